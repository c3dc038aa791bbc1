"""Token counts by byte-pair merging with a heap over a linked list of symbols.

The heap pops the best-ranked adjacent pair again and again; a pair whose neighbours have changed
since it was pushed is skipped. The count is the initial symbols minus the merges, so no
identifiers are ever made. A symbol outside the vocabulary counts as its UTF-8 bytes (byte fallback).

Two exact cuts keep segments short. No vocabulary piece has a space mark after another
character, so no merge crosses into a space mark; no piece holds a line feed next to anything, so
none crosses one. Both are checked against the vocabulary and left out where it disagrees.
"""

from __future__ import annotations

import heapq
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Segments a worker remembers, and the longest one it does.
REMEMBERED, LONGEST = 400_000, 48


def load_pieces(path: str) -> dict:
    """Merge scores of a sentencepiece BPE model and what its normaliser does."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm = model.normalizer_spec
    if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or not norm.escape_whitespaces or norm.remove_extra_whitespaces or not model.trainer_spec.byte_fallback:
        raise ValueError("only BPE models with byte fallback and an identity normaliser that keeps white space are supported")
    if any(p.type in (4, 5) for p in model.pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    scores = {p.piece: p.score for p in model.pieces if p.type == 1}
    many = [p for p in scores if len(p) > 1]
    return {"scores": scores, "prefix": norm.add_dummy_prefix, "by_mark": not any(re.search(f"[^{MARK}]{MARK}", p) for p in many), "by_line": not any("\n" in p for p in many)}


class PieceCounter:
    def __init__(self, model: dict):
        self.scores, self.prefix = model["scores"], model["prefix"]
        self.known: dict[str, int] = model.setdefault("known", {})  # broadcast, a worker fills it over all its tasks
        self.segments = None
        if model["by_mark"]:
            rest = f"[^{MARK}\n]" if model["by_line"] else f"[^{MARK}]"
            self.segments = re.compile(f"{MARK}*{rest}+|{MARK}+" + ("|\n" if model["by_line"] else "")).findall

    def merged(self, segment: str) -> int:
        """Tokens of one segment."""
        scores = self.scores
        text = list(segment)
        n = len(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            s = scores.get(text[i] + text[i + 1])
            if s is not None:
                heap.append((-s, i, i + 1, 2))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not text[i] or not text[j] or after[i] != j or len(text[i]) + len(text[j]) != size:
                continue
            text[i] += text[j]
            text[j] = ""
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                s = scores.get(text[i] + text[k])
                if s is not None:
                    heapq.heappush(heap, (-s, i, k, size + len(text[k])))
            h = before[i]
            if h >= 0:
                s = scores.get(text[h] + text[i])
                if s is not None:
                    heapq.heappush(heap, (-s, h, i, len(text[h]) + size))
        return n - merges + sum(len(c.encode()) - 1 for c in text if len(c) == 1 and c not in scores)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = (MARK if self.prefix else "") + text.replace(" ", MARK)
        if self.segments is None:
            return self.merged(text)
        known, total = self.known, 0
        for s in self.segments(text):
            n = known.get(s)
            if n is None:
                n = self.merged(s)
                if len(s) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[s] = n
            total += n
        return total


def token_counts(documents: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty: 0 bytes, 0 tokens. Rows are independent, so repeated rows, ties
    and null ids come out as they went in; texts of any length are counted whole. Other columns are ignored.
    """
    model = documents.sparkSession.sparkContext.broadcast(load_pieces(model_path))  # as large as the vocabulary file

    def run(parts):
        counter = PieceCounter(model.value)
        for part in parts:
            yield pd.DataFrame({"id": part["id"], "n_tokens": [counter.count(t) for t in part["text"]], "n_bytes": [0 if t is None else len(t.encode()) for t in part["text"]]}).astype({"id": "Int64"})

    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInPandas(run, "id long, n_tokens long, n_bytes long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
