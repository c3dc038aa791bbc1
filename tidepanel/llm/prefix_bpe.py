"""Byte-level BPE encoding by dynamic programming over byte prefixes, and decoding.

A sequence of tokens is what BPE makes of its bytes exactly when each token encodes to itself and
each adjacent pair encodes to that pair. So every byte prefix has one valid last token: the token
ending there whose predecessor (the last token of the prefix before it) forms a valid pair with
it. The table of last tokens is all the state there is: bytes can be appended without touching
it, and after an edit only the entries behind the edit are made anew until they repeat the old ones.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import slices

#: Bytes that a worker remembers chunks with (in two generations), the longest chunk it does, and pairs of tokens it keeps.
HELD, LONGEST, PAIRS = 64_000_000, 48, 400_000
#: A chunk is white space and what follows up to the next white space. Matches of the split patterns
#: supported here never run from other characters on into white space, so chunks split alone.
_CHUNKS = re.compile(r"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+").findall
#: White space beyond ASCII, or what some libraries count as such: then the whole text is split at once.
_ODD = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]").search


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def encoder_state(ranks: dict[bytes, int]) -> dict:
    """What an encoder works with, as plain dictionaries: broadcast, a worker fills them over all its tasks and lets go of them with the broadcast."""
    return {"ranks": ranks, "bytes_of": {r: t for t, r in ranks.items()}, "digits": {r: str(r) for r in ranks.values()}, "split": {}, "pairs": {}, "chunks": {}}


def token_finder(ranks: dict[bytes, int]) -> ahocorasick.Automaton:
    """Finds the tokens that end at each byte of a text (bytes read as Latin-1), the longest first."""
    out = ahocorasick.Automaton()
    for token, rank in ranks.items():
        out.add_word(token.decode("latin-1"), rank)
    out.make_automaton()
    return out


def packed(ids: list[int]) -> bytes:
    """Ids as native 32-bit numbers: small, and nothing for the garbage collector to walk."""
    return array("i", ids).tobytes()


class Remembered:
    """A dictionary bounded in bytes: when half of them are new, what was not asked for since the last time goes."""

    def __init__(self, store: dict):
        self.store = store
        if not store:
            store.update(new={}, old={}, held=0)

    def get(self, key):
        value = self.store["new"].get(key)
        if value is None and (value := self.store["old"].get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value):
        store = self.store
        store["held"] += 200 + len(key) + len(value)  # two objects, their slot and their content
        if store["held"] > HELD // 2:
            store["old"], store["new"], store["held"] = store["new"], {}, 0
        store["new"][key] = value


class PrefixEncoder:
    """A table of last tokens has an entry per byte prefix: the rank of its valid last token; that of the empty prefix, 0, is never read."""

    def __init__(self, state: dict):
        self.ranks, self.bytes_of, self.split = (state[k] for k in ("ranks", "bytes_of", "split"))
        self.longest, self.base = max(map(len, self.ranks), default=1), max(self.bytes_of, default=0) + 1
        self.pairs: dict[int, bool] = state["pairs"]
        if "finder" not in state:
            state["finder"], state["sizes"] = token_finder(self.ranks), {r: len(t) for t, r in self.ranks.items()}
        self.finder, self.sizes = state["finder"], state["sizes"]

    def merged(self, data: bytes, least: int = 1) -> list[bytes]:
        """BPE by definition, down to ``least`` parts; only ever run on a single token."""
        parts, ranks = [data[i:i + 1] for i in range(len(data))], self.ranks
        while len(parts) > least:
            best, at = min(((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """What the last merge of a token joins; None for one byte or a token that BPE never makes."""
        if token in self.split:
            return self.split[token]
        parts = self.merged(token, 2)
        out = self.split[token] = (parts[0], parts[1]) if len(parts) == 2 and token in self.ranks else None
        return out

    def follows(self, a: int | None, b: int) -> bool:
        """Whether BPE leaves token b behind token a, or at the start where a is None."""
        token = self.bytes_of[b]
        if len(token) > 1 and not self.halves(token):
            return False
        return a is None or self._follows(self.bytes_of[a], token)

    def _follows(self, a: bytes, b: bytes) -> bool:
        """Whether no merge across the border of the two tokens comes first.

        Goes back in time: what touches the border just before the later of the two was made.
        """
        ranks, never = self.ranks, 1 << 60
        limit = never
        while True:
            if ranks.get(a + b, never) < limit:
                return False
            ra, rb = (ranks[a] if len(a) > 1 else -1), (ranks[b] if len(b) > 1 else -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:  # of two equal ranks the left merge comes first, so b is the later one
                limit, a = ra, self.halves(a)[1]
            else:
                limit, b = rb + 1, self.halves(b)[0]

    def extend(self, data: bytes, last: list[int], to: int | None = None) -> list[int]:
        """Grow the table of last tokens (that of the empty prefix: [0]) up to ``to`` bytes."""
        return self._extend(data.decode("latin-1"), last, len(data) if to is None else to)

    def _extend(self, text: str, last: list[int], to: int) -> list[int]:
        pairs, sizes, base, at = self.pairs, self.sizes, self.base, len(last) - 1
        if at >= to:
            return last
        for end, rank in self.finder.iter(text, max(0, at + 1 - self.longest), to):
            if end != at:  # the last token of this prefix is there
                continue
            start = end + 1 - sizes[rank]
            key = last[start] * base + rank if start else -1 - rank
            ok = pairs.get(key)
            if ok is None:
                if len(pairs) >= PAIRS:
                    pairs.clear()
                ok = pairs[key] = self.follows(last[start] if start else None, rank)
            if ok:
                last.append(rank)
                at += 1
        if at != to:
            raise ValueError("the ranks lack a byte")
        return last

    def edit(self, data: bytes, last: list[int], start: int, stop: int, new: bytes) -> tuple[bytes, list[int]]:
        """data and its table after data[start:stop] is replaced; stops as soon as the old entries hold again."""
        changed = data[:start] + new + data[stop:]
        text, table, shift = changed.decode("latin-1"), last[:start + 1], len(changed) - len(data)
        same = 0
        while len(table) <= len(changed):
            self._extend(text, table, len(table))
            i = len(table) - 1
            # Equal last tokens over as many prefixes as a token is long, all past the edit, decide all that follows.
            same = same + 1 if i - shift >= stop and i - self.sizes[table[i]] >= start + len(new) and table[i] == last[i - shift] else 0
            if same > self.longest:
                table += last[i - shift + 1:]
                break
        return changed, table

    def taken(self, last: list[int]) -> list[int]:
        """Ids that the table's whole prefix encodes to."""
        ids, i, sizes = [], len(last) - 1, self.sizes
        while i:
            ids.append(last[i])
            i -= sizes[last[i]]
        return ids[::-1]

    def spans(self, last: list[int]) -> list[int]:
        """Ends of the tokens that the table's whole prefix encodes to."""
        return list(accumulate(map(self.sizes.__getitem__, self.taken(last))))


class TextEncoder:
    def __init__(self, state: dict, pattern: str):
        self.piece = PrefixEncoder(state)
        self.find = regex.compile(pattern).findall
        self.digits = state["digits"]
        self.chunks = Remembered(state["chunks"])

    def _pieces(self, pieces: set[str]) -> dict[str, bytes]:
        """Encoded in sorted order: each piece appends to the table of what it shares with the one before."""
        out, before, last, ranks = {}, b"", [0], self.piece.ranks
        for m in sorted(pieces):
            data = m.encode()
            rank = ranks.get(data)
            if rank is not None:  # as the library does: a whole match in the vocabulary is its token
                out[m] = packed([rank])
                continue
            same = 0
            for x, y in zip(before, data):
                if x != y:
                    break
                same += 1
            last = self.piece.extend(data, last[:same + 1])
            before = data
            out[m] = packed(self.piece.taken(last))
        return out

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks that aren't remembered; those of a chunk of several pieces are joined from the pieces'."""
        split = {c: self.find(c) for c in chunks}
        several = {m for found in split.values() if len(found) > 1 for m in found}
        known = {m: ids for m in several if (ids := self.chunks.get(m)) is not None}
        fresh = self._pieces((several - known.keys()) | {found[0] for found in split.values() if len(found) == 1})
        known |= fresh
        out = {c: known[found[0]] if len(found) == 1 else b"".join([known[m] for m in found]) for c, found in split.items()}
        for c, ids in (fresh | out).items():
            if len(c) <= LONGEST:
                self.chunks.put(c, ids)
        return out

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        split = [() if not t else [t] if _ODD(t) else _CHUNKS(t) for t in texts]
        found, new = {}, []
        for c in set().union(*split):
            ids = self.chunks.get(c)
            if ids is None:
                new.append(c)
            else:
                found[c] = ids
        found |= self._learn(new)
        return [memoryview(b"".join(map(found.__getitem__, x))).cast("i").tolist() for x in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.piece.bytes_of.__getitem__, ids))


def _in_blocks(coder: TextEncoder, texts, size: int = 4_000_000):
    """Ids of every text; texts are taken together up to so many characters."""
    block, chars = [], 0
    for t in texts:
        block.append(t)
        chars += len(t or "")
        if chars >= size:
            yield from coder.encode_all(block)
            block, chars = [], 0
    yield from coder.encode_all(block)


def round_trip(documents: DataFrame, ranks_path: str, pattern: str, with_ids: bool = True, with_text: bool = False,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode its ids again, one row per input row.

    Columns: id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (decoded bytes),
    with ``with_ids`` the array ids, with ``with_text`` the binary decoded. A null text is an
    empty one: no ids. Rows are independent, so repeated rows, ties and null ids come out as they went
    in; texts of any length are encoded whole. Other columns are ignored.
    """
    state = documents.sparkSession.sparkContext.broadcast(encoder_state(load_ranks(ranks_path)))  # grows with the vocabulary file alone
    spec = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids + ", decoded binary" * with_text

    def run(parts):
        coder = TextEncoder(state.value, pattern)
        sha = hashlib.sha256
        for part in slices(parts):
            out = {"id": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []} | ({"ids": []} if with_ids else {}) | ({"decoded": []} if with_text else {})
            out["id"] = part["id"]
            for ids in _in_blocks(coder, part["text"]):
                back = coder.decode(ids)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(sha(",".join(map(coder.digits.__getitem__, ids)).encode()).hexdigest())
                out["decoded_sha256"].append(sha(back).hexdigest())
                if with_ids:
                    out["ids"].append(np.array(ids, dtype="i4"))
                if with_text:
                    out["decoded"].append(back)
            yield pd.DataFrame(out).astype({"id": "Int64"})

    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, spec).withColumnRenamed("id", id_col)
