"""Packing documents into sequences of bounded length by a grouping genetic algorithm on islands.

Each document is its token ids and an end id; only one longer than a sequence is cut. Pieces are dealt by a hash into
shards of a few thousand. For each shard several islands breed packings of their own: a child takes whole well-filled bins of one parent,
the bins of the other that hold a duplicate are dissolved, and the documents displaced by that go by best fit, longest first. After an
epoch the elites of an island migrate to the next one of the shard; islands are rows, so any task may breed any of them. The best packing
of a shard stands, but for its least filled bins: those of sixteen shards are bred again as a shard of the next level, until one is left.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidepanel.llm.common import Tables

CAPACITY, END_ID = 2048, 0
#: Pieces of a shard; shards whose open bins make a shard of the next level; bins and pieces that a shard hands up.
SHARD, FAN_IN, OPEN_BINS, OPEN_PIECES = 4096, 16, 32, 1024
ISLANDS, EPOCHS, POPULATION, GENERATIONS, ELITES = 2, 3, 8, 8, 2
#: Bytes of remembered words in a worker, and characters of the longest one remembered.
REMEMBERED, LONGEST = 96_000_000, 48


#: What the tokenizer's own pattern parts lower-case text into.
UNITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters whose normal form, case and class are settled one by one: Latin, Greek and Cyrillic without combining marks, and common signs,
#: without the few letters whose lower case is elsewhere.
SETTLED_RANGES = ((0, 0x239), (0x23B, 0x23D), (0x23F, 0x2FF), (0x388, 0x3FC), (0x400, 0x482), (0x48A, 0x52F), (0x2010, 0x2027), (0x2030, 0x203E), (0x20A0, 0x20BF))


def _class_of(kind: str) -> str:
    """The settled characters of a general category, as ranges of a pattern."""
    found = [i for a, b in SETTLED_RANGES for i in range(a, b + 1) if unicodedata.category(chr(i))[0] == kind]
    return "".join(re.escape(chr(i)) for i in found)


def _bytes_as_text() -> dict[int, str]:
    """The usual byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}


class UnitCoder:
    """Token ids of texts, as little-endian unsigned 32-bit numbers.

    A text of settled characters is parted into units (words, digits, marks) as the tokenizer does it, and each new unit is encoded once by its
    merges. Of another text those chunks between spaces and line feeds that aren't settled go through the whole tokenizer, as its
    parts never join anything over white space.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        numbers = np.arange(self.tokenizer.get_vocab_size(), dtype="<u4").tobytes()
        self.packed = [numbers[i:i + 4] for i in range(0, len(numbers), 4)]
        self.merge, self.alphabet = self.tokenizer.model.tokenize, _bytes_as_text()
        letters, numbers = _class_of("L"), _class_of("N")
        self.settled = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in SETTLED_RANGES) + "]*").fullmatch
        self.units = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\t\n\x0b\x0c\r \x85\xa0{letters}{numbers}]+").findall
        self.words, self.older, self.held = {}, {}, 0

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.settled(text) and "<|" not in text:
            return self._settled(text)
        return b"".join([self._settled(c) if self.settled(c) and "<|" not in c else np.array(self.tokenizer.encode(c, add_special_tokens=False).ids, dtype="<u4").tobytes()
                         for c in text.replace("\n", " ").split(" ") if c])

    def _settled(self, text: str) -> bytes:
        units = self.units(text.lower() if "Σ" not in text else "".join(map(str.lower, text)))  # a last sigma is like any other
        try:
            return b"".join(map(self.words.__getitem__, units))
        except KeyError:
            return b"".join([self.words.get(u) or self._word(u) for u in units])

    def _word(self, unit: str) -> bytes:
        known = self.older.get(unit)
        if known is None:
            known = b"".join([self.packed[t.id] for t in self.merge(unit if unit.isascii() and unit.isprintable() else unit.encode().decode("latin-1").translate(self.alphabet))])
        if len(unit) <= LONGEST:
            self.words[unit] = known
            self.held += 200 + len(unit) + len(known)
            if self.held > REMEMBERED // 2:  # words not met again since the last turn go
                self.older, self.words, self.held = self.words, {}, 0
        return known


def separable(tokenizer_json: str) -> bool:
    """Whether texts may be cut at spaces and line feeds: the parts of the tokenizer are known to drop white space and to join nothing over it."""
    spec = json.loads(tokenizer_json)
    norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    norms = [(n["type"], n.get("pattern", {}).get("Regex"), n.get("content")) for n in norm.get("normalizers", [norm] if norm else [])]
    pres = pre.get("pretokenizers", [pre] if pre else [])
    split = [p for p in pres if p["type"] == "Split" and p["behavior"] == "Removed" and p["invert"] and p["pattern"].get("Regex") == UNITS]
    plain = all(p in split or (p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p["use_regex"]) for p in pres)
    apart = all(" " not in t["content"] and "\n" not in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec.get("added_tokens", []))
    marked = (spec.get("model") or {}).get("end_of_word_suffix") == "</w>"
    return bool(split) and plain and apart and marked and spec.get("post_processor") is None and all(n in (("NFC", None, None), ("Lowercase", None, None), ("Replace", r"\s+", " ")) for n in norms)


def pieces_of(documents: DataFrame, tokenizer_path: str, capacity: int, end_id: int, with_ids: bool, id_col: str, text_col: str) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, if asked for, ids."""
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    if not separable(text):
        raise ValueError("only tokenizers that drop white space and join nothing over it are supported")
    state = documents.sparkSession.sparkContext.broadcast({"json": text})  # grows with the vocabulary file alone
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    fields = [docs.schema["id"], *[T.StructField(c, t) for c, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()))]]
    schema = T.StructType(fields + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        coder = state.value.get("coder") or state.value.setdefault("coder", UnitCoder(state.value["json"]))
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                batch = whole.slice(a, 1000)
                doc, out = [], {"piece": [], "start": [], "length": [], "ids_crc32": []} | ({"ids": []} if with_ids else {})
                for i, text in enumerate(batch.column(1).to_pylist()):
                    data = coder.encode(text) + end
                    for piece, start in enumerate(range(0, len(data) // 4, capacity)):
                        part = data[4 * start:4 * (start + capacity)]
                        doc.append(i)
                        for c, v in (("piece", piece), ("start", start), ("length", len(part) // 4), ("ids_crc32", zlib.crc32(part))):
                            out[c].append(v)
                        if with_ids:
                            out["ids"].append(np.frombuffer(part, dtype="<u4").astype("i4"))
                kinds = {"piece": pa.int32(), "ids": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc, pa.int32())), *[pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()]], names=["id", *out])

    return docs.mapInArrow(run, schema)


def best_fit(lengths: list[int], fills: list[int], capacity: int) -> list[int]:
    """Bin of each length in turn: the fullest it fits into, or a new one. ``fills`` grows along."""
    room = [[] for _ in range(capacity + 1)]
    free_sizes = 0  # bit n: some bin has n free
    for b, fill in enumerate(fills):
        room[capacity - fill].append(b)
        free_sizes |= 1 << (capacity - fill)
    out = []
    for n in lengths:
        fitting = free_sizes >> n
        if fitting:
            free = n + (fitting & -fitting).bit_length() - 1
            b = room[free].pop()
            if not room[free]:
                free_sizes ^= 1 << free
        else:
            b, free = len(fills), capacity
            fills.append(0)
        out.append(b)
        fills[b] += n
        room[free - n].append(b)
        free_sizes |= 1 << (free - n)
    return out


def bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins."""
    return max(-(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()))


def quality(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Smaller is better: number of bins, then how unevenly they are filled (a few open bins are worth more than many nearly full ones)."""
    fills = np.bincount(bins, weights=lengths)
    return len(fills), -float(((fills / capacity) ** 2).sum())


def complete(bins: np.ndarray, lengths: np.ndarray, loose: np.ndarray, capacity: int) -> np.ndarray:
    """``bins`` numbered anew without gaps, and the ``loose`` pieces (bin -1) put in by best fit, longest first."""
    fixed = bins >= 0
    _, bins[fixed] = np.unique(bins[fixed], return_inverse=True)
    fills = np.bincount(bins[fixed], weights=lengths[fixed]).astype(int).tolist() if fixed.any() else []
    loose = loose[np.argsort(-lengths[loose], kind="stable")]
    bins[loose] = best_fit(lengths[loose].tolist(), fills, capacity)
    return bins


def cross(one: np.ndarray, other: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of ``other`` go into ``one``; its bins that held any of their pieces are dissolved, as are its emptiest ones."""
    fills = np.bincount(other, weights=lengths)
    well = np.flatnonzero(fills >= np.quantile(fills, 0.5))
    taken = np.zeros(len(fills), dtype=bool)
    taken[rng.choice(well, size=max(1, int(len(well) * rng.uniform(0.1, 0.5))), replace=False)] = True
    put = taken[other]
    own = np.bincount(one, weights=lengths)
    gone = np.zeros(len(own), dtype=bool)
    gone[one[put]] = True
    kept = np.flatnonzero(~gone)
    gone[kept[np.argsort(own[kept] + rng.uniform(0, capacity / 8, len(kept)))[:max(1, len(kept) // 20)]]] = True
    child = np.where(put, other + len(own), np.where(gone[one], -1, one))
    return complete(child, lengths, np.flatnonzero(child < 0), capacity)


def evolve(lengths: np.ndarray, population: list[np.ndarray], rng: np.random.Generator, capacity: int) -> list[np.ndarray]:
    """An epoch of one island: the population after it, best first. Ends early at a packing that can't be bettered."""
    goal = bound(lengths, capacity)
    everything = np.arange(len(lengths))

    def fresh(noise):
        out, order = np.full(len(lengths), -1), np.argsort(-lengths * rng.uniform(1 - noise, 1, len(lengths)), kind="stable")
        out[order] = best_fit(lengths[order].tolist(), [], capacity)
        return out

    ranked = sorted(((quality(p, lengths, capacity), i, p) for i, p in enumerate(population)), key=lambda x: x[:2])
    if not ranked:
        first = complete(np.full(len(lengths), -1), lengths, everything, capacity)
        ranked = [(quality(first, lengths, capacity), 0, first)]
    while ranked[0][0][0] > goal and len(ranked) < POPULATION:
        p = fresh(rng.choice([0.02, 0.1, 0.3]))
        ranked = sorted([*ranked, (quality(p, lengths, capacity), len(ranked), p)], key=lambda x: x[:2])
    number = len(ranked)
    for _ in range(GENERATIONS):
        if ranked[0][0][0] <= goal:
            break
        children = []
        for _ in range(POPULATION):
            a, b = sorted(rng.integers(0, len(ranked), 4).reshape(2, 2).min(axis=1))  # tournaments of two
            if a == b:
                b = (a + 1) % len(ranked)
            pair = (ranked[a][2], ranked[b][2])
            child = cross(*(pair if rng.random() < 0.5 else pair[::-1]), lengths, capacity, rng)
            number += 1
            children.append((quality(child, lengths, capacity), number, child))
        ranked = sorted(ranked + children, key=lambda x: x[:2])[:POPULATION]
    return [p for _, _, p in ranked]


def breed(groups: DataFrame, tables: Tables, capacity: int, seed: int) -> DataFrame:
    """(shard, best): the best packing of each shard, the bin of each of its pieces as packed 32-bit numbers.

    groups: shard, at, lengths. Every epoch is a job over (shard, island) rows of the shards that may still be bettered.
    """
    spark = groups.sparkSession
    spec = "shard long, island int, bound int, bins int, quality double, elites array<binary>"
    tasks = lambda n: max(1, min(n * ISLANDS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    lived, state, work = [], None, groups
    for epoch in range(EPOCHS):
        def run(parts):
            for part in parts:
                out = []
                for r in part.itertuples():
                    lengths = np.asarray(r.lengths, dtype="i8")
                    come = [] if r.elites is None else [np.frombuffer(e, dtype="<i4").astype("i8") for e in r.elites]
                    best = evolve(lengths, come, np.random.default_rng([seed, r.shard, r.island, epoch]), capacity)
                    bins, even = quality(best[0], lengths, capacity)
                    out.append((r.shard, r.island, bound(lengths, capacity), bins, even, [p.astype("<i4").tobytes() for p in best[:ELITES]]))
                yield pd.DataFrame(out, columns=["shard", "island", "bound", "bins", "quality", "elites"])

        rows = work.select("shard", "lengths", F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"))
        if state is None:
            rows = rows.withColumn("elites", F.lit(None).cast("array<binary>"))
        else:  # an island goes on from its own elites and those of the one before it
            came = state.unionByName(state.withColumn("island", (F.col("island") + 1) % ISLANDS)).groupBy("shard", "island").agg(F.flatten(F.collect_list("elites")).alias("elites"))
            rows = rows.join(came, ["shard", "island"])
        n = work.count()
        lived.append(tables.write(rows.repartition(tasks(n), "shard", "island").mapInPandas(run, spec)))
        state = lived[-1].select("shard", "island", "elites")
        unsettled = lived[-1].groupBy("shard").agg(F.min("bins").alias("least"), F.max("bound").alias("bound")).where("least > bound").select("shard")
        if epoch + 1 == EPOCHS or unsettled.isEmpty():
            break
        work = groups.join(unsettled, "shard", "left_semi")
    everything = lived[0]
    for later in lived[1:]:
        everything = everything.unionByName(later)
    return everything.groupBy("shard").agg(F.min_by(F.col("elites")[0], F.struct("bins", "quality", "island")).alias("best"))


def settle(groups: DataFrame, best: DataFrame, level: int, last: bool, capacity: int) -> DataFrame:
    """(at, length, shard, sequence_id, offset) of each piece; the id is null for pieces of open bins, which go up a level."""
    def run(parts):
        for part in parts:
            for r in part.itertuples():
                at, lengths, bins = np.asarray(r.at, dtype="i8"), np.asarray(r.lengths, dtype="i8"), np.frombuffer(r.best, dtype="<i4").astype("i8")
                fills, held = np.bincount(bins, weights=lengths), np.bincount(bins)
                low = np.argsort(fills, kind="stable")[:0 if last else OPEN_BINS]
                low = low[(np.cumsum(held[low]) <= OPEN_PIECES) & (fills[low] < capacity)]
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(lengths[order])
                offset = ends - lengths[order]
                offset -= np.concatenate([[0], np.cumsum(fills).astype("i8")])[bins[order]]
                up = np.isin(bins[order], low)
                place = (level << 56) + (int(r.shard) << 20) + bins[order]
                yield pd.DataFrame({"at": at[order], "length": lengths[order], "shard": r.shard, "sequence_id": pd.array(place, dtype="Int64"), "offset": offset}).assign(
                    sequence_id=lambda d: d["sequence_id"].mask(up))

    rows = groups.join(best, "shard").select("shard", "at", "lengths", "best")
    return rows.mapInPandas(run, "at long, length long, shard long, sequence_id long, offset long")


def place_pieces(pieces: DataFrame, tables: Tables, capacity: int, seed: int) -> DataFrame:
    """(at, sequence_id, offset) for pieces of (at, length); ``at`` tells them apart."""
    shards = max(1, -(-pieces.count() // SHARD))
    rows = pieces.select("at", "length", F.pmod(F.xxhash64("at", F.lit(seed)), F.lit(shards)).alias("shard"))
    settled, level = [], 0
    while True:
        groups = rows.groupBy("shard").agg(F.collect_list(F.struct("length", "at")).alias("p"))  # about SHARD pieces, or FAN_IN * OPEN_PIECES at most
        groups = groups.select("shard", F.array_sort("p").alias("p")).select("shard", F.col("p.at").alias("at"), F.col("p.length").alias("lengths"))
        groups = tables.write(groups)
        settled.append(tables.write(settle(groups, breed(groups, tables, capacity, seed), level, shards == 1, capacity)))
        if shards == 1:
            break
        rows = settled[-1].where("sequence_id IS NULL").select("at", "length", F.expr(f"shard div {FAN_IN}").alias("shard"))
        shards, level = -(-shards // FAN_IN), level + 1
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out.where("sequence_id IS NOT NULL").select("at", "sequence_id", "offset")


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True, seed: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset and, with ``with_ids``, the array ids.

    A null text is an empty one: its only token is the end id. Pieces of a document are numbered from 0 and hold ``capacity`` tokens but for the
    last. Every sequence is filled without gaps from offset 0 up to ``capacity`` tokens at most. Each row is a document of its own, so repeated rows, equal lengths and null ids come out as
    often as they went in. An empty table gives no rows. Other columns are ignored; texts of any length are taken whole.
    """
    tables = Tables(documents.sparkSession, "packing")
    pieces = tables.write(pieces_of(documents, tokenizer_path, capacity, end_id, with_ids, id_col, text_col).withColumn("at", F.monotonically_increasing_id()))
    out = pieces.join(place_pieces(pieces, tables, capacity, seed), "at")
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens, ids in order of offset; a group holds one sequence's pieces."""
    whole = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return whole.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids")).select("sequence_id", F.size("ids").cast("long").alias("n_tokens"), "ids")
