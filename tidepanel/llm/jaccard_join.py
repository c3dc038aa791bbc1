"""N-gram Jaccard join with R-trees over count vectors.

A document's shingles are hashed into groups; how many fall into each group is a point. Two sets share
at most the sum of the coordinate-wise minima of their points, and the upper corner of a box bounds
this for all points in it, so an R-tree finds all partners that a bound can't rule out. Those pairs are
verified on the whole sets.

The trees are dealt over tasks by shingles. Under one order of all shingles (``common`` ones last,
then by hash) two sets of similarity p % share a shingle among the first n - ceil(p n / 100) + 1 of each,
so documents that share such a shingle form a block with a tree of its own. The order decides only how
large blocks get, never a result; what is common is read off a bounded sample.

Equal sets are one class. In a first step documents that share one of their few least shingle hashes are joined,
inside blocks of bounded size that all hold the same few members of their bucket, each to one verified partner. So a group of
near copies is one component before the full search, which only looks at pairs between different components.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import Tables, components, groups_of, slices

#: Groups of a point, and of the finer one that sets of many shingles have as well. FINE is a multiple of GROUPS.
GROUPS, FINE, LONG = 128, 1024, 800
#: The most a stored count says; more counts as without bound, which only lets a pair through to verification.
MOST = 255
#: Odd multipliers of the words of a shingle, and of the mixing step after.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype="u8")
_MIX = np.uint64(0xC4CEB9FE1A85EC53)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, size: int, words: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of one text, for the signs of ``weak_toxicity``; the join uses ``shingle_sets``."""
    found = text.encode().lower().split() if text else []  # bytes: only A-Z change, and the split is the word rule
    if not found:
        return np.empty(0, dtype="u8")
    w = np.fromiter(map(words.__getitem__, found), dtype="u8", count=len(found))
    places = np.resize(_PLACES, size) * (2 * np.arange(size, dtype="u8") + np.uint64(1))
    with np.errstate(over="ignore"):
        if len(w) < size:
            h = np.array([(w * places[:len(w)]).sum(dtype="u8") + np.uint64(len(w))], dtype="u8")
        else:
            n = len(w) - size + 1
            h = np.zeros(n, dtype="u8")
            for i in range(size):
                h += w[i:i + n] * places[i]
        h = (h ^ (h >> np.uint64(29))) * _MIX
        h ^= h >> np.uint64(32)
    return np.unique(h)


#: A word's hash is a polynomial in its bytes' numbers (A-Z have those of a-z), mixed; longer words are hashed one by one.
_BYTES = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype="u8")
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LONG_WORD = 64
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 2**64) for i in range(LONG_WORD)], dtype="u8")
#: Bytes of texts that are hashed at once.
TEXT_BYTES = 1 << 18


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a text."""
    codes = np.frombuffer(raw, dtype="u1")
    inside = np.r_[False, ~_SPACE[codes], False]
    start, end = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    if not len(start):
        return start, np.empty(0, dtype="u8")
    n = end - start
    at = np.flatnonzero(inside[1:-1])
    place = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    h = np.add.reduceat(_BYTES[codes[at]] * _POWERS[np.minimum(place, LONG_WORD - 1)], np.cumsum(n) - n)
    h = _mixed(h + n.astype("u8") * _PLACES[4])
    for i in np.flatnonzero(n > LONG_WORD):
        h[i] = xxhash.xxh64_intdigest(raw[start[i]:end[i]].lower())
    return start, h


def shingle_sets(texts, size: int):
    """Of each text the sorted distinct 64-bit hashes of its shingles; of the whole sequence if it has fewer words."""
    held, held_bytes = [], 0
    for text in texts:
        held.append(text.encode() if text else b"")
        held_bytes += len(held[-1])
        if held_bytes >= TEXT_BYTES:
            yield from _sets_of(held, size)
            held, held_bytes = [], 0
    yield from _sets_of(held, size)


def _sets_of(raws: list[bytes], size: int):
    start, w = _word_hashes(b"\n".join(raws))
    places = np.resize(_PLACES, size) * (2 * np.arange(size, dtype="u8") + np.uint64(1))
    whole = np.zeros(max(0, len(w) - size + 1), dtype="u8")
    for i in range(size):
        whole += w[i:i + len(whole)] * places[i]
    whole = _mixed(whole)
    first = np.searchsorted(start, np.cumsum([0, *(len(x) + 1 for x in raws)]))  # the first word of each text
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            h = np.sort(whole[a:b - size + 1])
            yield h[np.r_[True, h[1:] != h[:-1]]]
        elif b > a:
            yield _mixed((w[a:b] * places[:b - a]).sum(dtype="u8", keepdims=True) + np.uint64(b - a))
        else:
            yield np.empty(0, dtype="u8")


def counts(hashes: np.ndarray) -> np.ndarray:
    """How many shingles each group has; long sets have finer groups, which add up to the common ones."""
    groups = GROUPS if len(hashes) < LONG else FINE
    return np.bincount((hashes % np.uint64(groups)).astype("i8"), minlength=groups)


def folded(point: np.ndarray) -> np.ndarray:
    return point.reshape(-1, GROUPS).sum(axis=0)


def prefix(hashes: np.ndarray, pct: int, common: np.ndarray) -> np.ndarray:
    """The first shingles in the order of the join, enough that similar sets share one."""
    n = len(hashes)
    take = n - -(-pct * n // 100) + 1 if n else 0
    if len(common) and n:
        late = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes
        if late.any():
            return np.concatenate([hashes[~late], hashes[late]])[:take]
    return hashes[:take]


class CountTree:
    """A packed R-tree of count vectors; boxes keep their upper corner and the range of set sizes."""

    FAN = 16

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((*points.T[:4], points.argmax(axis=1), sizes))
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > self.FAN:
            upper, low, high = self.levels[-1]
            at = np.arange(0, len(upper), self.FAN)
            self.levels.append((np.maximum.reduceat(upper, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    def partners(self, point: np.ndarray, size: int, pct: int) -> np.ndarray:
        """Indices of the points whose sets may have the similarity."""
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, low, high = self.levels[depth]
            ok = (100 * size >= pct * low[nodes]) & (100 * high[nodes] >= pct * size)
            nodes = nodes[ok]
            bound = np.minimum(upper[nodes], point).sum(axis=1)
            nodes = nodes[(100 + pct) * bound >= pct * (size + low[nodes])]
            if not depth:
                return self.order[nodes]
            nodes = (nodes[:, None] * self.FAN + np.arange(self.FAN)).ravel()
            nodes = nodes[nodes < len(self.levels[depth - 1][0])]


def similar(a: np.ndarray, b: np.ndarray, pct: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= pct * (len(a) + len(b) - both)


#: Leading shingles are buckets of their own, apart from those of the prefix.
_LEAD = np.uint64(0xA5A5A5A55A5A5A5A)


def _sets(size: int, pct: int, common, leads: int = 0):
    def run(parts):
        late = common.value if common is not None else np.empty(0, dtype="u8")
        for part in slices(parts):
            out = []
            for h in shingle_sets(part["text"], size):
                key = hashlib.md5(h.tobytes()).digest() if len(h) else None
                point = np.minimum(counts(h), MOST).astype("u1").tobytes() if len(h) else None
                out.append((len(h), key, prefix(h, pct, late).view("i8"), (h[:leads] ^ _LEAD).view("i8"), point))
            yield pd.DataFrame(out, columns=["n", "key", "first", "lead", "point"]).assign(id=part["id"].astype("Int64"), text_hash=part["text_hash"])
    return run


def _whole_sets(size: int):
    def run(parts):
        for part in slices(parts):
            items = []
            for key, h in zip(part["key"], shingle_sets(part["text"], size)):
                raw = h.tobytes()
                items.append(raw if hashlib.md5(raw).digest() == bytes(key) else None)  # None: another text under the same id
            yield part[["id"]].assign(items=items)
    return run


def _shared(chunk_rows: int, chunk_items: int):
    """Of postings sorted by (shingle, class): those of shingles with two classes or more, cut into chunks.

    Reads the stream once and holds a single posting between batches, however large a bucket is.
    """
    def run(parts):
        held, given = None, False
        chunk = rows = items = 0
        for part in parts:
            frame = part if held is None else pd.concat([held, part], ignore_index=True)
            if not len(frame):
                continue
            s, c = frame["s"].to_numpy(), frame["id"].to_numpy()
            fresh = np.r_[True, (s[1:] != s[:-1]) | (c[1:] != c[:-1])]
            frame, s, n = frame[fresh], s[fresh], frame["n"].to_numpy()[fresh]
            same = s[1:] == s[:-1]
            give = np.r_[False, same] | np.r_[same, False]
            at = np.full(len(s), -1)
            for i in np.flatnonzero(give):
                if not i and given:
                    continue  # went out with the batch before
                if not i or s[i] != s[i - 1]:
                    chunk = rows = items = 0
                elif rows >= chunk_rows or rows and items + n[i] > chunk_items:
                    chunk, rows, items = chunk + 1, 0, 0
                at[i] = chunk
                rows, items = rows + 1, items + n[i]
            held, given = frame.iloc[-1:], bool(give[-1]) or len(s) == 1 and given
            yield frame.assign(chunk=at)[at >= 0]
    return run


def _points(raw: list[bytes]) -> tuple[np.ndarray, list[np.ndarray | None]]:
    """Common points of a block, and the finer ones of its long sets."""
    each = []
    for x in raw:
        point = np.frombuffer(x, dtype="u1").astype("i8")
        point[point == MOST] = 1 << 40
        each.append(point)
    return np.stack([folded(p) for p in each]), [p if len(p) == FINE else None for p in each]


def _finer(fine: list[np.ndarray | None], n: np.ndarray, i: int, near: np.ndarray, pct: int) -> np.ndarray:
    """Of the partners found for member i, those that the finer points let through as well."""
    mine = fine[i]
    if mine is None or not len(near):
        return near
    ok = [fine[j] is None or (100 + pct) * np.minimum(mine, fine[j]).sum() >= pct * (n[i] + n[j]) for j in near]
    return near[np.array(ok)]


def _forest(pct: int):
    """Of each block, pairs that the tree lets through, no more than it takes to join them."""
    def run(parts):
        for part in groups_of(parts, "block"):
            members = sorted({(n, i): p for n, i, p in zip(part["n"], part["id"], part["point"])}.items())
            if len(members) < 2:
                continue
            (points, fine), n, ids, out = _points([p for _, p in members]), np.array([k[0] for k, _ in members]), [k[1] for k, _ in members], []
            tree = CountTree(points, n)
            for i in range(1, len(members)):
                near = tree.partners(points[i], n[i], pct)
                for j in np.sort(near[near < i]).tolist():
                    if len(_finer(fine, n, i, np.array([j]), pct)):
                        out.append((ids[j], ids[i]))
                        break
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])
    return run


def _search_block(pct: int):
    """Pairs of different components that the tree's bound lets through: the lower chunk is the tree."""
    def run(parts):
        for part in groups_of(parts, "block"):
            side, ids, comp, n = (np.array(part[c]) for c in ("side", "id", "comp", "n"))
            points, fine = _points(part["point"])
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side != 0)
            one = not len(right)
            right = left if one else right
            if not len(left):
                continue
            if one and len(left) <= CountTree.FAN:  # a single leaf: all bounds at once
                bound = np.minimum(points[:, None], points[None]).sum(axis=2)
                near = (100 * n[:, None] >= pct * n) & (100 * n >= pct * n[:, None]) & ((100 + pct) * bound >= pct * (n[:, None] + n)) & (comp[:, None] > comp)
                i, j = np.nonzero(near)
                ok = [len(_finer(fine, n, x, np.array([y]), pct)) > 0 for x, y in zip(i, j)]
                i, j = i[ok], j[ok]
                if len(i):
                    yield pd.DataFrame({"a": np.minimum(ids[i], ids[j]), "b": np.maximum(ids[i], ids[j])})
                continue
            tree, out = CountTree(points[left], n[left]), []
            for j, r in enumerate(right):
                near = tree.partners(points[r], n[r], pct)
                if one:
                    near = near[near < j]
                near = left[near]
                near = _finer(fine, n, r, near[comp[near] != comp[r]], pct)
                if len(near):
                    out.append(np.c_[np.minimum(ids[near], ids[r]), np.maximum(ids[near], ids[r])])
            if out:
                yield pd.DataFrame(np.concatenate(out), columns=["a", "b"])
    return run


def _verify(pct: int):
    def run(parts):
        for part in slices(parts):
            ok = [x is not None and y is not None and similar(np.frombuffer(x, dtype="u8"), np.frombuffer(y, dtype="u8"), pct) for x, y in zip(part["x"], part["y"])]
            yield part.loc[ok, ["a", "b"]]
    return run


def similar_documents(documents: DataFrame, size: int = 5, pct: int = 80, sample_rows: int = 3000, common_in_sample: int = 8,
                      max_common: int = 50_000, leads: int = 4, chunk_rows: int = 1500, chunk_items: int = 400_000, seeds: int = 8, broadcast_rows: int = 200_000,
                      id_col: str = "doc_id", text_col: str = "text", with_keys: bool = False) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable by links, itself included).

    Two texts link when their sets of ``size``-word shingles have a Jaccard similarity of ``pct`` % or more; a text of fewer
    words is one shingle. Null, empty and blank texts have no shingle, link with nothing and are components of
    their own; so are rows with a null id, whose component is null. Rows that repeat an id are judged each by its
    own text: their sets are nodes of their own, so two components may bear the name of one id. ``with_keys`` adds what tells those
    apart: component_key (one number per component, null without shingles) and text_hash (xxhash64 of the text). Equal sets link. Other columns are ignored.
    """
    spark = documents.sparkSession
    tables = Tables(spark, "jaccard")
    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    spec = "id long, n int, key binary, first array<long>, lead array<long>, point binary, text_hash long"
    total = max(1, rows.count())
    seen = (rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * min(1, sample_rows / total)) + 1)
            .mapInPandas(_sets(size, 0, None), spec)
            .select(F.explode("first").alias("s")).groupBy("s").count().where(F.col("count") >= common_in_sample)
            .orderBy(F.desc("count"), "s").limit(max_common).select("s").toPandas()["s"])
    common = spark.sparkContext.broadcast(np.sort(seen.to_numpy(dtype="i8").view("u8")))  # max_common numbers at most
    base = tables.write(rows.mapInPandas(_sets(size, pct, common, leads), spec))
    slim = tables.write(base.select("id", "n", "key", "text_hash"))
    able = "key IS NOT NULL AND id IS NOT NULL"
    # A set's node is the smallest id that has it; where different sets have the same smallest id, nodes are numbers and the ids return at the end.
    least = slim.where(able).groupBy("key").agg(F.min(F.struct("id", "text_hash")).alias("m"), F.first("n").alias("n"))
    names = tables.write(least.select("key", "n", F.col("m.id").alias("doc"), F.col("m.text_hash").alias("text_hash"), F.monotonically_increasing_id().alias("number")))
    clash = not names.groupBy("doc").count().where("count > 1").isEmpty()
    names = names.withColumn("id", F.col("number" if clash else "doc"))
    classes = base.where(able).groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("first").alias("first"), F.first("lead").alias("lead"))
    if clash:
        classes = classes.drop("id").join(names.select("key", "id"), "key")
    marked = F.concat(F.transform("first", lambda x: F.struct(x.alias("s"), F.lit(False).alias("lead"))), F.transform("lead", lambda x: F.struct(x.alias("s"), F.lit(True).alias("lead"))))
    postings = classes.select("id", "n", F.explode(marked).alias("p")).select("p.s", "id", "n", "p.lead")
    shared = tables.write(postings.repartition("s").sortWithinPartitions("s", "id").mapInPandas(_shared(chunk_rows, chunk_items), "s long, id long, n int, lead boolean, chunk long"))
    wanted = names.join(shared.select("id").distinct(), "id", "left_semi").select("doc", "text_hash", "key", "id")

    def small(df: DataFrame) -> DataFrame:
        """A written table, broadcast up to ``broadcast_rows`` rows of a few numbers each; beyond that it is shuffled."""
        df = tables.write(df)
        return F.broadcast(df) if df.count() <= broadcast_rows else df

    wanted = small(wanted)
    points = tables.write(base.select(F.col("id").alias("doc"), "n", "key", "point", "text_hash").join(wanted, ["doc", "text_hash", "key"]).select("id", "n", "point"))
    tables.drop(base)

    def verified(pairs: DataFrame) -> DataFrame:
        """The similar ones of the pairs: whole sets are hashed again, for the members of pairs only."""
        pairs = small(pairs)
        members = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        texts = rows.withColumnRenamed("id", "doc").join(small(wanted.join(members, "id", "left_semi")), ["doc", "text_hash"])
        items = tables.write(texts.mapInPandas(_whole_sets(size), "id long, items binary").where("items IS NOT NULL"))
        x = items.withColumnRenamed("id", "a").join(pairs, "a").select("a", "b", F.col("items").alias("x"))
        y = items.withColumnRenamed("id", "b").join(pairs, "b").select("a", "b", F.col("items").alias("y"))
        return x.join(y, ["a", "b"]).mapInPandas(_verify(pct), "a long, b long")

    # First step: what shares a leading shingle, in blocks that all hold the first members of their bucket.
    lead = shared.where("lead")
    first = lead.where("chunk = 0").groupBy("s").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "id"))), 1, seeds).alias("some"), F.count("*").alias("size"))
    more = lead.where("chunk > 0").select("s", "chunk").distinct()
    blocks = (lead.join(first.select("s", "size"), "s", "left").where("chunk > 0 OR size > 1").select(F.xxhash64("s", "chunk").alias("block"), "id")
              .unionByName(more.join(first, "s").select(F.xxhash64("s", "chunk").alias("block"), F.explode("some.id").alias("id"))).distinct())
    forest = blocks.join(points, "id").repartition("block").sortWithinPartitions("block").mapInPandas(_forest(pct), "a long, b long").distinct()
    links = tables.write(verified(forest))
    joined = components(links, tables).withColumnRenamed("node", "id")

    # Then every shared shingle, for pairs between components; a large bucket is searched chunk against chunk.
    known = tables.write(shared.where("NOT lead").select("s", "id", "chunk").join(joined, "id", "left").select("s", "id", "chunk", F.coalesce("component", "id").alias("comp")))
    open_ = known.groupBy("s").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), (F.max("chunk") + 1).alias("chunks"), F.count("*").alias("size"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("members")).where("low <> high")
    # Buckets with the same members are searched once.
    open_ = open_.groupBy("members", "size", "chunks", "low", "high").agg(F.min("s").alias("s"))
    dealt = (known.join(open_.select("s", "chunks"), "s").select("s", "id", "comp", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other"))
             .select(F.xxhash64("s", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("block"), "id", "comp", (F.col("chunk") > F.col("other")).cast("int").alias("side")))
    pairs = (dealt.join(points, "id").repartition("block").sortWithinPartitions("block")
             .mapInPandas(_search_block(pct), "a long, b long").distinct())
    found = components(joined.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(verified(pairs)), tables)
    answer = names.select("key", "id", "doc").join(found.withColumnRenamed("node", "id"), "id", "left").select("key", "doc", F.coalesce("component", "id").alias("component_key"))
    if clash:
        answer = answer.join(answer.groupBy("component_key").agg(F.min("doc").alias("component_id")), "component_key").select("key", "component_key", "component_id")
    else:
        answer = answer.select("key", "component_key", F.col("component_key").alias("component_id"))
    return (slim.join(answer, "key", "left")
            .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
                    *([F.when(F.col("id").isNotNull(), F.col("component_key")).alias("component_key"), "text_hash"] if with_keys else [])))
