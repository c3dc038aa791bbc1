"""Removal of long repeated byte strings by deep-shallow suffix sorting.

A byte goes if it lies in a string of ``window`` bytes that also starts anywhere else. Every such
string holds an anchor: a place whose hash of the next ``gram`` bytes is the least of some window around
it. Anchors depend on the bytes alone, so equal strings have them in equal places, and only suffixes that
start at anchors of one hash need to be sorted against each other.

Those suffixes are sorted twice, to the right and (reversed) to the left of the anchor, by a deep-shallow
sort: multikey quicksort down to a shallow depth, then a blind trie for every group that still agrees. Two
occurrences agree on L bytes to the left and R to the right; where L + R >= window, those bytes go.
For each node of the left order (occurrences that agree on its L bytes) the best R of a member is
that with its neighbour in the right order, so no pairs are listed.

Texts that are equal are one class, and so are equal surroundings of an anchor: these are only counted.
An anchor with very many different surroundings is sorted in chunks, each chunk against each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import Tables, groups_of

SHALLOW, STEP = 24, 8
_P, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _slide(x: np.ndarray, size: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of ``size`` values."""
    had = 1
    while 2 * had <= size:
        x = pick(x[:-had], x[had:])
        had *= 2
    return pick(x[:len(x) - (size - had)], x[size - had:]) if had < size else x


def anchors(data: bytes, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of a text and their hashes. ``gram`` is a power of two."""
    if len(data) < window:
        return np.empty(0, dtype="i8"), np.empty(0, dtype="u8")
    with np.errstate(over="ignore"):
        h, p, had = np.frombuffer(data, dtype="u1").astype("u8") + np.uint64(1), _P, 1
        while had < gram:
            h = h[:-had] * p + h[had:]
            p, had = p * p, 2 * had
        h = (h ^ (h >> np.uint64(31))) * _C
        h ^= h >> np.uint64(29)
    run = window - gram + 1
    least = _slide(h, run, np.minimum)
    edge = np.zeros(run - 1, dtype="u8")
    at = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), run, np.maximum) == h)
    return at, h[at]


def common_length(a: bytes, b: bytes, known: int = 0) -> int:
    most = min(len(a), len(b))
    if a[known:most] == b[known:most]:
        return most
    low, high = known, most
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """Orders strings that agree on their first ``depth`` bytes.

    Nodes keep only the depth at which strings part and the byte of each branch. A string goes down blindly,
    is compared once with the leaf it reaches, and gets a branch where the two part.
    """

    def __init__(self, strings: list[bytes], depth: int):
        self.strings, self.depth, self.root = strings, depth, None

    def _byte(self, s: bytes, at: int) -> int:
        return s[at] if at < len(s) else -1

    def insert(self, i: int) -> None:
        s = self.strings[i]
        node = self.root
        if node is None:
            self.root = [None, [i]]
            return
        while node[0] is not None:  # [depth, branches] or [None, leaf]
            node = node[1].get(self._byte(s, node[0])) or next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        at = common_length(s, other, self.depth)
        if at == len(s) == len(other):
            node[1].append(i)
            return
        above, key, node = None, None, self.root
        while node[0] is not None and node[0] < at:
            above, key = node, self._byte(s, node[0])
            node = node[1][key]
        if node[0] == at:
            node[1][self._byte(s, at)] = [None, [i]]
            return
        fork = [at, {self._byte(s, at): [None, [i]], self._byte(other, at): node}]
        if above is None:
            self.root = fork
        else:
            above[1][key] = fork

    def order(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if node[0] is None:
                out += node[1]
            else:
                todo += [node[1][k] for k in sorted(node[1], reverse=True)]
        return out


def deep_shallow(strings: list[bytes]) -> list[int]:
    """Indices of the strings in order."""
    out: list[int] = []
    todo = [(list(range(len(strings))), 0)]
    while todo:
        group, depth = todo.pop()
        if len(group) < 2:
            out += group
        elif depth >= SHALLOW:
            trie = BlindTrie(strings, depth)
            for i in group:
                trie.insert(i)
            out += trie.order()
        else:
            keys = [strings[i][depth:depth + STEP] for i in group]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            less = [i for i, k in zip(group, keys) if k < pivot]
            more = [i for i, k in zip(group, keys) if k > pivot]
            same = [i for i, k in zip(group, keys) if k == pivot]
            todo.append((more, depth))
            todo.append((same, SHALLOW if len(pivot) < STEP else depth + STEP))  # strings that end here are equal
            todo.append((less, depth))
    return out


def repeats(lefts: list[bytes], rights: list[bytes], window: int) -> list[tuple[int, int, int]]:
    """(occurrence, bytes to the left, bytes to the right) that other occurrences repeat, the most of each.

    lefts are reversed: they run away from the anchor. What one occurrence shares with others always spans the
    anchor, so the union over the others is one span.
    """
    m = len(lefts)
    if m == 2:
        a, b = common_length(lefts[0], lefts[1]), common_length(rights[0], rights[1])
        return [(0, a, b), (1, a, b)] if a + b >= window else []
    by_right = deep_shallow(rights)
    rank = np.empty(m, dtype="i8")
    rank[by_right] = np.arange(m)
    table = [np.array([common_length(rights[i], rights[j]) for i, j in zip(by_right, by_right[1:])])]
    widest = int(table[0].max())
    by_left = deep_shallow(lefts)
    agree = [common_length(lefts[i], lefts[j]) for i, j in zip(by_left, by_left[1:])]
    if max(agree) + widest < window:
        return []
    while 2 ** len(table) <= m - 1:  # minima over runs of 1, 2, 4, ... neighbours
        half = 2 ** (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    place = rank[by_left]
    lo, hi = np.zeros(m, dtype="i8"), np.zeros(m, dtype="i8")  # by rank

    def node(low: int, high: int, depth: int) -> None:
        if depth + widest < window:
            return
        if high - low == 2:
            a, b = place[low], place[low + 1]
            r = common_length(rights[by_right[a]], rights[by_right[b]])
            if depth + r >= window:
                for x in (a, b):
                    lo[x], hi[x] = max(lo[x], depth), max(hi[x], r)
            return
        ranks = np.sort(place[low:high])
        a, b = ranks[:-1], ranks[1:]
        level = np.frexp(b - a)[1] - 1
        shared = np.empty(len(a), dtype="i8")
        for k in range(level.min(), level.max() + 1):
            at = level == k
            shared[at] = np.minimum(table[k][a[at]], table[k][b[at] - 2 ** k])
        right = np.maximum(np.r_[shared, 0], np.r_[0, shared])
        ok = depth + right >= window
        x = ranks[ok]
        lo[x], hi[x] = np.maximum(lo[x], depth), np.maximum(hi[x], right[ok])

    stack: list[list[int]] = []  # open nodes: [first member, depth]
    for i, depth in enumerate([*agree, -1]):
        low = i
        while stack and stack[-1][1] > depth:
            low, d = stack.pop()
            node(low, i + 1, d)
        if depth >= 0 and (not stack or stack[-1][1] < depth):
            stack.append([low, depth])
    return [(by_right[x], int(lo[x]), int(hi[x])) for x in np.flatnonzero(hi)]


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _find_anchors(window: int, gram: int):
    def run(parts):
        for part in parts:
            hs, keys, at = [], [], []
            for key, text in zip(part["key"], part["text"]):
                p, h = anchors(text.encode(), window, gram)
                hs.append(h.view("i8")), at.append(p), keys.extend([key] * len(p))  # a list: numpy drops zero bytes at the end of a key
            if hs:
                yield pd.DataFrame({"h": np.concatenate(hs), "key": keys, "at": np.concatenate(at)})
    return run


def _contexts(window: int, gram: int, with_bytes: bool):
    """Around each anchor of a text that is not alone: what any window over the anchor can reach.

    Without bytes a row for each place; with them one for each surrounding that a batch has.
    """
    reach = window - gram
    names = ["h", "c", "left", "right"] if with_bytes else ["h", "c", "key", "at"]

    def run(parts):
        for part in parts:
            out, seen = [], set()
            for key, text, hs, ats in zip(part["key"], part["text"], part["hs"], part["ats"]):
                data = text.encode()
                for h, at in zip(hs.tolist(), ats.tolist()):
                    left, right = data[max(0, at - reach):at], data[at:at + window]
                    c = hashlib.md5(len(left).to_bytes(4, "big") + left + right).digest()
                    if not with_bytes:
                        out.append((h, c, key, at))
                    elif (h, c) not in seen:
                        seen.add((h, c))
                        out.append((h, c, left[::-1], right))
                if len(out) > 10_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)
    return run


def _sorted_groups(window: int):
    def run(parts):
        out = []
        for part in groups_of(parts, "block"):
            if len(part["c"]) > 1:
                unique = list({c: (left, right) for c, left, right in zip(part["c"], part["left"], part["right"])}.items())
                if len(unique) > 1:
                    h = part["h"][0]
                    out += [(h, unique[i][0], left, right) for i, left, right in repeats([x[1][0] for x in unique], [x[1][1] for x in unique], window)]
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=["h", "c", "lo", "hi"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["h", "c", "lo", "hi"])
    return run


def _cut(parts):
    for part in parts:
        out = []
        for key, text, starts, stops in zip(part["key"], part["text"], part["starts"], part["stops"]):
            data, gone, end, kept = text.encode(), merged(zip(starts.tolist(), stops.tolist())), 0, hashlib.sha256()
            for a, b in gone:
                kept.update(data[end:a])
                end = b
            kept.update(data[end:])
            out.append((key, sum(b - a for a, b in gone), len(gone), kept.hexdigest(), [{"start": a, "stop": b} for a, b in gone]))
        yield pd.DataFrame(out, columns=["key", "n_removed", "n_spans", "kept_sha256", "spans"])


def _of_several(found: DataFrame, several: DataFrame, chunk_rows: int, broadcast_rows: int = 100_000) -> DataFrame:
    """The anchors whose hash is in ``several`` (h, count).

    Hashes at more than ``chunk_rows`` places are few (all places / chunk_rows at most) and go to the anchors by a broadcast whose rows
    are counted first, so none of them is shuffled into one task. Beyond ``broadcast_rows`` of them all are joined by
    shuffle and splitting is left to the skew handling of adaptive execution.
    """
    hot = several.where(F.col("count") > chunk_rows).select("h")
    if not 0 < hot.count() <= broadcast_rows:
        return found.join(several.select("h"), "h")
    hot = F.broadcast(hot)
    rare = several.where(F.col("count") <= chunk_rows).select("h")
    return found.join(hot, "h", "left_semi").unionByName(found.join(hot, "h", "left_anti").join(rare, "h").select("h", "key", "at"))


def repeated_bytes(documents: DataFrame, window: int = 400, gram: int = 32, chunk_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, spans (start and stop byte of what goes).

    A null text counts as empty: nothing to remove. Matches never cross rows; a text that occurs in two rows,
    under one id or two, repeats itself whole if it has ``window`` bytes. Ids may be null and repeat. Other columns are ignored.
    """
    spark = documents.sparkSession
    if gram & (gram - 1) or not 0 < gram <= window:
        raise ValueError("gram must be a power of two, and no longer than the window")
    tables = Tables(spark, "repeats")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.unhex(F.md5(text)).alias("key"))
    base = tables.write(rows.select("id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")))
    long = rows.where(F.octet_length("text") >= window).select("key", "text")
    found = tables.write(long.mapInPandas(_find_anchors(window, gram), "h long, key binary, at int").distinct())
    several = tables.write(found.groupBy("h").count().where("count > 1"))
    shared = _of_several(found, several, chunk_rows).groupBy("key").agg(F.collect_list(F.struct("h", "at")).alias("found"))
    texts = tables.write(long.groupBy("key").agg(F.first("text").alias("text")).join(shared, "key").select("key", "text", F.col("found.h").alias("hs"), F.col("found.at").alias("ats")))
    tables.drop(found)
    tables.drop(several)
    places = tables.write(texts.mapInPandas(_contexts(window, gram, False), "h long, c binary, key binary, at int"))
    around = tables.write(texts.mapInPandas(_contexts(window, gram, True), "h long, c binary, left binary, right binary").dropDuplicates(["h", "c"]))
    # Surroundings that occur twice repeat themselves whole; different ones are sorted.
    twice = places.groupBy("h", "c").count().where("count > 1").select("h", "c")
    whole = (around.select("h", "c", F.length("left").alias("lo"), F.length("right").alias("hi")).where(F.col("lo") + F.col("hi") >= window).join(twice, ["h", "c"]))
    # Anchors with too many surroundings for one task; there are at most all surroundings / chunk_rows of them.
    crowded = tables.write(around.groupBy("h").count().where(F.col("count") > chunk_rows).select("h", F.ceil(F.col("count") / chunk_rows).cast("long").alias("chunks")))
    n_crowded = crowded.count()
    if n_crowded:
        own = F.pmod(F.xxhash64("c"), F.coalesce("chunks", F.lit(1)))
        blocks = (around.join(F.broadcast(crowded) if n_crowded <= 100_000 else crowded, "h", "left")
                  .select("h", "c", "left", "right", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("chunks", F.lit(1)) - 1)).alias("other"))
                  .select("h", "c", "left", "right", F.xxhash64("h", F.least("own", "other"), F.greatest("own", "other")).alias("block")))
    else:
        blocks = around.withColumn("block", F.col("h"))
    partly = blocks.repartition("block").sortWithinPartitions("block").mapInPandas(_sorted_groups(window), "h long, c binary, lo int, hi int")
    spans = whole.unionByName(partly).groupBy("h", "c").agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"))
    gone = (places.join(spans, ["h", "c"]).groupBy("key").agg(F.collect_list(F.struct((F.col("at") - F.col("lo")).alias("start"), (F.col("at") + F.col("hi")).alias("stop"))).alias("spans"))
            .select("key", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops")))
    cut = texts.select("key", "text").join(gone, "key").mapInPandas(_cut, "key binary, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,stop:int>>")
    copies = base.groupBy("key").agg(F.count("*").alias("copies"))
    classes = copies.join(cut, "key", "left").where("copies > 1 OR n_removed IS NOT NULL")
    all_gone = (F.col("copies") > 1) & (F.col("n_bytes") >= window)
    return base.join(classes, "key", "left").select(
        F.col("id").alias(id_col), "n_bytes",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(all_gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(all_gone, F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("stop")))).otherwise(F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>"))).alias("spans"))
