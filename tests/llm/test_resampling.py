import hashlib
import math
import random
import re
import zlib
from collections import Counter

from tidepanel.llm import resampling


def plain(rows, targets, percent=5, min_words=20):
    """The rule word by word: {position: (n_features, weight, score)} and the drawn positions in order."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    s, t = Counter(), Counter()
    docs = [features(text) for _, text in rows]
    for _, f in docs:
        s.update(f)
    for text in targets:
        t.update(features(text)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in range(10000)}
    out, able = {}, []
    for i, ((doc_id, _), (n, f)) in enumerate(zip(rows, docs)):
        weight, score = sum(gain[b] for b in f), None
        if doc_id is not None:
            h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n >= min_words:
                able.append((-score, doc_id, i))
        out[i] = (len(f), weight, score)
    return out, [i for _, _, i in sorted(able)[:percent * len(able) // 100]]


WORDS = "the of Über naïve x9 42 spark Γειά 日本 data O'Neil re-use tail".split()


def texts(n, seed):
    rng = random.Random(seed)
    odd = [None, "", "   ", "!?;--", "one", "One two", "\x00a\x7fb", "word " * 30_000]
    return odd + [rng.choice([" ", "\n", ", "]).join(rng.choices(WORDS, k=rng.choice([5, 19, 20, 21, 60]))) for _ in range(n - len(odd))]


def test_against_the_rule(documents, frame):
    own, targets = texts(300, 1), [None, "", "spark data spark data the tail", "日本 data of Spark"]
    ids = [None, *range(-5, 0), *range(10, 304)]
    out = resampling.resample(documents(own, ids=ids), frame([(i, t) for i, t in enumerate(targets)], "item_id long, text string"), percent=30)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want, drawn = plain(list(zip(ids, own)), targets, 30)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == 300 and len(drawn) > 50
    for i, doc_id in enumerate(ids):
        r = got[doc_id]
        assert (r.n_features, r.weight, r.score) == want[i]
        assert r["rank"] == (drawn.index(i) + 1 if i in drawn else None)


def test_ties_and_repeated_rows(documents, frame):
    """Rows equal in score: smaller ids first; rows equal in everything: as many as are left to draw."""
    same = "the of spark data tail " * 5
    target = frame([(1, "spark")], "item_id long, text string")
    rows = resampling.resample(documents([same] * 200, ids=[7] * 100 + [8] * 100), target, percent=10).collect()
    drawn = [r for r in rows if r["rank"] is not None]
    best = max(rows, key=lambda r: (r.score, -r.doc_id)).doc_id
    assert len(rows) == 200 and sorted(r["rank"] for r in drawn) == list(range(1, 21)) and {r.doc_id for r in drawn} == {best}


def test_cutoff_among_ties(frame):
    rng = random.Random(4)
    rows = [(rng.randrange(-10**12, 10**12), rng.randrange(-3, 3)) for _ in range(400)]
    table = frame(rows, "id long, score long")
    for draw in (1, 57, 200, 400):
        score, last = resampling.cutoff(table, draw)
        assert sorted((-s, i) for i, s in rows)[draw - 1] == (-score, last)


def test_few_rows(documents, frame):
    target = frame([(1, "spark")], "item_id long, text string")
    none = frame([], "item_id long, text string")
    assert resampling.resample(documents([]), target).count() == 0
    assert [r["rank"] for r in resampling.resample(documents(["a b c"] * 5), target).collect()] == [None] * 5
    assert [r.weight for r in resampling.resample(documents([None, ""]), none).collect()] == [0, 0]
