import hashlib
import os
import random
from collections import Counter

import numpy as np

from tidepanel.llm import jaccard_join, suffix_dedup
from tidepanel.llm.common import Tables, components


def shingled(text, size=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def classes(ids, texts, pct=80):
    sets = [shingled(t) for t in texts]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= pct * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    out = {}
    for i in range(len(ids)):
        out.setdefault(find(i), []).append(ids[i])
    return [(ids[i], len(sets[i]), min(out[find(i)])) for i in range(len(ids))]


def corpus(rng, copies=40):
    words = [f"w{i}" for i in range(400)]
    plain = lambda n: [rng.choice(words) for _ in range(n)]
    texts = [" ".join(plain(rng.randrange(1, 120))) for _ in range(60)]
    shared = plain(60)
    for n, changes in ((200, 2), (60, 1), (25, 1)):
        first = plain(n)
        for _ in range(copies):
            w = list(first)
            for _ in range(rng.randrange(changes + 4)):
                w[rng.randrange(n)] = rng.choice(words)
            texts.append(" ".join(w))
    texts += [" ".join(plain(20) + shared + plain(rng.randrange(40))) for _ in range(15)]
    texts += [texts[3]] * 5 + [texts[4].upper(), texts[4].replace(" ", "\n\t")]
    return texts + ["", None, " \n", "one", "ONE", "one two", "a b c d e", "a b c d", " ".join(plain(9000))]


def test_jaccard_against_brute_force(documents):
    texts = corpus(random.Random(11))
    ids = random.Random(2).sample(range(10_000), len(texts))
    for kw in ({}, {"chunk_rows": 6, "seeds": 2, "leads": 1}, {"leads": 0, "common_in_sample": 3, "chunk_items": 500, "broadcast_rows": 0}):
        got = jaccard_join.similar_documents(documents(texts, ids=ids), **kw).collect()
        assert sorted(map(tuple, got)) == sorted(classes(ids, texts))


def test_jaccard_other_bounds(documents):
    texts = corpus(random.Random(12), copies=8)
    ids = list(range(len(texts)))
    for pct in (50, 95, 100):
        got = jaccard_join.similar_documents(documents(texts, ids=ids), pct=pct).collect()
        assert sorted(map(tuple, got)) == sorted(classes(ids, texts, pct))


def test_jaccard_null_and_repeated_ids(documents):
    text = " ".join(f"w{i}" for i in range(30))
    got = jaccard_join.similar_documents(documents([text, text, text, "other words", None], ids=[None, 4, 4, 4, None])).collect()
    assert Counter(map(tuple, got)) == Counter([(None, 26, None), (4, 26, 4), (4, 26, 4), (4, 1, 4), (None, 0, None)])
    assert jaccard_join.similar_documents(documents([])).count() == 0


def test_whole_sets_are_kept_for_members_of_pairs_only(documents, monkeypatch):
    """Texts that share a shingle but can't be similar have points and no written sets."""
    held, write = [], Tables.write

    def spied(self, df):
        out = write(self, df)
        held.extend([out.count()] if "items" in out.columns else [])
        return out
    monkeypatch.setattr(Tables, "write", spied)
    apart = [" ".join(["all", "of", "them", "say", "this", *[f"u{i}x{j}" for j in range(5)]]) for i in range(60)]
    twins = ["a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o p q"]
    got = jaccard_join.similar_documents(documents(apart + twins), common_in_sample=10_000).collect()
    assert {tuple(r) for r in got} == {(i, 6, i) for i in range(60)} | {(60, 12, 60), (61, 13, 60)}
    assert sum(held) <= 4


def test_shingles_of_many_texts_at_once(monkeypatch):
    monkeypatch.setattr(jaccard_join, "TEXT_BYTES", 100)
    long = "z" * 300
    texts = [None, "", " \t\n", "one", "a B c d", "A b C D", "a b c d e", "a\x0bb\x0cc\rd\x1ce f", "É é É é É é", f"{long} {long.upper()} {long}y x y w {long}",
             "x " * 50, "x x x x x x", " ".join(f"w{i % 40}" for i in range(200)), "q" * 64 + " r s t " + "q" * 65 + " r s t"]
    for size in (1, 3, 5):
        names = {}
        got = list(jaccard_join.shingle_sets(texts, size))
        for text, hashes in zip(texts, got, strict=True):
            want = shingled(text, size)
            assert len(hashes) == len(want) and (hashes[1:] > hashes[:-1]).all()
            assert names.setdefault(want, hashes.tobytes()) == hashes.tobytes()
        for a, x in zip(texts, got):
            for b, y in zip(texts, got):
                assert len(np.intersect1d(x, y)) == len(shingled(a, size) & shingled(b, size))


def test_count_tree_finds_all():
    rng = np.random.default_rng(1)
    sizes = rng.integers(5, 300, 500)
    sets = [np.unique(rng.integers(0, 1 << 62, n).astype("u8")) for n in sizes]
    for i in range(0, 480, 3):
        sets[i + 1] = np.unique(np.concatenate([sets[i][rng.random(len(sets[i])) < 0.95], sets[i + 1][:3]]))
    points, n = np.stack([jaccard_join.folded(jaccard_join.counts(s)) for s in sets]), np.array([len(s) for s in sets])
    tree = jaccard_join.CountTree(points, n)
    for i in range(len(sets)):
        near = set(tree.partners(points[i], n[i], 80).tolist())
        assert {j for j in range(len(sets)) if jaccard_join.similar(sets[i], sets[j], 80)} <= near
        assert near <= {j for j in range(len(sets)) if 180 * np.minimum(points[i], points[j]).sum() >= 80 * (n[i] + n[j])}


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, 100), (100, 150), (7, 7), (300, 301), (301, 300)] + [(1000, 1000 + i) for i in range(1, 50)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, components(df, Tables(spark, "test")).collect()))
    want = {i: 0 for i in range(61)} | {200: 100, 100: 100, 150: 100, 300: 300, 301: 300} | {1000 + i: 1000 for i in range(50)}
    assert got == want


def repeated(texts, window):
    seen, datas, out = Counter(), [(t or "").encode() for t in texts], []
    for d in datas:
        seen.update(d[p:p + window] for p in range(len(d) - window + 1))
    for d in datas:
        gone = np.zeros(len(d), dtype=bool)
        for p in range(len(d) - window + 1):
            if seen[d[p:p + window]] > 1:
                gone[p:p + window] = True
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(d) else 0
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out


def test_repeats_against_brute_force(documents):
    rng = random.Random(4)
    letters = lambda n, a="abcdefé ": "".join(rng.choice(a) for _ in range(n))
    passages = [letters(n) for n in (39, 40, 41, 90, 200)]
    texts = []
    for _ in range(60):
        t = letters(rng.randrange(150))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a, b = sorted(rng.sample(range(len(p) + 1), 2))
            t += p[a:b] if rng.random() < 0.5 else p
            t += letters(rng.randrange(60))
        texts.append(t)
    texts += [texts[0]] * 3 + ["short"] * 2 + ["", None, "a" * 500, "ab" * 100, "abc" * 90 + "x" + "abc" * 90, passages[4] * 2, letters(4000, "ab")]
    for kw in ({}, {"chunk_rows": 3}):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_bytes(documents(texts), window=40, gram=8, **kw).collect()}
        assert [got[i] for i in range(len(texts))] == repeated(texts, 40)
    spans = {r.doc_id: r for r in suffix_dedup.repeated_bytes(documents(texts), window=40, gram=8).collect()}
    assert all(sum(s.stop - s.start for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans for r in spans.values())


def test_repeats_whatever_the_digest_ends_with(documents):
    """A text is known by its md5; one that ends in zero bytes is found like any other."""
    shared = " ".join(f"word{i}" for i in range(12))
    found = []
    for i in range(5000):
        text = f"{i} {shared} {i * 7919}"
        if hashlib.md5(text.encode()).digest()[-1] == 0 or i < 3:
            found.append(text)
    assert len(found) > 10
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_bytes(documents(found), window=40, gram=8).collect()}
    assert [got[i] for i in range(len(found))] == repeated(found, 40)


def test_repeats_null_and_repeated_ids(documents):
    text = "x" + "0123456789" * 5
    got = suffix_dedup.repeated_bytes(documents([text, text, None], ids=[None, 3, 3]), window=40, gram=8).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed) for r in got) == Counter([(None, 51, 51), (3, 51, 51), (3, 0, 0)])
    assert suffix_dedup.repeated_bytes(documents([])).count() == 0


def test_deep_shallow_order():
    rng = random.Random(9)
    for _ in range(40):
        bits = [os.urandom(rng.randrange(30)) for _ in range(4)] + [b"", b"a", b"aaaaaaaa", b"\x00"]
        strings = [b"".join(rng.choice(bits) for _ in range(rng.randrange(8))) for _ in range(rng.randrange(1, 60))]
        assert [strings[i] for i in suffix_dedup.deep_shallow(strings)] == sorted(strings)


def test_rows_that_share_an_id(spark, documents):
    """A text whose id another text has too stays: sets are the nodes, ids only names."""
    import corpus_pipeline

    a, b = " ".join(f"alpha{i}" for i in range(60)), " ".join(f"beta{i}" for i in range(60))
    near, nearer = a + " end", a + " the end"
    texts = [a, near, b, nearer, b, "", None, "", a]
    ids = [1, 2, 2, 7, 2, 3, 3, 3, None]
    docs = documents(texts, ids=ids)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id, r.component_key is None) for r in jaccard_join.similar_documents(docs, with_keys=True).collect())
    assert got == sorted([(1, 56, 1, False), (2, 57, 1, False), (2, 56, 2, False), (7, 58, 1, False), (2, 56, 2, False), (3, 0, 3, True), (3, 0, 3, True), (3, 0, 3, True), (-1, 56, None, True)], key=lambda r: (r[0], r[1], r[2] or 0))
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, "-" if r.text is None else r.text) for r in kept.collect()) == sorted([(1, a), (2, b), (3, ""), (3, "-"), (0, a)])
    # Two similar texts of one id are one component: one of them stays.
    kept = corpus_pipeline.near_duplicates(spark, documents([a, near, b], ids=[5, 5, 5]), "").collect()
    assert len(kept) == 2 and b in {r.text for r in kept}
