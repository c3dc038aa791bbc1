import math

import numpy as np

from tidepanel.llm import metric_join


def brute(rows, cosine):
    ok = {}
    for k, (i, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[k] = np.array(v, dtype="f4").astype("f8")
    link = {k: {m for m in ok if m != k and len(ok[m]) == len(ok[k]) and ok[k] @ ok[m] >= cosine * np.linalg.norm(ok[k]) * np.linalg.norm(ok[m])} if k in ok else set() for k in range(len(rows))}
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            new = link[todo.pop()] - seen
            seen |= new
            todo += new
        out.append((i, len(link[k]), min((rows[m][0] for m in seen if rows[m][0] is not None), default=None)))
    return sorted(out, key=str)


def vectors():
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for size in (1, 1, 1, 2, 5, 30):
        base = rng.normal(size=16)
        for _ in range(size):
            rows.append((n, (base + rng.normal(size=16) * 0.12).tolist()))
            n += 1
    same = rng.normal(size=16).tolist()
    rows += [(n + i, same) for i in range(12)]
    rows += [(500, [2 * x for x in same]), (500, same), (None, same), (600, None), (601, []), (602, [0.0] * 16), (603, [math.nan] + same[1:]), (604, [None] + same[1:]),
             (605, [math.inf] + same[1:]), (606, same[:8]), (607, same[:8]), (608, [-0.0 if not x else x for x in same])]
    return rows


def test_against_brute_force(frame):
    rows = vectors()
    df = frame([(i, v, "l", "k") for i, v in rows], "vec_id long, embedding array<float>, label string, key string")
    for kw in ({}, {"chunk_rows": 7, "n_pivots": 5}, {"n_pivots": 1}):
        got = metric_join.near_duplicates(df, cosine=0.9, **kw).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows, 0.9)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_empty(frame):
    assert metric_join.near_duplicates(frame([], "vec_id long, embedding array<float>")).count() == 0


def test_copies_are_handed_on_in_bounded_frames(monkeypatch):
    """A batch has a copy per chunk of each cell; they come in frames of bounded rows, each vector once for every task."""
    import pandas as pd

    rng = np.random.default_rng(4)
    full = rng.normal(size=(60, 8))
    part = pd.DataFrame({"key": [rng.bytes(16) for _ in full], "vec": [v.tobytes() for v in full], "n": 1, "home": 0, "angle": 0.1})
    chunks = np.array([9, 4, 1])
    monkeypatch.setattr(metric_join, "COPIES_AT_ONCE", 40)
    frames = list(metric_join._copies(full[:3] / np.linalg.norm(full[:3], axis=1)[:, None], "f8", 9.0, np.full(3, -9.0), np.full(3, 9.0), chunks)(iter([part])))
    assert max(map(len, frames)) <= 40
    got = pd.concat(frames)
    assert len(got) == len(got.drop_duplicates(["key", "cell", "a", "b"]))
    for (_, cell), g in got.groupby(["key", "cell"]):
        own = g["mine"].iloc[0]
        assert sorted(zip(g["a"], g["b"])) == sorted((min(own, o), max(own, o)) for o in range(chunks[cell])) and (g["at_home"] == (cell == 0)).all()


def test_cells_that_prune_nothing_are_one(frame):
    """Vectors without structure: the bounds send nearly all to all cells, so one cell of chunks has fewer copies; the links are the same."""
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(90, 24)))]
    rows += [(90 + i, (np.array(rows[i][1]) + rng.normal(size=24) * 0.1).tolist()) for i in range(30)]
    df = frame(rows, "vec_id long, embedding array<float>")
    seen, plain = [], metric_join._copies

    def watched(pivots, *rest):
        seen.append((len(pivots), rest[-1].tolist()))
        return plain(pivots, *rest)
    metric_join._copies = watched
    try:
        got = metric_join.near_duplicates(df, cosine=0.9, chunk_rows=20, n_pivots=6).collect()
    finally:
        metric_join._copies = plain
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows, 0.9)
    assert seen[0][0] == 6 and seen[1] == (1, [6])
