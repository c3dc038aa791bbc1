import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidepanel.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\n \t", "a", "I'll we're IT'S", "<|endoftext|> a<|startoftext|>b", "x" * 9000, "ΑΣ Σ İstanbul ǅ ﬁ é ́x 각", "tab\tand nbsp line\x1cend", "12345 6,7 ?!... --", "日本語のテキスト"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(rows, texts, ids, library, capacity):
    """Every rule of the contract; the number of sequences."""
    want = []
    for i, t in zip(ids, texts):
        tokens = library.encode(t or "", add_special_tokens=False).ids + [0]
        want += [(i, p, s, len(x := tokens[s:s + capacity]), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for p, s in enumerate(range(0, len(tokens), capacity))]
    key = lambda r: (r[0] is not None, *[x or 0 for x in r])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for spans in held.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held), -(-sum(r.length for r in rows) // capacity)


def test_pack(documents, library):
    rng = random.Random(2)
    words = "Spark data the of and Ünïcode 42 tail's window, merge. scan".split()
    texts = ODD + [" ".join(rng.choices(words, k=int(rng.lognormvariate(5, 1.2)))) for _ in range(300)] + ["the same text " * 40] * 60
    ids = [None, *range(2, len(texts)), 5]
    out = packing.pack(documents(texts, ids=ids), PATH)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    found, least = check(out.collect(), texts, ids, library, 2048)
    assert found == least
    whole = packing.sequences(out).collect()
    assert len(whole) == found and sum(r.n_tokens for r in whole) == sum(len(r.ids) for r in whole) and max(r.n_tokens for r in whole) <= 2048
    assert packing.pack(documents([]), PATH).count() == 0


def test_levels(documents, library, monkeypatch):
    """Many small shards: what they leave open is packed again, level by level."""
    monkeypatch.setattr(packing, "SHARD", 30)
    monkeypatch.setattr(packing, "FAN_IN", 3)
    monkeypatch.setattr(packing, "REMEMBERED", 2000)
    rng = random.Random(3)
    texts = [" ".join(str(rng.randrange(10)) for _ in range(rng.choice([1, 3, 9, 20, 30, 34, 40, 70]))) for _ in range(400)]
    rows = packing.pack(documents(texts), PATH, capacity=64, with_ids=False).collect()
    found, _ = check(rows, texts, range(400), library, 64)
    one_heap = max(packing.best_fit(sorted((r.length for r in rows), reverse=True), [], 64)) + 1
    assert found <= 1.02 * one_heap


def test_evolution_beats_best_fit():
    """Triplets that fill a bin exactly: best fit alone leaves gaps, breeding closes some and never makes more bins."""
    rng = np.random.default_rng(5)
    won = 0
    for case in range(4):
        a = rng.integers(600, 800, 40)
        b = rng.integers(550, 700, 40)
        lengths = np.sort(np.concatenate([a, b, 2048 - a - b]))
        plain = max(packing.best_fit(sorted(lengths.tolist(), reverse=True), [], 2048)) + 1
        best = packing.evolve(lengths, [], np.random.default_rng(case), 2048)
        again = packing.evolve(lengths, best, np.random.default_rng(case), 2048)
        n, m = int(best[0].max()) + 1, int(again[0].max()) + 1
        assert np.bincount(again[0], weights=lengths).max() <= 2048 and packing.bound(lengths, 2048) <= m <= n <= plain
        won += m < plain
    assert won


def test_best_fit_takes_the_fullest():
    fills = [5, 9, 7]
    assert packing.best_fit([1, 3, 4, 10, 1], fills, 10) == [1, 2, 0, 3, 0] and fills == [10, 10, 10, 10]
    assert packing.best_fit([], [], 10) == []


def test_units_equal_whole_texts():
    coder = packing.UnitCoder(open(PATH, encoding="utf-8").read())
    rng = random.Random(9)
    signs = [*" \n'sStTvVeErRÍͅΣςǅİ½²ªº·\x1c\x85\xa0’—€\t ", "<|endoftext|>", "<|", "'ll", "12", "Straße", "ΟΔΟΣ", "é", "日本", "각", "👍🏽", "ﬁ"]
    for _ in range(4000):
        text = "".join(rng.choice(signs) if rng.random() < 0.8 else chr(rng.choice([rng.randrange(1, 0x530), rng.randrange(0x530, 0xD800), rng.randrange(0xE000, 0x11000)])) for _ in range(rng.randrange(40)))
        assert np.frombuffer(coder.encode(text), dtype="<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_each_settled_character():
    """Every settled character alone, beside letters, marks and digits."""
    coder = packing.UnitCoder(open(PATH, encoding="utf-8").read())
    for a, b in packing.SETTLED_RANGES:
        for c in map(chr, range(a, b + 1)):
            text = f"{c} a{c}b {c}{c} 1{c}2 ,{c}. {c}"
            assert np.frombuffer(coder.encode(text), dtype="<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, hex(ord(c))
