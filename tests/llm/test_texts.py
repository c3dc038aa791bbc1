import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from tidepanel.llm import divergence, piece_count, prefix_bpe

ODD = ["", " ", "\n", "a", "The the  the\tTHE\r\nthe.", "  lead and trail  ", "日本語 のテキスト", "😀😀 emoji nbsp　wide\x1cfs", "▁▁ <s> <unk> <0x0A> x", "it's they'll 123 ##&&", "\x00\x01", "é" * 300, "ab" * 9000, "word " * 3000, None, None]


def fuzz(n=300):
    rng = random.Random(5)
    bits = ["a", "e", "the", " ", "  ", "\n", "\t", "\r", "▁", "é", "漢", "😀", "\xa0", "'s", "12", ";\r", "#&", "ß", "ing", "tion", "​"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_piece_counts(documents):
    texts = ODD + fuzz()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ids = [None if i == 3 else 1 if i in (5, 6) else i for i in range(len(texts))]
    got = piece_count.token_counts(documents(texts, ids=ids), public_tokenizers.path("piece_bpe_32k.model"), limit=50).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 50) for i, t in zip(ids, texts)]
    assert Counter(map(tuple, got)) == Counter(want)


def test_bpe_round_trip(documents):
    texts = ODD + fuzz()
    ranks = prefix_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = prefix_bpe.round_trip(documents(texts), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_text=True).collect()
    for r in got:
        text = texts[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert r.ids == ids and r.n_tokens == len(ids) and bytes(r.decoded) == text.encode()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert len(got) == len(texts)


def test_appends_and_edits():
    ranks = prefix_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coder, rng = prefix_bpe.PrefixEncoder(prefix_bpe.encoder_state(ranks)), random.Random(7)
    for _ in range(300):
        data = "".join(rng.choice(["the", "a", "b", "é", "ing", "x", "zz", "tion"]) for _ in range(rng.randrange(1, 50))).encode()
        table = coder.extend(data[:len(data) // 2], [0])
        assert coder.extend(data, list(table)) == coder.extend(data, [0])
        table = coder.extend(data, [0])
        assert [data[a:b] for a, b in zip([0, *coder.spans(table)], coder.spans(table))] == coder.merged(data)
        start = rng.randrange(len(data) + 1)
        stop, new = rng.randrange(start, min(len(data), start + 4) + 1), rng.choice([b"", b"q", b"the"])
        changed, after = coder.edit(data, table, start, stop, new)
        assert after == coder.extend(changed, [0])


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    threes = Counter(zip(words, words[1:], words[2:]))
    hit = {i + d for i in range(len(words) - 2) if threes[tuple(words[i:i + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_quality(documents):
    rng = random.Random(4)
    words = ["".join(rng.choice("bcdfghlmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    clean = ["Here is the story of the town. " + " ".join(rng.choice(["the", "of", "and", "to", "in"]) if rng.random() < 0.4 else rng.choice(words) for _ in range(120)) for _ in range(29)]
    junk = [" ".join(f"x{i}&&& q{i * 7}%%%" for i in range(60)), "one two three " * 40]
    texts = clean + junk + ODD + ["same line here\nsame line here\n\n \nsame line here", "a b c a b c", "x y x y x y"]
    langs = ["en"] * len(clean) + ["en", None] + [None if i % 2 else "xx" for i in range(len(texts) - len(clean) - 2)]
    got = {r.doc_id: r for r in divergence.quality(documents(texts, langs=langs)).collect()}
    for i, t in enumerate(texts):
        r, want = got[i], base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)
    assert all(got[i].kept for i in range(len(clean)) if not got[i].base_failed) and any(r.kept for r in got.values())
    assert not got[len(clean)].kept and not got[len(clean)].base_failed and got[len(clean)].class_distance > 0.3


def test_js_distance():
    import numpy as np
    p, q = np.array([1.0, 0, 3]), np.array([0, 2.0, 2])
    a, b = p / 4, q / 4
    m = (a + b) / 2
    want = (sum(x * np.log2(x / y) for x, y in zip(a, m) if x) + sum(x * np.log2(x / y) for x, y in zip(b, m) if x)) / 2
    assert divergence.js_distance(p, q) == pytest.approx(want ** 0.5)
    assert divergence.js_distance(p, 5 * p) == pytest.approx(0, abs=1e-7) and divergence.js_distance(np.array([1.0, 0]), np.array([0, 1.0])) == pytest.approx(1)


def test_empty_tables(documents):
    none = documents([])
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert piece_count.token_counts(none, path).count() == 0 and divergence.quality(none).count() == 0
    assert prefix_bpe.round_trip(none, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0
