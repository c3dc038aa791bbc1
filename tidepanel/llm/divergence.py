"""Quality rules: base counts of a text, and its divergence from a reference of its language.

The reference of a language is what all its documents together hold: a histogram of character
classes and one of its commonest words (the rest of the words being one more bin). A document is
compared with both by Jensen-Shannon distance (base 2, so 0 to 1). A distance only counts for
documents long enough for their own histogram to mean something: the guards ``min_chars`` and ``min_words``.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import Tables

CLASSES = ["lower", "upper", "other letter", "digit", "space", "line end", "sentence mark", "markup", "other"]
MARKUP = "#*$%&|<>"
#: The class of each byte of UTF-8, over which the histograms count: all bytes over 127 are parts of other letters or signs.
_CLASS_OF = np.full(256, 8, dtype="u1")
_CLASS_OF[128:] = 2
for _k, _s in ((0, "abcdefghijklmnopqrstuvwxyz"), (1, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (3, "0123456789"), (4, " \t\v\f\r"), (5, "\n"), (6, ".,;:!?'\"()-"), (7, MARKUP)):
    _CLASS_OF[[ord(c) for c in _s]] = _k
_TRIM = ".,;:!?'\"()-"


def base_counts(text: str) -> tuple[list[bytes], dict[str, int]]:
    """Words and the base counts of one text."""
    raw = text.encode()
    words = raw.split()  # bytes split on exactly \\x20 and \\x09-\\x0D
    n = len(words)
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), dtype="i8", count=n)
    repeated = 0
    if n >= 4:
        m = len(ids)
        pair = np.unique(w[:-1] * m + w[1:], return_inverse=True)[1]
        _, at, times = np.unique(pair[:-1] * m + w[2:], return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[at] > 1)
        hit = np.zeros(n, dtype=bool)
        for d in range(3):
            hit[starts + d] = True
        repeated = int(hit.sum())
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)] if b"\n" in raw else []
    marks = sum(map(raw.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    space = sum(map(raw.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    return words, {"n_words": n, "word_chars": len(text) - space, "n_symbols": marks, "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeated}


def class_counts(text: str) -> np.ndarray:
    return np.bincount(_CLASS_OF[np.frombuffer(text.encode(), dtype="u1")], minlength=len(CLASSES)).astype("i8")


def plain_words(words: list[bytes]) -> list[str]:
    return [x for x in (w.decode().strip(_TRIM).lower() for w in words) if x]


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence of two count vectors, base 2; 0 if one is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    half = lambda x: float((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum()) / 2
    return max(0.0, half(p) + half(q)) ** 0.5


def _totals(parts):
    """Of each batch and language: how often every word and every character class occurs."""
    for part in parts:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}
        for lang, text in zip(part["lang"], part["text"]):
            if text:
                lang = "" if lang is None else lang
                words.setdefault(lang, Counter()).update(text.encode().split())
                classes[lang] = classes.get(lang, 0) + class_counts(text)
        out = []
        for lang, raw in words.items():
            plain: Counter = Counter()
            for w, n in raw.items():
                if w := w.decode().strip(_TRIM).lower():
                    plain[w] += n
            out.append(pd.DataFrame({"lang": lang, "kind": 0, "item": list(plain), "n": list(plain.values())}))
            out.append(pd.DataFrame({"lang": lang, "kind": 1, "item": CLASSES, "n": classes[lang]}))
        if out:
            yield pd.concat(out)


def references(documents: DataFrame, common_words: int, max_langs: int, lang_col: str, text_col: str) -> dict:
    """Per language: class counts, its commonest words, their counts and the count of the rest.

    Read whole from all documents; what reaches the driver is ``common_words`` rows for each language,
    of at most ``max_langs`` languages (an error says so beyond that, as then the column is no language).
    """
    tables = Tables(documents.sparkSession, "divergence")
    rows = documents.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sums = tables.write(rows.mapInPandas(_totals, "lang string, kind int, item string, n long").groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")))
    whole = sums.groupBy("lang", "kind").agg(F.sum("n").alias("total")).limit(2 * max_langs + 1).collect()
    if len(whole) > 2 * max_langs:
        raise ValueError(f"more than {max_langs} languages")
    out = {r["lang"]: {"classes": np.zeros(len(CLASSES)), "words": {}, "counts": [], "total": 0} for r in whole}
    for r in whole:
        if r["kind"] == 0:
            out[r["lang"]]["total"] = r["total"]
    for lang, ref in out.items():
        own = sums.where((F.col("lang") == lang))
        for r in own.where("kind = 1").collect():
            ref["classes"][CLASSES.index(r["item"])] = r["n"]
        for r in own.where("kind = 0").orderBy(F.desc("n"), "item").limit(common_words).collect():
            ref["words"][r["item"]] = len(ref["words"])
            ref["counts"].append(r["n"])
    for ref in out.values():
        ref["counts"] = np.array([*ref["counts"], ref["total"] - sum(ref["counts"])], dtype="f8")
    tables.drop(sums)
    return out


def quality(documents: DataFrame, common_words: int = 40, max_langs: int = 500, max_class_distance: float = 0.3,
            max_word_distance: float = 0.45, min_chars: int = 200, min_words: int = 50, min_repeat_pct: int = 50,
            id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, class_distance, word_distance.

    base_failed: n_words < ``min_words``, or 100 * n_repeat_words > ``min_repeat_pct`` * n_words. Other documents are
    kept unless a distance from their language's reference is over its limit: that of character classes with at
    least ``min_chars`` characters, that of common words with at least ``min_words`` words. A null text counts as
    empty (all counts 0, base_failed); rows with a null language share one reference. Repeated rows and ties
    are judged alike; texts are read whole; other columns are ignored.
    """
    session = documents.sparkSession
    refs = session.sparkContext.broadcast(references(documents, common_words, max_langs, lang_col, text_col))  # max_langs x common_words at most

    def run(parts):
        known = refs.value
        for part in parts:
            out = []
            for lang, text in zip(part["lang"], part["text"]):
                words, row = base_counts(text or "")
                n, far = row["n_words"], [0.0, 0.0]
                if n:
                    ref = known["" if lang is None else lang]
                    if len(text) >= min_chars:
                        far[0] = js_distance(class_counts(text).astype("f8"), ref["classes"])
                    if n >= min_words:
                        at, own = ref["words"], np.zeros(len(ref["counts"]))
                        plain = plain_words(words)
                        for w in plain:
                            k = at.get(w)
                            if k is not None:
                                own[k] += 1
                        own[-1] = len(plain) - own.sum()
                        far[1] = js_distance(own, ref["counts"])
                out.append((*row.values(), *far))
            yield pd.DataFrame(out, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance"]).assign(id=part["id"].astype("Int64"))

    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    out = rows.mapInPandas(run, "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > min_repeat_pct * F.col("n_words"))
    near = (F.col("class_distance") <= max_class_distance) & (F.col("word_distance") <= max_word_distance)
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (~failed & near).alias("kept"), "class_distance", "word_distance")
