"""PII surrogates, in DataFrame functions alone.

One pattern finds e-mail addresses, phone numbers, IPv4 addresses, payment cards, access keys, passwords and
tokens, and names after a title. Each is replaced by another of its kind and shape: digits by digits,
letters by letters of the same case and script (in names vowels by vowels, consonants by consonants, and
the last letter stays, which with the title keeps the gender), cards with a valid check digit, octets
within range. What comes out depends on a secret key and on the entity in its normal form, so one entity has one
surrogate wherever and however it is written.

All distinct entities of the corpus are mapped in one table. A surrogate that two entities share, or that
is itself an entity of the corpus, is drawn again with the next attempt until all differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import Tables

#: Titles that come before a name.
TITLES = "Mr|Mrs|Ms|Miss|Mister|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Doña|Don"
NAME = r"(?:\p{Lu}['’])?+\p{Lu}\p{Ll}++(?:-?\p{Lu}\p{Ll}++)*+"
#: What ends a secret: white space, controls and a double quote; and what isn't its last character, as it belongs to the sentence around.
BORDER, AROUND = r"\x00-\x20\x7f\p{Z}\"", r".,;:?'`>)\]}"
#: Kinds in order of precedence, with the pattern of each. Runs have no upper bounds and give nothing back.
KINDS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}+",
    "ip": r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\d]|\.\d)",
    "card": r"(?<![\w-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ -]?)?(?:\(\d{2,4}\)[ -]?|\d{2,4}[ -])\d{3,4}[ -]\d{3,4}(?!\w)",
    "key": r"(?<!\w)(?:AKIA[A-Z0-9]{12,}+\w*+|gh[pousr]_[A-Za-z0-9]{20,}+\w*+|sk-[A-Za-z0-9_-]{16,}+|xox[abp]-[A-Za-z0-9-]{10,}+[\w-]*+)",
    "secret": r"(?<=[=\"])(?i:(?<=password=)|(?<=passwd=)|(?<=secret=)|(?<=token=)|(?<=token = \")|(?<=api_key=)|(?<=api_key = \"))"
              rf"(?:(?<= \")[^\"\x00-\x1f]{{6,}}+(?=\")|(?=[^{BORDER}]{{6}})(?:[{AROUND}]*+[^{AROUND}{BORDER}]++)++)",
    # A further name follows the last match, which was a name after a space.
    "name": rf"(?=\p{{Lu}})(?:(?<=\b(?:{TITLES})\.? ){NAME}|(?<=\G )(?<=\p{{Ll}} )(?<= \p{{Lu}}[\p{{L}}'’-]{{1,9999}} )(?!(?:{TITLES})\b){NAME})",
}
#: What any entity has, much cheaper to look for.
SIGNS = rf"[0-9@=]|AKIA|gh[pousr]_|sk-|xox[abp]-|\b(?:{TITLES})\b"
MARK, ESCAPE = "\x01", "\x02"
#: A secret is looked for first, as parts of one can look like other kinds.
ANY = "|".join(f"(?:{KINDS[k]})" for k in sorted(KINDS, key=lambda k: k != "secret")).replace(r"([ -]?)\d{4}\1\d{4}\1", r"(?<gap>[ -]?)\d{4}\k<gap>\d{4}\k<gap>")
#: Letters that stand in for each other within a name, by script.
SOUNDS = ["aeiou", "bcdfghjklmnprstvz", "аеиоуыэюя", "бвгджзклмнпрстфхцчш", "αεηιουω", "βγδζθκλμνπρστφχψ"]


def _parts(text: Column) -> Column:
    """Text between entities at even places, entities at odd ones."""
    plain = F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "b")), F.lit(MARK), F.lit(ESCAPE + "a"))
    return F.split(F.regexp_replace(plain, ANY, f"{MARK}$0{MARK}"), MARK, -1)


def _kind(e: Column) -> Column:
    out = F.lit("name")
    for kind in reversed([k for k in KINDS if k not in ("secret", "name")]):
        out = F.when(F.regexp_like(e, F.lit(f"^(?:{KINDS[kind]})$")), kind).otherwise(out)
    return F.when((out == "name") & ~F.regexp_like(e, F.lit(rf"^{NAME}$")), "secret").otherwise(out)


def _normal(kind: Column, e: Column) -> Column:
    digits = F.regexp_replace(e, r"\D", "")
    return F.when(kind == "card", digits).when(kind == "phone", F.when(F.length(digits) > 10, F.right(digits, F.lit(10))).otherwise(digits)).when(kind.isin("email", "name"), F.lower(e)).otherwise(e)


def _digest(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("\x00", F.lit(key), kind, normal, attempt.cast("string")), 256)


def _pick(letters: str, digest: Column, at: Column) -> Column:
    return F.substring(F.lit(letters), F.pmod(F.xxhash64(digest, at), F.lit(len(letters))).cast("int") + 1, F.lit(1))


def _swap(chars: Column, digest: Column, keep) -> Column:
    """Each character by one of its class; keep(character, place) tells which stay."""
    def one(c: Column, i: Column) -> Column:
        new = (F.when(c.rlike("[0-9]"), _pick("0123456789", digest, i)).when(c.rlike("[a-z]"), _pick("abcdefghijklmnopqrstuvwxyz", digest, i))
               .when(c.rlike("[A-Z]"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", digest, i)).otherwise(c))
        return F.when(keep(c, i), c).otherwise(new)
    return F.array_join(F.transform(chars, one), "")


def _chars(e: Column) -> Column:
    return F.split(e, "", -1)


def _by_digit(e: Column, digest: Column, swap) -> Column:
    """Digits replaced by their place from the right, so that spacing and prefixes don't matter."""
    chars = _chars(e)
    isdigit = F.transform(chars, lambda c: c.rlike("[0-9]").cast("int"))
    total = F.aggregate(isdigit, F.lit(0), lambda a, x: a + x)
    # (how many digits so far, text so far) along the characters
    return F.aggregate(chars, F.struct(F.lit(0).alias("n"), F.lit("").alias("s")),
                       lambda a, c: F.struct((a["n"] + c.rlike("[0-9]").cast("int")).alias("n"), F.concat(a["s"], F.when(c.rlike("[0-9]"), swap(c, total - a["n"] - 1, digest)).otherwise(c)).alias("s")),
                       lambda a: a["s"])


def _luhn(number: Column) -> Column:
    """The digits with the last one set so that the check sum holds."""
    digits = F.reverse(F.filter(_chars(number), lambda c: c.rlike("[0-9]")))
    value = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int")))
    rest = F.aggregate(F.transform(digits, lambda c, i: F.when(i == 0, 0).otherwise(value(c, i))), F.lit(0), lambda a, x: a + x)
    return F.regexp_replace(number, r"\d(?=\D*$)", F.pmod(-rest, F.lit(10)).cast("string"))


def _render(kind: Column, e: Column, digest: Column) -> Column:
    """The surrogate in the shape of one way of writing the entity."""
    chars, size = _chars(e), F.length(e)
    at = F.instr(e, "@")
    email = _swap(chars, digest, lambda c, i: i >= F.when(at > 0, size - F.length(F.substring_index(e, ".", -1)) - 1).otherwise(size))
    octets = F.array_join(F.transform(F.split(e, r"\."), lambda o, i: F.when(F.length(o) == 1, F.pmod(F.xxhash64(digest, i), F.lit(9)) + 1).when(F.length(o) == 2, F.pmod(F.xxhash64(digest, i), F.lit(90)) + 10).otherwise(F.pmod(F.xxhash64(digest, i), F.lit(155)) + 100).cast("string")), ".")
    card = _luhn(_by_digit(e, digest, lambda c, i, d: F.when(i >= 12, c).otherwise(_pick("0123456789", d, i))))
    phone = _by_digit(e, digest, lambda c, i, d: F.when(i >= 10, c).when(i.isin(9, 6), _pick("23456789", d, i)).otherwise(_pick("0123456789", d, i)))
    key = _swap(chars, digest, lambda c, i: i < F.when(F.substring(e, 1, 4) == "AKIA", 4).when(e.rlike("^(?:gh._|xox)"), 4).otherwise(3))

    def letter(c: Column, i: Column) -> Column:
        low, new = F.lower(c), c
        for sounds in SOUNDS:
            new = F.when(F.instr(F.lit(sounds), low) > 0, _pick(sounds, digest, i)).otherwise(new)
        return F.when(i >= size - 1, c).otherwise(F.when(low == c, new).otherwise(F.upper(new)))
    name = F.array_join(F.transform(chars, letter), "")
    hexed = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("[0-9]"), _pick("0123456789", digest, i)).otherwise(_pick("abcdef", digest, i))), "")
    ascii_ = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike(r"[^\x00-\x7f]") | ~e.rlike("[0-9A-Za-z]"), _pick("abcdefghijklmnopqrstuvwxyz", digest, i)).otherwise(c)), "")
    secret = F.when(e.rlike("^[0-9a-f]+$"), hexed).otherwise(_swap(_chars(ascii_), digest, lambda c, i: F.lit(False)))
    return F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "card", card).when(kind == "phone", phone).when(kind == "key", key).when(kind == "name", name).otherwise(secret)


def _longer(kind: Column, e: Column, digest: Column) -> Column:
    """For a shape with too few surrogates: one lengthened by letters of the digest, with digits for numbers."""
    more = F.translate(F.substring(digest, 1, 16), "0123456789", "ghijklmnop")
    numbers = F.translate(F.substring(digest, 1, 16), "abcdef", "012345")
    return F.when(kind.isin("card", "phone", "ip"), F.concat(_render(kind, e, digest), F.lit("-"), numbers)).when(kind == "email", F.concat(more, _render(kind, e, digest))).otherwise(F.concat(_render(kind, e, digest), more))


def surrogate_map(entities: DataFrame, key: str, tables: Tables, attempts: int = 12) -> DataFrame:
    """(kind, normal, attempt) for each distinct entity, so that no two surrogates agree and none is an entity."""
    real = tables.write(entities.distinct())
    taken, left, done = None, real, []
    for attempt in range(attempts):
        drawn = left.withColumn("surrogate", _render(F.col("kind"), F.col("normal"), _digest(key, F.col("kind"), F.col("normal"), F.lit(attempt))))
        drawn = tables.write(drawn.withColumn("surrogate", _normal(F.col("kind"), F.col("surrogate"))))
        free = drawn.join(real.select("kind", F.col("normal").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if taken is not None:
            free = free.join(taken, ["kind", "surrogate"], "left_anti")
        settled = tables.write(free.groupBy("kind", "surrogate").agg(F.min("normal").alias("normal")))
        done.append(settled.select("kind", "normal", F.lit(attempt).alias("attempt")))
        taken = settled.select("kind", "surrogate") if taken is None else taken.unionByName(settled.select("kind", "surrogate"))
        left = tables.write(left.join(settled.select("kind", "normal"), ["kind", "normal"], "left_anti"))
        if left.isEmpty():
            break
    else:
        done.append(left.select("kind", "normal", F.lit(-1).alias("attempt")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pseudonymise(documents: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, text with surrogates, n_entities.

    ``key`` is the secret: the same key gives the same surrogates in every run over the same entities. A null text stays null with no
    entities; a text without any stays as it is, byte for byte. Repeated rows and ties come out alike; texts are read whole; ids may be
    null and repeat; other columns are ignored.
    """
    tables = Tables(documents.sparkSession, "surrogates")
    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    has = F.coalesce(F.regexp_like("text", F.lit(SIGNS)) & F.regexp_like("text", F.lit(ANY)), F.lit(False))
    found = rows.where(has).select("id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(7), "text").alias("k2"), _parts(F.col("text")).alias("parts"))
    found = tables.write(found)
    entities = (found.select("k1", "k2", F.posexplode("parts").alias("at", "e")).where("at % 2 = 1").distinct()
                .withColumn("kind", _kind(F.col("e"))).withColumn("normal", _normal(F.col("kind"), F.col("e"))))
    entities = tables.write(entities)
    mapped = surrogate_map(entities.select("kind", "normal"), key, tables)
    forms = entities.select("kind", "normal", "e").distinct().join(mapped, ["kind", "normal"])
    digest = _digest(key, F.col("kind"), F.col("normal"), F.col("attempt"))
    forms = forms.select("kind", "normal", "e", F.when(F.col("attempt") < 0, _longer(F.col("kind"), F.col("e"), digest)).otherwise(_render(F.col("kind"), F.col("e"), digest)).alias("new"))
    forms = tables.write(forms)
    per_text = (entities.join(forms, ["kind", "normal", "e"]).groupBy("k1", "k2")
                .agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "new"))), lambda x: x["new"]).alias("new")))
    rebuilt = F.array_join(F.transform("parts", lambda p, i: F.when(i % 2 == 0, p).otherwise(F.get("new", (i / 2).cast("int")))), "")
    plain = F.replace(F.replace(rebuilt, F.lit(ESCAPE + "a"), F.lit(MARK)), F.lit(ESCAPE + "b"), F.lit(ESCAPE))
    changed = found.join(per_text, ["k1", "k2"]).select("id", plain.alias("text"), F.size("new").cast("long").alias("n_entities"))
    same = rows.where(~has).select("id", "text", F.lit(0).cast("long").alias("n_entities"))
    return same.unionByName(changed).withColumnRenamed("id", id_col).withColumnRenamed("text", text_col)
