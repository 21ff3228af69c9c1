"""Problem 7: one consistent form for texts that look the same.

Characters that look alike are mapped one to one by a fixed table (a ``translate`` and a few
replacements). What remains - composed against combining accents - is left to an accent- and
case-sensitive Unicode collation, under which canonically equivalent strings are equal. Grouping
mapped values under it gives the classes of look; a class is stored in its canonical member.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters and the Latin letter each looks like, after Unicode's confusables.
_LETTERS = [
    # Cyrillic
    ("АВЕЅІЈКМНОРСТУХҮӀԌԚԜѴӔ", "ABESIJKMHOPCTYXYIGQWVÆ"),
    ("аеорсухѕіјһԁԛԝүѵӏӕ", "aeopcyxsijhdqwyvlæ"),
    # Greek
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧͿϹϺ", "ABEZHIKMNOPTYXJCM"),
    ("αγινορσυϲϳϱ", "ayivopoucjp"),
    # Armenian, Latin extensions and letter-like signs
    ("օսԼոհաıɑɡᴏᴜᴠᴡᴢⲟⲞKÅℇ", "ouLnhwi" + "agouvwzoOKÅE"),
]
# Spaces, hyphens and minus signs, apostrophes, degree signs and the sign each looks like.
_SIGNS = [
    ("\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000\t", " " * 17),
    ("\u2028\u2029\u0085\u000b", "\n" * 4),
    ("\u2010\u2011\u2012\u2013\u2043\u2212\ufe63\ufe58\uff0d\u02d7\u06d4\u2796\u2cba", "-" * 13),
    ("\u2018\u2019\u02bc\u02b9\u2032\u00b4\uff07\u201b\u02bb\u02bd\u02be\u02c8\u055a\ua78c", "'" * 14),
    ("\u00ba\u02da\u2218\u25e6\u26ac", "\u00b0" * 5),
    ("\u00b5", "\u03bc"),
]
#: Full-width forms stand at a fixed distance from ASCII.
_WIDE = ("".join(chr(c) for c in range(0xFF01, 0xFF5F)), "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)))
# Characters of no width.
NO_WIDTH = "\u00ad\u034f\u061c\u115f\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufe0e\ufe0f\ufeff"
# Ligatures.
LIGATURES = {"\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl", "\ufb05": "st", "\ufb06": "st", "\u0132": "IJ", "\u0133": "ij"}
#: Where letters of other scripts stand that are composed of a letter above and accents.
_COMPOSED = (0x0370, 0x0530)


@lru_cache(maxsize=1)
def char_map() -> dict[str, str]:
    """Character -> what it looks like ('' for no width), for use outside SQL too.

    A composed letter of another script (Greek O with tonos) is taken apart by the Unicode data: if
    its base letter looks like a Latin one, it looks like that one under the same accents.
    """
    out = dict(zip(*_WIDE, strict=True))
    for a, b in (*_LETTERS, *_SIGNS):
        out |= dict(zip(a, b, strict=True))
    for c in map(chr, range(*_COMPOSED)):
        apart = unicodedata.normalize("NFD", c)
        if len(apart) > 1 and apart[0] in out and c not in out:
            look = unicodedata.normalize("NFC", out[apart[0]] + apart[1:])
            if len(look) == 1:  # what has no composed Latin form has no Latin look either
                out[c] = look
    return out | dict.fromkeys(NO_WIDTH, "") | LIGATURES


def mapped(text: Column) -> Column:
    """``text`` with look-alike characters mapped; case, accents and the number of spaces stay. Null stays null."""
    one = {k: v for k, v in char_map().items() if len(v) == 1}
    plain = F.translate(text, "".join(one) + NO_WIDTH, "".join(one.values()))
    for ligature, letters in LIGATURES.items():
        plain = F.replace(plain, F.lit(ligature), F.lit(letters))
    return F.when(text.rlike(r"[^\x00-\x08\x0a\x0c-\x7f]"), plain).otherwise(text)


def stored(text: Column) -> Column:
    """``text`` as stored, without outer spaces of any kind."""
    return F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def look(text: Column) -> Column:
    """The collated key under which texts of one look are equal."""
    return F.collate(stored(mapped(text)), "UNICODE")


def classes(texts: DataFrame, column: str) -> DataFrame:
    """(key, canonical, n_stored): each distinct mapped text, by hash, with its class's canonical member.

    The canonical member is the shortest, then least, mapped text, so it is composed and does not
    depend on row order. ``n_stored`` counts the different ways the class is stored. Repeats are
    merged before each shuffle; a text that fills a third of the table is one row from then on.
    """
    m = stored(mapped(F.col(column)))
    distinct = (
        texts.where(F.col(column).isNotNull())
        .select(m.alias("m"), F.xxhash64(stored(F.col(column))).alias("s"))
        .groupBy("m").agg(F.collect_set("s").alias("s"))
        .withColumn("s", F.array_sort("s"))
    )
    grouped = distinct.groupBy(F.collate("m", "UNICODE").alias("look")).agg(
        F.min(F.struct(F.length("m").alias("n"), F.col("m"))).alias("best"), F.collect_list(F.sha2("m", 256)).alias("keys"), F.size(F.array_distinct(F.flatten(F.collect_list("s")))).alias("n_stored")
    )
    return grouped.select(F.explode("keys").alias("key"), F.col("best.m").alias("canonical"), "n_stored")


def canonical_form(texts: DataFrame, column: str) -> DataFrame:
    """``texts`` with ``canonical`` (the class's one form; null for null) and ``n_stored`` joined back.

    Existing columns of these names are replaced. Empty and blank texts have the empty form.
    """
    rows = texts.drop("canonical", "n_stored").withColumn("__key", F.sha2(stored(mapped(F.col(column))), 256))
    return rows.join(classes(texts, column).withColumnRenamed("key", "__key"), "__key", "left").drop("__key")


def differing_pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Rows whose two columns look the same but are stored in different characters; nulls look like nothing.

    The values of both columns are put into classes together and each column gets its class's
    canonical member by a join; a row counts if both columns have one member. Only rows whose two
    values are stored differently can count, so only theirs are looked up.
    """
    x, y = F.col(a), F.col(b)
    unlike = rows.where(stored(x) != stored(y))
    both = unlike.select(F.explode(F.array(x, y)).alias("t"))
    of = classes(both, "t").select("key", "canonical")
    key = lambda c: F.sha2(stored(mapped(c)), 256)
    j = unlike.withColumn("__a", key(x)).withColumn("__b", key(y))
    j = j.join(of.select(F.col("key").alias("__a"), F.col("canonical").alias("__x")), "__a").join(of.select(F.col("key").alias("__b"), F.col("canonical").alias("__y")), "__b")
    return j.where("__x = __y").select(*rows.columns)


def differing_texts(rows: DataFrame, column: str) -> DataFrame:
    """Rows for which another row's text looks the same but is stored otherwise.

    Only the classes stored in more than one way travel back to the rows.
    """
    several = classes(rows, column).where("n_stored > 1").select(F.col("key").alias("__key"))
    return rows.withColumn("__key", F.sha2(stored(mapped(F.col(column))), 256)).join(several, "__key", "left_semi").drop("__key")
