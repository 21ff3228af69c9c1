"""Entity resolution by lookups in fixed order of precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import alnum_key

#: A seed row of this canonical name marks a composite, not a model.
COMPOSITE = "__composite__"


def learned_flags(evidence: DataFrame, printed: str, flag: str, order: list[str], qualifying: list[str]) -> DataFrame:
    """(printed_key, flag): the last qualifying evidence of each printed text, case and outer spaces aside."""
    return evidence.where(F.col(flag).isin(qualifying) & F.col(printed).isNotNull()).groupBy(F.lower(F.trim(printed)).alias("printed_key")).agg(F.max_by(flag, F.struct(*order)).alias("flag"))


def seed_table(seed: DataFrame, family: str, printed: str, canonical: str, basis: str, order: str) -> DataFrame:
    """(family, printed_key, canonical, basis): the last seed row of each family and printed text."""
    return seed.groupBy(F.col(family).alias("family"), F.lower(F.trim(printed)).alias("printed_key")).agg(F.max_by(F.struct(F.col(canonical).alias("canonical"), F.col(basis).alias("basis")), F.col(order)).alias("s")).select("family", "printed_key", "s.*")


def family_free_seed(seed: DataFrame) -> DataFrame:
    """(printed_key, canonical, basis) of the texts that mean one canonical name in all families; least basis wins."""
    return seed.groupBy("printed_key").agg(F.count_distinct("canonical").alias("n"), F.min("canonical").alias("canonical"), F.min("basis").alias("basis")).where("n = 1").drop("n")


def strip_container(text: Column, prefixes: list[str]) -> Column:
    """Without the first prefix that fits and without a stage count at the end."""
    out = text
    for p in reversed(prefixes):
        out = F.when(F.lower(text).startswith(p.lower()), F.substr(text, F.lit(len(p) + 1))).otherwise(out)
    out = F.regexp_replace(out, r"(?i)[\s,(]*\d+\s*(?:stages?|stg)\)?\s*$", "")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def structural_class(text: Column) -> Column:
    """``not_a_model`` for a bare number, ``composite`` for two names joined; else null."""
    return F.when(text.rlike(r"^[\d\s.,]+$"), "not_a_model").when(text.rlike(r"(?i)\S\s+(?:and|w/|\+|&)\s+\S") | (F.regexp_count(text, F.lit(r"\b[A-Z]{2,}[-_]?\d+")) > 1), "composite")


def alias_resolve(names: DataFrame, printed: str, family: str, flags: DataFrame, seed: DataFrame, grammar: dict[str, str], prefixes: list[str]) -> DataFrame:
    """(family, printed, canonical, basis, flag) of each distinct name.

    Order: evidence flag, exact seed, structural rejection, the family's grammar, container
    stripped and then seed (the composite sentinel excluded) or grammar, unresolved. Blank names
    are unresolved. Distinct names are resolved once; callers join back.
    """
    distinct = names.select(F.col(family).alias("family"), F.col(printed).alias("printed")).distinct()
    keyed = distinct.withColumn("printed_key", F.lower(F.trim("printed"))).withColumn("bare", strip_container(F.col("printed"), prefixes)).withColumn("bare_key", F.lower("bare"))
    joined = (
        keyed.join(flags, "printed_key", "left")
        .join(seed.select("family", "printed_key", F.struct("canonical", "basis").alias("s")), ["family", "printed_key"], "left")
        .join(seed.where(F.col("canonical") != COMPOSITE).select("family", F.col("printed_key").alias("bare_key"), F.struct("canonical", "basis").alias("b")), ["family", "bare_key"], "left")
    )

    def by_grammar(text: Column) -> Column:
        hit = F.lit("")
        for fam, pattern in grammar.items():
            hit = F.when(F.col("family") == fam, F.regexp_extract(text, pattern, 0)).otherwise(hit)
        return F.when(hit != "", F.upper(F.regexp_replace(hit, "[^A-Za-z0-9]", "")))

    result = lambda canonical, basis, flag: F.struct(canonical.cast("string").alias("canonical"), basis.cast("string").alias("basis"), F.lit(flag).alias("flag"))
    none = F.lit(None)
    own, inner = by_grammar(F.trim("printed")), by_grammar(F.col("bare"))
    clean = F.upper(F.regexp_replace("printed", "[^A-Za-z0-9]", "")) == own
    picked = (
        F.when(F.trim("printed").isNull() | (F.trim("printed") == ""), result(none, none, "unresolved"))
        .when(F.col("flag").isNotNull(), F.struct(none.cast("string").alias("canonical"), F.lit("evidence").alias("basis"), F.col("flag").alias("flag")))
        .when(F.col("s.canonical") == COMPOSITE, result(none, F.col("s.basis"), "composite"))
        .when(F.col("s").isNotNull(), result(F.col("s.canonical"), F.col("s.basis"), "seed"))
        .when(structural_class(F.col("printed")) == "composite", result(none, none, "composite"))
        .when(structural_class(F.col("printed")) == "not_a_model", result(none, none, "not_a_model"))
        .when(own.isNotNull() & clean, result(own, F.lit("grammar"), "clean"))
        .when(own.isNotNull(), result(own, F.lit("grammar"), "repaired"))
        .when(F.col("b").isNotNull(), result(F.col("b.canonical"), F.col("b.basis"), "seed"))
        .when(inner.isNotNull(), result(inner, F.lit("grammar"), "repaired"))
        .otherwise(result(none, none, "unresolved"))
    )
    return joined.select("family", "printed", picked.alias("r")).select("family", "printed", "r.*")


def catalogue_lookup(names: DataFrame, printed: str, catalogue: DataFrame, name: str) -> DataFrame:
    """(printed, how, match, candidates) of each distinct name: exact, case, key, ambiguous or none.

    A tier answers if any entry hits it: with one entry by its name, with several as ambiguous with
    the sorted candidates. Null and blank names are ``none``.
    """
    distinct = names.select(F.col(printed).alias("printed")).distinct()
    entries = catalogue.select(F.col(name).alias("n")).where("n is not null").distinct()
    tier = lambda key, out: entries.groupBy(key.alias(f"k_{out}")).agg(F.sort_array(F.collect_set("n")).alias(out))
    joined = (
        distinct.withColumn("k_exact", F.col("printed")).withColumn("k_case", F.lower(F.trim("printed"))).withColumn("k_key", F.nullif(alnum_key(F.col("printed")), F.lit("")))
        .join(tier(F.col("n"), "exact"), "k_exact", "left").join(tier(F.lower(F.trim("n")), "case"), "k_case", "left").join(tier(alnum_key(F.col("n")), "key"), "k_key", "left")
    )
    hits = F.coalesce("exact", "case", "key")
    blank = F.col("printed").isNull() | (F.trim("printed") == "")
    how = F.when(blank | hits.isNull(), "none").when(F.size(hits) > 1, "ambiguous").when(F.col("exact").isNotNull(), "exact").when(F.col("case").isNotNull(), "case").otherwise("key")
    return joined.select("printed", how.alias("how"), F.when(how.isin("exact", "case", "key"), hits[0]).alias("match"), F.when(how == "ambiguous", F.array_join(hits, "|")).alias("candidates"))


def unknown_models(resolved: DataFrame, catalogue: DataFrame, name: str, basis: str) -> DataFrame:
    """(printed, class): unresolved, absent, ambiguous or no_head_curve; each once."""
    curves = catalogue.groupBy(F.col(name).alias("match")).agg(F.max(F.col(basis).isNotNull().cast("int")).alias("curve"))
    joined = resolved.join(curves, "match", "left")
    kind = F.when(F.col("printed").isNull() | (F.trim("printed") == ""), "unresolved").when(F.col("how") == "ambiguous", "ambiguous").when(F.col("how") == "none", "absent").when(F.col("curve") == 0, "no_head_curve")
    return joined.select("printed", kind.alias("class")).where("class is not null").distinct()


def near_names(rows: DataFrame, name: str) -> DataFrame:
    """(form, n_names, names): names equal but for case, spaces and characters of no width."""
    form = F.lower(F.trim(F.regexp_replace(F.regexp_replace(name, "[​-‍⁠﻿­]", ""), r"(?U)\s+", " ")))
    return rows.where(F.col(name).isNotNull()).select(form.alias("form"), F.col(name).alias("n")).distinct().groupBy("form").agg(F.count("*").alias("n_names"), F.array_join(F.sort_array(F.collect_list("n")), "|").alias("names")).where("n_names > 1")


def same_model(a: Column, b: Column) -> Column:
    """Canonical names equal, or their keys equal or one the beginning of the other."""
    x, y = alnum_key(a), alnum_key(b)
    return (a == b) | ((x != "") & (y != "") & (x.startswith(y) | y.startswith(x)))


def first_filled(*columns: str) -> Column:
    """The first of several columns that holds more than blanks, trimmed; null if none does."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])


def by_lookup(rows: DataFrame, key: str, printed: str, family: str, generic: str, seed: DataFrame) -> DataFrame:
    """(key, canonical): rows of a family by that family's seed, rows of the generic one by the texts that mean one model in every family.

    Both lookups are one join each on the distinct texts; what is chosen is decided per row, so another
    lookup can be put in by giving another ``seed``.
    """
    keyed = rows.select(F.col(key), F.col(family).alias("family"), F.lower(F.trim(printed)).alias("printed_key"))
    own = seed.select("family", "printed_key", F.col("canonical").alias("own"))
    free = family_free_seed(seed.select("printed_key", "canonical", "basis")).select("printed_key", F.col("canonical").alias("free"))
    j = keyed.join(own, ["family", "printed_key"], "left").join(free, "printed_key", "left")
    return j.select(key, F.when(F.col("family") == generic, F.col("free")).otherwise(F.col("own")).alias("canonical"))


def conflict_kinds(rows: DataFrame, a: str, b: str, catalogue: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``kind``: ``benign`` if both printed forms name one model of the catalogue, else ``conflict``."""
    forms = rows.select(F.explode(F.array(a, b)).alias("n"))
    found = catalogue_lookup(forms, "n", catalogue, name).where("match is not null").select("printed", "match")
    j = rows.join(found.select(F.col("printed").alias(a), F.col("match").alias("__a")), a, "left").join(found.select(F.col("printed").alias(b), F.col("match").alias("__b")), b, "left")
    return j.withColumn("kind", F.when(F.col("__a") == F.col("__b"), "benign").otherwise("conflict")).drop("__a", "__b")
