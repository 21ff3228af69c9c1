"""Document routing by marker words, and which pages are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LOW_YIELD = 150
TEXT_FLOOR = 20


def route(pages: DataFrame, document: str, text: str, signatures: dict[str, list[str]]) -> DataFrame:
    """(document, family, n_families, near): the one family all of whose markers stand in the text.

    None: ``unknown`` with the family of the best share of markers; several: ``ambiguous``; hardly
    any text: ``no_text``. Markers are few and fixed, so they are predicates, not a join.
    """
    t = F.lower(F.coalesce(F.col(text), F.lit("")))
    size = F.length(F.regexp_replace(t, r"(?U)\s", ""))
    hits = F.array(*[F.struct(F.lit(f).alias("family"), sum((F.contains(t, F.lit(m.lower())).cast("int") for m in ms), F.lit(0)).alias("hits"), F.lit(len(ms)).alias("of")) for f, ms in sorted(signatures.items())])
    full = F.filter("h", lambda x: x["hits"] == x["of"])
    ranked = F.array_sort(F.transform("h", lambda x: F.struct((-(x["hits"] / x["of"])).alias("s"), (-x["hits"]).alias("n"), x["family"].alias("f"))))
    j = pages.select(document, size.alias("size"), hits.alias("h"))
    return j.select(
        document,
        F.when(F.col("size") < TEXT_FLOOR, "no_text").when(F.size(full) == 1, full[0]["family"]).when(F.size(full) > 1, "ambiguous").otherwise("unknown").alias("family"),
        F.size(full).alias("n_families"),
        F.when((F.size(full) == 0) & (ranked[0]["n"] < 0), ranked[0]["f"]).alias("near"),
    )


def keep_pages(pages: DataFrame, document: str, page_no: str, roles: str, text: str, plot_only: list[str]) -> DataFrame:
    """``pages`` with ``role`` (own first role, else carried forward), ``kept``, ``new_no`` and ``low_yield``.

    A page is left out only if it has roles and every one is plot-only.
    """
    w = W.partitionBy(document).orderBy(page_no)
    own = F.when(F.size(roles) > 0, F.get(F.col(roles), F.lit(0)))
    kept = ~((F.coalesce(F.size(roles), F.lit(0)) > 0) & F.forall(F.coalesce(F.col(roles), F.array().cast("array<string>")), lambda r: r.isin(plot_only)))
    out = pages.withColumn("role", F.coalesce(own, F.last(own, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1)))).withColumn("kept", kept)
    return out.withColumn("new_no", F.when(F.col("kept"), F.sum(F.col("kept").cast("int")).over(w))).withColumn("low_yield", F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"(?U)\s", "")) < LOW_YIELD)


def first_lines(pages: DataFrame, key: list[str], text: str, matchers: list[tuple[str, str, str, str]]) -> DataFrame:
    """(key, role, status, line): for each matcher (role, status, kind, needle) that a page meets the first line it meets, as it stands.

    Kinds: ``line`` the whole line, ``start`` its beginning, ``title`` the beginning of the page's
    first line, ``re`` a pattern in it. Matchers are few and fixed, so they are predicates.
    """
    fits = {"line": lambda n: lambda x: x == n, "start": lambda n: lambda x: x.startswith(n), "title": lambda n: lambda x: x.startswith(n), "re": lambda n: lambda x: x.rlike(n)}
    ls = F.split(F.coalesce(F.col(text), F.lit("")), "\r?\n")
    hay = lambda kind: F.slice(F.filter("l", lambda x: F.trim(x) != ""), 1, 1) if kind == "title" else F.col("l")
    one = [F.struct(F.lit(role).alias("role"), F.lit(status).alias("status"), F.get(F.filter(hay(kind), fits[kind](needle)), F.lit(0)).alias("line")) for role, status, kind, needle in matchers]
    hits = pages.select(*key, ls.alias("l")).select(*key, F.explode(F.filter(F.array(*one), lambda m: m["line"].isNotNull())).alias("m"))
    return hits.select(*key, "m.*")


def missing_roles(pages: DataFrame, document: str, hits: DataFrame, required: list[str]) -> DataFrame:
    """(document, missing): the required roles that no page of a document meets, in their order; documents that miss none have an empty list."""
    seen = hits.groupBy(document).agg(F.collect_set("role").alias("seen"))
    j = pages.select(document).distinct().join(seen, document, "left")
    return j.select(document, F.array_except(F.array(*map(F.lit, required)), F.coalesce("seen", F.array().cast("array<string>"))).alias("missing"))


def route_of(family: Column, near: Column, missing: Column, forced: Column) -> Column:
    """struct<route, hint>: ``template`` for a known family with all its pages; ``generic`` hinting at the family if pages are missing, at nothing if forced, at the nearest if unknown; else ``refused`` with the reason."""
    out = lambda route, hint: F.struct(F.lit(route).alias("route"), hint.cast("string").alias("hint"))
    none = F.lit(None)
    return (
        F.when(family.isin("no_text", "ambiguous"), out("refused", family)).when(family == "unknown", out("generic", near)).when(F.size(missing) > 0, out("generic", family))
        .when(forced, out("generic", none)).otherwise(out("template", family))
    )


def private_use(text: str) -> Column:
    """Whether glyphs of the private use area are left in a text."""
    return F.col(text).rlike(r"[-]")


def fingerprint_clusters(rows: DataFrame, key: str, text: str, parent: str) -> DataFrame:
    """(fingerprint, n, n_parents, first_key) of texts that occur more than once."""
    return rows.where(F.col(text).isNotNull()).groupBy(F.sha2(text, 256).alias("fingerprint")).agg(F.count("*").alias("n"), F.count_distinct(parent).alias("n_parents"), F.min(key).alias("first_key")).where("n > 1")
