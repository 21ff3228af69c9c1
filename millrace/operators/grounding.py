"""Whether a value stands on the page it is said to come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import page_numbers, squeeze


def stands_in(needle: Column, page: Column) -> Column:
    """The text, or else its leading number, stands in the page with no digit grown onto either end."""
    # The guards on either side of a number, so that no digit grows onto it.
    quoted = lambda x: F.concat(F.when(x.rlike(r"^\d"), F.lit(r"(?<![\d.,])")).otherwise(F.lit("")), F.lit(r"\Q"), F.replace(x, F.lit(r"\E"), F.lit("")), F.lit(r"\E"), F.when(x.rlike(r"\d$"), F.lit(r"(?!\d|[.,]\d)")).otherwise(F.lit("")))
    number = F.regexp_extract(needle, r"^[-+]?\d[\d,]*(?:\.\d+)?", 0)
    # a plain search first: only pages that hold the text are matched by pattern
    whole = F.contains(page, needle) & F.regexp_like(page, quoted(needle))
    return whole | ((number != "") & (number != needle) & F.contains(page, number) & F.regexp_like(page, quoted(number)))


def ground(values: DataFrame, pages: DataFrame, record: list[str], value_id: str, value: str, cited: str, page_no: str, text: str) -> DataFrame:
    """(value_id, grounding, found_on): cited_page, other_page, not_found or not_evaluated (no text or no pages).

    Cited pages are met by an equi-join on record and page. Only the values not found there are
    looked for on the other pages of their record. A value with an id of its own is one row.
    """
    clean = pages.select(*record, F.col(page_no).cast("int").alias("__p"), squeeze(F.col(text)).alias("__t"))
    v = values.select(*record, F.col(value_id).alias("__id"), squeeze(F.col(value).cast("string")).alias("__v"), page_numbers(F.col(cited)).alias("__c"))
    asked = v.where(F.coalesce(F.col("__v"), F.lit("")) != "")
    there = clean.where("__t is not null").select(*record).distinct()
    hit = lambda j: j.where(stands_in(F.col("__v"), F.col("__t"))).groupBy("__id").agg(F.array_join(F.array_sort(F.collect_set("__p")), ",").alias("__on"))
    on_cited = hit(asked.select(*record, "__id", "__v", F.explode("__c").alias("__p")).join(clean, [*record, "__p"]))
    left = asked.join(on_cited.select("__id"), "__id", "left_anti").join(clean, record).where(~F.coalesce(F.array_contains("__c", F.col("__p")), F.lit(False)))
    elsewhere = hit(left)
    evaluated = asked.join(there, record, "left_semi").select("__id")
    found = on_cited.withColumn("__g", F.lit("cited_page")).unionByName(elsewhere.withColumn("__g", F.lit("other_page")))
    j = v.select("__id").join(found, "__id", "left").join(evaluated.withColumn("__e", F.lit(True)), "__id", "left")
    return j.select(F.col("__id").alias(value_id), F.coalesce("__g", F.when(F.col("__e"), "not_found"), F.lit("not_evaluated")).alias("grounding"), F.coalesce("__on", F.lit("")).alias("found_on"))
