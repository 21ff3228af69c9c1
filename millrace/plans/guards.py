"""Guards over whole reports: structure, emptiness and declared halts, and the status they set.

A guard fires once per report (and block). Findings have the form of the rule engine's, so that
guards, rules and what staging reports come together in one table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources import reports as R

FINDING = ("report_id", "rule_id", "severity", "table_name", "column_name", "value")
# The least status each guard leaves a report with, and the rules that stop publishing.
FLOOR = {"G-S1": "failed", "G-S2": "failed", "G-S3": "failed", "G-E1": "failed", "G-E2": "needs_review", "G-E3": "needs_review"}
STOPS_PUBLISHING = ("V-08", "D17", "G-E1")
# A line of prose that declares a halt, and the rules it may name.
_HALT_LINE = r"(?m)^[\s>*_#-]*(?:\[![A-Za-z]+\]\s*)?[*_]*HALT\b[*_]*\s*(?:[—–:.(-]|V-|D1[67]).*$"
_RULE_ID = r"\b(V-F\d-\d+|V-[A-Z]?\d{1,2}|D1[67])\b"


def _finding(df: DataFrame, rule: str, severity: str, table=None, value=None) -> DataFrame:
    text = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
    return df.select("report_id", F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"), text(table).alias("table_name"), F.lit(None).cast("string").alias("column_name"), text(value).alias("value"))


def structure(reports: DataFrame, blocks: Sequence[str]) -> DataFrame:
    """G-S1 no frontmatter, G-S2 a block without its fence, G-S3 no footer with an integer for every block. Any of them refuses the report."""
    front = R.frontmatter(reports).where(F.size("frontmatter") > 0).select("report_id")
    opened = R.regions(reports).select("report_id", "block").distinct()
    wanted = reports.select("report_id", F.explode(F.array(*map(F.lit, blocks))).alias("block"))
    counted = R.footer(reports).where(F.col("block").isin(list(blocks)) & F.col("declared").isNotNull()).groupBy("report_id").agg(F.count("*").alias("n")).where(F.col("n") == len(blocks))
    ids = reports.select("report_id")
    return (
        _finding(ids.join(front, "report_id", "left_anti"), "G-S1", "ERROR")
        .unionByName(_finding(wanted.join(opened, ["report_id", "block"], "left_anti"), "G-S2", "ERROR", F.col("block")))
        .unionByName(_finding(ids.join(counted, "report_id", "left_anti"), "G-S3", "ERROR"))
    )


def counts(reports: DataFrame) -> DataFrame:
    """G-S4: a block whose footer declares another number than was parsed."""
    off = R.reconciliation(reports).where(F.col("declared").isNotNull() & ~F.col("agrees"))
    return _finding(off, "G-S4", "WARN", F.col("block"), F.concat_ws("/", "declared", "parsed"))


def declared_halts(reports: DataFrame) -> DataFrame:
    """(report_id, rules): reports that declare a halt in the prose before their first block or in the frontmatter, with the rule ids it names."""
    prose = F.regexp_replace("text", r"(?s)\n## [^\n]*\n```jsonl.*$", "")
    lines = F.array_join(F.regexp_extract_all(prose, F.lit("(" + _HALT_LINE + ")"), F.lit(1)), "\n")
    failed = F.lower(F.coalesce(F.element_at("frontmatter", F.lit("validation_status")), F.lit(""))) == "failed"
    j = reports.select("report_id", lines.alias("l")).join(R.frontmatter(reports), "report_id")
    return j.where((F.col("l") != "") | failed).select("report_id", F.array_distinct(F.regexp_extract_all("l", F.lit(_RULE_ID), F.lit(1))).alias("rules"))


def emptiness(reports: DataFrame, main: str, beside: str) -> DataFrame:
    """G-E1 neither block has rows, G-E2 the main one has none, G-E3 a declared halt of a report with rows. Reports without any row fire too."""
    n = R.rows(reports).groupBy("report_id").agg(F.count_if(F.col("block") == main).alias("m"), F.count_if(F.col("block") == beside).alias("b"))
    j = reports.select("report_id").join(n, "report_id", "left").fillna(0, ["m", "b"]).join(declared_halts(reports), "report_id", "left")
    said = F.array_join("rules", ",")
    empty = (F.col("m") == 0) & (F.col("b") == 0)
    return (
        _finding(j.where(empty), "G-E1", "ERROR", value=said).unionByName(_finding(j.where((F.col("m") == 0) & ~empty), "G-E2", "WARN", F.lit(main)))
        .unionByName(_finding(j.where(F.col("rules").isNotNull() & ~empty), "G-E3", "WARN", value=said))
    )


def surfaced(unknown_keys: DataFrame, varying: DataFrame, unlike: DataFrame) -> DataFrame:
    """What staging found, as findings: V-10 keys outside the schema (report_id, block, key, raw_value), D16 columns halted since they vary (report_id, column, all_values), D17 records whose variants differ (report_id)."""
    text = lambda c: F.col(c).cast("string")
    a = unknown_keys.select("report_id", F.lit("V-10").alias("rule_id"), F.lit("HALT").alias("severity"), text("block").alias("table_name"), text("key").alias("column_name"), text("raw_value").alias("value"))
    b = varying.select("report_id", F.lit("D16").alias("rule_id"), F.lit("HALT").alias("severity"), F.lit(None).cast("string").alias("table_name"), text("column").alias("column_name"), text("all_values").alias("value"))
    return a.unionByName(b).unionByName(_finding(unlike, "D17", "HALT"))


def status(reports: DataFrame, findings: DataFrame, generic: DataFrame | None = None) -> DataFrame:
    """(report_id, status, may_publish): passed, needs_review or failed, never below the floor of a guard; ``generic`` reports need review at least; reports without findings pass."""
    floor = F.create_map(*[F.lit(x) for kv in FLOOR.items() for x in kv])
    rank = F.greatest(
        F.when(F.col("severity") == "HALT", 2).when(F.col("severity").isin("ERROR", "WARN"), 1).otherwise(0),
        F.when(F.element_at(floor, F.col("rule_id")) == "failed", 2).when(F.element_at(floor, F.col("rule_id")) == "needs_review", 1).otherwise(0),
    )
    worst = findings.groupBy("report_id").agg(F.max(rank).alias("r"), F.max(F.col("rule_id").isin(*STOPS_PUBLISHING).cast("int")).alias("s"))
    j = reports.select("report_id").join(worst, "report_id", "left")
    r = F.coalesce("r", F.lit(0))
    if generic is not None:
        j = j.join(generic.select("report_id", F.lit(1).alias("g")).distinct(), "report_id", "left")
        r = F.greatest(r, F.coalesce("g", F.lit(0)))
    return j.select("report_id", F.when(r == 2, "failed").when(r == 1, "needs_review").otherwise("passed").alias("status"), (F.coalesce("s", F.lit(0)) == 0).alias("may_publish"))
