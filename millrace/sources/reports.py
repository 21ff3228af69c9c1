"""Text reports: frontmatter, fenced blocks of line-delimited JSON, a footer of row counts.

All reports flow through one plan. A report is one row of text; its lines are exploded once, with
their positions, and every reader works on those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FENCE = "```"


def scan(spark: SparkSession, path: str) -> DataFrame:
    """(report_id, text) of every ``*.md`` below ``path``; the id is the file name, bad bytes are replaced. A file of no bytes is no report."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("report_id"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def lines(reports: DataFrame) -> DataFrame:
    """(report_id, line_no, line), numbered from 1."""
    return reports.select("report_id", F.posexplode(F.split("text", "\r?\n")).alias("p", "line")).select("report_id", (F.col("p") + 1).alias("line_no"), "line")


def frontmatter(reports: DataFrame) -> DataFrame:
    """(report_id, frontmatter map): ``key: value`` lines between the first two ``---``; a key without a value takes its ``- item`` lines, joined by newlines."""
    head = F.regexp_extract("text", r"(?s)^---\r?\n(.*?)\r?\n---", 1)
    joined = F.regexp_replace(head, r"\r?\n\s+-\s+", "\u0001")
    rows = F.filter(F.split(joined, "\r?\n"), lambda x: x.rlike(r"^[^:\s][^:]*:"))
    entry = lambda x: F.struct(F.trim(F.regexp_extract(x, r"^([^:]+):", 1)).alias("k"), F.trim(F.replace(F.regexp_replace(F.regexp_extract(x, r"^[^:]+:\s*(.*)$", 1), "^\u0001", ""), F.lit("\u0001"), F.lit("\n"))).alias("v"))
    return reports.select("report_id", F.map_from_entries(F.transform(rows, entry)).alias("frontmatter"))


def regions(reports: DataFrame) -> DataFrame:
    """(report_id, block, line_no) of every heading that opens a data block."""
    w = W.partitionBy("report_id").orderBy("line_no")
    heads = lines(reports).withColumn("next", F.lead("line").over(w)).where(F.col("line").rlike(r"^##\s") & F.trim("next").startswith(FENCE + "jsonl"))
    return heads.select("report_id", F.trim(F.regexp_extract("line", r"^##\s+(.*)$", 1)).alias("block"), "line_no")


def block_lines(reports: DataFrame, strict: bool = False) -> DataFrame:
    """(report_id, block, line_no, line) of the lines inside data blocks.

    A ``## name`` opens a block only if the next line is a ```` ```jsonl ```` fence. The block runs
    to the next heading and tolerates fences closed and opened again; ``strict`` ends it at the
    first closing fence, and of repeated blocks keeps the last.
    """
    w = W.partitionBy("report_id").orderBy("line_no")
    marked = lines(reports).withColumn("next", F.lead("line").over(w))
    heading = F.col("line").rlike(r"^##\s")
    opens = heading & F.trim("next").startswith(FENCE + "jsonl")
    region = F.last(F.when(heading, F.struct(F.when(opens, F.trim(F.regexp_extract("line", r"^##\s+(.*)$", 1))).alias("block"), F.col("line_no").alias("at"))), ignorenulls=True)
    inside = marked.withColumn("r", region.over(w)).where("r.block is not null and line_no > r.at").select("report_id", F.col("r.block").alias("block"), F.col("r.at").alias("at"), "line_no", "line")
    if strict:
        in_block = W.partitionBy("report_id", "at").orderBy("line_no")
        fences = F.sum(F.trim("line").startswith(FENCE).cast("int")).over(in_block)
        last = F.max("at").over(W.partitionBy("report_id", "block"))
        inside = inside.withColumn("f", fences).withColumn("last", last).where("f = 1 and at = last")
    return inside.where(~F.trim("line").startswith(FENCE) & (F.trim("line") != "")).select("report_id", "block", "line_no", "line")


def staging(reports: DataFrame, strict: bool = False) -> DataFrame:
    """(report_id, block, line_no, line, obj): ``obj`` is a map of texts, null where the line does not parse.

    An absent key stays absent. Of a repeated key the last value holds (``mapKeyDedupPolicy``).
    """
    rows = block_lines(reports, strict)
    whole = F.trim("line").startswith("{") & F.trim("line").endswith("}")
    return rows.withColumn("obj", F.when(whole, F.from_json("line", "map<string,string>", {"allowSingleQuotes": "false", "mode": "PERMISSIVE"})))


def canonical(obj: str = "obj") -> Column:
    """The row as JSON with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(obj))))


def rows(reports: DataFrame, strict: bool = False) -> DataFrame:
    """(report_id, block, row_key, line_no, obj): parsed rows, exact repeats within a block dropped, numbered from 1."""
    parsed = staging(reports, strict).where("obj is not null").withColumn("canon", canonical())
    first = parsed.groupBy("report_id", "block", "canon").agg(F.min("line_no").alias("line_no"), F.min_by("obj", "line_no").alias("obj"))
    w = W.partitionBy("report_id", "block").orderBy("line_no")
    return first.select("report_id", "block", F.row_number().over(w).alias("row_key"), "line_no", "obj")


def truncated(reports: DataFrame) -> DataFrame:
    """Lines of data blocks that do not parse, their first 400 characters as raw value."""
    return staging(reports).where("obj is null").select("report_id", "block", "line_no", F.substring("line", 1, 400).alias("raw_value"), F.lit("truncated_line").alias("reason"))


def footer(reports: DataFrame) -> DataFrame:
    """(report_id, block, declared): the last parseable object under ``## row_counts``; a count that is no JSON integer (text, fraction, true) is null."""
    w = W.partitionBy("report_id").orderBy("line_no")
    section = F.last(F.when(F.col("line").rlike(r"^##\s"), F.trim(F.regexp_extract("line", r"^##\s+(.*)$", 1))), ignorenulls=True).over(w)
    objects = lines(reports).withColumn("s", section).where("s = 'row_counts'").withColumn("o", F.when(F.trim("line").startswith("{"), F.from_json("line", "map<string,variant>"))).where("o is not null and trim(line) like '{%}'")
    last = objects.groupBy("report_id").agg(F.max_by("o", "line_no").alias("o"))
    return last.select("report_id", F.explode("o").alias("block", "d")).select("report_id", "block", F.when(F.schema_of_variant("d") == "BIGINT", F.try_variant_get("d", "$", "int")).alias("declared"))


def reconciliation(reports: DataFrame) -> DataFrame:
    """(report_id, block, declared, parsed, repeated, truncated, agrees) of every block that is declared or there."""
    s = staging(reports).withColumn("canon", F.when(F.col("obj").isNotNull(), canonical()))
    counts = s.groupBy("report_id", "block").agg(F.count_distinct("canon").alias("parsed"), (F.count("canon") - F.count_distinct("canon")).alias("repeated"), F.count_if(F.col("obj").isNull()).alias("truncated"))
    j = footer(reports).join(counts, ["report_id", "block"], "full_outer").fillna(0, ["parsed", "repeated", "truncated"])
    return j.withColumn("agrees", F.col("declared").eqNullSafe(F.col("parsed").cast("int")))


def unknown_keys(reports: DataFrame, legal: DataFrame) -> DataFrame:
    """(report_id, block, row_key, key, raw_value) of keys outside ``legal`` (block, key); they are kept, not dropped."""
    cells = rows(reports).select("report_id", "block", "row_key", F.explode("obj").alias("key", "raw_value"))
    return cells.join(legal, ["block", "key"], "left_anti")
