"""Dimension and list sources, each with its own strictness."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.typed import strip


def csv_dimension(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """A header CSV as a dimension: the last row of each lower-cased key holds. Order is by file name, then that of the lines in the file."""
    rows = spark.read.option("header", True).csv(path)
    names = rows.columns
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    low = [F.lower(F.trim(k)).alias(f"__{k}") for k in keys]
    return rows.select(*names, at.alias("__at")).groupBy(*low).agg(F.max_by(F.struct(*names), "__at").alias("r")).select("r.*")


def _cells(content: bytes, legacy: str) -> Iterator[list[str]]:
    """Rows of a CSV file, each cell UTF-8 if it is valid so, else in the legacy code page; quoted cells may hold commas and line ends."""
    for row in csv.reader(io.StringIO(content.removeprefix(b"\xef\xbb\xbf").decode("latin-1"), newline="")):
        out = []
        for cell in row:
            raw = cell.encode("latin-1")
            try:
                out.append(raw.decode("utf-8"))
            except UnicodeDecodeError:
                out.append(raw.decode(legacy, "replace"))
        yield out


def strict_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """(columns): exact values of a list that must be whole, in the order of its lines.

    Missing columns, rows of another width and bad encoding raise at once; blank lines and a BOM are
    passed over; of exact repeats the first is kept. A list is one file that a task reads whole.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    rows = list(csv.reader(io.StringIO(bytes(content).decode("utf-8-sig"), newline=""), strict=True))
                except (UnicodeDecodeError, csv.Error) as e:
                    yield pd.DataFrame([(name, 0, None, f"not UTF-8 CSV: {e}")], columns=["file", "line_no", "cells", "problem"])
                    continue
                head, out = rows[0] if rows else [], []
                missing = [c for c in columns if c not in head]
                if missing:
                    out.append((name, 0, None, f"no column {', '.join(missing)}"))
                for no, row in enumerate(rows[1:], 2):
                    if row and not missing:
                        out.append((name, no, [row[head.index(c)] for c in columns], None) if len(row) == len(head) else (name, no, None, f"line {no} has {len(row)} fields"))
                yield pd.DataFrame(out, columns=["file", "line_no", "cells", "problem"])

    parsed = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, "file string, line_no int, cells array<string>, problem string")
    bad = parsed.where("problem is not null").select("file", "problem").limit(5).collect()
    if bad:
        raise ValueError("; ".join(f"{r.file}: {r.problem}" for r in bad))
    first = parsed.groupBy("cells").agg(F.min(F.struct("file", "line_no")).alias("at")).orderBy("at")
    return first.select(*[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def mixed_encoding_csv(spark: SparkSession, path: str, legacy: str = "cp1252") -> DataFrame:
    """(line_no, cells) of the records of a CSV file, each cell UTF-8 if it is valid so, else in the legacy code page; trailing cells without a header are dropped."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for content in pdf["content"]:
                width = None
                for no, cells in enumerate(_cells(bytes(content), legacy), 1):
                    if width is None:
                        while cells and not cells[-1].strip():
                            cells.pop()
                        width = len(cells)
                    out.append((no, cells[:width]))
            yield pd.DataFrame(out, columns=["line_no", "cells"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(decode, "line_no int, cells array<string>")


def curve_dimension(catalogue: DataFrame, name: str, basis: str) -> DataFrame:
    """(name, has_curve): whether any entry of the name has a curve; only the two columns are read."""
    return catalogue.select(name, basis).groupBy(name).agg(F.bool_or(F.col(basis).isNotNull()).alias("has_curve"))


def verified_asset(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """(name, content) of files whose SHA-256 is the manifest's (name, sha256); any other file raises when read."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    j = files.join(manifest, "name", "left").withColumn("ok", F.coalesce(F.sha2("content", 256) == F.lower("sha256"), F.lit(False)))
    return j.select("name", F.when(F.col("ok"), F.col("content")).otherwise(F.raise_error(F.concat(F.lit("hash differs: "), F.col("name")))).alias("content"))


def list_query(rows: DataFrame, columns: list[str], key: str) -> tuple[DataFrame, DataFrame]:
    """(rows, skipped): null reads as empty; rows with an empty key are left out and counted."""
    absent = [c for c in columns if c not in rows.columns]
    if absent:
        raise ValueError(f"no column {', '.join(absent)}")
    filled = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
    return filled.where(strip(F.col(key)) != ""), filled.agg(F.count_if(strip(F.col(key)) == "").alias("skipped"))


def viewer_lines(spark: SparkSession, path: str) -> DataFrame:
    """(obj, dropped): JSON lines for display; a line that is no object is wrapped as ``value``, one that is no JSON is dropped and marked."""
    t = spark.read.text(path).where(F.trim("value") != "")
    parsed = F.try_parse_json("value")
    is_object = F.trim("value").startswith("{")
    return t.select(F.when(parsed.isNotNull(), F.when(is_object, F.col("value")).otherwise(F.to_json(F.struct(F.col("value"))))).alias("obj"), parsed.isNull().alias("dropped"))
