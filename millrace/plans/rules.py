"""A declarative rule engine.

A rule is registered with an id, a severity, a scope and what it needs. Row rules of one table are
fused into one scan: an array of conditional findings, filtered and exploded. Aggregate rules are
functions from the tables to findings. Which rules there are is the caller's matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEVERITIES = ("INFO", "WARN", "ERROR", "HALT")


@dataclass(frozen=True)
class Rule:
    rule_id: str
    severity: str
    table: str
    needs: tuple[str, ...] = ()
    column: str | None = None
    fires: Callable[[], Column] | None = None
    value: Callable[[], Column] | None = None
    aggregate: Callable[[dict[str, DataFrame]], DataFrame] | None = None


@dataclass
class Registry:
    rules: list[Rule] = field(default_factory=list)

    def row(self, rule_id: str, severity: str, table: str, column: str, needs: tuple[str, ...] = ()) -> Callable:
        """Decorator of a function that gives the condition under which a row has the finding."""

        def add(fn: Callable[[], Column]) -> Callable[[], Column]:
            self.rules.append(Rule(rule_id, severity, table, needs, column, fires=fn))
            return fn

        return add

    def over(self, rule_id: str, severity: str, table: str, needs: tuple[str, ...] = ()) -> Callable:
        """Decorator of a function from the tables to (row_key, column, value)."""

        def add(fn: Callable[[dict[str, DataFrame]], DataFrame]) -> Callable:
            self.rules.append(Rule(rule_id, severity, table, needs, aggregate=fn))
            return fn

        return add

    def run(self, tables: dict[str, DataFrame], keys: dict[str, str]) -> tuple[DataFrame, list[str]]:
        """(findings, ids of rules skipped for a missing input).

        Findings: rule_id, severity, table_name, row_key, column_name, value (text).
        """
        skipped = [r.rule_id for r in self.rules if r.table not in tables or any(n not in tables for n in r.needs)]
        live = [r for r in self.rules if r.rule_id not in skipped]
        out = None
        for name in dict.fromkeys(r.table for r in live):
            fused = [r for r in live if r.table == name and r.fires]
            parts = []
            if fused:
                one = lambda r: F.when(r.fires(), F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.lit(r.column).alias("column_name"), F.col(r.column).cast("string").alias("value")))
                hits = F.filter(F.array(*map(one, fused)), lambda f: f.isNotNull())
                parts.append(tables[name].select(F.lit(name).alias("table_name"), F.col(keys[name]).cast("string").alias("row_key"), F.explode(hits).alias("f")).select("f.rule_id", "f.severity", "table_name", "row_key", "f.column_name", "f.value"))
            for r in live:
                if r.table == name and r.aggregate:
                    found = r.aggregate(tables)
                    parts.append(found.select(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.lit(name).alias("table_name"), F.col("row_key").cast("string").alias("row_key"), F.col("column").alias("column_name"), F.col("value").cast("string").alias("value")))
            for p in parts:
                out = p if out is None else out.unionByName(p)
        return out, skipped


def status(findings: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, status): failed for a HALT, needs_review for an ERROR or WARN, else ok."""
    rank = F.max(F.when(F.col("severity") == "HALT", 2).when(F.col("severity").isin("ERROR", "WARN"), 1).otherwise(0))
    return findings.groupBy(*by).agg(F.count("*").alias("n"), F.when(rank == 2, "failed").when(rank == 1, "needs_review").otherwise("ok").alias("status"))


def reasons(cells: DataFrame, findings: DataFrame, quarantine: DataFrame) -> DataFrame:
    """(table_name, row_key, column_name, reasons, needs_review) of each cell.

    Findings attach at cell, row (no column) and table (no row) level; quarantine at cell level.
    An informational finding is a reason that needs no review.
    """
    tag = F.concat_ws(":", "severity", "rule_id")
    level = lambda rows, keys, name: rows.groupBy(*keys).agg(F.collect_set("t").alias(name))
    f = findings.withColumn("t", tag)
    q = quarantine.select("table_name", "row_key", "column_name", F.concat(F.lit("QUARANTINE:"), F.col("reason")).alias("t"))
    cell = level(f.where("row_key is not null and column_name is not null").select("table_name", "row_key", "column_name", "t").unionByName(q), ["table_name", "row_key", "column_name"], "c")
    row = level(f.where("row_key is not null and column_name is null"), ["table_name", "row_key"], "r")
    wide = level(f.where("row_key is null"), ["table_name"], "w")
    j = cells.join(cell, ["table_name", "row_key", "column_name"], "left").join(row, ["table_name", "row_key"], "left").join(wide, "table_name", "left")
    empty = F.array().cast("array<string>")
    every = F.array_sort(F.array_distinct(F.concat(F.coalesce("c", empty), F.coalesce("r", empty), F.coalesce("w", empty))))
    return j.select("table_name", "row_key", "column_name", every.alias("reasons")).withColumn("needs_review", F.exists("reasons", lambda x: ~x.startswith("INFO:")))
