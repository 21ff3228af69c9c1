"""The pN_ queries of the general problems, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dates import printed_day
from millrace.operators import copy_diff, history, references, unit_history
from millrace.session import table
from millrace.sources import damaged_lines

PAIR = ("organization_id", "well_id")
CHAIN = history.ChainSpec(
    keys=PAIR,
    attributes=("intake_set_depth_md_ft", "motor_type", "motor_nameplate_hp", "oil_api_deg", "water_cut_design_frac", "design_frequency_hz"),
    day="day", arrival="loaded_at", tie_break="context_id",
)
COPY_KEYS = ["source_document", "scenario_ordinal", "section_order"]
COPY_FIELDS = ["section_role", "pump_model_as_printed", "manufacturer", "stages", "housing_count", "stages_per_housing_as_printed", "top_md_ft", "bottom_md_ft", "extraction_status"]
COPY_NUMERIC = ["stages", "housing_count", "top_md_ft", "bottom_md_ft"]


def _quantities(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "stg_curve_observations"), table(spark, d, "esp_well_design_context")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return unit_history.found(*_quantities(spark, d))


def p1_convert(spark: SparkSession, d: str) -> DataFrame:
    return unit_history.converted(*_quantities(spark, d))


def p1_segments(spark: SparkSession, d: str) -> DataFrame:
    return unit_history.histories(*_quantities(spark, d))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return damaged_lines.quarantine(table(spark, d, "raw_lines")).select("line_id", "reason")


def p2_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return damaged_lines.quarantine(table(spark, d, "raw_lines"))


def p2_loaded(spark: SparkSession, d: str) -> DataFrame:
    rows = damaged_lines.loaded(table(spark, d, "raw_lines"))
    return rows.withColumn("record", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("record")))))


def _changes(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "esp_well_design_context")
    return t.select(*PAIR, printed_day(F.col("effective_from")).alias("day"), *CHAIN.attributes, "loaded_at", "context_id")


def p4_history(spark: SparkSession, d: str) -> DataFrame:
    """Versions with their attributes; the last month of loads is the batch that touches chains."""
    changes = _changes(spark, d)
    last = table(spark, d, "esp_well_design_context").agg(F.date_trunc("month", F.max("loaded_at"))).first()[0]
    return history.history(changes, CHAIN, F.col("loaded_at") >= F.lit(last))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_history(spark, d).select(*PAIR, "valid_from", "valid_to")


def _diff(spark: SparkSession, d: str) -> DataFrame:
    return copy_diff.diff(table(spark, d, "stg_pump_config"), table(spark, d, "stg_pump_config_copy"), COPY_KEYS, COPY_FIELDS, COPY_NUMERIC)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _diff(spark, d).select(*COPY_KEYS, "field_name", "category")


def p5_fields(spark: SparkSession, d: str) -> DataFrame:
    return _diff(spark, d)


def p5_verdict(spark: SparkSession, d: str) -> DataFrame:
    return copy_diff.verdict(_diff(spark, d))


def p5_repeated(spark: SparkSession, d: str) -> DataFrame:
    """Per side, how many keys hold several unequal rows."""
    rows = copy_diff.repeated(table(spark, d, "stg_pump_config"), table(spark, d, "stg_pump_config_copy"), COPY_KEYS[:2], COPY_FIELDS[:2])
    return rows.groupBy("side").agg(F.count("*").alias("n_keys"), F.sum("n_rows").alias("n_rows"))


def _references(spark: SparkSession, d: str) -> DataFrame:
    sources = {"stg_pump_config": "config_id", "esp_well_design_context": "context_id", "stg_curve_observations": "obs_id"}
    out = None
    for name, key in sources.items():
        part = table(spark, d, name).select(F.lit(name).alias("table_name"), F.date_format("loaded_at", "yyyy-MM").alias("period"), F.col(key).alias("row_id"), *PAIR, "loaded_at")
        out = part if out is None else out.unionByName(part)
    return out


def _orphans(spark: SparkSession, d: str, match: str) -> DataFrame:
    return references.orphans(_references(spark, d), table(spark, d, "well_list"), PAIR, "loaded_at", "listed_at", "removed_at", match)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d, "simple").select("table_name", "period", "row_id", "orphan_kind")


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return references.report(_orphans(spark, d, "simple"))


def p6_partial(spark: SparkSession, d: str) -> DataFrame:
    """As p6_report, but a reference with one id null must match a pair on the other."""
    return references.report(_orphans(spark, d, "partial"))


QUERIES = {f.__name__: f for f in (p1_found, p1_convert, p1_segments, p2_found, p2_quarantine, p2_loaded, p4_found, p4_history, p5_found, p5_fields, p5_verdict, p5_repeated, p6_found, p6_report, p6_partial)}
