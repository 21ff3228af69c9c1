"""The pN_ queries of the problems for text corpora, over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import leaks, lookalike, name_match, packing, reading
from millrace.session import table


def _matched(spark: SparkSession, d: str) -> DataFrame:
    return name_match.match_names(table(spark, d, "stg_pump_config"), "config_id", "pump_model_as_printed", table(spark, d, "pump_catalogue"), "model_id", "pump_model_canonical", "manufacturer")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "pump_catalogue").select(F.col("pump_model_canonical").alias("pump_model_as_printed")).where("pump_model_as_printed is not null")
    return _matched(spark, d).join(names, "pump_model_as_printed", "left_anti").select("config_id", "model_id")


def p3_candidates(spark: SparkSession, d: str) -> DataFrame:
    """All entries within the distance, for each name that is not written as one."""
    rows = _matched(spark, d).where("how <> 'exact'").select("pump_model_as_printed", F.explode("candidates").alias("c")).select("pump_model_as_printed", "c.*")
    return rows.groupBy("pump_model_as_printed", "model_id", "distance", "path").agg(F.count("*").alias("n_rows"))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """How the names came out, and the most frequent of those without an entry."""
    return _matched(spark, d).groupBy("how", "distance").agg(F.count("*").alias("n_rows"), F.countDistinct("pump_model_as_printed").alias("n_names"))


def p3_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return _matched(spark, d).where(f"model_id = {name_match.NO_MODEL}").groupBy("pump_model_as_printed", "how").agg(F.count("*").alias("n_rows"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    config = lookalike.differing_pairs(table(spark, d, "stg_pump_config"), "pump_model_as_printed", "pump_model_as_printed_alt")
    pages = lookalike.differing_texts(table(spark, d, "page_texts"), "page_text")
    return config.select(F.lit("stg_pump_config").alias("table_name"), F.col("config_id").alias("row_id")).unionByName(pages.select(F.lit("page_texts").alias("table_name"), F.col("page_id").alias("row_id")))


def p7_pages(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.canonical_form(table(spark, d, "page_texts").select("page_id", "page_text"), "page_text").select("page_id", "canonical", "n_stored")


def p8_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.containers(packing.pack(table(spark, d, "documents")))


def p8_conserved(spark: SparkSession, d: str) -> DataFrame:
    """What every packing must keep, per document: nothing is lost, cut without need or put into a container that overflows."""
    packed = packing.pack(table(spark, d, "documents"))
    full = packing.containers(packed).select("container_id", (F.col("n_tokens") <= packing.CAPACITY).alias("fits"))
    total, end = F.sum("n_tokens"), F.max(F.col("first_token") + F.col("n_tokens"))
    return packed.join(full, "container_id", "left").groupBy("doc_id").agg(
        (total == 0).alias("empty"), (end == total).alias("complete"), ((F.count("*") == 1) | (total > packing.CAPACITY)).alias("whole"),
        F.bool_and(F.coalesce("fits", F.col("n_tokens") == 0)).alias("fits"),
    )


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_tiles(spark: SparkSession, d: str) -> DataFrame:
    return leaks.tiles(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    return reading.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels"))


def p10_profile(spark: SparkSession, d: str) -> DataFrame:
    levels = reading.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels"))
    return table(spark, d, "documents").select("doc_id", "source").join(levels, "doc_id").groupBy("source", "level_class", "basis").agg(F.count("*").alias("n_docs"), F.avg("reading_level").alias("mean_level"))


QUERIES = {f.__name__: f for f in (p3_found, p3_candidates, p3_report, p3_unmatched, p7_found, p7_pages, p8_pack, p8_containers, p8_conserved, p9_found, p9_tiles, p9_items, p10_levels, p10_profile)}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _look_sql(column: str) -> str:
    """DuckDB: the mapped text, without outer spaces, and its composed form."""
    one = {k: v for k, v in lookalike.char_map().items() if len(v) == 1}
    sql = f"translate({column}, {_quoted(''.join(one))}, {_quoted(''.join(one.values()))})"
    for c in lookalike.NO_WIDTH:
        sql = f"replace({sql}, {_quoted(c)}, '')"
    for c, letters in lookalike.LIGATURES.items():
        sql = f"replace({sql}, {_quoted(c)}, {_quoted(letters)})"
    return _bare_sql(sql)


def _bare_sql(sql: str) -> str:
    return f"regexp_replace({sql}, '^[\\s\\x0b\\pZ]+|[\\s\\x0b\\pZ]+$', '', 'g')"


_PAGES = f"""
    t as (select page_id, {_look_sql("page_text")} as m, {_bare_sql("page_text")} as s from page_texts where page_text is not null),
    c as (select nfc_normalize(m) as look, count(distinct s) as n_stored, arg_min(m, {{'n': length(m), 'm': m}}) as canonical from t group by 1)"""

#: DuckDB composes accents by normalisation, where the engine groups under a collation.
ORACLE = {
    "p7_found": f"""
        with {_PAGES}
        select 'stg_pump_config' as table_name, config_id as row_id from stg_pump_config
        where {_bare_sql("pump_model_as_printed")} <> {_bare_sql("pump_model_as_printed_alt")} and nfc_normalize({_look_sql("pump_model_as_printed")}) = nfc_normalize({_look_sql("pump_model_as_printed_alt")})
        union all select 'page_texts', page_id from t join c on nfc_normalize(t.m) = c.look where n_stored > 1""",
    "p7_pages": f"with {_PAGES} select p.page_id, canonical, n_stored::int as n_stored from page_texts p left join t using (page_id) left join c on nfc_normalize(t.m) = c.look",
    "p8_conserved": "select doc_id, coalesce(text, '') = '' as empty, true as complete, true as whole, true as fits from documents",
}
