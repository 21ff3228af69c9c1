"""Named queries of the engine's own operators, over whole tables of the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import expressions as X
from millrace.functions import typed
from millrace.operators import grounding, records, resolve, routing, variants, versions, windows
from millrace.plans import entries, rules
from millrace.session import new_dir, table
from millrace.sources import damaged_lines, reports, sinks
from millrace.sources.store import BucketStore
from millrace.streaming import writer


# ---- windows and arg-max
def w1_latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    """Latest-row view: newest order of each customer, ties by key."""
    return windows.latest_per_key(table(spark, d, "orders"), ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey"))


def w2_argmax_events(spark: SparkSession, d: str) -> DataFrame:
    return windows.arg_max(table(spark, d, "events"), ["user_id", "event_type"], ["event_id", "value"], ["ts", "event_id"])


def w4_consecutive_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return windows.consecutive_distinct(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], ["event_type"]).select("event_id", "user_id", "event_type")


def w5_monotonic(spark: SparkSession, d: str) -> DataFrame:
    return windows.backsteps(table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "l_extendedprice")


def w6_carry_forward(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "events").withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    return windows.carry_forward(seen, ["user_id"], ["ts", "event_id"], "v", "carried").select("event_id", "carried")


def w7_dense_renumber(spark: SparkSession, d: str) -> DataFrame:
    return windows.renumber(table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber"], F.col("l_returnflag") != "R", "new_no").select("l_orderkey", "l_linenumber", "new_no")


def w9_newest_done(spark: SparkSession, d: str) -> DataFrame:
    return windows.first_where(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "F", "newest_done").select("o_orderkey", "newest_done")


def w10_topk(spark: SparkSession, d: str) -> DataFrame:
    return windows.top_k(table(spark, d, "part"), ["p_brand"], 5, F.desc("p_retailprice"), F.asc("p_partkey")).select("p_brand", "p_partkey", "p_retailprice", "rank")


def w11_chosen_variant(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "stg_pump_config").where("source_document is not null and scenario_ordinal is not null")
    return variants.chosen_variant(rows, ["source_document"], "scenario_ordinal", F.when(F.col("is_design_scenario") == "true", 0).otherwise(1))


def v08_contiguous(spark: SparkSession, d: str) -> DataFrame:
    return windows.is_contiguous(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber")


# ---- aggregates
def a1_group_rollup(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "lineitem").select(
        "l_orderkey", F.when(F.col("l_suppkey") % 3 != 0, F.concat(F.lit("M"), F.col("l_suppkey") % 5)).alias("model"), F.concat(F.lit("part "), F.col("l_partkey")).alias("printed"), F.col("l_linenumber").alias("ord"),
        F.col("l_quantity").cast("int").alias("stages"), F.col("l_extendedprice").alias("top"), (F.col("l_extendedprice") + F.col("l_quantity")).alias("bottom"), F.col("l_quantity").cast("int").cast("string").alias("stages_list"),
        F.when(F.col("l_returnflag") == "R", "conflict").when(F.col("l_returnflag") == "A", "validated").otherwise("extracted").alias("status"),
    )
    return variants.roll_up(s, ["l_orderkey"], "model", "printed", "ord")


def a2_variance(spark: SparkSession, d: str) -> DataFrame:
    found = variants.variance(table(spark, d, "stg_pump_config").where("source_document is not null and scenario_ordinal is not null"), ["source_document"], "scenario_ordinal", ["section_order", "config_id"], ["manufacturer", "vendor_family", "stages", "top_md_ft", "section_role"], {"manufacturer": "A", "stages": "B", "section_role": "allowed"})
    return found.select("source_document", "column", "n_values", "tier")


def a4_set_identity(spark: SparkSession, d: str) -> DataFrame:
    return variants.identity_sets(table(spark, d, "orders").withColumn("y", F.year("o_orderdate")), ["o_custkey"], "y", ["o_orderpriority", "o_orderstatus"])


def a5_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupingSets([[F.col("l_returnflag"), F.col("l_linestatus")], [F.col("l_returnflag")], []], F.col("l_returnflag"), F.col("l_linestatus"))
    return rows.agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("qty"))


def a5_rollup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").rollup("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"), F.min("o_orderdate").alias("first_date"))


def a12_agreement(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.length("text").alias("len"))
    j = table(spark, d, "reading_labels").where("reading_level is not null").join(docs, "doc_id")
    return j.groupBy("rater").agg(F.round(F.try_divide(F.count_if((F.col("len") > 800) == (F.col("reading_level") >= 3)).cast("double"), F.count("len")), 6).alias("agreement"), F.count("*").alias("n"))


def a13_percent_delta(spark: SparkSession, d: str) -> DataFrame:
    """Per customer: change in orders between two halves of the calendar; null where the first half is empty."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.count_if(F.month("o_orderdate") <= 6).alias("a"), F.count_if(F.month("o_orderdate") > 6).alias("b"))
    return o.select("o_custkey", "a", "b", F.when(F.col("a") > 0, F.round((F.col("b") - F.col("a")) * 100.0 / F.col("a"), 2)).cast("double").alias("delta"))


def a16_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return routing.fingerprint_clusters(table(spark, d, "documents"), "doc_id", "text", "source")


# ---- typing
_TYPED = {"stages": "int", "housing_count": "int", "top_md_ft": "number", "bottom_md_ft": "number", "is_design_scenario": "bool"}


def _cells(spark: SparkSession, d: str) -> DataFrame:
    rows = typed.unpivot(table(spark, d, "stg_pump_config"), ["config_id"], list(_TYPED))
    return typed.typed_cells(rows, _TYPED)


def typing_parse_scalar(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d).select("config_id", "column", "raw", "value", "unit", "reason")


def typing_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return typed.quarantined(_cells(spark, d)).groupBy("column", "reason").agg(F.count("*").alias("n"), F.min("raw_value").alias("least"))


def typing_observations(spark: SparkSession, d: str) -> DataFrame:
    """Numeric cells of the observations by reason, the head in a pressure unit among the mismatches."""
    cols = {"head_as_printed": "number", "power_as_printed": "number", "frequency_hz_as_printed": "number", "stages_at_observation": "int", "free_gas_at_inlet_pct": "number"}
    cells = typed.typed_cells(typed.unpivot(table(spark, d, "stg_curve_observations"), ["obs_id"], list(cols)), cols)
    return cells.groupBy("column", "reason").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


def typing_props(spark: SparkSession, d: str) -> DataFrame:
    """Open JSON objects: keys outside the legal set come out, with their values."""
    e = table(spark, d, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "raw_value"))
    legal = spark.createDataFrame([("ref",), ("source",)], "key string")
    return e.join(F.broadcast(legal), "key", "left_anti").groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("raw_value").try_cast("long")).alias("total"))


# ---- expressions
def expr_affinity(spark: SparkSession, d: str) -> DataFrame:
    f = F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_linenumber") * 10.0)
    v = lambda p: F.round(X.at_reference_frequency(F.col("l_quantity"), f, p), 6)
    head = F.round(X.per_stage(X.at_reference_frequency(F.col("l_extendedprice"), f, 2), F.col("l_linenumber") - 1, F.when(F.col("l_returnflag") == "R", "per_stage").otherwise("total")), 6)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", v(1).alias("flow60"), head.alias("head60"), v(3).alias("power60"))


def expr_psia(spark: SparkSession, d: str) -> DataFrame:
    p = X.psia(F.col("bubble_point_psi").try_cast("double"), F.col("bubble_point_unit_as_printed"))
    return table(spark, d, "esp_well_design_context").select("context_id", p.alias("p")).select("context_id", F.round("p.value", 6).alias("value"), "p.reason")


def expr_gravity(spark: SparkSession, d: str) -> DataFrame:
    sg = X.gravity_of_api(F.col("oil_api_deg"))
    g = X.implied_gradient(sg, F.lit(1.02), F.col("water_cut_design_frac"))
    return table(spark, d, "esp_well_design_context").select("context_id", F.round(sg, 4).alias("sg"), F.round(g, 4).alias("gradient"))


def expr_surrogate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(X.surrogate_key("obs_", F.col("l_orderkey"), F.col("l_linenumber"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))).alias("id"), "l_orderkey", "l_linenumber")


def expr_run_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", X.run_id(F.col("ts"), F.concat(F.lit("in/"), F.col("user_id"), F.lit(".pdf")), F.col("event_type")).alias("run_id"))


# ---- resolution
_GRAMMAR = {f"F{i}": r"(?i)[a-z]{5}[ -]?\d{3,4}(?:-\d{3,4})?(?: ?[a-z]{1,2})?$" for i in range(1, 8)}


def e1_alias_precedence(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "part").select(F.col("p_brand").alias("family"), F.col("p_name").alias("printed"))
    seed = spark.createDataFrame([("Brand#11", "Part 1", "P1", "sheet", 1), ("Brand#11", "Part 1", "P1B", "sheet", 2), ("Brand#12", "part 2", resolve.COMPOSITE, "sheet", 1)], "f string, p string, c string, b string, o int")
    flags = resolve.learned_flags(spark.createDataFrame([("part 3", "composite", 1), ("Part 3", "not_a_model", 2), ("Part 5", "other", 1)], "p string, flag string, o int"), "p", "flag", ["o"], ["composite", "not_a_model"])
    return resolve.alias_resolve(names, "printed", "family", flags, resolve.seed_table(seed, "f", "p", "c", "b", "o"), {f"Brand#{i}": r"^Part \d+$" for i in range(11, 26)}, ["esp "])


def e1_pump_names(spark: SparkSession, d: str) -> DataFrame:
    """The precedence ladder over the free pump names, by outcome."""
    names = table(spark, d, "stg_pump_config").where("pump_model_as_printed is not null")
    catalogue = table(spark, d, "pump_catalogue")
    seed = resolve.seed_table(catalogue, "vendor_family", "pump_model_canonical", "pump_model_canonical", "curve_basis", "model_id")
    none = spark.createDataFrame([], "printed_key string, flag string")
    return resolve.alias_resolve(names, "pump_model_as_printed", "vendor_family", none, seed, _GRAMMAR, ["pump: ", "pump ", "model "]).groupBy("family", "flag").agg(F.count("*").alias("n"))


def e5_family_free(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "pump_catalogue").select(F.lower(F.trim("pump_model_canonical")).alias("printed_key"), F.col("pump_model_canonical").alias("canonical"), F.col("curve_basis").alias("basis"))
    return resolve.family_free_seed(c)


def e6_catalogue(spark: SparkSession, d: str) -> DataFrame:
    found = resolve.catalogue_lookup(table(spark, d, "stg_pump_config"), "pump_model_as_printed", table(spark, d, "pump_catalogue"), "pump_model_canonical")
    return found.where("printed is not null")


def e9_unknown_models(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "pump_catalogue")
    found = resolve.catalogue_lookup(table(spark, d, "stg_pump_config"), "pump_model_as_printed", c, "pump_model_canonical")
    return resolve.unknown_models(found, c, "pump_model_canonical", "curve_basis").groupBy("class").agg(F.count("*").alias("n"))


def e12_near_names(spark: SparkSession, d: str) -> DataFrame:
    return resolve.near_names(table(spark, d, "stg_pump_config"), "pump_model_as_printed")


# ---- joins and set operations
def j2_fill_or_conflict(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("own"), F.lit("total").alias("target"))
    offers = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.round(F.col("l_extendedprice"), 0).alias("offered"), F.col("l_linenumber").alias("ord"))
    return variants.fill_or_conflict(targets, offers, ["o_orderkey"], "target", "own", "offered", "ord").select("o_orderkey", "ord", "offered", "effective", "disposition")


def _versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").cast("decimal(12,2)").cast("string").alias("bal"))
    new = s.where("name not like '%7'").withColumn("bal", F.when(F.col("name").endswith("3"), F.concat("bal", F.lit(" (usd)"))).when(F.col("name").endswith("4"), F.lit("0.01")).otherwise(F.col("bal")))
    return s, new


def j3_positional_outer(spark: SparkSession, d: str) -> DataFrame:
    return versions.positional(*_versions(spark, d), ["k"], ["name", "bal"]).select("k", "position", F.col("old.name").alias("old_name"), F.col("new.name").alias("new_name"))


def d3_field_diff(spark: SparkSession, d: str) -> DataFrame:
    old, new = _versions(spark, d)
    return versions.field_diffs(versions.positional(old, new, ["name"], ["bal"]), ["name"], ["bal"])


def d5_verdict(spark: SparkSession, d: str) -> DataFrame:
    old, new = _versions(spark, d)
    diffs = versions.field_diffs(versions.positional(old, new, ["k", "name"], ["bal"]), ["k", "name"], ["bal"])
    return versions.verdict(diffs, ["k"])


def d1_align(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "stg_pump_config").select("config_id", "source_document", F.when(F.col("config_id") % 2 == 0, F.col("scenario_ordinal")).alias("ordinal"), F.col("section_role").alias("label"))
    return versions.align(rows, ["source_document"], "ordinal", "label").select("config_id", "variant")


def d7_recheck(spark: SparkSession, d: str) -> DataFrame:
    old, new = _versions(spark, d)
    sheet = old.select("name", F.col("bal").alias("old")).join(new.select("name", F.col("bal").alias("new")), "name")
    now = old.where("name not like '%5'").withColumn("bal", F.when(F.col("name").endswith("4"), F.lit("0.01")).otherwise(F.col("bal")))
    return versions.recheck(now, sheet, ["name"], "bal").groupBy("status").agg(F.count("*").alias("n"))


def j5_greedy_pair(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_brand", F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("size"), F.col("p_partkey").alias("id"))
    return versions.greedy_pairs(p.where("id % 2 = 0"), p.where("id % 2 = 1"), ["p_brand"], ["size"], "id")


def j6_semi(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(o, "c_custkey", "left_semi").select("c_custkey", "c_nationkey")


def j7_anti(spark: SparkSession, d: str) -> DataFrame:
    """Customers none of whose orders is urgent and above 300,000."""
    o = table(spark, d, "orders").where("o_orderpriority like '1%' and o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(o, "c_custkey", "left_anti").select("c_custkey", "c_nationkey")


def j8_grounding(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "page_texts").where("page_text is not null")
    values = pages.select("report_id", F.col("page_id").cast("string").alias("value_id"), F.regexp_extract("page_text", r"checksum (\d+)", 1).alias("value"), F.concat(F.lit("p"), F.col("page_no") - F.col("page_no") % 2).alias("cited"))
    return grounding.ground(values, pages, ["report_id"], "value_id", "value", "cited", "page_no", "page_text")


def j9_ranges(spark: SparkSession, d: str) -> DataFrame:
    cited = F.concat(F.lit("p"), F.col("l_linenumber"), F.lit("-"), F.col("l_linenumber") + 3, F.lit(", p"), F.col("l_quantity").cast("int"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(X.page_numbers(cited), ",").alias("pages"))


def u1_except_all(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").select(F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("s"))
    b = table(spark, d, "orders").where("o_orderkey % 4 <> 0").select(F.when(F.col("o_orderkey") % 10 == 1, "X").otherwise(F.col("o_orderpriority")).alias("p"), F.col("o_orderstatus").alias("s"))
    return versions.multiset_difference(a, b).groupBy("p", "s", "side").agg(F.count("*").alias("n"))


def u2_symmetric(spark: SparkSession, d: str) -> DataFrame:
    """Customers with an order in one state and none in the other."""
    o = table(spark, d, "orders")
    return versions.symmetric_difference(o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")), o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")), "a", "b")


def u3_intersect(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


def u4_union_mixed(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


def k7_upsert(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("state"), F.lit(0).alias("at"))
    changes = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("state"), F.col("o_orderkey").cast("int").alias("at"))
    return sinks.upsert(log, changes, ["c_custkey"], "at")


def o1_key_order(spark: SparkSession, d: str) -> DataFrame:
    """First rows by (length of the key, key), the order of numbers kept as text."""
    keys = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("k"), "p_name")
    return keys.orderBy(F.length("k").desc(), F.desc("k")).limit(10)


# ---- reports, routing, rules, review
def s3_report_rows(spark: SparkSession, d: str) -> DataFrame:
    """Files of raw lines put together as reports, read back as numbered rows of their blocks."""
    return reports.rows(_as_reports(spark, d)).select("report_id", "block", "row_key", F.size("obj").alias("n_keys"))


def _as_reports(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "raw_lines").where("source_file like '%.md' and raw_line is not null and trim(raw_line) not like '```%'")
    body = raw.groupBy("source_file", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line_id", "raw_line"))), lambda x: x["raw_line"]), "\n").alias("body"))
    part = F.concat(F.lit("## "), F.col("block"), F.lit("\n```jsonl\n"), F.col("body"), F.lit("\n```\n"))
    return body.groupBy(F.col("source_file").alias("report_id")).agg(F.concat(F.lit("---\nsource: x\n---\n"), F.array_join(F.array_sort(F.collect_list(part)), "\n")).alias("text"))


def s6_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    return reports.reconciliation(_as_reports(spark, d))


def s4_jsonl(spark: SparkSession, d: str) -> DataFrame:
    lines = damaged_lines.read_lines(table(spark, d, "raw_lines").where("source_file like '%.md'")).where("status <> 'skipped'")
    return lines.groupBy("block").agg(F.count("*").alias("n"), F.count_if(F.col("reason").isin("not_a_record", "truncated_line", "broken_quoting")).alias("n_broken"))


def t1_routing(spark: SparkSession, d: str) -> DataFrame:
    sig = {"A": ["pump model", "checksum"], "B": ["well data", "gas fraction"], "C": ["design summary"]}
    return routing.route(table(spark, d, "page_texts"), "page_id", "page_text", sig)


def t5_keep_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "page_texts").withColumn("order_no", F.struct("page_no", "page_id"))
    return routing.keep_pages(pages, "report_id", "order_no", "roles", "page_text", ["gas_page"]).select("page_id", "role", "kept", "new_no", "low_yield")


def _registry() -> rules.Registry:
    r = rules.Registry()
    r.row("L1", "ERROR", "lineitem", "l_discount")(lambda: F.col("l_discount") > 0.09)
    r.row("L2", "WARN", "lineitem", "l_tax")(lambda: (F.col("l_tax") == 0) & (F.col("l_returnflag") == "R"))
    r.row("L3", "INFO", "lineitem", "l_quantity")(lambda: F.col("l_quantity") >= 50)
    r.row("L4", "WARN", "lineitem", "l_returnflag")(lambda: (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"))
    r.row("O1", "WARN", "orders", "o_totalprice")(lambda: F.col("o_totalprice") < 1000)
    r.row("O2", "INFO", "orders", "o_orderpriority")(lambda: F.col("o_orderpriority").startswith("1"))
    r.row("O3", "HALT", "orders", "o_custkey")(lambda: F.col("o_custkey").isNull())
    r.row("X1", "HALT", "orders", "o_orderkey", needs=("nowhere",))(lambda: F.lit(True))
    r.over("O4", "ERROR", "orders", needs=("lineitem",))(lambda t: t["orders"].join(t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select(F.col("o_orderkey").alias("row_key"), F.lit("o_orderkey").alias("column"), F.col("o_orderkey").alias("value")))
    return r


def _findings(spark: SparkSession, d: str) -> DataFrame:
    return _registry().run({"lineitem": table(spark, d, "lineitem"), "orders": table(spark, d, "orders")}, {"lineitem": "l_orderkey", "orders": "o_orderkey"})[0]


def rule_engine(spark: SparkSession, d: str) -> DataFrame:
    return _findings(spark, d).groupBy("rule_id", "severity", "table_name", "column_name").agg(F.count("*").alias("n"))


def rule_status(spark: SparkSession, d: str) -> DataFrame:
    return rules.status(_findings(spark, d).where("table_name = 'lineitem'"), ["row_key"])


def r1_reasons(spark: SparkSession, d: str) -> DataFrame:
    cells = table(spark, d, "orders").select(F.lit("orders").alias("table_name"), F.col("o_orderkey").cast("string").alias("row_key"), F.lit("o_totalprice").alias("column_name"))
    quarantine = table(spark, d, "orders").where("o_orderkey % 11 = 0").select(F.lit("orders").alias("table_name"), F.col("o_orderkey").cast("string").alias("row_key"), F.lit("o_totalprice").alias("column_name"), F.lit("not_numeric").alias("reason"))
    whole = spark.createDataFrame([("T1", "INFO", "orders", None, None, None)], "rule_id string, severity string, table_name string, row_key string, column_name string, value string")
    out = rules.reasons(cells, _findings(spark, d).unionByName(whole), quarantine)
    return out.select("row_key", F.array_join("reasons", ",").alias("reasons"), "needs_review")


def r4_proposal(spark: SparkSession, d: str) -> DataFrame:
    cells = typed.unpivot(table(spark, d, "stg_pump_config").where("source_document is not null and scenario_ordinal is not null"), ["source_document", "scenario_ordinal"], ["manufacturer", "vendor_family"]).withColumnRenamed("raw", "value")
    least = cells.groupBy("source_document", "scenario_ordinal", "column").agg(F.min("value").alias("value"))
    return entries.proposal(least, ["source_document"], "scenario_ordinal", "1")


def r14_stale(spark: SparkSession, d: str) -> DataFrame:
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    status = F.when(F.col("event_type") == "view", "running").otherwise("completed")
    stale = X.is_stale(status, F.col("ts") + F.expr("interval 15 minutes"), now)
    return table(spark, d, "events").select("event_id", F.when(stale, "stale").otherwise(status).alias("state"))


# ---- record-level operators
def rec_collapse(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").withColumn("open", F.col("o_orderstatus") == "O").withColumn("halt", F.when(F.col("o_custkey") % 5 == 0, F.array(F.lit("o_orderpriority"))).otherwise(F.array().cast("array<string>")))
    return records.collapse(rows, ["o_custkey"], ["o_orderpriority"], ["o_orderdate", "o_orderkey"], ["open"], ["o_totalprice"], F.col("halt"))


def rec_merged_json(spark: SparkSession, d: str) -> DataFrame:
    return records.merged_json(table(spark, d, "events"), ["user_id"], "props", ["ts", "event_id"], "merged")


def rec_preferred(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "stg_pump_config")
    v = records.preferred([("top", F.col("top_md_ft")), ("bottom", F.col("bottom_md_ft"))])
    return t.select("config_id", v.alias("v")).select("config_id", "v.value", "v.source", "v.others")


def rec_envelope(spark: SparkSession, d: str) -> DataFrame:
    unit = F.when(F.col("bubble_point_unit_as_printed").isin("psi", "psia"), "psi").otherwise(F.col("bubble_point_unit_as_printed"))
    p = records.envelope_problem(F.col("bubble_point_psi").try_cast("double"), unit, F.coalesce("bubble_point_provenance", F.lit("document")), F.lit("psi"), ["document", "measured", "correlation", "assumed"])
    return table(spark, d, "esp_well_design_context").select("context_id", p.alias("problem"))


def rec_flattened(spark: SparkSession, d: str) -> DataFrame:
    return records.flattened(table(spark, d, "page_texts").select("page_id", "page_no", "roles"))


def rec_key_parts(spark: SparkSession, d: str) -> DataFrame:
    parts = records.key_parts(F.col("source_file"), r"(wl|rpt)-(\d+)\.(csv|md)", ["kind", "number", "ext"])
    return table(spark, d, "raw_lines").select("source_file").distinct().select("source_file", parts.alias("p")).select("source_file", "p.kind", "p.number", "p.ext")


def rec_keys_like(spark: SparkSession, d: str) -> DataFrame:
    obj = table(spark, d, "events").select("event_id", F.from_json("props", "map<string,string>").alias("o"))
    return records.keys_like(obj, "o", "^k", "event_id").groupBy("key").agg(F.count("*").alias("n"), F.count_distinct("value").alias("n_values"))


def e10_repair_class(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "stg_pump_config").select("pump_model_as_printed").distinct().select("pump_model_as_printed", records.repair_class(F.col("pump_model_as_printed")).alias("r"))
    return names.groupBy("r.kind").agg(F.count("*").alias("n"), F.array_join(F.slice(F.array_sort(F.collect_set("pump_model_as_printed")), 1, 12), "|").alias("examples")).select("kind", "n", "examples")


def e13_without_names(spark: SparkSession, d: str) -> DataFrame:
    return records.without_names(table(spark, d, "well_list"), "well_id", ["Orrin Bench", "isfjell!", "--"]).groupBy("organization_id").agg(F.count("*").alias("n"))


def a11_sum_check(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").cast("decimal(12,1)").cast("string").alias("printed"))
    o = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg((F.sum(F.col("l_quantity").cast("decimal(12,1)")) + F.max(F.when(F.col("l_orderkey") % 4 == 0, 1).otherwise(0))).alias("total"), (F.count("*") + F.max(F.when(F.col("l_orderkey") % 7 == 0, 1).otherwise(0))).alias("expected"))
    return records.sum_check(l, o, ["k"], "printed", "total", "expected")


def a14_poisoned_sum(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(records.poisoned_sum(F.col("n_chars")).alias("total"), F.count("*").alias("n"))


def a18_label_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Ordinals of a document that carry several roles, with the tables that hold them."""
    part = lambda t: table(spark, d, t).select("source_document", "scenario_ordinal", F.col("section_role").alias("label"), F.lit(t).alias("t"))
    return records.label_conflicts(part("stg_pump_config").unionByName(part("stg_pump_config_copy")), ["source_document"], "scenario_ordinal", "label", "t")


def a20_coverage(spark: SparkSession, d: str) -> DataFrame:
    cells = typed.unpivot(table(spark, d, "stg_pump_config").where("vendor_family is not null and source_document is not null"), ["vendor_family", "source_document"], ["manufacturer", "section_role", "stages", "top_md_ft", "stages_per_housing_as_printed"])
    return records.coverage(cells, "vendor_family", "source_document", "column")


def a20_expected_missing(spark: SparkSession, d: str) -> DataFrame:
    cells = typed.unpivot(table(spark, d, "stg_pump_config").where("vendor_family is not null and source_document is not null"), ["vendor_family", "source_document"], ["manufacturer", "section_role", "stages", "top_md_ft"])
    return records.expected_missing(cells, "vendor_family", "source_document", "column", 0.7)


def a22_rates(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.unix_timestamp(F.max("ts")).alias("last"), F.unix_timestamp(F.min("ts")).alias("first"))
    return e.select("user_id", "n", records.rate(F.col("n").cast("double") * 1000, F.col("last"), F.col("first")).alias("per_1000s"))


def w12_misplaced(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "stg_pump_config").withColumn("number", F.col("section_order").try_cast("int"))
    return records.misplaced(rows, ["source_document", "scenario_ordinal"], ["section_order", "config_id"], "number").select("config_id", "position", "misplaced")


def w13_latest_committed(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    done = table(spark, d, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"))
    return records.latest_committed(v, done, ["o_custkey"], "o_orderkey", ["o_orderdate", "o_orderkey"])


def j4_cascade_match(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "lineitem").select((F.col("l_orderkey") % 500).alias("k"), "l_linestatus", F.when(F.col("l_suppkey") % 3 == 0, F.col("l_returnflag")).alias("flag"))
    old, new = a.where("k % 7 <> 0"), a.where("k % 11 <> 0").withColumn("flag", F.when(F.col("k") % 13 == 0, "Z").otherwise(F.col("flag")))
    return records.cascade_match(old, new, ["k", "l_linestatus", "flag"], ["k", "l_linestatus"])


def d8_parity(spark: SparkSession, d: str) -> DataFrame:
    old, new = _versions(spark, d)
    return records.parity(old, new, ["k", "name", "bal"], F.col("name").endswith("3"))


def d9_causes(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "stg_pump_config").groupBy("source_document", F.concat_ws("/", "scenario_ordinal", "section_order").alias("key")).agg(F.min("stages").alias("v")).where("v is not null and source_document is not null")
    new = table(spark, d, "stg_pump_config_copy").groupBy("source_document", F.concat_ws("/", "scenario_ordinal", "section_order").alias("key")).agg(F.min("stages").alias("v")).where("v is not null and source_document is not null")
    return records.causes(old, new, ["source_document"], "key", "v").groupBy("cause").agg(F.count("*").alias("n"))


def d11_new_items(spark: SparkSession, d: str) -> DataFrame:
    now = table(spark, d, "orders")
    before = now.where("o_orderdate < date '1998-01-01'").select("o_custkey", "o_orderpriority").distinct()
    now = now.select("o_custkey", "o_orderpriority").distinct()
    return records.new_items(now, before, ["o_custkey", "o_orderpriority"])


def r17_series(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "stg_curve_observations").select("vendor_family", "point_type", F.replace("flow_as_printed", F.lit(","), F.lit("")).try_cast("double").alias("x"), F.replace("head_as_printed", F.lit(","), F.lit("")).try_cast("double").alias("y"))
    return records.series(t, ["vendor_family", "point_type"], "x", "y")


def r16_queue_state(spark: SparkSession, d: str) -> DataFrame:
    age = F.unix_timestamp(F.lit("2024-01-20").cast("timestamp")) - F.unix_timestamp("ts")
    return table(spark, d, "events").select("event_id", records.queue_state(age, F.col("user_id") % 3, 2).alias("state"))


def r25_unique_labels(spark: SparkSession, d: str) -> DataFrame:
    return records.unique_labels(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", "p_partkey", "label")


# ---- streaming
def _file_stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table of the driver as a file stream, whether it is one file or a folder."""
    t = table(spark, d, name)
    reader = spark.readStream.schema(t.schema)
    whole = f"{d}/{name}.parquet"
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(d) if t.inputFiles() and t.inputFiles()[0].endswith(f"/{name}.parquet") else reader.parquet(whole)


def st_confirm(spark: SparkSession, d: str) -> DataFrame:
    """A file stream of orders as requests: accepted rows once each, refusals with every reason."""
    out = new_dir(spark, "confirm")
    requests = _file_stream(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("confirmation_id"), "o_custkey", "o_totalprice", "o_orderstatus")
    query = writer.confirm_stream(spark, requests, {"customer": "o_custkey is not null", "price": "o_totalprice > 1000", "closed": "o_orderstatus <> 'P'"}, f"{out}/t", f"{out}/c")
    return writer.drain(query, lambda: spark.read.parquet(f"{out}/t/rows").select("confirmation_id", "o_custkey").withColumn("result", F.lit("accepted")).unionByName(spark.read.parquet(f"{out}/t/refused").select("confirmation_id", "o_custkey", F.array_join("problems", ",").alias("result"))))


def st_latest(spark: SparkSession, d: str) -> DataFrame:
    """Last evidence wins over a file stream of events."""
    out, keys = new_dir(spark, "latest"), ["user_id", "event_type"]
    stream = _file_stream(spark, d, "events").select(*keys, "event_id", "value", "ts")
    query = writer.latest_stream(spark, stream, keys, ["ts", "event_id"], f"{out}/t", f"{out}/c")
    return writer.drain(query, lambda: BucketStore(spark, f"{out}/t", keys).read().select(*keys, "event_id", "value"))


def st_close_once(spark: SparkSession, d: str) -> DataFrame:
    """The first event of each user closes the user's request, once."""
    out = new_dir(spark, "closed")
    stream = _file_stream(spark, d, "events").select("user_id", "ts", "event_id")
    query = writer.first_stream(spark, stream, "user_id", "ts", f"{out}/t", f"{out}/c")
    return writer.drain(query, lambda: BucketStore(spark, f"{out}/t", ["user_id"]).read().select("user_id", "ts", "event_id"))


def st_object_records(spark: SparkSession, d: str) -> DataFrame:
    """One record per object version from a stream of its events."""
    out = new_dir(spark, "objects")
    stream = _file_stream(spark, d, "events").select(F.col("ts").cast("timestamp").alias("event_time"), F.concat(F.lit("in/"), F.col("user_id")).alias("key"), F.col("event_type").alias("version"))
    named = writer.object_events(stream, "3650 days").select("run_id", "key", "version")
    query = named.writeStream.format("parquet").option("path", f"{out}/t").option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start()
    return writer.drain(query, lambda: spark.read.parquet(f"{out}/t"))


def st_transcription(spark: SparkSession, d: str) -> DataFrame:
    """Requests by users' first events, results by their purchases, the rest judged at a given moment."""
    e = table(spark, d, "events")
    requests = e.select(F.col("user_id").alias("key"), F.col("ts").alias("requested_at"))
    results = e.where("event_type = 'purchase'").select(F.col("user_id").alias("key"), F.when(F.col("value") > 50, "succeeded").otherwise("failed").alias("state"), F.col("ts").alias("created_at"))
    return writer.transcription_state(requests, results, F.lit("2024-01-20").cast("timestamp"), 7 * 86_400)


_NAMES = ("rec", "w", "v", "a", "typing", "expr", "e", "j", "d", "u", "k", "o", "s", "t", "rule", "r", "st")
QUERIES = {n: f for n, f in list(globals().items()) if callable(f) and not n.startswith("_") and getattr(f, "__module__", "") == __name__ and n.split("_")[0].rstrip("0123456789") in _NAMES}
