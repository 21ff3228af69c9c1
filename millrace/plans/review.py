"""Named queries of review, entry, comparison and guards, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import expressions as X
from millrace.functions import text as T
from millrace.functions import typed
from millrace.operators import compare, entry, records, resolve, routing, variants, versions
from millrace.plans import entries, guards
from millrace.plans.oracle import CELLS as _CELLS
from millrace.plans.oracle import ORACLE as BASE
from millrace.session import table
from millrace.sources import reports, runs

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with its twin."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add


# ---- values of a record, proposed and reviewed
_LEAST = f"""{_CELLS},
    least as (select source_document, scenario_ordinal, "column", min(raw) as raw from cells join stg_pump_config using (config_id) where source_document is not null and scenario_ordinal is not null and "column" in ('stages', 'top_md_ft') group by all),
    known as (select distinct "column", raw, case when reason is null then value end as value from cells),
    staged as (select * from least join known using ("column", raw)),
    single as (select source_document, "column", arg_min(raw, {{'o': scenario_ordinal <> '1', 'l': length(scenario_ordinal), 'v': scenario_ordinal}}) as printed,
        arg_min({{'v': value}}, {{'o': scenario_ordinal <> '1', 'l': length(scenario_ordinal), 'v': scenario_ordinal}}).v as value, count(distinct value) as n, string_agg(scenario_ordinal || '=' || raw, '; ' order by scenario_ordinal || '=' || raw) as all_printed from staged group by all),
    r18 as (select source_document, "column", printed, value, concat_ws(',', case when value is null then 'value_not_typed' end, case when n > 1 then 'varies_by_scenario' end) as reasons, all_printed from single)"""


def _single(spark: SparkSession, d: str) -> DataFrame:
    cells = typed.unpivot(table(spark, d, "stg_pump_config").where("source_document is not null and scenario_ordinal is not null"), ["source_document", "scenario_ordinal"], ["stages", "top_md_ft"])
    staged = cells.groupBy("source_document", "scenario_ordinal", "column").agg(F.min("raw").alias("raw"))
    return entry.single_values(staged, ["source_document"], "scenario_ordinal", "1", {"stages": "int", "top_md_ft": "number"})


@query(f"with {_LEAST} select * from r18")
def r18_single_values(spark: SparkSession, d: str) -> DataFrame:
    return _single(spark, d).withColumn("reasons", F.array_join("reasons", ","))


@query(f"""
    with {_LEAST}
    select source_document, count_if(value is not null)::bigint as n_written, count_if(reasons = '')::bigint as n_settled, count_if(reasons <> '')::bigint as n_to_check, count_if(reasons <> '') = 0 as nothing_to_check,
        coalesce(string_agg(case when value is not null then "column" end, ',' order by "column"), '') as keys from r18 group by source_document""")
def r5_entries(spark: SparkSession, d: str) -> DataFrame:
    """Entries by record: the keys written into them and the tally of what is left to check."""
    made = entry.assembled(entry.reviewed(_single(spark, d), {"stages": "count", "top_md_ft": "ft"}), ["source_document"])
    keys = F.map_keys(F.from_json("entry", "map<string,struct<value: double, unit: string>>"))
    return made.select("source_document", F.size(keys).cast("long").alias("n_written"), "n_settled", "n_to_check", "nothing_to_check", F.array_join(keys, ",").alias("keys"))


@query("""
    select r as source_document, key, case when key = 'design_document_ref' then 'settled' else 'to_check' end as status, case when key <> 'design_document_ref' then 'entered_by_hand' end as reason
    from (select distinct report_id as r from page_texts where report_id is not null and report_id not in (select source_document from stg_pump_config where source_document is not null)), (values ('stages'), ('top_md_ft'), ('design_document_ref')) k(key)""")
def r8_empty_proposals(spark: SparkSession, d: str) -> DataFrame:
    """The empty entry of every report that no pump row was read from."""
    read = table(spark, d, "stg_pump_config").select("source_document")
    none = table(spark, d, "page_texts").where("report_id is not null").select(F.col("report_id").alias("source_document")).join(read, "source_document", "left_anti")
    return entry.empty_proposal(none, ["source_document"], ["stages", "top_md_ft", "design_document_ref"], ["design_document_ref"])


# ---- the string of sections
_SECTIONS = f"""
    e6 as ({BASE["e6_catalogue"]}),
    s as (select source_document, scenario_ordinal, config_id, row_number() over (partition by source_document, scenario_ordinal order by section_order nulls first, config_id)::int as position, try_cast(section_order as int) as number,
        case when regexp_full_match(trim(stages), '[0-9]+') then try_cast(trim(stages) as bigint) end as stages, stages_per_housing_as_printed as list, extraction_status as status, pump_model_as_printed as printed from stg_pump_config where source_document is not null),
    sections as (select s.*, coalesce(how, 'none') as how, case when regexp_full_match(list, '[0-9]+(, ?[0-9]+)*') then list_sum(list_transform(string_split(list, ','), lambda x: trim(x)::bigint))::bigint end as list_sum from s left join e6 on s.printed = e6.printed),
    c as (select source_document, count(*) as n, count_if(number is distinct from position) as misplaced, count_if(list_sum <> stages) as unequal, count(list_sum) as lists, count_if(status = 'needs_review') as conflicts,
        count_if(how in ('none', 'ambiguous')) as unresolved, count_if(number is null or not coalesce(stages >= 1, false)) as incomplete from sections group by 1),
    docs as (select source_document from stg_pump_config where source_document is not null union select report_id from page_texts where report_id is not null),
    j as (select docs.source_document, coalesce(n, 0) as n, * exclude (n, source_document) from docs left join c using (source_document)),
    checks as (
        select source_document, 'sections' as "check", case when n > 0 then 'pass' else 'fail' end as result from j
        union all select source_document, 'order', case when n = 0 then 'not_run' when misplaced > 0 then 'fail' else 'pass' end from j
        union all select source_document, 'arithmetic', case when not coalesce(lists > 0, false) then 'not_run' when unequal > 0 then 'fail' else 'pass' end from j
        union all select source_document, 'conflict', case when coalesce(conflicts, 0) > 0 then 'fail' else 'pass' end from j
        union all select source_document, 'models', case when n = 0 then 'not_run' when unresolved > 0 then 'fail' else 'pass' end from j
        union all select source_document, 'complete', case when n = 0 then 'not_run' when incomplete > 0 then 'fail' else 'pass' end from j)"""


def _sections(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "stg_pump_config").where("source_document is not null").withColumn("number", F.col("section_order").try_cast("int"))
    placed = records.misplaced(rows, ["source_document", "scenario_ordinal"], ["section_order", "config_id"], "number")
    matched = resolve.catalogue_lookup(rows, "pump_model_as_printed", table(spark, d, "pump_catalogue"), "pump_model_canonical").select(F.col("printed").alias("pump_model_as_printed"), "how")
    parts = F.transform(typed.parse_list(F.col("stages_per_housing_as_printed")), lambda x: x.try_cast("long"))
    listed = F.when(F.col("stages_per_housing_as_printed").rlike(r"^[0-9]+(?:, ?[0-9]+)*$"), F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x))
    whole = F.when(F.trim("stages").rlike("^[0-9]+$"), F.trim("stages").try_cast("long"))
    return placed.join(matched, "pump_model_as_printed", "left").select("source_document", "scenario_ordinal", "config_id", "position", "number", whole.alias("stages"), listed.alias("list_sum"), F.col("extraction_status").alias("status"), F.coalesce("how", F.lit("none")).alias("how"))


def _all_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "stg_pump_config").where("source_document is not null").select("source_document").union(table(spark, d, "page_texts").where("report_id is not null").select("report_id"))


@query(f"""
    with {_SECTIONS} select config_id, concat_ws(',', case when how = 'ambiguous' then 'model_ambiguous' when how = 'none' then 'model_absent' end, case when not coalesce(number = position, false) then 'order_not_position' end,
        case when not coalesce(stages >= 1, false) then 'no_stages' end) as reasons from sections""")
def r20_sections(spark: SparkSession, d: str) -> DataFrame:
    return _sections(spark, d).select("config_id", F.array_join(entry.section_reasons(F.col("config_id"), "how", "number", "position", "stages"), ",").alias("reasons"))


@query(f"with {_SECTIONS} select * from checks")
def r6_string_checks(spark: SparkSession, d: str) -> DataFrame:
    return entry.string_checks(_all_documents(spark, d), _sections(spark, d), ["source_document"])


@query(f"""
    with {_SECTIONS} select source_document, case when bool_or(result = 'fail' and "check" = 'order') then 'blocks' when bool_or(result = 'fail') then 'to_check' else 'settled' end as status,
        coalesce(string_agg(case when result = 'fail' then "check" end, ',' order by "check"), '') as failed from checks group by source_document""")
def r6_string_status(spark: SparkSession, d: str) -> DataFrame:
    return entry.string_status(r6_string_checks(spark, d), ["source_document"], ["order"])


@query(f"""
    with {_SECTIONS} select source_document, scenario_ordinal, count(number) > 0 and min(number) = 1 and max(number) = count(number) and count(distinct number) = count(number) as contiguous, count(stages) as n_stages, sum(stages)::bigint as total from sections group by all""")
def r26_final_sections(spark: SparkSession, d: str) -> DataFrame:
    """Typed sections put back as staging rows, and the staging checks run on them again."""
    rows = entry.as_staging(_sections(spark, d), ["source_document", "scenario_ordinal"], ["number", "stages"])
    n, s = F.element_at("obj", F.lit("number")).try_cast("int"), F.element_at("obj", F.lit("stages")).try_cast("long")
    return rows.select("source_document", "scenario_ordinal", n.alias("n"), s.alias("s")).groupBy("source_document", "scenario_ordinal").agg(
        ((F.count("n") > 0) & (F.min("n") == 1) & (F.max("n") == F.count("n")) & (F.count_distinct("n") == F.count("n"))).alias("contiguous"), F.count("s").alias("n_stages"), F.sum("s").alias("total")
    )


@query(f"""
    with {_SECTIONS}, g as (select source_document, scenario_ordinal, coalesce(case when how in ('exact', 'case', 'key') then e.match end, 'printed: ' || s.printed) as model_key, s.stages from sections s left join e6 e on s.printed = e.printed)
    select source_document, scenario_ordinal, model_key, count(*) as members, nullif(sum(stages), 0)::bigint as stages from g group by all""".replace("case when how in", "case when s.how in"))
def r19_scenario_strings(spark: SparkSession, d: str) -> DataFrame:
    """Each scenario's string of sections grouped by model, with how many rows stand behind each."""
    t = table(spark, d, "stg_pump_config").where("source_document is not null")
    found = resolve.catalogue_lookup(t, "pump_model_as_printed", table(spark, d, "pump_catalogue"), "pump_model_canonical").select(F.col("printed").alias("pump_model_as_printed"), F.col("match").alias("model"))
    stages = F.when(F.trim("stages").rlike("^[0-9]+$"), F.trim("stages").try_cast("long"))
    rows = t.withColumn("n", stages).join(found, "pump_model_as_printed", "left").select("source_document", "scenario_ordinal", "model", F.col("pump_model_as_printed").alias("printed"), F.col("section_order").try_cast("int").alias("ord"), F.col("n").alias("stages"), F.lit(None).cast("double").alias("top"), F.lit(None).cast("double").alias("bottom"), F.lit("").alias("stages_list"), F.col("extraction_status").alias("status"))
    return variants.roll_up(rows, ["source_document", "scenario_ordinal"], "model", "printed", "ord").select("source_document", "scenario_ordinal", "model_key", F.col("housings").alias("members"), "stages")


@query("""
    select config_id, coalesce(nullif(trim(scenario_ordinal), ''), nullif(trim(section_role), ''), cast(row_number() over (partition by source_document order by config_id) as varchar)) as variant
    from (select * replace (case when config_id % 3 = 0 then scenario_ordinal end as scenario_ordinal, case when config_id % 2 = 0 then section_role end as section_role) from stg_pump_config)""")
def w3_variant_key(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "stg_pump_config").select("config_id", "source_document", F.when(F.col("config_id") % 3 == 0, F.col("scenario_ordinal")).alias("o"), F.when(F.col("config_id") % 2 == 0, F.col("section_role")).alias("l"))
    return entry.position_ranks(rows, ["source_document"], F.col("config_id")).select("config_id", variants.variant_key(F.col("o"), F.col("l"), F.col("rank")).alias("variant"))


# ---- requests, refusals and rows, over orders put into values of customers
_REQUESTS = """
    proposed as (select o_custkey, o_orderpriority as key, min(o_orderstatus) as value, case when count(*) > 4 then 'blocks' when count(*) > 2 then 'to_check' else 'settled' end as status, count(*) as n from orders group by all),
    overrides as (select o_custkey, key, case when o_custkey % 10 <> 0 then 'X' end as final from proposed where o_custkey % 5 = 0 and key like '1%'),
    req as (select p.o_custkey, p.key, p.value, p.status as was, p.n,
        case when o.key is not null then o.final else p.value end as final,
        case when o.key is not null then 'corrected' when p.n = 2 and p.key like '2%' then 'to_check' when p.status = 'blocks' then case when p.o_custkey % 3 = 0 then 'settled' else 'to_check' end when p.status = 'to_check' and p.o_custkey % 2 = 0 then 'to_check' else 'settled' end as status,
        case when o.key is not null then 'set by hand' when p.n = 2 and p.key like '2%' then 'left to check' when p.status = 'blocks' then case when p.o_custkey % 3 = 0 then 'accepted anyway' else 'blocks publish' end when p.status = 'to_check' and p.o_custkey % 2 = 0 then 'not confirmed' else 'as proposed' end as why
        from proposed p left join overrides o on o.o_custkey = p.o_custkey and o.key = p.key),
    given as (select o_custkey, key, case when o_custkey % 7 = 0 then 'W' else final end as final, status, o_custkey % 3 = 0 as accepted from req where not (o_custkey % 11 = 0 and key like '3%')
        union all select distinct o_custkey, '9-EXTRA', 'F', 'settled', false from proposed where o_custkey % 13 = 0),
    r as (select coalesce(p.o_custkey, g.o_custkey) as o_custkey, coalesce(p.key, g.key) as key, unnest([
            case when g.key is null then 'missing: ' end, case when p.key is null then 'extra: ' end, case when p.key is not null and g.status = 'to_check' then 'left to check: ' end,
            case when p.key is not null and g.key is not null and g.status <> 'corrected' and g.final is distinct from p.value then 'unmarked change: ' end,
            case when p.key is not null and g.key is not null and p.status = 'blocks' and g.status <> 'corrected' and not g.accepted then 'blocks: ' end,
            case when g.final is not null and g.final not in ('F', 'O', 'P') then 'not a known spelling: ' end]) as what
        from proposed p full join given g on g.o_custkey = p.o_custkey and g.key = p.key)"""


def _proposed(spark: SparkSession, d: str) -> DataFrame:
    n = F.count("*")
    return table(spark, d, "orders").groupBy("o_custkey", F.col("o_orderpriority").alias("key")).agg(F.min("o_orderstatus").alias("value"), F.when(n > 4, "blocks").when(n > 2, "to_check").otherwise("settled").alias("status"), n.alias("n"))


def _requests(spark: SparkSession, d: str) -> DataFrame:
    p = _proposed(spark, d)
    overrides = p.where("o_custkey % 5 = 0 and key like '1%'").select("o_custkey", "key", F.when(F.col("o_custkey") % 10 != 0, "X").alias("final"))
    return entry.build_requests(p, ["o_custkey"], overrides, (F.col("n") == 2) & F.col("key").startswith("2"), F.col("o_custkey") % 2 != 0, F.col("o_custkey") % 3 == 0)


def _given(spark: SparkSession, d: str) -> DataFrame:
    asked = _requests(spark, d).where(~((F.col("o_custkey") % 11 == 0) & F.col("key").startswith("3")))
    asked = asked.select("o_custkey", "key", F.when(F.col("o_custkey") % 7 == 0, "W").otherwise(F.col("final")).alias("final"), "status", (F.col("o_custkey") % 3 == 0).alias("accepted"))
    extra = _proposed(spark, d).where("o_custkey % 13 = 0").select("o_custkey").distinct().select("o_custkey", F.lit("9-EXTRA").alias("key"), F.lit("F").alias("final"), F.lit("settled").alias("status"), F.lit(False).alias("accepted"))
    return asked.unionByName(extra)


@query(f"with {_REQUESTS} select o_custkey, key, final, status, why, was || ' > ' || status as history from req")
def r22_requests(spark: SparkSession, d: str) -> DataFrame:
    return _requests(spark, d)


@query(f"with {_REQUESTS} select o_custkey, coalesce(string_agg(what || key, ',' order by what || key), '') as reasons from r group by o_custkey")
def r10_refusals(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "orders").select("o_orderstatus").distinct()
    return entry.refusals(_given(spark, d), _proposed(spark, d), ["o_custkey"], names).select("o_custkey", F.array_join("reasons", ",").alias("reasons"))


@query(f"""with {_REQUESTS} select o_custkey, '{{' || coalesce(string_agg(case when final is not null then '"' || key || '":"' || final || '"' end, ',' order by key), '') || '}}' as finals, count(final) as n_keys from req group by o_custkey""")
def r11_rows(spark: SparkSession, d: str) -> DataFrame:
    return entry.built_rows(_requests(spark, d), ["o_custkey"])


@query(f"with {_REQUESTS} select o_custkey, key, value as proposed, was as starting_status, final, status, final is distinct from value as changed from req")
def r12_versions(spark: SparkSession, d: str) -> DataFrame:
    return entry.version_record(_requests(spark, d), _proposed(spark, d), ["o_custkey"])


@query(f"""
    with {_REQUESTS}, e as (select o_custkey, key, case when o_custkey % 5 = 0 then 'correction' else 'settlement' end as kind, case when o_custkey % 4 = 0 then 'old' else value end as proposed, 'F' as final from proposed)
    select e.o_custkey, e.key, kind, e.final, p.value is distinct from e.proposed as moved from e join proposed p on p.o_custkey = e.o_custkey and p.key = e.key where kind = 'correction' or p.value is not distinct from e.proposed""")
def r13_carried(spark: SparkSession, d: str) -> DataFrame:
    p = _proposed(spark, d)
    earlier = p.select("o_custkey", "key", F.when(F.col("o_custkey") % 5 == 0, "correction").otherwise("settlement").alias("kind"), F.when(F.col("o_custkey") % 4 == 0, "old").otherwise(F.col("value")).alias("proposed"), F.lit("F").alias("final"))
    return entries.carried_decisions(earlier, p, ["o_custkey", "key"])


@query(f"with {_REQUESTS} select case when status = 'corrected' and final is null then 'emptied' when status = 'corrected' then 'corrected' when status = 'to_check' then 'left' else 'accepted' end as \"case\", count(*) as n from req group by 1")
def a6_tally(spark: SparkSession, d: str) -> DataFrame:
    corrected = F.col("status") == "corrected"
    return entry.tally(_requests(spark, d), [("emptied", corrected & F.col("final").isNull()), ("corrected", corrected), ("left", F.col("status") == "to_check")], [], "accepted")


@query(f"""
    with {_REQUESTS} select key, case when final is null then 'not_found' when status <> 'to_check' then 'decided' else 'found' end as "case", count(*) as n, count_if(status = 'to_check')::bigint as n_left from req group by all""")
def a7_groups(spark: SparkSession, d: str) -> DataFrame:
    """Values routed to their group on the page, and how many of each are left."""
    rows = _requests(spark, d)
    cases = [("not_found", F.col("final").isNull()), ("decided", F.col("status") != "to_check")]
    left = entry.tally(rows.where("status = 'to_check'"), cases, ["key"], "found").withColumnRenamed("n", "n_left")
    return entry.tally(rows, cases, ["key"], "found").join(left, ["key", "case"], "left").fillna(0, ["n_left"])


@query("""
    select event_id, 'rows/environment=' || event_type || '/' || event_id || '.json' as row_key, 'versions/' || sha256(user_id::varchar) || '/' || event_id || '.json' as version_key, 'results/' || event_id || '.json' as result_key,
        event_type in ('purchase') or (event_type = 'view' and ts + interval 1 day < timestamp '2024-01-20') as ended from events""")
def r23_object_keys(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    keys = entry.object_keys(F.col("event_type"), F.col("event_id").cast("string"), F.sha2(F.col("user_id").cast("string"), 256))
    status = F.when(F.col("event_type") == "purchase", "succeeded").when(F.col("event_type") == "view", "running").otherwise("unknown")
    ended = entry.has_ended(status, F.col("ts") + F.expr("interval 1 day"), F.lit("2024-01-20").cast("timestamp"))
    return e.select("event_id", keys.alias("k"), ended.alias("ended")).select("event_id", "k.*", "ended")


@query(f"with {_REQUESTS} select o_custkey, bool_or(status = 'corrected' and final is not null) as entered from req group by o_custkey")
def r24_entered(spark: SparkSession, d: str) -> DataFrame:
    return entry.anything_entered(_requests(spark, d), ["o_custkey"])


@query("""
    with u as (select user_id, min(ts) as moment from events group by 1),
    r as (select o_custkey, max(o_orderdate) as moment, arg_max(o_orderstatus, {'d': o_orderdate, 'k': o_orderkey}) as s from orders group by 1)
    select 'r' || o_custkey as run_id, case when s = 'O' and moment + interval 8400 day < timestamp '2024-01-20' then 'stale' when s = 'O' then 'running' else 'completed' end as state from r
    union all select 'r' || user_id, case when floor(epoch(timestamp '2024-01-20')) - floor(epoch(moment)) <= 864000 then 'waiting' else 'no_record' end from u where user_id not in (select o_custkey from r)""")
def r15_run_list(spark: SparkSession, d: str) -> DataFrame:
    """Customers with orders as runs, users without one as uploads that wait or are lost."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("at"), F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("s"))
    run = lambda c: F.concat(F.lit("r"), F.col(c))
    rs = o.select(run("o_custkey").alias("run_id"), F.when(F.col("s") == "O", "running").otherwise("completed").alias("status"), F.col("at").alias("started_at"), (F.col("at") + F.expr("interval 8400 days")).alias("deadline_at"))
    ups = table(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("uploaded_at")).select(run("user_id").alias("run_id"), "uploaded_at")
    return runs.run_list(rs, ups, F.lit("2024-01-20").cast("timestamp"), 864_000).select("run_id", "state")


@query("""
    with own as (select user_id, event_type, max(event_id) as own from events where value is not null group by all), other as (select user_id, max(event_id) as other from events where value is not null group by 1)
    select e.event_id, own, other from events e left join own using (user_id, event_type) left join other using (user_id)""")
def j12_confirm_state(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return entry.confirm_state(e.select(F.col("event_id").alias("run"), "user_id", "event_type"), e.where("value is not null").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], ["user_id"], ["event_id"]).select(F.col("run").alias("event_id"), "own", "other")


@query("""
    with n as (select sha256(page_text) as h, extraction_run as r, max(page_id) as page_id from page_texts where page_text is not null group by all)
    select a.h as document, a.page_id as template_id, b.page_id as generic_id from n a join n b on a.h = b.h and a.r = 'a1' and b.r = 'a2'""")
def j11_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Newest page of a text and run, the one run's paired with the other's."""
    p = table(spark, d, "page_texts").where("page_text is not null").groupBy(F.sha2("page_text", 256).alias("document"), "extraction_run").agg(F.max("page_id").alias("id"))
    side = lambda run, name: p.where(F.col("extraction_run") == run).select("document", F.col("id").alias(name))
    return side("a1", "template_id").join(side("a2", "generic_id"), "document")


# ---- resolution
@query("""
    select obs_id, coalesce(nullif(trim(scenario_title_as_printed), ''), nullif(trim(pump_model_as_printed), ''), nullif(trim(point_type), '')) as first from stg_curve_observations""")
def e8_first_filled(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "stg_curve_observations").select("obs_id", resolve.first_filled("scenario_title_as_printed", "pump_model_as_printed", "point_type").alias("first"))


@query("""
    with k as (select obs_id, source_document as s, pump_model_as_printed as n, regexp_replace(lower(pump_model_as_printed), '[^\\pL\\pN]', '', 'g') as x from stg_curve_observations where source_document is not null),
    p as (select source_document as s, config_id, pump_model_as_printed as n, regexp_replace(lower(pump_model_as_printed), '[^\\pL\\pN]', '', 'g') as y from stg_pump_config)
    select k.obs_id, arg_min(p.config_id, p.config_id) as config_id from k left join p on p.s = k.s and (p.n = k.n or (x <> '' and y <> '' and (starts_with(x, y) or starts_with(y, x)))) group by k.obs_id""")
def e11_same_model(spark: SparkSession, d: str) -> DataFrame:
    """For each curve point the first section of its document that names the same model."""
    o = table(spark, d, "stg_curve_observations").where("source_document is not null").select("obs_id", "source_document", F.col("pump_model_as_printed").alias("a"))
    p = table(spark, d, "stg_pump_config").select("source_document", "config_id", F.col("pump_model_as_printed").alias("b"))
    return entry.first_match(o, p, ["source_document"], resolve.same_model(F.col("a"), F.col("b")), "obs_id", "config_id", "config_id")


@query("""
    with c as (select lower(trim(pump_model_canonical)) as k, vendor_family as f, model_id, pump_model_canonical as m from pump_catalogue), fam as (select f, k, arg_max(m, model_id) as m from c group by all), one as (select k, min(m) as m from fam group by k having count(distinct m) = 1)
    select s.config_id, case when s.vendor_family = 'generic' then one.m else fam.m end as canonical from stg_pump_config s left join one on one.k = lower(trim(pump_model_as_printed)) left join fam on fam.f = s.vendor_family and fam.k = lower(trim(pump_model_as_printed))""")
def e14_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Each row by the lookup of its family, generic ones by the names that mean one model in all families."""
    c = table(spark, d, "pump_catalogue")
    seed = resolve.seed_table(c, "vendor_family", "pump_model_canonical", "pump_model_canonical", "curve_basis", "model_id")
    return resolve.by_lookup(table(spark, d, "stg_pump_config"), "config_id", "pump_model_as_printed", "vendor_family", "generic", seed).select("config_id", "canonical")


@query(f"""
    with e6 as ({BASE["e6_catalogue"]}), p as (select config_id, pump_model_as_printed as a, pump_model_as_printed_alt as b from stg_pump_config where pump_model_as_printed is not null and pump_model_as_printed_alt is not null and pump_model_as_printed <> pump_model_as_printed_alt),
    c as (select distinct pump_model_canonical as m, lower(trim(pump_model_canonical)) as ck, regexp_replace(lower(pump_model_canonical), '[^\\pL\\pN]', '', 'g') as key from pump_catalogue where pump_model_canonical is not null),
    alt as (select distinct b from p), h as (select b, coalesce((select list(m) from c where m = b), (select list(m) from c where ck = lower(trim(b))), (select list(m) from c where key = nullif(regexp_replace(lower(b), '[^\\pL\\pN]', '', 'g'), ''))) as hits from alt)
    select case when x.match is not null and len(h.hits) = 1 and trim(p.b) <> '' and x.match = h.hits[1] then 'benign' else 'conflict' end as kind, count(*) as n from p left join e6 x on x.printed = p.a left join h on h.b = p.b group by 1""")
def r2_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Rows with two printed forms: benign if both name one model."""
    t = table(spark, d, "stg_pump_config").where("pump_model_as_printed <> pump_model_as_printed_alt")
    return resolve.conflict_kinds(t, "pump_model_as_printed", "pump_model_as_printed_alt", table(spark, d, "pump_catalogue"), "pump_model_canonical").groupBy("kind").agg(F.count("*").alias("n"))


# ---- projection and typing
_OBS_NUMBER = "try_cast(replace(regexp_extract(trim({0}), '^([-+]?[\\d,]*\\.?\\d+)\\s*(.*)$', 1), ',', '') as double)"


@query(f"""
    with o as (select *, lower(trim(head_unit_as_printed)) in ('psi', 'psia', 'psig', '(psi)') as pressure, {_OBS_NUMBER.format("head_as_printed")} as h, {_OBS_NUMBER.format("frequency_hz_as_printed")} as f, try_cast(trim(stages_at_observation) as double) as st from stg_curve_observations)
    select obs_id, 'obs_' || substr(sha1(coalesce(source_document, '') || '|' || coalesce(pump_model_as_printed, '') || '|' || coalesce(point_type, '') || '|' || coalesce(flow_as_printed, '') || '|' || coalesce(head_as_printed, '')), 1, 16) as observation_key,
        coalesce(nullif(trim(scenario_title_as_printed), ''), trim(pump_model_as_printed)) as label, point_type in ('bep', 'ror_min', 'ror_max') as is_envelope, coalesce(curve_observation_role = 'cross_check', false) as is_withdrawn,
        lower(trim(observation_is_composite)) = 'true' as is_composite, case when not coalesce(pressure, false) then h end as head, case when coalesce(pressure, false) and h is not null then 'pressure_unit' end as head_reason,
        round(case when not coalesce(pressure, false) and f > 0 then case when head_basis_as_printed = 'per_stage' then h * pow(60 / f, 2) else h * pow(60 / f, 2) / nullif(case when st > 0 then st end, 0) end end, 8) as head60 from o""")
def proj_observations(spark: SparkSession, d: str) -> DataFrame:
    return records.observation_rows(table(spark, d, "stg_curve_observations"), ["bep", "ror_min", "ror_max"], ["cross_check"]).select("obs_id", "observation_key", "label", "is_envelope", "is_withdrawn", "is_composite", "head", "head_reason", F.round("head60", 8).alias("head60"))


@query("""
    select context_id, case when regexp_full_match(regexp_replace(trim(effective_from), '^["'']+|["'']+$', '', 'g'), '\\d{4}-\\d{2}-\\d{2}') then regexp_replace(trim(effective_from), '^["'']+|["'']+$', '', 'g') end as day,
        effective_from is null or replace(trim(effective_from), '"', '') in ('', 'null', 'None', '[]', '-') as absent from esp_well_design_context""")
def typing_days(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "esp_well_design_context").select("context_id", typed.parse_day(F.col("effective_from")).alias("day"), typed.is_absent(F.col("effective_from")).alias("absent"))


@query("""
    select config_id, len(l) as n, array_to_string(l, '|') as parts from (select config_id, list_filter(list_transform(string_split(stages_per_housing_as_printed, ','), lambda x: trim(x)), lambda x: x <> '') as l from stg_pump_config) where len(l) > 0""")
def typing_lists(spark: SparkSession, d: str) -> DataFrame:
    parts = typed.parse_list(F.col("stages_per_housing_as_printed"))
    return table(spark, d, "stg_pump_config").select("config_id", parts.alias("l")).where("l is not null").select("config_id", F.size("l").cast("long").alias("n"), F.array_join("l", "|").alias("parts"))


@query("""
    select event_id, coalesce(trim(json_extract_string(props, '$.ref')), '') as ref, coalesce(trim(json_extract_string(props, '$.source')), '') <> '' as has_source, try_cast(json_extract_string(props, '$.k1') as double) as k1 from events""")
def typing_accessors(spark: SparkSession, d: str) -> DataFrame:
    obj = table(spark, d, "events").select("event_id", F.from_json("props", "map<string,string>").alias("o"))
    return obj.select("event_id", typed.cell_text("o", "ref").alias("ref"), typed.cell_there("o", "source").alias("has_source"), typed.cell_number("o", "k1").alias("k1"))


@query("""
    select config_id, pump_model_canonical is not null and replace(trim(pump_model_canonical), '"', '') not in ('', 'null', 'None', '[]', '-') and extraction_status is distinct from 'partial' as matched from stg_pump_config""")
def typing_matches(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "stg_pump_config").select("config_id", typed.is_match(F.col("pump_model_canonical"), F.col("extraction_status"), "partial").alias("matched"))


@query("""
    select config_id, concat_ws(',', case when stages is not null and try_cast(trim(stages) as bigint) is null then 'stages' end, case when top_md_ft is not null and not regexp_full_match(trim(top_md_ft), '[-+]?[0-9]+(\\.[0-9]+)?') then 'top_md_ft' end,
        case when is_design_scenario is not null and lower(trim(is_design_scenario)) not in ('true', 'false') then 'is_design_scenario' end) as problems from stg_pump_config where not regexp_matches(coalesce(stages, ''), '[.eE]')""")
def rec_type_check(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "stg_pump_config").where("not coalesce(stages, '') rlike '[.eE]'")
    return rows.select("config_id", F.array_join(records.type_problems({"stages": "bigint", "top_md_ft": "double", "is_design_scenario": "boolean"}), ",").alias("problems"))


@query("""
    select doc_id, case when regexp_full_match(l, '[^/\\\\]+\\.pdf') then l end as file_name, case when regexp_full_match(sha256(source), '[0-9a-f]{64}') then sha256(source) end as digest, case when lang in ('en', 'es', 'de') then lang end as origin
    from (select *, replace(source_document, '.pdf', case when doc_id % 5 = 0 then '/x.pdf' when doc_id % 7 = 0 then ' +.pdf' else '.pdf' end) as l from documents)""")
def proj_labels(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents")
    tail = F.when(F.col("doc_id") % 5 == 0, "%2Fx.pdf").when(F.col("doc_id") % 7 == 0, "%20+.pdf").otherwise(".pdf")
    coded = F.replace(F.replace("source_document", F.lit("%"), F.lit("%25")), F.lit(".pdf"), tail)
    return t.select("doc_id", X.file_label(coded).alias("file_name"), X.hex_label(F.sha2("source", 256), 64).alias("digest"), X.one_of(F.col("lang"), ["en", "es", "de"]).alias("origin"))


@query("select event_id, least(user_id - 90, 780)::bigint as budget from events")
def expr_budget(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", X.clamped(F.col("user_id"), 90, 780).alias("budget"))


# ---- text and order
@query("select distinct well_id, regexp_replace(regexp_replace(lower(well_id), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug from well_list where well_id is not null")
def f_slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "well_list").where("well_id is not null").select("well_id", T.slug(F.col("well_id")).alias("slug")).distinct()


@query()
def f_hidden(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "stg_pump_config").where("pump_model_as_printed is not null").select("pump_model_as_printed").distinct()
    return names.select("pump_model_as_printed", T.hidden_shown(F.col("pump_model_as_printed")).alias("shown"))


@query("select page_id, replace(replace(page_text, 'e', chr(233)), chr(176), 'o') as text, 0::int as \"left\" from page_texts where page_text is not null")
def f_glyphs(spark: SparkSession, d: str) -> DataFrame:
    fixed = T.repaired_glyphs(F.col("page_text"), {"e": "é", "°": "o"})
    return table(spark, d, "page_texts").where("page_text is not null").select("page_id", fixed.alias("f")).select("page_id", "f.*")


@query("with g as (select user_id, event_type as mode, count(*) as n, min({'t': ts, 'e': event_id}) as first from events where event_type is not null group by all) select user_id, mode, n from (select *, row_number() over (partition by user_id order by n desc, first) as rn from g) where rn = 1")
def a9_mode(spark: SparkSession, d: str) -> DataFrame:
    return entry.mode_first(table(spark, d, "events"), ["user_id"], "event_type", ["ts", "event_id"])


@query("select p_partkey, p_brand, rank::int as rank from (select *, row_number() over (partition by p_brand order by '{\"p_name\":\"' || p_name || '\",\"p_size\":' || p_size || '}', p_partkey) as rank from part)")
def o2_canonical_order(spark: SparkSession, d: str) -> DataFrame:
    canon = versions.canonical(["p_name", "p_size"])
    return entry.position_ranks(table(spark, d, "part"), ["p_brand"], canon, F.col("p_partkey")).select("p_partkey", "p_brand", "rank")


@query("""
    select o_orderkey, rank::int as rank from (select o_orderkey, row_number() over (partition by o_custkey order by list_position(['P', 'O', 'F'], o_orderstatus), o_orderkey) as rank from orders)""")
def o3_group_order(spark: SparkSession, d: str) -> DataFrame:
    place = F.array_position(F.array(*map(F.lit, "POF")), F.col("o_orderstatus"))
    return entry.position_ranks(table(spark, d, "orders"), ["o_custkey"], place, F.col("o_orderkey")).select("o_orderkey", "rank")


@query("""
    select l_orderkey, l_linenumber, rank::int as rank from (select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by case l_returnflag when 'R' then 0 when 'A' then 1 else 2 end, l_linenumber) as rank from lineitem)""")
def o4_severity_order(spark: SparkSession, d: str) -> DataFrame:
    grave = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    return entry.position_ranks(table(spark, d, "lineitem"), ["l_orderkey"], grave, F.col("l_linenumber")).select("l_orderkey", "l_linenumber", "rank")


@query("select organization_id, well_id, rank::int as rank from (select *, row_number() over (partition by organization_id order by lower(well_id), well_id) as rank from (select distinct organization_id, well_id from well_list where well_id is not null))")
def o5_display_order(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "well_list").where("well_id is not null").select("organization_id", "well_id").distinct()
    return entry.position_ranks(pairs, ["organization_id"], F.lower("well_id"), F.col("well_id"))


# ---- comparison of versions
_PAIR = """
    a as (select source_document as s, scenario_ordinal as o, section_order as x, min(stages) as v from stg_pump_config where source_document is not null group by all),
    b as (select source_document as s, scenario_ordinal as o, section_order as x, min(stages) as v from stg_pump_config_copy where source_document is not null group by all)"""


def _pair(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    one = lambda t: table(spark, d, t).where("source_document is not null").groupBy("source_document", "scenario_ordinal", "section_order").agg(F.min("stages").alias("stages"))
    return one("stg_pump_config"), one("stg_pump_config_copy")


_TRAPS = """
    d as (select s, v, sum(n)::bigint as n from (select s, v, count(*) as n from a where v is not null group by all union all select s, v, -count(*) from b where v is not null group by all) group by all having sum(n) <> 0),
    side as (select s, v, n > 0 as old, unnest(range(abs(n))) as i from d), ranked as (select *, row_number() over (partition by s, old order by v, i) as rn from side),
    traps as (select coalesce(x.s, y.s) as s, x.v as old, y.v as new from (select * from ranked where old) x full join (select * from ranked where not old) y on x.s = y.s and x.rn = y.rn)"""


@query(f"with {_PAIR}, {_TRAPS} select s as source_document, old, new from traps")
def d4_traps(spark: SparkSession, d: str) -> DataFrame:
    """Stage numbers that one copy of a document has more often than the other, whatever the row."""
    return compare.traps(*_pair(spark, d), ["source_document"], "stages").select("source_document", "old", "new")


_NUM = "try_cast(replace(regexp_extract({0}, '([-+]?[\\d,]*\\.?\\d+)', 1), ',', '') as double)"
_WORDS = "lower(trim(regexp_replace(regexp_replace({0}, '[-+]?[\\d,]*\\.?\\d+|[()\\[\\]]', ' ', 'g'), '\\s+', ' ', 'g')))"
_CLASS = f"""case when {{0}} is null then 'added' when {{1}} is null then 'dropped' when len(regexp_extract_all({{0}}, '[-+]?[\\d,]*\\.?\\d+')) > 0
    and list_transform(regexp_extract_all({{0}}, '[-+]?[\\d,]*\\.?\\d+'), lambda n: try_cast(replace(n, ',', '') as double)) = list_transform(regexp_extract_all({{1}}, '[-+]?[\\d,]*\\.?\\d+'), lambda n: try_cast(replace(n, ',', '') as double))
    and ({_WORDS.format("{0}")} = {_WORDS.format("{1}")} or {_WORDS.format("{0}")} = '' or {_WORDS.format("{1}")} = '') then 'format' else 'conflict' end"""
_FIELDS = f"""
    fields as (select coalesce(a.s, b.s) as s, coalesce(a.o, b.o) as o, coalesce(a.x, b.x) as x, case when a.s is null then '*' when b.s is null then '*' else 'stages' end as field, case when a.s is not null and b.s is not null then a.v end as old, case when a.s is not null and b.s is not null then b.v end as new,
            case when a.s is null then 'added' when b.s is null then 'dropped' else {_CLASS.format("a.v", "b.v")} end as category
        from a full join b on a.s is not distinct from b.s and a.o is not distinct from b.o and a.x is not distinct from b.x where a.s is null or b.s is null or a.v is distinct from b.v)"""


def _fields(spark: SparkSession, d: str) -> DataFrame:
    keys = ["source_document", "scenario_ordinal", "section_order"]
    diffs = versions.field_diffs(versions.positional(*_pair(spark, d), keys, ["stages"]), keys, ["stages"])
    return diffs.withColumn("row_key", compare.row_key(["scenario_ordinal", "section_order"]))


@query(f"""
    with {_PAIR}, {_TRAPS}, {_FIELDS}, w as (
        select s, 't1' as t, '{{"scenario_ordinal":"' || o || '","section_order":"' || x || '"}}' as row_key, field, category, old, new from fields
        union all select s, 't2', 'stages', 'stages', {_CLASS.format("old", "new")}, old, new from traps)
    select s as source_document, t as table_name, row_key, field, category, old, new from w where category in ('conflict', 'dropped')""")
def d6_worksheet(spark: SparkSession, d: str) -> DataFrame:
    """Every failing difference of the two copies and every failing trap, as one worksheet."""
    t = compare.traps(*_pair(spark, d), ["source_document"], "stages").select("source_document", F.lit("stages").alias("row_key"), F.lit("stages").alias("column"), "old", "new", "category")
    sheet = compare.worksheet({"t1": _fields(spark, d), "t2": t}, "source_document", ["t1", "t2"])
    return sheet.drop("rank")


@query(f"""
    with {_PAIR}, {_FIELDS} select source_document, field, rank::int as rank from (select s as source_document, field, row_number() over (partition by s, field order by o, x) as rank from fields where category = 'added') where rank <= 5""")
def d6_added_sample(spark: SparkSession, d: str) -> DataFrame:
    return compare.added_sample(_fields(spark, d), "source_document").select("source_document", F.col("column").alias("field"), "rank")


@query(f"""
    with {_PAIR}, {_TRAPS}, {_FIELDS},
    n as (select coalesce(x.s, y.s) as s, coalesce(x.n, 0) as n_old, coalesce(y.n, 0) as n_new from (select s, count(*) as n from a group by 1) x full join (select s, count(*) as n from b group by 1) y on x.s = y.s),
    f as (select s, count_if(category in ('conflict', 'dropped')) as k from fields group by 1), t as (select s, count_if({_CLASS.format("old", "new")} in ('conflict', 'dropped')) as k from traps group by 1),
    v as (select n.s as source_document, coalesce(f.k, 0) = 0 as table_ok, coalesce(t.k, 0) = 0 as traps_ok, coalesce(abs(round((n_new - n_old) * 100.0 / nullif(n_old, 0), 2)) <= 5, false) as count_ok from n left join f on f.s = n.s left join t on t.s = n.s)
    select *, table_ok and traps_ok and count_ok as passed from v""")
def d13_compared(spark: SparkSession, d: str) -> DataFrame:
    return compare.compared(*_pair(spark, d), ["source_document"], ["scenario_ordinal", "section_order"], ["stages"], "stages")


@query("""
    with a as (select source_document as s, row_number() over (partition by source_document order by scenario_ordinal nulls first, section_order nulls first) as at, stages as v from (select source_document, scenario_ordinal, section_order, min(stages) as stages from stg_pump_config where source_document is not null group by all)),
    b as (select source_document as s, row_number() over (partition by source_document order by scenario_ordinal nulls first, section_order nulls first) as at, stages as v from (select source_document, scenario_ordinal, section_order, min(stages) as stages from stg_pump_config_copy where source_document is not null group by all)),
    r as (select s, max(abs(d)) = 0 as same_rows from (select s, v, sum(k) as d from (select s, v, 1 as k from a union all select s, v, -1 from b) group by all) group by s),
    o as (select coalesce(a.s, b.s) as s, bool_and(a.s is not null and b.s is not null and a.v is not distinct from b.v) as same_order from a full join b on a.s = b.s and a.at = b.at group by 1)
    select r.s as source_document, same_rows, same_order from r join o on r.s = o.s""")
def d8_ordered_parity(spark: SparkSession, d: str) -> DataFrame:
    return compare.ordered_parity(*_pair(spark, d), ["source_document"], ["scenario_ordinal", "section_order"], ["stages"])


@query("""
    with e as (select source_document, pump_model_as_printed, string_agg(distinct point_type, ' | ' order by point_type) as evidence from stg_curve_observations where point_type is not null group by all)
    select config_id, evidence from stg_pump_config s left join e on e.source_document = s.source_document and e.pump_model_as_printed = s.pump_model_as_printed where extraction_status = 'needs_review'""")
def d10_conflicts(spark: SparkSession, d: str) -> DataFrame:
    said = table(spark, d, "stg_curve_observations").where("point_type is not null").select("source_document", "pump_model_as_printed", F.col("point_type").alias("said"))
    return compare.conflict_rows(table(spark, d, "stg_pump_config"), "extraction_status", said, ["source_document"], "pump_model_as_printed").select("config_id", "evidence")


# ---- routing of documents
_MATCHERS = [("summary", "required", "re", "(?i)^design summary"), ("well", "optional", "line", "Well Data"), ("checksum", "required", "start", "checksum "), ("front", "optional", "title", "Halden")]
_HITS = """
    l as (select page_id, report_id, unnest(string_split(replace(page_text, chr(13), ''), chr(10))) as line, generate_subscripts(string_split(replace(page_text, chr(13), ''), chr(10)), 1) as i from page_texts where page_text is not null),
    m as (select page_id, report_id, 'summary' as role, 'required' as status, arg_min(line, i) as line from l where regexp_matches(line, '(?i)^design summary') group by all
        union all select page_id, report_id, 'well', 'optional', arg_min(line, i) from l where line = 'Well Data' group by all
        union all select page_id, report_id, 'checksum', 'required', arg_min(line, i) from l where line like 'checksum %' group by all
        union all select page_id, report_id, 'front', 'optional', line from (select *, row_number() over (partition by page_id order by i) as rn from l where trim(line) <> '') where rn = 1 and line like 'Halden%')"""


@query(f"with {_HITS} select page_id, role, status, line from m")
def t2_matchers(spark: SparkSession, d: str) -> DataFrame:
    return routing.first_lines(table(spark, d, "page_texts"), ["page_id"], "page_text", _MATCHERS)


def _missing(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "page_texts").where("report_id is not null")
    return routing.missing_roles(pages, "report_id", routing.first_lines(pages, ["report_id"], "page_text", _MATCHERS), ["summary", "checksum"])


_MISSING = f"""{_HITS},
    miss as (select r.report_id, concat_ws(',', case when not coalesce(bool_or(role = 'summary'), false) then 'summary' end, case when not coalesce(bool_or(role = 'checksum'), false) then 'checksum' end) as missing
        from (select distinct report_id from page_texts where report_id is not null) r left join m using (report_id) group by r.report_id)"""


@query(f"with {_MISSING} select * from miss")
def t3_required(spark: SparkSession, d: str) -> DataFrame:
    return _missing(spark, d).select("report_id", F.array_join("missing", ",").alias("missing"))


@query(f"""
    with {_MISSING}, x as (select report_id, missing, case when report_id like '%0.pdf' then 'unknown' when report_id like '%1.pdf' then 'ambiguous' else 'A' end as family, report_id like '%2.pdf' as forced from miss)
    select report_id, case when family = 'ambiguous' then 'refused' when family = 'unknown' or missing <> '' or forced then 'generic' else 'template' end as route,
        case when family = 'ambiguous' then family when family = 'unknown' then 'B' when missing <> '' then family when forced then null else family end as hint from x""")
def t4_route(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("report_id")
    family = F.when(r.endswith("0.pdf"), "unknown").when(r.endswith("1.pdf"), "ambiguous").otherwise("A")
    routed = routing.route_of(family, F.lit("B"), F.col("missing"), r.endswith("2.pdf"))
    return _missing(spark, d).select("report_id", routed.alias("x")).select("report_id", "x.*")


# ---- guards over reports made of customers and their orders
_GUARDS = """
    c as (select c_custkey as k, count(o_orderkey) as n from customer left join orders on o_custkey = c_custkey group by 1),
    h as (select k, n, k % 9 = 0 or (k % 8 = 0 and k % 7 <> 0) as halted, case when k % 9 = 0 then 'V-02,V-F1-3' else '' end as said from c),
    f as (
        select k, 'G-S1' as rule_id, 'ERROR' as severity, null as table_name, null as column_name, null as value from c where k % 7 = 0
        union all select k, 'G-S2', 'ERROR', 'lines', null, null from c where k % 5 = 0
        union all select k, 'G-S3', 'ERROR', null, null, null from c where k % 6 = 0
        union all select k, 'G-S4', 'WARN', 'orders', null, (n + 1) || '/' || n from c where k % 4 = 0 and k % 6 <> 0
        union all select k, 'G-E1', 'ERROR', null, null, case when halted then said end from h where n = 0
        union all select k, 'G-E2', 'WARN', 'lines', null, null from h where n > 0
        union all select k, 'G-E3', 'WARN', null, null, said from h where n > 0 and halted
        union all select o_custkey, 'V-10', 'HALT', 'orders', 'z', '1' from orders where o_custkey % 10 = 0
        union all select k, 'D16', 'HALT', null, 'o_orderpriority', cast(m as varchar) from (select o_custkey as k, count(distinct o_orderpriority) as m from orders where o_custkey % 25 = 0 group by 1) where m > 1
        union all select k, 'D17', 'HALT', null, null, null from c where k % 12 = 0)"""


def _customer_reports(spark: SparkSession, d: str) -> DataFrame:
    """One report per customer: frontmatter, prose, a block of orders, an empty block and a footer, each missing or wrong for some."""
    k, n = F.col("c_custkey"), F.col("n")
    line = F.concat(F.lit('{"k": "'), F.col("o_orderkey"), F.when(F.col("o_custkey") % 10 == 0, '", "z": "1"}').otherwise('"}'))
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"), F.count("*").alias("n"))
    c = table(spark, d, "customer").select("c_custkey").join(orders, "c_custkey", "left").fillna({"body": "", "n": 0})
    declared = n + F.when(k % 4 == 0, 1).otherwise(0)
    text = F.concat(
        F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("---\nsource: x\nvalidation_status: "), F.when(k % 8 == 0, "failed").otherwise("ok"), F.lit("\n---\n"))),
        F.when(k % 9 == 0, "\n> [!warning] **HALT \u2014 V-02 (no page)**, V-F1-3\n").otherwise("\nThis is not a HALT.\n"),
        F.lit("\n## orders\n```jsonl\n"), F.col("body"), F.lit("\n```\n"), F.when(k % 5 == 0, "").otherwise("\n## lines\n```jsonl\n```\n"),
        F.lit("\n## row_counts\n```jsonl\n"), F.concat(F.lit('{"orders": '), F.when(k % 6 == 0, F.concat(F.lit('"'), declared, F.lit('"'))).otherwise(declared.cast("string")), F.lit(', "lines": 0}')), F.lit("\n```\n"),
    )
    return c.select(k.cast("string").alias("report_id"), text.alias("text"))


def _guard_findings(spark: SparkSession, d: str) -> DataFrame:
    r, o = _customer_reports(spark, d), table(spark, d, "orders")
    legal = spark.createDataFrame([("orders", "k"), ("row_counts", "orders"), ("row_counts", "lines")], "block string, key string")
    vary = o.where("o_custkey % 25 = 0").groupBy(F.col("o_custkey").cast("string").alias("report_id")).agg(F.count_distinct("o_orderpriority").alias("all_values")).where("all_values > 1").withColumn("column", F.lit("o_orderpriority"))
    unlike = table(spark, d, "customer").where("c_custkey % 12 = 0").select(F.col("c_custkey").cast("string").alias("report_id"))
    found = guards.structure(r, ["orders", "lines"]).unionByName(guards.counts(r)).unionByName(guards.emptiness(r, "lines", "orders"))
    return found.unionByName(guards.surfaced(reports.unknown_keys(r, legal), vary, unlike))


@query(f"with {_GUARDS} select k::varchar as report_id, rule_id, severity, table_name, column_name, value from f")
def guard_findings(spark: SparkSession, d: str) -> DataFrame:
    return _guard_findings(spark, d)


@query(f"""
    with {_GUARDS}, w as (select k, max(case when severity = 'HALT' or rule_id in ('G-S1', 'G-S2', 'G-S3', 'G-E1') then 2 when severity in ('ERROR', 'WARN') then 1 else 0 end) as r, max((rule_id in ('V-08', 'D17', 'G-E1'))::int) as s from f group by 1)
    select c.k::varchar as report_id, case coalesce(greatest(r, (c.k % 2)::int), c.k % 2) when 2 then 'failed' when 1 then 'needs_review' else 'passed' end as status, coalesce(s, 0) = 0 as may_publish from c left join w on w.k = c.k""")
def guard_status(spark: SparkSession, d: str) -> DataFrame:
    """The status of every report; those of odd customers went the generic way."""
    r = _customer_reports(spark, d)
    return guards.status(r, _guard_findings(spark, d), r.where(F.col("report_id").cast("long") % 2 == 1))
