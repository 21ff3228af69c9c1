"""Reviewed values of a record: proposed, checked, requested, refused or built into a row.

Values stand in long form, one row per record and key, so that a record of any width goes through
the same plan and partial aggregates do the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.typed import typed_cells
from millrace.operators.windows import arg_max

SETTLED, TO_CHECK, BLOCKS, CORRECTED = "settled", "to_check", "blocks", "corrected"


def single_values(staged: DataFrame, record: list[str], variant: str, preferred: str, kinds: dict[str, str]) -> DataFrame:
    """(record, column, printed, value, reasons, all_printed): one typed value per key.

    ``staged`` has one row per record, variant and ``column`` with its ``raw`` text. The preferred
    variant's text is taken, else the first's (shorter names first); ``value_not_typed`` and
    ``varies_by_scenario`` are reasons to look, and all texts are listed.
    """
    typed = typed_cells(staged, kinds)
    value = F.when(F.col("reason").isNull(), F.col("value"))
    first = F.struct((F.col(variant) != preferred).alias("o"), F.length(variant).alias("l"), F.col(variant).alias("v"))
    out = typed.groupBy(*record, "column").agg(
        F.min_by("raw", first).alias("printed"), F.min_by(F.struct(value.alias("value")), first).alias("s"), F.count_distinct(value).alias("n"),
        F.array_join(F.array_sort(F.collect_set(F.concat_ws("=", variant, "raw"))), "; ").alias("all_printed"),
    )
    reasons = F.array_compact(F.array(F.when(F.col("s.value").isNull(), "value_not_typed"), F.when(F.col("n") > 1, "varies_by_scenario")))
    return out.select(*record, "column", "printed", F.col("s.value").alias("value"), reasons.alias("reasons"), "all_printed")


def reviewed(values: DataFrame, units: dict[str, str]) -> DataFrame:
    """``values`` of ``single_values`` with ``unit``, ``status`` and ``written``: a value with a reason is to check, one without a value is not written."""
    unit = F.element_at(F.create_map(*[F.lit(x) for kv in units.items() for x in kv]), F.col("column"))
    return values.select("*", unit.alias("unit"), F.when(F.size("reasons") > 0, TO_CHECK).otherwise(SETTLED).alias("status"), F.col("value").isNotNull().alias("written"))


def assembled(review: DataFrame, record: list[str]) -> DataFrame:
    """(record, entry, n_settled, n_to_check, nothing_to_check): envelopes {value, unit} of the written keys as JSON, keys sorted, and the tally."""
    e = F.when(F.col("written"), F.struct(F.col("column").alias("k"), F.struct(F.col("value").alias("value"), F.col("unit").alias("unit")).alias("v")))
    out = review.groupBy(*record).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(e)))).alias("entry"), F.count_if(F.col("status") == SETTLED).alias("n_settled"), F.count_if(F.col("status") == TO_CHECK).alias("n_to_check"))
    return out.withColumn("nothing_to_check", F.col("n_to_check") == 0)


def empty_proposal(records: DataFrame, record: list[str], keys: list[str], never: list[str]) -> DataFrame:
    """(record, key, status, reason): the entry of records nothing was read for; keys in ``never`` are settled and empty."""
    k = F.explode(F.array(*[F.struct(F.lit(x).alias("key"), F.lit(x in never).alias("never")) for x in keys]))
    return records.select(*record).distinct().select(*record, k.alias("k")).select(*record, "k.key", F.when(F.col("k.never"), SETTLED).otherwise(TO_CHECK).alias("status"), F.when(~F.col("k.never"), "entered_by_hand").alias("reason"))


def section_reasons(sections: DataFrame, how: str, order: str, position: str, stages: str) -> Column:
    """Reasons why a section cannot be taken as it is: its model, its order against its place, its stages."""
    bad_model = F.when(F.col(how) == "ambiguous", "model_ambiguous").when(F.col(how).isNull() | (F.col(how) == "none"), "model_absent")
    bad_order = F.when(~F.coalesce(F.col(order) == F.col(position), F.lit(False)), "order_not_position")
    return F.array_compact(F.array(bad_model, bad_order, F.when(~F.coalesce(F.col(stages) >= 1, F.lit(False)), "no_stages")))


def string_checks(records: DataFrame, sections: DataFrame, record: list[str]) -> DataFrame:
    """(record, check, result): pass, fail or not_run of every check of a record's string of sections.

    ``sections`` carries position, number (its printed order), stages, list_sum (of its printed list,
    null for none), status and how (the catalogue match). Records without sections have their rows
    too. Checks: sections, order, arithmetic, conflict, models, complete.
    """
    f = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    found = sections.groupBy(*record).agg(
        F.count("*").alias("n"), f(~F.col("number").eqNullSafe(F.col("position"))).alias("misplaced"), f(F.col("list_sum") != F.col("stages")).alias("unequal"), F.count("list_sum").alias("lists"),
        f(F.col("status") == "needs_review").alias("conflicts"), f(F.coalesce(F.col("how"), F.lit("none")).isin("none", "ambiguous")).alias("unresolved"), f(F.col("number").isNull() | ~F.coalesce(F.col("stages") >= 1, F.lit(False))).alias("incomplete"),
    )
    j = records.select(*record).distinct().join(found, record, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    run = lambda fails, ran=None: F.when(~(F.col("n") > 0) if ran is None else ~F.coalesce(ran, F.lit(False)), "not_run").when(F.col(fails) > 0, "fail").otherwise("pass")
    checks = {
        "sections": F.when(F.col("n") > 0, "pass").otherwise("fail"), "order": run("misplaced"), "arithmetic": run("unequal", F.col("lists") > 0),
        "conflict": F.when(F.coalesce(F.col("conflicts"), F.lit(0)) > 0, "fail").otherwise("pass"), "models": run("unresolved"), "complete": run("incomplete"),
    }
    one = F.explode(F.array(*[F.struct(F.lit(k).alias("check"), v.alias("result")) for k, v in checks.items()]))
    return j.select(*record, one.alias("c")).select(*record, "c.*")


def string_status(checks: DataFrame, record: list[str], blocking: list[str]) -> DataFrame:
    """(record, status, failed): a failed blocking check blocks, any other failure is to check."""
    fails = F.col("result") == "fail"
    out = checks.groupBy(*record).agg(F.max((fails & F.col("check").isin(blocking)).cast("int")).alias("b"), F.array_join(F.array_sort(F.collect_list(F.when(fails, F.col("check")))), ",").alias("failed"))
    return out.select(*record, F.when(F.col("b") == 1, BLOCKS).when(F.col("failed") != "", TO_CHECK).otherwise(SETTLED).alias("status"), "failed")


def as_staging(sections: DataFrame, keep: list[str], columns: list[str]) -> DataFrame:
    """(keep, obj): typed sections as the staging rows they would have been printed as, absent keys left out, so that the staging checks run on them again."""
    cells = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in columns])
    return sections.select(*keep, F.map_from_entries(F.filter(cells, lambda e: e["v"].isNotNull())).alias("obj"))


def build_requests(review: DataFrame, record: list[str], overrides: DataFrame, leave: Column, as_proposed: Column, accept: Column) -> DataFrame:
    """(record, key, final, status, why, history): what is asked of each proposed value.

    First of: set by hand (``overrides``: record, key, final; a null final empties the value), left to
    check, a blocking value accepted anyway or not, a value to check that is not confirmed, as
    proposed. The history has the proposal's step and this one.
    """
    j = review.join(overrides.select(*record, "key", F.col("final").alias("__f"), F.lit(True).alias("__set")), [*record, "key"], "left")
    blocks, check = F.col("status") == BLOCKS, F.col("status") == TO_CHECK
    s = lambda final, status, why: F.struct(final.alias("final"), F.lit(status).alias("status"), F.lit(why).alias("why"))
    own = F.col("value")
    decided = (
        F.when(F.col("__set"), s(F.col("__f"), CORRECTED, "set by hand")).when(leave, s(own, TO_CHECK, "left to check"))
        .when(blocks & accept, s(own, SETTLED, "accepted anyway")).when(blocks, s(own, TO_CHECK, "blocks publish")).when(check & ~as_proposed, s(own, TO_CHECK, "not confirmed")).otherwise(s(own, SETTLED, "as proposed"))
    )
    return j.select(*record, "key", "status", decided.alias("d")).select(*record, "key", "d.final", F.col("d.status").alias("status"), "d.why", F.concat_ws(" > ", "status", "d.status").alias("history"))


def refusals(requests: DataFrame, review: DataFrame, record: list[str], names: DataFrame | None = None) -> DataFrame:
    """(record, reasons): every reason to refuse a record's request, sorted; accepted requests have none.

    missing and extra keys, values left to check, values changed but not marked corrected, blocking
    values neither corrected nor accepted, and final values that are no entry of ``names`` (one
    column) as spelt.
    """
    a = review.select(*record, "key", F.col("value").alias("__proposed"), F.col("status").alias("__was"), F.lit(True).alias("__a"))
    b = requests.select(*record, "key", "final", "status", "accepted", F.lit(True).alias("__b"))
    j = a.join(b, [*record, "key"], "full_outer")
    both = F.col("__a") & F.col("__b")
    spelt = F.lit(None).cast("boolean")
    if names is not None:
        j = j.join(names.select(F.col(names.columns[0]).alias("final"), F.lit(True).alias("__n")).distinct(), "final", "left")
        spelt = F.col("final").isNotNull() & F.col("__n").isNull()
    say = lambda c, what: F.when(c, F.concat(F.lit(what + ": "), F.col("key")))
    reasons = F.array_compact(F.array(
        say(F.col("__b").isNull(), "missing"), say(F.col("__a").isNull(), "extra"), say(both & (F.col("status") == TO_CHECK), "left to check"),
        say(both & (F.col("status") != CORRECTED) & ~F.col("final").eqNullSafe(F.col("__proposed")), "unmarked change"),
        say(both & (F.col("__was") == BLOCKS) & (F.col("status") != CORRECTED) & ~F.coalesce("accepted", F.lit(False)), "blocks"), say(spelt, "not a known spelling"),
    ))
    return j.groupBy(*record).agg(F.array_sort(F.flatten(F.collect_list(reasons))).alias("reasons"))


def version_record(requests: DataFrame, review: DataFrame, record: list[str]) -> DataFrame:
    """(record, key, proposed, final, starting_status, status, changed): what was confirmed against what was proposed."""
    j = review.select(*record, "key", F.col("value").alias("proposed"), F.col("status").alias("starting_status")).join(requests.select(*record, "key", "final", "status"), [*record, "key"])
    return j.withColumn("changed", ~F.col("final").eqNullSafe(F.col("proposed")))


def built_rows(requests: DataFrame, record: list[str]) -> DataFrame:
    """(record, finals, n_keys): the finals of a record as JSON, keys sorted, empty ones dropped; a record of none has ``{}``."""
    e = F.when(F.col("final").isNotNull(), F.struct("key", "final"))
    return requests.groupBy(*record).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(e)))).alias("finals"), F.count("final").alias("n_keys"))


def confirm_state(runs: DataFrame, rows: DataFrame, run: list[str], place: list[str], order: list[str]) -> DataFrame:
    """``runs`` with ``own`` (their latest row by ``run``) and ``other`` (the latest row of the same ``place``), each by its id."""
    own = arg_max(rows.dropna(subset=run), run, [order[-1]], order).withColumnRenamed(order[-1], "own")
    other = arg_max(rows.dropna(subset=place), place, [order[-1]], order).withColumnRenamed(order[-1], "other")
    return runs.join(own, run, "left").join(other, place, "left")


def tally(rows: DataFrame, cases: list[tuple[str, Column]], by: list[str], rest: str = "other") -> DataFrame:
    """(by, case, n): each row counted under the first case that holds."""
    kind = F.lit(rest)
    for name, cond in reversed(cases):
        kind = F.when(F.coalesce(cond, F.lit(False)), name).otherwise(kind)
    return rows.groupBy(*by, kind.alias("case")).agg(F.count("*").alias("n"))


def object_keys(environment: Column, ident: Column, digest: Column) -> Column:
    """struct of the deterministic keys a confirmation's objects lie under."""
    return F.struct(F.concat(F.lit("rows/environment="), environment, F.lit("/"), ident, F.lit(".json")).alias("row_key"), F.concat(F.lit("versions/"), digest, F.lit("/"), ident, F.lit(".json")).alias("version_key"), F.concat(F.lit("results/"), ident, F.lit(".json")).alias("result_key"))


def has_ended(status: Column, deadline: Column, now: Column) -> Column:
    """Failed, succeeded, or running past its deadline."""
    return status.isin("failed", "succeeded") | ((status == "running") & (deadline < now))


def anything_entered(requests: DataFrame, record: list[str]) -> DataFrame:
    """(record, entered): whether any value was corrected to something."""
    return requests.groupBy(*record).agg(F.bool_or((F.col("status") == CORRECTED) & F.col("final").isNotNull()).alias("entered"))


def first_match(left: DataFrame, right: DataFrame, record: list[str], same: Column, left_id: str, pick: str, order: str) -> DataFrame:
    """(left_id, pick): for each left row the first right row, in order, of its record for which ``same`` holds; null for none.

    Both sides are met on the record only; a record is one document, small by nature.
    """
    hits = left.join(right, record).where(same).groupBy(left_id).agg(F.min_by(pick, F.struct(order, pick)).alias(pick))
    return left.select(left_id).distinct().join(hits, left_id, "left")


def mode_first(rows: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """(keys, mode, n): the most frequent value; of equally frequent ones that which comes first. Null is no value."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("at"))
    return counts.groupBy(*keys).agg(F.min_by(F.struct(F.col(value).alias("mode"), "n"), F.struct((-F.col("n")).alias("n"), "at")).alias("m")).select(*keys, "m.*")


def position_ranks(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """``rows`` with ``rank`` in a total order within each key."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
