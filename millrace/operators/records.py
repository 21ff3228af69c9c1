"""Record-level operators: projection and collapse to a load row, checks over rows, coverage, labels, causes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.expressions import alnum_key, at_reference_frequency, half_last_digit, per_stage, surrogate_key
from millrace.functions.typed import UNIT_DIMENSION
from millrace.operators.versions import classify


def collapse(rows: DataFrame, record: list[str], first: list[str], order: list[str], flags: list[str], spans: list[str], halted: Column | None = None) -> DataFrame:
    """One row per record: first value of each column in order, all() of flags (null for none), min and max of spans.

    ``halted`` is an array of column names whose values are withheld; a withheld value is null.
    """
    kept = lambda c: F.col(c) if halted is None else F.when(~F.array_contains(halted, c), F.col(c))
    by = F.struct(*order)
    aggs = [F.min_by(kept(c), F.when(kept(c).isNotNull(), by)).alias(c) for c in first]
    aggs += [F.bool_and(F.col(c)).alias(f"all_{c}") for c in flags]
    aggs += [f(kept(c)).alias(f"{n}_{c}") for c in spans for n, f in (("min", F.min), ("max", F.max))]
    return rows.groupBy(*record).agg(*aggs)


def merged_json(rows: DataFrame, record: list[str], text: str, order: list[str], out: str) -> DataFrame:
    """(record, out): JSON objects of a record merged, later ones over earlier, keys sorted; text that is no object adds nothing."""
    cells = rows.select(*record, *order, F.explode(F.from_json(text, "map<string,string>")).alias("k", "v"))
    last = cells.groupBy(*record, "k").agg(F.max_by("v", F.struct(*order)).alias("v"))
    return last.groupBy(*record).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v"))))).alias(out))


def preferred(sources: list[tuple[str, Column]]) -> Column:
    """struct<value, source, others>: the first source that has a value, its name, and the other values listed beside it."""
    value = F.coalesce(*[c for _, c in sources])
    name = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in sources])
    rest = F.array_compact(F.array(*[F.when(c.isNotNull() & (name != n), F.concat(F.lit(n + "="), c.cast("string"))) for n, c in sources]))
    return F.struct(value.alias("value"), name.alias("source"), F.array_join(rest, "; ").alias("others"))


def envelope_problem(value: Column, unit: Column, source: Column, unit_wanted: Column, sources: list[str]) -> Column:
    """The first thing wrong with a value's envelope, null if nothing is."""
    return F.coalesce(
        F.when(value.isNull(), "no_value"), F.when(F.isnan(value) | (F.abs(value) == float("inf")), "not_finite"), F.when(unit_wanted.isNotNull() & unit.isNull(), "no_unit"), F.when(unit != unit_wanted, "wrong_unit"), F.when(source.isNull() | ~source.isin(sources), "unknown_source")
    )


def flattened(df: DataFrame) -> DataFrame:
    """Every column as text for display: lists joined by ``; ``, maps and structs as JSON."""

    def one(name: str, kind: str) -> Column:
        if kind.startswith("array<") and "struct" not in kind and "map" not in kind:
            return F.array_join(F.transform(name, lambda x: x.cast("string")), "; ").alias(name)
        return (F.to_json(name) if kind.startswith(("array", "map", "struct")) else F.col(name).cast("string")).alias(name)

    return df.select(*[one(n, k) for n, k in df.dtypes])


def key_parts(key: Column, pattern: str, names: list[str]) -> Column:
    """struct of the groups of a pattern that fits the whole key, null otherwise."""
    whole = f"^(?:{pattern})$"
    return F.when(F.regexp_like(key, F.lit(whole)), F.struct(*[F.regexp_extract(key, whole, i + 1).alias(n) for i, n in enumerate(names)]))


def keys_like(rows: DataFrame, obj: str, pattern: str, *keep: str) -> DataFrame:
    """(keep, key, value) of map entries whose key matches."""
    return rows.select(*keep, F.explode(obj).alias("key", "value")).where(F.col("key").rlike(pattern))


def repair_class(text: Column) -> Column:
    """struct<kind, canonical>: clean, repaired (punctuation only), composite, not_a_model or unresolved; the printed text is never touched."""
    squeezed = F.trim(F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}\s/+&-]", " "), r"(?U)[\s-]+", " "))
    kind = (
        F.when(text.isNull() | (F.trim(text) == ""), "unresolved").when(text.rlike(r"^[\d\s.,]+$"), "not_a_model").when(squeezed.rlike(r"(?i)\S\s*(?:\+|&|/|\band\b|\bw/)\s*\S"), "composite")
        .when(~squeezed.rlike(r"\d"), "unresolved").when(squeezed == text, "clean").otherwise("repaired")
    )
    return F.struct(kind.alias("kind"), F.when(kind.isin("clean", "repaired"), squeezed).alias("canonical"))


def without_names(rows: DataFrame, text: str, names: list[str]) -> DataFrame:
    """Rows whose squeezed text holds none of the given names (a short, fixed list)."""
    squeezed = alnum_key(F.col(text))
    keys = [k for k in ("".join(c for c in n.lower() if c.isalnum()) for n in names) if k]
    hit = F.lit(False)
    for k in keys:
        hit = hit | F.contains(squeezed, F.lit(k))
    return rows.where(~F.coalesce(hit, F.lit(False)))


def sum_check(parts: DataFrame, whole: DataFrame, record: list[str], printed: str, total: str, expected: str) -> DataFrame:
    """(record, result, n, sum, tolerance): whether printed parts add up to the total, in exact decimals.

    The tolerance is half the last printed digit of every part. Not run: ``no_total``, ``no_parts``
    or ``missing_part`` (fewer parts than ``expected``); else pass or fail.
    """
    n = F.replace(F.col(printed), F.lit(","), F.lit("")).try_cast("decimal(30,8)")
    s = parts.groupBy(*record).agg(F.count(n).alias("n"), F.sum(n).alias("sum"), F.sum(F.when(n.isNotNull(), half_last_digit(F.col(printed)))).alias("tolerance"))
    j = whole.join(s, record, "left")
    t = F.col(total).cast("decimal(30,8)")
    result = F.when(t.isNull(), "no_total").when(F.coalesce("n", F.lit(0)) == 0, "no_parts").when(F.col("n") < F.col(expected), "missing_part").when(F.abs(F.col("sum") - t) <= F.col("tolerance"), "pass").otherwise("fail")
    return j.select(*record, result.alias("result"), F.coalesce("n", F.lit(0)).alias("n"), F.col("sum").cast("double").alias("sum"), F.col("tolerance").cast("double").alias("tolerance"))


def poisoned_sum(value: Column) -> Column:
    """A sum that is null as soon as one value is."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def label_conflicts(rows: DataFrame, record: list[str], ordinal: str, label: str, table: str) -> DataFrame:
    """(record, ordinal, labels, tables) where one ordinal has several labels."""
    return rows.where(f"{ordinal} is not null and {label} is not null").groupBy(*record, ordinal).agg(F.array_join(F.array_sort(F.collect_set(label)), "|").alias("labels"), F.array_join(F.array_sort(F.collect_set(table)), "|").alias("tables"), F.count_distinct(label).alias("n")).where("n > 1").drop("n")


def coverage(cells: DataFrame, group: str, record: str, column: str) -> DataFrame:
    """(group, column, n_with, n_records, share): how many records of a group carry each column."""
    total = cells.groupBy(group).agg(F.count_distinct(record).alias("n_records"))
    return cells.groupBy(group, column).agg(F.count_distinct(record).alias("n_with")).join(total, group).withColumn("share", F.round(F.col("n_with") / F.col("n_records"), 6))


def expected_missing(cells: DataFrame, group: str, record: str, column: str, share: float = 0.8) -> DataFrame:
    """(group, record, column): columns that at least ``share`` of a group's records carry and this one does not."""
    usual = coverage(cells, group, record, column).where(F.col("share") >= share).select(group, column)
    wanted = cells.select(group, record).distinct().join(usual, group)
    return wanted.join(cells.select(group, record, column).distinct(), [group, record, column], "left_anti")


def rate(amount: Column, total_s: Column, first_s: Column) -> Column:
    """Amount per second between the first and the last, null-safe."""
    return F.round(F.try_divide(amount, F.when(total_s > first_s, total_s - first_s)), 4)


def misplaced(rows: DataFrame, record: list[str], order: list[str], number: str) -> DataFrame:
    """``rows`` with ``position`` and whether the number they carry says otherwise."""
    w = W.partitionBy(*record).orderBy(*order)
    return rows.withColumn("position", F.row_number().over(w)).withColumn("misplaced", ~F.coalesce(F.col(number) == F.col("position"), F.lit(False)))


def latest_committed(versions: DataFrame, rows: DataFrame, keys: list[str], ident: str, order: list[str]) -> DataFrame:
    """(keys, ident) of the newest version whose row exists."""
    return versions.join(rows.select(ident), ident, "left_semi").groupBy(*keys).agg(F.max_by(ident, F.struct(*order)).alias(ident))


def cascade_match(old: DataFrame, new: DataFrame, keys: list[str], point: list[str]) -> DataFrame:
    """(keys, n_old, n_new, kind): how two versions of a curve meet at each full key.

    ``matched`` (as many on both sides), ``split`` or ``merged`` (another count), then, for keys on
    one side only, ``regrouped`` if the other side has the same point under other keys, else
    ``missing`` or ``extra``.
    """
    count = lambda df, n: df.groupBy(*keys).agg(F.count("*").alias(n))
    a, b = count(old, "n_old"), count(new, "n_new")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    j = a.alias("a").join(b.alias("b"), on, "full_outer").select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys], F.coalesce("n_old", F.lit(0)).alias("n_old"), F.coalesce("n_new", F.lit(0)).alias("n_new"))
    alone = j.where("n_old = 0 or n_new = 0")
    both_sides = alone.groupBy(*point).agg((F.max("n_old") > 0).alias("o"), (F.max("n_new") > 0).alias("n")).where("o and n").select(*[F.col(p).alias(f"__{p}") for p in point], F.lit(True).alias("__both"))
    m = j.join(both_sides, [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in point], "left")
    kind = F.when(F.col("n_old") == F.col("n_new"), "matched").when((F.col("n_old") > 0) & (F.col("n_new") > 0), F.when(F.col("n_new") > F.col("n_old"), "split").otherwise("merged")).when(F.col("__both"), "regrouped").when(F.col("n_new") == 0, "missing").otherwise("extra")
    return m.select(*keys, "n_old", "n_new", kind.alias("kind"))


def causes(old: DataFrame, new: DataFrame, record: list[str], key: str, value: str) -> DataFrame:
    """(record, key, cause) of each value of ``old`` that ``new`` does not give at its key.

    ``moved`` if the value stands under another key of the record, ``missing`` if the key does not
    exist, ``format`` or ``genuine`` by the text.
    """
    n = new.select(*record, F.col(key).alias("__k"), F.col(value).alias("__n"))
    j = old.join(n.withColumnRenamed("__k", key), [*record, key], "left")
    elsewhere = n.select(*record, F.col("__n").alias(value), F.lit(True).alias("__e")).distinct()
    k = j.where(~F.col(value).eqNullSafe(F.col("__n"))).join(elsewhere, [*record, value], "left")
    return k.select(*record, key, F.when(F.col("__e"), "moved").when(F.col("__n").isNull(), "missing").when(classify(F.col(value), F.col("__n")) == "format", "format").otherwise("genuine").alias("cause"))


def parity(old: DataFrame, new: DataFrame, order: list[str], allowed: Column | None = None) -> DataFrame:
    """(only_old, only_new, allowed): rows beyond the other side's count, whitelisted ones apart; (0, 0, n) is parity."""
    ok = F.lit(False) if allowed is None else F.coalesce(allowed, F.lit(False))
    a, b = old.select(*order).exceptAll(new.select(*order)), new.select(*order).exceptAll(old.select(*order))
    both = a.withColumn("__s", F.lit("o")).unionByName(b.withColumn("__s", F.lit("n"))).withColumn("__a", ok)
    return both.agg(F.count_if((F.col("__s") == "o") & ~F.col("__a")).alias("only_old"), F.count_if((F.col("__s") == "n") & ~F.col("__a")).alias("only_new"), F.count_if("__a").alias("allowed"))


def new_items(current: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    """Items of the current gate that the baseline did not have."""
    return current.join(baseline.select(*keys), keys, "left_anti")


def series(points: DataFrame, group: list[str], x: str, y: str) -> DataFrame:
    """(group, n, n_drawn, x_min, x_max, skipped): curve series; null groups are a group of their own."""
    drawn = F.col(x).isNotNull() & F.col(y).isNotNull()
    return points.groupBy(*group).agg(F.count("*").alias("n"), F.count_if(drawn).alias("n_drawn"), F.min(F.when(drawn, F.col(x))).alias("x_min"), F.max(F.when(drawn, F.col(x))).alias("x_max"), F.when(F.count_if(drawn) == 0, "nothing_to_draw").alias("skipped"))


def unique_labels(rows: DataFrame, label: str, key: str, out: str) -> DataFrame:
    """``rows`` with a label no other key has: repeats get their number behind."""
    w = W.partitionBy(label).orderBy(key)
    n = F.dense_rank().over(w)
    several = F.min(key).over(W.partitionBy(label)) != F.max(key).over(W.partitionBy(label))
    return rows.withColumn(out, F.when(several, F.concat(F.col(label), F.lit(" ("), n, F.lit(")"))).otherwise(F.col(label)))


def queue_state(age_s: Column, running: Column, slots: int, slow_s: int = 300) -> Column:
    """State of a request by its age and how many run."""
    return F.when(running >= slots, "queued").when(age_s > slow_s, "delayed").otherwise("starting")


def observation_rows(observations: DataFrame, envelope: list[str], withdrawn: list[str]) -> DataFrame:
    """The load projection of curve points: key, label, flags, head and its value at the reference speed.

    A head printed in a pressure unit is refused: its value is null and ``head_reason`` says so.
    Missing stages leave a total head without a per-stage value. Rows are neither dropped nor merged.
    """
    cell = lambda c: F.nullif(F.regexp_extract(F.trim(c), r"(?s)^([-+]?[\d,]*\.?\d+)\s*(.*)$", 1), F.lit(""))
    number = lambda c: F.replace(cell(c), F.lit(","), F.lit("")).try_cast("double")
    pressure = F.coalesce(F.lower(F.trim("head_unit_as_printed")).isin(*[u for u, dim in UNIT_DIMENSION.items() if dim == "pressure"]), F.lit(False))
    head = F.when(~pressure, number("head_as_printed"))
    at_speed = at_reference_frequency(head, number("frequency_hz_as_printed"), 2)
    return observations.select(
        "obs_id",
        surrogate_key("obs_", F.col("source_document"), F.col("pump_model_as_printed"), F.col("point_type"), F.col("flow_as_printed"), F.col("head_as_printed")).alias("observation_key"),
        F.coalesce(F.nullif(F.trim("scenario_title_as_printed"), F.lit("")), F.trim("pump_model_as_printed")).alias("label"),
        F.col("point_type").isin(envelope).alias("is_envelope"), F.coalesce(F.col("curve_observation_role").isin(withdrawn), F.lit(False)).alias("is_withdrawn"), (F.lower(F.trim("observation_is_composite")) == "true").alias("is_composite"),
        head.alias("head"), F.when(pressure & number("head_as_printed").isNotNull(), "pressure_unit").alias("head_reason"),
        per_stage(at_speed, F.trim("stages_at_observation").try_cast("double"), F.coalesce("head_basis_as_printed", F.lit(""))).alias("head60"),
    )


def type_problems(types: dict[str, str]) -> Column:
    """Array of the columns whose text is there but is no value of its declared type."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & F.trim(c).try_cast(t).isNull(), F.lit(c)) for c, t in types.items()]))
