"""Problem 5: differences between two copies of a table, field by field, in one shuffle.

Both sides are tagged and put together, grouped once by key with one struct per side, and the two
structs are compared by SQL expressions generated from the field list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The pattern of a number in a printed cell.
_NUMBER = r"[-+]?[\\d,]*\\.?\\d+"


def same_number_sql(a: str, b: str) -> str:
    """SQL: both cells hold the same number, and their unit words agree but for case and brackets or stand on one side only.

    A number printed twice (``400 (400) hp``) counts once.
    """

    def numbers(x: str) -> str:
        return f"array_distinct(transform(regexp_extract_all({x}, '({_NUMBER})', 1), n -> try_cast(replace(n, ',', '') as double)))"

    def words(x: str) -> str:
        return f"lower(trim(regexp_replace(regexp_replace({x}, '{_NUMBER}|[()\\\\[\\\\]]', ' '), '\\\\s+', ' ')))"

    return f"(size({numbers(a)}) > 0 and coalesce({numbers(a)} = {numbers(b)}, false) and ({words(a)} = {words(b)} or {words(a)} = '' or {words(b)} = ''))"


def category_sql(field: str, numeric: bool) -> str:
    """SQL: the category of one field of ``ref`` against ``port``; null where they are equal as stored."""
    a, b = f"ref.`{field}`", f"port.`{field}`"
    form = f"when {same_number_sql(a, b)} then 'format' " if numeric else ""
    return f"case when {a} <=> {b} then null when {a} is null then 'added' when {b} is null then 'dropped' {form}else 'conflict' end"


def diff(ref: DataFrame, port: DataFrame, keys: list[str], fields: list[str], numeric: list[str]) -> DataFrame:
    """(keys, field_name, category, old, new), one row per difference; ``*`` marks a row on one side only.

    Repeats of a row count once; where one side holds several unequal rows of a key, the least
    (fields compared in order, null first) stands for it and ``repeated`` reports the key. Null keys match null keys. Columns that
    are not named are ignored. The aggregate is partial, so repeats of a hot key are merged before
    the shuffle.
    """
    side = lambda df, name: df.select(*keys, F.struct(*fields).alias("row"), F.lit(name).alias("side"))
    both = side(ref, "ref").unionByName(side(port, "port"))
    pairs = both.groupBy(*keys).agg(F.min(F.when(F.col("side") == "ref", F.col("row"))).alias("ref"), F.min(F.when(F.col("side") == "port", F.col("row"))).alias("port"))
    one = lambda f: f"struct('{f}' as field_name, {category_sql(f, f in numeric)} as category, cast(ref.`{f}` as string) as old, cast(port.`{f}` as string) as new)"
    alone = "array(struct('*' as field_name, {0} as category, cast(null as string) as old, cast(null as string) as new))"
    found = f"""case when port is null then {alone.format("'only_ref'")} when ref is null then {alone.format("'only_port'")}
        else filter(array({", ".join(one(f) for f in fields)}), d -> d.category is not null) end"""
    return pairs.where("not (ref <=> port)").select(*keys, F.explode(F.expr(found)).alias("d")).select(*keys, "d.*")


def repeated(ref: DataFrame, port: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, side, n_rows, n_unequal) of keys for which one side holds several unequal rows, of which ``diff`` compares the least."""
    side = lambda df, name: df.select(*keys, F.xxhash64(*[x for f in fields for x in (F.col(f), F.col(f).isNull())]).alias("h"), F.lit(name).alias("side"))
    both = side(ref, "only_ref").unionByName(side(port, "only_port"))
    return both.groupBy(*keys, "side").agg(F.count("*").alias("n_rows"), F.count_distinct("h").alias("n_unequal")).where("n_unequal > 1")


def verdict(differences: DataFrame) -> DataFrame:
    """(field_name, category, n): how many differences of each kind."""
    return differences.groupBy("field_name", "category").agg(F.count("*").alias("n"))
