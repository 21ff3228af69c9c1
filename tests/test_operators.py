"""Typed cells, reports, resolution, versions, rules and streams on small fixtures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.functions import expressions as X
from millrace.functions import typed
from millrace.operators import grounding, resolve, routing, variants, versions, windows
from millrace.plans import entries, rules
from millrace.sources import dimensions, reports, runs, sinks
from millrace.streaming import writer

CELLS = [
    ("top_md_ft", "4,903.92 ft", 4903.92, None), ("top_md_ft", "", None, "empty_string"), ("top_md_ft", "10-20", None, "range_not_scalar"), ("top_md_ft", "10 to 20", None, "range_not_scalar"), ("top_md_ft", "abc", None, "not_numeric"),
    ("motor_hp", "400 (400) hp", 400.0, None), ("top_md_ft", "42 + 93x4", None, "composite_value"), ("top_md_ft", "5 widgets", 5.0, "unrecognized_unit_token"), ("oil_sg", "93.2 lb/ft3", None, "unit_dimension_mismatch"),
    ("cut_frac", "84.62 %", 0.8462, None), ("gas_pct", "0.7 (0-1)", 70.0, None), ("stages", "3.5", None, "non_integer_in_integer_column"), ("stages", " 12 ", 12.0, None), ("flag", "Yes", 1.0, None), ("flag", "maybe", None, "not_boolean"), ("stages", None, None, None), ("top_md_ft", " 7 ft ", 7.0, None),
]


def test_typing_table(spark):
    kinds = {"top_md_ft": "number", "motor_hp": "number", "oil_sg": "number", "cut_frac": "number", "gas_pct": "number", "stages": "int", "flag": "bool"}
    rows = spark.createDataFrame([(i, c[0], c[1], "x") for i, c in enumerate(CELLS)] + [(99, "other", "1", "x")], "id int, column string, raw string, reason string")
    got = {r.id: r for r in typed.typed_cells(rows, kinds).collect()}
    assert len(got) == len(CELLS)
    for i, c in enumerate(CELLS):
        assert got[i].reason == c[3], c
        assert got[i].value == (None if c[2] is None else pytest.approx(c[2])), c
    assert got[9].conversion and got[10].conversion and not got[0].conversion


REPORT = """---
source_document: a.pdf
well_name_source: body
codes:
  - x
  - y
---

## notes
no fence here
## pump
```jsonl
{"b": "1", "a": "2"}
{"a": "2", "b": "1"}
{"a": "3", "a": "4"}
```
```jsonl
{"c": ""}
{"d": "trunc
```
## row_counts
```jsonl
{"pump": 3, "other": "x"}
```
"""


def test_reports(spark, tmp_path):
    (tmp_path / "r1.md").write_text(REPORT)
    (tmp_path / "r2.md").write_text("\n")
    r = reports.scan(spark, str(tmp_path))
    assert sorted(x.report_id for x in r.collect()) == ["r1.md", "r2.md"]
    front = {x.report_id: x.frontmatter for x in reports.frontmatter(r).collect()}["r1.md"]
    assert front["source_document"] == "a.pdf" and front["codes"] == "x\ny"
    rows = reports.rows(r).where("block = 'pump'").orderBy("row_key").collect()
    assert [x.obj for x in rows] == [{"b": "1", "a": "2"}, {"a": "4"}, {"c": ""}]
    assert reports.rows(r, strict=True).where("block = 'pump'").count() == 2
    assert [x.raw_value for x in reports.truncated(r).collect()] == ['{"d": "trunc']
    got = {x.block: (x.declared, x.parsed, x.repeated, x.truncated, x.agrees) for x in reports.reconciliation(r).collect()}
    assert got["pump"] == (3, 3, 1, 1, True)
    assert got["other"] == (None, 0, 0, 0, False)
    legal = spark.createDataFrame([("pump", "a"), ("pump", "b"), ("row_counts", "pump"), ("row_counts", "other")], "block string, key string")
    assert [x.key for x in reports.unknown_keys(r, legal).collect()] == ["c"]


def test_resolution(spark):
    names = spark.createDataFrame([("ab 12",), ("AB-12",), ("Ab 12",), ("zz",), (None,), (" ",), ("tie1",)], "n string")
    cat = spark.createDataFrame([("Ab 12", None), ("TIE1", "c"), ("Tie1", "c")], "m string, basis string")
    found = resolve.catalogue_lookup(names, "n", cat, "m")
    assert {r.printed: (r.how, r.match, r.candidates) for r in found.collect()} == {
        "Ab 12": ("exact", "Ab 12", None), "ab 12": ("case", "Ab 12", None), "AB-12": ("key", "Ab 12", None), "zz": ("none", None, None), None: ("none", None, None), " ": ("none", None, None), "tie1": ("ambiguous", None, "TIE1|Tie1"),
    }
    kinds = {r.printed: r["class"] for r in resolve.unknown_models(found, cat, "m", "basis").collect()}
    assert kinds == {"Ab 12": "no_head_curve", "ab 12": "no_head_curve", "AB-12": "no_head_curve", "zz": "absent", None: "unresolved", " ": "unresolved", "tie1": "ambiguous"}
    assert [r.form for r in resolve.near_names(spark.createDataFrame([("A  b",), ("a b",), ("c",)], "n string"), "n").collect()] == ["a b"]


def test_alias_order(spark):
    names = spark.createDataFrame([("F", x) for x in ("flagged", "AX-100 (20 stg)", "pump AX 7", "12.5", "A and B", "mix", "??", "")], "f string, p string")
    flags = spark.createDataFrame([("flagged", "composite")], "printed_key string, flag string")
    seed = resolve.seed_table(spark.createDataFrame([("F", "ax-100", "AX100", "s", 1), ("F", "mix", resolve.COMPOSITE, "s", 2)], "f string, p string, c string, b string, o int"), "f", "p", "c", "b", "o")
    got = {r.printed: (r.canonical, r.flag) for r in resolve.alias_resolve(names, "p", "f", flags, seed, {"F": r"^AX \d+$"}, ["pump "]).collect()}
    assert got == {"flagged": (None, "composite"), "AX-100 (20 stg)": ("AX100", "seed"), "pump AX 7": ("AX7", "repaired"), "12.5": (None, "not_a_model"), "A and B": (None, "composite"), "mix": (None, "composite"), "??": (None, "unresolved"), "": (None, "unresolved")}


def test_versions(spark):
    schema = "k string, a string, b string"
    old = spark.createDataFrame([("1", "59.00", "x"), ("1", "60", "x"), ("2", "1800 psi", None), (None, "q", "q")], schema)
    new = spark.createDataFrame([("1", "59.00 (Hz)", "X"), ("2", "1800 psig", "n"), ("3", "1", "1"), (None, "q", "q")], schema)
    got = sorted((r.k or "", r.column, r.category) for r in versions.field_diffs(versions.positional(old, new, ["k"], ["a", "b"]), ["k"], ["a", "b"]).collect())
    assert got == [("1", "*", "dropped"), ("1", "a", "format"), ("1", "b", "conflict"), ("2", "a", "conflict"), ("2", "b", "added"), ("3", "*", "added")]
    pairs = versions.greedy_pairs(spark.createDataFrame([("g", 1, 1), ("g", None, 2), ("g", 3, 3)], "g string, a int, i long"), spark.createDataFrame([("g", 2, 10), ("g", 1, 11)], "g string, a int, i long"), ["g"], ["a"], "i")
    assert sorted((r.old_id or 0, r.new_id or 0) for r in pairs.collect()) == [(1, 11), (2, 10), (3, 0)]


def test_variants(spark):
    rows = spark.createDataFrame([("r", "1", 1, "1800", "u"), ("r", "2", 2, "1,800", "u"), ("r", "2", 3, "9", "u"), ("s", "1", 4, None, "u")], "r string, v string, i int, a string, b string")
    got = variants.variance(rows, ["r"], "v", ["i"], ["a", "b"], {"b": "allowed"}).collect()
    assert [(x.r, x.column, x.n_values, x.all_values) for x in got] == [("r", "a", 2, '{"1":"1800","2":"1,800"}')]
    same = {x.r: x.same for x in variants.identity_sets(rows, ["r"], "v", ["b"]).collect()}
    assert same == {"r": False, "s": True}
    seen = spark.createDataFrame([("r", "a", 1800.0)], "r string, c string, o double")
    assert variants.confirmed_variance(variants.variance(rows, ["r"], "v", ["i"], ["a"], {}), seen, ["r"], "c", "o").collect()[0].confirmed


def test_grounding(spark):
    pages = spark.createDataFrame([("d", 1, "set at 1,200 ft"), ("d", 2, "rate 45.5\nhp"), ("d", 3, None)], "d string, p int, t string")
    values = spark.createDataFrame([("d", "a", "1,200", "p1"), ("d", "b", "200", "p1"), ("d", "c", "45.5  hp", "1-3"), ("d", "e", "1,200 ft", "2"), ("d", "f", "", "1"), ("x", "g", "1", "1")], "d string, i string, v string, c string")
    got = {r.i: r.grounding for r in grounding.ground(values, pages, ["d"], "i", "v", "c", "p", "t").collect()}
    assert got == {"a": "cited_page", "b": "not_found", "c": "cited_page", "e": "other_page", "f": "not_evaluated", "g": "not_evaluated"}


def test_rules(spark):
    reg = rules.Registry()
    reg.row("A", "WARN", "t", "x")(lambda: F.col("x") > 1)
    reg.row("B", "HALT", "t", "x", needs=("missing",))(lambda: F.lit(True))
    reg.over("C", "HALT", "t")(lambda t: t["t"].agg(F.max("x").alias("value")).where("value > 2").selectExpr("cast(null as string) as row_key", "'x' as column", "value"))
    found, skipped = reg.run({"t": spark.createDataFrame([(1, 1), (2, 3), (3, None)], "id int, x int")}, {"t": "id"})
    assert skipped == ["B"]
    assert sorted((r.rule_id, r.row_key or "", r.value) for r in found.collect()) == [("A", "2", "3"), ("C", "", "3")]
    assert rules.status(found, ["table_name"]).collect()[0].status == "failed"


def test_entries_and_streams(spark, tmp_path):
    req = spark.createDataFrame([("c1", 5), ("c1", 5), ("c2", None)], "confirmation_id string, price int")
    req.write.parquet(str(tmp_path / "in"))
    for _ in (1, 2):  # the second run finds its rows committed
        stream = spark.readStream.schema(req.schema).parquet(str(tmp_path / "in"))
        writer.confirm_stream(spark, stream, {"price": "price > 1"}, str(tmp_path / "t"), str(tmp_path / f"c{_}")).awaitTermination()
    assert [r.confirmation_id for r in spark.read.parquet(str(tmp_path / "t/rows")).collect()] == ["c1"]
    e = spark.createDataFrame([("prd", "o", "w", "2024-01-01T13:00:00.000001", "a", 1), ("prd", "o", "w", "2024-01-01T13:00:00.000001", "b", 2), ("dev", "o", "w", "2023", "c", 3)], "environment string, organization_id string, well_id string, confirmed_at string, confirmation_id string, v int")
    assert sorted(r.v for r in entries.latest_entries(e).collect()) == [2, 3]
    e.createOrReplaceTempView("entries_t")
    assert sorted(r.v for r in spark.sql(entries.LATEST_SQL.format(table="entries_t")).collect()) == [2, 3]
    sinks.append_rows(e, str(tmp_path / "e"))
    assert spark.read.json(str(tmp_path / "e")).where("environment = 'dev'").count() == 1
    assert sinks.create_only(e, str(tmp_path / "once")) and not sinks.create_only(e, str(tmp_path / "once"))


def test_sources(spark, tmp_path):
    (tmp_path / "l.csv").write_text("﻿a,b\n1,x\n\n1,x\n2, y\n", encoding="utf-8")
    assert sorted(map(tuple, dimensions.strict_csv(spark, str(tmp_path / "l.csv"), ["a", "b"]).collect())) == [("1", "x"), ("2", " y")]
    with pytest.raises(ValueError, match="no column"):
        dimensions.strict_csv(spark, str(tmp_path / "l.csv"), ["z"])
    (tmp_path / "m.csv").write_bytes("h,i,,\né,".encode() + b"\x96,z\n")
    assert [r.cells for r in dimensions.mixed_encoding_csv(spark, str(tmp_path / "m.csv")).orderBy("line_no").collect()] == [["h", "i"], ["é", "–"]]
    (tmp_path / "runs/r1").mkdir(parents=True)
    (tmp_path / "runs/r1/run.json").write_text('{"run_id": "zz", "status": "running", "deadline_at": "2024-01-01T00:00:00"}')
    got = runs.with_state(runs.scan_runs(spark, str(tmp_path / "runs")), F.lit("2024-01-02").cast("timestamp")).collect()[0]
    assert (got.run_id, got.state) == ("r1", "stale")


def test_windows_and_expressions(spark):
    e = spark.createDataFrame([], "k int, o int, v int")
    for df in (windows.latest_per_key(e, ["k"], F.desc("o")), windows.arg_max(e, ["k"], ["v"], ["o"]), windows.consecutive_distinct(e, ["k"], ["o"], ["v"]), windows.backsteps(e, ["k"], ["o"], "v")):
        assert df.count() == 0
    rows = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (1, 3, None), (1, 4, None), (1, 5, 5), (None, 1, 1)], "k int, o int, v int")
    assert sorted(((r.k or 0), r.o) for r in windows.consecutive_distinct(rows, ["k"], ["o"], ["v"]).collect()) == [(0, 1), (1, 1), (1, 3), (1, 5)]
    got = spark.createDataFrame([("p13-15, p2", "a+b%20c")], "c string, l string").select(X.page_numbers(F.col("c")).alias("p"), X.decode_label(F.col("l")).alias("l"), X.half_last_digit(F.lit("12.3")).cast("double").alias("h")).collect()[0]
    assert (got.p, got.l, got.h) == ([2, 13, 14, 15], "a+b c", 0.05)


def test_routing(spark):
    pages = spark.createDataFrame([("d", 1, ["cover"], "x"), ("d", 2, [], "y"), ("d", 3, ["plot"], "z"), ("d", 4, None, None)], "d string, p int, roles array<string>, t string")
    got = {r.p: (r.role, r.kept, r.new_no) for r in routing.keep_pages(pages, "d", "p", "roles", "t", ["plot"]).collect()}
    assert got == {1: ("cover", True, 1), 2: ("cover", True, 2), 3: ("plot", False, None), 4: ("plot", True, 3)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", "/a/b")], "z int, a string, p string")
    sinks.write_grain(df, str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g")).count() == 1
    sinks.write_jsonl(df, str(tmp_path / "j"))
    assert [r.value for r in spark.read.text(str(tmp_path / "j")).collect()] == ['{"a":"x","p":"/a/b","z":1}']
    sinks.write_manifest(df, str(tmp_path / "m"), ["z", "a"])
    assert [r.asDict() for r in spark.read.csv(str(tmp_path / "m"), header=True).collect()] == [{"z": "1", "a": "x"}]
    assert df.select(sinks.relocate(F.col("p"), "/a", "/c").alias("p")).collect()[0].p == "/c/b"
    meta = sinks.sidecar(spark.createDataFrame([("n", {"k": "v"})], "name string, metadata map<string,string>"), "/x").collect()[0]
    assert (meta.file, meta.metadata) == ("/x/.n.metadata.json", '{"k":"v"}')
    log = spark.createDataFrame([(1, "old", 1), (2, "old", 1)], "k int, s string, at int")
    up = sinks.upsert(log, spark.createDataFrame([(1, "new", 1), (3, "new", 0)], "k int, s string, at int"), ["k"], "at")
    assert sorted((r.k, r.s) for r in up.collect()) == [(1, "new"), (2, "old"), (3, "new")]


def test_dimensions(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("Fam,Printed,Canon\nF1,Ab,one\nF1,aB ,two\n")
    assert [r.Canon for r in dimensions.csv_dimension(spark, str(tmp_path / "seed.csv"), ["Fam", "Printed"]).collect()] == ["two"]
    rows, skipped = dimensions.list_query(spark.createDataFrame([("a", None), (" ", "x"), (None, "y")], "k string, v string"), ["k", "v"], "k")
    assert [tuple(r) for r in rows.collect()] == [("a", "")] and skipped.collect()[0].skipped == 2
    (tmp_path / "v.jsonl").write_text('{"a": 1}\n[1]\nbad\n')
    assert [(r.obj, r.dropped) for r in dimensions.viewer_lines(spark, str(tmp_path / "v.jsonl")).collect()] == [('{"a": 1}', False), ('{"value":"[1]"}', False), (None, True)]
    (tmp_path / "asset.txt").write_text("content")
    import hashlib

    good = spark.createDataFrame([("asset.txt", hashlib.sha256(b"content").hexdigest())], "name string, sha256 string")
    assert bytes(dimensions.verified_asset(spark, str(tmp_path / "asset.txt"), good).collect()[0].content) == b"content"
    with pytest.raises(Exception, match="hash differs"):
        dimensions.verified_asset(spark, str(tmp_path / "asset.txt"), good.withColumn("sha256", F.lit("0"))).collect()
