"""Entries, guards, comparison, routes and text on small fixtures with nulls, ties, repeats and empty tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import expressions as X
from millrace.functions import text as T
from millrace.functions import typed
from millrace.operators import compare, entry, records, resolve, routing
from millrace.plans import guards
from millrace.sources import reports


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_single_values_and_entries(spark):
    cells = [("r", "2", "stages", "7"), ("r", "1", "stages", "9"), ("r", "1", "top_md_ft", "abc"), ("s", "3", "stages", "5"), (None, "1", "stages", None)]
    staged = spark.createDataFrame([(*c, "x") for c in cells], "r string, v string, column string, raw string, value string")
    found = entry.single_values(staged, ["r"], "v", "1", {"stages": "int", "top_md_ft": "number"})
    assert rows(found, "r", "column", "printed", "value", "reasons") == [
        ("r", "stages", "9", 9.0, ["varies_by_scenario"]), ("r", "top_md_ft", "abc", None, ["value_not_typed"]), ("s", "stages", "5", 5.0, []), (None, "stages", None, None, ["value_not_typed"]),
    ]
    made = entry.assembled(entry.reviewed(found, {"stages": "count", "top_md_ft": "ft"}), ["r"])
    assert rows(made, "r", "entry", "n_settled", "n_to_check") == [("r", '{"stages":{"value":9.0,"unit":"count"}}', 0, 2), ("s", '{"stages":{"value":5.0,"unit":"count"}}', 1, 0), (None, "{}", 0, 1)]
    assert entry.assembled(entry.reviewed(found.where("false"), {"stages": "count"}), ["r"]).count() == 0


def test_requests_and_refusals(spark):
    review = spark.createDataFrame([("a", "k1", "v", "settled"), ("a", "k2", None, "to_check"), ("a", "k3", "w", "blocks"), ("b", "k1", "v", "settled")], "r string, key string, value string, status string")
    over = spark.createDataFrame([("a", "k1", "new"), ("a", "k2", None)], "r string, key string, final string")
    asked = entry.build_requests(review, ["r"], over, F.lit(False), F.lit(True), F.lit(False))
    assert rows(asked, "r", "key", "final", "status", "why") == [("a", "k1", "new", "corrected", "set by hand"), ("a", "k2", None, "corrected", "set by hand"), ("a", "k3", "w", "to_check", "blocks publish"), ("b", "k1", "v", "settled", "as proposed")]
    given = asked.select("r", "key", "final", "status", F.lit(False).alias("accepted")).union(spark.createDataFrame([("b", "k9", "v", "settled", None)], "r string, key string, final string, status string, accepted boolean"))
    names = spark.createDataFrame([("v",), ("w",), (None,)], "n string")
    assert rows(entry.refusals(given, review, ["r"], names), "r", "reasons") == [("a", ["blocks: k3", "left to check: k3", "not a known spelling: k1"]), ("b", ["extra: k9"])]
    assert rows(entry.refusals(given.where("false"), review.where("r = 'b'"), ["r"]), "r", "reasons") == [("b", ["missing: k1"])]
    assert rows(entry.built_rows(asked, ["r"]), "r", "finals", "n_keys") == [("a", '{"k1":"new","k3":"w"}', 2), ("b", '{"k1":"v"}', 1)]
    assert rows(entry.version_record(asked, review, ["r"]), "key", "changed") == [("k1", False), ("k1", True), ("k2", False), ("k3", False)]
    assert rows(entry.anything_entered(asked, ["r"]), "r", "entered") == [("a", True), ("b", False)]


def test_string_checks(spark):
    sections = spark.createDataFrame([("a", 1, 1, 5, 5, "ok", "exact"), ("a", 2, 2, 3, None, "ok", "key"), ("b", 1, 3, None, 4, "needs_review", None)], "r string, position int, number int, stages int, list_sum int, status string, how string")
    records_ = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "r string")
    got = {(r.r, r.check): r.result for r in entry.string_checks(records_, sections, ["r"]).collect()}
    assert len(got) == 18 and {k[1] for k, v in got.items() if k[0] == "a" and v != "pass"} == set()
    assert {c: got["b", c] for c in ("order", "arithmetic", "conflict", "models", "complete")} == {"order": "fail", "arithmetic": "pass", "conflict": "fail", "models": "fail", "complete": "fail"}
    assert [got["c", c] for c in ("sections", "order", "arithmetic", "models")] == ["fail", "not_run", "not_run", "not_run"]
    status = entry.string_status(entry.string_checks(records_, sections, ["r"]), ["r"], ["order"])
    assert rows(status, "r", "status") == [("a", "settled"), ("b", "blocks"), ("c", "to_check")]


def test_modes_matches_and_tallies(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("a", None, 0), ("b", None, 0), (None, "z", 1)], "k string, v string, o int")
    assert rows(entry.mode_first(df, ["k"], "v", ["o"]), "k", "mode", "n") == [("a", "y", 1), (None, "z", 1)]
    assert rows(entry.tally(df, [("none", F.col("v").isNull()), ("late", F.col("o") > 1)], []), "case", "n") == [("late", 1), ("none", 2), ("other", 2)]
    left = spark.createDataFrame([(1, "d", "AB 12"), (2, "d", None), (3, None, "AB 12")], "i int, d string, a string")
    right = spark.createDataFrame([(7, "d", "ab12 X"), (5, "d", "ab-12"), (9, "e", "AB 12")], "j int, d string, b string")
    assert rows(entry.first_match(left, right, ["d"], resolve.same_model(F.col("a"), F.col("b")), "i", "j", "j"), "i", "j") == [(1, 5), (2, None), (3, None)]


def test_guards(spark):
    text = lambda front, prose, a, b, foot: f"{front}\n{prose}\n## a\n```jsonl\n{a}\n```\n{b}\n## row_counts\n{foot}\n"
    good = text("---\nsource: x\n---", "ok", '{"k": "1"}', "## b\n```jsonl\n{\"k\": \"2\"}\n```", '{"a": 1, "b": 1}')
    bad = text("", "**HALT** — V-02, then V-F1-3", "", "", '{"a": "1", "b": 1}')
    df = spark.createDataFrame([("good", good), ("bad", bad), ("empty", "")], "report_id string, text string")
    found = guards.structure(df, ["a", "b"]).unionByName(guards.counts(df)).unionByName(guards.emptiness(df, "a", "b"))
    ids = sorted((r.report_id, r.rule_id) for r in found.collect())
    assert ids == [("bad", "G-E1"), ("bad", "G-S1"), ("bad", "G-S2"), ("bad", "G-S3"), ("bad", "G-S4"), ("empty", "G-E1"), ("empty", "G-S1"), ("empty", "G-S2"), ("empty", "G-S2"), ("empty", "G-S3")]
    assert {r.report_id: r.rules for r in guards.declared_halts(df).collect()} == {"bad": ["V-02", "V-F1-3"]}
    assert rows(guards.status(df, found), "report_id", "status", "may_publish") == [("bad", "failed", False), ("empty", "failed", False), ("good", "passed", True)]
    assert reports.footer(df).where("report_id = 'bad'").select("block", "declared").collect() == [("a", None), ("b", 1)]


def test_compare(spark):
    schema = "r string, k string, v string"
    old = spark.createDataFrame([("a", "1", "5"), ("a", "2", "6"), ("b", "1", None), (None, "1", "x")], schema)
    new = spark.createDataFrame([("a", "1", "5 (u)"), ("a", "2", "7"), ("b", "1", None), (None, "1", "x"), ("c", "1", "9")], schema)
    assert rows(compare.traps(old, new, ["r"], "v"), "r", "old", "new", "category") == [("a", "5", "5 (u)", "format"), ("a", "6", "7", "conflict"), ("c", None, "9", "added")]
    got = {r.r: (r.table_ok, r.traps_ok, r.count_ok, r.passed) for r in compare.compared(old.where("r is not null"), new.where("r is not null"), ["r"], ["k"], ["v"], "v").collect()}
    assert got == {"a": (False, False, True, False), "b": (True, True, True, True), "c": (True, True, False, False)}
    same = compare.ordered_parity(old.where("r = 'a'"), old.where("r = 'a'"), ["r"], ["k"], ["v"]).collect()[0]
    assert (same.same_rows, same.same_order) == (True, True)
    turned = spark.createDataFrame([("a", "1", "6"), ("a", "2", "5")], schema)
    moved = compare.ordered_parity(old.where("r = 'a'"), turned, ["r"], ["k"], ["v"]).collect()[0]
    assert (moved.same_rows, moved.same_order) == (True, False)
    assert compare.compared(old.where("false"), new.where("false"), ["r"], ["k"], ["v"], "v").count() == 0


def test_routes(spark):
    pages = spark.createDataFrame([("d", 1, "Title\nA: one\nA: two"), ("d", 2, None), ("e", 1, "")], "doc string, p int, text string")
    m = [("t", "required", "title", "Tit"), ("a", "required", "start", "A:"), ("x", "optional", "re", "tw[o]"), ("n", "required", "line", "none")]
    hits = routing.first_lines(pages, ["doc", "p"], "text", m)
    assert rows(hits, "doc", "p", "role", "line") == [("d", 1, "a", "A: one"), ("d", 1, "t", "Title"), ("d", 1, "x", "A: two")]
    assert rows(routing.missing_roles(pages, "doc", hits, ["t", "a", "n"]), "doc", "missing") == [("d", ["n"]), ("e", ["t", "a", "n"])]


def test_text_and_labels(spark):
    df = spark.createDataFrame([("Ab  c d​ ",), ("",), (None,), ("%41+x.pdf",), ("a%2Fb.pdf",)], "t string")
    got = df.select("t", T.slug(F.col("t")).alias("s"), T.hidden_shown(F.col("t")).alias("h"), X.file_label(F.col("t")).alias("f")).collect()
    assert [r.s for r in got] == ["ab-c-d", "", None, "41-x-pdf", "a-2fb-pdf"]
    assert got[0].h == "Ab␣␣c°d¦␣" and got[1].h == "" and got[2].h is None
    assert [r.f for r in got] == [None, None, None, "A+x.pdf", None]
    glyphs = spark.createDataFrame([("x",), (None,)], "t string").select(T.repaired_glyphs(F.col("t"), {"": "-"}).alias("g")).collect()
    assert (glyphs[0].g.text, glyphs[0].g.left) == ("-x", 1) and glyphs[1].g.text is None
    obj = spark.createDataFrame([({"a": " 7 ", "b": ""},), ({},), (None,)], "o map<string,string>").select(typed.cell_text("o", "a").alias("a"), typed.cell_there("o", "b").alias("b"), typed.cell_number("o", "a").alias("n")).collect()
    assert [tuple(r) for r in obj] == [("7", False, 7.0), ("", False, None), ("", False, None)]


def test_projection_refuses_pressure_heads(spark):
    schema = "obs_id long, source_document string, pump_model_as_printed string, point_type string, flow_as_printed string, head_as_printed string, head_unit_as_printed string, head_basis_as_printed string, frequency_hz_as_printed string, stages_at_observation string, scenario_title_as_printed string, curve_observation_role string, observation_is_composite string"
    df = spark.createDataFrame([(1, "d", "m", "bep", "1", "1,200 ft", "ft", "total", "30 Hz", "4", " ", "cross_check", "true"), (2, "d", "m", None, None, "900", "PSI", None, None, None, None, None, None)], schema)
    a, b = records.observation_rows(df, ["bep"], ["cross_check"]).orderBy("obs_id").collect()
    assert (a.head, a.head60, a.label, a.is_envelope, a.is_withdrawn, a.is_composite) == (1200.0, 1200.0, "m", True, True, True)
    assert (b.head, b.head_reason, b.is_withdrawn) == (None, "pressure_unit", False)
    assert records.observation_rows(df.where("false"), ["bep"], []).count() == 0
