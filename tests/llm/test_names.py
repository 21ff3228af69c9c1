"""Problem 3: the trie, the automaton and the ladder around them."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import name_match as N

ENTRIES = [(1, "ZAKEL 6880T", "Acme"), (2, "Davon 562-890", "Acme"), (3, "KUKIV7960 CW", "Bolt Works"), (4, "Kukiv7960 Cw", "Bolt Works"), (5, "Nelox-650", None), (6, "Tunüt 400-9180", "Düna")]


def osa(a, b):
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=7), min_size=1, max_size=6), st.text("abc", min_size=1, max_size=7), st.integers(0, 3))
def test_automaton_is_the_distance(words, query, k):
    trie = N.Trie()
    for i, w in enumerate(words):
        trie.add(w, i)
    assert trie.within(query, k) == {i: osa(query, w) for i, w in enumerate(words) if osa(query, w) <= k}


def test_ladder():
    names = N.NameList(ENTRIES)
    cases = {
        "ZAKEL 6880T": 1, "zakel6880t": 1, "PUMP Zakel 6880T, 184 stages": 1, "Acme / Zakel 6880T": 1, "[zakel 688OT] by Acme": 1, "6880T Zakel": 1, "Zkl 6880T": 1, "Ｚаkel 68​80T (20 stg)": 1, "Zakle 6880T": 1,
        "Davon 562/890": 2, "Tunut 400-9180": 6, "KUKIV7960 CW": 3, "Kukiv7960 Cw": 4, "kukiv7960 cw": -1, "Zakel 6880T and Nelox-650": -1, "Zakel 6880T w/ Nelox-650 47hp": -1, "Vogul 1912Q": -1, "- rental unit": -1, "***": -1,
    }
    assert {k: names.resolve(k)[0] for k in cases} == cases


def test_alias_with_a_typo():
    names = N.NameList(ENTRIES)
    cases = {"6880T Zakwl": (1, "alias", 1), "Zkl 688T": (1, "alias", 1), "562-890 Davom": (2, "alias", 1), "Zakwl 6880T": (1, "name", 1), "Zxyl 688T": (-1, "unmatched", 0)}
    assert {k: names.resolve(k) for k in cases} == cases
    # the nearest over both tries, and several at one distance are no answer
    both = N.NameList([(1, "Abcd 123", None), (2, "123 Abxd", None), (3, "Efgh 456", None), (4, "456 Exfgh", None)])
    assert both.resolve("Abcd 12")[0] == 1
    near = {e: min(osa("abcx123", p) for p in paths) for e, paths in {1: ("abcd123", "123abcd"), 2: ("123abxd", "abxd123")}.items()}
    assert near == {1: 1, 2: 2} and both.resolve("Abcx 123") == (1, "name", 1)
    tied = N.NameList([(1, "Abcde 123", None), (2, "123 Abcdf", None)])
    assert tied.resolve("Abcdg 123") == (-1, "ambiguous", 1)


def test_table(spark):
    rows = spark.createDataFrame([(1, "zakel 6880t", "a"), (1, "zakel 6880t", "a"), (2, None, "b"), (3, "  ", "c"), (4, "x" * 20_000, "d"), (5, "", "e")], "config_id long, printed string, model_id string")
    ref = spark.createDataFrame(ENTRIES + [(9, None, None), (None, "Nothing 1", None)], "id long, name string, maker string")
    got = N.match_names(rows, "config_id", "printed", ref, "id", "name", "maker")
    assert sorted((r.config_id, r.model_id) for r in got.collect()) == [(1, 1), (1, 1), (4, -1)]
    assert N.match_names(rows.where("config_id = 1"), "config_id", "printed", ref.where("id < 0"), "id", "name", "maker").collect()[0].model_id == -1
    assert N.match_names(rows.where("config_id > 99"), "config_id", "printed", ref, "id", "name", "maker").count() == 0


def test_all_entries_within_the_distance():
    entries = [(1, "Kinen 1880N", None), (2, "Ruvus 400-8750", None), (3, "Kinem 1880N", None)]
    names = N.NameList(entries)
    assert [names.resolve(x)[:2] for x in ("1880N Kinen", "1880M Kinen", "400-8750 Ruvvs")] == [(1, "alias"), (1, "alias"), (2, "alias")]
    # both are within one edit; the nearer one is the answer, and both are listed
    assert names.answer("Kinen 1880N.")[3] == [(1, 0, "exact")] or {c[:2] for c in names.answer("Kinen 1880N.")[3]} == {(1, 0), (3, 1)}
    assert {c[:2] for c in names.answer("Kinex 1880N")[3]} == {(1, 1), (3, 1)} and names.resolve("Kinex 1880N")[1] == "ambiguous"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abé1- ", min_size=1, max_size=9), min_size=1, max_size=5, unique=True), st.text("abé1- ", max_size=16))
def test_candidates_against_every_path(words, text):
    names = N.NameList([(i, w, None) for i, w in enumerate(words)])
    exact, whole, _ = names.look_up(text)
    key = N.key_of(names.stripped(text))
    paths = {}

    def walk(node, path):
        for ch, child in node.items():
            if ch == "":
                for e in child:
                    paths.setdefault(e, []).append(path)
            else:
                walk(child, path + ch)

    walk(names.trie.root, "")
    if not exact and key:
        k = N.allowed(len(key))
        assert whole == {e: min(osa(key, p) for p in ps) for e, ps in paths.items() if min(osa(key, p) for p in ps) <= k}


def test_parts_do_not_change_the_result(spark, monkeypatch):
    texts = ["zakel 6880t", "6880T Zakel", "kukiv7960 cw", "Zakel 6880T and Nelox-650", "Davon 562-890 + davon 562 890", "Vogul", "Tunut 400-9180", "Nelox-651", "Zakel 6880T by Acme"]
    rows = spark.createDataFrame(list(enumerate(texts)), "config_id long, printed string")
    ref = spark.createDataFrame(ENTRIES, "id long, name string, maker string")
    got = lambda: sorted((r.config_id, r.model_id, r.how, r.distance, tuple(map(tuple, r.candidates))) for r in N.match_names(rows, "config_id", "printed", ref, "id", "name", "maker").collect())
    whole = got()
    monkeypatch.setattr(N, "MAX_ENTRIES", 2)
    assert got() == whole
