"""Problem 2: the error parse."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.sources import damaged_lines as D

HEADER = ["organization_id", "well_id", "effective_from", "top_md_ft", "stages"]
CSV = [
    ('o,"w, pad 4",2024-01-02,"4,100.5",12', None), ('o,"w ""N""",,,', None), ('o,w,2024-01-02,"",12', None), ("o,w,2024-02-30,,", "invalid_value"), ("o,w,,9 psi,", "invalid_value"), ("o,w,,7 ft,1.5", "invalid_value"),
    ("o,w,2024-01-02,4,100.5,12", "wrong_field_count"), ("o,w", "wrong_field_count"), ("", "wrong_field_count"), ('o,"w,2024-01-02,4,12', "broken_quoting"), ('o,"w"x,2024-01-02,4,12', "broken_quoting"),
    ('o,w",2024-01-02,4,12', "broken_quoting"), ('o,"w "N" p",2024-01-02,4,12', "broken_quoting"), ('o,"w\nn",,,', None),
]
MD = [
    ('{"stages": "1,204", "top_md_ft": "9 feet"}', None), (' {"stages": 12} ', None), ('{"stages": null}', None), ('{"stages": ""}', "invalid_value"), ('{"stages": true}', "invalid_value"), ('{"stages": 1.5}', "invalid_value"),
    ('{"effective_from": "2023-13-01"}', "invalid_value"), ("---", "not_a_record"), ('[{"a": 1}]', "not_a_record"), ('{"a": "b', "truncated_line"), ('{"a": "b"} x', "truncated_line"), ('{"a": "b";"c": 1}', "broken_quoting"),
    ("{'a': 'b'}", "broken_quoting"), ('{"a": NaN}', "broken_quoting"), ('{"a": 1}}', "broken_quoting"), ("{}", None),
]


@pytest.mark.parametrize(("line", "reason"), CSV)
def test_csv(line, reason):
    assert D.read_csv(line, HEADER)[1] == reason


@pytest.mark.parametrize(("line", "reason"), MD)
def test_md(line, reason):
    assert D.read_md(line)[1] == reason


def test_blank_and_fence_are_no_records():
    assert D.read_md("  ")[0] == D.read_md("```jsonl")[0] == "skipped"


def apply(line: str, edits: list[str]) -> str:
    out = []
    by_place: dict[int, list[str]] = {}
    for e in edits:
        what, place = e.rsplit(" at ", 1)
        by_place.setdefault(int(place), []).append(what)
    for i in range(len(line) + 1):
        todo = by_place.get(i, [])
        out += [x.removeprefix("insert ") for x in todo if x.startswith("insert ")]
        if i < len(line) and not any(x.startswith("delete ") for x in todo):
            out.append(line[i])
    return "".join(out)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='ab",', max_size=14), st.integers(1, 4))
def test_csv_scripts_repair(line, n):
    cost, edits = D.repair_csv(line, n)
    sound = bool(D._SOUND.match(line))
    assert (cost >= D.QUOTE) == (not sound)
    fixed = apply(line, edits)
    if not sound:
        assert D._SOUND.match(fixed)
        assert D.repair_csv(fixed, n)[0] == cost % D.QUOTE or cost % D.QUOTE == 1
    elif D._SOUND.match(fixed):
        assert D.read_csv(fixed, [str(i) for i in range(n)])[0] == "loaded"
    else:
        assert cost and all(e.startswith("delete ,") for e in edits)


def fewest_quote_edits(line):
    """Breadth-first over insertions and deletions of quotes."""
    seen, edge, n = {line}, [line], 0
    while not any(D._SOUND.match(x) for x in edge):
        n += 1
        edge = {y for x in edge for i in range(len(x) + 1) for y in ([x[:i] + '"' + x[i:]] + ([x[:i] + x[i + 1 :]] if i < len(x) and x[i] == '"' else []))} - seen
        seen |= edge
    return n


@settings(max_examples=120, deadline=None)
@given(st.text(alphabet='a",', max_size=6), st.integers(1, 3))
def test_csv_scripts_are_cheapest(line, n):
    cost, edits = D.repair_csv(line, n)
    fewest = fewest_quote_edits(line)
    assert cost // D.QUOTE <= fewest
    if all(e.split(" ")[1] in '",' for e in edits):
        assert cost // D.QUOTE == fewest


def test_table(spark):
    rows = [
        (1, "a.csv", "well_list", 1, ",".join(HEADER), 9), (2, "a.csv", "well_list", 2, CSV[0][0], 9), (3, "a.csv", "well_list", 3, "o,w", 9), (4, "a.md", "b", 1, None, 9), (5, "a.md", "b", 2, "", 9),
        (6, "a.md", "b", 3, '{"a": "x"}', 9), (6, "a.md", "b", 3, '{"a": "x"}', 9), (7, None, "b", 4, "{", 9), (8, "none.csv", "w", 2, "a", 9), (9, "a.md", "b", 5, '{"a": "' + "é" * 50_000, 9),
    ]
    df = spark.createDataFrame(rows, "line_id long, source_file string, block string, line_no int, raw_line string, reason int")
    got = {r.line_id: r for r in D.read_lines(df).collect()}
    assert [got[i].status for i in range(1, 10)] == ["skipped", "loaded", "refused", "skipped", "skipped", "loaded", "refused", "loaded", "refused"]
    assert got[9].reason == "truncated_line"
    assert D.read_lines(df.where("line_id < 0")).count() == 0


FLAT = st.dictionaries(st.text('ab"\\é {},:', max_size=4), st.one_of(st.none(), st.booleans(), st.integers(-99, 99), st.floats(allow_nan=False, allow_infinity=False, width=16), st.text('xy"\\,:{} ', max_size=6)), max_size=3)


@settings(max_examples=400, deadline=None)
@given(FLAT, st.data())
def test_cost_is_zero_for_flat_objects_only(record, data):
    line = D.json.dumps(record, ensure_ascii=data.draw(st.booleans()))
    assert D.repair_json(line) == (0, [])
    i = data.draw(st.integers(0, len(line) - 1))
    other = line[:i] + data.draw(st.sampled_from(["", '"', "\\", "}", "0", ",", "\t"])) + line[i + 1 :]
    try:
        strict = D._STRICT.decode(other)
        flat = isinstance(strict, dict) and not any(isinstance(v, dict | list) for v in strict.values())
    except ValueError:
        flat = False
    assert (D.repair_json(other)[0] == 0) == flat


def put_right(line: str, edits: list[str]) -> str:
    out = []
    for i in range(len(line) + 1):
        here = [e.rpartition(" at ")[0] for e in edits if int(e.rpartition(" at ")[2]) == i]
        out += [e.partition(" ")[2] for e in here if e.startswith(("insert ", "open ", "close "))]
        if i < len(line) and not any(e.startswith(("delete ", "before ", "after ")) for e in here):
            out.append(line[i])
    return "".join(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet='{}",:ab1\\ [', min_size=1, max_size=14).map(str.strip).filter(bool))
def test_reasons_follow_from_the_edits(line):
    status, reason, cost, edits, _ = D.read_md(line)
    if status == "loaded":
        return
    assert reason == ("not_a_record" if line[0] != "{" else "truncated_line" if line[-1] != "}" else "broken_quoting")
    script = D.repair_json(line)
    if script[0] == 0:  # nested values are beyond the automaton
        return
    assert isinstance(D._STRICT.decode(put_right(line, script[1])), dict)
