"""Problem 2: load the sound records of raw lines, refuse the rest with a reason.

Every line is read by a minimum-cost error parse. A parse that costs nothing and whose typed
fields are valid loads. Otherwise dynamic programming finds the cheapest insertions and deletions
of quotes and delimiters that make the line readable; they are reported and state the reason.

CSV lines are repaired in two steps, quotes before delimiters: a script costs ``QUOTE`` or more
exactly when no reading of the quotes as they stand exists, whatever the number of fields; among
the cheapest quote scripts the one that comes nearest to the header's fields is taken.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import date
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "line_id long, source_file string, block string, line_no int, raw_line string, status string, reason string, cost long, edits string, record map<string,string>"

_SOUND = re.compile(r'(?:"(?:[^"]|"")*+"|[^",]*+)(?:,(?:"(?:[^"]|"")*+"|[^",]*+))*+\Z')
_FIELD = re.compile(r'(?:"((?:[^"]|"")*+)"|([^",]*+))(?:,|\Z)')
_WHOLE = re.compile(r"[-+]?(?:\d+|\d{1,3}(?:,\d{3})+)(?:\.0*)?\Z")
_NUMBER = re.compile(r"[-+]?(?:\d+|\d{1,3}(?:,\d{3})+)?(?:\.\d+|(?<=\d)\.?)(?:[eE][-+]?\d+)?\Z")
_LENGTH = re.compile(r"(.*?)\s*(?:ft|feet)?\.?\Z", re.I | re.S)
_DAY = re.compile(r"\d{4}-\d{2}-\d{2}\Z")

#: Cost of a quote edit in CSV; a delimiter edit costs 1.
QUOTE = 1 << 20
#: In JSON: cost of a quote edit and of dropping any other character; a delimiter edit costs 1.
JSON_QUOTE, OTHER = 2, 8
_FAR = 1 << 60


def whole(text: str) -> bool:
    return bool(_WHOLE.match(text.strip()))


def length_ft(text: str) -> bool:
    return bool(_NUMBER.match(_LENGTH.match(text.strip()).group(1).strip()))


def real_day(text: str) -> bool:
    if not _DAY.match(text.strip()):
        return False
    try:
        date.fromisoformat(text.strip())
    except ValueError:
        return False
    return True


#: Typed fields and the test of their text. Open: a caller may add fields.
TYPED = {"stages": whole, "top_md_ft": length_ft, "effective_from": real_day}


def invalid_field(values: dict, empty_is_absent: bool) -> str | None:
    """The first typed field that is present but invalid."""
    for name, valid in TYPED.items():
        v = values.get(name)
        if v is None or (empty_is_absent and v == ""):
            continue
        if isinstance(v, bool) or not isinstance(v, str | int | float) or not valid(repr(v) if isinstance(v, float) else str(v)):
            return name
    return None


def _viterbi(text: str, start: int, accept: int, moves, inserts, order) -> tuple[int, list[str]]:
    """Cheapest edit script over an automaton.

    moves(state, char) -> [(state, cost, verb)] consume a character; inserts[state] -> [(state,
    cost, what)] put one in. Back pointers are one small tuple a cell; time and space are linear
    in the line.
    """
    n = len(text)
    now: dict[int, int] = {start: 0}
    back: list[dict[int, tuple]] = []

    def settle(cost: dict[int, int], links: dict[int, tuple]) -> None:
        for s in (*order, *order):
            c0 = cost.get(s)
            if c0 is not None:
                for t, c, what in inserts[s]:
                    c += c0
                    if c < cost.get(t, _FAR):
                        cost[t] = c
                        links[t] = (s, what, True)

    links: dict[int, tuple] = {}
    settle(now, links)
    back.append(links)
    for ch in text:
        then: dict[int, int] = {}
        links = {}
        for s in sorted(now):
            c0 = now[s]
            for t, c, verb in moves(s, ch):
                c += c0
                if c < then.get(t, _FAR):
                    then[t] = c
                    links[t] = (s, verb, False)
        settle(then, links)
        back.append(links)
        now = then
    edits, s, i = [], accept, n
    if accept not in now:
        return _FAR, []
    while True:
        link = back[i].get(s)
        if link is None:
            break
        p, what, inserted = link
        if what:
            edits.append(f"{what} at {i if inserted else i - 1}")
        s, i = p, i if inserted else i - 1
    return now[accept], edits[::-1]


def repair_csv(line: str, n_fields: int) -> tuple[int, list[str]]:
    """Cheapest script for ``line`` under a header of ``n_fields``; (0, []) if it reads as it stands.

    Quote edits cost QUOTE (dropping what follows a closing quote is one), each field too few or
    too many 1.
    """
    if _SOUND.match(line):
        return _delimiter_edits(line, n_fields)
    m = max(n_fields, 1)
    # state = 4 * (delimiters read, those beyond the header's as one) + (0 field begins, 1 bare, 2 quoted, 3 quote closed)
    inserts: list[list[tuple]] = []
    for f in range(m + 1):
        b = 4 * f
        inserts += [[(b + 2, QUOTE, 'insert "')], [], [(b + 3, QUOTE, 'insert "')], []]
    ends = 4 * (m + 1)
    inserts.append([])
    for f in range(m + 1):
        for k in (0, 1, 3):
            inserts[4 * f + k] = [*inserts[4 * f + k], (ends, abs(f + 1 - m), "")]

    def moves(s: int, ch: str) -> list[tuple]:
        if s == ends:
            return []
        f, k = divmod(s, 4)
        b = 4 * f
        if ch == '"':
            drop = (s, QUOTE, 'delete "')
            return [(b + 2, 0, "")] if k == 0 else [(b + 3, 0, ""), drop] if k == 2 else [(b + 2, 0, ""), drop] if k == 3 else [drop]
        if k == 2:
            return [(s, 0, "")]
        if ch == ",":
            return [(4 * min(f + 1, m), 0, "")]
        return [(s, QUOTE, "delete " + ch)] if k == 3 else [(b + 1, 0, "")]

    return _viterbi(line, 0, ends, moves, inserts, range(ends))


def _delimiter_edits(line: str, n_fields: int) -> tuple[int, list[str]]:
    """Delimiters to put in or take out of a line of sound quoting; those whose loss keeps it sound go first, from the end."""
    found, at = [], 0
    while True:
        m = _FIELD.match(line, at)
        found.append((m.start(), m.group(1) is not None))
        at = m.end()
        if at == len(line) and not (m.group(0).endswith(",") and m.end() > m.start()):
            break
    few = n_fields - len(found)
    if few >= 0:
        return few, [f"insert , at {len(line)}"] * few
    joints = [(found[i][0] - 1, found[i][1] == found[i - 1][1]) for i in range(1, len(found))]
    out = sorted(joints, key=lambda j: (not j[1], -j[0]))[:-few]
    return -few, [f"delete , at {p}" for p, _ in sorted(out)]


#: States of the automaton of one flat JSON object, as RFC 8259 has it.
(BEGIN, FIRST, KEY, COLON, VALUE, TEXT, NEXT, AGAIN, DONE, KEY_ESC, TEXT_ESC, MINUS, ZERO, WHOLE, POINT, TENTHS, EXP, EXP_SIGN, POWER, LITERAL) = range(20)
_KEY_HEX, _TEXT_HEX = 20, 24  # four states each: digits of an escape still to come
_LITERALS: dict[tuple[int, str], int] = {}
_N_STATES = 28
for _word in ("true", "false", "null"):
    _at = VALUE
    for _i, _ch in enumerate(_word):
        if _i == len(_word) - 1:
            _LITERALS[_at, _ch] = LITERAL
        else:
            _LITERALS[_at, _ch] = _N_STATES
            _at = _N_STATES
            _N_STATES += 1
_DIGITS = {MINUS: WHOLE, WHOLE: WHOLE, POINT: TENTHS, TENTHS: TENTHS, EXP: POWER, EXP_SIGN: POWER, POWER: POWER}
_STEP = {BEGIN: {"{": FIRST}, FIRST: {'"': KEY, "}": DONE}, COLON: {":": VALUE}, VALUE: {'"': TEXT, "-": MINUS}, NEXT: {",": AGAIN, "}": DONE}, AGAIN: {'"': KEY}}
_NUMBER_STEP = {ZERO: {".": POINT, "e": EXP, "E": EXP}, WHOLE: {".": POINT, "e": EXP, "E": EXP}, TENTHS: {"e": EXP, "E": EXP}, EXP: {"+": EXP_SIGN, "-": EXP_SIGN}}
_ENDS_VALUE = (ZERO, WHOLE, TENTHS, POWER, LITERAL)
_INSERTS: list[list[tuple]] = [[] for _ in range(_N_STATES)]
_INSERTS[BEGIN] = [(FIRST, 1, "open {")]
_INSERTS[FIRST] = [(KEY, JSON_QUOTE, 'insert "'), (DONE, 1, "close }")]
_INSERTS[KEY] = [(COLON, JSON_QUOTE, 'insert "')]
_INSERTS[COLON] = [(VALUE, 1, "insert :")]
_INSERTS[VALUE] = [(TEXT, JSON_QUOTE, 'insert "')]
_INSERTS[TEXT] = [(NEXT, JSON_QUOTE, 'insert "')]
_INSERTS[NEXT] = [(AGAIN, 1, "insert ,"), (DONE, 1, "close }")]
_INSERTS[AGAIN] = [(KEY, JSON_QUOTE, 'insert "')]
for _s in _ENDS_VALUE:
    _INSERTS[_s] = [(NEXT, 0, "")]
_ORDER = (BEGIN, FIRST, AGAIN, KEY, COLON, VALUE, TEXT, *_ENDS_VALUE, NEXT)


@lru_cache(maxsize=100_000)
def _json_moves(s: int, ch: str) -> list[tuple]:
    if s in (KEY, TEXT):
        inner = KEY_ESC if s == KEY else TEXT_ESC
        if ch == '"':
            return [(COLON if s == KEY else NEXT, 0, ""), (s, JSON_QUOTE, 'delete "')]
        if ch == "\\":
            return [(inner, 0, ""), (s, OTHER, "delete \\")]
        return [(s, 0, "")] if ch >= " " else [(s, OTHER, "delete " + ch)]
    if s in (KEY_ESC, TEXT_ESC):
        back = KEY if s == KEY_ESC else TEXT
        if ch in '"\\/bfnrt':
            return [(back, 0, "")]
        return [((_KEY_HEX if s == KEY_ESC else _TEXT_HEX), 0, "")] if ch == "u" else [(s, OTHER, "delete " + ch)]
    if _KEY_HEX <= s < _TEXT_HEX + 4:
        last = s in (_KEY_HEX + 3, _TEXT_HEX + 3)
        then = (KEY if s < _TEXT_HEX else TEXT) if last else s + 1
        return [(then, 0, "")] if ch in "0123456789abcdefABCDEF" else [(s, OTHER, "delete " + ch)]
    verb = "before " if s == BEGIN else "after " if s == DONE else "delete "
    drop = (s, JSON_QUOTE if ch in "\"'“”‘’„" else 1 if ch in ",:;{}[]" else OTHER, verb + ch)
    if ch in "0123456789":
        to = ZERO if ch == "0" and s in (VALUE, MINUS) else WHOLE if s == VALUE else _DIGITS.get(s)
    else:
        to = _STEP.get(s, {}).get(ch) or _NUMBER_STEP.get(s, {}).get(ch) or _LITERALS.get((s, ch))
    if to is not None:
        return [(to, 0, ""), drop]
    return [(s, 0, "")] if ch in " \t\n\r" and s in (BEGIN, FIRST, COLON, VALUE, NEXT, AGAIN, DONE) else [drop]


def repair_json(line: str) -> tuple[int, list[str]]:
    """Cheapest script that makes ``line`` one flat JSON object; (0, []) if it is one.

    Outer braces that stand are kept: what opens or closes the object is edited only where the line
    does not begin with ``{`` or end with ``}``.
    """
    if line[:1] != "{" or len(line) < 2:
        return _viterbi(line, BEGIN, DONE, _json_moves, _INSERTS, _ORDER)
    if line[-1] != "}":
        cost, edits = _viterbi(line[1:], FIRST, DONE, _json_moves, _INSERTS, _ORDER)
        return cost, _moved(edits)
    inside = [[m for m in ms if m[0] != DONE] for ms in _INSERTS]
    best = (_FAR, [])
    for end in (NEXT, FIRST):  # the object closes after a value or is empty
        found = _viterbi(line[1:-1], FIRST, end, _inner_moves, inside, _ORDER)
        best = min(best, found, key=lambda f: f[0])
    return best[0], _moved(best[1])


@lru_cache(maxsize=100_000)
def _inner_moves(s: int, ch: str) -> list[tuple]:
    return [m for m in _json_moves(s, ch) if m[0] != DONE]


def _moved(edits: list[str]) -> list[str]:
    """Edits of a line without its first character, at their places in the line."""
    return [f"{e.rpartition(' ')[0]} {int(e.rpartition(' ')[2]) + 1}" for e in edits]


#: What an edit of a report line does to the record, by its verb; any other breaks its quoting.
_REASON = {"open": "not_a_record", "before": "not_a_record", "close": "truncated_line", "after": "truncated_line"}


def reason_of(edits: list[str]) -> str:
    """The reason an edit script states: no opening comes before no end, and that before what is inside."""
    named = {_REASON.get(e.partition(" ")[0], "broken_quoting") for e in edits}
    return next((r for r in ("not_a_record", "truncated_line") if r in named), "broken_quoting")


def _no_constant(name: str) -> None:
    raise ValueError(name)


_STRICT = json.JSONDecoder(parse_constant=_no_constant)


def read_md(raw: str) -> tuple[str, str | None, int, str, dict | None]:
    """(status, reason, cost, edits, record) of a line of a report block.

    A line that decodes strictly is the parse of cost 0, found without the search; on flat objects
    the two agree. A line that costs nothing loads, unless a typed field is invalid.
    """
    line = raw.strip()
    if not line or line.startswith("```"):
        return "skipped", None, 0, "", None
    try:
        values = _STRICT.decode(line) if line[0] == "{" else None
    except (ValueError, RecursionError):
        values = None
    if isinstance(values, dict):
        bad = invalid_field(values, empty_is_absent=False)
        if bad:
            return "refused", "invalid_value", 0, f"invalid {bad}", None
        return "loaded", None, 0, "", {k: v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for k, v in values.items() if v is not None}
    cost, edits = repair_json(line)
    return "refused", reason_of(edits), max(cost, 1), "; ".join(edits) or "too deep", None


def read_csv(raw: str, header: list[str]) -> tuple[str, str | None, int, str, dict | None]:
    """(status, reason, cost, edits, record) of a line of an export with ``header``."""
    if _SOUND.match(raw):
        fields, at = [], 0
        while True:
            m = _FIELD.match(raw, at)
            fields.append(m.group(2) if m.group(1) is None else m.group(1).replace('""', '"'))
            at = m.end()
            if at == len(raw) and not (m.group(0).endswith(",") and m.end() > m.start()):
                break
        if len(fields) == len(header):
            values = dict(zip(header, fields, strict=True))
            bad = invalid_field(values, empty_is_absent=True)
            if bad:
                return "refused", "invalid_value", 0, f"invalid {bad}", None
            return "loaded", None, 0, "", {k: v for k, v in values.items() if v != ""}
    cost, edits = repair_csv(raw, len(header))
    return "refused", "broken_quoting" if cost >= QUOTE else "wrong_field_count", cost, "; ".join(edits), None


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    headers: dict[str, list[str]] = {}
    for pdf in batches:
        out = []
        for name, raw, no, head in zip(pdf["source_file"], pdf["raw_line"], pdf["line_no"], pdf["header"], strict=True):
            if raw is None:
                out.append(("skipped", None, 0, "", None))
            elif name is None or not name.lower().endswith(".csv"):
                out.append(read_md(raw))
            elif no == 1:
                out.append(("skipped", None, 0, "", None))
            else:
                if len(headers) > 10_000:
                    headers.clear()
                if head not in headers:
                    headers[head] = [(a or b).replace('""', '"') for a, b in _FIELD.findall(head)][: 1 + _commas(head)] if head else [""]
                out.append(read_csv(raw, headers[head]))
        res = pd.DataFrame(out, columns=["status", "reason", "cost", "edits", "record"], index=pdf.index)
        yield pd.concat([pdf.drop(columns="header"), res], axis=1)


def _commas(head: str) -> int:
    return len(re.sub(r'"(?:[^"]|"")*"', "", head)) - len(re.sub(r'"(?:[^"]|"")*"', "", head).replace(",", ""))


def read_lines(raw_lines: DataFrame) -> DataFrame:
    """Every raw line with ``status`` loaded, refused or skipped, and ``record`` or ``reason`` and ``edits``.

    Skipped are CSV headers (line 1), blank lines and fences of report blocks, and null lines; an
    empty CSV line is a record of one empty field. A CSV file whose header is missing is read as
    having one column. Repeated lines stay. Extra input columns are not carried.

    Headers are one row per file; the join to them is left to the planner, which broadcasts them
    only below its measured threshold and splits skewed files otherwise.
    """
    rows = raw_lines.select("line_id", "source_file", "block", F.col("line_no").cast("int").alias("line_no"), "raw_line")
    is_csv = F.lower("source_file").endswith(".csv")
    headers = rows.where(is_csv & (F.col("line_no") == 1)).groupBy(F.col("source_file").alias("f")).agg(F.min("raw_line").alias("header"))
    joined = rows.join(headers, is_csv & (F.col("source_file") == F.col("f")), "left").drop("f")
    return joined.mapInPandas(_read, RESULT)


def loaded(raw_lines: DataFrame) -> DataFrame:
    return read_lines(raw_lines).where("status = 'loaded'").select("line_id", "source_file", "block", "line_no", "record")


def quarantine(raw_lines: DataFrame) -> DataFrame:
    """The refused records: raw text, reason, the edit script and its cost."""
    return read_lines(raw_lines).where("status = 'refused'").select("line_id", "source_file", "block", "line_no", F.col("raw_line").alias("raw_value"), "reason", "cost", "edits")
