"""Printed quantities to feet and psia, as Column expressions.

A unit is looked for in three places, in this order: with the number, in the unit column, in a
free text that speaks of the value. Everything is a built-in expression, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.fence import fenced

# Unit tokens (lower case; spaces, brackets and dots removed) and their size in feet.
LENGTH_FT = {
    "ft": 1.0, "feet": 1.0, "foot": 1.0, "'": 1.0, "fttvd": 1.0, "ftmd": 1.0,
    "m": 3.280839895013123, "meter": 3.280839895013123, "meters": 3.280839895013123, "metre": 3.280839895013123,
    "metres": 3.280839895013123, "mtr": 3.280839895013123, "mtrs": 3.280839895013123, "mts": 3.280839895013123,
    "mt": 3.280839895013123, "mtvd": 3.280839895013123, "mmd": 3.280839895013123,
    "kft": 1000.0, "mft": 1000.0, "km": 3280.839895013123, "kilometers": 3280.839895013123, "kilometres": 3280.839895013123,
    "cm": 0.03280839895013123, "mm": 0.003280839895013123, "dm": 0.3280839895013123,
    "in": 1 / 12, "inch": 1 / 12, "inches": 1 / 12, '"': 1 / 12, "yd": 3.0, "yds": 3.0, "yard": 3.0, "yards": 3.0,
}

# Pressure units, spelling to size in psi. A basis suffix is read apart.
PRESSURE_PSI = {
    "psi": 1.0, "lb/in2": 1.0, "lb/in²": 1.0, "lbf/in2": 1.0, "lbf/in²": 1.0, "ksi": 1000.0, "kpsi": 1000.0, "mpsi": 1e6,
    "kpa": 0.1450377377, "mpa": 145.0377377, "hpa": 0.01450377377, "pa": 0.0001450377377, "gpa": 145037.7377,
    "bar": 14.50377377, "bars": 14.50377377, "mbar": 0.01450377377, "atm": 14.69594878, "atms": 14.69594878,
    "kg/cm2": 14.22334331, "kg/cm²": 14.22334331, "kgf/cm2": 14.22334331, "kgf/cm²": 14.22334331, "ksc": 14.22334331, "at": 14.22334331,
    "torr": 0.0193367747, "mmhg": 0.0193367747, "inhg": 0.4911541,
}

#: Added to a gauge pressure.
ATMOSPHERE_PSI = 14.7

NUMBER = r"[-+]?(?:\d[\d,]*(?:\.\d+)?|\.\d+)(?:[eE][-+]?\d+)?"
_S = r"[\s\u00a0\u2000-\u200b\u202f\u205f\u2060\u3000]"
#: One pass over a cell: number, mark of a range, multiplier and unit up to the next printed value.
_CELL = (
    f"(?s)^{_S}*({NUMBER}){_S}*(?:((?:-|–|—|±|to\\b|\\.\\.){_S}*[\\d.])|"
    f"(\\(?{_S}*(?:[x×*]?{_S}*10{_S}*\\^{_S}*\\d+|[x×*]{_S}*\\d+)?[^\\d;=]*?(?:(?:in|cm)[2²][^\\d;=]*?)?)(?={_S}*$|{_S}*[(/,;=~]*{_S}*[-+]?\\d|[;=])).*$"
)
_MARK = "\u0001"
#: A multiplier printed before a unit: ``x1000 ft``, ``(1000 ft)``.
LEAD = r"^[(\[]?\s*[x×*]?\s*(\d+)\s*(?=[a-zA-Z'])"
_GAUGE = ("g", "gauge", "gage")
_ABSOLUTE = ("a", "abs", "absolute")


def squeezed(unit: Column) -> Column:
    """Lower case, without spaces, brackets and dots."""
    return F.translate(F.lower(unit), " \t\n\r\u00a0\u2009\u202f\u2007()[].:", "")


def _unit_map() -> Column:
    """Map of squeezed unit -> struct<dim, scale, gauge>; one literal text, folded when planned, so plans stay small."""
    entries = {u: {"dim": "length", "scale": size, "gauge": False} for u, size in LENGTH_FT.items()}
    for unit, size in PRESSURE_PSI.items():
        for basis in ("", *_GAUGE, *_ABSOLUTE):
            entries.setdefault(unit + basis, {"dim": "pressure", "scale": size, "gauge": basis in _GAUGE})
    return F.from_json(F.lit(json.dumps(entries)), "map<string, struct<dim: string, scale: double, gauge: boolean>>")


def cell_parts(text: Column) -> Column:
    """array<number text, range mark, unit text> of a printed cell, null if it begins with no number."""
    parts = F.split(F.regexp_replace(text, _CELL, f"{_MARK}$1{_MARK}$2{_MARK}$3"), _MARK)
    return F.when(F.size(parts) == 4, parts)


def number_in(parts: Column) -> Column:
    """The single number of ``cell_parts``, null for none or a range.

    ``917,4`` (a comma before other than three digits, no dot) has a decimal comma.
    """
    first = parts[1]
    comma = F.when(F.contains(first, F.lit(",")) & first.rlike(r"^[-+]?\d+,(?:\d{1,2}|\d{4,})$"), F.lit(".")).otherwise(F.lit(""))
    return F.when(parts[2] == "", F.replace(first, F.lit(","), comma).try_cast("double"))


def number_of(text: Column) -> Column:
    """The single number a cell holds, else null.

    Null, empty text, words and ranges give null. Of several printed values the first counts.
    """
    return number_in(cell_parts(text))


_LENGTH_WORD = "(kft|km|cm|mm|feet|foot|ft|metres|meters|metre|meter|mtrs|mtr|mts|m|inches|inch|yards|yard|yd)"


def head_unit_in_title(title: Column) -> Column:
    """The length unit a title states for the head, else null.

    The unit must stand in one clause with the word for the head (head, lift, TDH, H): after it
    (``heads in metres``, ``H [m]``, ``head: mts``) or just before it (``metres head``). A number
    before a unit makes it another quantity (``set at 1,200 m``), and so does the name of another
    quantity in between (``flow m3/d``).
    """
    t = F.lower(F.translate(title, "\u00a0\u2009\u202f", "   "))
    head = r"(?:\b(?:heads?|lifts?|tdh)\b|\bh\b(?=\s*[=\[(:]))"
    gap = r"(?:(?!\b(?:flow|rate|depth|tubing|set|power|pressure|kb|elevation)\b)[^,;/\d])*?"
    after = F.regexp_extract(t, head + gap + r"(?<![\w^])" + _LENGTH_WORD + r"(?![\w\d²³^/])", 1)
    before = F.regexp_extract(t, r"(?<![\w\d/])(?<!\d )" + _LENGTH_WORD + r"\s+(?:of\s+)?" + head, 1)
    return F.when(after != "", after).when(before != "", before)


def pressure_unit_in_note(note: Column) -> Column:
    """The pressure unit a note states for the value, else null; ``9 bar tubing head`` is another value's."""
    t = F.lower(F.translate(note, "\u00a0\u2009\u202f", "   "))
    units = r"(?:psi|lbf?/in[2²]|ksi|kpa|mpa|mbar|bars?|atm|kgf?/cm[2²]|ksc)"
    basis = r"(?:\s?\(?\s?(?:gauge|gage|absolute|abs|g|a)\s?\)?(?![\w]))?"
    stated = F.regexp_extract(t, r"(?<![\w/])(?<!\d )(?<!\d)(" + units + basis + r")(?![\w])", 1)
    ahead = F.regexp_extract(t, r"\b(gauge|gage|absolute|abs)\s+" + units + r"(?![\w])", 1)
    joined = F.when((ahead != "") & ~squeezed(stated).rlike("(g|gauge|gage|a|abs|absolute)$"), F.concat(stated, F.lit(" "), ahead)).otherwise(stated)
    return F.when(stated != "", joined)


def convert(rows: DataFrame, value: Column, unit: Column, note: Column, reader: Callable[[Column], Column], dim: str, out: str) -> DataFrame:
    """``rows`` with column ``out`` = struct<number, unit, unit_from, value, changed, reason>.

    ``reader`` takes the unit out of ``note``. ``dim`` is 'length' (feet) or 'pressure' (psia). ``reason`` says why ``value`` is null:
    ``absent``, ``not_a_number`` or ``other_dimension``. A cell that names no unit anywhere is in
    the target unit already; so counts, here, a text in a unit's place that names none known: it stands in
    ``unit`` while ``unit_from`` is null. A column called ``out`` is replaced; others pass through.

    Written in fenced projections: each names what the next uses more than once, so that no
    expression is repeated in the generated code.
    """
    keep = [c for c in rows.columns if c != out]
    w = "__unit_"
    split = rows.select(*keep, fenced(cell_parts(value)).alias(f"{w}p"), unit.alias(f"{w}t2"), note.alias(f"{w}note"), value.isNull().alias(f"{w}none"))
    plain = lambda c: F.when(c.rlike(r"\d"), F.regexp_replace(c, r"10\s*\^\s*3(?!\d)", "1000")).otherwise(c)
    texts = split.select(
        *keep, f"{w}none", f"{w}note", fenced(number_in(F.col(f"{w}p"))).alias(f"{w}n"),
        fenced(plain(F.coalesce(F.col(f"{w}p")[3], F.lit("")))).alias(f"{w}t1"), fenced(plain(F.coalesce(f"{w}t2", F.lit("")))).alias(f"{w}t2"),
    )
    led = lambda c: F.when(c.rlike(r"\d"), F.regexp_replace(c, LEAD, "")).otherwise(c)
    look = lambda c: F.when(c != "", F.element_at(_unit_map(), squeezed(led(c))))
    two = texts.select("*", *[fenced(look(F.col(f"{w}t{i}"))).alias(f"{w}u{i}") for i in (1, 2)], *[F.when(F.col(f"{w}t{i}").rlike(r"\d"), F.regexp_extract(F.col(f"{w}t{i}"), LEAD, 1)).alias(f"{w}m{i}") for i in (1, 2)])
    # a text is read only where neither the cell nor the column names a unit
    third = two.withColumn(f"{w}t3", fenced(F.when(F.col(f"{w}u1").isNull() & F.col(f"{w}u2").isNull() & F.col(f"{w}note").isNotNull(), reader(F.col(f"{w}note")))))
    found = third.withColumn(f"{w}u3", fenced(look(F.col(f"{w}t3"))))
    struct = lambda i, where: F.struct(F.lit(where).alias("place"), F.col(f"{w}u{i}").alias("u"), F.trim(f"{w}t{i}").alias("text"), (F.coalesce(F.col(f"{w}m{i}").try_cast("double"), F.lit(1.0)) if i < 3 else F.lit(1.0)).alias("times"))
    worded = lambda i: F.col(f"{w}t{i}").rlike(r"\p{L}")
    chosen = found.select(
        *keep, f"{w}n", f"{w}none",
        fenced(
            F.when(F.col(f"{w}u1").isNotNull(), struct(1, "value")).when(F.col(f"{w}u2").isNotNull(), struct(2, "column")).when(F.col(f"{w}u3").isNotNull(), struct(3, "note"))
            .when(worded(1), struct(1, None)).when(worded(2), struct(2, None))
        ).alias(f"{w}c"),
    )
    u, n = F.col(f"{w}c.u"), F.col(f"{w}n")
    other = u["dim"] != F.lit(dim)
    offset = F.when(u["gauge"], F.lit(ATMOSPHERE_PSI)).otherwise(0.0)
    valued = chosen.select("*", F.when(u.isNull(), n).when(~other, n * u["scale"] * F.col(f"{w}c.times") + offset).alias(f"{w}v"))
    return valued.select(
        *keep,
        fenced(F.struct(
            n.alias("number"),
            F.col(f"{w}c.text").alias("unit"),
            F.col(f"{w}c.place").alias("unit_from"),
            F.col(f"{w}v").alias("value"),
            F.coalesce(F.col(f"{w}v") != n, F.lit(False)).alias("changed"),
            F.when(F.col(f"{w}none"), F.lit("absent")).when(n.isNull(), F.lit("not_a_number")).when(other, F.lit("other_dimension")).alias("reason"),
        )).alias(out),
    )
