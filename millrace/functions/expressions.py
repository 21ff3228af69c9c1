"""Scalar expressions over typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(prefix: str, *parts: Column, digits: int = 16) -> Column:
    """Prefix and the first hex digits of the SHA-1 of the parts, joined by ``|``; null counts as empty."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha1(joined), 1, digits))


def at_reference_frequency(value: Column, frequency: Column, power: int, reference: float = 60.0) -> Column:
    """A value moved to the reference speed by the affinity laws: flow 1, head 2, power 3. Null for no or no positive frequency."""
    return F.when(frequency > 0, value * F.pow(F.lit(reference) / frequency, F.lit(power)))


def per_stage(value: Column, stages: Column, basis: Column) -> Column:
    """A total divided by its stages; null where a total has none. A per-stage value stays."""
    return F.when(basis == "per_stage", value).otherwise(F.try_divide(value, F.when(stages > 0, stages)))


def psia(value: Column, unit: Column) -> Column:
    """struct<value, reason>: absolute pressure in exact decimals; bare psi and no unit are kept and said."""
    exact = value.cast("decimal(38,10)")
    u = F.lower(F.trim(F.coalesce(unit, F.lit(""))))
    return F.struct(
        F.when(u == "psig", exact + F.lit("14.7").cast("decimal(4,1)")).otherwise(exact).cast("double").alias("value"),
        F.when(u == "psi", "bare_psi").when(u == "", "no_unit").alias("reason"),
    )


def gravity_of_api(api: Column) -> Column:
    """Specific gravity of degrees API, half-even to four digits."""
    return F.bround(F.try_divide(F.lit(141.5), F.lit(131.5) + api), 4)


def implied_gradient(oil: Column, water: Column, cut: Column) -> Column:
    return F.lit(0.433) * (oil * (F.lit(1.0) - cut) + water * cut)


def within_share(value: Column, expected: Column, share: float) -> Column:
    return F.abs(value - expected) <= F.lit(share) * F.abs(expected)


def half_last_digit(printed: Column) -> Column:
    """Half of the last printed digit, as decimal: 0.05 for ``12.3``, 0.5 for ``12``."""
    digits = F.length(F.regexp_extract(printed, r"\.(\d+)", 1))
    return (F.lit(5.0) * F.pow(F.lit(10.0), -(digits + 1))).cast("decimal(38,10)")


def decode_label(text: Column) -> Column:
    """Percent-decoded text; ``+`` stays a plus, bad sequences give null."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def run_id(event_time: Column, key: Column, version: Column) -> Column:
    """Deterministic id: the event's second and eight hex digits of its object's hash."""
    return F.concat(F.date_format(event_time, "yyyyMMdd'T'HHmmss"), F.lit("-"), F.substring(F.sha2(F.concat_ws("@", key, version), 256), 1, 8))


def squeeze(text: Column) -> Column:
    """Single spaces, none outside, white space of any script."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def alnum_key(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"(?U)[^\p{Alnum}]", "")


def page_numbers(cited: Column, longest: int = 50) -> Column:
    """Sorted pages of ``p13-14, 20``; a range is followed for ``longest`` pages at most."""
    found = F.regexp_extract_all(cited, F.lit(r"(\d{1,6}(?:\s*[-–]\s*\d{1,6})?)"), F.lit(1))
    ends = lambda r: F.transform(F.split(F.regexp_replace(r, r"\s*[-–]\s*", "-"), "-"), lambda x: x.cast("int"))

    def pages(r: Column) -> Column:
        e = ends(r)
        return F.when(F.size(e) == 1, F.slice(e, 1, 1)).otherwise(F.sequence(F.element_at(e, 1), F.greatest(F.element_at(e, 1), F.least(F.element_at(e, 2), F.element_at(e, 1) + F.lit(longest - 1)))))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(found, pages))))


def is_stale(status: Column, deadline: Column, now: Column) -> Column:
    """Running past its deadline; ``now`` is given, never read from the clock."""
    return (status == "running") & (deadline < now)


def file_label(text: Column, ending: str = ".pdf") -> Column:
    """A percent-decoded plain file name: printable, no path in it, of the given ending; else null."""
    name = decode_label(text)
    return F.when(name.rlike(r"^[^/\\\p{Cc}]+$") & name.endswith(ending), name)


def hex_label(text: Column, digits: int) -> Column:
    return F.when(text.rlike(f"^[0-9a-f]{{{digits}}}$"), text)


def one_of(text: Column, allowed: list[str]) -> Column:
    """An optional label: null unless it is one of the values it may have."""
    return F.when(text.isin(allowed), text)


def clamped(left: Column, margin: int, most: int) -> Column:
    """What is left less a margin, at most ``most``."""
    return F.least(left - F.lit(margin), F.lit(most).cast("long"))
