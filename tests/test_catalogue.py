"""Catalogue lookup of names in any script, against brute force."""

from __future__ import annotations

import unicodedata

from millrace.plans import reference

CATALOGUE = ["Ruvüs 400", "RUVÜS-500", "Ruvüs 500", "Palül 12", "Kinén 7", "Davon 562-890", "Ｗide 9", "Ωmega 3", None]
PRINTED = [
    "Ruvüs 400", "ruvüs 400", " RUVÜS 400", "RUVÜS400", "Ruvüs 400", "Ruvüs 400", "ruvüs 500", "Palül-12", "Palul 12", "KINÉN 7", "Kinén", "Ｄavon 562-890", "Dаvon 562-890",
    "Davon​ 562-890", "Davon 562‑890", "davon 562/890", "Ｗide 9", "ｗide9", "Wide 9", "ΩMEGA 3", "ωmega-3", "***", "​", "", "  ", None, "Ruvüs 400",
]


def brute(printed, names):
    """(how, match, candidates) by comparing the name with every entry, one tier after the other."""
    key = lambda t: "".join(c for c in t.lower() if unicodedata.category(c)[0] == "L" or unicodedata.category(c) == "Nd")
    if not printed.strip(" "):
        return "none", None, None
    for how, form in (("exact", str), ("case", lambda t: t.strip(" ").lower()), ("key", key)):
        hits = sorted(n for n in names if form(n) == form(printed)) if form(printed) else []
        if hits:
            return (how, hits[0], None) if len(hits) == 1 else ("ambiguous", None, "|".join(hits))
    return "none", None, None


def test_names_beyond_ascii_come_out(spark, tmp_path):
    spark.createDataFrame([(x,) for x in PRINTED], "pump_model_as_printed string").write.parquet(f"{tmp_path}/stg_pump_config.parquet")
    spark.createDataFrame([(x,) for x in CATALOGUE], "pump_model_canonical string").write.parquet(f"{tmp_path}/pump_catalogue.parquet")
    rows = reference.e6_catalogue(spark, str(tmp_path)).collect()
    names = [x for x in CATALOGUE if x is not None]
    assert {r.printed: (r.how, r.match, r.candidates) for r in rows} == {x: brute(x, names) for x in PRINTED if x is not None}
    assert len(rows) == len({x for x in PRINTED if x is not None})
