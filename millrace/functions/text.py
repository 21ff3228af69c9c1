"""Text for display and for keys: slugs, hidden characters made visible, glyph repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sign shown for each kind of character that would not show.
_SIGNS = [
    ("[\u00a0\u2007\u202f]", "\u00b0"), ("\t", "\u2192"), ("[\u1680\u2000-\u2006\u2008-\u200a\u205f\u3000]", "\u25ab"),
    ("[\u00ad\u034f\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff]", "\u00a6"),
]


def slug(text: Column) -> Column:
    """Lower-case ASCII letters and digits joined by single hyphens; empty for a text without any."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def hidden_shown(text: Column) -> Column:
    """``text`` with a sign for every character that would not show, outer and doubled spaces among them."""
    out = F.regexp_replace(text, "^ | $|(?<= ) | (?= )", "\u2423")
    for pattern, sign in _SIGNS:
        out = F.regexp_replace(out, pattern, sign)
    return out


def repaired_glyphs(text: Column, glyphs: dict[str, str]) -> Column:
    """struct<text, left>: glyphs of a broken font put right, and how many of the private use area are left."""
    fixed = F.translate(text, "".join(glyphs), "".join(glyphs.values()))
    return F.struct(fixed.alias("text"), F.regexp_count(fixed, F.lit("[\ue000-\uf8ff]")).alias("left"))
