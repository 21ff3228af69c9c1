"""Words of a text, the same way for every operator that compares words."""

from __future__ import annotations

import re
import unicodedata

from millrace.llm.lookalike import char_map

_LOOK = str.maketrans(char_map())
#: A line that is nothing but a page heading.
_HEADING = re.compile(r"^[^\w\n]*(?:page|pag\.?|seite|página|p\.)[ \t]*\d+(?:[ \t]*(?:of|/|de|von)[ \t]*\d+)?[^\w\n]*$\n?", re.I | re.M)
_MAY_HEAD = re.compile(r"^[^\w\n]*(?:pag|seite|pág|p\.)", re.I | re.M)
_BROKEN = re.compile(r"(\w)-[ \t]*\r?\n\s*(?=\w)")
#: A word keeps inner punctuation out: ``8,984`` is 8984, ``gas-locked`` is gaslocked.
_INNER = re.compile(r"(?<=\w)[-',.’](?=\w)")
_WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    """Lower-case words; look-alike characters, accents set apart, page headings, line-end hyphens and punctuation aside."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text.translate(_LOOK))
    if "\n" in text:
        if _MAY_HEAD.search(text):
            text = _HEADING.sub("", text)
        if "-" in text:
            text = _BROKEN.sub(r"\1", text)
    return _WORD.findall(_INNER.sub("", text.lower()))
