"""Problem 3: freely written names to entries of a reference list.

The reference entries stand in one trie, each under several paths: its key (letters and digits
only, without case and accents) and its aliases (token order turned, vowels dropped). A printed
name is stripped of what is not a name and the trie is walked together with the states of its
Levenshtein automaton; all entries within a distance that depends on the length come back, and
one that is nearer than all others is the answer.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.lookalike import char_map

_LOOK = str.maketrans(char_map())
_VOWELS = re.compile("[aeiou]")

#: (shortest key, edits allowed from there on)
DISTANCES = ((0, 0), (6, 1), (14, 2))
#: Entries of the reference list that one task holds at once.
MAX_ENTRIES = 100_000
#: Tasks the distinct names are spread over, for each core.
TASKS_PER_CORE = 4
RESOLVED = "t string, model_id long, how string, distance int, candidates array<struct<model_id: long, distance: int, path: string>>"

NO_MODEL = -1


def folded(text: str) -> str:
    """Look-alikes mapped, accents dropped, lower case, single spaces."""
    t = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text.translate(_LOOK)).translate(_LOOK))
    return " ".join("".join(c for c in t if not unicodedata.combining(c)).lower().split())


def key_of(text: str) -> str:
    return "".join(c for c in text if c.isalnum())


def allowed(length: int) -> int:
    return max(d for n, d in DISTANCES if length >= n)


class Levenshtein:
    """The Levenshtein automaton for distance ``k`` (a swap of neighbours counts one), shared by all words.

    A state is the band of the last two rows of distances that can still lie within ``k``; cell ``t``
    after ``j`` letters is the distance to the first ``j - k + t`` letters of the word. Where the
    automaton goes from a state depends only on which letters of the word under the band equal the
    one read (and the one before it), so its table is filled once and serves every word.
    """

    def __init__(self, k: int):
        self.k, self.width = k, 2 * k + 1
        self.bands: list[tuple] = []
        self._ids: dict[tuple, int] = {}
        self._table: dict[tuple, int] = {}
        self.dead = -1

    def _state(self, before: tuple | None, row: tuple) -> int:
        known = self._ids.setdefault((before, row), len(self.bands))
        if known == len(self.bands):
            self.bands.append((before, row))
        return known

    def start(self, n: int) -> int:
        """The state before the first letter, for a word of ``n`` letters."""
        k = self.k
        return self._state(None, tuple(t - k if t >= k and t - k <= n else k + 1 for t in range(self.width)))

    def step(self, state: int, equal: int, swapped: int, low: int, high: int) -> int:
        """The next state: bit t of ``equal`` says whether the letter under cell t is the one read, of ``swapped`` whether the two read last are its neighbours turned; cells outside low..high lie outside the word."""
        key = (state, equal, swapped, low, high)
        known = self._table.get(key)
        if known is None:
            known = self._table[key] = self._fill(*key)
        return known

    def _fill(self, state: int, equal: int, swapped: int, low: int, high: int) -> int:
        before, row = self.bands[state]
        far = self.k + 1
        out, left = [], far
        for t in range(self.width):
            if t < low or t > high:
                out.append(far)
                left = far
                continue
            best = left + 1
            if t + 1 < self.width:
                best = min(best, row[t + 1] + 1)
            if equal >> t & 1:
                best = min(best, row[t])
            elif t > low or low == 0:
                best = min(best, row[t] + 1)
            if before is not None and swapped >> t & 1:
                best = min(best, before[t] + 1)
            left = min(best, far)
            out.append(left)
        return self._state(row, tuple(out)) if min(out) <= self.k else self.dead


_AUTOMATA: dict[int, Levenshtein] = {}


class Word:
    """One word to walk the automaton with: where its letters stand, as bits."""

    def __init__(self, word: str, k: int):
        self.n, self.k = len(word), k
        self.auto = _AUTOMATA.setdefault(k, Levenshtein(k))
        if len(self.auto.bands) > 1_000_000:  # the table of a few distances stays far below
            self.auto = _AUTOMATA[k] = Levenshtein(k)
        self.at: dict[str, int] = {}
        for i, ch in enumerate(word):
            self.at[ch] = self.at.get(ch, 0) | 1 << (i + k + 2)
        self.start = (0, self.auto.start(self.n), 0)

    def step(self, state: tuple, ch: str) -> tuple | None:
        j, s, last = state
        k, width = self.k, self.auto.width
        here = self.at.get(ch, 0)
        mask = (1 << width) - 1
        # cell t stands for the first i = j + 1 - k + t letters; its last letter is number i - 1
        equal = here >> (j + 2) & mask
        swapped = (last >> (j + 2)) & (here >> (j + 1)) & mask if last else 0
        low, high = max(0, k - 1 - j), min(width - 1, self.n - (j + 1 - k))
        if high < low:
            return None
        then = self.auto.step(s, equal, swapped, low, high)
        return None if then == self.auto.dead else (j + 1, then, here)

    def distance(self, state: tuple) -> int:
        t = self.n - state[0] + self.k
        return self.auto.bands[state[1]][1][t] if 0 <= t <= 2 * self.k else self.k + 1


class Trie:
    """Paths of letters; a path ends with the set of what it stands for."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, path: str, entry) -> None:
        node = self.root
        for ch in path:
            node = node.setdefault(ch, {})
        node.setdefault("", set()).add(entry)

    def within(self, word: str, k: int) -> dict:
        """entry -> distance, of every entry with a path at distance ``k`` or less."""
        word, found = Word(word, k), {}
        stack = [(self.root, word.start)]
        step = word.step
        while stack:
            node, state = stack.pop()
            for ch, child in node.items():
                if ch == "":
                    d = word.distance(state)
                    if d <= k:
                        for e in child:
                            found[e] = min(d, found.get(e, d))
                else:
                    then = step(state, ch)
                    if then is not None:
                        stack.append((child, then))
        return found


_TOKENS = re.compile(r"[a-z]+|\d+")
# Words around a name that are no part of it.
_NOISE = [
    r"\(?\b\d+\s*(?:x\s*)?(?:stages?|stgs?|stg\.?)\b\)?", r"\b\d+(?:\.\d+)?\s*(?:hp|kw|hz)\b", r"[-,(]\s*(?:upper|middle|mid|lower|single|center|centre)\s*(?:tandem|body|section|pump)?\s*\)?$",
    r"[-,(]\s*(?:tandem|rental unit|rental|spare|used|new)\s*\)?$", r"^(?:esp\s+)?(?:pump|model|type)(?:\s+(?:model|type))?\b\s*[:#=-]?", r"\(alt\)$", r"\*+$",
]
_NOISE_RE = [re.compile(x) for x in _NOISE]
_SPLIT = re.compile(r"\s+and\s+|\s*\+\s*|\s+w/\s*|\s*&\s*|\s+with\s+|\s*;\s*|\s*/\s*")
_WRAP = " []{}()<>\"',;:.-_/*"


Found = dict[tuple[int, str], int]  #: (entry, kind of path) -> distance


class NameList:
    """The trie over a reference list of (id, name, maker); ``makers`` adds those of other parts of a list."""

    def __init__(self, entries: list[tuple[int, str, str | None]], makers: Iterable[str] = ()):
        self.exact: dict[str, set[int]] = {}
        self.trie = Trie()
        known = {folded(m) for m in makers if m} | {folded(m) for _, name, m in entries if m and name is not None}
        for i, name, _ in entries:
            if name is None:
                continue
            self.exact.setdefault(name, set()).add(i)
            f = folded(name)
            key = key_of(f)
            if not key:
                continue
            self.trie.add(key, (i, "name"))
            tokens = _TOKENS.findall(f)
            turned = "".join(tokens[1:] + tokens[:1])
            words = [key_of(x) for x in re.split(r"[^a-z0-9]+", f) if key_of(x)]
            last_first = "".join(words[-1:] + words[:-1])
            bare = tokens[0][0] + _VOWELS.sub("", tokens[0][1:]) + "".join(tokens[1:]) if tokens else key
            for path in {turned, last_first, bare, _VOWELS.sub("", key)} - {key}:
                if len(path) > 3:
                    self.trie.add(path, (i, "alias"))
        names = "|".join(sorted(map(re.escape, known), key=len, reverse=True))
        self.maker = re.compile(rf"^(?:{names})\b\s*[:/,-]?\s*|\s*[,/(-]?\s*(?:\bby\s+)?\b(?:{names})\s*\)?$") if names else None
        self._memo: dict[str, tuple] = {}

    def stripped(self, text: str) -> str:
        """``text`` without makers, stage counts, positions and the like."""
        t = folded(text).strip(_WRAP)
        while True:
            before = t
            for r in _NOISE_RE:
                t = r.sub(" ", t).strip(_WRAP)
            if self.maker:
                t = self.maker.sub(" ", t).strip(_WRAP)
            if t == before:
                return t

    def within(self, name: str) -> Found:
        """All entries with a path, their own or an alias, within the distance the name's length allows."""
        key = key_of(name)
        return self.trie.within(key, allowed(len(key))) if key else {}

    def look_up(self, text: str) -> tuple[list[int], Found, list[Found]]:
        """(entries written just so, entries near the whole name, entries near each of the names joined in it)."""
        if text in self.exact:
            return sorted(self.exact[text]), {}, []
        name = self.stripped(text)
        parts = [p for p in (self.stripped(x) for x in _SPLIT.split(name)) if key_of(p)] if name else []
        return [], self.within(name), [self.within(p) for p in parts] if len(parts) > 1 else []

    def resolve(self, text: str) -> tuple[int, str, int]:
        """(id or -1, how, distance); how: exact, name, alias, ambiguous, several, unmatched."""
        return self.answer(text)[:3]

    def answer(self, text: str) -> tuple[int, str, int, list[tuple[int, int, str]]]:
        """``resolve`` and every candidate within the distance as (id, distance, path)."""
        known = self._memo.get(text)
        if known is None:
            if len(self._memo) > 200_000:
                self._memo.clear()
            known = self._memo[text] = decide(*self.look_up(text))
        return known


def _nearest(found: Found) -> tuple[set[int], int, str]:
    """(the nearest entries, their distance, path kind); a name met exactly goes before an alias met exactly."""
    if not found:
        return set(), 0, "none"
    best = min(found.values())
    near = {k for k, d in found.items() if d == best}
    if best == 0 and any(kind == "name" for _, kind in near):
        near = {k for k in near if k[1] == "name"}
    return {e for e, _ in near}, best, "name" if any(kind == "name" for _, kind in near) else "alias"


def decide(exact: list[int], whole: Found, parts: list[Found]) -> tuple[int, str, int, list[tuple[int, int, str]]]:
    """(id or -1, how, distance, candidates) from what was found in all parts of the reference list."""
    if exact:
        each = [(i, 0, "exact") for i in exact]
        return (exact[0], "exact", 0, each) if len(exact) == 1 else (NO_MODEL, "ambiguous", 0, each)
    listed = sorted((e, d, kind) for f in (whole, *(() if whole else parts)) for (e, kind), d in f.items())
    ids, d, how = _nearest(whole)
    if not ids:
        near = [_nearest(f) for f in parts]
        if near and all(n[0] for n in near) and len({frozenset(n[0]) for n in near}) == 1:
            ids, d, how = near[0]
        else:
            return NO_MODEL, "several" if any(n[0] for n in near) else "unmatched", 0, listed
    return (next(iter(ids)), how, d, listed) if len(ids) == 1 else (NO_MODEL, "ambiguous", d, listed)


_LISTS: dict[tuple, NameList] = {}


def _list(stamp: tuple, entries: list, makers: list[str]) -> NameList:
    """The trie of ``entries``, built once a Python worker."""
    if stamp not in _LISTS:
        if len(_LISTS) > 3:
            _LISTS.clear()
        _LISTS[stamp] = NameList(entries, makers)
    return _LISTS[stamp]


def match_names(rows: DataFrame, key: str, text: str, reference: DataFrame, entry: str, name: str, maker: str) -> DataFrame:
    """(key, text, model_id, how, distance, candidates) of every row whose text is neither null nor blank.

    ``candidates`` are all entries within the distance, as (model_id, distance, path). Distinct texts
    are resolved once and joined back, so a hot name costs one lookup; the join is left to the
    planner, which splits skewed partitions. A reference list longer than ``MAX_ENTRIES`` is worked
    through part by part in one pass over the names: each part adds what it holds, then the answer
    is decided, so no task holds more than one part's trie. An empty list matches nothing.
    """
    parts: list[list] = [[]]
    for r in reference.select(entry, name, maker).where(F.col(entry).isNotNull()).toLocalIterator():
        if len(parts[-1]) >= MAX_ENTRIES:
            parts.append([])
        parts[-1].append((int(r[0]), r[1], r[2]))
    makers = sorted({m for p in parts for _, n, m in p if m and n is not None})
    stamps = [(len(p), i, hash(tuple(p)), hash(tuple(makers))) for i, p in enumerate(parts)]

    def answered(pdf: pd.DataFrame, got: list) -> pd.DataFrame:
        each = [[{"model_id": e, "distance": d, "path": how} for e, d, how in g[3]] for g in got]
        return pd.DataFrame({"t": pdf["t"], "model_id": [g[0] for g in got], "how": [g[1] for g in got], "distance": [g[2] for g in got], "candidates": each})

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = _list(stamps[0], parts[0], makers)
        for pdf in batches:
            yield answered(pdf, [names.answer(x) for x in pdf["t"]])

    def search(i: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names = _list(stamps[i], parts[i], makers)
            for pdf in batches:
                yield pdf.assign(found=[pickle.dumps([*pickle.loads(b), names.look_up(x)]) for x, b in zip(pdf["t"], pdf["found"], strict=True)])

        return run

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = []
            for b in pdf["found"]:
                looks = pickle.loads(b)
                whole = {k: d for x in looks for k, d in x[1].items()}
                several = [{k: d for x in looks if x[2] for k, d in x[2][n].items()} for n in range(max(len(x[2]) for x in looks))]
                got.append(decide(sorted(i for x in looks for i in x[0]), whole, several))
            yield answered(pdf, got)

    written = rows.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("t").isNotNull() & (F.regexp_replace("t", r"[\s\p{Z}\u200b\ufeff]", "") != ""))
    # few bytes but much work a name: spread by count, which adaptive execution leaves as it is
    tasks = TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    names = written.select("t").distinct().repartition(tasks, "t")
    if len(parts) == 1:
        resolved = names.mapInPandas(resolve, RESOLVED)
    else:
        found = names.withColumn("found", F.lit(pickle.dumps([])))
        for i in range(len(parts)):
            found = found.mapInPandas(search(i), "t string, found binary")
        resolved = found.mapInPandas(joined, RESOLVED)
    return written.join(resolved, "t").select(F.col("k").alias(key), F.col("t").alias(text), "model_id", "how", "distance", "candidates")
