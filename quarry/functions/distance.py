"""Edit distance as Spark higher-order-function expressions.

The dynamic programme runs inside the JVM with `aggregate` over the
characters of one string; each step builds the next table row with an
inner `aggregate` over the other string. State per step is two rows, so
memory stays linear in the shorter string. Characters are Unicode code
points (Spark strings), not bytes.

With ``transposition=True`` an adjacent swap costs one edit
(optimal string alignment: no substring is edited twice, so
``ca`` -> ``abc`` is 3). Without it the result is plain Levenshtein.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dp_last_row(a: Column, b: Column, transposition: bool) -> Column:
    """Row D[len(a)][0..len(b)] of the edit-distance table of a against b.

    Only valid when both strings are non-empty (callers guard empties).
    """
    la = F.char_length(a)
    lb = F.char_length(b)
    first = F.sequence(F.lit(1), lb)
    zero_row = F.concat(F.array(F.lit(0)), first)

    def step(acc, i):
        ai = F.substring(a, i, 1)
        prev, prev2 = acc["p"], acc["pp"]

        def cell(row, j):
            bj = F.substring(b, j, 1)
            cost = F.when(ai == bj, F.lit(0)).otherwise(F.lit(1))
            best = F.least(
                F.element_at(prev, j + 1) + 1,      # delete a[i]
                F.element_at(row, j) + 1,           # insert b[j]
                F.element_at(prev, j) + cost,       # substitute / keep
            )
            if transposition:
                swap = F.when(
                    (i > 1) & (j > 1)
                    & (ai == F.substring(b, j - 1, 1))
                    & (F.substring(a, i - 1, 1) == bj),
                    F.element_at(prev2, j - 1) + 1,
                )
                best = F.least(best, swap)          # least() skips nulls
            return F.concat(row, F.array(best))

        row = F.aggregate(first, F.array(i), cell)
        return F.struct(prev.alias("pp"), row.alias("p"))

    start = F.struct(zero_row.alias("pp"), zero_row.alias("p"))
    return F.aggregate(F.sequence(F.lit(1), la), start, step, lambda acc: acc["p"])


def edit_distance(a, b, transposition: bool = True) -> Column:
    """Exact edit distance between two string columns (INT)."""
    a, b = _col(a), _col(b)
    la, lb = F.char_length(a), F.char_length(b)
    full = F.element_at(_dp_last_row(a, b, transposition), -1)
    return F.when(la == 0, lb).when(lb == 0, la).otherwise(full)


def edit_distance_to_literal(col, query: str, transposition: bool = True) -> Column:
    """Edit distance between a string column and a literal."""
    return edit_distance(F.lit(query), _col(col), transposition)


def prefix_distance_to_literal(col, query: str, distance: int,
                               transposition: bool = True) -> Column:
    """Smallest edit distance between the literal and any prefix of the column.

    A prefix longer than len(query) + distance is already further than
    `distance` away, so only that many leading characters can matter; the
    table is built over them alone. The answer is exact for every value
    up to `distance` (larger answers are only known to exceed it).
    """
    b = F.substring(_col(col), 1, len(query) + distance)
    if len(query) == 0:
        return F.lit(0)
    row = _dp_last_row(F.lit(query), b, transposition)
    return F.when(F.char_length(b) == 0, F.lit(len(query))).otherwise(F.array_min(row))


def swapped_forms(word: str, k: int) -> dict[str, int]:
    """The forms of a word with up to k disjoint pairs of neighbours swapped,
    each with the fewest swaps that make it."""
    out, last = {word: 0}, {(word, 0)}
    for n in range(1, k + 1):
        last = {(w[:i] + w[i + 1] + w[i] + w[i + 2:], i + 2) for w, at in last for i in range(at, len(w) - 1)}
        for w, _ in last:
            out.setdefault(w, n)
    return out


# Forms of which a filter is made; a word that has more is compared as it is.
SWAPPED_FORMS = 64


def within_of_literal(col, query: str, k: int, transposition: bool = True, prefix: bool = False) -> Column:
    """A necessary condition for `col` (or a prefix of it) to be within k edits
    of the literal, by Spark's own bounded Levenshtein: what swaps and plain
    edits make of a word, plain edits make of the word with the swaps done."""
    col, m, forms = _col(col), len(query), {query: 0}
    rest = k
    if transposition:
        if m * k <= SWAPPED_FORMS and len(swaps := swapped_forms(query, k)) <= SWAPPED_FORMS:
            forms = swaps
        else:
            rest = 2 * k        # a swap is at most two plain edits
    tests = []
    for w, used in forms.items():
        left = rest - used
        if prefix and left == 0:
            tests.append(col.startswith(w))
        else:
            heads = [F.substring(col, 1, n) for n in range(max(0, m - k + used), m + k - used + 1)] if prefix else [col]
            tests += [(h == F.lit(w)) if left == 0 else (F.levenshtein(h, F.lit(w), left) >= 0) for h in heads]
    return reduce(lambda x, y: x | y, tests)


def deletion_keys(word, k: int):
    """All strings made by deleting up to k characters (as a column of arrays).

    Two strings within k edits (a swap counting one) share at least one
    key in which each side lost at most k characters.
    """
    w = _col(word)
    keys = F.array(w)
    for _ in range(k):
        keys = F.array_distinct(F.flatten(F.transform(keys, lambda s: F.concat(
            F.array(s),
            F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(s), F.lit(1))),
                        lambda i: F.concat(F.substring(s, 1, i - 1), F.substring(s, i + 1, 1 << 30)))
        ))))
    return keys


# A term of more characters is found by its halves: it has too many deletions.
SHORT_TERM = 8
HALF_MARK = "\u0002"
# A term of more characters yet is found by its segments.
LONG_TERM = 16
# Two edits, of which a swap can touch two segments, leave one of five whole.
SEGMENTS = 5
SEGMENT_MARK = "\u0001"


def neighbourhood_keys(term) -> Column:
    """Keys under which a term is found by anything within two edits: all its
    forms without up to two characters, or for a longer term the forms of its
    two halves without up to one (two edits leave one half with one at most; a
    swap across the middle changes one character of each), or for a long one
    its segments, each with its number."""
    t = _col(term)
    n = F.char_length(t)
    at = [F.floor(n * i / SEGMENTS).cast("int") for i in range(SEGMENTS + 1)]
    segments = F.array(*[F.concat(F.lit(f"{SEGMENT_MARK}{i}"), F.substring(t, at[i] + 1, at[i + 1] - at[i])) for i in range(SEGMENTS)])
    middle = F.floor(n / 2).cast("int")

    def half(i, part):
        return F.transform(deletion_keys(part, 1), lambda s: F.concat(F.lit(f"{HALF_MARK}{i}"), s))

    halves = F.concat(half(0, F.substring(t, F.lit(1), middle)), half(1, F.substring(t, middle + 1, n)))
    return F.when(n <= SHORT_TERM, deletion_keys(t, 2)).when(n <= LONG_TERM, halves).otherwise(segments)


def neighbourhood(term: str) -> set[str]:
    """The same keys of one term, as a value."""
    def without_one(words):
        return words | {w[:i] + w[i + 1:] for w in words for i in range(len(w))}

    n = len(term)
    if n <= SHORT_TERM:
        return without_one(without_one({term}))
    if n <= LONG_TERM:
        return {f"{HALF_MARK}{i}{w}" for i, part in enumerate((term[:n // 2], term[n // 2:])) for w in without_one({part})}
    at = [n * i // SEGMENTS for i in range(SEGMENTS + 1)]
    return {f"{SEGMENT_MARK}{i}{term[at[i]:at[i + 1]]}" for i in range(SEGMENTS)}


def neighbourhood_probes(word: str, k: int) -> list[str]:
    """The keys to ask for the terms within k edits of `word` (k at most 2)."""
    forms, m = {word}, len(word)
    if m - k <= SHORT_TERM:
        for _ in range(k):
            forms |= {w[:i] + w[i + 1:] for w in forms for i in range(len(w))}
    else:
        forms = set()
    for n in range(max(SHORT_TERM + 1, m - k), min(LONG_TERM, m + k) + 1):
        left, right = n // 2, n - n // 2
        if k == 1:      # one half is whole, or a swap across the middle changed its inner end
            near = [(0, word[:left]), (0, word[:left - 1]), (1, word[max(0, m - right):]), (1, word[max(0, m - right + 1):])]
        else:           # one half has one edit at most
            whole = [(0, word[:left + d]) for d in (-1, 0, 1)] + [(1, word[max(0, m - right - d):]) for d in (-1, 0, 1)]
            near = whole + [(i, w[:j] + w[j + 1:]) for i, w in whole for j in range(len(w))]
        forms |= {f"{HALF_MARK}{i}{w}" for i, w in near}
    for n in range(max(LONG_TERM + 1, m - k), m + k + 1):
        at = [n * i // SEGMENTS for i in range(SEGMENTS + 1)]
        for i in range(SEGMENTS):
            for start in range(max(0, at[i] - k), at[i] + k + 1):
                piece = word[start:start + at[i + 1] - at[i]]
                if len(piece) == at[i + 1] - at[i]:
                    forms.add(f"{SEGMENT_MARK}{i}{piece}")
    return sorted(forms)
