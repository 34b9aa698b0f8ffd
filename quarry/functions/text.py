"""Text analysis as JVM-side column expressions.

The analyser lower-cases the text and splits it into maximal runs of
Unicode letters and digits. Every run is a token, however long. A field may
declare another chain: how to split, words to leave out, character n-grams.
"""

from __future__ import annotations

from dataclasses import dataclass

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the token pattern.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"

# Word and non-word pieces together cover a text exactly (used for highlighting).
PIECE_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Analyzer:
    """A field's chain, applied to texts and queries alike.

    split: `words` (runs of letters and digits), `spaces` (runs of anything
    but white space) or `whole` (the text is one token); stop: tokens left out
    (what follows moves up); grams: each token longer than that becomes its
    n-grams, so that a query finds inner strings of n characters or more.
    """
    split: str = "words"
    stop: tuple = ()
    grams: int | None = None

    def __post_init__(self):
        object.__setattr__(self, "stop", tuple(self.stop))
        if self.split not in _SPLITS:
            raise ValueError(f"split must be one of {', '.join(_SPLITS)}, got {self.split!r}")
        if self.grams is not None and (not isinstance(self.grams, int) or self.grams < 1):
            raise ValueError("grams must be a positive integer")


# How each way to split names a token; the whole text is one unless it is empty.
_SPLITS = {"words": TOKEN_PATTERN, "spaces": r"\S+", "whole": r"(?s).+"}
DEFAULT = Analyzer()


def tokens(col: Column | str, analyzer: Analyzer = DEFAULT) -> Column:
    """ARRAY<STRING> of the tokens, in order. After the n-grams of a token
    stands an empty one, a gap that no phrase crosses; it is never indexed."""
    c = F.col(col) if isinstance(col, str) else col
    toks = F.regexp_extract_all(F.lower(c), F.lit(_SPLITS[analyzer.split]), 0)
    if analyzer.stop:
        stop = F.array(*[F.lit(w) for w in analyzer.stop])
        toks = F.filter(toks, lambda t: ~F.array_contains(stop, t))
    if analyzer.grams:
        n = analyzer.grams
        toks = F.flatten(F.transform(toks, lambda t: F.concat(F.when(F.char_length(t) <= n, F.array(t)).otherwise(
            F.transform(F.sequence(F.lit(1), F.char_length(t) - (n - 1)), lambda i: F.substring(t, i, F.lit(n)))), F.array(F.lit("")))))
    return toks


def analyse(text: str | None, analyzer: Analyzer = DEFAULT) -> list[str]:
    """Driver-side analysis of a query literal (a few words, never data),
    before n-grams are made of its tokens."""
    found = regex.findall(_SPLITS[analyzer.split], text.lower()) if text else []
    return [t for t in found if t not in analyzer.stop]


def grams_of(token: str, n: int) -> list[str]:
    return [token[i:i + n] for i in range(max(1, len(token) - n + 1))]
