"""Quality classifier: histogram gradient-boosted trees over document statistics (operator 8).

Statistics are computed in tasks on flat byte arrays (shares of character
kinds, word lengths, repeated words, shingles and lines). The trees are
fitted here, on binned statistics of a bounded sample of labelled documents,
and flattened into arrays that a task walks for all rows at once.

Rows held out (crc32 of the id as text, mod 5 = 0) and rows without a
quality label are never learnt from; a document labelled more than once
counts as good if any of its labels says so. A null text is scored as an
empty one. Scores depend on the text alone, so repeated rows score alike;
columns other than id and text are not read. With no labels, or labels of
one kind only, every score is that share (0.5 without any). Texts of any
length are read whole, in slices; an empty table gives no rows. `score` and
`accepted` carry the other columns along, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import apart, held_out, slices, strings
from quarry.llm.shingles import join_words, powers, prefix, word_table

FIT_ROWS = 20_000        # labelled documents that the trees are fitted on, about
TREES, DEPTH, BINS, RATE, L2, LEAST_WEIGHT = 60, 4, 32, 0.15, 1.0, 2.0
THRESHOLD = 0.3
SLICE_BYTES = 1 << 19

# Kinds of bytes, by the characters that belong to them.
KINDS = {
    "lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789",
    "blank": " \t", "line": "\n\r", "stop": ".?", "comma": ",;:", "bang": "!",
    "symbol": "#*$%&|<>", "quote": "\"'()[]{}", "dash": "-_/\\=+~^`@",
}
_KIND_OF = np.full(256, len(KINDS), np.int64)              # other ASCII
_KIND_OF[0x80:0xC0] = len(KINDS) + 1                       # within a character
_KIND_OF[0xC0:] = len(KINDS) + 2                           # its first byte
for _i, _chars in enumerate(KINDS.values()):
    _KIND_OF[list(_chars.encode())] = _i
N_KINDS = len(KINDS) + 3
FEATURES = ([f"share_{k}" for k in [*KINDS, "ascii", "within", "wide"]]
            + ["log_bytes", "log_words", "word_mean", "word_std", "word_longest", "short_words", "long_words",
               "distinct_words", "distinct_triples", "log_lines", "distinct_lines", "words_per_line",
               "upper_words", "symbol_words", "stops_per_word"])


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts, FEATURES) of the texts data[off[i]:off[i+1]]."""
    d = data[off[0]:off[-1]]
    off = off - off[0]
    n = len(off) - 1
    size = np.diff(off)
    text = np.repeat(np.arange(n), size)
    kind = _KIND_OF[d]
    counts = np.bincount(text * N_KINDS + kind, minlength=n * N_KINDS).reshape(n, N_KINDS).astype(float)
    shares = counts / np.maximum(size, 1)[:, None]
    h, begin, end, at = word_table(d, off, lower=False)
    words = np.diff(at)
    per_word = np.maximum(words, 1)
    length = (end - begin).astype(float)
    word_text = np.repeat(np.arange(n), words)

    def total(x):
        return np.bincount(word_text, x, n)

    mean = total(length) / per_word
    std = np.sqrt(np.maximum(total(length ** 2) / per_word - mean ** 2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, word_text, length)

    def has(k):
        c = np.r_[0, np.cumsum(kind == list(KINDS).index(k))]
        return c[end] - c[begin]

    upper, symbol = has("upper"), has("symbol") + has("bang")
    triples, triple_at = join_words(h, at, 3)
    # lines: hash of what lies between line feeds
    first = np.zeros(len(d) + 1, bool)
    first[off[:-1][size > 0]] = True
    breaks = np.flatnonzero(d == 10)
    line_begin = np.unique(np.r_[np.flatnonzero(first[:-1]), breaks[~first[breaks + 1]] + 1]).astype(np.int64)
    line_begin = line_begin[line_begin < len(d)]
    line_end = np.r_[line_begin[1:], len(d)][:len(line_begin)]
    p = prefix(d)
    line_hash = (p[line_end] - p[line_begin]) * powers(len(d) + 1)[1][line_begin]
    line_at = np.searchsorted(line_begin, off)
    lines = np.diff(line_at)
    distinct = np.ones((n, 3))
    for i in range(n):
        for c, (x, a) in enumerate(((h, at), (triples, triple_at), (line_hash, line_at))):
            if a[i + 1] - a[i] > 1:
                distinct[i, c] = len(np.unique(x[a[i]:a[i + 1]])) / (a[i + 1] - a[i])
    more = np.stack([
        np.log1p(size), np.log1p(words), mean, std, longest, total(length <= 2) / per_word,
        total(length > 15) / per_word, distinct[:, 0], distinct[:, 1], np.log1p(lines), distinct[:, 2],
        words / np.maximum(lines, 1), total((upper >= length - symbol) & (upper > 1)) / per_word,
        total(symbol > 0) / per_word, counts[:, list(KINDS).index("stop")] / per_word], axis=1)
    return np.concatenate([shares, more], axis=1)


@dataclass
class Trees:
    """Flattened trees: node i of all trees tests feature[i] <= cut[i] and goes
    to left[i] or left[i] + 1; a leaf leads to itself. roots: one a tree."""
    base: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    leaf: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                right = x[rows, self.feature[node]] > self.cut[node]
                node = np.where(self.leaf[node], node, self.left[node] + right)
            z += self.value[node]
        return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for the log-odds of y, by gradient histograms."""
    share = float(np.mean(y)) if len(y) else 0.5
    # labels of one kind: a score just inside (0, 1)
    share = min(max(share, 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    feature, cut, left, leaf, value, roots = [], [], [], [], [], []

    def node():
        for a, v in ((feature, 0), (cut, 0.0), (left, 0), (leaf, True), (value, 0.0)):
            a.append(v)
        return len(feature) - 1

    if len(y) and 0 < np.mean(y) < 1:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
        cells = binned + np.arange(x.shape[1]) * BINS
        z = np.full(len(y), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            g, h = p - y, p * (1 - p)
            roots.append(node())
            level = [(roots[-1], np.arange(len(y)))]
            for depth in range(DEPTH + 1):
                below = []
                for at, rows in level:
                    sg, sh = g[rows].sum(), h[rows].sum()
                    value[at] = -RATE * sg / (sh + L2)
                    split = _split(cells[rows], g[rows], h[rows], x.shape[1]) if depth < DEPTH else None
                    if split is None:
                        z[rows] += value[at]
                        continue
                    f, b = split
                    a = node()
                    c = node()
                    assert c == a + 1
                    feature[at], cut[at], left[at], leaf[at] = f, float(edges[f][b]), a, False
                    goes = binned[rows, f] > b
                    below += [(a, rows[~goes]), (c, rows[goes])]
                level = below
    return Trees(base, *(np.array(v) for v in (roots, feature, cut, left, leaf, value)), DEPTH)


def _split(cells, g, h, n_features):
    """(feature, bin) of the best cut, or None."""
    flat = cells.ravel()
    hg = np.bincount(flat, np.repeat(g, n_features), n_features * BINS).reshape(n_features, BINS)
    hh = np.bincount(flat, np.repeat(h, n_features), n_features * BINS).reshape(n_features, BINS)
    gl, hl = np.cumsum(hg, 1)[:, :-1], np.cumsum(hh, 1)[:, :-1]
    gt, ht = hg.sum(1, keepdims=True), hh.sum(1, keepdims=True)
    gain = gl ** 2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt ** 2 / (ht + L2)
    gain[(hl < LEAST_WEIGHT) | (ht - hl < LEAST_WEIGHT)] = -1
    f, b = divmod(int(np.argmax(gain)), BINS - 1)
    return (f, b) if gain[f, b] > 1e-9 else None


def _statistics_of(column) -> np.ndarray:
    data, off = strings(column)
    parts = [statistics(data, off[i:j + 1]) for i, j in slices(off, SLICE_BYTES)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = FIT_ROWS) -> Trees:
    """Trees fitted on about `rows` labelled documents, picked by a hash of
    the id. Only that many ids are broadcast, and as many rows of
    statistics come to the driver."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
                   .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label")))
    total = known.count()
    if total > rows:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * rows / total))
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                 .join(F.broadcast(known), "id").select("label", "text"))

    def run(batches):
        for b in batches:
            x = _statistics_of(b.column(1))
            flat = pa.array(x.ravel(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.float64()), pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), flat)], names=["label", "x"])

    got = texts.mapInArrow(run, "label double, x array<double>").toArrow().sort_by("label")
    x = np.array(got.column("x").combine_chunks().flatten()).reshape(-1, len(FEATURES))
    y = np.array(got.column("label"))
    order = np.lexsort([*x.T, y])          # the same trees whichever way rows arrive
    return fit(x[order], y[order])


def score(docs: DataFrame, trees: Trees, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) with `score`, the chance of label 1."""
    own, back = apart(docs.select(*[F.col(f"`{c}`") for c in (keep or docs.columns) if c != "score"]), "_text")
    src = docs.select(*[F.col(f"`{back.get(c, c)}`").alias(c) for c in own.columns], F.col(f"`{text_col}`").alias("_text"))
    schema = T.StructType([*src.schema.fields[:-1], T.StructField("score", T.DoubleType())])

    def run(batches):
        for b in batches:
            s = trees.score(_statistics_of(b.column(b.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s, pa.float64())], names=schema.names)
    return src.mapInArrow(run, schema).withColumnsRenamed(back)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = score(docs, train(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the threshold, with their columns."""
    src, back = apart(docs, "score")
    out = score(src, train(docs, labels)).where(F.col("score") >= THRESHOLD).drop("score")
    return out.withColumnsRenamed(back).select(*[F.col(f"`{c}`") for c in docs.columns])
