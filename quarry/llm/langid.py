"""Language ID by unigrams over a fixed public vocabulary, summed over all
segmentations (operator 7).

A text is a sequence of lower-cased words (split at white space, each with a
word mark before it). For each language every vocabulary piece has a probability; a
word's likelihood is the sum over all ways to cut it into pieces, computed
by the forward algorithm for many words and all languages at once. The
probabilities are fitted by expectation-maximisation (forward-backward
counts) on the words of a bounded sample of documents of known language;
Spark sums the counts, and only the piece table, bounded by the vocabulary
and the number of languages, comes to the driver.

A character that no piece holds has one small probability in every
language. A word of any length is scored over all its segmentations: of a word
of more than LONGEST characters only the last columns of the forward pass are
held. For learning, which takes a sample anyway, such words are cut into runs of
LONGEST characters.

Rows held out (crc32 of the id as text, mod 5 = 0) and rows with a null
language are never learnt from. The prediction reads the text alone: null
texts and texts without a letter are `und` with score 0, as is everything
when there is nothing to learn from. Repeated rows get the same answer,
equal likelihoods the alphabetically first language. A letter is a character
of Unicode category L, so numerals are none. Long texts are read whole; an empty
table gives no rows. Other columns, which may have any name, are not read.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import held_out, written

FIT_DOCS = 500             # documents of each language that are learnt from, about
ROUNDS = 3                 # rounds of expectation-maximisation
SMOOTH = 0.1               # added to each expected count
UNSEEN = 1e-7              # probability of a character that no piece holds
LONGEST = 256              # longer words are learnt from in runs, and scored one by one
CACHE_WORDS = 300_000
CACHE_CHARS = 1 << 24      # characters of the words kept
STRIP = 4096               # characters of a long word whose pieces are looked up at once
GROUP_CELLS = 1 << 21      # words x positions x languages of one forward pass

MARK = "▁"
_LETTER = regex.compile(r"\p{L}")
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Hashes of the pieces of a SentencePiece model, for looking up substrings."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = sorted(sp.id_to_piece(i) for i in range(sp.get_piece_size())
                             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)))
        self.pieces = [p for p in self.pieces if p.strip(MARK)]
        self.longest = max(map(len, self.pieces))
        self.size = len(self.pieces)             # this number stands for "no piece"
        h = np.array([_hash(p) for p in self.pieces], np.uint64)
        order = np.argsort(h)
        self.hashes = np.append(h[order], np.uint64(2 ** 64 - 1))
        self.numbers = np.append(order, self.size)
        assert len(np.unique(h)) == len(h)

    def find(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, h), self.size)
        return np.where(self.hashes[at] == h, self.numbers[at], self.size)


def _hash(s: str) -> int:
    h = 0
    for ch in s:
        h = (h * int(_BASE) + ord(ch) + 1) % 2 ** 64
    return h


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _piece_table(v: Vocabulary, words: list[str]) -> np.ndarray:
    """(words, end, length): the piece of each substring of words of one length."""
    n = len(words[0])
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = points.reshape(len(words), n).astype(np.uint64) + np.uint64(1)
    out = np.full((len(words), n, v.longest), v.size, np.int32)
    h = np.zeros((len(words), n), np.uint64)      # hash of the l characters from each start
    for size in range(1, min(n, v.longest) + 1):
        h = h[:, :n - size + 1] * _BASE + points[:, size - 1:]
        out[:, size - 1:, size - 1] = v.find(h)
    return out


def _forward(table: np.ndarray, p: np.ndarray):
    """(log likelihood (words, languages), alpha, scale): alpha[:, j] is the
    likelihood of the first j characters over the product of scale[:, :j + 1]."""
    words, n, longest = table.shape
    alpha = np.zeros((words, n + 1, p.shape[1]))
    scale = np.ones((words, n + 1))
    alpha[:, 0] = 1
    for j in range(1, n + 1):
        a = np.zeros((words, p.shape[1]))
        shrink = np.ones((words, 1))
        for size in range(1, min(j, longest) + 1):
            # pieces of that length are reached over the scales in between
            if size > 1:
                shrink = shrink / scale[:, j - size + 1, None]
            a += alpha[:, j - size] * p[table[:, j - 1, size - 1]] * shrink
        none = table[:, j - 1, 0] == len(p) - 1
        a[none] += alpha[none, j - 1] * UNSEEN
        scale[:, j] = a.max(axis=1)
        alpha[:, j] = a / scale[:, j, None]
    with np.errstate(divide="ignore"):
        return np.log(alpha[:, n]) + np.log(scale).sum(axis=1)[:, None], alpha, scale


def _expected(table: np.ndarray, p: np.ndarray, weight: np.ndarray, counts: np.ndarray):
    """Add to counts (pieces, languages) how often each piece is expected in
    the words, weight (words, languages) times each."""
    words, n, longest = table.shape
    _, alpha, scale = _forward(table, p)
    beta = np.zeros_like(alpha)
    beta[:, n] = 1
    for j in range(n - 1, -1, -1):
        b = np.zeros_like(beta[:, 0])
        shrink = np.ones((words, 1))
        for size in range(1, min(n - j, longest) + 1):
            shrink = shrink / scale[:, j + size, None]
            b += beta[:, j + size] * p[table[:, j + size - 1, size - 1]] * shrink
        none = table[:, j, 0] == len(p) - 1
        b[none] += beta[none, j + 1] * UNSEEN / scale[none, j + 1, None]
        beta[:, j] = b
    total = np.maximum(alpha[:, n], 1e-300)
    for j in range(1, n + 1):
        shrink = np.ones((words, 1))
        for size in range(1, min(j, longest) + 1):
            shrink = shrink / scale[:, j - size + 1, None]
            piece = table[:, j - 1, size - 1]
            if (piece == len(p) - 1).all():
                continue
            share = weight * alpha[:, j - size] * p[piece] * beta[:, j] * shrink / total
            for lang in range(p.shape[1]):
                counts[:, lang] += np.bincount(piece, share[:, lang], len(p))


def _long_word(v: Vocabulary, word: str, p: np.ndarray) -> np.ndarray:
    """Log likelihood (languages) of one word: row l of `last` is the likelihood
    of the word up to l + 1 characters back, each language over its own scale."""
    last = np.zeros((v.longest, p.shape[1]))
    last[0] = 1
    total = np.zeros(p.shape[1])
    for start in range(0, len(word), STRIP):
        back = max(0, start - v.longest + 1)
        table = _piece_table(v, [word[back:start + STRIP]])[0][start - back:]
        share = p[table]
        share[table[:, 0] == v.size, 0] = UNSEEN
        scales = np.empty((len(table), p.shape[1]))
        for j, row in enumerate(share):
            a = (last * row).sum(axis=0)
            last[1:] = last[:-1] / a
            last[0] = 1
            scales[j] = a
        total += np.log(scales).sum(axis=0)
    return total


def words_of_text(text: str | None) -> list[str]:
    return [MARK + w for w in (text or "").lower().split()]


def split(text: str | None) -> list[str]:
    """The words to learn from, long ones in runs."""
    return [w[i:i + LONGEST] for w in words_of_text(text) for i in range(0, len(w), LONGEST)]


def _by_length(words: list[str], languages: int):
    """Groups (positions, words) of words of one length, of bounded size."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    i = 0
    while i < len(order):
        n = int(lengths[order[i]])
        j = int(np.searchsorted(lengths[order], n, side="right"))
        j = min(j, i + max(1, GROUP_CELLS // ((n + 1) * max(languages, 16))))
        yield order[i:j], [words[k] for k in order[i:j]]
        i = j


class Model:
    """Piece probabilities (pieces + 1, languages); the last row, of substrings
    that are no piece, is zero."""

    def __init__(self, path: str, langs: list[str], p: np.ndarray):
        self.path, self.langs, self.p = path, langs, p

    def log_likelihood(self, words: list[str]) -> np.ndarray:
        v = vocabulary(self.path)
        out = np.zeros((len(words), len(self.langs)))
        short = np.array([i for i, w in enumerate(words) if len(w) <= LONGEST], np.int64)
        for at, group in _by_length([words[i] for i in short], len(self.langs)):
            out[short[at]] = _forward(_piece_table(v, group), self.p)[0]
        for i, w in enumerate(words):
            if len(w) > LONGEST:
                out[i] = _long_word(v, w, self.p)
        return out


def train(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", fit_docs: int = FIT_DOCS, rounds: int = ROUNDS) -> Model:
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    per_lang = {r[0]: r[1] for r in usable.groupBy(lang_col).count().collect()}   # a row a language
    langs = sorted(per_lang)
    if not langs:
        return Model(model_path, [], np.zeros((1, 0)))
    keep = F.lit(False)
    part = F.pmod(F.xxhash64(id_col), F.lit(1 << 30))
    for lang, n in per_lang.items():
        keep |= (F.col(lang_col) == lang) & (part < int((1 << 30) * min(1.0, fit_docs / n)))
    number = {lang: i for i, lang in enumerate(langs)}

    def words_of(batches):
        for b in batches:
            count = Counter()
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                count.update((number[lang], w) for w in split(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in count], pa.int32()), pa.array([k[1] for k in count], pa.string()),
                 pa.array(list(count.values()), pa.int64())], names=["lang", "word", "n"])

    words = written(usable.where(keep).select(lang_col, text_col)
                    .mapInArrow(words_of, "lang int, word string, n long")
                    .groupBy("word", "lang").agg(F.sum("n").alias("n")), "words")
    size = vocabulary(model_path).size
    p = np.full((size + 1, len(langs)), 1.0 / size)
    p[size] = 0
    for _ in range(rounds):
        counts = _counts(words, model_path, p)
        p = (counts + SMOOTH) / (counts + SMOOTH)[:size].sum(axis=0)
        p[size] = 0
    return Model(model_path, langs, p)


def _counts(words: DataFrame, path: str, p: np.ndarray) -> np.ndarray:
    shared = words.sparkSession.sparkContext.broadcast(p)

    def run(batches):
        p = shared.value
        v = vocabulary(path)
        counts = np.zeros_like(p)
        for b in batches:
            text = b.column(0).to_pylist()
            weight = np.zeros((len(text), p.shape[1]))
            weight[np.arange(len(text)), b.column(1).to_numpy()] = b.column(2).to_numpy()
            for at, group in _by_length(text, p.shape[1]):
                _expected(_piece_table(v, group), p, weight[at], counts)
        piece, lang = np.nonzero(counts[:-1] > 1e-12)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(counts[piece, lang])],
            names=["piece", "lang", "n"])

    # a row a piece and language at most: bounded by the vocabulary
    got = (words.select("word", "lang", "n").mapInArrow(run, "piece int, lang int, n double")
                .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros_like(p)
    out[got.column("piece").to_numpy(), got.column("lang").to_numpy()] = got.column("n").to_numpy()
    return out


class Scorer:
    """Scores texts; a word's likelihoods are kept while the cache holds it."""

    def __init__(self, m: Model):
        self.m = m
        self._reset()

    def _reset(self):
        self.at: dict[str, int] = {}
        self.chars = 0
        self.table = np.zeros((1024, len(self.m.langs)))

    def _learn(self, words: set[str]):
        new = [w for w in words if w not in self.at]
        if len(self.at) + len(new) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self._reset()
            new = list(words)
        if not new:
            return
        self.chars += sum(map(len, new))
        n = len(self.at)
        while len(self.table) < n + len(new):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[n:n + len(new)] = self.m.log_likelihood(new)
        self.at.update(zip(new, range(n, n + len(new))))

    def predict(self, texts: list[str | None]):
        """(language, score) of each text."""
        if not self.m.langs:
            return [("und", 0.0)] * len(texts)
        words = [words_of_text(t) if t and _LETTER.search(t) else None for t in texts]
        self._learn({w for ws in words if ws for w in ws})
        out, get = [], self.at.__getitem__
        for ws in words:
            if not ws:
                out.append(("und", 0.0))
                continue
            s = self.table[list(map(get, ws))].sum(axis=0)
            best = int(np.argmax(s))
            out.append((self.m.langs[best], float(1 / np.exp(s - s[best]).sum())))
        return out


def predictions(docs: DataFrame, m: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(m)
    src = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                      F.col(text_col).alias("text"))

    def run(batches):
        s = Scorer(shared.value)
        for b in batches:
            out, texts, size = [], [], 0
            for t in b.column(2).to_pylist():
                texts.append(t)
                size += len(t or "")
                if size > 1 << 20:
                    out += s.predict(texts)
                    texts, size = [], 0
            out += s.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([o[0] for o in out], pa.string()),
                 pa.array([o[1] for o in out], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
    return src.mapInArrow(run, T.StructType([
        src.schema["doc_id"], T.StructField("held_out", T.BooleanType()),
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
