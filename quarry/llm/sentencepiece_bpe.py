"""SentencePiece BPE encoding and decoding by vectorised merge rounds (operator 9).

A text becomes flat numpy arrays of symbols, one run per word. Each round
looks up the rank of every adjacent pair, takes the smallest rank in each
word (a segmented minimum), merges the leftmost pairs of that rank in all
words at the same time, and compacts the arrays; it ends when no word holds
a mergeable pair. No tokenizer is trained and none does the encoding: the
model file gives only pieces and scores.

Words are cut where a word mark follows something else. No piece of the
model holds a mark after another character, so no merge crosses a cut (this
is checked when the model is loaded). Equal words are encoded once and kept
in a bounded cache in each Python worker.

Several equal pairs of one word are merged in one round only where that
cannot change the result: when no piece that begins or ends with the merged
piece has a rank as good as its own. Otherwise only the leftmost is merged.

A word of more than LONG_WORD characters takes the same rounds, but on linked
symbols with the places of each rank kept beside them: a round then costs what
it merges, not the length of the word.

Nulls count as empty text, and an empty text has no ids. A very long text is
handled word by word; rows that repeat are encoded as often as they occur. An
empty table gives no rows. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import apart, fresh

MARK = "▁"
CACHE_WORDS = 150_000          # words kept by a Python worker; more start a new cache
BATCH_WORDS = 50_000           # words that one set of merge rounds takes
LONG_WORD = 1024               # characters of a word whose rounds are indexed by rank

_NO = np.iinfo(np.int64).max


def _each_byte(e):
    return "�", e.start + 1


codecs.register_error("quarry_each_byte", _each_byte)


class PieceModel:
    """Pieces, ranks and the pair table of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        usual = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i)
                                             or sp.is_unknown(i) or sp.is_unused(i))]
        if any(MARK in pieces[i].lstrip(MARK) for i in usual):
            raise ValueError("a piece holds a word mark after another character")
        self.unk = sp.unk_id()
        byte_id = {int(pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        # symbols: piece ids, then characters that only occur inside pieces
        symbol = {pieces[i]: i for i in usual}
        for i in usual:
            for ch in pieces[i]:
                symbol.setdefault(ch, n + len(symbol))
        self.n_pieces = n
        by_score = sorted({sp.get_score(i) for i in usual}, reverse=True)
        rank_of = {s: r for r, s in enumerate(by_score)}
        rank = {pieces[i]: rank_of[sp.get_score(i)] for i in usual}

        left, right, made, ranks = [], [], [], []
        best_longer: dict[str, int] = {}       # best rank of a longer piece around a piece
        for i in usual:
            z = pieces[i]
            for cut in range(1, len(z)):
                x, y = z[:cut], z[cut:]
                for part in (x, y):
                    if rank[z] < best_longer.get(part, 1 << 60):
                        best_longer[part] = rank[z]
                if x in symbol and y in symbol:
                    left.append(symbol[x])
                    right.append(symbol[y])
                    made.append(i)
                    ranks.append(rank[z])
        key = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(key)
        self.pair_key = np.append(key[order], _NO)
        self.pair_made = np.append(np.array(made, np.int64)[order], 0)
        self.pair_rank = np.append(np.array(ranks, np.int64)[order], _NO)
        self.alone = np.zeros(n, bool)         # merge one pair of a word at a time
        for i in usual:
            self.alone[i] = best_longer.get(pieces[i], 1 << 60) <= rank[pieces[i]]
        self.char = np.full(0x110000, -1, np.int64)
        for ch, s in symbol.items():
            if len(ch) == 1:
                self.char[ord(ch)] = s
        # what a symbol is written as: its id, or the ids of its bytes
        self.byte_id, self.byte_ids = byte_id, frozenset(byte_id.values())
        self.surface = [b""] * n
        for i in usual:
            self.surface[i] = pieces[i].replace(MARK, " ").encode()
        for b, i in byte_id.items():
            self.surface[i] = bytes([b])
        self.surface[self.unk] = " ⁇ ".encode()
        self.decimal = [str(i) for i in range(n)]

    # ------------------------------------------------------------- encode
    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word (a run of marks, then characters without any)."""
        if not words:
            return []
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self.char[points]
        unknown = sym < 0
        sym = np.where(unknown, -1 - points.astype(np.int64), sym)
        word = np.repeat(np.arange(len(words)), lengths)
        ends = np.cumsum(lengths)
        long = np.flatnonzero(lengths > LONG_WORD)
        merged = [(self._merge_indexed(sym[ends[w] - lengths[w]:ends[w]]), w) for w in long]
        if len(long):
            short = (lengths <= LONG_WORD)[word]
            sym, word = sym[short], word[short]
        sym, word = self._merge_rounds(sym, word)
        if len(long):
            sym = np.concatenate([sym, *[s for s, _ in merged]])
            word = np.concatenate([word, *[np.full(len(s), w) for s, w in merged]])
            order = np.argsort(word, kind="stable")
            sym, word = sym[order], word[order]
        return self._ids(sym, word, len(words))

    def _pairs(self, sym, word, at):
        """(rank, piece) of the pairs that begin at the positions `at`."""
        at1 = np.minimum(at + 1, len(sym) - 1)
        return self._ranked(sym[at], sym[at1], (at1 > at) & (word[at] == word[at1]))

    def _ranked(self, x, y, ok):
        ok = ok & (x >= 0) & (y >= 0)
        key = x << 32 | y
        slot = np.searchsorted(self.pair_key, np.where(ok, key, _NO))
        hit = ok & (self.pair_key[slot] == key)
        return np.where(hit, self.pair_rank[slot], _NO), np.where(hit, self.pair_made[slot], 0)

    def _merge_rounds(self, sym: np.ndarray, word: np.ndarray):
        done_sym, done_word = [], []
        rank, made = self._pairs(sym, word, np.arange(len(sym)))
        while len(sym):
            # segmented minimum: the best rank of each word
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(rank, starts)
            low_at = np.repeat(low, np.diff(np.r_[starts, len(sym)]))
            ended = low_at == _NO
            if ended.any():
                done_sym.append(sym[ended])
                done_word.append(word[ended])
                live = ~ended
                sym, word, rank, made, low_at = (a[live] for a in (sym, word, rank, made, low_at))
                if not len(sym):
                    break
            p = np.flatnonzero(rank == low_at)
            # a word whose piece must be merged singly keeps its leftmost pair
            first = np.r_[True, word[p[1:]] != word[p[:-1]]]
            first_at = np.maximum.accumulate(np.where(first, np.arange(len(p)), 0))
            p = p[first | ~self.alone[made[p]][first_at]]
            # overlapping pairs: every second one of a run, from the left
            run = np.r_[True, p[1:] != p[:-1] + 1]
            run_at = np.maximum.accumulate(np.where(run, np.arange(len(p)), 0))
            p = p[(np.arange(len(p)) - run_at) % 2 == 0]
            # merge, compact, and look up the pairs beside the new symbols
            sym[p] = made[p]
            stay = np.ones(len(sym), bool)
            stay[p + 1] = False
            new = p - np.arange(len(p))
            sym, word, rank, made = (a[stay] for a in (sym, word, rank, made))
            at = np.concatenate([new, np.maximum(new - 1, 0)])
            rank[at], made[at] = self._pairs(sym, word, at)
        if not done_sym:
            return sym, word
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    def _merge_indexed(self, sym: np.ndarray) -> np.ndarray:
        """The rounds of one long word: symbols stay in place, linked to their
        neighbours; `places` holds where a pair of each rank may begin."""
        n = len(sym)
        sym = np.append(sym, -1)                   # place n ends the word
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        rank, made = np.full(n + 1, _NO), np.zeros(n + 1, np.int64)
        places: dict[int, list[int]] = {}
        ranks: list[int] = []

        def note(at):
            for r, i in zip(rank[at].tolist(), at.tolist()):
                if r == _NO:
                    continue
                if r not in places:
                    places[r] = []
                    heapq.heappush(ranks, r)
                places[r].append(i)

        def look(at):
            rank[at], made[at] = self._ranked(sym[at], sym[after[at]], after[at] < n)
            note(at)

        look(np.arange(n))
        while ranks:
            low = heapq.heappop(ranks)
            p = np.unique(np.array(places.pop(low), np.int64))
            p = p[rank[p] == low]
            if not len(p):
                continue
            if self.alone[made[p[0]]]:
                note(p[1:])
                p = p[:1]
            # overlapping pairs: every second one of a run, from the left
            run = np.r_[True, p[1:] != after[p[:-1]]]
            run_at = np.maximum.accumulate(np.where(run, np.arange(len(p)), 0))
            p = p[(np.arange(len(p)) - run_at) % 2 == 0]
            gone = after[p]
            sym[p] = made[p]
            rank[gone] = _NO
            sym[gone] = -1
            after[p] = after[gone]
            before[after[p]] = p
            after[gone] = -1
            left = before[p]
            look(np.unique(np.concatenate([p, left[left >= 0]])))
        return sym[:n][after[:n] >= 0]

    def _ids(self, sym: np.ndarray, word: np.ndarray, n: int) -> list[list[int]]:
        odd = set(word[(sym < 0) | (sym >= self.n_pieces)].tolist())
        flat = sym.tolist()
        ends = np.searchsorted(word, np.arange(1, n + 1)).tolist()
        out, i = [], 0
        for e in ends:
            out.append(flat[i:e])
            i = e
        for w in odd:
            out[w] = [x for s in out[w] for x in self._spell(s)]
        return out

    def _spell(self, s: int) -> list[int]:
        if 0 <= s < self.n_pieces:
            return [s]
        point = -1 - s if s < 0 else int(np.flatnonzero(self.char == s)[0])
        data = chr(point).encode("utf-8", "surrogatepass")
        if all(b in self.byte_id for b in data):
            return [self.byte_id[b] for b in data]
        return [self.unk]

    # ------------------------------------------------------------- decode
    def decode(self, ids) -> str:
        """Text of ids: surfaces joined, byte pieces read as UTF-8 (a byte
        that fits nowhere becomes U+FFFD; a control id ends a run of bytes),
        the space put before the text taken off."""
        surface = self.surface
        parts, run, first = [], [], None
        for i in ids:
            if surface[i]:
                first = i if first is None else first
                run.append(surface[i])
            else:
                parts.append(b"".join(run).decode("utf-8", "quarry_each_byte"))
                run = []
        parts.append(b"".join(run).decode("utf-8", "quarry_each_byte"))
        text = "".join(parts)
        marked = first is not None and first != self.unk and first not in self.byte_ids
        return text[1:] if marked and text[:1] == " " else text


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def split_words(text: str) -> list[str]:
    """The words of a text: spaces become marks and one stands before it."""
    if not text:
        return []
    return _WORD.findall(MARK + text.replace(" ", MARK))


class Encoder:
    """Encodes texts; equal words are merged once while the cache holds them."""

    def __init__(self, path: str):
        self.model = model(path)
        self.cache: dict[str, tuple] = {}

    def _learn(self, words):
        new = list(set(words).difference(self.cache))
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache = {}
            new = list(set(words))
        surface, decimal = self.model.surface, self.model.decimal
        for i in range(0, len(new), BATCH_WORDS):
            part = new[i:i + BATCH_WORDS]
            for w, ids in zip(part, self.model.encode_words(part)):
                self.cache[w] = (len(ids), ",".join([decimal[k] for k in ids]),
                                 b"".join([surface[k] for k in ids]))

    def lookup(self, texts: list[str]):
        """For each text the (count, ids, surface) of its words, in order."""
        words = [split_words(t) for t in texts]
        self._learn([w for ws in words for w in ws])
        get = self.cache.__getitem__
        return [list(map(get, ws)) for ws in words]

    def encode(self, text: str | None) -> list[int]:
        return _ids_of(self.lookup([text or ""])[0]).tolist()

    def decode(self, ids) -> str:
        return self.model.decode(ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder, and so one cache, for all tasks of a Python worker."""
    return Encoder(path)


def _ids_of(entries) -> np.ndarray:
    text = ",".join([e[1] for e in entries])
    return np.fromstring(text, np.int32, sep=",") if text else np.zeros(0, np.int32)


def _runs(column: pa.Array, limit: int = 1 << 20):
    """Slices (row, texts) of about `limit` characters, so that memory is
    bounded; nulls as empty texts."""
    at, run, size = 0, [], 0
    for i, v in enumerate(column):
        run.append(v.as_py() or "")
        size += len(run[-1])
        if size >= limit:
            yield at, run
            at, run, size = i + 1, [], 0
    if run:
        yield at, run


def encode(docs: DataFrame, model_path: str, text_col: str = "text",
           decoded_col: str | None = None) -> DataFrame:
    """`docs` with `ids` (array of int) and `n_tokens`, and with what the ids
    decode to in `decoded_col` if one is named; other columns stay, but for
    ones of these names, which are replaced."""
    own, back = apart(fresh(docs, "ids", "n_tokens", *([decoded_col] if decoded_col else [])), "_text")
    kept = own.columns
    src = docs.select(*[F.col(f"`{back.get(c, c)}`").alias(c) for c in kept], F.col(f"`{text_col}`").alias("_text"))
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    added += [T.StructField(decoded_col, T.StringType())] if decoded_col else []
    out = T.StructType([*src.schema.fields[:-1], *added])

    def run(batches):
        enc = encoder(model_path)
        for b in batches:
            for row, texts in _runs(b.column(len(kept))):
                ids = [_ids_of(es) for es in enc.lookup(texts)]
                n = np.array([len(x) for x in ids], np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()),
                                                 pa.array(np.concatenate(ids), pa.int32()))
                cols = [*b.slice(row, len(texts)).columns[:-1], lists, pa.array(n)]
                if decoded_col:
                    cols.append(pa.array([enc.decode(x.tolist()) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=out.names)
    return src.mapInArrow(run, out).withColumnsRenamed(back)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`df` with the text of its ids in `out_col` (a column of that name is
    replaced); null ids give empty text."""
    src = fresh(df, out_col)
    out = T.StructType([f for f in src.schema.fields] + [T.StructField(out_col, T.StringType())])
    at = src.columns.index(ids_col)

    def run(batches):
        m = model(model_path)
        for b in batches:
            texts = [m.decode(x.values.to_numpy().tolist()) if x.is_valid else "" for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             names=out.names)
    return src.mapInArrow(run, out)


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the
    ids, and keep only the digests. Decoding joins the surfaces of the ids word
    by word, which is what `PieceModel.decode` does with the whole list: no
    character's bytes are spread over two words."""
    src = docs.select(id_col, text_col)
    kind = src.schema[id_col].dataType

    def run(batches):
        enc = encoder(model_path)
        for b in batches:
            n, ids, back = [], [], []
            for _, texts in _runs(b.column(1)):
                for es in enc.lookup(texts):
                    n.append(sum([e[0] for e in es]))
                    ids.append(hashlib.sha256(",".join([e[1] for e in es]).encode()).hexdigest())
                    data = b"".join([e[2] for e in es])
                    text = (data[1:] if data[:1] == b" " else data).decode("utf-8", "quarry_each_byte")
                    back.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return src.mapInArrow(run, T.StructType([
        T.StructField("doc_id", kind), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]))
