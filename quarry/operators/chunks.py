"""Postings by the chunk: what the term table and the pairs are dealt by.

A document is a row, so its words are counted where it is read: Spark splits
the text into tokens, and a task groups the tokens of a few thousand documents
at once, in Arrow. What goes through the exchange is not a row a posting but a
row a chunk: a word with up to CHUNK_DOCS of its documents, consecutive ones in
the order of their ids. Chunks of a word do not overlap, each has its place
in the order of (field, word, block), and behind the exchange they are unrolled
to the rows of the table. The chunks that a task sends to one partition are a
message: their Arrow batch, compressed.

The places where the order is cut are taken from a sample of documents; they
say which file a row is in, and nothing else.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.distance import HALF_MARK, LONG_TERM, SHORT_TERM, neighbourhood

# Documents of a chunk: a word that every document has is dealt to as many
# partitions as its rows fill.
CHUNK_DOCS = 128
# Tokens that a task groups at once.
PIECE_TOKENS = 3 << 20
# Documents (at least, and for each partition) and rows (for each partition, and
# in all) of the sample that says where the order is cut.
SAMPLE_DOCS, SAMPLE_DOCS_EACH = 2_000, 4
SAMPLE_ROWS_EACH, SAMPLE_ROWS = 100, 200_000
# Terms for a document in that sample, where a vocabulary is dealt.
TERMS_EACH = 8
# Bits of a document's length beside its block.
LENGTH_BITS = 32
# Characters of the keys of all but long terms, at most.
KEY_CHARS = max(SHORT_TERM, 2 + LONG_TERM - LONG_TERM // 2)
MESSAGE = "part int, message binary"


def _tokens_in(batch: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(batch.column("toks")), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _pieces(batches) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches joined or cut to at most PIECE_TOKENS tokens (or one row), with their rows' numbers of tokens."""
    held, n = [], 0
    for batch in batches:
        ends, at = np.cumsum(_tokens_in(batch)), 0
        while at < len(ends):
            done = ends[at - 1] if at else 0
            to = int(np.searchsorted(ends, done + PIECE_TOKENS - n, side="right"))
            if to > at or not held:
                to = max(to, at + 1)
                held.append(batch.slice(at, to - at))
                n, at = n + int(ends[to - 1] - done), to
            if at < len(ends):
                yield pa.concat_batches(held), np.concatenate([_tokens_in(b) for b in held])
                held, n = [], 0
    if held:
        yield pa.concat_batches(held), np.concatenate([_tokens_in(b) for b in held])


def _starts(changed: np.ndarray) -> np.ndarray:
    """Where runs begin: at the first place, and wherever something changed from the place before."""
    return np.flatnonzero(np.concatenate([[True], changed]))


def _order(key: np.ndarray) -> np.ndarray:
    """A stable order of numbers from 0 on: with their places in their low bits, if there is room, they are sorted as they are."""
    bits = len(key).bit_length()
    if not len(key) or int(key.max()) >> (63 - bits):
        return np.argsort(key, kind="stable")
    return np.sort(key.astype(np.int64) << bits | np.arange(len(key))) & ((1 << bits) - 1)


def _lists(starts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


def _messages(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows with their `part` as (part, message): a compressed Arrow stream for each part."""
    part = batch.column("part").to_numpy()
    order = _order(part)
    part, rows = part[order], batch.drop_columns(["part"]).take(pa.array(order))
    starts, out = _starts(part[1:] != part[:-1]), []
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]):
        sink = pa.BufferOutputStream()
        with pa.CompressedOutputStream(sink, "zstd") as packed, pa.ipc.new_stream(packed, rows.schema) as stream:
            stream.write_batch(rows.slice(lo, hi - lo))
        out.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(part[starts], pa.int32()), pa.array(out, pa.binary())], ["part", "message"])


def _unpacked(batches) -> Iterator[pa.RecordBatch]:
    """The rows of messages, batch by batch."""
    for batch in batches:
        for message in batch.column("message"):
            yield from pa.ipc.open_stream(pa.CompressedInputStream(pa.BufferReader(message.as_buffer()), "zstd"))


def _chunk_rows(names: list[str]) -> Callable:
    """The task behind the exchange: messages to chunks, with where each document's places start among them."""

    def run(batches):
        for chunks in _unpacked(batches):
            lists = chunks.column("tf")
            tf, at = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            before = np.cumsum(tf) - tf
            start = before - np.repeat(before[at[:-1]], np.diff(at)) + 1
            columns = {**dict(zip(chunks.schema.names, chunks.columns)), "start": pa.ListArray.from_arrays(lists.offsets, pa.array(start, pa.int32()))}
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return run


def _chunks(names: list[str], run_blocks: int, gaps: bool, common: dict[str, list[str]] | None,
            cuts: list[tuple] | None) -> Callable:
    """The task: batches (doc_id, block, field, toks) to messages of chunks of words, or
    with `common` (words by field) of pairs of common words that stand together."""

    def grouped(batch: pa.RecordBatch, lens: np.ndarray):
        row = np.repeat(np.arange(len(lens), dtype=np.int32), lens)
        pos = (np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int32)
        encoded = batch.column("toks").flatten().dictionary_encode()
        words, code = encoded.dictionary, encoded.indices.to_numpy()
        if cuts:        # words in order, so that chunks are
            in_order = pc.sort_indices(words).to_numpy()
            words, rank = words.take(pa.array(in_order)), np.empty(len(in_order), np.int32)
            rank[in_order] = np.arange(len(in_order))
            code = rank[code]
        field = batch.column("field").dictionary_encode()
        fields, in_field = field.dictionary, field.indices.to_numpy()
        block = batch.column("block").to_numpy()
        # documents ascend only within a partition of the corpus, which the block's high bits number
        runs, run = np.unique(block // run_blocks, return_inverse=True)
        own = in_field.astype(np.int64) * len(runs) + run
        dl = lens
        real = None
        if gaps:
            real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)[code]
            dl = np.bincount(row[real], minlength=len(lens))
        if common is None:
            tok = np.arange(len(row)) if real is None else np.flatnonzero(real)
            key = own[row[tok]] * len(words) + code[tok]
        else:
            known = np.stack([pc.is_in(words, pa.array(common.get(f, []), pa.string())).to_numpy(zero_copy_only=False)
                              for f in fields.to_pylist()])
            here = known[in_field[row], code]
            tok = np.flatnonzero(here[:-1] & here[1:] & (row[:-1] == row[1:]))
            any_field = known.any(axis=0)
            short, n = np.cumsum(any_field) - 1, int(any_field.sum())
            key = (own[row[tok]] * n + short[code[tok]]) * n + short[code[tok + 1]]
        if not len(tok):
            return None
        order = _order(key)
        tok, key = tok[order], key[order]
        docs = row[tok]
        posting = _starts((key[1:] != key[:-1]) | (docs[1:] != docs[:-1]))
        docs, key = docs[posting], key[posting]
        word = _starts(key[1:] != key[:-1])
        nth = np.arange(len(key)) - np.repeat(word, np.diff(np.append(word, len(key))))
        chunk = np.flatnonzero(nth % CHUNK_DOCS == 0)
        first = tok[posting[chunk]]
        columns = [fields.take(pa.array(in_field[row[first]])), words.take(pa.array(code[first]))]
        if common is not None:
            columns.append(words.take(pa.array(code[first + 1])))
        # chunks of one field and run are in order: the cuts' places among them are looked up
        part, head = np.zeros(len(chunk), np.int32), block[docs[chunk]]
        group = _starts(np.diff(own[row[first]]) != 0).tolist() if cuts else []
        for lo, hi in zip(group, [*group[1:], len(chunk)]):
            at = [bisect_left(range(hi), c, lo, key=lambda i: (*[w[i].as_py() for w in columns], int(head[i]))) for c in cuts]
            part[lo:hi] = np.searchsorted(np.array(at), np.arange(lo, hi), side="right")
        tf = np.diff(np.append(posting, len(tok)))
        # block (within the run) and length share a number: half the bytes to send
        packed = (block[docs] % run_blocks << LENGTH_BITS) | dl[docs]
        return _messages(pa.RecordBatch.from_arrays([
            pa.array(part, pa.int32()), *columns, pa.array(head // run_blocks, pa.int64()),
            _lists(chunk, batch.column("doc_id").take(pa.array(docs))), _lists(chunk, pa.array(packed, pa.int64())),
            _lists(chunk, pa.array(tf, pa.int32())), _lists(posting[chunk], pa.array(pos[tok], pa.int32()))], ["part", *[c for c in names if c != "start"]]))

    def run(batches):
        for piece, lens in _pieces(batches):
            out = grouped(piece, lens) if lens.any() else None
            if out is not None:
                yield out

    return run


def _chunked(toks: DataFrame, run_blocks: int, gaps: bool, common: dict[str, list[str]] | None, cuts: list[tuple] | None, n: int | None = None) -> DataFrame:
    """The chunks of the tokens, in n partitions by the cuts or (None) where they are made."""
    words = ["term"] if common is None else ["w1", "w2"]
    lists = {"doc_id": toks.schema["doc_id"].dataType, "packed": T.LongType(), "start": T.IntegerType(), "tf": T.IntegerType(),
             "places": T.IntegerType()}
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in ["field", *words]], T.StructField("run", T.LongType()),
                           *[T.StructField(c, T.ArrayType(t)) for c, t in lists.items()]])
    sent = toks.select("doc_id", "block", "field", "toks").mapInArrow(_chunks(schema.names, run_blocks, gaps, common, cuts), MESSAGE)
    return _sent(sent, n).mapInArrow(_chunk_rows(schema.names), schema)


def _sent(messages: DataFrame, n: int | None) -> DataFrame:
    return messages.repartitionById(n, F.col("part")) if n else messages


def _block(run_blocks: int) -> Column:
    return F.col("run") * run_blocks + F.shiftright("packed", LENGTH_BITS)


def _cuts(rows: DataFrame, n: int) -> list[tuple]:
    """At most n - 1 places that cut the order of the sampled rows into equal parts."""
    some = sorted(tuple(r) for r in rows.orderBy(F.rand(7)).limit(min(SAMPLE_ROWS_EACH * n, SAMPLE_ROWS)).collect())
    return sorted({some[len(some) * i // n] for i in range(1, n)}) if some else []


def _sample(df: DataFrame, rows: int, n: int) -> DataFrame:
    share = max(SAMPLE_DOCS, SAMPLE_DOCS_EACH * n) / max(rows, 1)
    return df.sample(share, seed=7) if share < 1 else df


def posting_rows(tokens_of: Callable[[DataFrame], DataFrame], corpus: DataFrame, n_docs: int, n: int, run_blocks: int,
                 gaps: bool, common: dict[str, list[str]] | None = None) -> DataFrame:
    """(field, term, doc_id, dl, block, tf, positions), or for pairs (field, w1, w2,
    doc_id, ...), in n partitions that are ranges of (field, words, block) and
    sorted. `tokens_of` makes (doc_id, block, field, toks) of a corpus."""
    words = ["term"] if common is None else ["w1", "w2"]
    cuts = None
    if n > 1:
        chunks = _chunked(tokens_of(_sample(corpus, n_docs, n)), run_blocks, gaps, common, None)
        rows = chunks.select("field", *words, "run", F.explode("packed").alias("packed"))
        cuts = _cuts(rows.select("field", *words, _block(run_blocks)), n)
    # chunks in order unroll to rows in order, which the last sort only has to check
    rows = (_chunked(tokens_of(corpus), run_blocks, gaps, common, cuts, n)
            .sortWithinPartitions("field", *words, F.get("doc_id", F.lit(0)))
            .select("field", *words, "run", "places", F.inline(F.arrays_zip("doc_id", "packed", "start", "tf"))))
    length = F.col("packed").bitwiseAND((1 << LENGTH_BITS) - 1).cast("int")
    return rows.select("field", *words, "doc_id", length.alias("dl"), _block(run_blocks).alias("block"), "tf",
                       F.slice("places", F.col("start"), F.col("tf")).alias("positions")).sortWithinPartitions("field", *words, "doc_id")


def _deletions(chars: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, strings) that words of one length (a row of characters each) leave
    without k of them, each string of a word once: where its characters are the
    first ones that can be kept."""
    places = range(chars.shape[1])
    for gone in combinations(places, k):
        kept = [i for i in places if i not in gone]
        first = np.ones(len(chars), bool)
        for i in gone:
            after = next((j for j in kept if j > i), None)
            if after is not None:
                first &= chars[:, i] != chars[:, after]
        rows = np.flatnonzero(first)
        yield rows, chars[np.ix_(rows, kept)]


def neighbourhoods(terms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the keys of `neighbourhood` of all terms of up to LONG_TERM characters."""
    by_length: dict[int, list[int]] = {}
    for i, t in enumerate(terms):
        if len(t) <= LONG_TERM:
            by_length.setdefault(len(t), []).append(i)
    rows, keys = [np.zeros(0, np.int64)], [np.zeros((0, KEY_CHARS), np.uint32)]
    for n, own in by_length.items():
        own = np.array(own)
        chars = np.array([terms[i] for i in own], f"U{max(n, 1)}").view(np.uint32).reshape(len(own), -1)[:, :n]
        parts = [("", chars, 2)] if n <= SHORT_TERM else [(f"{HALF_MARK}0", chars[:, :n // 2], 1), (f"{HALF_MARK}1", chars[:, n // 2:], 1)]
        for mark, part, most in parts:
            for k in range(most + 1):
                for some, left in _deletions(part, k):
                    made = np.zeros((len(some), KEY_CHARS), np.uint32)
                    made[:, :len(mark)] = [ord(c) for c in mark]
                    made[:, len(mark):len(mark) + left.shape[1]] = left
                    rows.append(own[some])
                    keys.append(made)
    return np.concatenate(rows), np.concatenate(keys).view(f"U{KEY_CHARS}").ravel()


def _near(cuts: list[tuple] | None) -> Callable:
    """The task: batches (field, term) to messages of terms with their keys, a row for each part they are dealt to."""
    below = {}
    for i, (f, key) in enumerate(cuts or []):
        below.setdefault(f, (i, []))[1].append(key)

    def dealt(field: str, terms: list[str]) -> pa.RecordBatch:
        least, ends = below.get(field, (bisect_right(cuts or [], (field,)), []))
        # numpy drops a string's last NULs
        row, key = neighbourhoods([t if "\0" not in t else " " * (LONG_TERM + 1) for t in terms])
        rest = [(i, k) for i, t in enumerate(terms) if len(t) > LONG_TERM or "\0" in t for k in neighbourhood(t)]
        # a longer end compares with a key as its first characters do
        part = np.searchsorted(np.array([e[:KEY_CHARS + 1] for e in ends], f"U{KEY_CHARS + 1}"), key, side="right")
        part = np.concatenate([part, np.array([bisect_right(ends, k) for _, k in rest], np.int64)])
        row = np.concatenate([row, np.array([i for i, _ in rest], np.int64)])
        keys = pa.concat_arrays([pa.array(key, pa.string()), pa.array([k for _, k in rest], pa.string())])
        order = np.lexsort((row, part))
        part, row = part[order], row[order]
        starts = _starts((part[1:] != part[:-1]) | (row[1:] != row[:-1]))
        term = pa.array(terms, pa.string()).take(pa.array(row[starts]))
        return pa.RecordBatch.from_arrays([
            pa.array(least + part[starts], pa.int32()), pa.array([field] * len(starts), pa.string()), term,
            _lists(starts, keys.take(pa.array(order)))], ["part", "field", "term", "keys"])

    def run(batches):
        for batch in batches:
            for field in pc.unique(batch.column("field")).to_pylist():
                yield _messages(dealt(field, batch.column("term").filter(pc.equal(batch.column("field"), field)).to_pylist()))

    return run


def near_rows(vocab: DataFrame, n: int) -> DataFrame:
    """(field, key, n, term): a vocabulary's terms under the keys by which
    anything within two edits finds them (n is the term's length), in n
    partitions that are ranges of (field, key), sorted. A term's keys mostly
    begin alike: those of one partition are sent together."""
    words = vocab.select("field", "term")

    def keyed(words, cuts, n):
        return _sent(words.mapInArrow(_near(cuts), MESSAGE), n).mapInArrow(_unpacked, "field string, term string, keys array<string>")

    cuts = None
    if n > 1:
        some = keyed(_sample(words, words.count(), n * TERMS_EACH), None, None)
        cuts = _cuts(some.select("field", F.explode("keys")), n)
    return (keyed(words, cuts, n)
                 .select("field", F.explode("keys").alias("key"), F.char_length("term").alias("n"), "term")
                 .sortWithinPartitions("field", "key", "n"))
