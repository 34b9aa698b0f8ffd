"""Suffix-array dedup: remove every byte of a string of L bytes that also
starts elsewhere (operator 10).

The order of suffixes is built column by column for many strings at once:
each round puts one symbol in front of every string's suffix, which permutes
the collection's Burrows-Wheeler column (a stable sort by the new symbol is
the LF step) and extends the common prefixes of neighbours (one more than
the least over the rows in between). Neighbours with a common prefix of L
hold a repeated string. What the published construction keeps in sequential
files between rounds is here the order and the prefixes of a bounded batch,
and between steps the tables in Spark's shared folder.

Whole documents cannot be rounds long (a round per byte of the longest), so
the strings are contexts of anchors, which also deals them out:

  * every string of L bytes has an anchor, the leftmost of its K-byte
    substrings with the least hash; equal strings have equal anchors at equal
    places, so all occurrences of a repeated string meet under their
    anchor's hash, aligned, within L - K bytes of it on either side;
  * anchors whose hash occurs once are dropped (counted with partial sums);
  * contexts that occur twice or more in full are repeated as a whole. One
    of each goes on, beside the contexts that occur once;
  * the rounds run on the distinct contexts of an anchor, aligned, so that
    only suffixes that begin in the same column are compared. A batch holds
    whole groups. A group of more than GROUP contexts is not gathered: its
    windows are counted one by one, by hash, with partial sums.

Strings are judged on the input bytes, matches never cross documents, and
overlapping or same-document repeats count. Null and short texts have none.
Documents with the same text share their result; rows that repeat an id are
separate documents. Ties do not arise: every occurrence of a repeated string
goes. An empty table gives no rows, a very long text is cut like any other.
Other columns are carried along, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import apart, slices, strings, tasks_for, written
from quarry.llm.shingles import _RNG, BYTE_VALUE, mix, powers, prefix

L = 200                  # length of a repeated string, in bytes
K = 32                   # length of an anchor
GROUP = 20_000           # contexts of one anchor that a task takes together
SALTS = 16               # tasks that the occurrences of one context are spread over
BATCH = 20_000           # contexts whose rounds run together (more if a group is larger)
SLICE_BYTES = 1 << 19    # text that is hashed at once
PAD = 0xFF               # never a byte of UTF-8

SECOND = _RNG.integers(0, 2 ** 64, 256, np.uint64)


def _anchors(data: np.ndarray, off: np.ndarray):
    """(text, position, hash, context hash) of the anchors of texts
    data[off[i]:off[i+1]]; off[0] is 0. Positions are within the slice."""
    size = len(data)
    span = L - K + 1
    if size < L:
        return None
    p = prefix(data)
    back = powers(size + 1)[1]
    grams = size - K + 1
    h = mix((p[K:] - p[:grams]) * back[:grams])
    low = np.uint64(0xFFFFFFFF)
    key = (h & ~low) | np.arange(grams, dtype=np.uint64)
    # the least of `span` neighbours, by doubling; the position breaks ties
    width, least = 1, key
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = span - width
    least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
    text_of = np.repeat(np.arange(len(off) - 1), np.diff(off))
    start = np.arange(len(least))
    whole = start + L <= off[1:][text_of[:len(least)]]       # the string ends within its text
    at = np.unique((least[whole] & low).astype(np.int64))
    if not len(at):
        return None
    text = text_of[at]
    lo = np.maximum(at - (L - K), off[:-1][text])
    hi = np.minimum(at + L, off[1:][text])
    q = prefix(data, SECOND)
    shape = ((at - lo) << 10 | (hi - at)).astype(np.uint64)
    c = mix((q[hi] - q[lo]) * back[lo] + mix(shape))
    return text, at, h[at], c


def _anchor_rows(texts: DataFrame, only_hash: bool) -> DataFrame:
    """(h) or (h, c, tid, place) of every anchor of `texts` (tid, text);
    place is the text's length << 32 | position."""
    names = ["h"] if only_hash else ["h", "c", "tid", "place"]

    def run(batches):
        for b in batches:
            data, off = strings(b.column(1))
            tid = b.column(0).to_numpy(zero_copy_only=False)
            for i, j in slices(off, SLICE_BYTES):
                o = off[i:j + 1] - off[i]
                found = _anchors(data[off[i]:off[j]], o)
                if found is None:
                    continue
                text, at, h, c = found
                cols = [h.view(np.int64)]
                if not only_hash:
                    place = np.diff(o)[text] << 32 | (at - o[text])
                    cols += [c.view(np.int64), tid[i:j][text], place]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], names=names)
    return texts.mapInArrow(run, T.StructType([T.StructField(n, T.LongType()) for n in names]))


def column_rounds(m: np.ndarray, length: int = L) -> np.ndarray:
    """Which windows of `length` bytes occur in another row of the aligned
    strings m (rows, columns), PAD where a row has no byte: a boolean for
    each row and window start.

    One round a column, from the last: the rows stay sorted by their
    suffixes from that column on, `common` holds the common prefix of each
    row with the one before it in that order, cut off at `length`."""
    rows, columns = m.shape
    out = np.zeros((rows, columns - length + 1), bool)
    order = np.arange(rows)
    common = np.zeros(rows, np.uint8 if length < 256 else np.int32)
    levels = max(1, int(rows).bit_length())
    table = np.empty((levels, rows), common.dtype)
    log = np.zeros(rows + 1, np.int64)
    log[2:] = np.floor(np.log2(np.arange(2, rows + 1))).astype(np.int64)
    by_column = np.ascontiguousarray(m.T)
    for j in range(columns - 1, -1, -1):
        symbol = by_column[j][order]
        step = np.argsort(symbol, kind="stable")
        # least common prefix between the old ranks of new neighbours
        table[0] = common
        for lv in range(1, levels):
            half = 1 << (lv - 1)
            table[lv] = table[lv - 1]
            np.minimum(table[lv - 1][:-half], table[lv - 1][half:], out=table[lv][:-half])
        a, b = step[:-1] + 1, step[1:]
        new = symbol[step]
        same = (new[1:] == new[:-1]) & (new[1:] != PAD)
        a, b = a[same], b[same]
        lv = log[b - a + 1]
        least = np.minimum(table[lv, a], table[lv, b - (1 << lv) + 1])
        common = np.zeros(rows, common.dtype)
        common[1:][same] = np.minimum(least, length - 1) + 1
        order = order[step]
        if j <= columns - length:
            full = common == length
            hit = full.copy()
            hit[:-1] |= full[1:]
            out[order[hit], j] = True
    return out


def _runs(flags: np.ndarray):
    """(row, first, last) of the runs of True in each row."""
    wide = np.zeros((flags.shape[0], flags.shape[1] + 2), np.int8)
    wide[:, 1:-1] = flags
    d = np.diff(wide, axis=1)
    row, first = np.nonzero(d == 1)
    _, last = np.nonzero(d == -1)
    return row, first, last - 1


_SPAN = T.StructType([T.StructField(n, T.LongType()) for n in ("tid", "size", "begin", "end")])


def _span_batch(tid, size, begin, end):
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (tid, size, begin, end)],
                                      names=["tid", "size", "begin", "end"])


def _compare(contexts: DataFrame) -> DataFrame:
    """(tid, size, begin, end): the repeated stretches of the contexts that
    occur once. `contexts`: (h, tid, place, n, context), groups bounded."""
    def close(parts):
        t = pa.Table.from_batches(parts)
        data, off = strings(t.column("context"))
        place = t.column("place").to_numpy()
        pos, size = place & 0xFFFFFFFF, place >> 32
        before = np.minimum(pos, L - K)
        m = np.full((len(pos), 2 * L - K), PAD, np.uint8)
        length = np.diff(off)
        row = np.repeat(np.arange(len(pos)), length)
        col = np.arange(len(row)) - (off[:-1] - off[0])[row] + (L - K - before)[row]
        m[row, col] = data[off[0]:off[-1]]
        flags = column_rounds(m)
        flags[t.column("n").to_numpy() > 1] = False          # settled before
        r, first, last = _runs(flags)
        begin = pos[r] - (L - K) + first
        return _span_batch(t.column("tid").to_numpy()[r], size[r], begin, pos[r] - (L - K) + last + L)

    def run(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            h = b.column(0).to_numpy()
            cut = int(np.searchsorted(h == h[-1], True)) if len(h) else 0
            # rows are sorted by h: all but the last group are complete
            if cut and sum(map(len, held)) + cut >= BATCH:
                yield close([*held, b.slice(0, cut)])
                held = [b.slice(cut)]
            else:
                if held and len(h) and sum(map(len, held)) >= BATCH and held[-1].column(0)[-1].as_py() != h[0]:
                    yield close(held)
                    held = []
                held.append(b)
        if held and sum(map(len, held)):
            yield close(held)

    src = (contexts.select("h", "tid", "place", "n", "context")
                   .repartition(tasks_for(contexts.sparkSession), "h").sortWithinPartitions("h"))
    return src.mapInArrow(run, _SPAN)


def _count_windows(contexts: DataFrame) -> DataFrame:
    """The same for the contexts of very large groups: each window of L bytes
    is a row (group, 128-bit digest), counted with partial sums."""
    def run(batches):
        for b in batches:
            out = ([], [], [], [], [], [])
            for h, tid, place, n, ctx in zip(*(b.column(i).to_pylist() for i in range(5))):
                pos, size = place & 0xFFFFFFFF, place >> 32
                begin = pos - min(pos, L - K)
                for s in range(len(ctx) - L + 1):
                    d = hashlib.blake2b(ctx[s:s + L], digest_size=16).digest()
                    # the place within the anchor's frame keeps windows aligned
                    for o, v in zip(out, (h, begin + s - pos, d, tid, place, begin + s)):
                        o.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(o, pa.binary() if i == 2 else pa.int64()) for i, o in enumerate(out)],
                names=["h", "shift", "digest", "tid", "place", "begin"])

    rows = contexts.select("h", "tid", "place", "n", "context").mapInArrow(
        run, "h long, shift long, digest binary, tid long, place long, begin long")
    many = rows.groupBy("h", "shift", "digest").count().where("count > 1").drop("count")
    return rows.join(many, ["h", "shift", "digest"]).select(
        "tid", (F.shiftright("place", 32)).alias("size"), "begin", (F.col("begin") + L).alias("end"))


def repeated_spans(docs: DataFrame, text_col: str = "text", group: int = GROUP) -> DataFrame:
    """(tid, size, begins, ends): for each text with repeated strings the byte
    ranges they cover (they may overlap). A text is known by its 64-bit hash
    `tid` and its length."""
    spark = docs.sparkSession
    texts = (docs.select(F.xxhash64(text_col).alias("tid"), F.col(text_col).alias("text"))
                 .where(F.octet_length("text") >= L))
    # written, so that the join below has an exchange on either side and Spark
    # can split the hash of a very common passage
    known = written(_anchor_rows(texts, True).groupBy("h").count().where("count > 1").select("h"), "known")
    rows = written(_anchor_rows(texts, False).join(known.hint("merge"), "h"), "anchors")
    settled, kinds = _kinds(rows)
    groups = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    pos, size = F.col("place").bitwiseAND(0xFFFFFFFF), F.shiftright("place", 32)
    whole = settled.select("tid", size.alias("size"), F.greatest(pos - (L - K), F.lit(0)).alias("begin"),
                           F.least(pos + L, size).alias("end")).distinct()
    # contexts to compare: of anchors with several kinds, one of them unique
    open_ = (kinds.join(groups.where("kinds > 1 and least = 1"), "h")
                  .select("h", "n", "kinds", "tid", "place"))
    per_text = (open_.groupBy("tid", F.shiftright("place", 32).alias("size"))
                     .agg(F.collect_list(F.struct("h", "n", "kinds", "place")).alias("open")))
    # one copy of a text is enough, whichever row has it
    fetched = (texts.select("tid", F.octet_length("text").cast("long").alias("size"), "text")
                    .join(per_text.hint("merge"), ["tid", "size"]))
    contexts = written(_cut_contexts(fetched).dropDuplicates(["h", "tid", "place"]), "open")
    spans = whole.unionByName(_compare(contexts.where(F.col("kinds") <= group)))
    large = contexts.where(F.col("kinds") > group)
    if not large.isEmpty():
        spans = spans.unionByName(_count_windows(large))
    # written: the join with the documents then has an exchange on either side,
    # and Spark can split the key of a text with very many copies
    return written(spans.groupBy("tid", "size").agg(
        F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends")), "spans")


def _kinds(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(occurrences of contexts that occur twice or more; one row (h, c, n, tid,
    place) of each context, n its number of occurrences).

    Occurrences are counted by windows over (h, c, salt), so a very common
    context is spread over SALTS tasks, and then over (h, c), where at most two
    rows a salt are left."""
    # dealt by row number, since copies of a text have equal ids and places
    salted = rows.withColumn("salt", F.monotonically_increasing_id() % SALTS)
    near = Window.partitionBy("h", "c", "salt")
    one = written(salted.withColumn("n", F.count(F.lit(1)).over(near))
                        .withColumn("at", F.row_number().over(near.orderBy("tid", "place"))), "salted")
    both = Window.partitionBy("h", "c")
    left = written(one.where("at = 1").withColumn("all", F.sum("n").over(both))
                      .withColumn("first", F.row_number().over(both.orderBy("tid", "place"))), "contexts")
    names = ["h", "c", "tid", "place"]
    settled = one.where("n > 1").select(*names).unionByName(left.where("n = 1 and all > 1").select(*names))
    return settled, left.where("first = 1").select("h", "c", F.col("all").alias("n"), "tid", "place")


def _cut_contexts(fetched: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            data, off = strings(b.column("text"))
            lists = b.column("open")
            n = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            row = np.repeat(np.arange(b.num_rows), n)
            place = flat.field("place").to_numpy()
            pos = place & 0xFFFFFFFF
            lo = off[row] + np.maximum(pos - (L - K), 0)
            hi = np.minimum(off[row] + pos + L, off[row + 1])
            for i in range(0, len(row), 20_000):
                part = slice(i, i + 20_000)
                length = (hi - lo)[part]
                ends = np.cumsum(length)
                src = np.arange(int(ends[-1])) + np.repeat(lo[part] - np.r_[0, ends[:-1]], length)
                ctx = pa.Array.from_buffers(pa.binary(), len(length), [
                    None, pa.py_buffer(np.r_[0, ends].astype(np.int32).tobytes()),
                    pa.py_buffer(data[src].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [flat.field("h")[part], b.column("tid").take(pa.array(row[part])),
                     flat.field("place")[part], flat.field("n")[part], flat.field("kinds")[part], ctx],
                    names=["h", "tid", "place", "n", "kinds", "context"])
    return fetched.select("tid", "text", "open").mapInArrow(
        run, "h long, tid long, place long, n long, kinds long, context binary")


def merged(begins, ends) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching ranges."""
    if not begins:
        return []
    out = []
    for s, e in sorted(zip(begins, ends)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def keep_bytes(data: bytes, spans) -> bytes:
    """`data` without its spans."""
    parts, at = [], 0
    for s, e in spans:
        parts.append(data[at:s])
        at = e
    parts.append(data[at:])
    return b"".join(parts)


def to_characters(data: bytes, spans):
    """The spans cut back to whole UTF-8 characters."""
    for s, e in spans:
        while s < e and data[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(data) and data[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            yield s, e


def _with_spans(docs: DataFrame, text_col: str) -> DataFrame:
    found = repeated_spans(docs, text_col).select(
        F.col("tid").alias("_tid"), F.col("size").alias("_size"), F.col("begins").alias("_begins"),
        F.col("ends").alias("_ends"))
    keyed = (docs.withColumn("_tid", F.xxhash64(text_col))
                 .withColumn("_size", F.octet_length(text_col).cast("long")))
    return keyed.join(found.hint("merge"), ["_tid", "_size"], "left").drop("_tid", "_size")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    src = _with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")

    def run(batches):
        for b in batches:
            out = ([], [], [], [])
            for t, s, e in zip(*(b.column(c).to_pylist() for c in ("text", "_begins", "_ends"))):
                data = (t or "").encode()
                spans = merged(s, e)
                kept = keep_bytes(data, spans)
                for o, v in zip(out, (len(data), len(data) - len(kept), len(spans),
                                      hashlib.sha256(kept).hexdigest())):
                    o.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(o, pa.int64()) for o in out[:3]), pa.array(out[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return src.mapInArrow(run, T.StructType([
        src.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())]))


def without_repeats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with the repeated strings cut out of its texts, in whole
    characters (a span that begins or ends within one is cut back); null
    texts stay null."""
    own, back = apart(docs, "_tid", "_size", "_begins", "_ends")
    text_col = {v: k for k, v in back.items()}.get(text_col, text_col)
    src = _with_spans(own, text_col)
    schema = T.StructType([f for f in src.schema.fields if f.name not in ("_begins", "_ends")])
    at = src.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = []
            for t, s, e in zip(*(b.column(c).to_pylist() for c in (src_text, "_begins", "_ends"))):
                if t is not None and s:
                    data = t.encode()
                    t = keep_bytes(data, to_characters(data, merged(s, e))).decode()
                texts.append(t)
            cols = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(len(schema))]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)
    src_text = src.columns[at]
    return src.mapInArrow(run, schema).withColumnsRenamed(back).select(*[F.col(f"`{c}`") for c in docs.columns])
