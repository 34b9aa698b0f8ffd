"""Ranked lexical search over a length-stratified index.

A document's normaliser m is a function of its length, so documents of equal m
form a stratum, in which a term's contribution depends on its tf alone:
w * impact(tf, m), impact = (10^9 tf) div (1000 tf + 12 m). The index keeps, a
row a block of a stratum, each term's postings in runs of equal tf, highest
first; an impact is computed once for each (m, tf) of a block, never for each
posting.

A batch of queries is answered in two visits. From the blocks' vocabularies
(term, documents, top tf) come each term's weight and, for each query and
stratum, a bound: the sum over its words
of w * impact(top tf, m). The first visit reads, for each query, blocks of the
strata with the highest bounds until they hold FIRST_DOCS documents; the k-th
best score found is a lower bound of the final one. The second visit reads the
strata whose bound reaches it. Inside a block the same test is made with the
block's own top tf, then with the words in order of what they can add: once
what is left cannot lift any document to the k-th score, the block is done.
Each task carries on its own k best, so it ships k rows a query at most.
Nothing is capped: a skipped stratum, block or word cannot change the answer.

Blocks hold about BLOCK_WORDS words: a stratum with more is split by a hash of
the document, so a third of all documents of one length is many blocks. Queries
are taken in batches of at most BATCH_QUERIES, their words being what a task is
sent; each batch meets all documents, in blocks.

Null and empty texts, and texts without a term, are in no stratum and count
nowhere. Every row is a document of its own, repeated ids included; a null id
sorts first and is returned as null. Every item row is a query of its own; one
without a term has no rows. Ties go by ascending doc_id. Empty tables give no
rows. Long texts are read whole; a block holds one document at least. Only the
named columns are read, so others may have any name.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written

# A term is a run of ASCII letters and digits and of all characters above them.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# The same on UTF-8 bytes: A-Z become a-z, bytes of no term become spaces.
_TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# Words of a block, about (a longer document is a block of its own).
BLOCK_WORDS = 32_768
# Blocks of a row group: a reader holds one at a time, so few.
ROW_GROUP = 8
# Documents in the strata of a query's first visit.
FIRST_DOCS = 2_000
# Queries answered at once, and the UTF-8 bytes of their texts.
BATCH_QUERIES, BATCH_BYTES = 1_000, 1 << 20
# A null id inside a block's array of ids; it sorts before all others.
NO_ID = np.iinfo(np.int64).min


def normaliser(n, docs: int, words: int):
    """m of a document of n terms, in a corpus of `docs` documents and `words` terms."""
    if isinstance(n, Column):
        return (F.lit(75) + F.call_function("div", F.lit(25) * n * F.lit(docs), F.lit(words))).cast("int")
    return 75 + (25 * n * docs) // words


def impact(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TO_TERMS).split() if text else []


def _lengths(batches):
    """Terms of each text, without those of none."""
    for batch in batches:
        n = [len(terms_of(t.as_py())) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([pa.array([x for x in n if x], pa.int64())], ["n"])


def _forward(batches):
    """Texts to (doc_id, n, terms, tfs), without documents of no term: distinct
    terms with a space between, their tf as packed 32-bit integers."""
    for batch in batches:
        rows, size = [], 0
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            words = terms_of(text.as_py())
            if words:
                count = Counter(words)
                rows.append((doc_id.as_py(), len(words), b" ".join(count), np.fromiter(count.values(), "<i4", len(count)).tobytes()))
                size += len(rows[-1][2])
            if size > 1 << 22:
                yield _forward_batch(rows)
                rows, size = [], 0
        if rows:
            yield _forward_batch(rows)


def _forward_batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                      ["doc_id", "n", "terms", "tfs"])


# Arrays are packed, 32 bits a number (ids 64), so that a block crosses between
# the JVM and Python as bytes; terms have a space between.
_BLOCK = ("m int, block int, docs binary, terms binary, counts binary, tops binary, "
          "term_runs binary, run_tf binary, run_ends binary, slots binary")


def _block(key, table):
    """One block: postings by term, within it by descending tf, in runs of equal tf."""
    table = table.combine_chunks()
    ids = table.column("doc_id").combine_chunks().fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
    each = [t.split(b" ") for t in table.column("terms").to_pylist()]
    words = pa.array([w for ws in each for w in ws], pa.binary()).dictionary_encode()
    tf = np.frombuffer(b"".join(table.column("tfs").to_pylist()), "<i4").astype(np.int64)
    code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    slot = np.repeat(np.arange(len(ids)), [len(ws) for ws in each])
    order = np.lexsort((slot, -tf, code))
    code, tf, slot = code[order], tf[order], slot[order]
    new_term = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    new_run = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])])
    packed = {
        "docs": ids.astype("<i8"), "terms": b" ".join(words.dictionary.to_pylist()),
        "counts": np.diff(np.r_[new_term, len(code)]), "tops": tf[new_term],
        "term_runs": np.searchsorted(new_run, np.r_[new_term[1:], len(code)]),
        "run_tf": tf[new_run], "run_ends": np.r_[new_run[1:], len(code)], "slots": slot}
    return pa.table({"m": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32())} | {
        k: pa.array([v if k == "terms" else (v if k == "docs" else v.astype("<i4")).tobytes()], pa.binary()) for k, v in packed.items()})


def _ints(batch, name: str, i: int, kind: str = "<i4") -> np.ndarray:
    return np.frombuffer(batch.column(name)[i].as_buffer(), kind)


def _terms(batch, i: int) -> pa.Array:
    return pa.array(batch.column("terms")[i].as_py().split(b" "), pa.binary())


class StratifiedIndex:
    """blocks and strata (m, docs, blocks), written to the shared folder; n_docs
    and n_words of the corpus."""

    def __init__(self, blocks: DataFrame, strata: DataFrame, n_docs: int, n_words: int):
        self.blocks, self.strata, self.n_docs, self.n_words = blocks, strata, n_docs, n_words

    @classmethod
    def build(cls, docs: DataFrame) -> "StratifiedIndex":
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        # lengths first: m depends on those of all documents
        lengths = written(docs.select("text").mapInArrow(_lengths, "n long").groupBy("n").agg(F.count(F.lit(1)).alias("docs")), "ranked-lengths")
        total = lengths.agg(F.sum("docs"), F.sum(F.col("n") * F.col("docs"))).first()
        n_docs, n_words = total[0] or 0, total[1] or 1
        m = normaliser(F.col("n"), n_docs, n_words)
        strata = written(lengths.groupBy(m.alias("m")).agg(F.sum("docs").alias("docs"), F.ceil(
            F.sum(F.col("n") * F.col("docs")) / BLOCK_WORDS).cast("int").alias("blocks")), "ranked-strata")
        forward = docs.mapInArrow(_forward, "doc_id long, n long, terms binary, tfs binary")
        # a null id would hash alike in all rows, so its terms are hashed
        spread = F.when(F.col("doc_id").isNull(), F.xxhash64("terms")).otherwise(F.xxhash64("doc_id"))
        rows = forward.withColumn("m", m).join(strata.select("m", "blocks"), "m")
        blocks = written(rows.select("m", F.pmod(spread, F.col("blocks")).cast("int").alias("block"), "doc_id", "terms", "tfs")
                             .groupBy("m", "block").applyInArrow(_block, _BLOCK), "ranked-blocks",
                         **{"parquet.block.row.count.limit": ROW_GROUP})
        return cls(blocks, strata, n_docs, n_words)

    def known(self, words: list[str]) -> DataFrame:
        """(term, m, docs, top tf) of the words, from the blocks' vocabularies."""
        def found(batches):
            terms = pa.array([w.encode() for w in words], pa.binary())
            for batch in batches:
                for i in range(batch.num_rows):
                    code = pc.index_in(terms, value_set=_terms(batch, i))
                    here = code.is_valid()
                    code = code.filter(here).to_numpy()
                    yield pa.RecordBatch.from_arrays([
                        terms.filter(here).cast(pa.string()), pa.array([batch.column("m")[i].as_py()] * len(code), pa.int32()),
                        pa.array(_ints(batch, "counts", i)[code]), pa.array(_ints(batch, "tops", i)[code])], ["term", "m", "docs", "top"])

        rows = self.blocks.select("m", "terms", "counts", "tops").mapInArrow(found, "term string, m int, docs int, top int")
        return rows.groupBy("term", "m").agg(F.sum("docs").alias("docs"), F.max("top").alias("top"))


def _visit(queries: dict[int, tuple[list[str], list[int]]], least: dict[int, int], wanted, k: int):
    """A task's part of a visit: (q, doc_id, score) of its own k best of each query.

    queries: words and weights (times repeats); least: score that counts;
    wanted: (m, block) -> queries, or None where rows name theirs in `qs`.
    """
    vocabulary = sorted({w for words, _ in queries.values() for w in words})
    at = {w: i for i, w in enumerate(vocabulary)}
    plan = {q: (np.array([at[w] for w in words]), np.array(ws, np.float64)) for q, (words, ws) in queries.items()}

    def run(batches):
        terms = pa.array([w.encode() for w in vocabulary], pa.binary())
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        floor = dict(least)

        def block(m, qs, ids, own_terms, term_runs, run_tf, run_ends, slots):
            code = pc.index_in(terms, value_set=own_terms).fill_null(-1).to_numpy(zero_copy_only=False)
            first_run = np.r_[0, term_runs[:-1]]
            # once for each run of equal tf
            worth = impact(run_tf.astype(np.int64), m).astype(np.float64)
            run_starts = np.r_[0, run_ends[:-1]]
            top, low, high = worth[first_run], run_starts[first_run], run_ends[term_runs - 1]
            each = np.repeat(worth, run_ends - run_starts)

            def added(which, ws):
                """What these terms give each document, exact in a double."""
                spans = list(zip(low[which].tolist(), high[which].tolist()))
                return np.bincount(np.concatenate([slots[a:b] for a, b in spans]), minlength=len(ids), weights=np.concatenate(
                    [each[a:b] for a, b in spans]) * np.repeat(ws, [b - a for a, b in spans]))

            for q in qs:
                mine, ws = plan[q]
                here = code[mine]
                ws, here = ws[here >= 0], here[here >= 0]
                most = ws * top[here]
                need = max(floor[q], 1)
                if most.sum() < need:
                    continue
                order = np.argsort(-most)
                here, ws = here[order], ws[order]
                left = most.sum() - np.cumsum(most[order])
                # the terms without which no document gets there, then the others
                lead = min(int(np.searchsorted(-left, -need, side="right")) + 1, len(here))
                score = added(here[:lead], ws[:lead])
                if lead < len(here):
                    if score.max() + left[lead - 1] < need:
                        continue
                    score += added(here[lead:], ws[lead:])
                hit = np.flatnonzero(score >= need)
                if not len(hit):
                    continue
                s, d = score[hit].astype(np.int64), ids[hit]
                if q in best:
                    s, d = np.r_[best[q][0], s], np.r_[best[q][1], d]
                keep = np.lexsort((d, -s))[:k]
                best[q] = s[keep], d[keep]
                if len(keep) == k:
                    floor[q] = max(floor[q], int(s[keep[-1]]))

        for batch in batches:
            for i in range(batch.num_rows):
                m = batch.column("m")[i].as_py()
                qs = batch.column("qs")[i].as_py() if wanted is None else wanted.get((m, batch.column("block")[i].as_py()), ())
                if len(qs):
                    block(m, qs, _ints(batch, "docs", i, "<i8"), _terms(batch, i),
                          *(_ints(batch, c, i) for c in ("term_runs", "run_tf", "run_ends", "slots")))
        if best:
            q = np.concatenate([np.full(len(s), x, np.int64) for x, (s, _) in best.items()])
            ids = np.concatenate([d for _, d in best.values()])
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids, mask=ids == NO_ID),
                                              pa.array(np.concatenate([s for s, _ in best.values()]))], ["q", "doc_id", "score"])

    return run


_FOUND = "q long, doc_id long, score long"


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.desc("score"), F.asc("doc_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _batch(index: StratifiedIndex, texts: list[str | None], k: int) -> DataFrame:
    """(q, rank, doc_id, score) for a batch of queries, numbered from 0."""
    spark = index.blocks.sparkSession
    words = [(q, w.decode(), c) for q, t in enumerate(texts) for w, c in Counter(terms_of(t)).items()]
    # bounded by the batch: its words, then words x strata
    known = written(index.known(sorted({w for _, w, _ in words})), "ranked-words")
    df = {r["term"]: r["df"] for r in known.groupBy("term").agg(F.sum("docs").alias("df")).collect()}
    queries: dict[int, tuple[list[str], list[int]]] = {}
    for q, w, c in words:
        if w in df and (x := weight(index.n_docs, df[w])) > 0:
            names, ws = queries.setdefault(q, ([], []))
            names.append(w)
            ws.append(c * x)
    if not queries:
        return spark.createDataFrame([], f"{_FOUND}, rank int")
    weights = spark.createDataFrame([(q, w, x) for q, (names, ws) in queries.items() for w, x in zip(names, ws)],
                                    "q int, term string, w long")
    top = F.col("top").cast("long")
    each = F.col("w") * F.call_function("div", F.lit(1_000_000_000) * top, 1000 * top + 12 * F.col("m"))
    bounds = written(known.join(F.broadcast(weights), "term").groupBy("q", "m").agg(F.sum(each).alias("bound"))
                          .join(index.strata, "m"), "ranked-bounds")

    # first visit: strata in order of their bounds
    before = Window.partitionBy("q").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)
    first = (bounds.withColumn("seen", F.coalesce(F.sum("docs").over(before), F.lit(0))).where(F.col("seen") < FIRST_DOCS)
                   .withColumn("n", F.least("blocks", F.ceil((FIRST_DOCS - F.col("seen")) * F.col("blocks") / F.col("docs")).cast("int"))))
    wanted: dict[tuple[int, int], list[int]] = {}
    for r in first.select("q", "m", "n").collect():
        for b in range(r["n"]):
            wanted.setdefault((r["m"], b), []).append(r["q"])
    least = {q: 1 for q in queries}
    places = spark.createDataFrame(sorted(wanted), "m int, block int")
    near = index.blocks.where(F.col("m").isin(sorted({m for m, _ in wanted}))).join(F.broadcast(places), ["m", "block"], "left_semi")
    for r in _best(near.drop("counts", "tops").mapInArrow(_visit(queries, least, wanted, k), _FOUND), k).where(F.col("rank") == k).collect():
        least[r["q"]] = r["score"]

    # second visit: the strata whose bound reaches the k-th score
    reach = spark.createDataFrame(list(least.items()), "q int, least long")
    open_ = written(bounds.join(F.broadcast(reach), "q").where("bound >= least")
                          .groupBy("m").agg(F.collect_list(F.col("q")).alias("qs")), "ranked-visits")
    rows = index.blocks.drop("counts", "tops").join(F.broadcast(open_), "m")
    return written(_best(rows.mapInArrow(_visit(queries, least, None, k), _FOUND), k), "ranked-best")


def _batches(items: DataFrame):
    """Lists of (item_id, text) of bounded size."""
    batch, size = [], 0
    for r in items.select("item_id", "text").toLocalIterator():
        n = len((r["text"] or "").encode())
        if batch and (len(batch) == BATCH_QUERIES or size + n > BATCH_BYTES):
            yield batch
            batch, size = [], 0
        batch.append((r["item_id"], r["text"]))
        size += n
    if batch:
        yield batch


def search(index: StratifiedIndex, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    spark = items.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for batch in _batches(items):
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(batch)], f"q long, item_id {kind}")
        best = _batch(index, [t for _, t in batch], k)
        out = out.unionByName(best.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score"))
    return out


def top_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """Index the documents and search it for every item."""
    return search(StratifiedIndex.build(docs), items, k)


ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '{TERM}') AS l FROM documents),
d AS (SELECT r, doc_id, l, len(l)::BIGINT AS n FROM t WHERE len(l) > 0),
c AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nw FROM d),
tf AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, n, unnest(l) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, c),
q AS (SELECT item_id, term, count(*)::BIGINT AS qtf FROM (SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, r, doc_id, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // nw))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term), c GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 20
"""
