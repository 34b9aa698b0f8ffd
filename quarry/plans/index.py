"""The index: corpus + term table + per-commit vocabulary and statistics.

`Index.build` writes the tables to a path (by default in the shared
checkpoint folder), so every later search reads parquet with pushdown instead
of re-tokenising, and a lost executor recomputes from files, not lineage:

    meta     schema and id column, as JSON
    corpus/  partitioned by commit_id, clustered on the id
    terms/   partitioned by commit_id, field; range-clustered on (term, doc_id)
    vocab/   partitioned by commit_id, field; sorted on term
    values/  partitioned by commit_id, field; range-clustered on the value
    near/    (if asked for) partitioned by commit_id, field; range-clustered on
             the deletion key: a fuzzy search's candidate terms
    pairs/   (if asked for) partitioned by commit_id, field; range-clustered on
             (w1, w2, doc_id): where two common words stand together
    tops/    partitioned by commit_id, field: the most a frequent term adds to
             a document of each block of ids
    stats/   one row per (commit_id, field)
    commits/ an empty marker per commit, written last

A commit counts once its marker is there: a reader lists the markers when it
opens the index and reads only those partitions, so it sees a commit's
tables or none of them. What a broken write left is removed before its id is
written again; a finished id is refused (a stream replaces its own).

Range clustering on (term, doc_id) rather than term alone lets a very
frequent term spread over many files instead of one.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import analysis
from quarry.operators.chunks import near_rows
from quarry.schema import Schema, SearchError
from quarry.session import exists, get_text, names, put_text, remove, scratch_path
from quarry.sources.corpus import COMMIT_COL, check_ids, ingest

# Target bytes of input per written partition. The term table holds
# positions and is larger than its input, hence the factor. A task sorts the
# exploded tokens of its documents, some fifty times their compressed bytes:
# at four times this it spills, and a larger input all the more.
TARGET_PARTITION_BYTES = 24 * 1024 * 1024
TERMS_PER_INPUT = 2
# Texts and postings take about a quarter less of it than of the default, for some more CPU time.
CODEC = "zstd"
# Rows of a page of the value table: a range reads whole pages.
VALUE_PAGE_ROWS = 1000
# Ranges of a batch's ids in which earlier commits are searched for them.
PUSHED_RANGES = 200
# The same for the neighbourhoods, of which a search asks a few hundred keys.
NEAR_PAGE_ROWS = 1000
TABLES = ("corpus", "terms", "vocab", "values", "near", "pairs", "tops", "stats")
# Rows of a page of the term table, of which a search for few blocks reads few.
TERM_PAGE_ROWS = 2000


def _write_partitions(spark: SparkSession, df: DataFrame) -> int:
    """Output partitions for one commit: TERMS_PER_INPUT per TARGET_PARTITION_BYTES of input (the scanned
    relations' sizes; a join's own estimate, without table statistics, can
    be the product of its sides), the default parallelism at least. A source
    whose size Spark does not know counts as the session's shuffle setting."""
    unknown = int(spark.conf.get("spark.sql.defaultSizeInBytes").rstrip("bB"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    size, least = 0, spark.sparkContext.defaultParallelism
    while leaves.hasNext():
        n = int(str(leaves.next().stats().sizeInBytes()))
        if n < unknown:
            size += n
        else:
            least = max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(least, -(-TERMS_PER_INPUT * size // TARGET_PARTITION_BYTES))


def _schemas(schema: Schema, id_col: str, id_type: T.DataType) -> dict[str, T.StructType]:
    """The declared schemas of the tables: reads need no inference, and
    every commit has the same types."""
    commit, field = T.StructField(COMMIT_COL, T.LongType()), T.StructField("field", T.StringType())
    term = T.StructField("term", T.StringType())
    block = T.StructField(analysis.BLOCK_COL, T.LongType())
    fields = [T.StructField(f.name, f.spark_type()) for f in schema.fields if f.name != id_col]
    return {
        "corpus": T.StructType([T.StructField(id_col, id_type), *fields, block, commit]),
        "terms": T.StructType([term, T.StructField("doc_id", id_type), T.StructField("dl", T.IntegerType()), block,
                               T.StructField("tf", T.IntegerType()),
                               T.StructField("positions", T.ArrayType(T.IntegerType())), commit, field]),
        "vocab": T.StructType([term, T.StructField("df", T.LongType()), T.StructField("cf", T.LongType()),
                               commit, field]),
        "values": T.StructType([T.StructField("dec", T.DecimalType(20, 0)), T.StructField("long", T.LongType()),
                                T.StructField("dbl", T.DoubleType()), T.StructField("doc_id", id_type), commit, field]),
        "near": T.StructType([T.StructField("key", T.StringType()), T.StructField("n", T.IntegerType()), term, commit, field]),
        "pairs": T.StructType([T.StructField("doc_id", id_type), T.StructField("w1", T.StringType()), T.StructField("w2", T.StringType()),
                               T.StructField("dl", T.IntegerType()), T.StructField("positions", T.ArrayType(T.IntegerType())), commit, field]),
        "tops": T.StructType([term, block, T.StructField("top", T.DoubleType()), commit, field]),
        "stats": T.StructType([field, T.StructField("n_docs", T.LongType()),
                               T.StructField("total_len", T.LongType()), commit]),
    }


class Index:
    """A searchable view: corpus rows and the tables derived from them.

    `commit` pins the view to a snapshot (`None` = everything committed when
    the index was opened).
    """

    def __init__(self, spark: SparkSession, schema: Schema, corpus: DataFrame,
                 terms: DataFrame, vocab: DataFrame, values: DataFrame, near: DataFrame | None, pairs: DataFrame | None,
                 tops: DataFrame | None, stats: DataFrame,
                 id_col: str = "doc_id", path: str | None = None,
                 commit: int | None = None, commits: tuple[int, ...] | None = None):
        self.spark, self.schema, self.id_col = spark, schema, id_col
        self._corpus, self._terms, self._vocab = corpus, terms, vocab
        self._values, self._near, self._pairs, self._tops, self._stats = values, near, pairs, tops, stats
        self.path, self.commit, self.commits = path, commit, commits
        self._stat_rows = None

    @property
    def id_type(self) -> str:
        return self._corpus.schema[self.id_col].dataType.simpleString()

    # ---------------------------------------------------------------- build
    @classmethod
    def from_corpus(cls, df: DataFrame, schema: Schema, id_col: str = "doc_id") -> "Index":
        """A lazy index: nothing written, every search re-derives the tables."""
        corpus = ingest(df, schema, id_col)
        if COMMIT_COL not in corpus.columns:
            corpus = corpus.withColumn(COMMIT_COL, F.lit(0).cast("long"))
        fields = schema.text_fields()
        terms = analysis.term_table(corpus, fields, id_col, analyzers=schema.analyzers())
        return cls(df.sparkSession, schema, corpus, terms,
                   analysis.commit_vocabulary(terms),
                   analysis.value_table(corpus, schema.value_fields(), id_col), None, None, None,
                   analysis.commit_stats(corpus, terms, fields), id_col)

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: Schema, id_col: str, id_type: T.DataType,
               near: bool = False, pairs: bool = False) -> None:
        """An index without commits. With `near` every commit also writes the
        deletion neighbourhoods of its vocabulary, for fuzzy searches; with
        `pairs` the places where two common words stand together, for phrases."""
        if exists(spark, path + "/meta"):
            raise SearchError(f"Index already exists at '{path}'")
        put_text(spark, path + "/meta", json.dumps({"id_col": id_col, "id_type": id_type.json(), "near": near, "pairs": pairs,
                                                     "schema": schema.validate().to_json()}))

    @classmethod
    def build(cls, df: DataFrame, schema: Schema, id_col: str = "doc_id",
              path: str | None = None, commit_id: int = 0, partitions: int | None = None,
              near: bool = False, pairs: bool = False) -> "Index":
        """Ingest `df` as the first commit and write all index tables."""
        spark = df.sparkSession
        path = path or scratch_path(spark, "index")
        corpus = ingest(df, schema, id_col)
        cls.create(spark, path, schema, id_col, corpus.schema[id_col].dataType, near, pairs)
        cls._write_commit(spark, corpus, schema, id_col, path, commit_id, partitions)
        return cls.open(spark, path)

    @classmethod
    def _write_commit(cls, spark, corpus: DataFrame, schema: Schema, id_col: str, path: str, commit_id: int,
                      partitions: int | None = None, replace: bool = False) -> None:
        """Write one commit: corpus rows, then the tables derived from them,
        then the marker.

        Ids are checked on the written rows (the marker is what counts): they
        must be unique in the batch, and no earlier commit may have them. The
        texts are tokenised where the written corpus is read, and their words
        dealt by chunks of documents; vocabulary and statistics are read off
        the written term table."""
        commit_id = int(commit_id)
        done = [int(c) for c in names(spark, path + "/commits")]
        if commit_id in done and not replace:
            raise SearchError(f"Commit {commit_id} already exists at '{path}'")
        marker = f"{path}/commits/{commit_id}"
        remove(spark, marker)
        for t in TABLES:
            remove(spark, f"{path}/{t}/{COMMIT_COL}={commit_id}")
        n = partitions or _write_partitions(spark, corpus)
        fields = schema.text_fields()
        schemas = _schemas(schema, id_col, corpus.schema[id_col].dataType)

        def folder(table):
            return f"{path}/{table}/{COMMIT_COL}={commit_id}"

        def written(table):
            # files of this commit, with the commit as a column again
            kept = T.StructType([f for f in schemas[table].fields if f.name != COMMIT_COL])
            return (spark.read.schema(kept).parquet(folder(table))
                         .withColumn(COMMIT_COL, F.lit(commit_id).cast("long")))

        # corpus: clustered on the id so that a hit lookup by id skips files
        # (its rows are numbered in that order; the number's high bits count partitions)
        (corpus.drop(COMMIT_COL).repartitionByRange(n, F.col(f"`{id_col}`")).sortWithinPartitions(F.col(f"`{id_col}`"))
               .withColumn(analysis.BLOCK_COL, F.floor(F.monotonically_increasing_id() / analysis.BLOCK_DOCS))
               .write.option("compression", CODEC).parquet(folder("corpus")))
        batch = written("corpus")
        try:
            check_ids(batch, id_col)
            others = [c for c in done if c != commit_id]
            if others:
                earlier = cls._ids_near(Index.open(spark, path).corpus.where(F.col(COMMIT_COL).isin(others)), batch, id_col)
                if not batch.select(F.col(f"`{id_col}`")).join(earlier, id_col, "left_semi").isEmpty():
                    raise SearchError(f"Document id '{id_col}' must be unique: an id of commit {commit_id} is indexed already")
        except SearchError:
            remove(spark, folder("corpus"))
            raise
        (analysis.dealt_terms(batch.drop(COMMIT_COL), fields, id_col, n, schema.analyzers())
                 .write.option("compression", CODEC).option("parquet.page.row.count.limit", TERM_PAGE_ROWS).partitionBy("field").parquet(folder("terms")))
        terms = written("terms")
        # fields as partition folders need a row to exist; an empty commit has none
        (analysis.commit_vocabulary(terms).drop(COMMIT_COL)
                 .repartitionByRange(n, "field", "term").sortWithinPartitions("field", "term")
                 .write.option("compression", CODEC).partitionBy("field").parquet(folder("vocab")))
        meta = json.loads(get_text(spark, path + "/meta"))
        if meta.get("near"):
            (near_rows(written("vocab"), n)
                     .write.option("compression", CODEC).option("parquet.page.row.count.limit", NEAR_PAGE_ROWS).partitionBy("field").parquet(folder("near")))
        # values: a range or an equality reads its own files and pages only
        place = ["field", *analysis.VALUE_TYPES, "doc_id"]
        (analysis.value_table(batch.drop(COMMIT_COL), schema.value_fields(), id_col)
                 .repartitionByRange(n, *place).sortWithinPartitions(*place)
                 .write.option("compression", CODEC).option("parquet.page.row.count.limit", VALUE_PAGE_ROWS).partitionBy("field").parquet(folder("values")))
        (analysis.commit_stats(batch, terms, fields).drop(COMMIT_COL).coalesce(1)
                 .write.parquet(folder("stats")))
        if meta.get("pairs"):
            common = cls._common(written("vocab"), written("stats"))
            (analysis.pair_table(batch.drop(COMMIT_COL), common, fields, id_col, n, schema.analyzers())
                     .write.option("compression", CODEC).option("parquet.page.row.count.limit", TERM_PAGE_ROWS).partitionBy("field").parquet(folder("pairs")))
        own = written("stats").collect()
        means = {r["field"]: r["total_len"] / max(r["n_docs"], 1) for r in own}
        (analysis.block_tops(terms, written("vocab"), means, max([r["n_docs"] for r in own], default=0))
                 .repartitionByRange(n, "field", "term", analysis.BLOCK_COL).sortWithinPartitions("field", "term", analysis.BLOCK_COL)
                 .write.option("compression", CODEC).partitionBy("field").parquet(folder("tops")))
        put_text(spark, marker)

    @staticmethod
    def _ids_near(corpus: DataFrame, batch: DataFrame, id_col: str) -> DataFrame:
        """The ids of `corpus` that can be among those of a written batch: both
        are clustered on the id, so each file of the batch spans a range of
        ids, and the ranges (at most PUSHED_RANGES) are pushed to the scan. A
        batch of new, higher ids reads next to nothing of the earlier ones."""
        own = F.col(f"`{id_col}`")
        spans = (batch.groupBy(F.input_file_name().alias("file")).agg(F.min(own).alias("lo"), F.max(own).alias("hi"))
                      .withColumn("part", F.ntile(PUSHED_RANGES).over(Window.orderBy("lo")))
                      .groupBy("part").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect())
        near = reduce(lambda x, y: x | y, [own.between(r["lo"], r["hi"]) for r in spans], F.lit(False))
        return corpus.where(near).select(own)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "Index":
        """Open a written index: schema and id column are stored with it."""
        if not exists(spark, path + "/meta"):
            raise SearchError(f"Index not found at '{path}'")
        meta = json.loads(get_text(spark, path + "/meta"))
        schema, id_col = Schema.from_json(meta["schema"]), meta["id_col"]
        schemas = _schemas(schema, id_col, T._parse_datatype_json_string(meta["id_type"]))
        commits = tuple(sorted(int(c) for c in names(spark, path + "/commits")))

        def read(table):
            if table in ("near", "pairs") and not meta.get(table):
                return None
            if not commits:
                return spark.createDataFrame([], schemas[table])
            df = spark.read.schema(schemas[table]).parquet(f"{path}/{table}")
            return df.where(F.col(COMMIT_COL).isin(list(commits)))

        return cls(spark, schema, *(read(t) for t in TABLES), id_col, path, None, commits)

    def append(self, df: DataFrame, commit_id: int) -> "Index":
        """Write one more batch as commit `commit_id` and reopen (A3)."""
        if self.path is None:
            raise SearchError("append needs a written index (Index.build)")
        corpus = ingest(df, self.schema, self.id_col)
        self._write_commit(self.spark, corpus, self.schema, self.id_col, self.path, commit_id)
        return Index.open(self.spark, self.path)

    def drop(self) -> None:
        """Remove a written index (a scratch copy that is no longer needed)."""
        remove(self.spark, self.path)

    # ---------------------------------------------------------------- views
    def as_of(self, commit_id: int) -> "Index":
        """Snapshot: commits after `commit_id` are invisible (A4)."""
        return Index(self.spark, self.schema, self._corpus, self._terms, self._vocab,
                     self._values, self._near, self._pairs, self._tops, self._stats, self.id_col, self.path, commit_id, self.commits)

    def _pin(self, df: DataFrame) -> DataFrame:
        if self.commit is None:
            return df
        return df.where(F.col(COMMIT_COL) <= F.lit(self.commit))

    @property
    def corpus(self) -> DataFrame:
        return self._pin(self._corpus).drop(analysis.BLOCK_COL)

    @property
    def tops(self) -> DataFrame | None:
        """(field, term, commit_id, _block, top) of frequent terms; a written index has it."""
        return None if self._tops is None else self._pin(self._tops)

    @property
    def terms(self) -> DataFrame:
        return self._pin(self._terms)

    @property
    def values(self) -> DataFrame:
        """(field, dec, long, dbl, doc_id): the indexed numbers and booleans."""
        return self._pin(self._values)

    @property
    def near(self) -> DataFrame | None:
        """(field, key, n, term): deletion neighbourhoods, if the index keeps them."""
        return None if self._near is None else self._pin(self._near)

    @staticmethod
    def _common(vocab: DataFrame, stats: DataFrame) -> DataFrame:
        """(commit_id, field, term): the words of each commit whose pairs it keeps."""
        own = stats.select(COMMIT_COL, "field", "n_docs")
        return (vocab.join(own, [COMMIT_COL, "field"]).where(analysis.common_words(vocab, F.col("n_docs")))
                     .select(COMMIT_COL, "field", "term"))

    @property
    def pairs(self) -> DataFrame | None:
        """(field, w1, w2, doc_id, dl, positions) of common words, if the index keeps them."""
        return None if self._pairs is None else self._pin(self._pairs)

    def paired(self, field: str, words) -> tuple[set[str], list[int]]:
        """Which of a phrase's words are common somewhere, and the commits in
        which all of these are: there pairs of them are kept. A row a word and
        commit at most comes to the driver."""
        if self._pairs is None:
            return set(), []
        rows = (self._common(self._pin(self._vocab).where((F.col("field") == field) & F.col("term").isin(sorted(set(words)))),
                             self._pin(self._stats)).groupBy(COMMIT_COL).agg(F.collect_set("term").alias("terms")).collect())
        common = set().union(*[r["terms"] for r in rows])
        return common, sorted(r[COMMIT_COL] for r in rows if set(r["terms"]) == common)

    def vocabulary(self, where=None, only: DataFrame | None = None) -> DataFrame:
        """(field, term, df, cf). `where` and the semi join with `only` (a
        `term` column) are applied before the per-commit rows are summed;
        a view of a single commit needs no sum (and no shuffle)."""
        v = self._pin(self._vocab)
        if where is not None:
            v = v.where(where)
        if only is not None:
            v = v.join(only.select("term"), "term", "left_semi")
        if self.path is not None and self.n_commits() == 1:
            return v.select("field", "term", "df", "cf")
        return analysis.vocabulary(v)

    def _stats_rows(self):
        """The view's statistics, summed over commits on the executors: one
        row per text field (bounded by the schema, however many commits a
        stream has written). Read once per view, a snapshot as a reader is."""
        if self._stat_rows is None:
            self._stat_rows = (self._pin(self._stats).groupBy("field")
                               .agg(F.sum("n_docs").alias("n_docs"),
                                    F.sum("total_len").alias("total_len"),
                                    F.count_distinct(COMMIT_COL).alias("n_commits"))
                               .collect())
        return self._stat_rows

    def n_commits(self) -> int:
        return max([int(r["n_commits"]) for r in self._stats_rows()], default=0)

    def stat_values(self) -> dict[str, tuple[int, float]]:
        """field -> (n_docs, avgdl) of the view, as driver-side numbers."""
        return {r["field"]: (int(r["n_docs"]), int(r["total_len"]) / max(int(r["n_docs"]), 1))
                for r in self._stats_rows()}

    def stat_columns(self, field="field"):
        """(n_docs, avgdl) columns for rows of any field: literal lookups."""
        field = F.col(field) if isinstance(field, str) else field
        vals = self.stat_values()
        if not vals:
            return F.lit(None).cast("long"), F.lit(None).cast("double")
        keys = sorted(vals)
        n = F.create_map(*[x for f in keys for x in (F.lit(f), F.lit(vals[f][0]).cast("long"))])
        a = F.create_map(*[x for f in keys for x in (F.lit(f), F.lit(float(vals[f][1])))])
        return F.try_element_at(n, field), F.try_element_at(a, field)

    def mean_growth(self, field: str) -> float:
        """How far the view's average length exceeds a commit's own, at most:
        a document's contribution grows by no more."""
        rows = (self._pin(self._stats).where((F.col("field") == field) & (F.col("total_len") > 0))
                    .agg(F.min(F.col("total_len") / F.col("n_docs")).alias("least")).first())
        mean = self.stat_values().get(field, (0, 0.0))[1]
        return max(1.0, mean / rows["least"]) if rows["least"] else 1.0

    def stats(self) -> DataFrame:
        """(field, n_docs, total_len, avgdl): one row per text field."""
        return analysis.corpus_stats(self._pin(self._stats))
