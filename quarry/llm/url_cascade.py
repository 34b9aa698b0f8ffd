"""URL filters by a Bloom filter cascade (operator 2); DataFrame functions only.

A cascade holds a set of listed keys exactly, relative to a universe of all
keys that can be asked for: level 0 is a Bloom filter of the listed keys,
level 1 one of the other keys that level 0 lets through, level 2 one of the
listed keys that level 1 lets through, and so on until none is left. A key
of the universe is listed if the number of levels it passes before the first
that stops it is odd. Asking needs no join: the levels are constants of the
plan, and their size follows the list, not the corpus (level 0 is made so
sharp that about as many other keys pass it as there are listed ones).

The universe is built from the corpus: for every url the host and the
domains above it, alone and with the path prefixes of the lengths that
occur in the list.

Null urls and urls without `://` have an empty host and path, fit no rule
and are allowed. Repeated pages are judged alike. Hosts are lower-cased in
A-Z only. Urls of any length are parsed whole; an empty table gives no rows.
Other columns of the pages, which may have any name, are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, written

# The rules of the contract: key = host + path; fixed values.
ALLOW = ["org/", "com/fr/"]
BLOCK = ["example.org/es/", "example.org/en/1", "com/de/"]

# Words that put a host on the block list when one of its labels holds them
# between hyphens (what a public list of unwanted hosts is made of here).
UNWANTED = ["casino", "pills", "bets", "spam", "adult", "ads"]

LATER_RATE = 0.05               # false positives of the levels after the first: few levels are needed
MAX_FILTER_BYTES = 64 << 20     # a level of more than this is refused, not broadcast


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def domains(host: Column) -> Column:
    """The host and all domains above it, longest first; none for an empty host."""
    labels = F.split(host, r"\.", -1)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)),
                    lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def rule_keys(names: Column, path: Column, lengths: list[int]) -> Column:
    """The keys a rule for this url can have: domain + path prefix."""
    # the lengths are given to every row as a column, so that no key is made
    # for a length that no rule has
    sizes = F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")
    return F.flatten(F.transform(names, lambda d: F.transform(
        F.filter(sizes, lambda n: F.length(path) >= n), lambda n: F.concat(d, F.substring(path, 1, n)))))


def _bits(key: Column, level: int, hashes: int, size: int) -> list[Column]:
    """Positions of a key in a level: two hashes, stepped."""
    a, b = (F.pmod(F.xxhash64(key, F.lit(2 * level + i)), F.lit(size)) for i in (0, 1))
    return [F.pmod(a + b * F.lit(i), F.lit(size)) for i in range(hashes)]


class Cascade:
    """Levels as (array of 64-bit words, hashes, bits)."""

    def __init__(self, spark: SparkSession, levels: list[tuple[DataFrame, int, int]]):
        self.spark, self.levels = spark, levels

    def attach(self, df: DataFrame, prefix: str) -> DataFrame:
        """`df` with each level's words as a column: a scalar subquery, which
        the plan evaluates once and holds as a constant."""
        for i, (words, _, _) in enumerate(self.levels):
            df = df.withColumn(f"{prefix}{i}", words.scalar())
        return df

    def passes(self, key: Column, level: int, prefix: str) -> Column:
        _, hashes, size = self.levels[level]
        words = F.col(f"{prefix}{level}")
        hit = F.lit(True)
        for at in _bits(key, level, hashes, size):
            word = F.get(words, F.shiftright(at, 6).cast("int"))
            hit = hit & (F.getbit(word, F.pmod(at, F.lit(64)).cast("int")) == 1)
        return hit

    def holds(self, key: Column, prefix: str) -> Column:
        """Whether the key, one of the universe, is listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(self.passes(key, i, prefix), out).otherwise(F.lit(i % 2 == 1))
        return out if self.levels else F.lit(False)


def _level(keys: DataFrame, level: int, n: int, rate: float):
    """A Bloom filter of n keys with a false positive rate, as one row."""
    spark = keys.sparkSession
    hashes = max(1, round(-math.log2(rate)))
    size = 64 * max(1, math.ceil(n * hashes / math.log(2) / 64))
    if size / 8 > MAX_FILTER_BYTES:
        raise ValueError(f"a filter of {n} keys needs {size // 8} bytes, more than MAX_FILTER_BYTES")
    at = keys.select(F.explode(F.array(*_bits(F.col("key"), level, hashes, size))).alias("at"))
    mask = F.expr("shiftleft(1L, cast(at % 64 as int))")
    words = at.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(mask).alias("b"))
    dense = spark.range(size // 64).join(words, F.col("id") == F.col("w"), "left")
    row = dense.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0).cast("bigint")).alias("b")))).alias("r"))
    return written(row.select(F.col("r.b").alias("words")), "level"), hashes, size


def cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of the keys of `listed` over those of `universe` (one
    column `key` each, nulls ignored; repeats do not matter)."""
    spark = universe.sparkSession
    keys = written(listed.select("key", F.lit(True).alias("listed"))
                   .unionByName(universe.select("key", F.lit(False).alias("listed")))
                   .where(F.col("key").isNotNull()).groupBy("key").agg(F.max("listed").alias("listed")), "keys")
    counts = {r[0]: r[1] for r in keys.groupBy("listed").count().collect()}
    levels: list = []
    inside, outside = keys.where("listed"), keys.where("not listed")
    n, others = counts.get(True, 0), counts.get(False, 0)
    rate = min(LATER_RATE, max(n, 1) / max(others, 1))
    while n:
        levels.append(_level(inside, len(levels), n, rate))
        c = Cascade(spark, levels)
        last = len(levels) - 1
        through = c.attach(outside, "f").where(c.passes(F.col("key"), last, "f")).select("key", "listed")
        inside, outside = written(through, "through"), inside
        n = inside.count()
        rate = LATER_RATE
    return Cascade(spark, levels)


def judge(pages: DataFrame, allow: DataFrame, block: DataFrame, hosts: DataFrame,
          lengths: list[int], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict). `allow`, `block`: rule keys
    (host + path prefix; `lengths` are the lengths of their paths); the
    longest that fits decides. `hosts`: hosts to block, subdomains included,
    where no rule fits. One column `key` each."""
    url = F.col(url_col)
    parsed = (pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
                   .withColumn("names", domains(F.col("host")))
                   .withColumn("keys", rule_keys(F.col("names"), F.col("path"), lengths)))
    # one cascade for the three lists: a key is marked with its list
    rules, names = parsed.select(F.explode("keys").alias("key")), parsed.select(F.explode("names").alias("key"))
    marked = lambda df, mark: df.select(F.concat(F.lit(mark), "key").alias("key"))
    all_of = lambda a, b, h: marked(a, "a ").unionByName(marked(b, "b ")).unionByName(marked(h, "h "))
    lists = cascade(all_of(allow, block, hosts), all_of(rules, rules, names))
    df = lists.attach(parsed, "f")
    on = lambda mark: lambda k: lists.holds(F.concat(F.lit(mark), k), "f")
    longest = lambda keys: F.array_max(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))
    df = (df.withColumn("yes", longest(F.filter("keys", on("a "))))
            .withColumn("no", longest(F.filter("keys", on("b ")))))
    listed = F.exists("names", on("h "))
    rule = F.when(F.col("yes").isNull(), F.col("no")).when(F.col("no").isNull(), F.col("yes")).otherwise(
        F.greatest("yes", "no"))
    return df.withColumn("best", rule).select(
        "page_id", "host", "path", F.col("best.key").alias("rule"),
        F.when(F.col("best").isNotNull(), F.when(F.col("best") == F.col("yes"), "allow").otherwise("block"))
         .when(listed, "block").otherwise("allow").alias("verdict"))


def unwanted_hosts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """The corpus's hosts with a label that holds an unwanted word."""
    word = "|".join(UNWANTED)
    return (pages.select(host_of(F.col(url_col)).alias("key"))
                 .where(F.col("key").rlike(rf"(^|[.-])({word})([.-]|$)")).distinct())


def verdicts(pages: DataFrame) -> DataFrame:
    """The registered query: the contract's rules, then the block list."""
    spark = pages.sparkSession
    as_keys = lambda rules: spark.createDataFrame([(r,) for r in rules], "key string")
    lengths = sorted({len(r) - r.index("/") for r in ALLOW + BLOCK})
    return judge(pages, as_keys(ALLOW), as_keys(BLOCK), unwanted_hosts(pages), lengths)


_HOST = r"translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = rf"""
WITH rules(rhost, rpath, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parsed AS (
  SELECT page_id, coalesce({_HOST}, '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
listed AS (
  SELECT DISTINCT host FROM parsed WHERE regexp_matches(host, '(^|[.-])({"|".join(UNWANTED)})([.-]|$)'))
SELECT page_id, host, path,
       (SELECT arg_max(rhost || rpath, length(rhost || rpath)) FROM rules
        WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule,
       coalesce((SELECT arg_max(verdict, length(rhost || rpath)) FROM rules
                 WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
                CASE WHEN EXISTS (SELECT 1 FROM listed l WHERE p.host = l.host OR ends_with(p.host, '.' || l.host))
                     THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed p
"""
