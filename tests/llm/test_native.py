"""URL cascade, n-gram ratio, license diagonals, Poisson mixing: DataFrame operators."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from quarry.llm import license_diagonals, ngram_ratio, poisson_mix, url_cascade

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_cascade_is_exact(spark):
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("key like '%7'").unionByName(spark.createDataFrame([("elsewhere",), (None,)], "key string"))
    c = url_cascade.cascade(listed, universe.unionByName(universe))
    assert len(c.levels) > 1
    got = {r.key for r in c.attach(universe, "f").where(c.holds(F.col("key"), "f")).collect()}
    assert got == {f"k{i}" for i in range(3000) if str(i).endswith("7")}
    none = url_cascade.cascade(listed.limit(0), universe)
    assert none.attach(universe, "f").where(none.holds(F.col("key"), "f")).count() == 0
    no_keys = url_cascade.cascade(listed.limit(0), universe.limit(0))
    assert no_keys.levels == []


def test_filter_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(url_cascade, "MAX_FILTER_BYTES", 8)
    keys = spark.range(500).select(F.col("id").cast("string").alias("key"))
    with pytest.raises(ValueError, match="MAX_FILTER_BYTES"):
        url_cascade.cascade(keys, keys)


RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def _url_brute(url, bad):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0].translate(LOWER)
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    fits = [r for r in RULES for h, p in [(r[:r.index("/")], r[r.index("/"):])]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fits, key=len, default=None)
    listed = any(host == b or host.endswith("." + b) for b in bad)
    return host, path, rule, RULES[rule] if rule else "block" if listed else "allow"


def test_urls(spark):
    urls = [None, "", "no scheme/x", "http://", "http://EXAMPLE.org/es/1", "https://a.example.org/en/12", "http://example.org/en/2",
            "http://example.org", "http://x.com/fr/?q=1", "http://x.com/fr", "http://x.com/de/#a", "http://notexample.org/es/",
            "http://free-bets.example.com/en/1", "http://www.free-bets.example.com/fr/", "http://a.b.casino.net?x=://y.org/",
            "http://com/de/x", "http://org", "http://xcom/de/", "ftp://u@h.org:80/p", "http://a..b.com/de/", "http://é.ORG/É", "http://free-bets.example.com/en/1"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    hosts = [_url_brute(u, [])[0] for u in urls]
    bad = {h for h in hosts if re.search(r"(^|[.-])(casino|pills|bets|spam|adult|ads)([.-]|$)", h)}
    got = {r.page_id: tuple(r)[1:] for r in url_cascade.verdicts(df).collect()}
    assert got == {i: _url_brute(u, bad) for i, u in enumerate(urls)}
    assert bad and url_cascade.verdicts(df.limit(0)).collect() == []


def _base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_base_rules_and_ratio(spark):
    rng = random.Random(6)
    good = [" ".join(rng.choice("the cat sat on a mat and saw it go by".split()) + (". " if rng.random() < .1 else "")
                     for _ in range(rng.randrange(30, 90))) for _ in range(60)]
    junk = [" ".join(rng.choice(["xx", "yy", "zz"]) + rng.choice(["###", "$$$"]) + str(rng.randrange(99)) for _ in range(50)) for _ in range(60)]
    odd = [None, "", " \n\t ", "a b c d e", "a b c d e f a b c d e f", "x " * 300, "l1 é\nl1 é\n\n \nl2\r\nl1 é", "|<>|" * 5,
           " ".join(f"u{i}" for i in range(5000)) + " again again again again again again"]
    texts = good + junk + odd
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(i, 0) for i in range(60, 90)] + [(3, 1), (None, 1), (4, None)],
                                   "doc_id long, quality int")
    got = {r.doc_id: r for r in ngram_ratio.verdicts(docs, labels).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert tuple(got[i])[1:7] == _base(t), t
    assert not any(got[i].kept for i in range(60, 120))
    assert all(got[i].kept != got[i].base_failed for i in range(60))
    # no labels: the base rules alone
    alone = ngram_ratio.verdicts(docs, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed and r.score == 0 for r in alone)
    assert ngram_ratio.verdicts(docs.limit(0), labels).collect() == []


def test_score_by_hand(spark):
    docs = spark.createDataFrame([(0, "a b"), (1, "a c"), (2, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    w = ngram_ratio.weights(docs, labels).first().weights
    assert len(w) == ngram_ratio.BUCKETS
    at = docs.where("doc_id = 0").select(ngram_ratio.buckets(F.col("text"))).first()[0]
    assert len(at) == 3
    got = {r.doc_id: r.score for r in ngram_ratio.verdicts(docs, labels).collect()}
    assert abs(got[0] - sum(w[i] for i in at) / 3) < 1e-6 and got[2] == 0


def test_trusted_counts_cover_all_good_documents(spark):
    docs = spark.range(21_000).selectExpr("id as doc_id", "concat('word', id, ' of ', id % 7) as text")
    labels = docs.selectExpr("doc_id", "1 as quality")
    # all documents are good: trusted and raw counts are the same
    assert set(ngram_ratio.weights(docs, labels).first()["weights"]) == {0.0}
    anonymous = docs.limit(3).selectExpr("cast(null as long) as doc_id", "'rare ' || text as text")
    found = ngram_ratio.weights(docs.unionByName(anonymous), labels).first()["weights"]
    assert len(found) == ngram_ratio.BUCKETS and min(found) < 0


PHRASE = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def test_licenses(spark):
    mit = license_diagonals.NOTICES["mit-text"]
    words = mit.split()
    broken = " ".join(words[:12] + ["really"] + words[12:30] + words[31:])
    texts = [None, "", "MIT", "MIT License", "the MIT license, the mit-license; Apache\nLicense general public license",
             "general public general public license", "mit licenses", "x " * 50 + "Released under the MIT License." + " y" * 50,
             "This work is licensed under the GNU General Public License, version 3.", mit, "before " + broken + " after",
             " ".join(words[:10]), "mit éa license", "mit 1 license", "MIT LICENSE " * 40, "MIT License"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_base int")
    got = {r.doc_id: r for r in license_diagonals.scan(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        at = [(j, v) for j in range(len(w)) for p, v in PHRASE.items() if tuple(w[j:j + len(p)]) == p]
        want = (len(w), len(at), min((a[0] for a in at), default=None), max((a[0] for a in at), default=None),
                ",".join(sorted({a[1] for a in at})))
        assert tuple(got[i])[1:6] == want, t
    assert got[10].labels == "mit-text" and got[9].labels == "mit-text" and got[11].labels == ""
    assert got[8].labels == "gpl,gpl-notice" and got[7].labels == "mit,mit-notice"
    assert all(0 <= r.score <= 1 for r in got.values()) and got[9].score == 1
    assert license_diagonals.scan(df.limit(0)).collect() == []


def _longest_chain(words, template):
    matches = [(p, t) for p in range(len(words) - 1) for t in range(len(template) - 1)
               if words[p:p + 2] == template[t:t + 2]]
    best = {}
    for p, t in matches:
        best[p, t] = 1 + max([n for (q, u), n in best.items()
                              if q < p and u < t and abs(p - q - t + u) <= license_diagonals.DRIFT * (t - u)], default=0)
    return max(best.values(), default=0)


def test_license_spans_are_verified(spark):
    notices = license_diagonals.NOTICES
    split = license_diagonals._template_words
    apache, nc, bsd = (split(notices[k]) for k in ("apache-notice", "cc-by-nc", "bsd-text"))
    far = bsd[:5] + ["a", "b", "c"] + bsd[5:12] + ["d", "e"] + bsd[12:]
    odd = {"2.0 2.0 2.0 2.0 2.0 2.0": "", "4.0, 4.0, 4.0, 4.0, 4.0": "", "4.0 " * 500: "",
           "2.0 version 2 license version apache license the apache under the licensed under": "apache",
           " ".join(reversed(apache)): "", " ".join(" ".join(nc[i:i + 2]) for i in range(len(nc) - 2, -1, -1)): "",
           "4.0 " * 300 + notices["cc-by-nc"] + " 4.0" * 300: "cc-by-nc", " ".join(far): "bsd-text",
           notices["apache-notice"] + ". " + notices["apache-notice"]: "apache,apache-notice"}
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_diagonals.scan(df).collect()}
    for i, (text, labels) in enumerate(odd.items()):
        assert got[i].labels == labels, text
        share = max(_longest_chain(split(text), split(t)) / (len(split(t)) - 1) for t in notices.values())
        if "apache" not in labels:
            assert got[i].score == (share if share >= license_diagonals.SHARE else 0), text


def test_mixing(spark):
    rows = [(i, f"t{i}", "big" if i % 3 else None if i % 2 else "small", 0) for i in range(3000)] + [(5, "t5", "big", 0), (None, "t", "tiny", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int")
    mixed = poisson_mix.mix(df).collect()
    got = Counter(r.source for r in mixed)
    n = Counter(r[2] for r in rows)
    total = sum(c ** 0.5 for c in n.values())
    for s, c in n.items():
        want = c ** 0.5 / total * len(rows)
        if c > 1:
            assert abs(got[s] - want) < 5 * want ** 0.5
    # the same id, the same count; copies numbered from 0; in order of the key
    per = Counter((r.doc_id, r.source) for r in mixed)
    assert per[(5, "big")] % 2 == 0
    assert [r.mix_key for r in mixed] == sorted(r.mix_key for r in mixed)
    assert all(r.copy < per[(r.doc_id, r.source)] for r in mixed)
    assert poisson_mix.mix(df.limit(0)).collect() == []
    given = spark.createDataFrame([("small", 1.0), ("absent", 9.0)], "source string, weight double")
    only = Counter(r.source for r in poisson_mix.mix(df, given, wanted=5000).collect())
    assert set(only) == {"small"} and abs(only["small"] - 500) < 120 or abs(only["small"] - 5000) < 350


def test_mixing_as_duckdb(spark):
    rows = [(i, f"t{i}", "en", ["a", "b", None, "c'd"][i % 7 % 4], i) for i in range(500)] + [(7, "again", None, "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    mine = sorted((str(r.doc_id), r.source or "", r.copy, r.mix_key, round(r.rate, 6), r.text) for r in poisson_mix.mix(df).collect())
    theirs = sorted((str(r[0]), r[3] or "", r[6], r[7], r[5], r[1]) for r in con.execute(poisson_mix.ORACLE).fetchall())
    assert mine == theirs and len(mine) > 300


def _spark_hash(*parts):
    """xxhash64 of strings, each seeded with the hash of those before."""
    h = 42
    for s in parts:
        h = xxhash.xxh64_intdigest(s.encode(), seed=h)
    return h


def test_ngram_scores_by_brute_force(spark):
    rng = random.Random(8)
    plain, junk = "the cat sat on a mat and saw it go by, then left.".split(), "xx #1 $$ click_here buy now!! zz 99".split()
    docs = [(i, " ".join(rng.choice(plain if i % 3 else junk) for _ in range(rng.randrange(9, 60)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "one two"), (63, docs[1][1]), (64, docs[1][1]), (65, "word " * 3000), (None, docs[2][1])]
    labels = [(i, 1 if i is not None and i % 3 else 0) for i, _ in docs if i != 5] + [(999, 1)]
    got = {(r.doc_id, r.n_words): r for r in ngram_ratio.verdicts(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}

    def grams(text):
        t = regex.findall(ngram_ratio.TOKEN, text or "")
        return [_spark_hash(x) % ngram_ratio.BUCKETS for x in t] + [_spark_hash(*x) % ngram_ratio.BUCKETS for x in zip(t, t[1:])]

    good = {i for i, q in labels if q == 1 and i is not None}
    raw, trusted = Counter(), Counter()
    for i, t in docs:
        raw.update(grams(t))
        trusted.update(grams(t) if i in good else ())
    size = ngram_ratio.BUCKETS
    weight = [math.log((trusted[b] + 1) / (sum(trusted.values()) + size)) - math.log((raw[b] + 1) / (sum(raw.values()) + size))
              for b in range(size)]
    assert len(got) == len(docs)
    for i, t in docs:
        words = (t or "").split()
        g = grams(t)
        want = sum(weight[b] for b in g) / len(g) if g else 0.0
        r = got[i, len(words)]
        assert r.score == pytest.approx(want, abs=2e-6)
        assert r.kept == (not r.base_failed and want >= ngram_ratio.THRESHOLD)
    assert 0 < sum(r.kept for r in got.values()) < len(docs)
