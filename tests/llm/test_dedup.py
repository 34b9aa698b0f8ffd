"""Near-duplicates (documents, vectors) and repeated strings against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from quarry.llm import minmax_dedup, projection_dedup, suffix_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def _classes(ids, linked):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def _texts():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    out = ["", None, "one", "One", "one two", "  one\ttwo ", " \n ", "one two three"]
    for _ in range(5):
        base = [rng.choice(vocab) for _ in range(rng.randrange(40, 120))]
        out.append(" ".join(base))
        for _ in range(rng.randrange(3, 14)):
            w = list(base)
            for _ in range(rng.randrange(0, 7)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            out.append(" ".join(w).upper() if rng.random() < 0.3 else " ".join(w))
    return out + [out[9], out[9]]


@pytest.mark.parametrize("block", [128, 3])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(minmax_dedup, "BLOCK", block)
    monkeypatch.setattr(minmax_dedup, "PIVOTS", 2)
    texts = _texts()
    rng = random.Random(5)
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts, ["x"] * len(ids)))
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    for k, num in ((3, 85), (5, 80)):
        sets = {i: _shingles(t, k) for i, t in zip(ids, texts)}
        linked = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
                  and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
        want = _classes(ids, linked)
        got = {r.doc_id: r for r in minmax_dedup.near_duplicates(df, k=k, num=num).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
        assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
        assert all(r.kept == (i == want[i]) for i, r in got.items())
    one = minmax_dedup.deduplicated(df, k=3, num=85)
    assert one.columns == df.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(_classes(ids, [
        (a, b) for a in ids for b in ids if a < b and (s := _shingles(texts[ids.index(a)], 3))
        and (t := _shingles(texts[ids.index(b)], 3)) and 100 * len(s & t) >= 85 * len(s | t)]).values()))


def test_documents_without_id_and_repeated_rows(spark):
    same = " ".join(f"v{i}" for i in range(30))
    df = spark.createDataFrame([(4, same), (4, same), (None, same), (None, "other words here now"), (2, None)],
                               "doc_id long, text string")
    rows = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in minmax_dedup.near_duplicates(df).collect())
    assert rows == [("2", "2", True), ("4", "4", True), ("4", "4", True), ("None", "4", False), ("None", "None", True)]
    assert minmax_dedup.deduplicated(df).count() == 4
    assert minmax_dedup.near_duplicates(df.limit(0)).collect() == []


def test_more_bands_for_lower_thresholds():
    assert minmax_dedup.bands_for(0.8) > minmax_dedup.bands_for(0.85)


def test_bands_cover_small_sets():
    for num, small in ((85, [(6, 7), (17, 20)]), (80, [(4, 5), (8, 10)])):
        bands = minmax_dedup.bands_for(num / 100)
        for m, n in small:
            band = (m * (m - 1) / (n * (n - 1))) ** (minmax_dedup.ROWS // 2)
            assert (1 - band) ** bands < minmax_dedup.MISS


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(projection_dedup, "BLOCK", 7)
    monkeypatch.setattr(projection_dedup, "STEP", 80)
    rng = np.random.default_rng(1)
    x = [rng.standard_normal(16) for _ in range(150)]
    for c in range(4):
        base = rng.standard_normal(16)
        x += [base + rng.standard_normal(16) * 0.12 for _ in range(5 + 9 * c)]
    x += [x[3], x[3], x[160] * 7, np.zeros(16)]
    x += [rng.standard_normal(8)]
    x[-1] = np.array(x[-1])
    ids = rng.permutation(len(x) + 3).tolist()
    rows = [(i, [float(c) for c in v], "z") for i, v in zip(ids, x)]
    rows += [(ids[-3], None, "z"), (ids[-2], [1.0] * 15 + [float("nan")], "z"), (ids[-1], [], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept string")
    links = {i: 0 for i, _, _ in rows}
    pairs = []
    for a, (i, v, _) in enumerate(rows[:-3]):
        for j, w, _ in rows[a + 1:-3]:
            if len(v) == len(w) and any(v) and any(w):
                cos = np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)
                if cos >= 0.95:
                    links[i] += 1
                    links[j] += 1
                    pairs.append((i, j))
    want = _classes(list(links), pairs)
    got = projection_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {
        i: (links[i], want[i], want[i] == i) for i in links}
    assert projection_dedup.near_duplicates(df.limit(0)).collect() == []
    alone = spark.createDataFrame([(None, [1.0, 2.0]), (5, None)], "vec_id long, embedding array<double>")
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept)
                  for r in projection_dedup.near_duplicates(alone).collect()) == [("5", 0, 5, True), ("None", 0, None, False)]


def _dense_cloud(rows, others, pairs):
    """`others` strangers, a cloud of `rows` vectors with cosines of about 0.9,
    and for `pairs` of these a partner at 0.951."""
    rng = np.random.default_rng(6)
    unit = lambda m: m / np.linalg.norm(m, axis=-1, keepdims=True)
    centre = unit(rng.standard_normal(64))
    cloud = unit(np.sqrt(0.9) * centre + np.sqrt(0.1) * unit(rng.standard_normal((rows, 64))))
    some = cloud[:pairs]
    aside = rng.standard_normal(some.shape)
    aside = unit(aside - (aside * some).sum(axis=1, keepdims=True) * some)
    return np.vstack([rng.standard_normal((others, 64)), cloud, 0.951 * some + np.sqrt(1 - 0.951 ** 2) * aside])


@pytest.mark.parametrize("rows,block", [(4000, 1024), (300, 70)])
def test_vectors_in_a_dense_cloud(spark, monkeypatch, rows, block):
    monkeypatch.setattr(projection_dedup, "BLOCK", block)
    x = _dense_cloud(rows, 2 * rows, min(rows // 4, 300))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = np.triu(unit @ unit.T >= 0.95, 1)
    links = near.sum(axis=0) + near.sum(axis=1)
    want = _classes(range(len(x)), zip(*(i.tolist() for i in np.nonzero(near))))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in projection_dedup.near_duplicates(df).collect()}
    wrong = [i for i in got if got[i] != (links[i], want[i], want[i] == i)]
    assert len(got) == len(x) and wrong == []


def _brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i:i + length]] = seen.get(d[i:i + length], 0) + 1
    out = []
    for d in data:
        mask = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                mask[i:i + length] = True
        runs = int((np.diff(np.r_[0, mask.astype(int)]) == 1).sum())
        kept = np.frombuffer(d, np.uint8)[~mask].tobytes()
        out.append((len(d), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def _repeat_texts():
    rng = random.Random(8)

    def prose(n):
        return "".join(rng.choice("abcdeé ñ\n") for _ in range(n))

    passage, other = prose(350), prose(260)
    texts = ["", None, "short", "a" * 199, "b" * 200, "c" * 201, "de" * 400, prose(500)]
    for _ in range(12):
        cut = rng.randrange(0, 120)
        texts.append(prose(rng.randrange(0, 300)) + passage[cut:rng.randrange(290, 350)] + prose(rng.randrange(0, 300)))
    texts += [prose(50) + other + prose(50) + other, prose(900), texts[7], texts[9], "b" * 200]
    return texts


@pytest.mark.parametrize("group", [20_000, 3])
def test_repeated_strings(spark, monkeypatch, group):
    spans = suffix_dedup.repeated_spans
    monkeypatch.setattr(suffix_dedup, "repeated_spans", lambda d, c="text": spans(d, c, group))
    texts = _repeat_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(suffix_dedup.digests(df).collect())
    assert [tuple(r)[1:] for r in got] == _brute_repeats(texts, suffix_dedup.L)
    kept = {r.doc_id: r for r in suffix_dedup.without_repeats(df.selectExpr("doc_id", "text", "1 as _tid")).collect()}
    assert kept[1].text is None and kept[2].text == "short" and kept[4].text == ""
    assert suffix_dedup.digests(df.limit(0)).collect() == []


def test_column_rounds_against_pairs():
    rng = np.random.default_rng(2)
    m = rng.integers(0, 2, (40, 30)).astype(np.uint8)
    m[5], m[17, 4:] = m[9], m[3, 4:]
    m[20, :6] = suffix_dedup.PAD
    m[21, :6] = suffix_dedup.PAD
    m[21, 6:] = m[20, 6:]
    for length in (3, 8, 20):
        got = suffix_dedup.column_rounds(m, length)
        for i in range(len(m)):
            for j in range(m.shape[1] - length + 1):
                w = m[i, j:j + length]
                want = (w != suffix_dedup.PAD).all() and any(
                    (m[x, j:j + length] == w).all() for x in range(len(m)) if x != i)
                assert got[i, j] == want


def test_spans_in_whole_characters():
    data = "aé€b".encode()
    assert list(suffix_dedup.to_characters(data, [(2, 5)])) == [(3, 3)][:0]
    assert list(suffix_dedup.to_characters(data, [(1, 6)])) == [(1, 6)]
    assert suffix_dedup.merged([5, 0, 2], [9, 3, 4]) == [(0, 4), (5, 9)]
