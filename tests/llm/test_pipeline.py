"""The pipeline's stages one after another, each against a plain version on its own input."""

import re

import sentencepiece

import corpus_pipeline
from quarry.llm.queries import PIECE_MODEL

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    from quarry.llm.common import written
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SF), name)
        seen[name] = (docs.collect(), out.collect(), out.columns)
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "repeat_dedup", "mix", "tokens"]
    assert all(sorted(seen[n][2]) == sorted(columns) for n in ("quality", "near_dedup", "repeat_dedup", "mix"))

    before, after, _ = seen["quality"]
    assert 0 < len(after) < len(before) and {r.doc_id: r for r in after}.items() <= {r.doc_id: r for r in before}.items()

    before, after, _ = seen["near_dedup"]
    sets = {}
    for r in before:
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text.lower())
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in after) == sorted({find(i) for i in sets})

    before, after, _ = seen["repeat_dedup"]
    assert sorted(r.doc_id for r in before) == sorted(r.doc_id for r in after)
    text = {r.doc_id: r.text.encode() for r in before}
    count = {}
    for t in text.values():
        for i in range(len(t) - 199):
            count[t[i:i + 200]] = count.get(t[i:i + 200], 0) + 1
    for r in after:
        t, cover = text[r.doc_id], set()
        for i in range(len(t) - 199):
            if count[t[i:i + 200]] > 1:
                cover.update(range(i, i + 200))
        # characters are removed whole, or not at all
        want, at = "", 0
        for ch in t.decode():
            n = len(ch.encode())
            want += "" if all(j in cover for j in range(at, at + n)) else ch
            at += n
        assert r.text == want and r.n_chars == len(want)

    before, after, _ = seen["mix"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    before, after, _ = seen["tokens"]
    assert len(before) == len(after)
    source = {r.doc_id: r.text for r in before}
    for r in after:
        assert r.ids == sp.encode(source[r.doc_id]) and r.n_tokens == len(r.ids) and r.text == sp.decode(r.ids)


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "ids", "n_tokens"}
    assert out.count() > 0
