"""The pipeline's stages, each against what its input must become."""

import random
import re

import numpy as np
from brute import components, normal

import corpus_pipeline
from triplens.llm import language, packing, pii
from triplens.llm.common import stored

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rng = random.Random(2)
    base = [r for r in docs.collect()]
    rows = [tuple(r) for r in base]
    for r in base[:12]:
        words = r.text.split(" ")
        if len(words) > 60:
            words[rng.randrange(len(words))] = "changed"
            rows.append((1000 + r.doc_id, " ".join(words), r.lang, "x", 1))
        rows.append((2000 + r.doc_id, re.sub(" ", "\n ", r.text), r.lang, "x", 1))
    rows += [(3000, None, "en", None, None), (3001, "", "en", "x", 0), (3002, "12 34 !", "en", "x", 7), rows[0]]
    rows += [(3003, "the mail of ann is ann@example.org and the phone +49 30 1234567", "en", "x", 1)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def test_stages(spark):
    docs = stored(corpus(spark), "test")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "pii", "packing"]
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stored(stage(spark, docs, ""), name)
        out[name] = before, docs.collect()
        if name != "packing":
            assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")], name

    before, after = out["language_id"]
    profiles = language.learn(spark.createDataFrame(before, COLUMNS).where(~language.held_out()))
    good = [r for r in before if (p := profiles.predict(r.text))[0] != "und" and p[1] > 0]
    assert sorted(map(tuple, good), key=repr) == sorted(map(tuple, after), key=repr)
    assert {3000, 3001, 3002} <= {r.doc_id for r in before} - {r.doc_id for r in after}

    before, after = out["exact_dedup"]
    first = {}
    for r in before:
        first[normal(r.text)] = min(first.get(normal(r.text), r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(first.values()) and len(after) < len(before)

    before, after = out["near_dedup"]
    reached, sizes = components([(r.doc_id, r.text) for r in before])
    want = {r.doc_id for r, c, s in zip(before, reached, sizes) if c == r.doc_id or not s}
    assert {r.doc_id for r in after} == want and len(after) == len(want) < len(before)

    before, after = out["pii"]
    texts = {r.doc_id: r for r in after}
    assert len(after) == len(before)
    for r in before:
        if pii.base_spans(r.text):
            assert not pii.base_spans(texts[r.doc_id].text) and texts[r.doc_id].n_chars == len(texts[r.doc_id].text)
        else:
            assert texts[r.doc_id] == r

    before, after = out["packing"]
    bpe = packing.byte_bpe()
    ids = {r.doc_id: np.frombuffer(bpe.ids(r.text), "<u4").size + 1 for r in before}
    got = {}
    for r in after:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == ids


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
