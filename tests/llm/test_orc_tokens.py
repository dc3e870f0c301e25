"""Token files against the tokenizer's library, a second ORC reader, and plain sums."""

import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.test_tokens import ODD_TEXTS
from triplens.llm import orc_tokens
from triplens.llm.common import shared_path

ODD = [
    *ODD_TEXTS, "ΑΣ ΣΑΣ ΣΊΣΥΦΟΣ", "a<|endoftext|>b <|startoftext|>", "It'S WE'LL 'Ss I'M don't", "日本語 テキスト ﾃ Ａ",
    "é 가 ̈a", "İI ıŞ ǅ ß ẞ", "a\x1cb\x85c\xa0d　e​f", "½ Ⅳ ²3 ٣", "\x01a", "“q” – ‘x’ …",
]
SCHEMA = "doc_id long, text string, part int, ids int, first string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def written(spark, rows, **options):
    docs = spark.createDataFrame([(key, text, 7, 8, "clash") for key, text in rows], SCHEMA).repartition(3)
    return docs, orc_tokens.TokenFiles.write(docs, shared_path(spark, "test-orc"), **options)


def test_ids_equal_the_library(library):
    mine = orc_tokens.word_bpe()
    every = [f"a{chr(c)}b {chr(c)}" for c in range(0x20, 0x3100, 3)]
    for text in [*ODD, *every]:
        assert np.frombuffer(mine.ids(text), "<u4").tolist() == ids_of(library, text)[:-1], text


def test_rows_against_plain_sums(spark, library):
    """Null and repeated ids, null, empty and very long texts, columns with the files' own names."""
    rows = [(i * 3 % 101, text) for i, text in enumerate(ODD)]
    rows += [(None, "no id"), (None, None), (7, "same id"), (7, "same id"), (1000, "Long Words " * 60_000), (1001, "")]
    _, files = written(spark, rows)
    got = orc_tokens.checksums(files.rows()).collect()
    assert len(got) == len(rows)
    begun = 0
    for row in sorted(got, key=lambda r: r.start):
        assert row.start == begun
        begun += row.n_tokens
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys)
    want = sorted((str(key), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for key, ids in ((k, ids_of(library, t)) for k, t in rows))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want


def test_empty_table(spark):
    _, files = written(spark, [])
    assert orc_tokens.checksums(files.rows()).count() == 0 and files.span(0, 10).count() == 0


def scanned(df):
    """Rows that the scan of ``df`` hands on, behind pruning by metadata."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    leaves = (plan.finalPhysicalPlan() if "Adaptive" in plan.nodeName() else plan).collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()) if "Scan" in leaves.apply(i).nodeName())


def test_metadata_prunes_and_stripes_split(spark, library):
    rows = [(2 * i, f"Document number {i} of many") for i in range(12_000)]
    _, files = written(spark, rows, stripe_bytes=1 << 16, row_group=1000)
    paths = glob.glob(f"{files.path}/ids/*.orc")
    # A second reader sees the same rows, several stripes and the row index.
    seen = {}
    for path in paths:
        held = pyarrow.orc.ORCFile(path)
        assert held.row_index_stride == 1000
        seen |= dict(zip(*[held.read(columns=[c]).column(c).to_pylist() for c in ("doc_id", "ids")]))
    assert seen[42] == ids_of(library, rows[21][1]) and len(seen) == len(rows)
    # 42 is looked up within its row group; an odd id inside the range is ruled out by the Bloom filter.
    assert 1 <= scanned(files.stripes().where("doc_id = 42")) <= 4096
    assert scanned(files.stripes().where("doc_id = 4243")) == 0
    assert [r.ids for r in files.lookup([42, 43]).collect()] == [seen[42]]
    total = files.rows().agg(F.sum(F.size("ids"))).first()[0]
    stream = [i for _, text in rows for i in ids_of(library, text)]
    assert total == len(stream)
    found = files.span(5000, 5100).orderBy("start").collect()
    first = found[0].start
    assert first <= 5000 and [i for r in found for i in r.ids][5000 - first : 5100 - first] == stream[5000:5100]


def test_registered_query(spark, library):
    from __spark_entry__ import queries

    folder = "/root/testdata/sf0.001"
    got = queries()["op11_orc_tokens"](spark, folder).orderBy("doc_id").collect()
    begun = 0
    for row, doc in zip(got, spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect(), strict=True):
        ids = ids_of(library, doc.text)
        assert tuple(row) == (doc.doc_id, begun, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        begun += len(ids)
