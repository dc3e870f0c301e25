"""Token ids in ORC files, sorted by document id.

A file holds one range of document ids in ascending order, a row for each document: its ids as a list
of integers, which ORC writes with run-length encoding, and ``first``, the ids of the file before
it. Row indexes and Bloom filters on the document id, and the least and largest ``first`` of each
row group, let a reader skip stripes and row groups by their metadata; a manifest with a row per
file holds the ids before each. Stripes are read in parallel, as Spark splits files at them.

The texts are shuffled once, by range of (id, place in the table); they are encoded behind that
shuffle, in the order of the files, so neither ids nor positions are sorted or joined again. As the
place is part of the range, rows with one id, or without any, are dealt over many files.

Defined results: a null or empty text is the end id alone; a null id comes before all others and
stays null; rows with one id follow each other in the order of the table, each with its own ids; a text
of any length is one row; an empty table gives files without rows; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.llm.common import shared_path, table

SCHEMA = "part int, doc_id long, first long, n_tokens int, ids array<int>"
_ROWS, _IDS = 512, 1 << 20  # of a batch that leaves the encoder

# Closes a word for the byte-pair encoder; texts that hold it go to the library.
_MARK = "\x01"
# Characters on whose class, lower case and composition all versions of Unicode since 4.0 agree.
_SETTLED = re.compile(
    r"[\t\n\r\x20-\x7E¡-ȠΑ-ΡΣ-ώА-я"
    r"‐-‧‰-⁞€、-〟ぁ-ゔァ-ヺ一-龥가-힣！-～]*"
)
# Letters and numbers of settled characters; \d has the decimal digits only, \w all numbers.
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾〇]+|[\d²³¹¼½¾〇]|(?:[^\s\w]|_)+")


class WordBpe:
    """Ids of a lower-casing byte-pair vocabulary with word ends, as little-endian unsigned 32-bit integers.

    ``json_path`` is a file of the ``tokenizers`` library, and the ids are that library's. Texts of
    settled characters are normalised and cut into words here, and merged by ``tiktoken`` at several
    times the library's speed: the ranks are the vocabulary's ids, with a mark for the end of a word.
    """

    def __init__(self, json_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(json_path)
        with open(json_path, encoding="utf-8") as file:
            described = json.load(file)
        vocabulary, merges = described["model"]["vocab"], described["model"]["merges"]
        added = {token["content"]: token["id"] for token in described["added_tokens"]}
        symbols = _byte_symbols()
        ranks = {_MARK.encode(): len(vocabulary) + len(added)}
        for token, number in vocabulary.items():
            if token not in added:
                whole = token.removesuffix("</w>")
                ranks[bytes(symbols[c] for c in whole) + (_MARK.encode() if whole != token else b"")] = number
        # Merging by rank is merging by rule only where ids follow the order of the rules.
        made = [vocabulary["".join(rule if isinstance(rule, list) else rule.split(" "))] for rule in merges]
        if made != sorted(made) or min(made) < 512:
            raise ValueError("the ids of the vocabulary do not follow its merges")
        pattern = f"[^{_MARK}]+{_MARK}"
        self.merge = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.added = {content: np.array([number], "<u4").tobytes() for content, number in added.items()}
        self.cut = re.compile(f"({'|'.join(map(re.escape, sorted(added, key=len, reverse=True)))})")

    def ids(self, text: str) -> bytes:
        parts = self.cut.split(text)
        return b"".join([self.added[part] if at % 2 else self._plain(part) for at, part in enumerate(parts)])

    def _plain(self, text: str) -> bytes:
        if not _SETTLED.fullmatch(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        # The library lowers character by character, so a sigma at the end of a word has its usual form.
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        words = _WORD.findall(lowered)
        if not words:
            return b""
        return np.array(self.merge(_MARK.join(words) + _MARK), "<u4").tobytes()


def _byte_symbols() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: visible Latin-1 characters stand for themselves."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return {chr(byte): byte for byte in visible} | {chr(256 + at): byte for at, byte in enumerate(hidden)}


_loaded: dict = {}


def word_bpe() -> WordBpe:
    """The tokenizer ``word_bpe_49k``, loaded once in a worker."""
    if "words" not in _loaded:
        import public_tokenizers

        _loaded["words"] = WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    return _loaded["words"]


class TokenFiles:
    """Token files under ``path`` and what can be read from them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        #: (part, before, tokens), one row per file.
        self.manifest = spark.read.parquet(f"{path}/manifest")

    @classmethod
    def write(
        cls, docs: DataFrame, path: str, tokenizer=word_bpe, end_id: int = 1, id_column: str = "doc_id",
        text_column: str = "text", stripe_bytes: int = 32 << 20, row_group: int = 1000,
    ) -> TokenFiles:
        """Encode ``docs``; the number of files follows from Spark's partition sizes.

        Without its manifest, which is written last, a folder counts as unfinished.
        """
        end = np.array([end_id], "<u4").tobytes()

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder, part, total = tokenizer(), TaskContext.get().partitionId(), 0
            for batch in batches:
                keys, encoded, begun, size = batch.column(0), [], 0, 0
                for at, text in enumerate(batch.column(1), 1):
                    encoded.append(encoder.ids(text.as_py()) + end)
                    size += len(encoded[-1])
                    if at == len(batch) or len(encoded) == _ROWS or size > 4 * _IDS:
                        out, total = _rows(part, total, keys.slice(begun, at - begun), encoded)
                        yield out
                        encoded, begun, size = [], at, 0

        ordered = docs.select(
            F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"),
            F.monotonically_increasing_id().alias("place"),
        ).repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
        (
            ordered.select("doc_id", "text").mapInArrow(encode, SCHEMA).write
            .option("compression", "zstd").option("orc.stripe.size", stripe_bytes)
            .option("orc.row.index.stride", row_group)
            .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01)
            .orc(f"{path}/ids")
        )
        spark = docs.sparkSession
        rows = spark.read.schema(SCHEMA).orc(f"{path}/ids")
        # One row per file, from two short columns; the ids are not read.
        sizes = sorted(rows.groupBy("part").agg(F.sum("n_tokens")).collect())
        before = np.cumsum([0, *[tokens for _, tokens in sizes]]).tolist()
        manifest = [(part, start, tokens) for (part, tokens), start in zip(sizes, before)]
        described = spark.createDataFrame(manifest, "part int, before long, tokens long")
        described.coalesce(1).write.parquet(f"{path}/manifest")
        return cls(spark, path)

    def stripes(self) -> DataFrame:
        """The files as they are; a filter on ``doc_id`` or ``first`` prunes by metadata."""
        return self.spark.read.schema(SCHEMA).orc(f"{self.path}/ids")

    def rows(self, wanted: Column | None = None) -> DataFrame:
        """(doc_id, start, ids): ``start`` counts the ids of all documents before.

        ``wanted`` is a condition on ``doc_id`` that is pushed into the scan.
        """
        found = self.stripes() if wanted is None else self.stripes().where(wanted)
        # A row per file of some MB at least: small against any memory, whatever the corpus.
        return found.join(F.broadcast(self.manifest.select("part", "before")), "part").select(
            "doc_id", (F.col("before") + F.col("first")).alias("start"), "ids"
        )

    def lookup(self, doc_ids: list[int]) -> DataFrame:
        """The rows of some documents, found by row indexes and Bloom filters."""
        return self.rows(F.col("doc_id").isin(doc_ids))

    def span(self, start: int, stop: int) -> DataFrame:
        """Rows holding any of the ids ``start`` to ``stop`` (end exclusive) of the whole stream."""
        near = self.manifest.where(f"before < {stop} AND before + tokens > {start}").collect()
        found = self.spark.createDataFrame([], "doc_id long, start long, ids array<int>")
        for part, before, _ in near if stop > start else []:
            in_file = self.stripes().where((F.col("part") == part) & (F.col("first") < stop - before))
            in_file = in_file.where(F.col("first") + F.col("n_tokens") > start - before)
            found = found.unionByName(in_file.select("doc_id", (F.col("first") + before).alias("start"), "ids"))
        return found


def _rows(part: int, total: int, keys: pa.Array, encoded: list[bytes]) -> tuple[pa.RecordBatch, int]:
    """A batch of the file's rows, and the file's ids up to its end."""
    counts = np.array([len(ids) // 4 for ids in encoded], np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    ids = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(encoded), "<i4"), pa.int32())
    )
    columns = [
        pa.array(np.full(len(counts), part, np.int32)), keys, pa.array(total + offsets[:-1], pa.int64()),
        pa.array(counts.astype(np.int32)), ids,
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "first", "n_tokens", "ids"]), total + int(offsets[-1])


def checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows (doc_id, start, ids) as they were read."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ids, bounds = lists.values.to_numpy().astype("<u4", copy=False), lists.offsets.to_numpy()
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(bounds), pa.int64()), pa.array(crcs, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return rows.mapInArrow(sums, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op11_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = TokenFiles.write(table(spark, sf_dir, "documents"), shared_path(spark, "orc-tokens"))
    return checksums(files.rows())
