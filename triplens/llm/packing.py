"""Packing token sequences: first-fit decreasing in randomised groups.

Documents become token ids, are cut into pieces of at most ``capacity`` ids, and the pieces are
dealt at random into groups of a stated mean size. Each group is packed on its own by first-fit
decreasing, where a tournament tree over the free space of its bins finds the first bin with room
in logarithmic time. A group is one small task, so the plan is the same at any size.

Defined results: a null or empty text is the closing id alone; repeated rows are packed each on
their own; an empty table gives no rows; a null id is kept as null; other columns are not looked at.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.llm.common import stored, table


class Memo(dict):
    """Byte strings of ``make`` by key, of at most ``limit`` bytes with all that Python adds to an entry.

    It is emptied when it is full. Keys over 64 characters, such as whole texts written without
    spaces, hardly recur and are not remembered.
    """

    def __init__(self, make, limit: int = 24 << 20):
        super().__init__()
        self.make, self.limit, self.used = make, limit, 0

    def __missing__(self, key):
        value = self.make(key)
        if len(key) > 64:
            return value
        size = 250 + 4 * len(key) + len(value)  # a slot of the table, the heads of two objects, their contents
        if self.used + size > self.limit:
            self.clear()
            self.used = 0
        self.used += size
        self[key] = value
        return value


class ByteBpe:
    """Ids of a byte-level BPE vocabulary as little-endian unsigned 32-bit integers.

    ``ranks_path`` holds the ranks of the same vocabulary as the JSON file of the ``tokenizers``
    library; the ids of texts without added tokens are equal to that library's (tests compare
    them), at several times its speed. ``AddedTokens`` puts the added tokens in. A text is encoded in one
    call: to look its words up in a table costs more than to merge them, where many of them are rare.
    """

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encoding = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.encode = encoding.encode_ordinary

    def ids(self, text: str) -> bytes:
        ids = self.encode(text)
        return struct.pack(f"<{len(ids)}I", *ids)


class AddedTokens:
    """``inner`` with the added tokens of a tokenizer's JSON file, as the ``tokenizers`` library has them.

    The leftmost and there the longest token counts; the parts between are encoded on their own.
    """

    def __init__(self, inner: ByteBpe, json_path: str):
        with open(json_path, encoding="utf-8") as file:
            described = json.load(file)
        added = described["added_tokens"]
        if described["normalizer"] or any(token[kind] for token in added for kind in ("single_word", "lstrip", "rstrip")):
            raise ValueError("only added tokens that are found as they are written can be used")
        self.inner = inner
        self.added = {token["content"]: np.array([token["id"]], "<u4").tobytes() for token in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if added else None

    def ids(self, text: str) -> bytes:
        parts = self.cut.split(text) if self.cut else [text]
        if len(parts) == 1:
            return self.inner.ids(text)
        # Every second part is an added token.
        return b"".join([self.added[part] if k % 2 else self.inner.ids(part) if part else b"" for k, part in enumerate(parts)])


_loaded: dict = {}


def byte_bpe() -> ByteBpe:
    """The vocabulary ``byte_bpe_50k`` without its added tokens, loaded once in a worker."""
    if "bpe" not in _loaded:
        import public_tokenizers

        _loaded["bpe"] = ByteBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return _loaded["bpe"]


def whole_bpe() -> AddedTokens:
    """The tokenizer ``byte_bpe_50k``, added tokens and all, loaded once in a worker."""
    if "whole" not in _loaded:
        import public_tokenizers

        _loaded["whole"] = AddedTokens(byte_bpe(), public_tokenizers.path("byte_bpe_50k.json"))
    return _loaded["whole"]


def pieces_of(
    docs: DataFrame, capacity: int, tokenizer=whole_bpe, end_id: int = 0,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens), one row per piece of each whole text."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer()
        for batch in batches:
            keys, rows = batch.column(0), ([], [], [], [], [])
            for at, text in enumerate(batch.column(1)):
                ids = encoder.ids(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    length = min(capacity, total - start)
                    piece = ids[4 * start : 4 * (start + length)]
                    for column, value in zip(rows, (at, start, length, zlib.crc32(piece), total)):
                        column.append(value)
            columns = [pa.array(column, pa.int64()) for column in rows]
            yield pa.RecordBatch.from_arrays(
                [keys.take(columns[0]), *columns[1:]],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return plain.mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    )


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length.

    The tree's leaves are the free spaces of the bins and each inner node the larger of its two
    children; going down to the left whenever the left child has room ends at the first bin.
    """
    count = len(lengths)
    leaves = 1 << max(0, int(count - 1).bit_length())
    free = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(count, np.int64), np.zeros(count, np.int64)
    for at in np.argsort(-lengths, kind="stable").tolist():
        length, node = int(lengths[at]), 1
        while node < leaves:
            node *= 2
            if free[node] < length:
                node += 1
        bins[at], offsets[at] = node - leaves, capacity - free[node]
        free[node] -= length
        node //= 2
        while node:
            larger = max(free[2 * node], free[2 * node + 1])
            if free[node] == larger:
                break
            free[node] = larger
            node //= 2
    return bins, offsets


def padded_length(used: int, capacity: int) -> int:
    """Ids of a stored sequence: it is padded to ``capacity`` unless it fills a power of two."""
    return used if used & (used - 1) == 0 else capacity


#: Ids of sequences that one full piece makes start here, above those of all groups.
_FULL = 1 << 62


def pack(pieces: DataFrame, capacity: int, group_size: int = 4096) -> DataFrame:
    """``pieces`` (a stored table with a ``length``) with sequence_id, offset and padded_length.

    A full piece is a sequence by itself and is not shuffled. What is left is at most one piece a
    document, its tail, so groups are of documents: ``group_size`` of them in the mean. A tail's group is a
    hash of its place in the table, so neither equal rows nor equal ids meet in one group.
    """
    full = pieces.where(F.col("length") == capacity).select(
        "*", (F.lit(_FULL) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(padded_length(capacity, capacity)).cast("long").alias("padded_length"),
    )
    tails = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-tails.count() // group_size))
    dealt = tails.withColumn(
        "_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("long")
    )

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        bins, offsets = first_fit_decreasing(part["length"].to_numpy(), capacity)
        used = np.bincount(bins, weights=part["length"].to_numpy()).astype(np.int64)
        part["sequence_id"] = part["_group"].to_numpy() * (1 << 32) + bins
        part["offset"] = offsets
        part["padded_length"] = [padded_length(int(used[b]), capacity) for b in bins]
        part["doc_id"] = part["doc_id"].astype("Int64")
        return part.drop(columns="_group")

    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in pieces.schema.fields)
    packed = dealt.groupBy("_group").applyInPandas(
        fill, f"{schema}, sequence_id long, offset long, padded_length long"
    )
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, capacity: int = 1024, group_size: int = 4096) -> DataFrame:
    """Pieces of all documents with the sequence and the place in it that each got."""
    return pack(stored(pieces_of(docs, capacity), "pieces"), capacity, group_size)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
