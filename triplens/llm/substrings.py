"""Removal of passages that repeat across documents.

Every window of ``width`` words gets a Rabin-Karp hash. The windows are counted by Spark: tasks
send the hashes of a chunk of documents to buckets of the hash range, a bucket finds the hashes
that occur twice or more and answers the chunks that sent them. A chunk sends a hash once however
often it occurs there, so a passage held by a third of all documents costs a bucket one entry a
chunk. The repeated windows of a document merge into maximal intervals, which are removed.

Hashes have 64 bits: two different windows are taken for equal with probability n**2 / 2**65.

Defined results: a null text has no words; a text of fewer words than a window stays whole;
repeated rows repeat each other and lose all covered words; ids may be null or occur twice, as
answers go by id and text (what is sent are hashes that repeat somewhere, which is right for every
row); a very long text is a chunk by itself; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.llm.common import stored, table
from triplens.llm.words import bucket_of, split, window_hashes, word_hashes

#: Windows of a chunk, which bounds the memory of a task; a longer document is a chunk by itself.
CHUNK_WINDOWS = 1_000_000
#: Bytes of text whose windows meet in one bucket, in the mean.
BUCKET_BYTES = 6_000_000


def _u8(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u8")


def _chunk_rows(keys: list[int], windows: list[np.ndarray], buckets: int) -> dict[str, list]:
    """A row per bucket for the hashes of a chunk, and one with its ids and own repeats."""
    hashes = np.concatenate(windows)
    order = np.argsort(hashes)
    places = np.repeat(np.arange(len(keys), dtype="<u2"), [len(w) for w in windows])[order]
    hashes = hashes[order]
    equal = np.concatenate([[False], hashes[1:] == hashes[:-1], [False]])
    again = equal[1:] | equal[:-1]
    ids = np.array(keys, "<i8").tobytes()
    chunk = hashlib.blake2b(ids + places.tobytes() + hashes.tobytes(), digest_size=16).hexdigest()
    once, once_at = hashes[~again], places[~again]
    many = hashes[again & ~equal[:-1]]
    cuts, many_cuts = (
        np.searchsorted(bucket_of(x, buckets), np.arange(buckets + 1)) for x in (once, many)
    )
    own = int(chunk[:12], 16) % buckets
    rows = {"bucket": [-1 - own], "chunk": [chunk], "ids": [ids],
            "places": [places[again].tobytes()], "once": [hashes[again].tobytes()], "many": [b""]}
    for b in np.flatnonzero((cuts[1:] > cuts[:-1]) | (many_cuts[1:] > many_cuts[:-1])).tolist():
        part = slice(cuts[b], cuts[b + 1])
        for name, value in (("bucket", b), ("chunk", chunk), ("ids", None), ("places", once_at[part].tobytes()),
                            ("once", once[part].tobytes()), ("many", many[many_cuts[b] : many_cuts[b + 1]].tobytes())):
            rows[name].append(value)
    return rows


def _repeated(rows: pd.DataFrame) -> pd.DataFrame:
    """What a bucket answers each chunk: the sent hashes that occur in another chunk too."""
    if rows["bucket"].iloc[0] < 0:
        return rows[["chunk", "ids", "places", "once"]]
    sent = [_u8(blob) for blob in rows["once"]]
    many = np.concatenate([_u8(blob) for blob in rows["many"]])
    hashes = np.sort(np.concatenate([*sent, many, many]))
    hashes = np.unique(hashes[1:][hashes[1:] == hashes[:-1]])
    answers = []
    for chunk, places, once in zip(rows["chunk"], rows["places"], sent):
        at = np.searchsorted(hashes, once)
        found = at < len(hashes)
        found[found] = hashes[at[found]] == once[found]
        if found.any():
            answers.append((chunk, None, np.frombuffer(places, "<u2")[found].tobytes(), once[found].tobytes()))
    return pd.DataFrame(answers, columns=["chunk", "ids", "places", "once"])


def _by_document(rows: pd.DataFrame) -> pd.DataFrame:
    """The answers of one chunk, dealt out to its documents."""
    keys = np.frombuffer(next(blob for blob in rows["ids"] if blob is not None), "<i8")
    places = np.concatenate([np.frombuffer(blob, "<u2") for blob in rows["places"]])
    hashes = np.concatenate([_u8(blob) for blob in rows["once"]])
    order = np.argsort(places, kind="stable")
    places, hashes = places[order], hashes[order]
    cuts = np.searchsorted(places, np.arange(len(keys) + 1))
    held = np.flatnonzero(cuts[1:] > cuts[:-1])
    return pd.DataFrame({
        "key": keys[held], "hashes": [np.unique(hashes[cuts[d] : cuts[d + 1]]).tobytes() for d in held.tolist()]
    })


def _key(id_column: str, text_column: str) -> Column:
    """Equal only for rows of equal id and text, which have the same repeated windows."""
    return F.xxhash64(F.col(id_column).cast("long"), text_column)


def repeated_windows(docs: DataFrame, width: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(key, hashes): for each id and text, the hashes of its windows that start twice or more."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(-(-size // BUCKET_BYTES), 3 * partitions)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int] = []
        windows: list[np.ndarray] = []
        held = 0
        kinds = [pa.int64(), pa.string(), *[pa.binary()] * 4]

        def flush():
            rows = _chunk_rows(keys, windows, buckets)
            arrays = [pa.array(column, kind) for column, kind in zip(rows.values(), kinds)]
            return pa.RecordBatch.from_arrays(arrays, list(rows))

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = window_hashes(word_hashes(split(text.as_py())), width)
                if len(found):
                    keys.append(key)
                    windows.append(found)
                    held += len(found)
                    if held >= CHUNK_WINDOWS or len(keys) == 65535:
                        yield flush()
                        keys, windows, held = [], [], 0
        if keys:
            yield flush()

    sent = docs.select(_key(id_column, text_column).alias("key"), F.col(text_column).alias("text")).mapInArrow(
        send, "bucket long, chunk string, ids binary, places binary, once binary, many binary"
    )
    answers = sent.groupBy("bucket").applyInPandas(
        _repeated, "chunk string, ids binary, places binary, once binary"
    )
    found = answers.groupBy("chunk").applyInPandas(_by_document, "key long, hashes binary")
    return found.groupBy("key").agg(F.collect_set("hashes").alias("hashes"))


def intervals_of(text: str | None, repeated: list[bytes] | None, width: int) -> tuple[list[bytes], np.ndarray]:
    """Words of a text and the maximal intervals (start, end) that its repeated windows cover."""
    words = split(text)
    if not repeated:
        return words, np.zeros((0, 2), np.int64)
    starts = np.flatnonzero(
        np.isin(window_hashes(word_hashes(words), width), np.concatenate([_u8(x) for x in repeated]))
    )
    if not len(starts):
        return words, np.zeros((0, 2), np.int64)
    # A gap opens where a window starts behind the end of the one before.
    opens = np.concatenate([[True], starts[1:] > starts[:-1] + width])
    closes = np.concatenate([opens[1:], [True]])
    return words, np.stack([starts[opens], starts[closes] + width], 1)


def remove_repeated(
    docs: DataFrame, width: int = 35, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_removed, intervals, kept) of each row of ``docs``.

    ``intervals`` holds start and end of each removed interval in words, one after the other;
    ``kept`` the other words joined by one space.
    """
    repeated = stored(repeated_windows(docs, width, id_column, text_column), "repeated")
    plain = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"),
        _key(id_column, text_column).alias("key"),
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ([], [], [], [])
            for text, hashes in zip(batch.column(1), batch.column(2)):
                words, intervals = intervals_of(text.as_py(), hashes.as_py(), width)
                kept, end = [], 0
                for start, stop in intervals.tolist():
                    kept += words[end:start]
                    end = stop
                kept += words[end:]
                for column, value in zip(rows, (len(words), len(words) - len(kept), intervals.ravel(), b" ".join(kept))):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            columns = [pa.array(column, kind) for column, kind in zip(rows, kinds)]
            columns[3] = columns[3].cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", "n_words", "n_removed", "intervals", "kept"]
            )

    return plain.join(repeated, "key", "left").select("doc_id", "text", "hashes").mapInArrow(
        remove, "doc_id long, n_words long, n_removed long, intervals array<long>, kept string"
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = remove_repeated(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
