"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by the model's compiled character map: at each place the longest prefix
known to the map is replaced, and every normalised byte remembers the source byte it came from.
Pieces, laid end to end over the normalised text, are thereby projected to byte spans of the
original. The ids are those of the sentencepiece library: a piece never holds a space sign behind
another character (checked when a model is loaded), so the words of a text are encoded apart and
remembered.

Defined results: a null text counts as empty; an empty text has no pieces, only the begin and end
ids; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.llm.common import table
from triplens.llm.packing import Memo

SPACE = "▁"
_WORDS = re.compile(r" *[^ ]+| +")


class CharacterMap:
    """A compiled map: a double-array trie over UTF-8 bytes, then zero-ended replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes matched from ``at`` and their replacement; None if no prefix is in the map."""
        if not self.units:
            return None
        found, units = None, self.units

        def step(unit: int) -> int:
            return (unit >> 10) << ((unit & 0x200) >> 6)

        node = step(units[0])
        for end in range(at, len(data)):
            node ^= data[end]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[end]:
                break
            node ^= step(unit)
            if unit & 0x100:
                start = units[node] & 0x7FFFFFFF
                found = end + 1 - at, self.texts[start : self.texts.index(b"\0", start)]
        return found

    def apply(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each (and the end) the source byte it came from."""
        if not self.units:
            return data, np.arange(len(data) + 1)
        out, origin, at = bytearray(), [], 0
        while at < len(data):
            matched = self.longest(data, at)
            if matched is None:
                width = 1
                while at + width < len(data) and data[at + width] & 0xC0 == 0x80:
                    width += 1
                out += data[at : at + width]
                origin += range(at, at + width)
            else:
                width, new = matched
                out += new
                origin += [at] * len(new)
            at += width
        return bytes(out), np.array([*origin, len(data)])


class OffsetEncoder:
    """Ids and original byte spans by a SentencePiece model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        spec = proto.normalizer_spec
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        if not proto.trainer_spec.byte_fallback or not spec.escape_whitespaces or spec.remove_extra_whitespaces:
            raise ValueError("the model must have byte fallback, escape white space and keep all of it")
        if any(SPACE in p.piece.lstrip(SPACE) for p in proto.pieces if p.type == 1):
            raise ValueError("pieces of the model reach over words")
        if not spec.add_dummy_prefix:
            raise ValueError("the model must open each text with a space sign")
        self.map = CharacterMap(spec.precompiled_charsmap)
        # Normalised bytes of each piece: a byte piece is one, a word piece its UTF-8 length.
        self.widths = np.array(
            [1 if p.type == 6 else len(p.piece.encode()) if p.type in (1, 4) else 0 for p in proto.pieces]
        )
        encode = self.library.encode
        lone = np.array([self.library.piece_to_id(SPACE)], "<u4").tobytes()
        self.words = Memo(lambda word: np.array(encode(word), "<u4").tobytes() if word else lone)

    def ids(self, normalised: str) -> np.ndarray:
        """Piece ids of a normalised text, without begin and end."""
        if not normalised:
            return np.zeros(0, "<u4")
        plain = normalised.replace(SPACE, " ")
        if "  " in plain or plain[0] == " " or plain[-1] == " ":
            words = [word[1:] for word in _WORDS.findall(" " + plain)]
        else:
            words = plain.split(" ")
        memo = self.words
        return np.frombuffer(b"".join([memo[word] for word in words]), "<u4")

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, ends): spans in bytes of the text as UTF-8."""
        data, origin = self.map.apply(text.encode())
        ids = self.ids(data.decode() if self.map.units else text)
        if not len(ids):
            return ids, np.zeros(0, np.int64), np.zeros(0, np.int64)
        # A space is one byte of the text and three of what the pieces cover; the first sign has none.
        grown = np.where(np.frombuffer(data, np.uint8) == 32, 3, 1)
        origin = np.concatenate([np.zeros(3, np.int64), np.repeat(origin[:-1], grown), origin[-1:]])
        ends = np.cumsum(self.widths[ids])
        return ids, origin[ends - self.widths[ids]], origin[ends]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


_loaded: dict = {}


def piece_bpe() -> OffsetEncoder:
    """The model ``piece_bpe_32k``, loaded once in a worker."""
    if "model" not in _loaded:
        import public_tokenizers

        _loaded["model"] = OffsetEncoder(public_tokenizers.path("piece_bpe_32k.model"))
    return _loaded["model"]


def encode_documents(
    docs: DataFrame, model=piece_bpe, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, ids, starts, ends, decoded) of each whole text; ids have begin and end."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model()
        first, last = encoder.library.bos_id(), encoder.library.eos_id()
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, starts, ends = encoder.encode(text.as_py() or "")
                full = [first, *ids.tolist(), last]
                rows.append((key, full, starts.tolist(), ends.tolist(), encoder.decode(full)))
            names = ["doc_id", "ids", "starts", "ends", "decoded"]
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 3, pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * 5, kinds)], names
            )

    return _plain(docs, id_column, text_column).mapInArrow(
        encoded, "doc_id long, ids array<long>, starts array<long>, ends array<long>, decoded string"
    )


def encode_digests(
    docs: DataFrame, model=piece_bpe, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Digests of what :func:`encode_documents` gives, so that the ids need not leave the worker.

    (doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32): ids with begin and end, spans
    the starts, then the ends, all as little-endian unsigned 32-bit integers.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model()
        first = np.array([encoder.library.bos_id()], "<u4")
        last = np.array([encoder.library.eos_id()], "<u4")
        for batch in batches:
            rows = ([], [], [], [])
            for text in batch.column(1):
                ids, starts, ends = encoder.encode(text.as_py() or "")
                full = np.concatenate([first, ids, last])
                spans = np.concatenate([starts, ends]).astype("<u4").tobytes()
                decoded = encoder.decode(full.tolist()).encode()
                rows[0].append(len(full))
                rows[1].append(hashlib.sha256(full.tobytes()).hexdigest())
                rows[2].append(hashlib.sha256(decoded).hexdigest())
                rows[3].append(zlib.crc32(spans))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(column, kind) for column, kind in zip(rows, kinds)]],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"],
            )

    return _plain(docs, id_column, text_column).mapInArrow(
        digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long"
    )


def _plain(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))
