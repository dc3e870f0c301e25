"""Token operators against the libraries they stand for, and against a plain first fit."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from triplens.llm import packing, pieces

ODD_TEXTS = [
    "", " ", "  ", "a", " a", "a ", "  a  b ", "a\n b\n\n c\t d", "x  \n  y", "it's we'll  don't",
    "▁ a▁▁b", "été — naïve　ideographic nbsp", "<s> </s> <unk> <|endoftext|>", "😀 a 😀😀b‍",
    "12 345.6 -7", "\x00\x01 \x1c\x1d a\x85b", "a" * 5000, " " * 300 + "z", "é ﬁ ½ Ⅳ", "words " * 900,
]


def test_byte_bpe_equals_tokenizers():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    mine = packing.byte_bpe()
    for text in ODD_TEXTS:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(mine.ids(text), "<u4").tolist() == want, text


def test_added_tokens_equal_tokenizers(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [*ODD_TEXTS, f"a {end} b", end, end * 3, f" {end}  {end}\n", f"x{end}y", f"<|endof{end}text|>", "<|ENDOFTEXT|>", f"a  {end[:-1]} {end} b's"]
    mine = packing.whole_bpe()
    want = {text: library.encode(text, add_special_tokens=False).ids for text in texts}
    assert want[f"a {end} b"] == [64, 220, 50256, 275]
    for text in texts:
        assert np.frombuffer(mine.ids(text), "<u4").tolist() == want[text], text
    docs = frame(spark, [(i, t, "clash", 1, None) for i, t in enumerate(texts)])
    tokens = {r.doc_id: r.doc_tokens for r in packing.pack_documents(docs).collect()}
    assert [tokens[i] for i in range(len(texts))] == [len(want[t]) + 1 for t in texts]


def test_byte_bpe_encodes_a_text_at_once(monkeypatch):
    """A call a text, not one for each new word of it; long runs of rare words and white space included."""
    import tiktoken

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    calls, plain = [], tiktoken.Encoding.encode_ordinary

    def counted(self, text):
        calls.append(text)
        return plain(self, text)

    monkeypatch.setattr(tiktoken.Encoding, "encode_ordinary", counted)
    mine = packing.ByteBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [" ".join(f"w{i * 7919:x}q" for i in range(3000)), "a \n  b\t" * 500, "x" * 70 + " y " * 400, ""]
    for text in texts:
        assert np.frombuffer(mine.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert calls == texts


def test_pieces_equal_sentencepiece():
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    mine = pieces.piece_bpe()
    for text in ODD_TEXTS:
        ids, starts, ends = mine.encode(text)
        assert ids.tolist() == library.encode(text), text
        data = text.encode()
        # The spans follow each other and cover the text; each shows the piece's own characters.
        assert ends.tolist()[:-1] == starts.tolist()[1:] and (not len(ids) or (starts[0], ends[-1]) == (0, len(data)))
        for i, a, b in zip(ids.tolist(), starts, ends):
            piece = library.id_to_piece(i)
            if not library.is_byte(i):
                source = data[a:b].decode().replace(" ", "▁")
                assert piece == source or (a == 0 and piece == "▁" + source), (piece, source)


def unit(label, leaf, offset):
    return label | (0x100 if leaf else 0) | offset << 10


def test_character_map_takes_longest_prefix():
    """A trie for a -> X, ab -> YZ, laid out by hand."""
    units = [0] * 512
    units[0] = unit(0, False, 1)          # the root's children lie around 1
    node_a = 1 ^ ord("a")
    units[node_a] = unit(ord("a"), True, 8)
    base_a = node_a ^ 8
    units[base_a] = 0x80000000 | 0        # value of "a"
    node_ab = base_a ^ ord("b")
    units[node_ab] = unit(ord("b"), True, 4)
    units[node_ab ^ 4] = 0x80000000 | 2   # value of "ab"
    trie = np.array(units, "<u4").tobytes()
    blob = np.array([len(trie)], "<u4").tobytes() + trie + b"X\0YZ\0"
    out, origin = pieces.CharacterMap(blob).apply("abaéa".encode())
    assert out.decode() == "YZXéX"
    assert origin.tolist() == [0, 0, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_compiled_maps_equal_the_library(rule):
    """The library's own maps of some 10**5 bytes: normalised text and the source of each character."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False)
    spec = sentencepiece_model_pb2.NormalizerSpec.FromString(library.serialized_normalizer_spec())
    assert len(spec.precompiled_charsmap) > 100_000
    mine = pieces.CharacterMap(spec.precompiled_charsmap)
    texts = [*ODD_TEXTS, "ﬁ ½ Ⅳ　ｱﾞ ガ e\u0301 Å ẞ", "".join(map(chr, range(0x20, 0xD800, 7))), "한국어 ﷺ 𝔘𝔫𝔦 " * 50]
    for text in texts:
        want, at = library.normalize(text, with_offsets=True)
        out, origin = mine.apply(text.encode())
        assert out.decode() == want, text
        # The library counts characters; of ours, the first byte of each normalised character is looked at.
        place = {len(text[:i].encode()): i for i in range(len(text) + 1)} if len(text) < 2000 else None
        if place is not None:
            heads = np.flatnonzero((np.frombuffer(out, np.uint8) & 0xC0) != 0x80)
            assert [place[o] for o in origin[heads].tolist()] == list(at[: len(heads)]), text


def plain_first_fit(lengths, capacity):
    free, where = [], {}
    for at in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        for b, room in enumerate(free):
            if room >= lengths[at]:
                break
        else:
            free.append(capacity)
            b = len(free) - 1
        where[at] = (b, capacity - free[b])
        free[b] -= lengths[at]
    return [where[i] for i in range(len(lengths))]


@pytest.mark.parametrize("count", [1, 2, 3, 64, 257])
def test_first_fit_decreasing(count):
    lengths = np.random.default_rng(count).integers(1, 1025, count)
    bins, offsets = packing.first_fit_decreasing(lengths, 1024)
    assert list(zip(bins.tolist(), offsets.tolist())) == plain_first_fit(lengths.tolist(), 1024)


def test_padded_length():
    assert [packing.padded_length(n, 1024) for n in (1, 3, 512, 513, 1024)] == [1, 1024, 512, 1024, 1024]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, length string, start int, ids string")


def test_packing_of_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "word " * 3000), (3, "word " * 3000), (None, "a b"), *[(i, "x y z") for i in range(9, 60)]]
    docs = frame(spark, [(k, t, "clash", 1, None) for k, t in rows])
    got = packing.pack_documents(docs, group_size=16).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.length for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_packed_ids_equal_tokenizers(spark):
    """Start, length and CRC of every piece, cut from the ids of the library; only full pieces stand alone."""
    texts = [*ODD_TEXTS, "word <|endoftext|> " * 1500, "a b " * 511 + "a", None]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack_documents(frame(spark, [(i, t, "c", 1, "") for i, t in enumerate(texts)]), group_size=8).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    for at, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        rows = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got if r.doc_id == at)
        cuts = [ids[i : i + 1024] for i in range(0, len(ids), 1024)]
        assert rows == [(1024 * i, len(c), zlib.crc32(c.tobytes()), len(ids)) for i, c in enumerate(cuts)], at
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append(r.length)
    assert all(sum(parts) <= 1024 for parts in used.values()) and all(len(parts) == 1 for parts in used.values() if 1024 in parts)


def test_digests_equal_sentencepiece(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = [*ODD_TEXTS, None, "long words here " * 20_000]
    got = {r.doc_id: r for r in pieces.encode_digests(frame(spark, [(i, t, "c", 1, "") for i, t in enumerate(texts)])).collect()}
    for at, text in enumerate(texts):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), library.decode(ids).encode())]
        assert (got[at].n_tokens, got[at].ids_sha256, got[at].decoded_sha256) == (len(ids), *want), text


def test_encoding_of_edge_rows(spark):
    docs = frame(spark, [(1, None, "c", 1, ""), (2, "", "c", 1, ""), (None, "a  b", "c", 1, ""), (None, "a  b", "c", 1, "")])
    got = pieces.encode_documents(docs).collect()
    assert sorted((r.ids, r.decoded) for r in got)[:2] == [([1, 2], ""), ([1, 2], "")]
    assert [r.decoded for r in got if r.doc_id is None] == ["a  b"] * 2
    assert pieces.encode_digests(docs).count() == 4 and pieces.encode_digests(docs.limit(0)).count() == 0
