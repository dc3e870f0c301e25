"""Archives: round trip, revisits by brute force, and damage that must cost no other record."""

import gzip
import random
import shutil

from pyspark.sql import functions as F

from triplens.llm import warc


def brute(rows, min_bytes):
    best = {}
    for key, _, html in rows:
        data = (html or "").encode()
        if key is not None and len(data) >= min_bytes:
            best[data] = max(best.get(data, key), key)
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        first = best.get(data, key)
        refers = None if first == key else first
        out.append((key, len(data), warc.sha1_base32(data), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/é\r\nx", "<p>one</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>one</p>"), (4, "u", "<p>one</p>"),
    (None, "u", "<p>one</p>"), (None, "u", "only"), (9, "u", "x" * 300_000), (10, "u", "WARC/1.1\r\n\r\n\x1f\x8b é"), (11, "u", "\r\n\r\n"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, payload string")


def results(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted([tuple(r[n] for n in names) for r in df.where("gap IS NULL").collect()], key=repr)


def test_round_trip(spark, tmp_path):
    for at, min_bytes in enumerate((0, 5)):
        path = str(tmp_path / str(at))
        warc.write_archives(frame(spark, ROWS), path, min_bytes, records_per_file=3)
        read = warc.read_archives(spark, path, payloads=True)
        assert results(read) == brute(ROWS, min_bytes)
        assert read.where("gap IS NOT NULL").count() == 0
        texts = {r.page_id: bytes(r.payload).decode() for r in read.where("record_type = 'response'").collect()}
        assert texts[10] == ROWS[8][2] and texts[9] == ROWS[7][2]
    path = str(tmp_path / "empty")
    warc.write_archives(frame(spark, []), path)
    assert warc.read_archives(spark, path).count() == 0


def test_very_long_urls(spark, tmp_path):
    urls = ["data:text/html," + "a" * 70_000, "http://a/" + "日" * 8_000, "u" * 3_000_000, "WARC/1.1\r\n" * 9_000, "u"]
    rows = [(i, url, f"page {i}") for i, url in enumerate(urls)]
    path = str(tmp_path / "long")
    warc.write_archives(frame(spark, rows), path)
    read = warc.read_archives(spark, path)
    assert results(read) == brute(rows, 0) and read.where("gap IS NOT NULL").count() == 0
    assert {r.page_id: len(r.url) for r in read.collect()}[0] == len(urls[0])


def test_long_headers_and_damage_in_plain_files():
    parts = [warc.record(i, "u" * 100_000, b"x", None, warc.sha1_base32(b"x"), "2020-01-01T00:00:00Z") for i in range(4)]
    for cut in (40, 90_000, len(parts[0]) - 3):
        got = list(warc.salvage(parts[0] + parts[1][:cut] + parts[2] + parts[3]))
        assert [warc._urn(f["warc-record-id"]) for _, _, f, _ in got if f is not None] == [0, 2, 3]
    # Each search for the end of a header stops at the next version line.
    got = list(warc.salvage(b"WARC/1.1\r\na: b\r\n" * 100_000))
    assert len(got) == 1 and got[0][2] is None


def test_files_are_chains_of_members(spark, tmp_path):
    warc.write_archives(frame(spark, ROWS).coalesce(1), str(tmp_path / "x"))
    for file in (tmp_path / "x").glob("part-*"):
        assert gzip.decompress(file.read_bytes()).startswith(b"WARC/1.1\r\n")


def chain(count, plain):
    parts = []
    for i in range(count):
        body = f"page {i} ".encode() * (20 + i)
        whole = warc.record(i, f"u{i}", body, None, warc.sha1_base32(body), "2020-01-01T00:00:00Z")
        parts.append(whole if plain else gzip.compress(whole, mtime=0))
    return parts


def test_damage_costs_only_what_it_hits():
    rng = random.Random(7)
    for plain in (True, False):
        for _ in range(60):
            parts = chain(8, plain)
            hit = rng.randrange(8)
            part = bytearray(parts[hit])
            kind = rng.randrange(3)
            if kind == 0:
                at = rng.randrange(30, len(part) - 12) if not plain else part.index(b"page %d" % hit) + rng.randrange(40)
                part[at] ^= 0x15
            elif kind == 1:
                part = part[: len(part) // 2]
            else:
                part = part + b"\0junk" * rng.randrange(1, 9)
            parts[hit] = bytes(part)
            data = b"".join(parts)
            got = list(warc.salvage(data))
            kept = {warc._urn(f["warc-record-id"]) for _, _, f, _ in got if f is not None}
            assert kept >= set(range(8)) - {hit}, (plain, kind)
            gaps = [(a, b) for a, b, f, _ in got if f is None]
            start = sum(map(len, parts[:hit]))
            assert gaps, (plain, kind, hit, kept)
            assert all(start <= a < b <= start + len(part) for a, b in gaps)
            # Records and gaps cover the file without holes.
            ends = sorted({(a, b) for a, b, _, _ in got})
            assert ends[0][0] == 0 and ends[-1][1] == len(data)
            assert all(x[1] == y[0] for x, y in zip(ends, ends[1:]))


def kept(got):
    return [warc._urn(f["warc-record-id"]) for _, _, f, _ in got if f is not None]


def test_damage_in_a_member_of_several_records():
    plain = chain(5, True)
    before, after = gzip.compress(chain(1, True)[0], mtime=0), gzip.compress(plain[4], mtime=0)
    bad = bytearray(plain[1])
    bad[bad.index(b"page 1")] ^= 1
    # A record with a wrong digest in a sound member costs no other record.
    member = gzip.compress(b"".join([plain[0], bytes(bad), *plain[2:]]), mtime=0)
    got = list(warc.salvage(before + member + after))
    assert kept(got) == [0, 0, 2, 3, 4, 4]
    gaps = [g for g in got if g[2] is None]
    assert [g[:2] for g in gaps] == [(len(before), len(before) + len(member))]
    assert gaps[0][3].startswith(f"bytes {len(plain[0])} to {len(plain[0]) + len(bad)} of")
    # A member cut short, at the end of the file or before another one, keeps what was inflated.
    member = gzip.compress(b"".join(plain), mtime=0)
    for tail in (b"", after):
        got = list(warc.salvage(before + member[:-12] + tail))
        assert kept(got)[:6] == [0, 0, 1, 2, 3, 4][: len(kept(got))] and len(kept(got)) >= 5
        assert [g[:2] for g in got if g[2] is None] == [(len(before), len(before) + len(member) - 12)]
    # A wrong CRC leaves the records that pass their own digests, and none without one.
    wrong = bytearray(member)
    wrong[-6] ^= 1
    assert kept(list(warc.salvage(bytes(wrong) + after))) == [0, 1, 2, 3, 4, 4]
    bare = b"WARC/1.1\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    wrong = bytearray(gzip.compress(bare, mtime=0))
    assert len([f for _, _, f, _ in warc.salvage(bytes(wrong)) if f is not None]) == 1
    wrong[-6] ^= 1
    assert [f for _, _, f, _ in warc.salvage(bytes(wrong))] == [None]


def test_rows_of_a_damaged_member(spark, tmp_path):
    folder = tmp_path / "z"
    folder.mkdir()
    member = gzip.compress(b"".join(chain(5, True)), mtime=0)
    (folder / "part-00000").write_bytes(member[:-12] + gzip.compress(chain(1, True)[0], mtime=0))
    rows = warc.read_archives(spark, str(folder)).where("gap IS NULL").select("page_id", "damaged_member").collect()
    assert (0, False) in map(tuple, rows) and [r.page_id for r in rows if r.damaged_member][:4] == [0, 1, 2, 3]


def test_gaps_are_logged(spark, tmp_path):
    path = tmp_path / "x"
    warc.write_archives(frame(spark, [(i, "u", f"page {i} " * 50) for i in range(20)]).coalesce(1), str(path))
    file = next(path.glob("part-*"))
    data = bytearray(file.read_bytes())
    data[len(data) // 2 : len(data) // 2 + 9] = b"\0" * 9
    copy = tmp_path / "y"
    copy.mkdir()
    (copy / "part-00000").write_bytes(bytes(data))
    read = warc.read_archives(spark, str(copy))
    assert read.where("gap IS NULL").count() == 19
    gap = read.where("gap IS NOT NULL").select(F.min("start"), F.max("end")).first()
    assert 0 < gap[0] < len(data) // 2 < gap[1] < len(data)
    shutil.rmtree(copy)
