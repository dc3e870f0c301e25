"""Substring removal against a plain count of word windows."""

import random
from collections import Counter

from triplens.llm import substrings


def brute(rows, width):
    windows = Counter()
    for _, text in rows:
        words = (text or "").encode().split()
        windows.update(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    out = []
    for key, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - width + 1):
            if windows[tuple(words[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((key, len(words), len(gone), kept))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, key string, hashes int")


def check(spark, rows, width):
    got = substrings.remove_repeated(frame(spark, rows), width).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got], key=repr) == brute(rows, width)
    for r in got:
        ends = r.intervals
        assert sum(ends[1::2]) - sum(ends[::2]) == r.n_removed
        assert all(a < b for a, b in zip(ends, ends[1:]))


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    passage = [f"p{i}" for i in range(50)]
    rows = []
    for key in range(60):
        words = [rng.choice("ab") + str(rng.randrange(9)) for _ in range(rng.randrange(0, 120))]
        if key % 3 == 0:
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[rng.randrange(10) :]
        rows.append((key, rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(60, None), (61, ""), (62, rows[3][1]), (3, rows[3][1]), (None, rows[6][1]), (None, "q " * 40), (63, "ä b c")]
    check(spark, rows, 5)
    monkeypatch.setattr(substrings, "CHUNK_WINDOWS", 30)
    check(spark, rows, 5)
    check(spark, rows, 35)


def test_rows_without_id_and_long_texts(spark, monkeypatch):
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(40)]
    texts = [" ".join([f"w{rng.randrange(10**6)}" for _ in range(60)] + passage) for _ in range(20)]
    rows = [(None, text) for text in texts] + [(None, texts[0])] * 30 + [(5, text) for text in texts[:4]]
    long = [f"v{rng.randrange(10**6)}" for _ in range(150_000)]
    rows += [(7, " ".join(long[:70_000] + passage + long[70_000:])), (8, "x" * 400_000)]
    check(spark, rows, 35)
    # Equal rows are answered once, and each text without an id by itself.
    found = substrings.repeated_windows(frame(spark, rows), 35).collect()
    assert len(found) == 20 + 4 + 1 and all(len(row.hashes) == 1 for row in found)
    # Copies met in chunks of their own are told the same.
    monkeypatch.setattr(substrings, "CHUNK_WINDOWS", 1)
    found = substrings.repeated_windows(frame(spark, rows[:-2]), 35).collect()
    assert len(found) == 20 + 4 and all(len(row.hashes) == 1 for row in found)


def test_empty(spark):
    assert substrings.remove_repeated(frame(spark, []), 35).count() == 0
