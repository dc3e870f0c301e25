"""The prefix trie against a trie of nested dictionaries."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from triplens.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, id string, key int, turns double"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(sequences):
    """Nodes of {id: [(role, text), ...]}, by prefixes."""
    members = {}
    for key, turns in sequences.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(key)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children.get(prefix, [])
        leaves[prefix] = sum(leaves[c] for c in below) if below else 1
        saved[prefix] = sum(saved[c] for c in below) + ((len(members[prefix]) - 1) * len(prefix[-1][1]) if prefix else 0)
    out = []
    for prefix, ids in members.items():
        ended = ",".join(str(i) for i in sorted(ids) if len(sequences[i]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        below = len(children.get(prefix, []))
        out.append((min(ids), len(prefix), parent, len(ids), below, leaves[prefix], saved[prefix], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out)


def rebuilt(rows):
    own = {}
    for key, turn, role, text in rows:
        if key is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(key, []).append((turn is not None, turn or 0, digest[:32], role, text))
    own = {key: [(role, text) for *_, role, text in sorted(turns)] for key, turns in own.items()}
    out = {}
    for key, turns in own.items():
        head = zlib.crc32(str(key).encode()) % 6
        lead = key - (abs(key) % 100 if key >= 0 else -(abs(key) % 100))
        out[key] = own.get(lead, [])[:head] + turns[head:]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*row, "clash", 1, 2.0) for row in rows], SCHEMA).repartition(3)


def nodes(spark, rows, rebuild=True):
    lists = trie.turn_lists(frame(spark, rows))
    if rebuild:
        lists = trie.with_shared_starts(lists, 100, 5, F.crc32(F.col("id").cast("string").cast("binary")) % 6)
    got = trie.prefix_trie(trie.keyed(lists))
    assert got.columns == NODE
    rows = [tuple(r) for r in got.collect()]
    assert len({r[:2] for r in rows}) == len(rows)
    return sorted(rows)


@pytest.fixture
def many_parts(spark, monkeypatch):
    """Rows dealt over 13 partitions, whose forests are merged two by two."""
    monkeypatch.setattr(trie, "FAN_IN", 2)
    monkeypatch.setattr(trie, "_ENDS_BYTES", 60)
    monkeypatch.setattr(trie, "_CHUNK", 7)
    conf = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def turns_of(sequences):
    return [(key, at, role, text) for key, turns in sequences.items() for at, (role, text) in enumerate(turns)]


@pytest.mark.parametrize("seed", range(4))
def test_random_sequences_over_many_parts(spark, many_parts, seed):
    """Copies and shared starts reach over the boundaries of partitions."""
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdef"
    sequences = {key: [("u", rng.choice(letters) * 3) for _ in range(rng.randrange(1, 9))] for key in range(150)}
    for key in range(150, 400):
        sequences[key] = sequences[rng.randrange(3)]
    assert nodes(spark, turns_of(sequences), rebuild=False) == brute(sequences)


def test_chain_and_one_start(spark, many_parts):
    """Each sequence is a start of the next one, and all have one long start."""
    start = [("u", f"common {i}") for i in range(30)]
    chain = {key: start + [("a", "more")] * key for key in range(60)}
    assert nodes(spark, turns_of(chain), rebuild=False) == brute(chain)
    reverse = {60 - key: turns for key, turns in chain.items()}
    assert nodes(spark, turns_of(reverse), rebuild=False) == brute(reverse)


def test_rebuilt_with_odd_rows(spark, many_parts):
    """Null ids, turns, roles and texts, repeated rows, negative ids, absent leads, turnless conversations, a long text."""
    rng = random.Random(9)
    rows = [(key, turn, rng.choice(["user", "assistant", None]), rng.choice(["hi", "yes", "", None, "é😀"]))
            for key in [*range(0, 40), *range(100, 130), *range(250, 260), -1, -150, -100, 7000] for turn in range(rng.randrange(1, 9))]
    rows += rows[:20] + [(3, None, "user", "first"), (None, 0, "user", "no id"), (None, None, None, None), (5, 2, "user", "tie"), (5, 2, "user", "other")]
    rows += [(8, 9, "user", "long " * 200_000), (301, 0, "user", "alone")]
    want = rebuilt(rows)
    assert any(not turns for turns in want.values())
    assert nodes(spark, rows) == brute(want)


def test_empty(spark):
    assert nodes(spark, []) == [] and nodes(spark, [(None, 1, "user", "x")]) == []
    assert nodes(spark, [(5, 1, "user", "x")], rebuild=False) == brute({5: [("user", "x")]})
