"""Exact and near duplicates against brute force."""

import hashlib
import random

import pytest
from brute import components, normal, ngrams

from triplens.llm import exact, jaccard
from triplens.llm.common import stored
from triplens.llm.components import components as spark_components

SCHEMA = "doc_id long, text string, v long, c string, digest int"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, 1, "x", 2) for k, t in rows], SCHEMA).repartition(3)


def corpus(seed, many=40):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnop") + str(rng.randrange(60))
    passage = [word() for _ in range(30)]
    rows = []
    for _ in range(many):
        words = [word() for _ in range(rng.randrange(1, 90))]
        if rng.random() < 0.5:
            words += passage[: rng.randrange(5, 30)]
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.randrange(3)):  # chains of near copies
            words = list(words)
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = word()
            rows.append((len(rows), rng.choice([" ", "\n\t"]).join(words).replace("a", rng.choice("aA"))))
    base = [word() for _ in range(120)]
    for _ in range(60):  # one large group of near copies
        words = list(base)
        words[rng.randrange(120)] = word()
        rows.append((len(rows), " ".join(words)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \t "), (len(rows) + 3, "one two"), (len(rows) + 4, "One  two")]
    rows += [rows[0], (None, rows[1][1]), (None, "alone here with no id at all"), (None, "")]
    return rows


def check(spark, rows):
    got = jaccard.similarity_classes(frame(spark, rows)).collect()
    reached, sizes = components(rows)
    # Rows that repeat an id with its text have equal results, so the sorted lists tell all.
    want = sorted(((k, s, c if s else k) for (k, _), c, s in zip(rows, reached, sizes)), key=repr)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == want


def test_classes(spark):
    check(spark, corpus(1))


@pytest.mark.parametrize("rounds", [0, 1])
def test_classes_with_frequent_ngrams_and_leaders(spark, monkeypatch, rounds):
    """Without leaders the positional bound alone decides what is compared; a very long text takes part."""
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    monkeypatch.setattr(jaccard, "CHUNK_GRAMS", 1500)
    monkeypatch.setattr(jaccard, "PAIRS_PER_MEMBER", 0)
    monkeypatch.setattr(jaccard, "LEADER_ROUNDS", rounds)
    rows = corpus(2, 20)
    long = " ".join(f"w{i % 7919}" for i in range(60_000))
    check(spark, rows + [(1000, long), (1001, long + " end"), (999, "other " + long)])


def test_positional_bound_keeps_links():
    """Behind the last shared n-gram of two prefixes, sets share no more than the smaller rest."""
    rng = random.Random(8)
    import numpy as np

    for _ in range(300):
        a = {rng.randrange(10**6) for _ in range(rng.randrange(1, 60))}
        b = {x if rng.random() < 0.95 else rng.randrange(10**6) for x in a}
        late = np.array(sorted(rng.sample(sorted(a | b), len(a | b) // 3)), np.uint64)
        order = jaccard.Order(late, np.array([rng.randrange(5) for _ in late]))
        x, y = (order.prefix(np.array(sorted(s), np.uint64), 80).tolist() for s in (a, b))
        shared = set(x) & set(y)
        if shared:
            most = len(shared) + min(len(a) - max(map(x.index, shared)), len(b) - max(map(y.index, shared))) - 1
            assert len(a & b) <= most


def test_sketches_differ_at_most_as_sets_do():
    rng = random.Random(9)
    import numpy as np

    for _ in range(300):
        a = {rng.getrandbits(64) for _ in range(rng.randrange(1, 900))}
        b = {x if rng.random() < 0.9 else rng.getrandbits(64) for x in a}
        x, y = (jaccard.sketch(np.array(sorted(s), np.uint64)) for s in (a, b))
        assert len(x) * 64 == jaccard.SKETCH
        assert sum(((i ^ j) & (1 << 64) - 1).bit_count() for i, j in zip(x, y)) <= len(a ^ b)


def near_but_unlinked(many):
    """Copies of one text that each lack other words of it: any two share about two thirds of their n-grams."""
    rng = random.Random(10)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for k in range(many):
        words = list(base)
        for at in rng.sample(range(2, 398, 6), 8):
            words[at] = f"own{k}x{at}"
        rows.append((k, " ".join(words)))
    return rows


def test_near_copies_that_do_not_link_form_no_pairs(spark, monkeypatch):
    """The last round's pairs are far fewer than those that share most n-grams; the classes are those of the full join."""
    monkeypatch.setattr(jaccard, "LEADER_ROUNDS", 0)
    formed, plain = [], jaccard._pairs

    def counted(joined, *args):
        formed.append(joined.count())
        return plain(joined, *args)

    monkeypatch.setattr(jaccard, "_pairs", counted)
    rows = near_but_unlinked(60)
    check(spark, rows)
    assert sum(formed) < 60 * 59 / 2 / 10
    # A link costs rows only where the n-grams of one prefix begin to be those of the other again.
    formed.clear()
    check(spark, [(0, rows[0][1]), (1, rows[0][1].replace("b200", "c")), (2, rows[0][1].replace("b300", "d"))])
    assert 3 <= sum(formed) <= 12


def test_vertices_get_their_classes_once_a_round(spark, monkeypatch):
    """However many near copies there are, a round joins the labels to a row per vertex once, and the result once more."""
    joins, rounds, mixed = [], [], jaccard._mixed

    def counted(df, name):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter"))
        return stored(df, name)

    monkeypatch.setattr(jaccard, "stored", counted)
    monkeypatch.setattr(jaccard, "_mixed", lambda held, k: rounds.append(k) or mixed(held, k))
    monkeypatch.setattr(jaccard, "PAIRS_PER_MEMBER", 0)
    monkeypatch.setattr(jaccard, "LEADER_ROUNDS", 2)
    monkeypatch.setattr(jaccard, "MERGING", 1000)
    check(spark, corpus(3, 10))
    assert rounds == [0, 1, 2]
    assert sum(joins) <= len(rounds)


def test_no_rows(spark):
    assert jaccard.similarity_classes(frame(spark, [])).count() == 0
    check(spark, [(4, "a b c d e f g"), (2, "h i j")])


def test_keep_one(spark):
    rows = [(5, "a b c d e f"), (3, "A b c d e f"), (9, "x"), (1, None), (None, "a b c d e f"), (None, "y")]
    kept = jaccard.keep_one(frame(spark, rows))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([3, 9, 1, None], key=repr)
    assert kept.columns == ["doc_id", "text", "v", "c", "digest"]


def test_keep_one_decides_by_row(spark):
    """Ids that name two texts, near copies without an id, and columns named like the operator's own."""
    rows = [(4, "x y z u v w"), (4, "p q r s t u"), (3, "x y z u v w")] + [(None, "k l m n o p")] * 3 + [(7, ""), (7, None)]
    df = spark.createDataFrame([(*row, 1, 2, 3, 4) for row in rows], "doc_id long, text string, _key int, row int, _metadata int, key int")
    for kept in (jaccard.keep_one(df), jaccard.keep_one(stored(df, "test"))):
        assert kept.columns == df.columns
        got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
        assert got == sorted([(4, "p q r s t u"), (3, "x y z u v w"), (None, "k l m n o p"), (7, ""), (7, None)], key=repr)


def test_keep_first_decides_by_row(spark):
    rows = [(5, "a  b"), (4, "a b"), (4, "c"), (None, "c"), (4, "c"), (None, None), (None, "")]
    df = spark.createDataFrame([(*row, 1, 2, 3, 4) for row in rows], "doc_id long, text string, _id int, _digest int, key int, digest int")
    for docs in (df, stored(df, "test")):
        kept = exact.keep_first(docs, exact.fresh_index(spark, 4))
        assert kept.columns == df.columns
        got = sorted(((r.doc_id, normal(r.text)) for r in kept.collect()), key=repr)
        assert got == sorted([(4, "a b"), (4, "c"), (None, "")], key=repr)


def test_rerun_of_a_batch_keeps_the_same_rows(spark):
    """The driver may be lost behind the append: the batch is then run again."""
    index = exact.fresh_index(spark, 4)
    exact.deduplicate(frame(spark, [(1, "old")]), index, batch="first").collect()
    rows = [(9, "old"), (3, "x"), (2, "x"), (5, "y"), (None, "z")]
    runs = [sorted(map(tuple, exact.deduplicate(frame(spark, rows), index, batch="second").select("doc_id", "keep_id", "group_size", "kept").collect()), key=repr) for _ in range(3)]
    assert runs[0] == runs[1] == runs[2] and sum(r[3] for r in runs[0]) == 3
    assert index.rows().count() == 4
    index.forget()


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 230), rng.randrange(200, 230)) for _ in range(20)]
    got = {r.v: r.c for r in spark_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    label = {v: v for e in chain for v in e}
    for _ in range(300):
        for a, b in chain:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_prefix_shares_an_ngram():
    """Sets over the threshold share some among their prefixes in any order."""
    rng = random.Random(6)
    import numpy as np

    for _ in range(300):
        a = {rng.randrange(10**6) for _ in range(rng.randrange(1, 60))}
        b = {x if rng.random() < 0.9 else rng.randrange(10**6) for x in a}
        late = np.array(sorted(rng.sample(sorted(a | b), len(a | b) // 3)), np.uint64)
        order = jaccard.Order(late, np.array([rng.randrange(5) for _ in late]))
        if 100 * len(a & b) >= 80 * len(a | b):
            x, y = (order.prefix(np.array(sorted(s), np.uint64), 80) for s in (a, b))
            needed = min((80 * min(len(a), len(b)) + 99) // 100, jaccard.SHARED)
            assert len(set(x.tolist()) & set(y.tolist())) >= needed
    assert len(jaccard.ngram_set("A b\tc d e F", 5)) == 2 == len(ngrams("A b\tc d e F"))


def plain_exact(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(normal(text), []).append(key)
    out = []
    for key, text in rows:
        keys = groups[normal(text)]
        out.append((key, min((k for k in keys if k is not None), default=None), len(keys), hashlib.sha256(normal(text).encode()).hexdigest()))
    return sorted(out, key=repr), len(groups)


def test_exact(spark):
    rows = [(7, "a  b"), (3, "a\n b"), (3, "a b"), (None, "a b"), (4, "A b"), (8, None), (2, ""), (6, " "), (None, "z"), (None, "z"), (1, "y" * 100_000)]
    index = exact.fresh_index(spark, buckets=4)
    got = exact.deduplicate(frame(spark, rows), index).collect()
    want, groups = plain_exact(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == groups and all(r.doc_id == r.keep_id for r in got if r.kept)
    # A second batch knows the texts of the first.
    second = exact.deduplicate(frame(spark, [(0, "a b"), (50, "new"), (51, "new")]), index).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in second) == [(0, 3, 1, False), (50, 50, 2, True), (51, 50, 2, False)]
    assert index.rows().count() == groups + 1
    index.forget()
    kept = exact.keep_first(frame(spark, rows), exact.fresh_index(spark, 4))
    assert kept.count() == groups and kept.columns == ["doc_id", "text", "v", "c", "digest"]
    assert exact.deduplicate(frame(spark, []), exact.fresh_index(spark, 4)).count() == 0


def test_batches_decide_as_one(spark):
    """The second batch holds copies of the first's texts; sizes and the rows kept are those of all rows."""
    rows = [(7, "a  b"), (3, "a\n b"), (3, "a b"), (None, "a b"), (4, "A b"), (8, None), (2, ""), (6, " "), (None, "z"), (None, "z"), (1, "y" * 100_000), (9, "A b")]
    index = exact.fresh_index(spark)
    got = exact.in_batches(frame(spark, rows), index).collect()
    want, groups = plain_exact(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == groups == index.rows().count()
    assert index.rows().select("batch").distinct().count() == 2
    # Whoever opens the index again works with the buckets it has.
    assert exact.DigestIndex(spark, index.name, 99).buckets == index.buckets == 4
    index.forget()
    assert exact.in_batches(frame(spark, []), exact.fresh_index(spark)).count() == 0


def test_index_side_is_not_shuffled(spark):
    index = exact.fresh_index(spark, buckets=4)
    index.append(spark.createDataFrame([(b"x", 1, "b")], "digest binary, keep_id long, batch string"))
    batch = spark.createDataFrame([(b"y",)], "digest binary").repartition(4, "digest")
    plan = batch.join(index.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1
    index.forget()
