"""Lexicon tables, link layouts, page chains, pruned edit distances, stem dictionaries, and the merge's recovery."""

import random

import pytest
from pyspark.sql import functions as F

from triplens.functions.text import byte_levenshtein, hrefs, least_edits
from triplens.operators import edits, graph, index
from triplens.operators.stems import StemDictionary
from triplens.plans import posts
from triplens.sources import feeds, tables


def plan_of(df):
    return df._jdf.queryExecution().toString()


# --- lexicon tables

@pytest.fixture
def texts(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "the", "Sea", "old", f"w{rng.randrange(500)}", ",", "'s"]) for _ in range(30))) for i in range(200)]
    return spark.createDataFrame([*rows, (900, ""), (901, None)], "doc_id long, text string")


@pytest.mark.parametrize("broadcast", [True, False])
def test_tags_of_a_large_lexicon(spark, texts, monkeypatch, broadcast):
    """10**5 words; the same rows as the lexicon in the plan gives, which here holds none of it."""
    small = {"the": "DT", "old": "JJ", "w7": "NNS", "w8": "NNS"}
    if not broadcast:
        monkeypatch.setattr(index, "BROADCAST_WORDS", 10)
    lexicon = spark.range(100_000).select(F.concat(F.lit("other"), "id").alias("token"), F.lit("VB").alias("tag"))
    lexicon = lexicon.unionByName(spark.createDataFrame([*small.items(), ("THE", "ZZ"), ("sea", None)], "token string, tag string"))
    rows = index.tag_rows(texts, "doc_id", "text", lexicon)
    wanted = texts.select("doc_id", F.posexplode(index.tag_tokens("text", small)).alias("location", "item")).select("doc_id", "location", "item.*")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, wanted.collect()))
    assert "other77" not in plan_of(rows)
    got = index.noun_phrases_of_rows(rows, "doc_id", "location")
    in_row = index.noun_phrases(texts, "doc_id", index.tag_tokens("text", small))
    assert sorted(map(tuple, got.select("doc_id", "entity").collect())) == sorted(map(tuple, in_row.collect()))


def test_phrases_of_tokens_holding_marks(spark):
    tokens = ["a\nb", "c\x1ad", "\x1an", "e\x1ae\n"]
    rows = [(1, [(token, "NN") for token in tokens[:2]] + [("is", "VB")] + [(token, "NNS") for token in tokens[2:]])]
    df = spark.createDataFrame(rows, "id long, tagged array<struct<token string, tag string>>")
    assert [r.entity for r in index.noun_phrases(df, "id", "tagged").collect()] == ["a\nb c\x1ad", "\x1an e\x1ae\n"]


# --- links by markup state

@pytest.mark.parametrize("html, wanted", [
    ('<!-- <a href="/c">x</a> --><a href="/d">', ["/d"]),
    ('<!--><a href="/a"><!---><a href="/b"><!-- x --!><a href="/c"><!-- <a href="/d">', ["/a", "/b", "/c"]),
    ("<script>'<a href=\"/s\">'</scripty></script ><a href=/t>", ["/t"]),
    ('<SCRIPT src="a>b"><a href="/s"></sCript><style><a href="/u"></style><a href="/v">', ["/v"]),
    ('<textarea><a href="/s"></textarea><title><a href="/t"></title><scripted><a href="/v">', ["/v"]),
    ("<script><a href='/never'>", []),
    ("""<img alt='<a href="/alt">' title="<a href='/t'>"><a title="<a href='/u'>" href="/v" id='<a href="/w">'>""", ["/v"]),
    ("<a href='/first' href='/second'><a data-href=/x hrefs=/y href><a href=''>", ["/first", ""]),
    ("<a\n\tclass = k\nHREF\n=\n'/n'><a/href=/o><a b=c'd href=/p><abbr href=/q><a>", ["/n", "/o", "/p"]),
    ('a < b <a href="/a&amp;b"> < <3 <a href=/c', ["/a&b"]),
    ("", []), (None, None),
])
def test_links_follow_the_markup(spark, html, wanted):
    got = spark.createDataFrame([(html,)], "html string").select(hrefs(F.col("html")).alias("links")).first().links
    assert got == wanted


def test_links_of_very_long_pages(spark):
    long = '<!-- <a href="/no"> ' + "x" * 500_000 + " -->" + "<script>" + "<a href='/no'>" * 20_000 + "</script>"
    many = "<p class='k'>" + " ".join(f'<a id="i{i}" href="/p{i}">{i}</a>' for i in range(5000)) + f'<img alt="{"y" * 100_000}" {"z " * 500}>'
    got = spark.createDataFrame([(long + many,)], "html string").select(hrefs(F.col("html")).alias("links")).first().links
    assert got == [f"/p{i}" for i in range(5000)]


# --- link layouts

def test_links_move_once(spark):
    """A level's plan holds no exchange of links, and few sources are named to the scan."""
    links = spark.range(5000).select(F.when(F.col("id") < 2000, 3).otherwise(F.col("id") % 211).alias("src"), F.col("id").alias("dst"))
    with graph.LinkLayout(links, 5) as layout:
        sources = spark.createDataFrame([(3,), (7,), (9999,)], "node long")
        for count in (3, graph.FEW_SOURCES + 1):
            found = layout.from_sources(sources, count)
            assert sorted(map(tuple, found.collect())) == sorted(map(tuple, links.where("src IN (3, 7)").collect()))
            plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            scan = next(line for line in plan.splitlines() if "FileScan" in line)
            assert "Bucketed: true" in scan and ("In(src" in scan) == (count == 3)
            # The only exchanges are of the sources asked for.
            above = plan.splitlines()[: plan.splitlines().index(scan)]
            depth = len(scan) - len(scan.lstrip(" :+-*"))
            branch = [line for line in above if len(line) - len(line.lstrip(" :+-*")) < depth]
            assert not any("Exchange" in line for line in branch[-3:])
        name = layout.name
        assert layout.rows.select("salt").distinct().count() > 1
    assert not spark.catalog.tableExists(name)


def test_bfs_of_no_seeds_and_null_nodes(spark):
    links = spark.createDataFrame([(1, 2), (None, 3), (2, None), (2, 4)], "src long, dst long")
    visited, forest = graph.bfs(links, spark.createDataFrame([], "node long"), 2)
    assert visited.count() == forest.count() == 0
    visited, forest = graph.bfs(links, spark.createDataFrame([(1,), (None,), (1,)], "node long"), 3)
    assert sorted(r.node for r in visited.where("node IS NOT NULL").collect()) == [1, 2, 4]


# --- page chains

def followed(pages, first, most):
    nexts = {}
    for page, after, _ in pages:
        if page is not None:
            nexts[page] = max((a for p, a, _ in pages if p == page and a is not None), default=None)
    out = set()
    for chain, page in first:
        seen = []
        while page in nexts and page not in seen and len(seen) <= most:
            seen.append(page)
            page = nexts[page]
        out |= {(chain, place, page) for place, page in enumerate(seen)}
    return sorted(out)


@pytest.mark.parametrize("most", [0, 1, 5, 100])
def test_chains_of_pages(spark, most):
    """Long, shared, circular and broken chains, pages landed twice, unknown and null keys, in any order."""
    rows = [(f"a{i}", f"a{i + 1}", i) for i in range(70)] + [("b0", "b1", 0), ("b1", "b2", 1), ("b2", "b0", 2), ("c0", "c0", 0)]
    rows += [("d0", "lost", 0), ("e0", None, 0), ("f0", "a3", 0), ("b1", "b2", 7), ("e0", "e1", 1), ("e1", None, 0), (None, "a0", 0)]
    random.Random(3).shuffle(rows)
    first = [("A", "a0"), ("B", "b1"), ("C", "c0"), ("D", "d0"), ("E", "e0"), ("F", "f0"), ("G", "lost"), ("H", None), ("A", "a0"), ("I", "a60")]
    pages = spark.createDataFrame(rows, "page string, next string, body int")
    got = feeds.follow_pages(pages, spark.createDataFrame(first, "chain string, page string"), most)
    assert got.columns == ["chain", "place", "page", "next", "body"]
    assert sorted((r.chain, r.place, r.page) for r in got.collect()) == followed(rows, first, most)


# --- pruned edit distances

@pytest.mark.parametrize("k", [1, 5, 400])
def test_closest_equals_all_distances(spark, k):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abcdé xyz") for _ in range(rng.randrange(40)))) for i in range(300)]
    rows += [(301, None), (302, ""), (303, "abcde"), (304, "abcde")]
    df = spark.createDataFrame(rows, "id long, t string")
    targets = ["abcde", "été"]
    every = [byte_levenshtein(F.col("t"), F.lit(t)) for t in targets]
    want = df.withColumn("d", F.least(*every)).orderBy(F.asc_nulls_last("d"), "id").limit(k)
    got = edits.closest(df, "t", targets, k, "d", "id")
    assert list(map(tuple, got.collect())) == list(map(tuple, want.collect()))


def test_few_rows_are_compared(spark):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("qrstuvwxyz") for _ in range(rng.randrange(5, 60)))) for i in range(2000)]
    df = spark.createDataFrame([*rows, *[(5000 + i, f"quiet islands {i}") for i in range(5)]], "id long, t string")
    worst = edits._kth_distance(df, "t", ["quiet islands"], 5)
    assert worst == 2 and edits.within(df, "t", ["quiet islands"], worst).count() < 20


def test_bounds_of_edits_hold(spark):
    rng = random.Random(7)
    rows = [("".join(rng.choice("abé ") for _ in range(rng.randrange(9))),) for _ in range(400)]
    df = spark.createDataFrame(rows, "t string")
    for target in ("", "ab", "ééab", "aaaa b"):
        wrong = df.where(least_edits(F.col("t"), target) > byte_levenshtein(F.col("t"), F.lit(target)))
        assert wrong.isEmpty()


# --- stem dictionary

def test_words_are_stemmed_once(spark, texts):
    dictionary = StemDictionary(spark)
    first = spark.createDataFrame([("running",), ("runs",), ("running",), (None,)], "word string")
    assert sorted(map(tuple, dictionary.extend(first).collect())) == [("running", "run"), ("runs", "run")]
    files = set(dictionary.rows().inputFiles())
    dictionary.extend(first)
    assert dictionary.rows().count() == 2 and files <= set(dictionary.rows().inputFiles())
    again = StemDictionary(spark, dictionary.path)
    assert again.rows().count() == 2
    tokens = index.tokenize(texts, "doc_id", "text", stem=False)
    stemmed = index.tokenize(texts, "doc_id", "text")
    assert sorted(map(tuple, again.stemmed(tokens).collect())) == sorted(map(tuple, stemmed.collect()))


def test_stemmed_ranking_without_python_over_texts(spark):
    rows = [(i, f"run{'s' if i % 2 else 'ning'} by the sea{'s' * (i % 3)} " + "word " * i) for i in range(40)]
    df = spark.createDataFrame(rows, "post_id long, text string")
    dictionary = StemDictionary(spark)
    asked = dictionary.asked(index.tokenize(df, "post_id", "text", stem=False), ["run", "sea"])
    assert "ArrowEvalPython" not in plan_of(asked)
    want = index.tokenize(df, "post_id", "text").where(F.col("word").isin("run", "sea"))
    assert sorted(map(tuple, asked.collect())) == sorted(map(tuple, want.collect()))
    got = posts.rank_texts(df, ["run", "sea"], 5, dictionary=dictionary)
    plain = posts.rank_posts(want, ["run", "sea"], 5)
    assert list(map(tuple, got.collect())) == list(map(tuple, plain.collect()))


# --- the merge's recovery

class Lost(Exception):
    pass


@pytest.mark.parametrize("step", ["_switch", "_empty", "snapshot"])
def test_merge_survives_a_failure(spark, monkeypatch, step):
    """Readers see all of the old rows or all of the new ones, and a rerun of the batch merges once."""
    spark.sql("CREATE DATABASE IF NOT EXISTS recovery")
    for name in ("base", "daily", "copy"):
        tables.drop_table(spark, f"recovery.{name}")
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string").write.saveAsTable("recovery.base")
    spark.createDataFrame([("c", 3), ("a", 1)], "v string, k long").write.saveAsTable("recovery.daily")
    old, new = [(1, "a"), (1, "a"), (2, "b")], [(1, "a"), (1, "a"), (1, "a"), (2, "b"), (3, "c")]

    def rows():
        return sorted(map(tuple, spark.table("recovery.base").collect()))

    def lost(*_):
        raise Lost

    with monkeypatch.context() as patched:
        patched.setattr(tables, step, lost)
        with pytest.raises(Lost):
            tables.merge_daily(spark, "recovery.base", "recovery.daily", "recovery.copy", "day-1")
    assert rows() == (new if step == "_empty" else old)
    for _ in range(2):
        tables.merge_daily(spark, "recovery.base", "recovery.daily", "recovery.copy", "day-1")
        assert rows() == new and sorted(map(tuple, spark.table("recovery.copy").collect())) == old
    tables.merge_daily(spark, "recovery.base", "recovery.daily", "recovery.copy", "day-2")
    assert rows() == sorted(new + [(3, "c"), (1, "a")]) and sorted(map(tuple, spark.table("recovery.copy").collect())) == new
    with pytest.raises(ValueError):
        tables.merge_daily(spark, "recovery.base", "recovery.daily", "recovery.copy", "no/path")
    spark.sql("DROP DATABASE recovery CASCADE")
