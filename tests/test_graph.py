import pytest
from pyspark.sql import functions as F

from triplens.operators import graph
from triplens.plans import pages as plans

HOST = "https://h.example"


def page(page_id, url, *links):
    return (page_id, url, " ".join(f'<a href="{link}">x</a>' for link in links))


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        page(0, f"{HOST}/wiki/A", "/wiki/B", "/wiki/C", "/wiki/File:sea.jpg", "/wiki/Help:Y", "/wiki/B"),
        page(1, f"{HOST}/wiki/B", "/wiki/A", "/wiki/D", "/wiki/C"),
        page(2, f"{HOST}/wiki/C", "/wiki/D", "/wiki/Missing", "/wiki/File:hut.1.jpg"),
        page(3, f"{HOST}/wiki/D", "/wiki/E", "http://elsewhere.example/wiki/A"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def tail(url):
    return url.rsplit("/", 1)[1]


def edges_of(df):
    return sorted((tail(row["from_url"]), tail(row["to_url"])) for row in df.collect())


def test_crawl_builds_a_forest(pages):
    urls, links, images = plans.crawl(pages, [f"{HOST}/wiki/A"], HOST, depth=3)
    assert sorted((tail(row["url"]), row["level"]) for row in urls.collect()) == [
        ("A", 0), ("B", 1), ("C", 1), ("D", 2), ("E", 3), ("Missing", 2)]
    assert edges_of(links) == [("A", "B"), ("A", "C"), ("B", "D"), ("C", "Missing"), ("D", "E")]
    assert sorted((row["name"], tail(row["url"])) for row in images.collect()) == [
        ("hut", "File:hut.1.jpg"), ("sea", "File:sea.jpg")]


def test_crawl_depth_one_reads_the_seeds_only(pages):
    urls, links, images = plans.crawl(pages, [f"{HOST}/wiki/A", f"{HOST}/wiki/Gone"], HOST, depth=1)
    assert edges_of(links) == [("A", "B"), ("A", "C")]
    assert [row["name"] for row in images.collect()] == ["sea"]
    assert urls.count() == 4


def test_bfs_stops_when_nothing_is_new(spark):
    links = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (1, 3)], "src long, dst long")
    seeds = spark.createDataFrame([(1,)], "node long")
    visited, forest = graph.bfs(links, seeds, depth=50)
    assert sorted(tuple(row) for row in forest.collect()) == [(1, 2, 1), (1, 3, 1)]
    assert visited.count() == 3
    with pytest.raises(ValueError):
        graph.bfs(links, seeds, depth=0)


def test_bfs_each_target_has_one_parent(spark):
    links = spark.range(4000).select(
        F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 97).alias("src"), (F.col("id") * 31 % 1009).alias("dst"))
    visited, forest = graph.bfs(links, spark.range(1).select(F.col("id").alias("node")), depth=4)
    rows = [tuple(row) for row in forest.collect()]
    # The same walk, step by step.
    pairs = {tuple(row) for row in links.collect()}
    seen, frontier, expected = {0}, {0}, []
    for level in range(1, 5):
        found = {}
        for src, dst in sorted(pairs):
            if src in frontier and dst not in seen:
                found.setdefault(dst, src)
        expected += [(src, dst, level) for dst, src in found.items()]
        frontier = set(found)
        seen |= frontier
    assert sorted(rows) == sorted(expected)
    assert visited.count() == len(seen)


def test_link_graph(spark):
    urls = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "url string")
    links = spark.createDataFrame([("a", "c"), ("b", "a"), ("a", "nowhere")], "from_url string, to_url string")
    vertices, edges = graph.link_graph(urls, links)
    assert sorted(tuple(row) for row in vertices.select("id", "url").collect()) == [(0, "a"), (1, "b"), (2, "c")]
    assert sorted(tuple(row) for row in edges.collect()) == [(0, 2, "contains"), (1, 0, "contains")]


def ranks_by_hand(count, pairs, rounds, reset=0.15):
    degree = [sum(src == node for src, _ in pairs) for node in range(count)]
    ranks = [reset] * count
    for _ in range(rounds):
        ranks = [
            reset + (1 - reset) * sum(ranks[src] / degree[src] for src, dst in pairs if dst == node)
            for node in range(count)
        ]
    return ranks


@pytest.mark.parametrize("rounds", [1, 6])
def test_pagerank(spark, rounds):
    # A cycle, a sink, a doubled edge, and vertex 0 holding a large share of the edges.
    pairs = [(0, node) for node in range(1, 400)] + [(node, (node * 7) % 400) for node in range(1, 300)] + [(5, 6)] * 2
    vertices = spark.range(400).withColumn("url", F.col("id").cast("string"))
    edges = spark.createDataFrame(pairs, "src long, dst long")
    # The tolerance that the last of these rounds, and no round before it, stays under.
    steps = [ranks_by_hand(400, pairs, k) for k in range(rounds + 1)]
    moves = [max(abs(a - b) for a, b in zip(x, y)) for x, y in zip(steps, steps[1:])]
    tol = moves[-1] * 1.001
    assert all(move > tol for move in moves[:-1])
    got = {row["id"]: row["pagerank"] for row in graph.pagerank(vertices, edges, tol=tol, max_iter=rounds).collect()}
    if rounds > 1:
        with pytest.raises(RuntimeError):
            graph.pagerank(vertices, edges, tol=tol, max_iter=rounds - 1)
    expected = steps[-1]
    assert [got[node] for node in range(400)] == pytest.approx(expected)


def test_pagerank_converges_and_normalizes(spark):
    pairs = [(0, 1), (1, 2), (2, 0), (2, 1)]
    vertices = spark.range(4).withColumn("url", F.col("id").cast("string"))
    edges = spark.createDataFrame(pairs, "src long, dst long")
    ranks = graph.pagerank(vertices, edges, tol=1e-3)
    got = {row["id"]: row["pagerank"] for row in ranks.collect()}
    assert [got[node] for node in range(4)] == pytest.approx(ranks_by_hand(4, pairs, 200), abs=0.02)
    scaled = graph.pagerank(vertices, edges, normalize=True)
    assert scaled.agg(F.sum("pagerank")).first()[0] == pytest.approx(4.0)
    assert [row["uid"] for row in graph.top_pages(ranks, 2).collect()] == [1, 2]


def test_match_image(spark):
    images = spark.createDataFrame([("Urban", "u1"), ("urbane", "u2"), ("far", "u0")], "name string, url string")
    rows = plans.match_image(images, ["urban", "fare"], 3).collect()
    assert [(row["url"], row["levenshtein_dist"]) for row in rows] == [("u0", 1), ("u1", 1), ("u2", 1)]
    assert plans.closest_image(images, ["urbane"]).collect()[0]["url"] == "u2"


def test_search_pages(spark):
    texts = {"A": "camera travel free", "B": "free free camera far from travel", "C": "camera only", "D": "travel free camera"}
    pages = spark.createDataFrame(
        [(i, name, f"<p>{text}</p>") for i, (name, text) in enumerate(texts.items())]
        + [(9, "A", "<p>camera travel free camera</p>")],  # stored again, which must not count twice
        "page_id long, url string, html string")
    urls = spark.createDataFrame([("A",), ("B",), ("C",), ("Gone",)], "url string")
    links = spark.createDataFrame([("A", "B"), ("A", "C"), ("B", "Gone")], "from_url string, to_url string")
    rows = plans.search_pages(pages, urls, links, ["camera", "travel", "free"]).collect()
    # D is not linked and C lacks two words.
    assert sorted(row["url"] for row in rows) == ["A", "B"]
    assert rows[0]["ranking"] > rows[1]["ranking"] > 0


def test_pagerank_computes_the_edges_once(spark):
    """Edges cut out of pages are costly; each row of them is made once, however many rounds there are."""
    made = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame

    pairs = [(at, (at * 7 + k) % 50) for at in range(50) for k in range(3)]
    edges = spark.createDataFrame(pairs, "src long, dst long").mapInPandas(counted, "src long, dst long")
    ranks = graph.pagerank(spark.range(50), edges, tol=1e-6)
    # Every page has three links and, but for their order, three linking to it.
    assert ranks.count() == 50 and made.value == len(pairs)
    assert abs(sum(row["pagerank"] for row in ranks.collect()) - 50) < 0.01
