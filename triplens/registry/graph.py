"""Queries over pages: links, discovery, link graph, page rank, page search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.functions.text import hrefs, visible_text
from triplens.operators import graph
from triplens.plans import pages as page_plans
from triplens.plans import posts
from triplens.registry.common import naive_scores_cte, ranking_sql, rescaled_cte, table, tokens_cte
from triplens.registry import text as text_queries
from triplens.session import cut

HOST = "https://wiki.example"
PREFIX = "/"
IMAGE_TOKENS = ["onthe", "backpacking", "tionha"]
PAGE_TOKENS = ["en", "tion", "er"]
SEEDS = [0, 1, 2]
DEPTH = 3
TOLERANCE = 0.01
CANDIDATES = 200
# The best post ranks between these.
LOW_THRESHOLD, HIGH_THRESHOLD = 1.0, 8.0


def _varied_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with their anchors written in other ways, and with hrefs and anchors that are none."""
    form = F.col("page_id") % 3
    hidden = (
        '<head><link rel="next" href="/style"><base data-href="/base"><!-- <a href="/comment">x</a> -->'
        """<script type="x>y">var s = '<a href="/script">x</a>';</script><STYLE>/* <a href="/css"> */</STYLE >"""
        """<textarea rows=2><a href="/area">x</a></textarea><img alt='<a href="/alt">x</a>'><!--><a x=1 href>"""
    )
    html = F.regexp_replace("html", "<head>", hidden)
    single = F.regexp_replace(html, '<a href="([^"]*)">', "<A class=k HREF = '$1'>")
    bare = F.regexp_replace(html, '<a href="([^"]*)">', '<a title="a > b" href=$1 data-href="/x">')
    html = F.when(form == 0, html).when(form == 1, single).otherwise(bare)
    # What is left open hides the rest of a page.
    html = F.concat(html, F.when(form == 0, '<!-- <a href="/open">').when(form == 1, '<script> <a href="/open">').otherwise('<a href="/open'))
    return table(spark, sf_dir, "pages", spread=True).withColumn("html", html)


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = graph.extract_links(_varied_pages(spark, sf_dir), HOST, PREFIX)
    return links.select("page_id", "from_url", "to_url")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some letters are written as decimal, hexadecimal and named references; names of any length and unknown ones follow."""
    html = F.replace(F.replace("html", F.lit("é"), F.lit("&#233;")), F.lit("è"), F.lit("&#xE8;"))
    html = F.replace(F.replace(html, F.lit("ü"), F.lit("&uuml;")), F.lit("ñ"), F.lit("&ntilde;"))
    html = F.concat(html, F.lit("&thetasym;&CounterClockwiseContourIntegral;&NotEqualTilde;&bogus;&amp;lt;"))
    pages = table(spark, sf_dir, "pages", spread=True).withColumn("html", html)
    return pages.select("page_id", visible_text(F.col("html")).alias("text"))


def _file_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with every site link turned into a link to a jpg file page."""
    html = F.regexp_replace("html", 'href="/([^"]*)"', 'href="/File:$1.jpg"')
    return table(spark, sf_dir, "pages").withColumn("html", html)


def image_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.extract_images(_file_pages(spark, sf_dir), HOST, PREFIX)


def match_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = graph.extract_images(_file_pages(spark, sf_dir), HOST, PREFIX)
    return page_plans.match_image(images, IMAGE_TOKENS, 5)


def closest_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = graph.extract_images(_file_pages(spark, sf_dir), HOST, PREFIX)
    return page_plans.closest_image(images, IMAGE_TOKENS)


def _page_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between stored pages.

    No href of the test pages names a stored page, so a rule on the page and the link's length
    says which page each link leads to.
    """
    pages = table(spark, sf_dir, "pages")
    count = pages.agg(F.count(F.lit(1)).alias("n")).scalar()
    link = pages.select(F.col("page_id").alias("src"), F.explode(hrefs(F.col("html"))).alias("link"))
    target = (F.col("src") * 3 + F.char_length("link") * 7 + 1) % count
    return link.select("src", target.alias("dst")).distinct()


def _seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(seed,) for seed in SEEDS], "node long")


def bfs_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.bfs(cut(_page_edges(spark, sf_dir)), _seeds(spark), DEPTH)[1]


def bfs_visited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.bfs(cut(_page_edges(spark, sf_dir)), _seeds(spark), DEPTH)[0]


def link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = cut(graph.extract_links(table(spark, sf_dir, "pages"), HOST, PREFIX))
    urls = links.select(F.col("from_url").alias("url")).union(links.select("to_url"))
    return graph.link_graph(urls, links)[1]


def _page_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")
    return graph.pagerank(vertices, _page_edges(spark, sf_dir), tol=TOLERANCE)


def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = _page_ranks(spark, sf_dir)
    return ranks.select("id", "url", F.round("pagerank", 6).alias("pagerank"))


def pagerank_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = graph.top_pages(_page_ranks(spark, sf_dir), CANDIDATES)
    return top.withColumn("pagerank", F.round("pagerank", 6))


def _crawled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A crawl over the pages, with hrefs that name stored pages by the rule of the page edges."""
    def name(page: str) -> Column:
        return F.concat(F.lit("/p"), F.lpad(F.col(page).cast("string"), 9, "0"))

    anchors = _page_edges(spark, sf_dir).groupBy(F.col("src").alias("page_id")).agg(
        F.array_join(F.collect_list(F.concat(F.lit('<a href="'), name("dst"), F.lit('">x</a>'))), " ").alias("html")
    )
    pages = anchors.select("page_id", F.concat(F.lit(HOST), name("page_id")).alias("url"), "html")
    seeds = [f"{HOST}/p{seed:09d}" for seed in SEEDS]
    return page_plans.crawl(cut(pages), seeds, HOST, PREFIX, DEPTH)


def crawl_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _crawled(spark, sf_dir)[0]


def crawl_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _crawled(spark, sf_dir)[1]


def _found_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages with unique urls, the urls found from the seeds, and the links that found them."""
    pages = table(spark, sf_dir, "pages").withColumn(
        "url", F.concat_ws("#", "url", F.col("page_id").cast("string"))
    )
    visited, forest = graph.bfs(cut(_page_edges(spark, sf_dir)), _seeds(spark), DEPTH)
    url_of = pages.select(F.col("page_id").alias("node"), "url")
    urls = visited.join(url_of, "node").select("url")
    links = (
        forest.join(url_of.select(F.col("node").alias("src"), F.col("url").alias("from_url")), "src")
        .join(url_of.select(F.col("node").alias("dst"), F.col("url").alias("to_url")), "dst")
        .select("from_url", "to_url")
    )
    return pages, urls, links


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, urls, links = _found_pages(spark, sf_dir)
    ranked = page_plans.search_pages(
        pages, urls, links, PAGE_TOKENS, 5, CANDIDATES, stem=False, tol=TOLERANCE
    )
    return ranked.select("uid", "url", F.round("ranking", 6).alias("ranking"))


def _answer(spark: SparkSession, sf_dir: str, threshold: float) -> DataFrame:
    from_posts = posts.rank_texts(
        table(spark, sf_dir, "documents", spread=True), text_queries.TOKENS, 5,
        url_prefix=text_queries.URL_PREFIX, id_column="doc_id", stem=False,
    )


    def from_pages() -> DataFrame:
        pages, urls, links = _found_pages(spark, sf_dir)
        return page_plans.search_pages(
            pages, urls, links, PAGE_TOKENS, 5, CANDIDATES, stem=False, tol=TOLERANCE
        )

    chosen = page_plans.answer(from_posts, from_pages, threshold)
    return chosen.withColumn("ranking", F.round("ranking", 6))


def answer_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No post is good enough, so pages answer."""
    return _answer(spark, sf_dir, HIGH_THRESHOLD)


def answer_gate_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts are good enough, and no page is looked at."""
    return _answer(spark, sf_dir, LOW_THRESHOLD)


QUERIES = {
    "page_links": page_links,
    "page_text": page_text,
    "image_links": image_links,
    "match_image": match_image,
    "closest_image": closest_image,
    "bfs_forest": bfs_forest,
    "bfs_visited": bfs_visited,
    "link_graph": link_graph,
    "pagerank": pagerank,
    "pagerank_top": pagerank_top,
    "search_pages": search_pages,
    "answer_gate": answer_gate,
    "answer_gate_posts": answer_gate_posts,
    "crawl_urls": crawl_urls,
    "crawl_links": crawl_links,
}

# Rounds the SQL can look at.
UNROLLED = 60

_HREFS = """
href AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages)"""
_LINKS = f"""{_HREFS},
links AS (
  SELECT DISTINCT page_id, url AS from_url, '{HOST}' || link AS to_url
  FROM href WHERE starts_with(link, '{PREFIX}') AND NOT contains(link, ':'))"""
_IMAGES = f"""{_HREFS},
images AS (
  SELECT DISTINCT split_part(substr(link, 2), '.', 1) AS name,
         '{HOST}/File:' || substr(link, 2) || '.jpg' AS url
  FROM href WHERE starts_with(link, '/'))"""
_IMAGE_DISTANCE = "CAST(least({}) AS INTEGER)".format(
    ", ".join(f"levenshtein(name, '{token}')" for token in IMAGE_TOKENS)
)
_EDGES = f"""{_HREFS},
edges AS MATERIALIZED (
  SELECT DISTINCT page_id AS src,
         (page_id * 3 + length(link) * 7 + 1) % (SELECT count(*) FROM pages) AS dst
  FROM href)"""


def _forest_cte() -> str:
    seen = f"SELECT unnest([{', '.join(map(str, SEEDS))}]) AS node, 0 AS level"
    parts = [f"seen0 AS MATERIALIZED (SELECT CAST(node AS BIGINT) AS node, level FROM ({seen}))"]
    for level in range(1, DEPTH + 1):
        parts.append(f"""
found{level} AS MATERIALIZED (
  SELECT min(src) AS src, dst, {level} AS level
  FROM edges JOIN seen{level - 1} s ON s.node = src AND s.level = {level - 1}
  WHERE dst NOT IN (SELECT node FROM seen{level - 1}) GROUP BY dst),
seen{level} AS MATERIALIZED (
  SELECT node, level FROM seen{level - 1} UNION ALL SELECT dst, level FROM found{level})""")
    union = " UNION ALL ".join(f"SELECT * FROM found{level}" for level in range(1, DEPTH + 1))
    return ",".join(parts) + f", forest AS MATERIALIZED ({union})"


def _ranks_cte(vertices: str, edges: str) -> str:
    """``ranks`` (id, r) of the first round in which no rank moves by the tolerance or more.

    The rounds are unrolled; that they are enough shows in ``ranks`` not being empty.
    """
    parts = [
        f"degree AS MATERIALIZED (SELECT src, count(*) AS n FROM {edges} GROUP BY src)",
        f"rank0 AS MATERIALIZED (SELECT id, CAST(0.15 AS DOUBLE) AS r FROM {vertices})",
    ]
    for step in range(1, UNROLLED + 1):
        parts.append(f"""
rank{step} AS MATERIALIZED (
  SELECT v.id, CAST(0.15 AS DOUBLE) + CAST(0.85 AS DOUBLE) * coalesce(sum(p.r / d.n), 0.0) AS r
  FROM {vertices} v LEFT JOIN {edges} e ON e.dst = v.id
  LEFT JOIN degree d ON d.src = e.src LEFT JOIN rank{step - 1} p ON p.id = e.src
  GROUP BY v.id)""")
    moves = " UNION ALL ".join(
        f"SELECT {k} AS k, max(abs(a.r - b.r)) AS moved FROM rank{k} a JOIN rank{k - 1} b USING (id)"
        for k in range(1, UNROLLED + 1)
    )
    every = " UNION ALL ".join(f"SELECT {k} AS k, id, r FROM rank{k}" for k in range(1, UNROLLED + 1))
    parts.append(f"stop AS MATERIALIZED (SELECT min(k) AS k FROM ({moves}) WHERE moved < {TOLERANCE})")
    parts.append(f"ranks AS MATERIALIZED (SELECT id, r FROM ({every}) JOIN stop USING (k))")
    return ",".join(parts)


_PAGE_RANKS = f"""{_EDGES}, page_vertices AS (SELECT page_id AS id, url FROM pages),
{_ranks_cte('page_vertices', 'edges')}"""

_VISIBLE = "html"
for _pattern, _plain in (
    (r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " "),
    ("<[^>]*>", " "),
):
    _VISIBLE = f"regexp_replace({_VISIBLE}, '{_pattern}', '{_plain}', 'g')"
# The references that the pages hold; &amp; goes last, otherwise what it leaves would be decoded too.
for _entity, _plain in (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"),
    ("&middot;", "·"), ("&amp;", "&"),
):
    _VISIBLE = f"replace({_VISIBLE}, '{_entity}', '{_plain}')"

_SEARCH = f"""{_EDGES}, {_forest_cte()},
named AS (SELECT page_id, url || '#' || CAST(page_id AS VARCHAR) AS url, html FROM pages),
found_vertices AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY url) - 1 AS id, url, html
  FROM named WHERE page_id IN (SELECT node FROM seen{DEPTH})),
found_edges AS MATERIALIZED (
  SELECT a.id AS src, b.id AS dst FROM forest f
  JOIN named x ON x.page_id = f.src JOIN found_vertices a ON a.url = x.url
  JOIN named y ON y.page_id = f.dst JOIN found_vertices b ON b.url = y.url),
{_ranks_cte('found_vertices', 'found_edges')},
chosen AS MATERIALIZED (
  SELECT v.id AS uid, v.url, v.html FROM found_vertices v JOIN ranks r ON r.id = v.id
  ORDER BY round(r.r, 9) DESC, v.id LIMIT {CANDIDATES}),
{tokens_cte('chosen', 'uid', _VISIBLE, 'uid', max_len=20, name='ptok')},
{naive_scores_cte(PAGE_TOKENS, 'uid', 'ptok', 'pscores')},
{rescaled_cte('pscores', 'prescaled')},
page_answer AS (
  SELECT uid, url, {ranking_sql(2.0, 3.5, 4.0)} AS ranking
  FROM prescaled JOIN chosen USING (uid) ORDER BY ranking DESC, uid LIMIT 5)"""


def _gate_sql(threshold: float) -> str:
    return f"""WITH {_SEARCH},
{text_queries.DOC_TOKENS}, {naive_scores_cte(text_queries.TOKENS, 'doc_id')}, {rescaled_cte()},
post_answer AS (
  SELECT doc_id, '{text_queries.URL_PREFIX}' || CAST(doc_id AS VARCHAR) AS url,
         {ranking_sql(4.0, 3.5, 1.0)} AS ranking FROM rescaled
  ORDER BY ranking DESC, doc_id LIMIT 5),
best AS (SELECT coalesce(max(ranking) >= {threshold}, false) AS enough FROM post_answer)
SELECT 'posts' AS origin, url, round(ranking, 6) AS ranking FROM post_answer, best WHERE enough
UNION ALL
SELECT 'pages' AS origin, url, round(ranking, 6) AS ranking FROM page_answer, best WHERE NOT enough"""


def _crawl_name(page: str) -> str:
    return f"'{HOST}/p' || lpad(CAST({page} AS VARCHAR), 9, '0')"


ORACLES = {
    "page_links": f"WITH {_LINKS} SELECT page_id, from_url, to_url FROM links",
    "page_text": f"SELECT page_id, {_VISIBLE} || '\u03d1\u2233\u2242\u0338&bogus;&lt;' AS text FROM pages",
    "image_links": f"WITH {_IMAGES} SELECT name, url FROM images",
    "match_image": f"""WITH {_IMAGES}
SELECT name, url, {_IMAGE_DISTANCE} AS levenshtein_dist FROM images
ORDER BY levenshtein_dist, url LIMIT 5""",
    "closest_image": f"WITH {_IMAGES} SELECT url FROM images ORDER BY {_IMAGE_DISTANCE}, url LIMIT 1",
    "bfs_forest": f"WITH {_EDGES}, {_forest_cte()} SELECT src, dst, level FROM forest",
    "bfs_visited": f"WITH {_EDGES}, {_forest_cte()} SELECT node, level FROM seen{DEPTH}",
    "link_graph": f"""WITH {_LINKS},
vertices AS (
  SELECT url, row_number() OVER (ORDER BY url) - 1 AS id
  FROM (SELECT from_url AS url FROM links UNION SELECT to_url FROM links))
SELECT a.id AS src, b.id AS dst, 'contains' AS relationship
FROM links JOIN vertices a ON a.url = from_url JOIN vertices b ON b.url = to_url""",
    "pagerank": f"""WITH {_PAGE_RANKS}
SELECT r.id, url, round(r, 6) AS pagerank FROM ranks r JOIN page_vertices USING (id)""",
    "pagerank_top": f"""WITH {_PAGE_RANKS}
SELECT r.id AS uid, url, round(r, 6) AS pagerank FROM ranks r JOIN page_vertices USING (id)
ORDER BY round(r, 9) DESC, r.id LIMIT {CANDIDATES}""",
    "search_pages": f"WITH {_SEARCH} SELECT uid, url, round(ranking, 6) AS ranking FROM page_answer",
    "answer_gate": _gate_sql(HIGH_THRESHOLD),
    "answer_gate_posts": _gate_sql(LOW_THRESHOLD),
    "crawl_urls": f"""WITH {_EDGES}, {_forest_cte()}
SELECT {_crawl_name('node')} AS url, level FROM seen{DEPTH}""",
    "crawl_links": f"""WITH {_EDGES}, {_forest_cte()}
SELECT {_crawl_name('src')} AS from_url, {_crawl_name('dst')} AS to_url FROM forest""",
}
