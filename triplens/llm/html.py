"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: runs of text between block-level tags. Each leaf
is read as a vector of its tag path (tags and words of class, id and role, hashed) and a vector of
its hashed words and a few measures of its text. A bidirectional LSTM in numpy reads the whole
sequence and labels every leaf, so each decision knows the document around it.

The labeller is trained here, on a bounded sample of the pages whose markup names their main part,
and on variants of them: other names for the main part, and menus, notices, adverts, forms and
reader comments put before, in and behind it.

Defined results: a null or empty page has an empty text, as has a page without a main leaf;
repeated rows get the same text; unclosed and stray tags are put up with; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.llm.common import table

#: Pages the labeller is fitted on, in the mean; chosen by hash of the url and the page.
SAMPLE = 300
PATH_SIZE, WORD_SIZE, MEASURES, HIDDEN = 512, 64, 4, 16
#: Elements read at either end of a tag path.
DEEP = 32
#: Leaves of the pages that run through the network together.
BATCH_LEAVES = 4096

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Their content is no text of the page.
HIDDEN_TAGS = frozenset("head script style noscript template textarea select option button svg math iframe object canvas title".split())
RAW = frozenset("script style textarea title iframe noscript template svg math".split())
#: A tag of the key's kind ends an open tag of the value's kinds.
CLOSES = {tag: ("p",) for tag in (
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav "
    "ol p pre section table ul".split()
)} | {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p")}
#: What can stand in a head; any other start tag, and text, ends a head left open.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_SCOPE = frozenset("ul ol dl table div article section aside main nav form body".split())

_NAME = re.compile(r"/?[A-Za-z][^\s/>]*")
_QUOTE_OR_END = re.compile(r"[>\"']")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")


class Leaf:
    """A block of text: the pieces of it, the path to it, and how much of it is in links."""

    __slots__ = ("path", "pieces", "linked")

    def __init__(self, path: tuple[str, ...]):
        self.path, self.pieces, self.linked = path, [], 0

    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def _tag_end(page: str, at: int) -> int:
    """The > that ends a tag, quotes heeded; the end of the page if there is none."""
    while found := _QUOTE_OR_END.search(page, at):
        if found[0] == ">":
            return found.start()
        close = page.find(found[0], found.end())
        if close < 0:
            close = page.find(">", found.end())
            return close if close >= 0 else len(page)
        at = close + 1
    return len(page)


def leaves(page: str | None) -> list[tuple[tuple[str, ...], str, float]]:
    """(path, text, share in links) of each leaf in page order; a path lists tags and .names."""
    if not page:
        return []
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    opened: Counter[str] = Counter()
    leaf: Leaf | None = None
    hidden = links = 0

    def close(upto: int) -> None:
        nonlocal hidden, links
        for tag, _ in stack[upto:]:
            opened[tag] -= 1
            hidden -= tag in HIDDEN_TAGS
            links -= tag == "a"
        del stack[upto:]

    def end_head() -> None:
        if opened["head"] and not opened["noframes"]:
            close(next(k for k, (tag, _) in enumerate(stack) if tag == "head"))

    def add(text: str) -> None:
        nonlocal leaf
        if opened["head"] and text and not text.isspace():
            end_head()
        if hidden or not text:
            return
        if leaf is None:
            if text.isspace():
                return
            # Of a very deep path both ends are read, so that leaves stay small.
            path = stack if len(stack) <= 2 * DEEP else stack[:DEEP] + stack[-DEEP:]
            leaf = Leaf(tuple(token for _, tokens in path for token in tokens))
            out.append(leaf)
        leaf.pieces.append(text)
        if links:
            leaf.linked += len(text)

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            add(html.unescape(page[at:]))
            break
        after = page[start + 1 : start + 2]
        if not (after.isalpha() and after.isascii()) and after not in ("/", "!", "?"):
            add(html.unescape(page[at : start + 1]))
            at = start + 1
            continue
        add(html.unescape(page[at:start]))
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else size
            continue
        name = _NAME.match(page, start + 1)
        if name is None:
            end = page.find(">", start)
            at = end + 1 if end >= 0 else size
            continue
        end = _tag_end(page, name.end())
        at, tag = end + 1, name[0].lower()
        if tag[0] == "/":
            tag = tag[1:]
            if tag not in INLINE:
                leaf = None
            if tag in ("body", "br"):
                end_head()
            if opened[tag]:
                depth = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag)
                close(depth)
            continue
        if tag not in IN_HEAD:
            end_head()
        elif tag == "head" and opened["head"]:
            continue
        if tag not in INLINE:
            leaf = None
        elif tag == "br":
            add(" ")
        for ended in CLOSES.get(tag, ()):
            for depth in range(len(stack) - 1, -1, -1) if opened[ended] else ():
                if stack[depth][0] == ended:
                    close(depth)
                    break
                if stack[depth][0] in _SCOPE:
                    break
        if tag in VOID or page[end - 1 : end] == "/" and tag in RAW:
            continue
        if tag in RAW:
            found = re.compile(rf"</{tag}\b", re.IGNORECASE).search(page, at)
            if found is None:
                break
            at = _tag_end(page, found.end()) + 1
            continue
        tokens = [tag]
        if end > name.end():
            for found in _NAMES.finditer(page, name.end(), end):
                tokens += ["." + part for part in _PART.findall((found[1] or found[2] or found[3] or "").lower())]
        stack.append((tag, tuple(tokens)))
        opened[tag] += 1
        hidden += tag in HIDDEN_TAGS
        links += tag == "a"
    found = [(x.path, x.text(), x.linked / max(1, sum(map(len, x.pieces)))) for x in out]
    return [x for x in found if x[1]]


def path_places(path: tuple[str, ...]) -> list[int]:
    return [zlib.crc32(token.encode()) % PATH_SIZE for token in {*path, "last:" + next((t for t in reversed(path) if t[0] != "."), "")}]


def word_vector(text: str, linked: float) -> np.ndarray:
    """Hashed words, scaled by the root of their number, then measures of the text."""
    words = text.encode().split()
    vector = np.zeros(WORD_SIZE + MEASURES)
    places = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % WORD_SIZE
    vector[:WORD_SIZE] = np.bincount(places, minlength=WORD_SIZE) / np.sqrt(max(1, len(words)))
    vector[WORD_SIZE:] = np.log1p(len(words)) / 4, linked, min(1.0, text.count(".") / max(1, len(words)) * 10), 1.0
    return vector


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """A bidirectional LSTM with one output per leaf."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        size = PATH_SIZE + WORD_SIZE + MEASURES
        self.p = {"wo": rng.normal(0, 0.3, 2 * HIDDEN), "bo": np.zeros(1)}
        for d in "fb":
            self.p["wx" + d] = rng.normal(0, 0.1, (size, 4 * HIDDEN))
            self.p["wh" + d] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
            self.p["b" + d] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])
        self._paths: dict[tuple[str, ...], np.ndarray] = {}

    def __getstate__(self):
        return {"p": self.p, "_paths": {}}

    def _path(self, path: tuple[str, ...]) -> np.ndarray:
        """What the tag path adds to the gates of both directions; paths repeat, so it is kept."""
        if path not in self._paths:
            if len(self._paths) > 20_000:
                self._paths.clear()
            places = path_places(path)
            self._paths[path] = np.concatenate([self.p["wx" + d][places].sum(axis=0) for d in "fb"])
        return self._paths[path]

    def _run(self, gates: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (T, B, H) from input gates (T, B, 4H); masked places hand on the state."""
        steps, batch = mask.shape
        h, c, out = np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN)), np.zeros((steps, batch, HIDDEN))
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = gates[t] + h @ self.p["wh" + d]
            s = _sigmoid(z[:, : 3 * HIDDEN])
            f, i, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, h, c, f, i, o, g, tc, m))
            h, c = m * (o * tc) + (1 - m) * h, m * c_new + (1 - m) * c
            out[t] = h
        return out

    def probabilities(self, pages: list[list[tuple]]) -> list[np.ndarray]:
        """For each page, the probability of each of its leaves to be main text."""
        result: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(pages[order[end]]) * (end + 1 - at) <= BATCH_LEAVES:
                end += 1
            chosen = order[at:end]
            steps = len(pages[chosen[-1]])
            gates, mask = np.zeros((steps, len(chosen), 8 * HIDDEN)), np.zeros((steps, len(chosen)))
            word_weights = np.concatenate([self.p["wx" + d][PATH_SIZE:] for d in "fb"], axis=1)
            bias = np.concatenate([self.p["bf"], self.p["bb"]])
            for column, k in enumerate(chosen):
                words = np.stack([word_vector(text, linked) for _, text, linked in pages[k]])
                own = words @ word_weights + bias + np.stack([self._path(path) for path, _, _ in pages[k]])
                gates[: len(own), column], mask[: len(own), column] = own, 1
            states = [self._run(gates[:, :, s * 4 * HIDDEN : (s + 1) * 4 * HIDDEN], mask, d) for s, d in enumerate("fb")]
            p = _sigmoid(np.concatenate(states, axis=2) @ self.p["wo"] + self.p["bo"])
            for column, k in enumerate(chosen):
                result[k] = p[: len(pages[k]), column]
            at = end
        return result

    def fit(self, pages: list[list[tuple]], labels: list[list[int]], epochs: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 0) -> None:
        """Adam on the mean cross entropy, through time."""
        rng = np.random.default_rng(seed)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = sorted(rng.permutation(len(pages)).tolist(), key=lambda k: len(pages[k]) // 8)
            batches = [order[i : i + batch] for i in range(0, len(order), batch)]
            rng.shuffle(batches)
            for chosen in batches:
                step += 1
                for name, slope in self._slopes([pages[k] for k in chosen], [labels[k] for k in chosen]).items():
                    m, v = moments[name]
                    m += 0.1 * (slope - m)
                    v += 0.001 * (slope * slope - v)
                    self.p[name] = self.p[name] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self._paths.clear()

    def _slopes(self, pages: list[list[tuple]], labels: list[list[int]]) -> dict[str, np.ndarray]:
        steps = max(map(len, pages))
        x, mask, y = np.zeros((steps, len(pages), PATH_SIZE + WORD_SIZE + MEASURES)), np.zeros((steps, len(pages))), np.zeros((steps, len(pages)))
        for column, (page, own) in enumerate(zip(pages, labels)):
            for t, (path, text, linked) in enumerate(page):
                x[t, column, path_places(path)] = 1
                x[t, column, PATH_SIZE:] = word_vector(text, linked)
            mask[: len(page), column], y[: len(page), column] = 1, own
        kept: dict[str, list] = {"f": [], "b": []}
        states = [self._run(x @ self.p["wx" + d] + self.p["b" + d], mask, d, kept[d]) for d in "fb"]
        both = np.concatenate(states, axis=2)
        error = (_sigmoid(both @ self.p["wo"] + self.p["bo"]) - y) * mask / mask.sum()
        slopes = {"wo": np.einsum("tb,tbh->h", error, both), "bo": np.array([error.sum()])}
        for s, d in enumerate("fb"):
            dout = error[:, :, None] * self.p["wo"][s * HIDDEN : (s + 1) * HIDDEN]
            dh, dc = np.zeros((len(pages), HIDDEN)), np.zeros((len(pages), HIDDEN))
            dz_all, dwh = np.zeros((steps, len(pages), 4 * HIDDEN)), np.zeros_like(self.p["wh" + d])
            for t, h, c, f, i, o, g, tc, m in reversed(kept[d]):
                dh = dh + dout[t]
                own_h = dh * m
                own_c = dc * m + own_h * o * (1 - tc * tc)
                dz = np.concatenate([own_c * c * f * (1 - f), own_c * g * i * (1 - i), own_h * tc * o * (1 - o), own_c * i * (1 - g * g)], axis=1)
                dz_all[t] = dz
                dwh += h.T @ dz
                dh = dz @ self.p["wh" + d].T + dh * (1 - m)
                dc = own_c * f + dc * (1 - m)
            slopes["wh" + d] = dwh
            slopes["wx" + d] = np.tensordot(x, dz_all, axes=([0, 1], [0, 1]))
            slopes["b" + d] = dz_all.sum(axis=(0, 1))
        return slopes


#: Names for the main part, and for what is no main text; each entry is a path.
MAIN_PATHS = [p.split() for p in (
    "article|main|main article|div .content|div .main .content|div .post|div .post .content|div .entry .content|div .article .body|"
    "section .article|div .story .body|div .text|main div .page|div .container div .article|td .content|section .main|div .wrapper article .post"
).split("|")]
OTHER_PATHS = [p.split() for p in (
    "nav ul li|nav .menu ul li a|ul .menu li|div .nav|div .navigation ul li|header|header .site .header div|div .header|div .breadcrumb|"
    "aside|aside div p|div .sidebar|div .sidebar section p|div .widget|div .ad|div .ads|div .advert|div .advertisement p|div .banner|div .promo|div .sponsored|"
    "div .cookie .notice|div .notice|div .notice p|div .alert|div .consent|div .popup|form|form label|form .search div|form p|form fieldset|div .newsletter|div .subscribe form|"
    "footer|footer div|footer p|footer .site .footer ul li|div .footer|div .copyright|div .legal|div .share|div .social|div .related|div .related ul li|div .recommended|"
    "section .comments|section .comments div .comment p|div .comments|div .comments ul li|div .comment p|ol .commentlist li|ul .comments li p|div .comment .body|div .replies p|div .disqus|div .reviews p"
).split("|")]
_OTHER_TAGS = frozenset("nav aside footer form".split())
_OTHER_NAMES = frozenset(t for p in OTHER_PATHS for t in p if t[0] == "." and t not in (".site", ".body", ".header"))


def named_label(path: tuple[str, ...]) -> int | None:
    """What the markup itself says: 1 in a main part, 0 in another named part, else None."""
    inside = "article" in path or "main" in path
    if any(t in _OTHER_TAGS or t in _OTHER_NAMES for t in path) or "header" in path and not inside:
        return 0
    return 1 if inside else None


def variants(pages: list[list[tuple]], seed: int, per_page: int = 3) -> tuple[list, list]:
    """Training sequences with their labels: pages as they are, and rebuilt under other names."""
    rng = random.Random(seed)
    named = [[(x, named_label(x[0])) for x in page] for page in pages]
    named = [page for page in named if any(y == 1 for _, y in page)]
    if not named:  # nothing names its main part: long leaves stand for it
        named = [[(x, int(len(x[1].split()) >= 12)) for x in page] for page in pages]
        named = [page for page in named if any(y for _, y in page)]
    others = [x for page in named for x, y in page if y != 1] or [(("div",), "Home", 0.0)]
    mains = [x for page in named for x, y in page if y == 1]
    out, labels = [], []
    for page in named:
        out.append([x for x, _ in page])
        labels.append([int(y == 1) for _, y in page])
        own = [x for x, y in page if y == 1]
        for _ in range(per_page):
            main = rng.choice(MAIN_PATHS)
            root = ["html", "body", *rng.choice([[], ["div"], ["div", ".wrapper"], ["div", ".page"]])]
            rows: list[tuple] = []

            def boilerplate(inside: list[str], count: int) -> None:
                for _ in range(count):
                    path = tuple(root + inside + rng.choice(OTHER_PATHS))
                    for _ in range(rng.choice([1, 1, 2, 4])):
                        text = rng.choice(others if rng.random() < 0.6 else mains)[1]
                        if rng.random() < 0.4:
                            text = " ".join(text.split()[: rng.randrange(1, 12)])
                        rows.append(((path, text, float("a" in path or rng.random() < 0.2)), 0))

            boilerplate([], rng.randrange(5))
            for k, (path, text, linked) in enumerate(own):
                tail = [t for t in path[2:] if t not in ("article", "main", "body", "html") and t[0] != "."]
                tail = tail or [rng.choice(["p", "p", "h1", "h2", "li", "blockquote", "div"])]
                if tail[-1] == "b" or rng.random() < 0.15:
                    tail = [rng.choice(["p", "p", "p", "h2", "blockquote", "pre", "ul", "section"])]
                if k == 0 and rng.random() < 0.15:
                    tail = ["header", *tail]
                rows.append(((tuple(root + main + tail), text, linked if rng.random() < 0.8 else rng.random() / 2), 1))
                if rng.random() < 0.04:
                    boilerplate(main, 1)
            if rng.random() < 0.3:
                boilerplate(main, 1)
            boilerplate([], rng.randrange(5))
            out.append([x for x, _ in rows])
            labels.append([y for _, y in rows])
    return out, labels


def train(pages: DataFrame, sample: int = SAMPLE, seed: int = 0, url_column: str = "url", html_column: str = "html") -> BlockLabeller:
    """A labeller fitted on about ``sample`` distinct pages, which are what comes to the driver.

    Equal pages are one page to learn from, so the many rows of a page that repeats don't arrive.
    """
    labeller = BlockLabeller(seed)
    total = pages.count()
    parts = 1_000_000
    share = -(-parts * sample // max(1, total))
    place = F.xxhash64(url_column, html_column)
    chosen = pages.where(F.pmod(place, F.lit(parts)) < share).select(place.alias("place"), F.col(html_column).alias("html"))
    chosen = chosen.dropDuplicates(["place"]).orderBy("place")
    found = [leaves(row["html"]) for row in chosen.collect()]
    # A page of very many leaves teaches by parts of the length of usual pages.
    found = [page[i : i + 200] for page in found for i in range(0, len(page), 200)]
    sequences, labels = variants(found, seed)
    if sequences:
        labeller.fit(sequences, labels)
    return labeller


def main_text(page: list[tuple], probabilities: np.ndarray) -> str:
    return "\n".join(text for (_, text, _), p in zip(page, probabilities) if p >= 0.5)


def extract(pages: DataFrame, labeller: BlockLabeller, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text) of each row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 500):
                batch = whole.slice(start, 500)
                found = [leaves(value.as_py()) for value in batch.column(2)]
                texts = [main_text(page, p) for page, p in zip(found, labeller.probabilities(found))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    plain = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    return plain.mapInArrow(run, "page_id long, url string, text string")


def op6_html_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extract(pages, train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
