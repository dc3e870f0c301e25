"""Column expressions over text: tokens, byte edit distance, links and visible page text.

Everything here is row-local, so it adds no shuffle to the plan it is used in.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop words the tokeniser drops by default.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very s t can will just don should now d ll m o re "
    "ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn "
    "weren won wouldn"
).split()

# Unicode whitespace and the four ASCII separators. The predefined class is over twice as
# fast here as the same set spelled out.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
# Fixed value: retweet header up to the last colon followed by white space.
RETWEET_HEADER = r"RT\s@[\w\W]+:\s"
# Fixed value: what introduces a link inside a tweet.
LINK_SCHEME = "https://"
# Pages keep only raw tokens shorter than this.
PAGE_TOKEN_LIMIT = 20

NON_WORD_ASCII = r"\W+"
NON_WORD_UNICODE = r"[^\p{L}\p{N}_]+"
# A run of word characters of any script, or one punctuation character.
TAGGING_TOKEN = r"(?U)\w+|[^\s\w]"
PUNCTUATION = r"(?U)\W"


def raw_tokens(text: Column) -> Column:
    """Lower-cased whitespace tokens."""
    return F.array_remove(F.split(F.lower(text), WHITESPACE), "")


def clean_tokens(
    text: Column,
    stops: Iterable[str] = ENGLISH_STOP_WORDS,
    max_len: int | None = None,
    unicode: bool = False,
) -> Column:
    """Tokens after stop-word removal and punctuation stripping.

    The stop list meets the raw token, so "the," passes and then becomes "the". Tokens left
    empty by the stripping stay in the array: an element's index is its location.
    """
    stops = sorted(set(stops))
    tokens = raw_tokens(text)
    if stops or max_len is not None:
        def keep(word: Column) -> Column:
            conditions = [~word.isin(stops)] if stops else []
            if max_len is not None:
                conditions.append(F.char_length(word) < max_len)
            return conditions[0] if len(conditions) == 1 else conditions[0] & conditions[1]

        tokens = F.filter(tokens, keep)
    pattern = NON_WORD_UNICODE if unicode else NON_WORD_ASCII
    return F.transform(tokens, lambda word: F.regexp_replace(word, pattern, ""))


def tagging_tokens(text: Column) -> Column:
    """Words and single punctuation marks in order, as a tagger expects them."""
    return F.regexp_extract_all(text, F.lit(TAGGING_TOKEN), 0)


def as_bytes(text: Column) -> Column:
    """A text with one character for each byte of its UTF-8 form."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def byte_levenshtein(left: Column, right: Column, most: int | None = None) -> Column:
    """Edit distance over UTF-8 bytes (the built-in counts characters); -1 if it is over ``most``."""
    return F.levenshtein(as_bytes(left), as_bytes(right), most)


def least_edits(text: Column, target: str) -> Column:
    """A bound that the byte edit distance to ``target`` does not fall below, from byte counts alone.

    An edit takes away at most one of the bytes that the text has more often than the target, and adds at
    most one of those that it has less often.
    """
    held = target.encode().decode("latin-1")
    own = as_bytes(text)
    length = F.char_length(own)
    more = F.char_length(F.translate(own, held, "")) if held else length
    for byte in sorted(set(held)):
        count = length - F.char_length(F.translate(own, byte, ""))
        more = more + F.greatest(count - held.count(byte), F.lit(0))
    return F.greatest(more, more + len(held) - length)


def nearest_token_distance(name: Column, tokens: Iterable[str]) -> Column:
    """Smallest byte edit distance between ``name`` and any of the tokens."""
    distances = [byte_levenshtein(F.lit(token), name) for token in tokens]
    if not distances:
        raise ValueError("at least one token is needed")
    return F.array_min(F.array(*distances))


# What may stand in a tag: a name, and a value in either quotes or bare.
_NAME = r"""[^\s/>=][^\s/>=]*+"""
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_REST = rf"""(?:[\s/]++(?:{_NAME}(?:\s*+=\s*+{_VALUE})?+)?+)*+"""
# One pass over a page: a comment, an element whose content is no markup, an anchor with its first href
# (the only group 2), any other tag. What an unclosed comment or element hides goes up to the end.
MARKUP = (
    r"""(?is)<!--(?:-?>|.*?(?:--!?>|\z))"""
    rf"""|<(script|style|textarea|title|xmp|iframe|noembed|noframes)(?=[\s/>]){_REST}[\s/]*+>.*?(?:</\1(?=[\s/>])|\z)"""
    rf"""|<a(?:[\s/]++(?!href[\s=])(?:{_NAME}(?:\s*+=\s*+{_VALUE})?+))*+[\s/]++href\s*+=\s*+({_VALUE}){_REST}[\s/]*+>"""
    rf"""|</?[a-z][^\s/>]*+{_REST}[\s/]*+>"""
)


def hrefs(html: Column) -> Column:
    """The href of every anchor of the page, in order, character references decoded.

    Anchors within comments, scripts, styles, text areas and the like, or within the value of
    another tag's attribute, are none.
    """
    values = F.filter(F.regexp_extract_all(html, F.lit(MARKUP), 2), lambda value: value != "")
    bare = F.transform(values, lambda value: F.regexp_replace(value, r"""^["']|["']$""", ""))
    return F.transform(bare, decode_references)


def text_links(links: Column, prefix: str, host: str) -> Column:
    """Distinct site links without a namespace colon, made absolute."""
    kept = F.filter(links, lambda link: link.startswith(prefix) & ~link.contains(":"))
    return F.array_distinct(F.transform(kept, lambda link: F.concat(F.lit(host), link)))


def image_links(links: Column, prefix: str, host: str) -> Column:
    """Distinct links to jpg file pages, made absolute."""
    kept = F.filter(links, lambda link: link.startswith(prefix + "File:") & link.contains("jpg"))
    return F.array_distinct(F.transform(kept, lambda link: F.concat(F.lit(host), link)))


def image_name(url: Column, file_prefix: str) -> Column:
    """The file name in an image url: after the prefix, up to the first dot."""
    return F.substring_index(F.substring_index(url, file_prefix, -1), ".", 1)


def visible_text(html: Column) -> Column:
    """Text of a page: no scripts, styles, comments or tags; character references decoded."""
    text = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " ")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    return decode_references(text)


def _named_references() -> str:
    """JSON of all names of HTML character references that end in a semicolon, the usual ones first.

    Looking a name up goes through the map in this order.
    """
    usual = ["amp", "lt", "gt", "quot", "nbsp", "apos"]
    names = [name[:-1] for name in html5 if name.endswith(";")]
    names.sort(key=lambda name: (usual.index(name) if name in usual else len(usual), min(map(ord, html5[name + ";"])), name))
    return json.dumps({name: html5[name + ";"].replace("\xa0", " ") for name in names})


CHARACTER_REFERENCES = _named_references()
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def decode_references(text: Column) -> Column:
    """Decimal, hexadecimal and named character references as their characters, each once.

    A text without an ampersand is passed on as it is. Others are cut at their references; what
    stands for no character (an unknown name, a number outside Unicode) stays.
    """
    between = F.split(text, REFERENCE)
    found = F.regexp_extract_all(text, F.lit(REFERENCE), 0)
    names = F.from_json(F.lit(CHARACTER_REFERENCES), "map<string,string>")

    def character(reference: Column) -> Column:
        name = F.substring(reference, 2, F.char_length(reference) - 2)
        hexadecimal = F.lower(name).startswith("#x")
        decimal, sixteen = F.conv(F.substring(name, 2, 7), 10, 10), F.conv(F.substring(name, 3, 6), 16, 10)
        number = F.when(hexadecimal, sixteen).otherwise(decimal).cast("int")
        known = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        # UTF-32 of the number; a no-break space counts as a space.
        decoded = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        numeric = F.when(known, F.when(number == 0xA0, " ").otherwise(decoded))
        return F.coalesce(F.when(name.startswith("#"), numeric).otherwise(names[name]), reference)

    # There is one part more than there are references.
    parts = F.zip_with(between, F.transform(found, character), lambda part, new: F.concat(part, F.coalesce(new, F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(parts, "")).otherwise(text)


def strip_retweet_header(text: Column) -> Column:
    """Text behind the retweet header; the text itself when there is none."""
    return F.coalesce(F.get(F.split(text, RETWEET_HEADER), F.lit(1)), text)


def tweet_body(cleaned: Column, screen_name: Column) -> Column:
    """Text before the first link; the author's name when the text starts with a link."""
    at = F.instr(cleaned, LINK_SCHEME)
    return (
        F.when(at == 0, cleaned)
        .when(at == 1, screen_name)
        .otherwise(F.substring_index(cleaned, LINK_SCHEME, 1))
    )


def tweet_links(cleaned: Column) -> Column:
    """Words of a tweet that are links, comma separated; empty when there are none."""
    words = F.split(cleaned, WHITESPACE)
    return F.array_join(F.filter(words, lambda word: word.startswith(LINK_SCHEME)), ",  ")


def parse_query_string(query: Column) -> Column:
    """``?a=1&b=2`` to a map; of a repeated name the last value counts."""
    pairs = F.transform(
        F.split(F.substring(query, 2, 2**31 - 1), "&"),
        lambda part: F.struct(
            F.substring_index(part, "=", 1).alias("key"),
            F.when(F.contains(part, F.lit("=")), F.substring(part, F.instr(part, "=") + 1, F.char_length(part))).alias("value"),
        ),
    )
    later = F.filter(pairs, lambda pair, at: ~F.exists(F.slice(pairs, at + 2, F.size(pairs)), lambda other: other["key"] == pair["key"]))
    return F.map_from_entries(later)
