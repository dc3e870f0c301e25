import pytest
from pyspark.sql import functions as F

from triplens.functions import text as tx
from triplens.functions.stem import stem, stem_tokens, stem_word
from triplens.operators.index import question_tokens, tokenize
from triplens.plans.posts import tokens_of

# Word pairs printed in Porter's 1980 paper.
PAPER = """
caresses caress ponies poni caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan
falling fall hissing hiss fizzed fizz failing fail filing file happy happi relational relat
conditional condit rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform
radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam
predication predic operator oper feudalism feudal decisiveness decis hopefulness hope
callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic
formative form formalize formal electriciti electr electrical electr hopeful hope goodness good
revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop
adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust
dependent depend adoption adopt homologou homolog communism commun activate activ
angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate
cease ceas controll control roll roll
""".split()
DEPARTURES = "sky sky skies sky dying die dies die flies fli enjoy enjoy by by advice advic news news".split()


def test_stems_of_the_paper():
    for words in (PAPER, DEPARTURES):
        for word, expected in zip(words[::2], words[1::2]):
            assert stem_word(word) == expected, word


def test_stem_columns(spark):
    df = spark.createDataFrame([(["hopping", "cats"], "relational"), (None, None), ([], "")], "a array<string>, w string")
    rows = df.select(stem_tokens(F.col("a")), stem(F.col("w"))).collect()
    assert [tuple(row) for row in rows] == [(["hop", "cat"], "relat"), (None, None), ([], "")]


def tokens(spark, text, **options):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    rows = tokenize(df, "id", "text", **options).orderBy("location").collect()
    return [(row["word"], row["location"]) for row in rows]


def test_stop_words_meet_the_raw_token(spark):
    # "The" goes, "the," stays and becomes "the".
    assert tokens(spark, "The trip, the, end", stem=False) == [("trip", 0), ("the", 1), ("end", 2)]


def test_empty_tokens_leave_gaps(spark):
    assert tokens(spark, "go -- later ... !", stem=False) == [("go", 0), ("later", 2)]


def test_unicode_whitespace_and_letters(spark):
    text = "café crème brûlée\x1fok"
    assert tokens(spark, text, stem=False) == [("caf", 0), ("crme", 1), ("brle", 2), ("ok", 3)]
    assert tokens(spark, text, stem=False, unicode=True) == [
        ("café", 0), ("crème", 1), ("brûlée", 2), ("ok", 3)]


def test_length_limit_is_on_the_raw_token(spark):
    assert tokens(spark, "a" * 19 + " " + "b" * 20 + " " + "c" * 19 + "!", max_len=20, stem=False) == [("a" * 19, 0)]


def test_empty_text(spark):
    assert tokens(spark, "") == []
    assert tokens(spark, None) == []


def test_question_tokens(spark):
    question = "Which island ferries should I take in winter, the quiet ones?"
    assert tokens_of(spark, question) == ["island", "ferri", "take", "winter", "quiet", "one"]
    assert tokens_of(spark, "Ferries, ferry, and ferries!") == ["ferri"]
    df = spark.createDataFrame([("Quiet, or quiet, beaches?",)], "q string")
    assert question_tokens(df, "q").first()["tokens"] == ["quiet", "beach"]


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(value).alias(name) for name, value in values.items()])
    return df.select(column).first()[0]


def test_byte_levenshtein(spark):
    distance = tx.byte_levenshtein(F.col("a"), F.col("b"))
    assert one(spark, distance, a="café", b="cafe") == 2
    assert one(spark, distance, a="kitten", b="sitting") == 3


def test_nearest_token(spark):
    column = tx.nearest_token_distance(F.col("name"), ["urban", "advic"])
    assert one(spark, column, name="Urban") == 1
    with pytest.raises(ValueError):
        tx.nearest_token_distance(F.col("name"), [])


HTML = (
    '<a href="/wiki/A">A</a> <a href="/wiki/A">A</a> <a href="/wiki/File:b.c.jpg">b</a>'
    '<a href="/wiki/Help:Y">h</a><a href="http://x.example/wiki/Z">z</a><a href="/wiki/File:d.png">d</a>'
)


def test_links(spark):
    links = tx.hrefs(F.col("html"))
    host = "https://h.example"
    assert one(spark, tx.text_links(links, "/wiki/", host), html=HTML) == [f"{host}/wiki/A"]
    assert one(spark, tx.image_links(links, "/wiki/", host), html=HTML) == [f"{host}/wiki/File:b.c.jpg"]
    name = tx.image_name(F.col("u"), f"{host}/wiki/File:")
    assert one(spark, name, u=f"{host}/wiki/File:b.c.jpg") == "b"


def test_visible_text(spark):
    html = "<style>p{}</style><p>a&amp;lt;b</p><!-- <b>no</b> --><SCRIPT>x</SCRIPT>c&nbsp;d"
    text = one(spark, tx.visible_text(F.col("html")), html=html)
    assert text.split() == ["a&lt;b", "c", "d"]


def test_query_string(spark):
    assert one(spark, tx.parse_query_string(F.col("q")), q="?max_id=12&q=travel") == {"max_id": "12", "q": "travel"}
    got = one(spark, tx.parse_query_string(F.col("q")), q="?a=1&b=2=3&a=4&c")
    assert got == {"a": "4", "b": "2=3", "c": None}


def test_anchors_in_any_form(spark):
    html = (
        "<a class=x href='/wiki/A'>a</a><A HREF = \"/wiki/B&amp;C\" id=z>b</A><a href=/wiki/D>d</a>"
        '<link href="/wiki/style"><a data-href="/wiki/no">n</a><abbr href="/wiki/no">n</abbr><a name="q">q</a>'
    )
    assert one(spark, tx.hrefs(F.col("html")), html=html) == ["/wiki/A", "/wiki/B&C", "/wiki/D"]


def test_character_references(spark):
    text = "caf&#233; &#xE9;&eacute; &copy;&middot; a&nbsp;b &amp;lt; &bogus; &#0; &#x110000; &amp &#128512; &"
    want = "caf\u00e9 \u00e9\u00e9 \u00a9\u00b7 a b &lt; &bogus; &#0; &#x110000; &amp \U0001f600 &"
    assert one(spark, tx.decode_references(F.col("t")), t=text) == want
    assert one(spark, tx.decode_references(F.col("t")), t="plain") == "plain"
