"""Language identification: held-out accuracy, and distances against the plain definition."""

from collections import Counter

from pyspark.sql import functions as F

from triplens.llm import language

DOCS = "/root/testdata/sf0.01/documents.parquet"


def plain_ngrams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    joined = " " + " ".join(words) + " "
    found = Counter(joined[i : i + n] for n in (1, 2, 3) for i in range(len(joined) - n + 1))
    return {g: k for g, k in found.items() if g != " " and not (len(g) == 3 and g[1] == " ")} if words else {}


def test_ngrams_as_defined():
    for text in ("", "12 !", "a", "Ab, ab-Çé 3x", "日本 語", "x  y"):
        grams, counts = language.ngrams(p) if len(p := language.letters(text)) else ([], [])
        got = {}
        for gram, count in zip(list(grams), list(counts)):
            gram, out = int(gram), ""
            while gram:
                out = chr(gram & (1 << 21) - 1) + out
                gram >>= 21
            got[out] = count
        assert got == plain_ngrams(text), text


def test_out_of_place_distance():
    code = lambda s: sum(ord(c) << 21 * i for i, c in enumerate(reversed(s)))
    profiles = language.Profiles({"x": [code("a"), code("b"), code(" a")], "y": [code("q")]}, 10)
    # "a b b": b 2, then " a", " b", "a", "a ", "b ", " a ", " b " once, in the order of their codes.
    lang, score = profiles.predict("b, a b")
    own = sorted(plain_ngrams("b, a b").items(), key=lambda item: (-item[1], code(item[0])))[:10]
    places = {"a": 0, "b": 1, " a": 2}
    want = sum(abs(places[g] - i) if g in places else 10 for i, (g, _) in enumerate(own))
    assert (lang, round(score, 9)) == ("x", round(1 - want / (10 * len(own)), 9))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DOCS)
    profiles = language.learn(docs.where(~language.held_out()), learn_from=50)
    found = language.predict(docs.where(language.held_out()), profiles)
    right = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.97


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, score string, row int"
    rows = [(1, "the cat and the hat", "en", "c", 1), (3, "le chat et le chapeau", "fr", "c", 1), (None, "der Hund", "de", "c", 1),
            (4, None, "en", "c", 1), (5, "", None, "c", 1), (6, "123 $", "en", "c", 1), (6, "the " * 40000, None, "c", 1), (7, "日本", None, "c", 1)]
    docs = spark.createDataFrame(rows, schema)
    profiles = language.learn(docs)
    assert profiles.languages == ["en", "fr"]
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.predict(docs, profiles).collect()]
    assert [x for x in got if x[0] in (4, 5)] == [(4, "und", 0.0), (5, "und", 0.0)]
    assert sorted(x[1] for x in got if x[0] == 6) == ["en", "und"]
    assert all(0 <= x[2] <= 1 for x in got)
    kept = language.identified(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {1, 3, 6, None}
    assert language.predict(docs.limit(0), language.learn(docs.limit(0))).count() == 0
    assert language.Profiles({}).predict("word") == ("und", 0.0)
