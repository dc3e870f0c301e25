"""Personal data: spans against the patterns as stated, disclosure against plain counting."""

import math
import random
import re

from triplens.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern in ((2, CARD), (3, PHONE)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 3 and 10 <= len(digits) <= 15 or kind == 2 and 14 <= len(digits) <= 19 and pii.luhn(digits):
                spans.append((m.start(), kind, m.end()))
    return sorted(spans)


def test_spans_as_stated():
    rng = random.Random(3)
    bits = ["a@b.c", "@", "x.y+z@", "d-e.f", "1.2.3.4", "256.1.1.1", ".5", "4111 1111 1111 1111", "4111-1111", "+49 (30) 12345-678",
            "+", "12", " ", "é", "_", "..", "@@a@b.co", "(", "0001.2.3.4", "-", "日"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        assert pii.base_spans(text) == plain(text), text


def test_long_texts_take_linear_time():
    for part in ("1", "1.", "a@", "@", "a", "+1", "1 ", "a."):
        pii.inspect(part * 200_000)


SCHEMA = "doc_id long, text string, n_chars long, words string, kind int"


def corpus():
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    fill = lambda: " ".join(rng.choice(vocabulary) for _ in range(30))
    texts = [fill() for _ in range(60)]
    for i in range(4):  # a word that occurs near one address only, in different contexts
        texts.append(f"{fill()} zanzibar writes to ann@example.org {fill()} zanzibar")
    texts += [f"{fill()} qqqqq mail bob@example.org"] * 5  # copies: one context
    return [*texts, None, "", "call +49 30 1234567 or 10.0.0.1", "x" * 100_000]


def test_disclosure_against_counting(spark):
    rows = [(i, t, None if t is None else len(t), "c", 1) for i, t in enumerate(corpus())]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.doc_id: r for r in pii.find_spans(docs).collect()}
    total = len(rows)
    looked = {i: pii.inspect(t or "") for i, t, *_ in rows}
    holds = {i: {m[0].lower() for m in pii._WORD.finditer(t or "")} for i, t, *_ in rows}
    both, of_entity = {}, {}
    for i, (_, names, pairs, _) in looked.items():
        for name in names:
            of_entity[name] = of_entity.get(name, 0) + 1
        for name, _, word, context in pairs:
            both.setdefault((name, word), []).append(context)
    revealing = set()
    for (name, word), contexts in both.items():
        documents = sum(word in h for h in holds.values())
        if len(set(contexts)) > 1:
            own = math.log2(total / of_entity[name])
            if math.log2(total * len(contexts) / (of_entity[name] * documents)) / own >= pii.GENERALISE:
                revealing.add((name, word))
    assert ("email:ann@example.org", "zanzibar") in revealing
    assert not any(word == "qqqqq" for _, word in revealing)
    for i, (spans, _, pairs, occurrences) in looked.items():
        words = {w for n, _, w, _ in pairs if (n, w) in revealing}
        want = sorted([*spans, *[(a, 4, b) for w, a, b in occurrences if w in words]])
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert got[i].spans == listed
    clean = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    for i, text, *_ in rows:
        if not looked[i][0]:
            assert clean[i].text == text
        else:
            assert not pii.base_spans(clean[i].text) and clean[i].n_chars == len(clean[i].text)
    assert "zanzibar" not in clean[61].text and "[EMAIL]" in clean[61].text
    assert set(clean[61].asDict()) == {"doc_id", "text", "n_chars", "words", "kind"}


def term_words(spark, texts):
    docs = spark.createDataFrame([(i, t, len(t), "c", 1) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    out = []
    for r in sorted(pii.find_spans(docs).collect(), key=lambda r: r.doc_id):
        places = [s.split(":")[1:] for s in r.spans.split(",") if s.startswith("term:")]
        out.append({texts[r.doc_id][int(a) : int(b)].lower() for a, b in places})
    return out, {r.doc_id: r.text for r in pii.sanitise(docs).collect()}


def filler(seed, count=40):
    rng = random.Random(seed)
    return " ".join("w" + "".join(rng.choice("abc") for _ in range(2)) for _ in range(count))


def test_words_far_from_the_entity_disclose(spark):
    """A letterhead, a customer number and a name of two letters, all more than 20 words away."""
    texts = [filler(i) for i in range(60)]
    texts += [f"Zanzibar Wu K4711 990017 {filler(100 + i)} ann@example.org" for i in range(3)]
    words, clean = term_words(spark, texts)
    for i in range(60, 63):
        assert {"zanzibar", "wu", "k4711", "990017"} <= words[i]
        assert not re.search("Zanzibar|Wu|K4711|990017|ann@", clean[i]) and "[EMAIL]" in clean[i]
    assert not any(words[:60])


def test_signature_repeated_word_for_word_is_support(spark):
    """The near words are the same in each text; the texts differ."""
    sign = "best wishes from your contact person for all questions Zanzibar ann@example.org thanks for reading this message to its very end"
    texts = [filler(i) for i in range(60)] + [f"{filler(100 + i)} {sign}" for i in range(4)]
    words, _ = term_words(spark, texts)
    assert all("zanzibar" in w for w in words[60:])


def test_contexts_of_one_document_are_support(spark):
    texts = [filler(i) for i in range(60)]
    texts.append(f"Zanzibar: ann@example.org {filler(7)} now Zanzibar ann@example.org {filler(8)} yetonce")
    texts += [f"qqqqq bob@example.org {filler(9)}"] * 3  # copies with one context
    words, clean = term_words(spark, texts)
    assert "zanzibar" in words[60] and "yetonce" not in words[60]
    assert not any("qqqqq" in w for w in words[61:])
    assert "[EMAIL]" in clean[60]


def test_word_at_the_head_of_an_address_keeps_its_label():
    assert pii.replaced("ann: ann@example.org", {"ann": (1.0, 0)}) == ": [EMAIL]"


def test_directory_of_many_entities(spark):
    """Entities held by the same texts are counted as one: no pairs of 3,000 by 3,000."""
    listed = " ".join(f"name{i} u{i}@example.org" for i in range(3000))
    words, _ = term_words(spark, [filler(i) for i in range(60)] + [f"first {listed}", f"second {listed}"])
    assert all({f"name{i}" for i in range(3000)} <= w for w in words[60:])


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert pii.find_spans(docs).count() == 0 and pii.sanitise(docs).count() == 0
