"""Personal data, and the words around it that give it away.

Fixed patterns find e-mail addresses, IP addresses, card numbers and phone numbers. Each value
is a protected entity. Over the whole corpus it is counted in how many documents a word occurs with
an entity, in how many it occurs at all, and in how many the entity does. The word's pointwise
mutual information with the entity, as a share of the entity's own information, tells how strongly
the word reveals it: 1 means that the word never occurs without the entity. From ``GENERALISE`` on
a word is replaced by a general one, from ``REMOVE`` on it is taken out, in the documents that hold
that entity. One text, however often it was copied, is no estimate: a word must have been seen with
the entity in two different texts, or near it in two different contexts of one.

Defined results: a null text counts as empty and stays null when sanitised; an empty text has no
spans; repeated rows get the same spans; overlapping spans of different kinds are all reported and
replaced as one; ids are only passed on; an empty table gives no rows; other columns are kept by
``sanitise`` and not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.llm.common import stored, table

KINDS = ("email", "ip", "card", "phone", "term")
GENERALISE, REMOVE = 0.9, 0.97
#: Words on either side of an entity that are its context in a text, and the characters they are
#: sought in; all words of a text are paired with its entities.
NEAR_WORDS, NEAR_CHARS = 8, 120
#: Bits of the filter that tells which words need to be counted; it only saves work.
FILTER_BITS = 1 << 20

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# Starting inside a run of digits finds nothing that starting at its head doesn't.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W_]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from each @ outwards in linear time."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        low = found.end() if found else at + 1
        at = text.find("@", max(low, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order; kind is a place in ``KINDS``."""
    spans = [(start, 0, end) for start, end in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for found in _IP.finditer(text):
            if all(len(part.lstrip("0")) < 4 and int(part.lstrip("0") or 0) <= 255 for part in found[0].split(".")):
                spans.append((found.start(), 1, found.end()))
        for found in _CARD.finditer(text):
            if found.end() - found.start() <= 37 and 14 <= len(digits := _digits(found[0])) <= 19 and luhn(digits):
                spans.append((found.start(), 2, found.end()))
        if "+" in text:
            for found in _PHONE.finditer(text):
                if 10 <= len(_digits(found[0])) <= 15:
                    spans.append((found.start(), 3, found.end()))
    return sorted(spans)


def entity(text: str, kind: int, start: int, end: int) -> str:
    """The protected value, spelled alike wherever it occurs."""
    value = text[start:end]
    return f"{KINDS[kind]}:{value.lower() if kind == 0 else value if kind == 1 else _digits(value)}"


def words_near(text: str, start: int, end: int, covered: np.ndarray) -> list[tuple[str, int, int]]:
    """(word, start, end) of the words on either side that lie outside all base spans."""
    low, high = max(0, start - NEAR_CHARS), min(len(text), end + NEAR_CHARS)
    left = [m.span() for m in _WORD.finditer(text, low, start)]
    right = [m.span() for m in _WORD.finditer(text, end, high)]
    if left and left[0][0] == low and low and text[low - 1].isalnum():
        left.pop(0)
    if right and right[-1][1] == high and high < len(text) and text[high].isalnum():
        right.pop()
    near = left[-NEAR_WORDS:] + right[:NEAR_WORDS]
    at = np.searchsorted(covered[0], [b for _, b in near], "left")
    inside = [k > 0 and covered[1][k - 1] > a for k, (a, _) in zip(at, near)]
    return [(text[a:b].lower(), a, b) for (a, b), skip in zip(near, inside) if not skip]


def _covered(spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([s for s, _, _ in spans]), np.maximum.accumulate([e for _, _, e in spans])


def words_outside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(word, start, end) of the words that no base span touches, in order."""
    at, reach = 0, 0
    for found in _WORD.finditer(text):
        start, end = found.span()
        while at < len(spans) and spans[at][0] < end:
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= start:
            yield found[0].lower(), start, end


def varied_words(text: str, spans: list[tuple[int, int, int]], names: list[str]) -> list[tuple[str, str]]:
    """(entity, word) of the words that stand near an entity in two different contexts of one text."""
    if len(set(names)) == len(names):
        return []
    repeated = {name for name, times in Counter(names).items() if times > 1}
    covered, contexts = _covered(spans), {}
    for (start, _, end), name in zip(spans, names):
        if name in repeated:
            near = words_near(text, start, end, covered)
            context = xxhash.xxh3_64_intdigest(" ".join(w for w, _, _ in near).encode())
            for word in {w for w, _, _ in near}:
                first = contexts.setdefault((name, word), context)
                if first != context:
                    contexts[name, word] = None
    return sorted(pair for pair, context in contexts.items() if context is None)


def inspect(text: str) -> tuple:
    """(spans, entities, pairs, occurrences): what a text says by itself.

    Pairs are (entity, kind, word, context) for each entity and each distinct word of the text;
    the context is the whole text, by its hash. The queries don't write the pairs of a text out.
    """
    spans = base_spans(text)
    if not spans:
        return spans, [], [], []
    kinds = {entity(text, kind, start, end): kind for start, kind, end in spans}
    occurrences = list(words_outside(text, spans))
    context = xxhash.xxh3_64_intdigest(text.encode()) >> 1
    words = dict.fromkeys(word for word, _, _ in occurrences)
    pairs = [(name, kind, word, context) for name, kind in kinds.items() for word in words]
    return spans, sorted(kinds), pairs, occurrences


_ROW = (
    "doc_id long, text_key binary, n_email long, n_ip long, n_card long, n_phone long, "
    "base array<struct<start:long,kind:int,end:long>>, entities array<struct<entity:string,kind:int>>, "
    "varied array<struct<entity:string,word:string>>, text string"
)


def inspected(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``; ``text_key`` and ``text`` are null if it holds no entity."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_ROW))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(9)]
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = base_spans(text)
                kinds = [kind for _, kind, _ in spans]
                names = [entity(text, kind, start, end) for start, kind, end in spans]
                row = (
                    hashlib.md5(text.encode()).digest() if spans else None, *[kinds.count(k) for k in range(4)],
                    [dict(zip(("start", "kind", "end"), s)) for s in spans],
                    [dict(zip(("entity", "kind"), e)) for e in sorted(set(zip(names, kinds)))],
                    [dict(zip(("entity", "word"), v)) for v in varied_words(text, spans, names)],
                    text if spans else None,
                )
                for column, item in zip(columns, row):
                    column.append(item)
            arrays = [batch.column(0), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return plain.mapInArrow(look, _ROW)


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_key, word), each distinct word of a text once; of copies that follow each other, one."""
    last = None
    for batch in batches:
        keys, words = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if key == last:
                continue
            last, text = key, text.as_py()
            found = {word for word, _, _ in words_outside(text, base_spans(text))}
            keys += [key] * len(found)
            words += found
            if len(words) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(words, pa.string())], ["text_key", "word"])
                keys, words = [], []
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(words, pa.string())], ["text_key", "word"])


def document_counts(docs: DataFrame, words: DataFrame, text_column: str = "text") -> DataFrame:
    """(word, documents): in how many rows of ``docs`` each word of ``words`` occurs.

    A filter of fixed size, made from ``words``, keeps most other words from being counted.
    """
    place = F.pmod(F.col("h"), F.lit(FILTER_BITS))
    bits = np.zeros(FILTER_BITS, bool)
    hashed = words.mapInArrow(_hash_words, "h long")
    bits[hashed.select(place.alias("p")).distinct().toPandas()["p"].to_numpy(np.int64)] = True
    packed = np.packbits(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(packed).astype(bool)
        known: dict[str, bool] = {}
        held: dict[str, int] = {}

        def summed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "k"]
            )

        for batch in batches:
            for value in batch.column(0):
                for word in set(map(str.lower, _WORD.findall(value.as_py() or ""))):
                    if (want := known.get(word)) is None:
                        if len(known) >= 500_000:
                            known.clear()
                        want = known[word] = bool(wanted[_word_hash(word) % FILTER_BITS])
                    if want:
                        held[word] = held.get(word, 0) + 1
            if len(held) > 300_000:
                yield summed()
                held.clear()
        if held:
            yield summed()

    counts = docs.select(F.col(text_column).alias("text")).mapInArrow(count, "word string, k long")
    return counts.groupBy("word").agg(F.sum("k").alias("documents"))


def _word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode()) >> 1


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([_word_hash(w) for w in batch.column(0).to_pylist()], pa.int64())], ["h"])


def disclosing_words(
    docs: DataFrame, rows: DataFrame, generalise: float = GENERALISE, text_column: str = "text"
) -> DataFrame:
    """(text_key, words): for each text with an entity, the words of it that reveal it.

    ``words`` are (word, disclosure, kind), with the largest disclosure of the entities in the
    text. Each distinct word of a text is a pair with each entity of it. Pairs that can't reach
    ``generalise`` are not written out: as no more documents hold both than hold the entity, a word
    in more than of_entity * (total / of_entity) ** (1 - generalise) documents stays below it.
    Entities held by the same texts have the same pairs, so one of each kind stands for them.
    """
    total = float(max(rows.count(), 1))
    # Copies of one text count as documents but are one context, so they can't support a word alone.
    found = rows.where("text_key IS NOT NULL")
    held = found.select("text_key", "varied", F.explode("entities").alias("e")).groupBy("text_key", "e.entity", "e.kind")
    held = stored(held.agg(F.count(F.lit(1)).alias("copies")), "held")
    entities = held.groupBy("entity", "kind").agg(
        F.sum("copies").alias("of_entity"), F.count(F.lit(1)).alias("texts"),
        F.bit_xor(F.xxhash64("text_key", F.lit(1))).alias("x"), F.bit_xor(F.xxhash64("text_key", F.lit(2))).alias("y"),
    )
    entities = stored(entities, "entities")
    classes = entities.where("texts > 1").groupBy("kind", "of_entity", "texts", "x", "y").agg(F.min("entity").alias("entity"))
    bound = F.col("of_entity") * F.pow(F.lit(total) / F.col("of_entity"), F.lit(1 - generalise)) * (1 + 1e-9)
    classes = stored(classes.select("entity", "kind", "of_entity", bound.alias("bound")), "classes")
    several = stored(held.join(classes, ["entity", "kind"]), "several")
    varied = found.select("text_key", F.explode("varied").alias("v")).select("text_key", "v.*").distinct()
    varied = stored(varied.join(held, ["text_key", "entity"]).join(entities.select("entity", "of_entity"), "entity"), "varied")
    texts = found.select("text_key", "text").join(several.select("text_key").distinct(), "text_key", "left_semi")
    words = stored(texts.mapInArrow(_words_of, "text_key binary, word string").distinct(), "words")
    highest = classes.agg(F.max("bound")).first()[0] or 0.0
    # A word supports a pair by two texts of one entity, or by two contexts in one text. Before anything
    # is counted over all documents, words are left out that stand in more texts than any bound lets
    # pass, and pairs whose word stands in more than their own bound.
    held_by = words.groupBy("word").agg(F.count(F.lit(1)).alias("in_texts")).where((F.col("in_texts") > 1) & (F.col("in_texts") <= highest))
    paired = words.join(held_by, "word").join(several.select("text_key", "entity", "bound"), "text_key").where("in_texts <= bound")
    paired = paired.groupBy("entity", "word").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("word")
    wanted = stored(paired.union(varied.select("word")).distinct(), "wanted")
    of_word = stored(document_counts(docs, wanted, text_column).join(wanted, "word", "left_semi"), "of-word")
    rare = stored(words.join(of_word.where(F.col("documents") <= highest), "word"), "rare")
    candidates = rare.join(several, "text_key").where(F.col("documents") <= F.col("bound"))
    counted = candidates.groupBy("entity", "word").agg(
        F.sum("copies").alias("both"), F.count(F.lit(1)).alias("texts"), F.first("of_entity").alias("of_entity"),
        F.first("documents").alias("documents"),
    ).where("texts > 1")
    own = F.log2(F.lit(total) / F.col("of_entity"))
    mutual = F.log2(F.lit(total) * F.col("both") / (F.col("of_entity") * F.greatest("documents", "both")))
    # try_divide: an entity in every document has no information to disclose.
    disclosure, reveals = F.try_divide(mutual, own), F.col("disclosure") >= generalise
    revealing = stored(counted.withColumn("disclosure", disclosure).where(reveals).select("entity", "word", "disclosure"), "revealing")
    hit = candidates.join(revealing, ["entity", "word"]).select("text_key", "word", "disclosure", "kind")
    # What stands in several texts is found above; in one text, its copies are all documents with both.
    alone = varied.withColumnRenamed("copies", "both").join(of_word, "word").withColumn("disclosure", disclosure)
    alone = alone.where(reveals).select("text_key", "word", "disclosure", "kind")
    most = hit.union(alone).groupBy("text_key", "word").agg(F.max(F.struct("disclosure", "kind")).alias("m"))
    grouped = most.groupBy("text_key").agg(F.collect_list(F.struct("word", "m.disclosure", "m.kind")).alias("words"))
    return stored(grouped, "disclosing")


def _listed(spans: str) -> str:
    names = ", ".join(f"'{kind}'" for kind in KINDS)
    return f"array_join(transform({spans}, s -> concat(array({names})[s.kind], ':', s.start, ':', s.end)), ',')"


def find_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) of each row of ``docs``.

    ``base`` and ``spans`` list kind:start:end by start, then kind; the latter with the words.
    """
    from pyspark.sql.functions import arrow_udf

    term = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])

    @arrow_udf("array<struct<start:long,kind:int,end:long>>")
    def located(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, hits in zip(texts, found):
            text, known = text.as_py(), {h["word"] for h in hits.as_py() or ()}
            places = words_outside(text, base_spans(text)) if known else ()
            out.append([{"start": a, "kind": 4, "end": b} for word, a, b in places if word in known])
        return pa.array(out, pa.list_(term))

    rows = stored(inspected(docs, id_column, text_column), "inspected")
    words = disclosing_words(docs, rows, text_column=text_column)
    found = rows.where("text_key IS NOT NULL").join(words, "text_key", "left")
    # Documents without an entity, which have no key, need no look-up.
    kind = words.schema["words"].dataType
    without = rows.where("text_key IS NULL").withColumn("words", F.lit(None).cast(kind))
    found = found.unionByName(without).withColumn("_terms", located("text", "words"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.expr(_listed("base")).alias("base"),
        F.expr(_listed("array_sort(concat(base, _terms))")).alias("spans"),
    )


def replaced(text: str, words: dict[str, tuple[float, int]], remove: float = REMOVE) -> str:
    """The text with every entity and revealing word replaced; overlapping spans are one."""
    base = base_spans(text)
    spans = [(start, end, f"[{KINDS[kind].upper()}]") for start, kind, end in base]
    if words:
        for word, start, end in words_outside(text, base):
            if (hit := words.get(word)) is not None:
                label = "" if hit[0] >= remove else f"[{KINDS[hit[1]].upper()} CONTEXT]"
                spans.append((start, end, label))
    spans.sort()
    out, end = [], 0
    for start, stop, label in spans:
        if start >= end:
            out += [text[end:start], label]
        end = max(end, stop)
    return "".join(out) + text[end:]


def sanitise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with its texts sanitised; a column n_chars follows the texts that change."""
    from pyspark.sql.functions import arrow_udf

    rows = stored(inspected(docs, id_column, text_column), "inspected")
    words = disclosing_words(docs, rows, text_column=text_column)
    words = words.select(F.col("text_key").alias("_key"), F.col("words").alias("_words"))

    @arrow_udf("string")
    def clean(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, hits in zip(texts, found):
            known = {h["word"]: (h["disclosure"], h["kind"]) for h in hits.as_py() or ()}
            out.append(replaced(text.as_py(), known) if text.is_valid else None)
        return pa.array(out, pa.string())

    names = docs.columns
    keyed = docs.select(F.struct(*names).alias("_row"), F.col(text_column).alias("_text"))
    keyed = keyed.withColumn("_key", F.unhex(F.md5("_text")))
    done = keyed.join(words, "_key", "left").withColumn("_clean", clean("_text", "_words"))
    columns = [F.col("_clean").alias(name) if name == text_column else F.col("_row")[name].alias(name) for name in names]
    if "n_chars" in names:
        changed = ~F.col("_clean").eqNullSafe(F.col("_text"))
        size = F.when(changed, F.length("_clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
        columns[names.index("n_chars")] = size.alias("n_chars")
    return done.select(*columns)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )
