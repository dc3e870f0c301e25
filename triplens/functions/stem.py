"""Porter stemming (M. F. Porter, "An algorithm for suffix stripping", 1980).

With the usual departures from the paper: a few irregular words, words of one or two letters
left alone, "-ies"/"-ied" of four-letter words kept as "-ie", "y" turned into "i" only behind a
consonant that is not the first letter, and the suffix rules "bli", "alli", "fulli" and "logi".
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Irregular words and their stems.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}

# Suffix rules of steps 2, 3 and 4.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "fulli": "ful", "logi": "log", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize",
    "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def _shape(word: str) -> str:
    """The word as a string of c(onsonants) and v(owels); y is a vowel behind a consonant."""
    shape = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    """Number of vowel-consonant sequences."""
    return _shape(stem).count("vc")


def _ends_short(word: str) -> bool:
    """Consonant, vowel, consonant other than w, x, y at the end; or just vowel, consonant."""
    shape = _shape(word)
    if shape == "vc":
        return True
    return shape.endswith("cvc") and word[-1] not in "wxy"


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word).endswith("c")


def _longest(word: str, suffixes) -> str | None:
    found = [suffix for suffix in suffixes if word.endswith(suffix)]
    return max(found, key=len) if found else None


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    suffix = _longest(word, ("ed", "ing"))
    if suffix is None or "v" not in _shape(word[: -len(suffix)]):
        return word
    stem = word[: -len(suffix)]
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_consonant(stem) and stem[-1] not in "lsz":
        return stem[:-1]
    if _measure(stem) == 1 and _ends_short(stem):
        return stem + "e"
    return stem


def _final_y(word: str) -> str:
    stem = word[:-1]
    if word.endswith("y") and len(stem) > 1 and _shape(stem).endswith("c"):
        return stem + "i"
    return word


def _replace(word: str, rules: dict[str, str]) -> str:
    suffix = _longest(word, rules)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    if suffix == "alli" and _measure(stem) > 0:
        return _replace(stem + "al", rules)
    # "logi" is measured with its l.
    measured = stem + "l" if suffix == "logi" else stem
    return stem + rules[suffix] if _measure(measured) > 0 else word


def _residual(word: str) -> str:
    suffix = _longest(word, STEP4)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
        return stem
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        size = _measure(stem)
        if size > 1 or (size == 1 and not _ends_short(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@lru_cache(maxsize=1 << 17)
def stem_word(word: str) -> str:
    """Stem of one word."""
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _plural(word)
    word = _past(word)
    word = _final_y(word)
    word = _replace(word, STEP2)
    word = _replace(word, STEP3)
    return _tidy(_residual(word))


def _stem_batch(words: pa.Array) -> pa.Array:
    """Stem a string array through its dictionary: Python sees each distinct word once."""
    encoded = words.dictionary_encode()
    stems = pa.array([stem_word(word) for word in encoded.dictionary.to_pylist()], pa.string())
    return stems.take(encoded.indices)


@F.arrow_udf(ArrayType(StringType()))
def _stem_arrays(tokens: pa.Array) -> pa.Array:
    stems = _stem_batch(tokens.flatten())
    sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = pa.array([0, *sizes.cumsum().tolist()], pa.int32())
    return pa.ListArray.from_arrays(offsets, stems, mask=tokens.is_null())


@F.arrow_udf(StringType())
def _stem_strings(words: pa.Array) -> pa.Array:
    return _stem_batch(words)


def stem_tokens(tokens: Column) -> Column:
    """Stem every element of an array column; no shuffle, whole batches through Arrow."""
    return _stem_arrays(tokens)


def stem(word: Column) -> Column:
    """Stem a string column."""
    return _stem_strings(word)
