"""Porter stems in SQL, step by step, for the queries that stem."""

from __future__ import annotations

from triplens.functions.stem import IRREGULAR, STEP2, STEP3, STEP4


# A character that no word holds.
_MARK = "\ue000"


def _shape(word: str) -> str:
    """0 for consonants and 1 for vowels; y is a vowel behind a consonant. Runs of up to eight y."""
    shape = f"translate(regexp_replace({word}, '[^aeiouy]', '0', 'g'), 'aeiou', '11111')"
    shape = f"regexp_replace({shape}, '^y', '0')"
    for _ in range(4):
        shape = f"replace(replace({shape}, '0y', '01'), '1y', '10')"
    return shape


def _measure(shape: str) -> str:
    return f"((length({shape}) - length(replace({shape}, '10', ''))) // 2)"


def _short(word: str, shape: str) -> str:
    return f"({shape} = '10' OR ({shape} LIKE '%010' AND right({word}, 1) NOT IN ('w', 'x', 'y')))"


def _rules(rules: dict[str, str], condition) -> str:
    """The longest suffix decides; its condition tells whether it is replaced."""
    cases = []
    for suffix in sorted(rules, key=len, reverse=True):
        size = len(suffix)
        cases.append(
            f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {condition(suffix, size)} "
            f"THEN left(w, -{size}) || '{rules[suffix]}' ELSE w END"
        )
    return f"CASE {' '.join(cases)} ELSE w END"


def stems_cte(words: str, name: str) -> str:
    """CTEs that give ``name`` (word, stem) for the words of the query ``words`` (column word)."""
    m = _measure
    doubled = "length(t) > 1 AND right(t, 1) = left(right(t, 2), 1) AND ts LIKE '%0' AND right(t, 1) NOT IN ('l', 's', 'z')"
    irregular = " ".join(f"WHEN '{word}' THEN '{stem}'" for word, stem in IRREGULAR.items())

    def step2(suffix: str, size: int) -> str:
        return f"{m(f'left(s, -{size - 1 if suffix == "logi" else size})')} > 0"

    def step4(suffix: str, size: int) -> str:
        more = f" AND (left(w, -{size}) LIKE '%s' OR left(w, -{size}) LIKE '%t')" if suffix == "ion" else ""
        return f"{m(f'left(s, -{size})')} > 1{more}"

    steps = [
        """CASE WHEN w LIKE '%sses' THEN left(w, -2)
            WHEN w LIKE '%ies' THEN CASE WHEN length(w) = 4 THEN left(w, -1) ELSE left(w, -2) END
            WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN left(w, -1) ELSE w END""",
        # The stem before -ed and -ing is marked, to be mended by the next step.
        f"""CASE WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN left(w, -1) ELSE left(w, -2) END
            WHEN w LIKE '%eed' THEN CASE WHEN {m('left(s, -3)')} > 0 THEN left(w, -1) ELSE w END
            WHEN w LIKE '%ed' AND contains(left(s, -2), '1') THEN left(w, -2) || '{_MARK}'
            WHEN w LIKE '%ing' AND contains(left(s, -3), '1') THEN left(w, -3) || '{_MARK}' ELSE w END""",
        f"""CASE WHEN w NOT LIKE '%{_MARK}' THEN w WHEN t LIKE '%at' OR t LIKE '%bl' OR t LIKE '%iz' THEN t || 'e'
            WHEN {doubled} THEN left(t, -1) WHEN {m('ts')} = 1 AND {_short('t', 'ts')} THEN t || 'e' ELSE t END""",
        "CASE WHEN w LIKE '%y' AND length(w) > 2 AND left(s, -1) LIKE '%0' THEN left(w, -1) || 'i' ELSE w END",
        f"CASE WHEN w LIKE '%alli' AND {m('left(s, -4)')} > 0 THEN left(w, -2) ELSE w END",
        _rules(STEP2, step2),
        _rules(STEP3, lambda suffix, size: f"{m(f'left(s, -{size})')} > 0"),
        _rules(dict.fromkeys(STEP4, ""), step4),
        f"""CASE WHEN w LIKE '%e' AND ({m('left(s, -1)')} > 1 OR ({m('left(s, -1)')} = 1
            AND NOT {_short('left(w, -1)', 'left(s, -1)')})) THEN left(w, -1) ELSE w END""",
        f"CASE WHEN w LIKE '%ll' AND {m('left(s, -1)')} > 1 THEN left(w, -1) ELSE w END",
    ]
    parts = [f"{name}_0 AS MATERIALIZED (SELECT DISTINCT word, lower(word) AS w FROM ({words}))"]
    for at, step in enumerate(steps):
        shaped = f"SELECT word, w, {_shape('w')} AS s, rtrim(w, '{_MARK}') AS t, {_shape(f"rtrim(w, '{_MARK}')")} AS ts FROM {name}_{at}"
        parts.append(f"{name}_{at + 1} AS MATERIALIZED (SELECT word, {step} AS w FROM ({shaped}))")
    parts.append(f"""{name} AS MATERIALIZED (
  SELECT word, CASE lower(word) {irregular} ELSE CASE WHEN length(word) <= 2 THEN lower(word) ELSE w END END AS stem
  FROM {name}_{len(steps)})""")
    return ",\n".join(parts)
