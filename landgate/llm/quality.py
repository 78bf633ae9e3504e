"""Line-first cleaning: rules judge every line, and a text that loses too much of itself is rejected.

A text is cut at \\n. A line with a word fails if

- punctuation: it has no letter or digit, or more than one of ``#*$%&|<>`` for two words;
- navigation: it has three bars or more, and one for three words at least;
- boilerplate: it is short and holds one of the stated phrases, or it repeats an earlier line.

Failing lines are removed. A text is rejected if the removed lines hold more than half of its word
characters, or if it breaks a rule on the whole text: too few words, or too many words inside
8-word windows that occur twice.

Defined results: a null text is a text without words and is rejected (``n_words`` 0); lines without a
word are neither judged nor counted; equal rows get equal results; the length of a text is not bounded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from landgate.llm import words as W
from landgate.llm.batches import kept_rows, measured
from landgate.llm.tables import table

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
BAR = "|"
NAVIGATION_BARS = 3
MAX_LOST_PERCENT = 50
BOILERPLATE_WORDS = 30
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "subscribe to our newsletter",
    "sign up for our newsletter",
    "click here to",
    "enable javascript",
    "share on facebook",
    "share on twitter",
    "log in to your account",
    "skip to content",
)
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_bad_lines long, lost_chars long"
)


def _marks(symbols: str) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[[ord(c) for c in symbols]] = True
    return marks


IS_SYMBOL, IS_BAR = _marks(SYMBOLS), _marks(BAR)
IS_POINT_START = (np.arange(256) & 0xC0) != 0x80
#: Letters and digits as bytes; every byte of a character beyond ASCII counts as one.
IS_ALNUM = W.ALNUM[W.LOWER]


def _holding(lower: bytes, phrases: tuple[str, ...], lines: W.Spans) -> np.ndarray:
    found = np.zeros(len(lines), bool)
    for phrase in phrases:
        wanted, at = phrase.encode(), lower.find(phrase.encode())
        while at >= 0:
            line = int(np.searchsorted(lines.start, at, "right")) - 1
            if line >= 0 and at + len(wanted) <= lines.end[line]:
                found[line] = True
            at = lower.find(wanted, at + 1)
    return found


def judged_lines(texts: W.Texts) -> dict:
    """The lines of a slice with their figures and a verdict for each."""
    data, n = texts.data, len(texts)
    is_word = W.NOT_SPACE[data]
    found = W.spans(texts, is_word)
    lines = W.spans(texts, W.NOT_NEWLINE[data])

    def per_line(at_byte):
        total = np.concatenate(([0], np.cumsum(at_byte, dtype=np.int64)))
        return total[lines.end] - total[lines.start]

    first_bytes = np.zeros(len(data), bool)
    first_bytes[found.start] = True
    n_words = per_line(first_bytes)
    symbols, bars = per_line(IS_SYMBOL[data]), per_line(IS_BAR[data])
    chars = per_line(is_word & IS_POINT_START[data])
    has_word = n_words > 0
    before = np.zeros(len(lines), bool)
    at = np.flatnonzero(has_word)
    worded = W.Spans(lines.start[at], lines.end[at], lines.text[at])
    _, before[at] = W.repeated(W.span_hashes(data, worded), worded.text)
    punctuation = (per_line(IS_ALNUM[data]) == 0) | (2 * symbols > n_words)
    navigation = (bars >= NAVIGATION_BARS) & (3 * bars >= n_words)
    phrased = _holding(W.LOWER[data].tobytes(), BOILERPLATE, lines) & (n_words <= BOILERPLATE_WORDS)
    bad = has_word & (punctuation | navigation | phrased | before)
    return {
        "words": found, "lines": lines, "n": n, "has_word": has_word, "before": before,
        "chars": chars, "bad": bad,
    }


def measure(column: pa.Array) -> dict:
    """The figures of every text of a column."""
    parts: dict[str, list] = {}
    for texts in W.slices(column):
        got = judged_lines(texts)
        found, lines, n = got["words"], got["lines"], got["n"]
        grams, at = W.gram_hashes(W.span_hashes(texts.data, found), found.text, WINDOW)
        again, _ = W.repeated(grams, found.text[at])
        step = np.zeros(len(found) + WINDOW, np.int64)
        np.add.at(step, at[again], 1)
        np.add.at(step, at[again] + WINDOW, -1)
        covered = np.cumsum(step)[: len(found)] > 0
        n_words = found.per_text(n)

        def total(weight, where):
            return np.bincount(where, weights=weight, minlength=n).astype(np.int64)

        repeat = total(covered, found.text)
        chars = total(got["chars"], lines.text)
        lost = total(got["chars"] * got["bad"], lines.text)
        failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEATED_PERCENT * n_words)
        for name, values in {
            "n_words": n_words,
            "word_chars": chars,
            "n_symbols": texts.per_text(IS_SYMBOL[texts.data]),
            "n_dup_lines": total(got["before"], lines.text),
            "n_repeat_words": repeat,
            "base_failed": failed,
            "kept": ~failed & (100 * lost <= MAX_LOST_PERCENT * chars),
            "n_lines": total(got["has_word"], lines.text),
            "n_bad_lines": total(got["bad"], lines.text),
            "lost_chars": lost,
        }.items():
            parts.setdefault(name, []).append(values)
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return {k: np.concatenate(parts[k]) if k in parts else np.zeros(0, np.int64) for k in names}


def clean_lines(column: pa.Array) -> pa.Array:
    """Every text without its failing lines; null stays null."""
    out: list[str] = []
    for texts in W.slices(column):
        got = judged_lines(texts)
        gone = np.zeros(len(texts.data), bool)
        for i in np.flatnonzero(got["bad"]):
            start, end = got["lines"].start[i], got["lines"].end[i]
            gone[start : end + 1 if end < texts.offsets[got["lines"].text[i] + 1] else end] = True
        left = texts.data[~gone].tobytes()
        ends = texts.offsets - np.concatenate(([0], np.cumsum(gone)))[texts.offsets]
        out += [left[a:b].decode() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return pc.if_else(column.is_null(), None, pa.array(out, pa.large_string()))


def quality_measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    return measured(docs, measure, SCHEMA, text, keep)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose texts pass, as they are."""
    return kept_rows(docs, lambda column: measure(column)["kept"], text)


def op2_line_rules(spark, sf_dir):
    return quality_measures(table(spark, sf_dir, "documents"))


def sql(documents: str = "documents") -> str:
    """The measures over a table with doc_id and text, as DuckDB SQL."""
    word = r"[^\x20\x09-\x0D]+"
    lower = "translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    phrases = " OR ".join(f"contains({lower}, '{p}')" for p in BOILERPLATE)
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM {documents}),
split AS (SELECT r, doc_id, text, regexp_extract_all(text, '{word}') AS w,
    string_split(text, chr(10)) AS l FROM texts),
runs AS (SELECT r, unnest(range(1, len(w) - {WINDOW - 2})) AS i, w FROM split WHERE len(w) >= {WINDOW}),
grams AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM runs),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c >= 2),
again AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM twice)
  GROUP BY r),
numbered AS (SELECT r, unnest(l) AS line, unnest(range(len(l))) AS k FROM split),
lines AS (SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY k) > 1 AS earlier,
    len(regexp_extract_all(line, '{word}')) AS n,
    len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
    len(regexp_extract_all(line, '[|]')) AS bars,
    length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    regexp_matches(line, '[0-9A-Za-z]|[^\x00-\x7F]') AS alnum FROM numbered),
judged AS (SELECT *, NOT alnum OR 2 * symbols > n OR (bars >= {NAVIGATION_BARS} AND 3 * bars >= n)
    OR earlier OR (n <= {BOILERPLATE_WORDS} AND ({phrases})) AS bad FROM lines WHERE n > 0),
whole AS (SELECT r, sum(chars) AS chars, count(*) FILTER (earlier) AS dup, count(*) AS n_lines,
    count(*) FILTER (bad) AS n_bad, coalesce(sum(chars) FILTER (bad), 0) AS lost FROM judged GROUP BY r),
flat AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(chars, 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    coalesce(dup, 0) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_bad, 0) AS n_bad_lines,
    CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars
  FROM split LEFT JOIN again USING (r) LEFT JOIN whole USING (r)),
failed AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words
    AS base_failed FROM flat)
SELECT *, NOT base_failed AND 100 * lost_chars <= {MAX_LOST_PERCENT} * word_chars AS kept FROM failed
"""


QUERIES = {"op2_line_rules": (op2_line_rules, sql())}
