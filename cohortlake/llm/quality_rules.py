"""Quality rules, line first: lines that fail a rule are removed, then documents
that lose too much text, or that fail the base rules, are rejected.

Defined results: null, empty and blank texts have no words and are rejected;
texts of any length are read whole; repeated rows give repeated results; an
empty table gives an empty table; other columns pass through, and those named
like an added column (``prefix`` and its name) are replaced.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.llm import arrow_rows, common
from cohortlake.llm.common import BREAKS

#: Characters counted as symbols, and marks that may end a line.
SYMBOLS = "#*$%&|<>"
LINE_ENDS = ".!?…:;,\"'”’»)]"
#: Marks between the entries of a navigation line.
NAVIGATION_MARKS = "|»›·"
#: Phrases of lines that sites and licences repeat.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "terms of use", "terms of service",
    "privacy policy", "cookie policy", "accept cookies", "enable javascript", "click here", "sign up for",
    "subscribe to", "follow us on", "share this", "powered by", "general public license",
)

#: Line rules: a boilerplate line has at most so many words; a navigation line at
#: least so many marks; symbols and capitals may be so many percent of a line's
#: characters and ASCII letters; a line of fewer words needs an end mark.
BOILERPLATE_WORDS, NAVIGATION_COUNT, SYMBOL_PERCENT, CAPITAL_PERCENT, FREE_WORDS = 30, 3, 15, 60, 4
#: Of a line's words, percent that may equal the word before them.
STUTTER_PERCENT = 40
#: Document rules: words at least, percent of words in repeated windows and of words lost at most.
LEAST_WORDS, REPEAT_PERCENT, LOST_PERCENT, WINDOW = 20, 30, 50, 8

_PHRASES = re.compile("|".join(map(re.escape, BOILERPLATE)), re.ASCII | re.IGNORECASE)
_CAPITALS, _LETTERS = re.compile("[A-Z]+"), re.compile("[A-Za-z]+")
_FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()), T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()), T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    T.StructField("n_kept_words", T.LongType()), T.StructField("n_failed_lines", T.LongType()),
]


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside a window of ``width`` words that the text has twice or more.
    Windows get exact ids by doubling: pairs of ids of half the width."""
    n = len(words)
    if n <= width:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    if len(known) == n:
        return 0
    reach, counts = 1, None
    while reach < width:
        step = min(reach, width - reach)
        pairs = ids[: len(ids) - step] * (n + 1) + ids[step:]
        _, ids, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(counts) == len(ids):
            return 0  # no window of this reach occurs twice, so no wider one does
        reach += step
    starts = np.flatnonzero(counts[ids] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges)[:n] > 0).sum())


def line_fails(line: str, words: list[bytes], seen: bool) -> bool:
    """Whether a line that has words is removed."""
    n_words = len(words)
    if 100 * sum(a == b for a, b in zip(words, words[1:], strict=False)) > STUTTER_PERCENT * n_words:
        return True
    if seen or sum(map(line.count, NAVIGATION_MARKS)) >= NAVIGATION_COUNT:
        return True
    if n_words <= BOILERPLATE_WORDS and _PHRASES.search(line):
        return True
    if 100 * sum(map(line.count, SYMBOLS)) > SYMBOL_PERCENT * len(line):
        return True
    letters = sum(map(len, _LETTERS.findall(line)))
    if 100 * sum(map(len, _CAPITALS.findall(line))) > CAPITAL_PERCENT * letters and n_words >= FREE_WORDS:
        return True
    return n_words < FREE_WORDS and line.rstrip(BREAKS)[-1] not in LINE_ENDS


def measure(text: str | None, with_text: bool) -> tuple:
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    chars = len(text) - sum(map(text.count, BREAKS))
    seen: set[str] = set()
    good: list[str] = []
    dup = failed = kept_words = 0
    for line in text.split("\n"):
        own = line.encode("utf-8", "replace").split()
        if not own:
            good.append(line)
            continue
        again = line in seen
        seen.add(line)
        dup += again
        if line_fails(line, own, again):
            failed += 1
        else:
            kept_words += len(own)
            good.append(line)
    repeat = repeated_words(words)
    base_failed = len(words) < LEAST_WORDS or 100 * repeat > REPEAT_PERCENT * len(words)
    kept = not base_failed and 100 * (len(words) - kept_words) <= LOST_PERCENT * len(words)
    out = (len(words), chars, sum(map(text.count, SYMBOLS)), dup, repeat, base_failed, kept, kept_words, failed)
    return (*out, "\n".join(good).strip(BREAKS) if failed else text) if with_text else out


def clean(df: DataFrame, text: str = "text", prefix: str = "quality_", with_text: bool = True) -> DataFrame:
    """Add the metrics and the verdict of every row, and with ``with_text`` the
    cleaned text (``<prefix>text``; equal to the text where no line failed)."""
    fields = [T.StructField(prefix + f.name, f.dataType) for f in _FIELDS]
    if with_text:
        fields.append(T.StructField(f"{prefix}text", T.StringType()))
    return arrow_rows.append(df, text, fields, lambda texts: [measure(t, with_text) for t in texts])


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and verdict of every document."""
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    fields = [f for f in _FIELDS]
    return arrow_rows.append(docs, "text", fields, lambda texts: [measure(t, False) for t in texts], drop=("text",))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go, failed lines go from the others."""
    done = clean(docs).filter("quality_kept")
    done = done.withColumn("text", F.col("quality_text"))
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)
