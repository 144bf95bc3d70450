"""Metrics against a brute-force version; verdicts on planted and labelled documents."""

import random
import re
from collections import Counter

from cohortlake.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {p for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def test_metrics_equal_the_definitions(spark):
    rng = random.Random(1)
    parts = ["a", "b ", "c\n", "\n", " ", "é ", "\t", "x\x0b", "\x85", " ", "%", "|", "a b c d e f g h "]
    given = ["".join(rng.choices(parts, k=rng.randint(0, 80))) for _ in range(800)] + [None, "", " ", "a b c d e f g h " * 5000]
    given += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect()]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    fields = ["quality_n_words", "quality_word_chars", "quality_n_symbols", "quality_n_dup_lines", "quality_n_repeat_words", "quality_base_failed"]
    got = {r.doc_id: tuple(r[f] for f in fields) for r in quality_rules.clean(df).collect()}
    assert all(got[i] == brute(t) for i, t in enumerate(given))


def test_lines_are_removed_before_documents_are_judged(spark):
    rng = random.Random(5)
    prose = "\n".join(" ".join(f"w{rng.randint(0, 9999)}" for _ in range(14)) + "." for i in range(6))
    noisy = prose + "\nHome | News | About | Contact\nLicensed under the Apache License, Version 2.0.\nOK\nBUY NOW BUY TODAY CHEAP\n" + prose.split("\n")[0]
    shouting = "\n".join(" ".join(f"LOUD{rng.randint(0, 9999)}" for _ in range(9)) + "!!" for i in range(9))
    half = prose + "\n" + "\n".join(" ".join(f"x{i}{j} x{i}{j}" for j in range(5)) for i in range(10, 30))
    df = spark.createDataFrame([(1, prose), (2, noisy), (3, shouting), (4, half)], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules.clean(df).collect()}
    assert got[1].quality_kept and got[1].quality_text == prose and got[1].quality_n_failed_lines == 0
    assert got[2].quality_kept and got[2].quality_text == prose and got[2].quality_n_failed_lines == 5
    assert not got[3].quality_kept and not got[3].quality_base_failed
    assert not got[4].quality_kept and not got[4].quality_base_failed


def test_clean_documents_are_kept_and_bad_ones_rejected(spark):
    out = quality_rules.op6_quality_rules(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert all(r.kept or r.base_failed for r in out if r.quality == 1)
    assert sum(r.kept for r in out if r.quality == 0) <= 0.02 * sum(r.quality == 0 for r in out)
