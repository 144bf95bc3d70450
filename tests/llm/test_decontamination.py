"""Containment against all pairs of documents and items."""

import random
import re

from cohortlake.llm import decontamination
from cohortlake.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").lower())
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    out = set()
    for i, text in items:
        own = shingles(text)
        for d, other in docs:
            both = len(own & shingles(other))
            if own and 100 * both >= 80 * len(own):
                out.add((d, i, len(own), both))
    return out


def test_finds_every_item_in_long_documents(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(800)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 4, 5, 6, 12, 30, 70])))) for i in range(60)] + [(60, None), (61, " ")]
    docs = [(1000, None), (1001, ""), (1002, " \t")]
    for d in range(150):
        words = rng.choices(vocabulary, k=rng.choice([0, 30, 300]))
        for _ in range(rng.randint(0, 2)):
            part = (items[rng.randrange(60)][1]).upper().split()
            if rng.random() < 0.5 and len(part) > 20:
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = part[: rng.choice([len(part), len(part) - 1, len(part) * 9 // 10])]
        docs.append((d, rng.choice([" ", "\n", "\t "]).join(words)))
    docs.append((5000, " ".join(rng.choices(vocabulary, k=20000)) + " " + items[6][1]))
    docs.append(docs[20])
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 30
    for limit in (decontamination.BROADCAST_SHINGLES, 0):  # both ways of joining
        monkeypatch.setattr(decontamination, "BROADCAST_SHINGLES", limit)
        got = decontamination.contained(a, b, Scratch(spark, "test")).collect()
        assert {(r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in got} == want and len(got) == len(want)


def test_the_plan_runs_no_python(spark):
    out = decontamination.op8_decontaminate(spark, "/root/testdata/sf0.001")
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()


def test_the_stage_keeps_clean_rows_that_share_an_id_with_a_leaked_one(spark, tmp_path):
    leak = "one two three four five six seven eight"
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"a {leak} b"), (None, "clean text without an id"), (None, None), (7, leak.upper()), (7, "clean text with a repeated id"), (7, leak), (8, "clean")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = decontamination.stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted([rows[1], rows[2], rows[4], rows[6]], key=repr)
