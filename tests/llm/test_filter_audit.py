"""The byte transducer against regular expressions, the audit against removing rows filter by filter."""

import random
import re
from itertools import permutations

import numpy as np
import pytest

from cohortlake.llm import filter_audit, transducer
from cohortlake.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(texts):
    raw = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, raw)]).astype(np.int64)
    out = transducer.counts(np.frombuffer(b"".join(raw), np.uint8), bounds, transducer.step_table(filter_audit.SYMBOLS))
    return [tuple(int(v[i]) for v in out) for i in range(len(texts))]


def expected(text):
    words = WORD.findall(text)
    return len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))


@pytest.mark.parametrize("chunk", [1 << 20, 64, 7])
def test_transducer_counts_what_patterns_count(monkeypatch, chunk):
    monkeypatch.setattr(transducer, "CHUNK", chunk)
    rng = random.Random(chunk)
    alphabet = "aab AB\n\t\x0b\x0c\r\x1c\x85\xa0  #é漢😀|&z"
    texts = ["", " ", "a", " a ", "word", "é", "\n", "A" * 300, "one one One"]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(0, 90))) for _ in range(300)]
    texts += ["".join(rng.choices("ab ", k=5000)), "x" * 5000 + " " + "x" * 5000 + " " + "x" * 4999 + "y"]
    assert counted(texts) == [expected(t) for t in texts]
    assert counted([]) == []


def test_colliding_hashes_lose_no_word(monkeypatch):
    monkeypatch.setattr(transducer, "_hashes", lambda buffer, starts, lengths: np.zeros(len(starts), np.uint64))
    texts = ["ab ba ab ca ba", "ab ba", " ".join(f"w{i % 50:02}" for i in range(200))]
    assert [c[1] for c in counted(texts)] == [3, 2, 50]


def brute(docs, labels):
    first, flags, rows = {}, {}, {}
    for i, q, t in labels:
        good, toxic = flags.get(i, (0, 0))
        flags[i] = (max(good, q == 1), max(toxic, t == 1))
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    fails = []
    for i, text, part in docs:
        text = text or ""
        words = WORD.findall(text)
        bad = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
               "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and first[text] < i}
        fails.append((part or "", {f for f in bad if bad[f]}, *(flags.get(i, (0, 0)) if i is not None else (0, 0))))
    removed_in = {}
    for part in {f[0] for f in fails}:
        for order in permutations("ABCDE"):
            left = [f for f in fails if f[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                out = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removed_in[part, f] = removed_in.get((part, f), 0) + len(out)
                rows[part, "".join(order), step] = (len(left), len(out), sum(f in r[1] for r in gone), sum(r[1] == {f} and r[0] == part for r in fails),
                                                    sum(r[2] for r in out), sum(r[3] for r in out))
                gone += out
    return {k: (*v, removed_in[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def test_audit_equals_removing_rows_order_by_order(spark):
    rng = random.Random(3)
    many = [" ".join(f"{rng.choice('abX')}{rng.randint(0, n)}" for _ in range(k)) + rng.choice(["", " #", " é"]) for n, k in ((5, 40), (5, 260), (900, 230), (900, 10)) for _ in range(8)]
    docs = [(i, rng.choice(many), rng.choice(["a", "b", "", None])) for i in range(200)]
    docs += [(7, many[0], "a"), (7, many[0], "a"), (None, many[1], "a"), (None, many[1], None), (300, None, "c"), (301, "", "c"), (5, None, "a"), (5, many[3], "b")]
    docs += [(1000 + i, many[2], "hot") for i in range(100)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (9999, 1, 1)]
    scratch = Scratch(spark, "test")
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, source string, mask string").repartition(5)
    facts = scratch.table(filter_audit.measured(df), "facts")
    counted = filter_audit.classes(facts, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.audit(counted).collect()}
    assert got == brute(docs, labels) and len(got) == 600 * 5


def test_parcels_do_not_change_counts(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "PARCEL", 50)
    texts = ["a b a", None, "C " * 100, "", "é # é"] * 5
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r.doc_id: (r.words, r.distinct, r.capitals, r.points, r.symbols) for r in filter_audit.measured(df).collect()}
    assert got == {i: expected(t or "") for i, t in enumerate(texts)}
