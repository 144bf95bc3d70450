"""Targets and taken words of the mix."""

import random
from collections import defaultdict

import pytest

from cohortlake.llm import mixing
from cohortlake.llm.common import Scratch

SF = "/root/testdata/sf0.01"


def fill(sizes, weights, most):
    """Targets by adding excess to what is below its limit, round by round."""
    total, held = sum(sizes), [False] * len(sizes)
    target = [0.0] * len(sizes)
    while True:
        rest = total - sum(most * s for s, h in zip(sizes, held, strict=True) if h)
        units = sum(w for w, h in zip(weights, held, strict=True) if not h)
        target = [most * s if h else rest * w / units for s, w, h in zip(sizes, weights, held, strict=True)]
        above = [not h and t > most * s for s, t, h in zip(sizes, target, held, strict=True)]
        if not any(above):
            return target
        held = [h or a for h, a in zip(held, above, strict=True)]


@pytest.mark.parametrize("seed", range(4))
def test_targets_fill_up_to_their_limits(spark, seed):
    rng = random.Random(seed)
    names = sorted({f"s{rng.randint(0, 99)}é"[: rng.randint(2, 4)] for _ in range(12)}) + [None]
    sizes = [rng.choice([0, 3, 10, 50, 1000]) + 1 for _ in names]
    rows = [("n" if n is None else "s" + n, s) for n, s in zip(names, sizes, strict=True)]
    rng.shuffle(rows)
    out = mixing.targets(spark.createDataFrame(rows, "source string, source_size long"), (5, 2, 1), 3, Scratch(spark, "test"))
    got = {r.source: r.target for r in out.collect()}
    want = fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 3)
    assert all(abs(got["n" if n is None else "s" + n] - w) < 1e-6 * max(1, w) for n, w in zip(names, want, strict=True))


def test_every_source_comes_near_its_target_and_reruns_agree(spark):
    out = mixing.op1_mix(spark, SF).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, mixing.op1_mix(spark, SF).collect()))
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    taken, target, longest = defaultdict(int), {}, defaultdict(int)
    for r in out:
        source = docs[r.doc_id]
        taken[source] += r.taken
        target[source] = r.target
        longest[source] = max(longest[source], r.size)
        assert r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0
    assert abs(sum(target.values()) - sum(r.size for r in out)) < 1
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in target)


def test_copies_are_systematic_within_a_source(spark):
    """One source of equal documents, a second one that limits it: copies differ by one at most."""
    rows = [(i, "a b c", "big") for i in range(300)] + [(1000 + i, "a b c", "x") for i in range(30)] + [(2000, None, None), (None, "d e", "x")]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), Scratch(spark, "test"))
    got = out.collect()
    assert len(got) == len(rows)
    for source in ("big", "x"):
        own = [r for r in got if r.source == source and r.mix_size == 3]
        rate = own[0].mix_target / own[0].mix_source_size
        assert {r.mix_copies for r in own} <= {int(rate), int(rate) + 1}
        assert abs(sum(r.mix_copies for r in own) - rate * len(own)) <= 2
    assert [r.mix_copies for r in got if r.source is None] == [0]
    assert mixing.emitted(out).count() == sum(r.mix_copies for r in got)


def test_rows_without_an_id_spread_over_buckets(spark):
    """A third of the rows have no id: no bucket holds more than a small share of them."""
    from pyspark.sql import functions as F

    rows = [(None if i % 3 == 0 else i, f"word{i} of some text {i}", "s") for i in range(3000)]
    df = mixing._bucketed(spark.createDataFrame(rows, "doc_id long, text string, source string"), "source", "doc_id", "text", "mix_")
    largest = df.groupBy("mix_source", "mix_class", "mix_share").count().agg(F.max("count")).first()[0]
    assert largest <= 15
