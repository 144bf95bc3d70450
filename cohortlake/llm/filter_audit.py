"""Filter interaction audit: what every filter removes in every order of the filters.

One pass of a byte transducer (``transducer``) counts words, distinct words,
capitals, code points and symbols of each text; four filters are rules on these
counts, the fifth fails repeated texts. A row's failures are a bit mask. Whatever
the order, a filter removes the rows that fail it and none of the filters before
it, so all orders follow from the number of rows by (part, mask): at most 32 masks
a part, however many rows there are.

Rows meet as narrow facts: (text digest, id, part, mask, n), summed up map-side
before every shuffle, so repeated rows, hot texts and hot ids shrink to single
rows before they move. The least id of each text joins on (digest, id), not on the digest
alone, so a text that a third of the rows hold is no single task's.

Defined results: a null text is empty; a null part counts with the empty string;
equal texts are those of equal SHA-256; a row fails as repeated if a smaller
non-null id holds its text, so a null id neither fails nor makes others fail, and rows that share
the least id all pass; an id with several labels counts as labelled if any says so; texts are
read whole; an empty table gives no parts and no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cohortlake.llm import common, transducer
from cohortlake.llm.common import Scratch

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50  # percent of the words
MAX_CAPITALS = 2  # percent of the code points
SYMBOLS = b"#$%&*|"
PARCEL = 1 << 20  # bytes of text that one call of the transducer takes, or one longer text
COUNTS = ("words", "distinct", "capitals", "points", "symbols")


def mask(c: transducer.Counts) -> np.ndarray:
    """Bits of the failed filters A to D."""
    failed = (c.words < MIN_WORDS, 100 * c.distinct < MIN_DISTINCT * c.words, 100 * c.capitals > MAX_CAPITALS * c.points, c.symbols > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(failed))


def measured(df: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(doc_id, part, digest, mask, words, distinct, capitals, points, symbols) of every row; mask covers A to D."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(body, 256)).alias("digest"), body.alias("text"))
    table = transducer.step_table(SYMBOLS)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("mask", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in COUNTS)])
    names, types = schema.names, [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            body = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            at = 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PARCEL, "right")) - 1)
                own = bounds[at : to + 1]
                c = transducer.counts(body[own[0] : own[-1]], own - own[0], table)
                part = batch.slice(at, to - at)
                made = [mask(c), *(getattr(c, n).astype(np.int64) for n in COUNTS)]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), *(pa.array(v, t) for v, t in zip(made, types[len(kept) :], strict=True))], names)
                at = to

    return rows.mapInArrow(run, schema)


def classes(facts: DataFrame, labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(part, mask, n, good, toxic): rows by part and failed filters A to E, those labelled good and toxic among them.
    ``facts`` is a written table."""
    rows = facts.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n"))
    known = rows.filter(F.col("doc_id").isNotNull())
    least = facts.filter(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    repeated = F.when(F.col("first").isNull(), 16).otherwise(0)
    known = known.join(least, ["digest", "doc_id"], "left").withColumn("mask", F.col("mask").bitwiseOR(repeated))
    known = known.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    one = labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(
        F.max((F.col(quality) == 1).cast("int")).alias("is_good"), F.max((F.col(toxic) == 1).cast("int")).alias("is_toxic"))
    known = known.join(one, "doc_id", "left")
    without = facts.filter(F.col("doc_id").isNull()).groupBy("part", "mask").agg(F.count("*").alias("n"))
    both = known.select("part", "mask", "n", "is_good", "is_toxic").unionByName(without, allowMissingColumns=True)
    among = lambda flag: F.sum(F.when(F.col(flag) == 1, F.col("n")).otherwise(0))
    return both.groupBy("part", "mask").agg(F.sum("n").alias("n"), among("is_good").alias("good"), among("is_toxic").alias("toxic"))


def audit(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from (part, mask, n, good, toxic)."""
    bits = {f: 1 << i for i, f in enumerate(filters)}
    steps = []
    for order in permutations(filters):
        for step, f in enumerate(order, 1):
            steps.append(("".join(order), step, bits[f], sum(bits[x] for x in order[: step - 1])))
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # at most 2 ** filters each
    literal = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(e).alias("earlier")) for o, s, b, e in steps])
    rows = parts.withColumn("s", F.explode(literal)).select("part", "masks", "s.*")

    def total(holds, value=lambda m: m["n"]) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"), lambda acc, m: acc + F.when(holds(m["mask"]), value(m)).otherwise(0).cast("long"))

    fails = lambda m, which: m.bitwiseAND(F.col(which)) != 0
    removed = lambda m: fails(m, "bit") & ~fails(m, "earlier")
    # a row that fails s filters is removed by each of them in orders / s of all orders
    orders = len({o for o, *_ in steps})
    share = lambda m: (m["n"] * orders / F.bit_count(m["mask"])).cast("long")
    return rows.select(
        "part", "filter_order", "step",
        total(lambda m: ~fails(m, "bit") & ~fails(m, "earlier")).alias("kept"),
        total(removed).alias("removed"),
        total(lambda m: fails(m, "bit") & fails(m, "earlier")).alias("redundant"),
        total(lambda m: m == F.col("bit")).alias("unique_fails"),
        total(removed, lambda m: m["good"]).alias("good_lost"),
        total(removed, lambda m: m["toxic"]).alias("toxic_lost"),
        total(lambda m: fails(m, "bit"), share).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents, by source."""
    facts = Scratch(spark, "audit").table(measured(common.documents(spark, sf_dir)), "facts")
    return audit(classes(facts, spark.read.parquet(f"{sf_dir}/labels.parquet")))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
         100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'),
         coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)] AS fails
      FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
k AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS p FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT p, step, p[step] AS own FROM o, (SELECT i AS step FROM k)),
r AS (SELECT s.p, s.step, c.*, fails[own] AS fail,
        (step > 1 AND fails[p[1]]) OR (step > 2 AND fails[p[2]]) OR (step > 3 AND fails[p[3]]) OR (step > 4 AND fails[p[4]]) AS gone,
        len(list_filter(fails, lambda x: x)) AS failing
      FROM c, s)
SELECT part, substr('ABCDE', p[1], 1) || substr('ABCDE', p[2], 1) || substr('ABCDE', p[3], 1) || substr('ABCDE', p[4], 1) || substr('ABCDE', p[5], 1) AS filter_order,
  step::INTEGER AS step,
  coalesce(sum(n) FILTER (NOT fail AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (fail AND NOT gone), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (fail AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fail AND failing = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (fail AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (fail AND NOT gone), 0)::BIGINT AS toxic_lost,
  sum(coalesce(sum(n) FILTER (fail AND NOT gone), 0)) OVER (PARTITION BY part, p[step])::BIGINT AS shapley
FROM r GROUP BY part, p, step
"""
