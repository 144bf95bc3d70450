"""Mixing sources to target weights by systematic sampling.

Sources share the total size by weight; a target stops at ``most`` times its
source's size and the excess goes to the others by weight. A document's
expected copies are its source's target over its source's size. Within a
source the expected copies are summed up in order of size; with one random
offset per source, a document is emitted once for each integer that its part
of the sum crosses. The order by size makes the emitted words follow the target
closely, whatever the offset.

The order is (size class, share hashed from doc_id and text, size, doc_id, text digest). Classes and
shares make buckets, so that a source with a third of all rows is ranked by
many tasks: bucket counts are summed up first (classes of a source, then
shares of a class), rows are ranked within their bucket only.

Defined results: a null text has size 0; a null source is a source of its own,
sorted last; a source of size 0 has target 0 and emits nothing; equal rows
are interchangeable; an empty table gives an empty table; other columns pass
through, but columns that start with ``prefix`` are replaced by the added ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlake.llm import common
from cohortlake.llm.common import Scratch

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
MOST = 3  # times its source's size that a target may be
SHARES = 1024  # hashed shares of a size class
CLASSES_PER_E = 12  # size classes per factor e


def _number(text: Column, digits: int) -> Column:
    """The first hex digits of the text's MD5 as a number."""
    return F.conv(F.left(F.md5(text), F.lit(digits)), 16, 10).cast("long")


def _bucketed(df: DataFrame, source: str, doc_id: str, text: str, p: str) -> DataFrame:
    size = F.size(common.words(F.col(text))).cast("long")
    out = df.drop(*[c for c in df.columns if c.startswith(p)]).withColumn(f"{p}size", size)
    return out.withColumns({
        f"{p}source": F.when(F.col(source).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source))),
        f"{p}class": F.floor(F.log(F.col(f"{p}size") + 1) * CLASSES_PER_E).cast("int"),
        # the text shares in, so that rows without an id, or with a common one, spread as well
        f"{p}share": (_number(F.concat_ws(":", F.col(doc_id).cast("string"), F.md5(text)), 8) % SHARES).cast("int"),
    })


def _ranked(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """Add ``at``, the place of each source in code point order, null last."""
    order = [F.col("source") == "n", F.col("source")]
    placed = scratch.table(sources.orderBy(*order).withColumn("row", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("row", 33)
    parts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # one row per sorted partition
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.withColumn("part", part).join(parts, "part").withColumn("at", F.col("before") + F.col("row").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "before", "row")


def targets(sources: DataFrame, weights: tuple[int, ...], most: int, scratch: Scratch) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Rounds of one aggregate: the level is what is left per unit of weight once
    every source that it would lift above its limit is held at the limit. It
    only rises, so the limits alone are the state; nothing but sums reach the driver.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int"))
    ranked = scratch.table(_ranked(sources, scratch).select("source", "source_size", weight.alias("weight")), "weights")
    limit = F.col("source_size") * most
    level, held = 0.0, -1
    while True:
        above = limit.cast("double") < F.lit(level) * F.col("weight")
        n, rest, units = ranked.agg(
            F.count(F.when(above, 1)), F.sum("source_size") - F.sum(F.when(above, limit).otherwise(0)), F.sum(F.when(~above, F.col("weight"))),
        ).first()
        if n == held or not units:
            break
        level, held = int(rest) / int(units), n
    target = F.when(above, limit.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(df: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = "mix",
        doc_id: str = "doc_id", text: str = "text", source: str = "source", prefix: str = "mix_") -> DataFrame:
    """Every row with ``<prefix>size``, ``<prefix>source_size``, ``<prefix>target`` and ``<prefix>copies``
    (how often the mix takes it). ``emitted`` turns copies into rows."""
    p = prefix
    rows = _bucketed(df, source, doc_id, text, p)
    keys = [f"{p}source", f"{p}class", f"{p}share"]
    buckets = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(f"{p}size").alias("words"))
    buckets = scratch.table(buckets.toDF("source", "class", "share", "n", "words"), "buckets")
    sources = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    goal = targets(sources, weights, most, scratch)
    earlier = lambda part, by: Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    of_class = buckets.groupBy("source", "class").agg(F.sum("n").alias("n"))
    of_class = of_class.select("source", "class", F.coalesce(F.sum("n").over(earlier(["source"], "class")), F.lit(0)).alias("before_class")).join(goal, "source")
    of_share = buckets.select("source", "class", "share", F.coalesce(F.sum("n").over(earlier(["source", "class"], "share")), F.lit(0)).alias("before_share"))
    facts = of_share.join(of_class, ["source", "class"]).select(
        F.col("source").alias(keys[0]), F.col("class").alias(keys[1]), F.col("share").alias(keys[2]),
        (F.col("before_class") + F.col("before_share")).alias(f"{p}before"),
        F.col("source_size").alias(f"{p}source_size"), F.col("target").alias(f"{p}target"),
    )
    facts = scratch.table(facts, "facts")
    scratch.keep_only("facts")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(f"{p}size", doc_id, F.md5(text)))
    out = rows.withColumn(f"{p}place", place).join(facts, keys)
    end = F.col(f"{p}before") + F.col(f"{p}place")
    rate = F.when(F.col(f"{p}source_size") > 0, F.col(f"{p}target") / F.col(f"{p}source_size")).otherwise(F.lit(0.0))
    offset = (_number(F.concat(F.lit(f"{seed}:"), F.col(keys[0])), 4) % 1024 + 0.5) / 1024
    copies = F.floor(end * rate + offset) - F.floor((end - 1) * rate + offset)
    return out.withColumn(f"{p}copies", F.least(copies, F.lit(most)).cast("int")).drop(*keys, f"{p}before", f"{p}place")


def emitted(mixed: DataFrame, prefix: str = "mix_") -> DataFrame:
    """One row per copy, numbered from 1 in ``<prefix>copy``."""
    taken = mixed.filter(F.col(f"{prefix}copies") > 0)
    return taken.withColumn(f"{prefix}copy", F.explode(F.sequence(F.lit(1), F.col(f"{prefix}copies"))))


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = common.documents(spark, sf_dir).select("doc_id", "text", "source")
    out = mix(docs, Scratch(spark, "mix"))
    return out.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                      F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: one row per copy that the mix takes."""
    out = emitted(mix(docs, Scratch(spark, "stage-mix")))
    return out.select(*docs.columns, F.col("mix_copy").alias("copy"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
w AS (SELECT *, CASE nth % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, nth) AS k,
        (SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER earlier, 0) AS rest,
        (SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER earlier, 0) AS units
      FROM w WINDOW earlier AS (ORDER BY 3.0 * source_size / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(rest::DOUBLE / units, k) AS level FROM o WHERE 3.0 * source_size >= rest::DOUBLE / units * weight),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, level * weight)::DOUBLE AS target FROM w, l),
r AS (SELECT doc_id, size, source_size, target,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
        row_number() OVER (PARTITION BY t.source ORDER BY floor(ln(size + 1) * 12),
          ('0x' || md5(concat_ws(':', doc_id::VARCHAR, md5(text)))[1:8])::BIGINT % 1024, size, doc_id NULLS FIRST, md5(text) NULLS FIRST) AS place,
        (('0x' || md5('mix:' || CASE WHEN t.source IS NULL THEN 'n' ELSE 's' || t.source END)[1:4])::BIGINT % 1024 + 0.5::DOUBLE) / 1024 AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * least(3, floor(place * rate + start) - floor((place - 1) * rate + start)))::BIGINT AS taken
FROM r
"""
