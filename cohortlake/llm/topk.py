"""Exact top-k search by columnar branch-and-bound.

Vectors lie in blocks of ``BLOCK``, each stored by dimension (vertical layout). A
block of queries meets a block of candidates one group of dimensions at a time, those
with most of the block's mass first. After each group, the score so far plus the
product of the two vectors' remaining mass (the norms of the dimensions not read yet)
bounds a candidate's score from above, and minus that product from below.
Candidates whose upper bound is under the k-th best lower bound, or under the k-th best score
of earlier blocks, are dropped; the survivors are compacted to pairs, and only these go on to the next
dimensions. A bound that equals the k-th best stays, so ties are decided by id.

Query blocks are dealt into groups and candidate blocks into shares; a task takes one
group and one share, bounded both, and sends at most k rows per query. So
a group of equal vectors is spread like any other rows. The best k of each query are taken
from these, map-side first.

Scores are exact integers: in doubles where every partial sum fits in 53 bits, else in
Python's integers without bounds.

Defined results: vectors that are null or hold a null or non-finite component take
no part; a shorter vector counts as filled up with zeros; rows with the query's id are its
own and no candidates; rows with one id are separate candidates, and each is a query of its own; a
null id is never a query and comes last in ties; fewer candidates than k give all
of them; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlake.llm import vectors
from cohortlake.llm.common import Scratch

TOP = 20
SCALE = 64
QUERY_EVERY = 20
BLOCK = 1024  # vectors of a block
DIMENSIONS = 8  # read at a time
GROUP = 32  # blocks of queries that a task takes at most, about
SHARE = 64  # blocks of candidates that a task takes at most, about
DENSE = 0.1  # share of the pairs below which survivors are compacted
LAST = np.iinfo(np.int64).max


def packed(table: DataFrame) -> DataFrame:
    """(block, ids, dimensions, columns): up to ``BLOCK`` vectors of ``table`` (vec_id, x) a row, dimension by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = vectors.matrix(part.column("x"))
                yield pa.RecordBatch.from_pydict({
                    "block": [block], "ids": [part.column("vec_id").to_pylist()], "dimensions": [x.shape[1]], "columns": [np.ascontiguousarray(x.T).tobytes()],
                }, pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("dimensions", pa.int32()), ("columns", pa.binary())]))
                block += 1

    return table.mapInArrow(run, "block bigint, ids array<bigint>, dimensions int, columns binary")


def _blocks(table: pa.Table) -> list[tuple[int, list, np.ndarray]]:
    """(block, ids, dimensions x vectors) in the order of the blocks."""
    rows = sorted(table.select(["block", "ids", "dimensions", "columns"]).to_pylist(), key=lambda r: r["block"])
    return [(r["block"], r["ids"], np.frombuffer(r["columns"], np.int64).reshape(r["dimensions"], len(r["ids"]))) for r in rows]


def _to_width(x: np.ndarray, width: int) -> np.ndarray:
    return x if len(x) == width else np.concatenate((x, np.zeros((width - len(x), x.shape[1]), x.dtype)))


def _remaining(x: np.ndarray) -> np.ndarray:
    """Norms of what is left of each vector (column) after each group of dimensions, a little rounded up."""
    after = np.cumsum((x * x)[::-1], axis=0)[::-1]
    left = [after[d] if d < len(x) else np.zeros(x.shape[1]) for d in range(DIMENSIONS, len(x) + DIMENSIONS, DIMENSIONS)]
    return np.sqrt(np.stack(left)) * (1 + 1e-9)


def survivors(q: np.ndarray, v: np.ndarray, same: np.ndarray, floor: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of all pairs that can be among their query's ``top``.

    ``q`` and ``v`` have a row per dimension, ``same`` marks pairs that are no candidates,
    ``floor`` is each query's ``top``-th best score so far (-inf if there are fewer).
    """
    width = max(len(q), len(v))
    q, v = _to_width(q, width), _to_width(v, width)
    largest = int(np.abs(q).max(initial=0)) * int(np.abs(v).max(initial=0)) * width
    if largest >= 2**50 or not width:
        scores = (q.astype(object).T @ v.astype(object)) if width else np.zeros((q.shape[1], v.shape[1]), np.int64)
        row, col = np.nonzero(~same)
        return row, col, scores[row, col].astype(np.int64)
    order = np.argsort(-(v.astype(np.float64) ** 2).sum(axis=1), kind="stable")
    q, v = q[order].astype(np.float64), v[order].astype(np.float64)
    left_q, left_v = _remaining(q), _remaining(v)
    scores, floor, row, col = np.zeros(same.shape), floor.copy(), None, None
    unknown = np.flatnonzero(np.isneginf(floor)) if v.shape[1] >= top else []
    for step, d in enumerate(range(0, width, DIMENSIONS)):
        dims = slice(d, d + DIMENSIONS)
        if row is None:
            scores += q[dims].T @ v[dims]
            slack = np.outer(left_q[step], left_v[step]) + 1e-6
            if len(unknown):
                lower = np.where(same[unknown], -np.inf, scores[unknown] - slack[unknown])
                floor[unknown] = np.maximum(floor[unknown], np.partition(lower, -top, axis=1)[:, -top])
            alive = (scores + slack >= floor[:, None]) & ~same
            if alive.mean() < DENSE or d + DIMENSIONS >= width:
                row, col = np.nonzero(alive)
                scores = scores[row, col]
        else:
            scores = scores + np.einsum("dp,dp->p", q[dims][:, row], v[dims][:, col])
            keep = scores + left_q[step, row] * left_v[step, col] + 1e-6 >= floor[row]
            row, col, scores = row[keep], col[keep], scores[keep]
    return row, col, np.rint(scores).astype(np.int64)


def best(row: np.ndarray, tie: np.ndarray, score: np.ndarray, top: int) -> np.ndarray:
    """Places of each row's ``top`` greatest scores, ties to the smaller ``tie``."""
    order = np.lexsort((tie, -score, row))
    own = row[order]
    place = np.arange(len(own)) - np.searchsorted(own, own)
    return order[place < top]


def _search(top: int):
    """The function for one group of queries and one share of candidates."""
    schema = pa.schema([("query_block", pa.int64()), ("query_row", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n in schema.names}
        found = _blocks(candidates)
        for block, query_ids, q in _blocks(queries):
            own = np.array(query_ids, np.int64)
            row, tie, score, vec = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), []
            for _, ids, v in found:
                # a null id stands last and equals no query's
                null = np.array([i is None for i in ids])
                key = np.array([LAST if i is None else i for i in ids], np.int64)
                floor = np.full(len(own), -np.inf)
                full = np.bincount(row, minlength=len(own)) >= top
                if full.any():  # row is sorted, each row's scores from the greatest
                    floor[full] = score[np.searchsorted(row, np.flatnonzero(full)) + top - 1]
                r, c, s = survivors(q, v, (own[:, None] == key[None, :]) & ~null[None, :], floor, top)
                row, tie, score = np.concatenate((row, r)), np.concatenate((tie, key[c])), np.concatenate((score, s))
                vec = vec + [ids[i] for i in c]
                keep = best(row, tie, score, top)
                row, tie, score, vec = row[keep], tie[keep], score[keep], [vec[i] for i in keep]
            for name, values in zip(schema.names, ([block] * len(row), row.tolist(), own[row].tolist(), vec, score.tolist()), strict=True):
                out[name] += values
        return pa.Table.from_pydict(out, schema)

    return run


def search(table: DataFrame, is_query: Column, scratch: Scratch, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``top`` best candidates among all rows of
    ``table`` (vec_id, x), a written table; queries are its rows where ``is_query`` holds and the id is not null."""
    asked = scratch.table(table.filter(F.col("vec_id").isNotNull() & is_query), "queries")
    n, parallel = asked.count(), table.sparkSession.sparkContext.defaultParallelism
    queries = scratch.table(packed(asked.repartition(1 + n // BLOCK)), "query-blocks")
    blocks = scratch.table(packed(table), "blocks")
    there = blocks.count()
    groups = 1 + n // (GROUP * BLOCK)
    shares = max(1, min(there, max(-(-there // SHARE), -(-2 * parallel // groups))))
    every = lambda ways: F.explode(F.sequence(F.lit(0), F.lit(ways - 1)))
    dealt = lambda ways: F.pmod(F.xxhash64("block"), F.lit(ways)).cast("int")
    q = queries.withColumn("group", dealt(groups)).withColumn("share", every(shares))
    c = blocks.withColumn("share", dealt(shares)).withColumn("group", every(groups))
    found = q.groupBy("group", "share").cogroup(c.groupBy("group", "share")).applyInArrow(
        _search(top), "query_block bigint, query_row int, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_block", "query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best candidates of every query, by inner product."""
    scratch = Scratch(spark, "top-k")
    table = scratch.table(vectors.integers(vectors.embeddings(spark, sf_dir), SCALE, "vec_id", "embedding"), "vectors")
    return search(table.withColumn("vec_id", F.col("vec_id").cast("long")), F.pmod("vec_id", F.lit(QUERY_EVERY)) == 0, scratch)


OP13_SQL = f"""
WITH e AS (SELECT row_number() OVER () AS v, vec_id, embedding FROM embeddings WHERE embedding IS NOT NULL),
u AS (SELECT v, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM e),
b AS (SELECT v FROM u WHERE x IS NULL OR NOT isfinite(x)),
r AS (SELECT v, vec_id FROM e ANTI JOIN b USING (v)),
x AS (SELECT v, d, floor({SCALE} * x)::BIGINT AS x FROM u SEMI JOIN r USING (v)),
q AS (SELECT * FROM r WHERE vec_id % {QUERY_EVERY} = 0),
p AS (SELECT a.v AS qv, b.v, sum(a.x * b.x) AS score FROM x a JOIN x b USING (d) WHERE a.v IN (SELECT v FROM q) GROUP BY ALL),
s AS (SELECT q.v, q.vec_id AS query_id, r.vec_id, coalesce(score, 0)::BIGINT AS score
      FROM q JOIN r ON r.vec_id IS DISTINCT FROM q.vec_id LEFT JOIN p ON p.qv = q.v AND p.v = r.v),
t AS (SELECT *, row_number() OVER (PARTITION BY v ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM t WHERE place <= {TOP}
"""
