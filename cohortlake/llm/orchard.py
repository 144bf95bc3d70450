"""Centroid clustering: Lloyd's rounds in exact integers, each vector's nearest
centroid found by Orchard's search.

Every centroid has the list of the others, sorted by their distance from it. A
vector's search starts at a centroid and walks down its list; as soon as a closer
centroid is found, it goes on with that one's list from the start. Centroids once
measured are marked and not measured again. The search stops where the list's next
centroid is strictly beyond twice the current distance: by the triangle inequality
that one and all behind it are strictly farther, so neither a nearer centroid nor an
equally near one with a smaller number is missed.

A round reads the vectors once. A task sums up its vectors by centroid and sends
(components + 1) * k numbers; they are added up in Spark, and (components + 1) * k
sums reach the driver, whatever the number of vectors. Centroids travel as
constants, so no lineage grows over the rounds.

Defined results: vectors that are null, of another length, or hold a null or
non-finite component take no part; repeated rows each count; a null id hashes as
empty text; with fewer than k vectors each is a centroid; no vectors give an empty
table; other columns are not read. Distances that do not fit in 64 bits
(components beyond 2**25 or so) raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import vectors
from cohortlake.llm.common import Scratch

K = 8
ROUNDS = 10
COMPONENTS = 64
SCALE = 1024
SEED = "3"


def squared(a: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=-1)


def neighbours(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances between centroids, and for each centroid the others from near to far."""
    gaps = np.stack([squared(centroids - c) for c in centroids])
    lists = [[int(j) for j in np.argsort(row, kind="stable") if j != i] for i, row in enumerate(gaps)]
    return gaps, np.array(lists, np.int64).reshape(len(centroids), len(centroids) - 1)


def nearest(x: np.ndarray, centroids: np.ndarray, gaps: np.ndarray, lists: np.ndarray, start: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid (ties: the
    smaller number), and how many distances were measured. All vectors walk at once."""
    n, k = len(x), len(centroids)
    at, place = np.full(n, start), np.zeros(n, np.int64)
    best = squared(x - centroids[start])
    marked = np.zeros((n, k), bool)
    marked[:, start] = True
    walking, measured = np.arange(n), n
    while walking.size:
        walking = walking[place[walking] < k - 1]
        other = lists[at[walking], place[walking]]
        within = gaps[at[walking], other] <= 4 * best[walking]
        walking, other = walking[within], other[within]
        place[walking] += 1
        fresh = ~marked[walking, other]
        row, other = walking[fresh], other[fresh]
        marked[row, other] = True
        d = squared(x[row] - centroids[other])
        measured += len(row)
        closer = (d < best[row]) | ((d == best[row]) & (other < at[row]))
        row = row[closer]
        at[row], best[row], place[row] = other[closer], d[closer], 0
    return at, best, measured


def _exact(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers where four times any squared distance fits, else as Python's integers."""
    most = max(int(abs(a).max(initial=0)) for a in (x, centroids))
    if 16 * most * most * x.shape[1] < 2**63:
        return x, centroids
    return x.astype(object), centroids.astype(object)


def _searched(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            x, c = _exact(vectors.matrix(batch.column("x"), centroids.shape[1]), centroids)
            yield batch, x, *nearest(x, c, *neighbours(c))[:2]


def _sums(table: DataFrame, centroids: np.ndarray) -> dict[int, list[int]]:
    """By centroid the number of its vectors, then their sum component by component."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width + 1), object)
        for _, x, at, _ in _searched(batches, centroids):
            for c in range(k):
                own = x[at == c]
                total[c] += [len(own), *(int(v) for v in own.sum(axis=0))]
        yield pa.RecordBatch.from_pydict({"cluster": list(range(k)), "total": total.tolist()}, pa.schema([("cluster", pa.int32()), ("total", pa.list_(pa.int64()))]))

    parts = table.mapInArrow(run, "cluster int, total array<bigint>")
    added = parts.select("cluster", F.posexplode("total")).groupBy("cluster", "pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("sum"))
    out = {c: [0] * (width + 1) for c in range(k)}
    for r in added.collect():  # k * (components + 1) rows
        out[r["cluster"]][r["pos"]] = int(r["sum"])
    return out


def seeds(table: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors with the least SHA-256 of ``<seed>:<vec_id>``, in that order; equal ids by their components."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r["x"] for r in table.orderBy(hashed, "x").limit(k).select("x").collect()]


def fit(table: DataFrame, k: int = K, rounds: int = ROUNDS, seed: str = SEED) -> np.ndarray:
    """The centroids (one row each) of the integer vectors ``table`` (vec_id, x) after ``rounds`` rounds."""
    centroids = np.array(seeds(table, k, seed), np.int64)
    for _ in range(rounds if len(centroids) else 0):
        sums = _sums(table, centroids)
        moved = [[s // n for s in total] if n else centroids[c].tolist() for c, (n, *total) in sorted(sums.items())]
        centroids = np.array(moved, np.int64)
    return centroids


def assign(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector; the distance is squared."""
    kind = table.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, at, best in _searched(batches, centroids):
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(at.astype(np.int32)), pa.array(best.tolist(), pa.int64())], ["vec_id", "cluster", "distance"])

    return table.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


def clusters(df: DataFrame, scratch: Scratch, k: int = K, rounds: int = ROUNDS, seed: str = SEED, components: int = COMPONENTS,
             scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector, written to the shared folder, and the centroids."""
    table = scratch.table(vectors.integers(df, scale, vec_id, vector, components), "vectors")
    centroids = fit(table, k, rounds, seed)
    if not len(centroids):
        return table.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    out = scratch.table(assign(table, centroids), "assigned")
    scratch.drop("vectors")
    return out, centroids


def op11_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance, inertia and centroid of every vector."""
    assigned, centroids = clusters(vectors.embeddings(spark, sf_dir), Scratch(spark, "orchard"))
    by = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = lambda values, kind: F.element_at(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster") + 1)
    return assigned.select(
        "vec_id", "cluster", "distance",
        of([by.get(c, 0) for c in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(by.values())).cast("long").alias("inertia"),
        of(digests, "string").alias("centroid_sha256"),
    )


def _op11_sql(k: int = K, rounds: int = ROUNDS) -> str:
    """The rounds written out, over one row per vector and component."""
    parts = [f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS v, vec_id, embedding FROM embeddings WHERE len(embedding) = {COMPONENTS}),
u AS (SELECT v, vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM e),
g AS (SELECT v FROM u GROUP BY v HAVING count(x) = {COMPONENTS} AND bool_and(isfinite(x))),
x AS MATERIALIZED (SELECT v, vec_id, d, floor({SCALE} * x)::BIGINT AS x FROM u SEMI JOIN g USING (v)),
f AS (SELECT v, row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), list(x ORDER BY d)) - 1 AS c FROM x GROUP BY v, vec_id),
c0 AS MATERIALIZED (SELECT c, d, x FROM x JOIN f USING (v) WHERE c < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT v, vec_id, arg_min(c, (dist, c)) AS c, min(dist) AS dist
  FROM (SELECT v, vec_id, c, sum((x.x - m.x) * (x.x - m.x))::BIGINT AS dist FROM x JOIN c{r} m USING (d) GROUP BY v, vec_id, c) GROUP BY v, vec_id)""")
        if r < rounds:
            parts.append(f"""s{r} AS (SELECT c, d, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM x JOIN a{r} USING (v) GROUP BY c, d),
c{r + 1} AS MATERIALIZED (SELECT m.c, m.d, CASE WHEN n IS NULL THEN m.x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{r} m LEFT JOIN s{r} USING (c, d))""")
    parts.append(f"""h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS sha FROM c{rounds} GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, dist AS distance, (sum(dist) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(dist) OVER ())::BIGINT AS inertia, sha AS centroid_sha256
FROM a{rounds} JOIN h USING (c)""")
    return ",\n".join(parts)


OP11_SQL = _op11_sql()
