"""Quality classifier: a generalised additive model with pairwise interactions.

Every text is reduced to a few measures. Each measure is cut in quantile bins;
shallow trees over the bins, boosted in turn feature by feature, add up to one
lookup table per feature, and then to one per chosen pair of features. A score is the
sum of a row's bins through a logistic function.

The model is fitted on the driver on the measures of at most ``2 * PER_CLASS``
labelled documents (ids with the least hashes of each class; class weights
restore the true shares). Everything else is a pass over the rows.

Defined results: null and empty texts have the measures of no words and are
scored; texts are read whole; repeated rows score alike; without labels every
score is 0.5, with one class only its smoothed share; an empty table gives an
empty table; labels, language, source and id are no inputs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.llm import arrow_rows, common, labelled
from cohortlake.llm.common import Scratch
from cohortlake.llm.quality_rules import LINE_ENDS, repeated_words

PER_CLASS = 10_000
BINS, COARSE = 32, 8  # bins of a single feature, and of a feature in a pair
CYCLES, PAIR_CYCLES, PAIRS = 60, 30, 8
RATE, SMOOTH, LEAF_WEIGHT = 0.2, 1.0, 2.0

FEATURES = (
    "log_words", "word_length", "longest_word", "distinct_words", "stutter", "repeated", "symbols", "capitals", "digits",
    "marks", "exclamations", "pipes", "other_letters", "line_words", "short_lines", "repeated_lines", "ended_lines", "entropy",
)


def _is(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_BYTES = {
    "symbols": _is("#*$%&|<>=_~^{}[]\\@"), "capitals": _is("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": _is("0123456789"),
    "marks": _is(".,;:?'\"()-"), "exclamations": _is("!"), "pipes": _is("|"), "other_letters": np.arange(256) >= 128,
}


def measures(text: str | None) -> list[float]:
    """The features of a text, in the order of FEATURES."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()
    n = max(1, len(words))
    histogram = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = max(1, len(data))
    share = histogram[histogram > 0] / size
    lines = [line for line in text.split("\n") if line.strip()]
    m = max(1, len(lines))
    counts = {name: float(histogram[which].sum()) / size for name, which in _BYTES.items()}
    return [
        float(np.log1p(len(words))), sum(map(len, words)) / n, float(min(200, max(map(len, words), default=0))), len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, repeated_words(words) / n,
        *counts.values(),
        n / m, sum(len(line.split()) < 4 for line in lines) / m, 1 - len(set(lines)) / m if lines else 0.0,
        sum(line.rstrip()[-1] in LINE_ENDS for line in lines) / m, float(-(share * np.log2(share)).sum()),
    ]


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values of a shallow regression tree over ordered bins."""
    value = np.full(len(g), g.sum() / (h.sum() + SMOOTH))
    if not depth or len(g) < 2:
        return value
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + SMOOTH) + right_g**2 / (right_h + SMOOTH)
    gain[(left_h < LEAF_WEIGHT) | (right_h < LEAF_WEIGHT)] = -1
    at = int(gain.argmax())
    if gain[at] <= g.sum() ** 2 / (h.sum() + SMOOTH) + 1e-9:
        return value
    return np.concatenate((_tree(g[: at + 1], h[: at + 1], depth - 1), _tree(g[at + 1 :], h[at + 1 :], depth - 1)))


def _grid(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree over a grid: the best cut of the rows, then one of the columns on either side; its gain."""
    best, gain = np.full(g.shape, g.sum() / (h.sum() + SMOOTH)), 0.0
    for at in range(1, g.shape[0]):
        parts = [_tree(g[s].sum(axis=0), h[s].sum(axis=0), 1) for s in (slice(0, at), slice(at, None))]
        value = np.vstack([np.broadcast_to(p, (k, g.shape[1])) for p, k in zip(parts, (at, g.shape[0] - at), strict=True)])
        won = float((g * value).sum() - 0.5 * (h * value**2).sum())
        if won > gain:
            best, gain = value, won
    return best, gain


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)], axis=1)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """Edges, base, one table per feature and one per chosen pair."""
    total, positive = weight.sum(), (weight * y).sum()
    base = float(np.log((positive + 1) / (total - positive + 1)))
    model: dict = {"base": base, "edges": [], "tables": [], "coarse": [], "pairs": []}
    if not len(y) or y.min() == y.max():
        return model
    quantile = lambda k: [np.unique(np.quantile(x[:, f], np.arange(1, k) / k)) for f in range(x.shape[1])]
    model["edges"], model["coarse"] = quantile(BINS), quantile(COARSE)
    fine, coarse = _binned(x, model["edges"]), _binned(x, model["coarse"])
    weight = weight * len(weight) / total
    raw = np.full(len(y), base)
    tables = [np.zeros(len(e) + 1) for e in model["edges"]]

    def sums(cells: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        p = _sigmoid(raw)
        return np.bincount(cells, weight * (y - p), n), np.bincount(cells, weight * p * (1 - p), n)

    for _ in range(CYCLES):
        for f, table in enumerate(tables):
            step = RATE * _tree(*sums(fine[:, f], len(table)), 2)
            table += step
            raw += step[fine[:, f]]
    model["tables"] = tables
    widths = [len(e) + 1 for e in model["coarse"]]
    cell = lambda a, b: coarse[:, a] * widths[b] + coarse[:, b]
    square = lambda a, b: [s.reshape(widths[a], widths[b]) for s in sums(cell(a, b), widths[a] * widths[b])]
    gains = [(_grid(*square(a, b))[1], a, b) for a in range(x.shape[1]) for b in range(a + 1, x.shape[1])]
    chosen = [(a, b, np.zeros((widths[a], widths[b]))) for _, a, b in sorted(gains, reverse=True)[:PAIRS]]
    for _ in range(PAIR_CYCLES):
        for a, b, table in chosen:
            step = RATE * _grid(*square(a, b))[0]
            table += step
            raw += step[coarse[:, a], coarse[:, b]]
    model["pairs"] = chosen
    return model


def scores(model: dict, x: np.ndarray) -> np.ndarray:
    """Bin additions for all rows at once."""
    raw = np.full(len(x), model["base"])
    if model["tables"]:
        fine, coarse = _binned(x, model["edges"]), _binned(x, model["coarse"])
        for f, table in enumerate(model["tables"]):
            raw += table[fine[:, f]]
        for a, b, table in model["pairs"]:
            raw += table[coarse[:, a], coarse[:, b]]
    return _sigmoid(raw)


def measured(df: DataFrame, text: str = "text", name: str = "measures") -> DataFrame:
    """Replace the text by its measures."""
    field = T.StructField(name, T.ArrayType(T.DoubleType()))
    return arrow_rows.append(df, text, [field], lambda texts: [(measures(t),) for t in texts], drop=(text,))


def learned_from(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, measures, y): one row per labelled id; of rows that share an id, the one with the least measures."""
    met = rows.join(ids, F.col("doc_id") == F.col("labelled_id"))
    return met.groupBy("doc_id").agg(F.min("measures").alias("measures"), F.max("y").alias("y"))


def train(rows: DataFrame, labels: DataFrame, label: str, eligible, per_class: int = PER_CLASS) -> dict:
    """Fit on the measures of a bounded sample of labelled rows (doc_id, measures)."""
    ids, counts = labelled.sample(labels, label, eligible, per_class)
    ids = F.broadcast(ids.withColumnRenamed("doc_id", "labelled_id"))  # at most 2 * per_class ids
    found = learned_from(rows, ids).toPandas().sort_values("doc_id")
    x = np.array(found["measures"].tolist(), float).reshape(len(found), len(FEATURES))
    y = found["y"].to_numpy(float)
    weight = np.array([counts[int(v)] / max(1, (y == v).sum()) for v in y])
    return fit(x, y, weight)


def score(rows: DataFrame, model: dict, name: str = "score") -> DataFrame:
    """Replace the measures by the score."""
    kept = [f for f in rows.schema.fields if f.name != "measures"]

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("measures"))
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(scores(model, x))], [*(f.name for f in kept), name])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField(name, T.DoubleType())]))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; labels of rows with remainder 1 of 3 are not learned from."""
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    rows = Scratch(spark, "quality").table(measured(docs), "measures")
    model = train(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality", labelled.remainder("doc_id", 3) != 1)
    out = score(rows, model)
    return out.select("doc_id", (labelled.remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
