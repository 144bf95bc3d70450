"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's checksum gives two buckets; the two buckets' vectors side by side are
its embedding, and only if training texts use both buckets, so that a word
only takes over another's meaning if both buckets collide. Filters of several widths slide over the whole text, the largest
response of each is kept (max pooling), and a linear layer over those gives
the score. Trained in numpy with Adam; only the positions that win the pooling
carry gradient. The embeddings start from how much oftener a bucket is seen in
texts of class 1 than chance allows. Buckets that fewer than ``LEAST_TEXTS`` training texts use stay
zero, so that unseen words say nothing however long the text is.

The model learns from the words of every labelled document, in Spark tasks. The
documents are dealt by the hash of their ids to shards of about ``ROWS_A_SHARD``. A round
broadcasts the model, every shard goes through its own documents with Adam, and the
mean of the shards' changes (of a bucket: of the shards that changed it) is the next
model. The changes are summed as whole numbers, so that neither tasks nor their order matter;
only sums reach the driver, at most the model's size. A document stays a row of its own: a
shard's are sorted into one partition, and a task puts them together batch by batch. The
documents of a single shard are gone through in one task. A fifth of the labelled documents sets one threshold per language,
from exact counts of their scores in ``CUTS`` steps. The language chooses a
threshold for ``flagged``; it is no input of the score.

Defined results: null and empty texts have no words and score the model's bias;
texts are read whole; repeated rows score alike; a null or unseen language has
threshold 0.5; without labels every score is 0.5, with one class only its
smoothed share; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.llm import common, labelled
from cohortlake.llm.common import Scratch, sized

ROWS_A_SHARD, WORDS_A_SHARD = 8000, 8_000_000  # about; the more shards of both counts
ROUNDS = 4  # passes over documents of several shards
STEP = 1 << 30  # changes are summed in steps of its inverse
CUTS = 10_000  # thresholds are whole numbers of its inverse
BITS, HALF = 18, 8  # buckets (as a power of two) and values of each half
BUCKETS = 1 << BITS
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH, RATE, DECAY = 8, 32, 0.01, 1e-4
LEAST_TEXTS = 3
LEAST_CASES = 5  # of each class that a language needs for a threshold of its own
LEAST_STEPS = 600  # a small sample is gone through oftener than EPOCHS times
WORDS_AT_ONCE = 100_000  # words that are scored in one go

_WORD = re.compile(r"[^\W\d_]+")


def hashed(text: str | None) -> np.ndarray:
    """32-bit checksum of every word in order."""
    found = _WORD.findall((text or "").lower())
    return np.fromiter((crc32(w.encode("utf-8", "replace")) for w in found), np.uint32, len(found))


def buckets(ids: np.ndarray, half: str) -> np.ndarray:
    """The bucket of each checksum: its low bits, or the high bits of a product."""
    return ids & np.uint32(BUCKETS - 1) if half == "low" else ids * np.uint32(2654435761) >> np.uint32(32 - BITS)


def _pair(model: dict, ids: np.ndarray) -> np.ndarray:
    """Both halves side by side, zero unless both buckets are used (a used bucket's first value is never 0)."""
    low, high = model["low"][buckets(ids, "low")], model["high"][buckets(ids, "high")]
    both = (low[..., :1] != 0) & (high[..., :1] != 0)
    return np.concatenate((low, high), axis=-1) * both


def _embedded(model: dict, ids: np.ndarray) -> np.ndarray:
    """Embeddings, with a margin of zero rows behind for the widest filter."""
    out = np.zeros((len(ids) + max(WIDTHS) - 1, 2 * HALF), np.float32)
    out[: len(ids)] = _pair(model, ids)
    return out


def _responses(model: dict, x: np.ndarray, n: int) -> np.ndarray:
    """Response of every filter at each of the first n positions."""
    out = []
    for width in WIDTHS:
        window = np.concatenate([x[i : i + n] for i in range(width)], axis=1) if width > 1 else x[:n]
        out.append(window @ model[f"filter{width}"] + model[f"shift{width}"])
    return np.concatenate(out, axis=1)


def _uses(texts: list[np.ndarray], y: np.ndarray, half: str) -> tuple[np.ndarray, np.ndarray]:
    """For each bucket of a half, the number of texts that use it, and of those of class 1."""
    seen, positive = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for ids, label in zip(texts, y, strict=True):
        own = np.unique(buckets(ids, half))
        seen[own] += 1
        positive[own] += label
    return seen, positive


def _odd(seen: np.ndarray, positive: np.ndarray, share: float) -> np.ndarray:
    """For each bucket, the standardised excess of texts of class 1 (a share of all
    texts) among those that use it; 0 below LEAST_TEXTS."""
    excess = (positive - seen * share) / np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    return np.where(seen >= LEAST_TEXTS, np.where(excess == 0, 1e-6, excess), 0.0)


def new_model(rng: np.random.Generator, odd: dict[str, np.ndarray]) -> dict:
    model = {"dense": rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), "bias": np.zeros(1, np.float32)}
    for half, excess in odd.items():
        table = rng.normal(0, 0.02, (BUCKETS, HALF))
        table[:, 0] = np.clip(excess / 10, -1, 2)
        model[half] = (table * (excess != 0)[:, None]).astype(np.float32)
    for width in WIDTHS:
        model[f"filter{width}"] = rng.normal(0, 0.3, (width * 2 * HALF, FILTERS)).astype(np.float32)
        model[f"shift{width}"] = np.zeros(FILTERS, np.float32)
    return model


def pooled(model: dict, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of each filter over each text, not below 0, and its position (-1: none above 0)."""
    top = np.zeros((len(texts), len(WIDTHS) * FILTERS), np.float32)
    where = np.full(top.shape, -1)
    for t, ids in enumerate(texts):
        for at in range(0, len(ids), WORDS_AT_ONCE):
            n = min(WORDS_AT_ONCE, len(ids) - at)
            found = _responses(model, _embedded(model, ids[at : at + n + max(WIDTHS) - 1]), n)
            best = found.argmax(axis=0)
            value = found[best, np.arange(found.shape[1])]
            better = value > top[t]
            top[t, better], where[t, better] = value[better], best[better] + at
    return top, where


def scores(model: dict, texts: list[np.ndarray]) -> np.ndarray:
    if "dense" not in model:
        return np.full(len(texts), model["share"])
    raw = pooled(model, texts)[0] @ model["dense"] + model["bias"][0]
    return 1 / (1 + np.exp(-np.clip(raw.astype(float), -30, 30)))


def fit(texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, seed: int = 7) -> dict:
    """Train on hashed texts; without two classes the model is the smoothed share."""
    if not len(y) or y.min() == y.max():
        return {"share": float(((weight * y).sum() + 1) / (weight.sum() + 2))}
    rng = np.random.default_rng(seed)
    odd = {half: _odd(*_uses(texts, y, half), y.mean()) for half in ("low", "high")}
    used = {half: excess != 0 for half, excess in odd.items()}
    model = new_model(rng, odd)
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(texts)))
    _learn(model, used, texts, y, weight * len(weight) / weight.sum(), rng, range(epochs), epochs)
    return model


def _learn(model: dict, used: dict[str, np.ndarray], texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray,
           rng: np.random.Generator, passes: range, epochs: int) -> None:
    """Go through the texts, in these passes of all ``epochs``, and change the model in place."""
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    steps = 0
    for epoch in passes:
        rate = RATE * (1 - epoch / epochs) + RATE / 20
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            slopes = _slopes(model, used, [texts[i] for i in chosen], y[chosen], weight[chosen])
            steps += 1
            for k, (index, g) in slopes.items():
                g = g + DECAY * model[k][index]
                first[k][index] = 0.9 * first[k][index] + 0.1 * g
                second[k][index] = 0.999 * second[k][index] + 0.001 * g * g
                model[k][index] -= rate * (first[k][index] / (1 - 0.9**steps)) / (np.sqrt(second[k][index] / (1 - 0.999**steps)) + 1e-8)


def _slopes(model: dict, used: dict[str, np.ndarray], texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> dict:
    """(rows, gradient) of each array of the model over a batch."""
    top, where = pooled(model, texts)
    p = 1 / (1 + np.exp(-np.clip(top @ model["dense"] + model["bias"][0], -30, 30)))
    error = (weight * (p - y) / len(texts)).astype(np.float32)
    back = error[:, None] * model["dense"][None, :] * (where >= 0)
    out: dict = {"dense": (slice(None), top.T @ error), "bias": (slice(None), np.array([error.sum()], np.float32))}
    margin = np.zeros(max(WIDTHS) - 1, np.uint32)
    words = np.concatenate([part for ids in texts for part in (ids, margin)])
    real = np.concatenate([part for ids in texts for part in (np.ones(len(ids), np.float32), margin.astype(np.float32))])
    starts = np.cumsum([0] + [len(ids) + len(margin) for ids in texts[:-1]])
    seen, pulls = [], []
    for w, width in enumerate(WIDTHS):
        t, f = np.nonzero(back[:, w * FILTERS : (w + 1) * FILTERS])
        pull = back[t, w * FILTERS + f]
        place = (starts[t] + where[t, w * FILTERS + f])[:, None] + np.arange(width)[None, :]
        here, there = words[place], real[place]
        e = _pair(model, here) * there[:, :, None]
        slope, shift = np.zeros((FILTERS, width * 2 * HALF), np.float32), np.zeros(FILTERS, np.float32)
        np.add.at(slope, f, pull[:, None] * e.reshape(len(t), width * 2 * HALF))
        np.add.at(shift, f, pull)
        out[f"filter{width}"], out[f"shift{width}"] = (slice(None), slope.T), (slice(None), shift)
        own = (pull[:, None] * model[f"filter{width}"].T[f]).reshape(len(t), width, 2 * HALF) * there[:, :, None]
        seen.append(here.ravel())
        pulls.append(own.reshape(-1, 2 * HALF))
    found, pulled = np.concatenate(seen), np.concatenate(pulls)
    for half, part in (("low", pulled[:, :HALF]), ("high", pulled[:, HALF:])):
        rows, at = np.unique(buckets(found, half), return_inverse=True)
        g = np.zeros((len(rows), HALF), np.float32)
        np.add.at(g, at, part)
        out[half] = (rows, g * used[half][rows][:, None])
    return out


def threshold(bins: np.ndarray, clean: np.ndarray, toxic: np.ndarray, weight: tuple[float, float] = (1.0, 1.0)) -> float:
    """The cut of the best weighted F1, of counts of both classes by score in steps of ``1 / CUTS``;
    0.5 where a class has few cases or 0.5 does as well."""
    if min(clean.sum(), toxic.sum()) < LEAST_CASES:
        return 0.5
    of = [w * np.bincount(bins, n, CUTS + 1) for w, n in zip(weight, (clean, toxic), strict=True)]
    below, hit = (np.cumsum(x[::-1])[::-1] for x in of)  # rows at or above each cut
    f1 = np.round(2 * hit / np.maximum(1e-9, below + hit + of[1].sum()), 6)
    best = np.flatnonzero(f1 == f1.max())
    return int(best[np.abs(best - CUTS // 2).argmin()]) / CUTS


def learned_from(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, words, lang, y): one row per labelled id; of rows that share an id, the one whose
    hashed words (then language) come first. They are reduced in Spark, map-side first."""

    def run(batches):
        for batch in batches:
            words = [hashed(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary()), batch.column(2), batch.column(3)], ["doc_id", "words", "lang", "y"])

    met = docs.join(ids, F.col("doc_id") == F.col("labelled_id")).select(F.col("doc_id").cast("long"), "text", "lang", "y")
    met = met.mapInArrow(run, "doc_id long, words binary, lang string, y int")
    one = met.groupBy("doc_id").agg(F.min(F.struct("words", "lang")).alias("least"), F.max("y").alias("y"))
    return one.select("doc_id", "least.words", "least.lang", "y")


def _texts(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
    """Words and labels of rows with these fields."""
    words, y = (batch.column(n) for n in ("words", "y"))
    return [np.frombuffer(w, np.uint32) for w in words.to_pylist()], y.to_numpy(zero_copy_only=False).astype(float)


def excesses(rows: DataFrame, share: float) -> dict[str, np.ndarray]:
    """``_odd`` of both halves over all rows (words, y), counted in tasks."""

    def run(batches):
        counts = {half: np.zeros((2, BUCKETS), np.int64) for half in ("low", "high")}
        for batch in batches:
            for half, count in counts.items():
                count += np.stack(_uses(*_texts(batch), half)).astype(np.int64)
        for half, (seen, positive) in counts.items():
            own = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array([half] * len(own), pa.string()), pa.array(own), pa.array(seen[own]), pa.array(positive[own])], ["half", "bucket", "seen", "positive"])

    met = rows.select("words", "y").mapInArrow(run, "half string, bucket long, seen long, positive long")
    met = met.groupBy("half", "bucket").agg(F.sum("seen").alias("seen"), F.sum("positive").alias("positive")).toArrow()
    out = {}
    for half in ("low", "high"):
        at = np.array(met["half"].to_pylist(), object) == half
        seen, positive = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for to, name in ((seen, "seen"), (positive, "positive")):
            to[met["bucket"].to_numpy()[at]] = met[name].to_numpy()[at]
        out[half] = _odd(seen, positive, share)
    return out


def _shard_id(shards: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")


def in_shards(rows: DataFrame, shards: int) -> DataFrame:
    """(shard, words, y): the documents, each shard whole in one partition and in order of the ids."""
    dealt = rows.withColumn("shard", _shard_id(shards)).repartition(shards, "shard")
    return dealt.sortWithinPartitions("shard", "doc_id").select("shard", "words", "y")


def _each_shard(batches):
    """(shard, words, labels) of each shard in turn, put together from batches that follow each other."""
    at, texts, labels = None, [], []
    for batch in batches:
        number = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1), len(number)]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            if begin == end:
                continue
            if texts and number[begin] != at:
                yield at, texts, np.concatenate(labels)
                texts, labels = [], []
            at = int(number[begin])
            own, y = _texts(batch.slice(begin, end - begin))
            texts += own
            labels.append(y)
    if texts:
        yield at, texts, np.concatenate(labels)


def learned_round(shards: DataFrame, model: dict, used: dict[str, np.ndarray], weight: tuple[float, float], passes: range, epochs: int, draw) -> dict:
    """The model after every shard went through its documents from ``model`` on: plus the mean change.
    ``draw`` gives the generator of a shard's number."""
    halves, rest = ("low", "high"), [k for k in model if k not in ("low", "high")]
    shared = shards.sparkSession.sparkContext.broadcast((model, used))
    flat = lambda m: np.concatenate([m[k].ravel() for k in rest])
    width = -(-len(flat(model)) // HALF)  # rows of the flat part

    def run(batches):
        start, use = shared.value
        total = {k: np.zeros((BUCKETS, HALF), np.int64) for k in halves} | {"rest": np.zeros((width, HALF), np.int64)}
        count = {k: np.zeros(len(v), np.int64) for k, v in total.items()}
        for number, texts, y in _each_shard(batches):
            mine = {k: v.copy() for k, v in start.items()}
            _learn(mine, use, texts, y, np.where(y == 1, weight[1], weight[0]), draw(number), passes, epochs)
            for k in halves:
                at = np.flatnonzero((mine[k] != start[k]).any(axis=1))
                total[k][at] += np.rint((mine[k][at].astype(float) - start[k][at]) * STEP).astype(np.int64)
                count[k][at] += 1
            change = np.zeros(width * HALF)
            change[: len(flat(start))] = flat(mine).astype(float) - flat(start)
            total["rest"] += np.rint(change * STEP).astype(np.int64).reshape(width, HALF)
            count["rest"] += 1
        for k, v in total.items():
            at = np.flatnonzero(count[k])
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(at), pa.array(count[k][at]), *(pa.array(v[at, i]) for i in range(HALF))], names)

    names = ["part", "at", "n", *(f"v{i}" for i in range(HALF))]
    types = ", ".join(f"{n} {'string' if n == 'part' else 'long'}" for n in names)
    met = shards.mapInArrow(run, types).groupBy("part", "at").agg(*(F.sum(n).alias(n) for n in names[2:])).toArrow()
    shared.unpersist()
    part, at = np.array(met["part"].to_pylist(), object), met["at"].to_numpy()
    mean = np.stack([met[f"v{i}"].to_numpy() for i in range(HALF)], axis=1) / (met["n"].to_numpy()[:, None] * float(STEP))
    out = {k: v.copy() for k, v in model.items()}
    for k in halves:
        mine = part == k
        out[k][at[mine]] += mean[mine]
    change = np.zeros((width, HALF))
    change[at[part == "rest"]] = mean[part == "rest"]
    begin = 0
    for k in rest:
        out[k] += change.ravel()[begin : begin + out[k].size].reshape(out[k].shape)
        begin += out[k].size
    return out


def learned(rows: DataFrame, found: dict[int, int], words: int, weight: tuple[float, float], seed: int = 7) -> dict:
    """Train on all rows (doc_id, words, y), ``found`` of each class; without two classes the model is the smoothed share."""
    n, mass = sum(found.values()), sum(weight[y] * k for y, k in found.items())
    if len(found) < 2:
        return {"share": float((weight[1] * found.get(1, 0) + 1) / (mass + 2))}
    odd = excesses(rows, found[1] / n)
    used = {half: excess != 0 for half, excess in odd.items()}
    rng = np.random.default_rng(seed)
    model = new_model(rng, odd)
    count = max(1, -(-n // ROWS_A_SHARD), -(-words // WORDS_A_SHARD))
    shards = in_shards(rows, count)
    epochs = max(EPOCHS if count == 1 else ROUNDS, -(-LEAST_STEPS * BATCH // n))
    scaled = (weight[0] * n / mass, weight[1] * n / mass)
    if count == 1:  # as ``fit`` does
        return learned_round(shards, model, used, scaled, range(epochs), epochs, lambda number: rng)
    shards.persist(StorageLevel.DISK_ONLY)  # dealt once; partitions stay whole, as files that are read again need not
    for epoch in range(epochs):
        model = learned_round(shards, model, used, scaled, range(epoch, epoch + 1), epochs, lambda number, epoch=epoch: np.random.default_rng((seed, epoch, number)))
    shards.unpersist()
    return model


def thresholds(rows: DataFrame, model: dict, weight: tuple[float, float]) -> dict[str, float]:
    """The threshold of each language among rows (words, lang, y), where it is not 0.5."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts, _ = _texts(batch)
            p = np.concatenate([scores(shared.value, texts[i : i + 256]) for i in range(0, len(texts), 256)]) if texts else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.floor(p * CUTS).astype(np.int64)), batch.column(2)], ["lang", "bin", "y"])

    def cut(group):
        bins, clean, toxic = (group[c].to_numpy() for c in ("bin", "clean", "toxic"))
        found = threshold(bins, clean, toxic, weight)
        return pd.DataFrame({"lang": group["lang"].iloc[:1], "cut": [found]}) if found != 0.5 else pd.DataFrame({"lang": [], "cut": []}).astype({"lang": object, "cut": float})

    spoken = rows.filter(F.col("lang") != "").select("lang", "words", "y").mapInArrow(run, "lang string, bin long, y int")
    # at most CUTS + 1 rows a language
    counts = spoken.groupBy("lang", "bin").agg(F.count_if(F.col("y") == 0).alias("clean"), F.count_if(F.col("y") == 1).alias("toxic"))
    return {r["lang"]: r["cut"] for r in counts.groupBy("lang").applyInPandas(cut, "lang string, cut double").collect()}


def train(docs: DataFrame, labels: DataFrame, label: str, eligible) -> tuple[dict, dict[str, float]]:
    """(model, threshold of each language where it is not 0.5) from all labelled rows of ``docs`` (doc_id, text, lang)."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    ids, counts = labelled.every(labels, label, eligible)
    ids = sized(scratch.table(ids.withColumnRenamed("doc_id", "labelled_id"), "ids"))
    rows = scratch.table(learned_from(docs, ids), "rows")
    aside = F.crc32(F.concat(F.lit("aside:"), F.col("doc_id").cast("string"))) % 5 == 0
    sums = rows.groupBy("y", aside.alias("aside")).agg(F.count("*").alias("n"), F.sum(F.length("words") / 4).alias("words")).collect()
    # ids of a class without a document leave its documents the class's true weight
    every = {y: sum(r["n"] for r in sums if r["y"] == y) for y in (0, 1)}
    weight = tuple(counts.get(y, 0) / max(1, every[y]) for y in (0, 1))
    found = {r["y"]: r["n"] for r in sums if not r["aside"]}
    model = learned(rows.filter(~aside), found, int(sum(r["words"] for r in sums if not r["aside"])), weight)
    cuts = thresholds(rows.filter(aside), model, weight)
    scratch.drop("ids", "rows")
    return model, cuts


def score(docs: DataFrame, model: dict, cuts: dict[str, float], text: str = "text", lang: str = "lang", prefix: str = "toxic_") -> DataFrame:
    """Replace the text by ``<prefix>score``, ``<prefix>threshold`` and ``<prefix>flagged``; other columns pass through.
    The model is broadcast (2 * BUCKETS * HALF floats, 17 MB)."""
    names = [f"{prefix}{n}" for n in ("score", "threshold", "flagged")]
    docs = docs.drop(*names)  # columns named like the added ones are replaced
    kept = [f for f in docs.schema.fields if f.name != text]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at, lang_at = docs.columns.index(text), docs.columns.index(lang)
    positions = [i for i, f in enumerate(docs.schema.fields) if f.name != text]
    names = [*(f.name for f in kept), *names]

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                p = scores(shared.value, [hashed(t) for t in part.column(text_at).to_pylist()])
                cut = np.array([cuts.get(x, 0.5) for x in part.column(lang_at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in positions), pa.array(p), pa.array(cut), pa.array(p >= cut)], names)

    types = [T.DoubleType(), T.DoubleType(), T.BooleanType()]
    return docs.mapInArrow(run, T.StructType([*kept, *(T.StructField(n, t) for n, t in zip(names[-3:], types, strict=True))]))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; labels of rows with remainder 0 of 5 are not learned from."""
    docs = common.documents(spark, sf_dir).select("doc_id", "text", "lang")
    model, cuts = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic", labelled.remainder("doc_id", 5) != 0)
    out = score(docs, model, cuts)
    return out.select(
        "doc_id", (labelled.remainder("doc_id", 5) == 0).alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"), F.col("toxic_threshold").alias("threshold"), F.col("toxic_flagged").alias("flagged"))
