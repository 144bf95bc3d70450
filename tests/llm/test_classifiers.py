"""Held-out accuracy of the two classifiers, and what they do without labels."""

from zlib import crc32

import numpy as np

from cohortlake.llm import quality_classifier, toxicity

SF = "/root/testdata/sf0.1"


def area(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def held_out(spark, query, label):
    out = query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    return out, out[label].to_numpy()


def test_quality_on_held_out_documents(spark):
    out, y = held_out(spark, quality_classifier.op5_quality, "quality")
    assert area(out["score"].to_numpy(), y) > 0.995 and (out["predicted"] == y).mean() > 0.98
    assert out["score"].between(0, 1).all()


def test_toxicity_on_held_out_documents(spark):
    """Some labels contradict the texts, so recall cannot be whole; clean documents are left alone."""
    out, y = held_out(spark, toxicity.op7_toxicity, "toxic")
    assert area(out["score"].to_numpy(), y) > 0.93
    assert ((out["predicted"] == 1) & (y == 1)).sum() > 0.75 * y.sum()
    assert ((out["predicted"] == 1) & (y == 0)).sum() <= 0.005 * (y == 0).sum()


def test_without_two_classes_scores_are_the_smoothed_share():
    none = np.empty((0, len(quality_classifier.FEATURES)))
    model = quality_classifier.fit(none, np.empty(0), np.empty(0))
    x = np.array([quality_classifier.measures(t) for t in (None, "", "some words here")])
    assert np.allclose(quality_classifier.scores(model, x), 0.5)
    assert toxicity.fit([], np.empty(0), np.empty(0)) == {"share": 0.5}
    one = toxicity.fit([toxicity.hashed("a b")] * 3, np.ones(3), np.ones(3))
    assert np.allclose(toxicity.scores(one, [toxicity.hashed("x")]), 0.8)


def test_unseen_words_say_nothing_however_long_the_text():
    rng = np.random.default_rng(0)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(400)]
    texts = [" ".join(rng.choice(words, 60)) + (" nastyword awfulword" if i % 4 == 0 else "") for i in range(300)]
    y = np.array([float(i % 4 == 0) for i in range(300)])
    model = toxicity.fit([toxicity.hashed(t) for t in texts], y, np.ones(300))
    long = " ".join("unseen" + chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i // 676 % 26) for i in range(15000))
    p = toxicity.scores(model, [toxicity.hashed(t) for t in (None, long, long + " nastyword awfulword", texts[1])])
    assert p[0] < 0.5 and p[1] < 0.5 and p[2] > 0.5 and p[3] < 0.5


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality_classifier.fit(x[:3000], y[:3000], np.ones(3000))
    assert ((quality_classifier.scores(model, x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9
    assert any({a, b} == {0, 1} for a, b, _ in model["pairs"])


def test_rows_that_share_a_labelled_id_are_reduced_in_spark_and_dealt_in_any_order(spark):
    """A third of the rows bear one labelled id: one row of each labelled id reaches the driver, and models do not depend on how rows are dealt."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    rows = [(i if i % 3 else 0, " ".join(word() for _ in range(rng.randint(3, 40))) + (" HATE" if i % 2 else ""), rng.choice(["en", "fr", None])) for i in range(600)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(0, 600)], "doc_id long, quality int, toxic int")
    ids = labels.select(F.col("doc_id").alias("labelled_id"), F.col("toxic").alias("y"))
    found = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(seed + 2)
        words = toxicity.learned_from(docs, ids)
        assert words.count() == 401 == words.select("doc_id").distinct().count()
        measured = quality_classifier.measured(docs.select("doc_id", "text"))
        assert quality_classifier.learned_from(measured, ids).count() == 401
        model = quality_classifier.train(measured, labels, "quality", F.lit(True))
        cnn, cuts = toxicity.train(docs, labels, "toxic", F.lit(True))
        found.append(([t.tolist() for t in model["tables"]], [p[2].tolist() for p in model["pairs"]], {k: np.asarray(v, object).tobytes() if not isinstance(v, np.ndarray) else v.tobytes() for k, v in cnn.items() if isinstance(v, np.ndarray)}, cuts))
    assert found[0] == found[1]


def test_additive_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, len(quality_classifier.FEATURES)))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    model = quality_classifier.fit(x, y, np.ones(300))
    for row, got in zip(x[:40], quality_classifier.scores(model, x[:40]), strict=True):
        raw = model["base"]
        for f, table in enumerate(model["tables"]):
            raw += table[sum(e <= row[f] for e in model["edges"][f])]
        for a, b, table in model["pairs"]:
            raw += table[sum(e <= row[a] for e in model["coarse"][a]), sum(e <= row[b] for e in model["coarse"][b])]
        assert abs(got - 1 / (1 + np.exp(-raw))) < 1e-9


def test_convolution_and_pooling_by_plain_loops(monkeypatch):
    rng = np.random.default_rng(5)
    odd = {half: np.where(rng.random(toxicity.BUCKETS) < 0.7, rng.normal(size=toxicity.BUCKETS), 0.0) for half in ("low", "high")}
    model = toxicity.new_model(rng, odd) | {"bias": np.array([0.2], np.float32)}
    texts = [toxicity.hashed(t) for t in (None, "", "one", "one two", "the same word the same word again and again", " ".join(f"w{'x' * (i % 7)}{'y' * (i % 5)}" for i in range(40)))]
    nothing = [0.0] * (2 * toxicity.HALF)

    def vector(word):
        low, high = (model[half][int(toxicity.buckets(np.array([word], np.uint32), half)[0])] for half in ("low", "high"))
        return [*low, *high] if low[0] != 0 and high[0] != 0 else nothing

    want = []
    for ids in texts:
        words, raw, place = [vector(w) for w in ids], float(model["bias"][0]), 0
        for width in toxicity.WIDTHS:
            for f in range(toxicity.FILTERS):
                best = 0.0
                for at in range(len(words)):
                    window = [x for k in range(width) for x in (words[at + k] if at + k < len(words) else nothing)]
                    best = max(best, sum(a * float(b) for a, b in zip(window, model[f"filter{width}"][:, f], strict=True)) + float(model[f"shift{width}"][f]))
                raw += best * float(model["dense"][place])
                place += 1
        want.append(1 / (1 + np.exp(-raw)))
    assert np.allclose(toxicity.scores(model, texts), want, atol=1e-5)
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", 3)  # a long text in pieces
    assert np.allclose(toxicity.scores(model, texts), want, atol=1e-5)


def test_toxicity_learns_from_every_labelled_document(spark, monkeypatch):
    """What toxic documents say that are not among the 2000 of their class with the least hashes is learned, in one shard or several, however rows are dealt."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(300)]
    labels = spark.range(4600).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    order = [r["doc_id"] for r in labels.filter("toxic = 1").orderBy(F.xxhash64(F.col("doc_id").cast("string"))).collect()]
    late = set(order[2000:])
    text = lambda i: " ".join(rng.choices(words, k=12)) + (" vilest" if i in late else " hate" if i % 2 else "")
    rows = [(i, text(i), "en") for i in range(4600)]
    asked = spark.createDataFrame([(0, rows[0][1] + " hate", "en"), (1, rows[0][1] + " vilest", "en"), (2, rows[0][1], "en")], "doc_id long, text string, lang string")
    found = []
    for a_shard, seed in ((5000, 1), (700, 1), (700, 2)):
        monkeypatch.setattr(toxicity, "ROWS_A_SHARD", a_shard)
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(seed + 2)
        model, cuts = toxicity.train(docs, labels, "toxic", F.lit(True))
        p = {r["doc_id"]: r["toxic_score"] for r in toxicity.score(asked, model, cuts).collect()}
        assert p[0] > 0.5 and p[1] > 0.5 and p[2] < 0.5, (a_shard, p)
        found.append({k: v.tobytes() for k, v in model.items()})
        if a_shard == 5000:  # one shard is learned from as on the driver
            own = [r for r in sorted(rows) if crc32(b"aside:%d" % r[0]) % 5]
            alone = toxicity.fit([toxicity.hashed(r[1]) for r in own], np.array([r[0] % 2.0 for r in own]), np.ones(len(own)))
            asked_words = [toxicity.hashed(r[1]) for r in rows[:300]]
            assert np.allclose(toxicity.scores(model, asked_words), toxicity.scores(alone, asked_words), atol=1e-4)
    assert found[1] == found[2]


def test_threshold_by_trying_every_cut():
    rng = np.random.default_rng(11)
    bins = np.sort(rng.choice(toxicity.CUTS + 1, 60, replace=False))
    clean, toxic = rng.integers(0, 9, 60), rng.integers(0, 9, 60) * (bins > 3000)

    def f1(cut):
        hit = bins >= cut
        return 2 * 3 * toxic[hit].sum() / max(1e-9, 2 * clean[hit].sum() + 3 * toxic[hit].sum() + 3 * toxic.sum())

    tried = [round(f1(c), 6) for c in range(toxicity.CUTS + 1)]
    got = round(toxicity.threshold(bins, clean, toxic, (2.0, 3.0)) * toxicity.CUTS)
    assert tried[got] == max(tried)
    assert abs(got - 5000) == min(abs(c - 5000) for c, t in enumerate(tried) if t == max(tried))
    assert toxicity.threshold(bins, clean * 0 + 1, toxic * 0) == 0.5


def test_toxicity_deals_shards_as_rows_of_one_document(spark):
    """Shards that share a partition and span many batches are learned from as one by one, in order of the ids; no row holds several documents."""
    rng = np.random.default_rng(2)
    ids = rng.permutation(240).tolist()
    words = {i: rng.integers(0, 1 << 32, rng.integers(0, 9), dtype=np.uint32).tobytes() for i in ids}
    rows = spark.createDataFrame([(i, bytearray(words[i]), i % 2) for i in ids], "doc_id long, words binary, y int").repartition(3)
    y = np.array([i % 2.0 for i in ids])
    odd = {half: toxicity._odd(*toxicity._uses([np.frombuffer(words[i], np.uint32) for i in ids] * 3, np.tile(y, 3), half), 0.5) for half in ("low", "high")}
    used = {half: x != 0 for half, x in odd.items()}
    model = toxicity.new_model(rng, odd)
    draw = lambda number: np.random.default_rng(number)
    dealt = rows.withColumn("shard", toxicity._shard_id(5)).collect()
    shards = [sorted((r["doc_id"], bytes(r["words"]), r["y"]) for r in dealt if r["shard"] == n) for n in range(5)]
    changes, met = {k: np.zeros(v.shape) for k, v in model.items()}, {k: np.zeros(len(v)) for k, v in model.items()}
    for n, own in enumerate(shards):
        mine = {k: v.copy() for k, v in model.items()}
        toxicity._learn(mine, used, [np.frombuffer(w, np.uint32) for _, w, _ in own], np.array([float(c) for *_, c in own]), np.array([3.0 if c else 2.0 for *_, c in own]), draw(n), range(1), 4)
        for k, v in mine.items():
            changes[k] += v.astype(float) - model[k]
            met[k] += (v != model[k]).any(axis=1) if k in ("low", "high") else 1
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        dealt = toxicity.in_shards(rows, 5)
        found = [r.asDict() for r in dealt.collect()]
        got = toxicity.learned_round(dealt.coalesce(1), model, used, (2.0, 3.0), range(1), 4, draw)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((bytes(r["words"]), r["y"]) for r in found) == sorted((words[i], i % 2) for i in ids)
    for n, own in enumerate(shards):
        assert [(bytes(r["words"]), r["y"]) for r in found if r["shard"] == n] == [(w, c) for _, w, c in own]
    for k, v in model.items():
        n = np.maximum(met[k], 1)
        assert np.allclose(got[k], v + changes[k] / (n[:, None] if v.ndim == 2 else n), atol=1e-6), k
        assert k in ("bias",) or (got[k] != v).any(), k
