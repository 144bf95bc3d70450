"""The pipeline against a brute-force version of every stage, and odd inputs through every operator."""

import shutil

import numpy as np

import corpus_pipeline
from cohortlake.llm import common, decontamination, mixing, near_dup, pii, quality_classifier, quality_rules, secrets, toxicity
from cohortlake.llm.queries import QUERIES, SQL
from oracle.compare import compare, duck_connection
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_near_dup import brute as near
from tests.llm.test_spans import brute_pii

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_do_what_their_definitions_say(spark):
    scratch = common.Scratch(spark, "test-pipeline")
    docs = common.documents(spark, SF)
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = kept[name] = scratch.table(stage(spark, docs, SF), name)
    rows = {name: {r.doc_id: r for r in df.collect()} for name, df in kept.items()}
    assert all(df.columns == common.documents(spark, SF).columns for name, df in kept.items() if name != "mixing")
    # quality rules
    judged = {i: quality_rules.measure(r.text, True) for i, r in rows["documents"].items()}
    assert {i: r.text for i, r in rows["quality_rules"].items()} == {i: m[-1] for i, m in judged.items() if m[6]}
    # near duplicates
    texts = [(i, r.text) for i, r in rows["quality_rules"].items()]
    assert set(rows["near_dedup"]) == {i for i, (_, top) in near(texts, 80).items() if i == top}
    # decontamination
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, *_ in leaks([(i, r.text) for i, r in rows["near_dedup"].items()], items)}
    assert leaked and set(rows["decontamination"]) == set(rows["near_dedup"]) - leaked
    # personal data
    assert set(rows["personal_data"]) == set(rows["decontamination"])
    for i, r in rows["decontamination"].items():
        found, after = brute_pii(r.text), rows["personal_data"][i]
        assert (after.text == r.text) == (not found) or "[IBAN]" in after.text or "[ID]" in after.text
        assert not brute_pii(after.text) and after.n_chars == len(after.text)
    # mixing
    copies = {i: 0 for i in rows["personal_data"]}
    for r in kept["mixing"].collect():
        copies[r.doc_id] += 1
    want = {r.doc_id: r.mix_copies for r in mixing.mix(kept["personal_data"], common.Scratch(spark, "again")).collect()}
    assert copies == want


def test_odd_rows_pass_every_operator(spark):
    long = "one two three " * 30000
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, " \n\t", "en", "a", 3), (4, "word", "fr", "", 4), (None, "a text without an id", "en", "a", 5),
            (5, "the same text twice", "en", "a", 5), (5, "the same text twice", "en", "a", 5), (6, long, "en", "b", 9), (None, None, None, None, None)]
    extra = ", ".join(f"{c} string" for c in ("key", "n", "kept", "score", "mix_target", "mix_size", "pii_spans", "quality_text", "toxic_score", "rows", "size", "chunk", "__share"))
    docs = spark.createDataFrame([(*r, *["x"] * 13) for r in rows], f"{COLUMNS}, {extra}")
    empty = docs.limit(0)
    items = spark.createDataFrame([(1, long), (None, None), (2, "word")], "item_id long, text string")
    scratch = lambda: common.Scratch(spark, "odd")
    cnn = toxicity.fit([], np.empty(0), np.empty(0))
    per_row = [
        lambda d: mixing.mix(d, scratch()), lambda d: pii.mask(pii.find(d)), lambda d: secrets.scan(d, scratch()), quality_rules.clean,
        lambda d: near_dup.classes(d, scratch(), 85), lambda d: toxicity.score(d, cnn, {}), quality_classifier.measured,
    ]
    for operator in per_row:
        assert operator(docs).count() == len(rows)
        assert operator(empty).count() == 0
    assert {(r.doc_id, r.item_id) for r in decontamination.contained(docs, items, scratch()).collect()} == {(6, 1), (4, 2)}
    assert decontamination.contained(empty, items, scratch()).count() == 0
    assert decontamination.contained(docs, items.limit(0), scratch()).count() == 0
    sums = {r.doc_id: r.mix_size for r in mixing.mix(docs, scratch()).collect()}
    assert (sums[1], sums[2], sums[3], sums[4], sums[6]) == (0, 0, 0, 1, 90000)


def test_stages_and_queries_take_empty_and_odd_tables(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0)]
    for name, given in (("empty", []), ("odd", rows)):
        base = f"{tmp_path}/{name}"
        spark.createDataFrame(given, COLUMNS).write.parquet(f"{base}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
        spark.createDataFrame([(None, None, None)] * len(given), "page_id long, url string, html string").write.parquet(f"{base}/pages.parquet")
        spark.createDataFrame([(None, None, None, None)] * len(given), "conv_id long, turn long, role string, text string").write.parquet(f"{base}/conversations.parquet")
        spark.createDataFrame([(None, None), (20, None), (20, [None] * 64)][: len(given)], "vec_id long, embedding array<float>").write.parquet(f"{base}/embeddings.parquet")
        # the audit has 600 rows for each of the sources "" and "a"; no vector of this table takes part in a search
        counts = {"op8_decontaminate": 0, "op11_orchard": 0, "op12_filter_audit": 1200 if given else 0, "op13_top_k": 0}
        for query, f in QUERIES.items():
            assert f(spark, base).count() == counts.get(query, len(given)), query
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, common.documents(spark, base), base).count()
        assert corpus_pipeline.run(spark, base).count() == 0
        shutil.rmtree(base)


def test_queries_equal_their_sql(spark):
    con = duck_connection(SF)
    for name, sql in SQL.items():
        result = compare(QUERIES[name](spark, SF), sql, con)
        assert result["ok"], (name, result)
