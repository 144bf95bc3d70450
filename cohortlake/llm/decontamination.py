"""Benchmark decontamination: containment search of short test items in long
documents, in built-in expressions.

Items are partitioned by size (shingles, in powers of two). If a document
contains at least ``percent`` of an item's m shingles, at most m minus that
many are missing, so it holds at least one of the m - ceil(percent * m) + 1
minwise (least-hashed) shingles of the item: that sketch, as long as the size
partition's largest item needs, finds every candidate. The texts are searched for
sketched shingles only, about a quarter of all, and a document only meets
partitions whose items its length has room for. Candidates are written as distinct
(document, item) pairs. Only the documents among them are read a second time, and the
shingles that each pair shares are counted on the shingles themselves.

A shingle is the text of five lower-cased words with single spaces, so equal
shingles are equal texts. Items and documents of one to four words are one shingle
of the whole sequence, so a short item is found in a document that is just it.

Defined results: null, empty and blank texts hold no shingles and match nothing;
texts are read whole; repeated rows count once; rows that share a doc_id give
the greater containment; a null doc_id or item_id is an id of its own; an empty
table on either side gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlake.llm import common
from cohortlake.llm.common import Scratch

WIDTH = 5
PERCENT = 80
BROADCAST_SHINGLES = 200_000  # sketched item shingles (about 100 bytes each) up to which they are sent to every executor


#: Fixed value: at the start of each word, that word and the four behind it. The
#: look-behind and possessive loops keep it linear in any text.
FIVE = r"(?<![^ ])(?=([^ ]++ [^ ]++ [^ ]++ [^ ]++ [^ ]++))[^ ]++"


def _shingles(df: DataFrame, carried: list[Column], text: str) -> DataFrame:
    """One row per shingle place with the carried columns, the row's digest and the text's length."""
    plain = F.btrim(F.regexp_replace(F.lower(text), common.BREAK_RUN, " "))
    rows = df.select(*carried, F.xxhash64(text).alias("row"), F.length(text).alias("length"), plain.alias("plain"))
    rows = rows.withColumn("five", F.regexp_extract_all("plain", F.lit(FIVE), F.lit(1)))
    found = F.when(F.size("five") > 0, F.col("five")).when(F.col("plain") != "", F.array("plain"))
    return rows.withColumn("shingle", F.explode(found)).drop("plain", "five")


def item_index(items: DataFrame, percent: int, item_id: str, text: str) -> DataFrame:
    """(item_id, item, shingle, m, need, class_need, sketched): the distinct shingles of every item."""
    one = _shingles(items, [F.col(item_id).alias("item_id")], text).select("item_id", F.col("row").alias("item"), "shingle").distinct()
    sizes = one.groupBy("item_id", "item").agg(F.count("*").alias("m"))
    need = F.ceil(F.col("m") * percent / 100).cast("long")
    sizes = sizes.withColumn("need", need).withColumn("size_class", F.floor(F.log2(F.col("m") + 0.5)).cast("int"))
    longest = sizes.groupBy("size_class").agg(F.max(F.col("m") - F.col("need") + 1).alias("sketch"), F.min("need").alias("class_need"))
    sizes = sizes.join(longest, "size_class").withColumnsRenamed({"item_id": "own_id", "item": "own"})
    place = F.row_number().over(Window.partitionBy("item_id", "item").orderBy(F.xxhash64("shingle"), "shingle"))
    full = one.join(sizes, F.col("item_id").eqNullSafe(F.col("own_id")) & (F.col("item") == F.col("own")))
    return full.select("item_id", "item", "shingle", "m", "need", "class_need", (place <= F.col("sketch")).alias("sketched"))


def matches(docs: DataFrame, items: DataFrame, scratch: Scratch, percent: int = PERCENT, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, row, item_id, m, n_shared) of every document text and item text with
    100 * shared >= percent * item shingles; ``row`` is the digest of the document's text."""
    index = scratch.table(item_index(items, percent, item_id, text), "index")
    sketches = scratch.table(index.filter("sketched").select("shingle", "item_id", "item", "class_need"), "sketches")
    sketches = common.sized(sketches, BROADCAST_SHINGLES)
    probes = _shingles(docs, [F.col(doc_id).alias("doc_id")], text)
    # first reading: documents that hold a sketched shingle of an item their length has room for
    room = (F.col("class_need") == 1) | (F.col("length") >= 2 * (F.col("class_need") + WIDTH - 1) - 1)
    pair = ["doc_id", "row", "item_id", "item"]
    met = probes.join(sketches, "shingle").filter(room).select(*pair).distinct()
    candidates = scratch.table(met, "candidates")
    # second reading, of these documents alone: all shingles of the pairs are counted
    named = scratch.table(candidates.select(F.col("doc_id").alias("own_id"), F.col("row").alias("own")).distinct(), "named")
    on = F.col(doc_id).eqNullSafe(F.col("own_id")) & (F.xxhash64(text) == F.col("own"))
    again = docs.select(doc_id, text).join(common.sized(named), on, "left_semi")
    held = _shingles(again, [F.col(doc_id).alias("doc_id")], text).select("doc_id", "row", "shingle")
    if index.count() <= BROADCAST_SHINGLES:  # shingles that no item has need not be shuffled
        held = held.join(F.broadcast(index.select("shingle")), "shingle", "left_semi")
    held = held.distinct().withColumnsRenamed({"doc_id": "own_id", "row": "own"})
    full = index.select(F.col("item_id").alias("full_id"), F.col("item").alias("full"), "shingle", "m", "need")
    asked = candidates.join(full, F.col("item_id").eqNullSafe(F.col("full_id")) & (F.col("item") == F.col("full")))
    both = asked.join(held, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("row") == F.col("own")) & (asked["shingle"] == held["shingle"]))
    counted = both.groupBy(*pair).agg(F.count("*").alias("n_shared"), F.first("m").alias("m"), F.first("need").alias("need"))
    return counted.filter("n_shared >= need").select("doc_id", "row", "item_id", "m", "n_shared")


def contained(docs: DataFrame, items: DataFrame, scratch: Scratch, percent: int = PERCENT, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment) of every document and item
    with 100 * shared >= percent * item shingles."""
    found = matches(docs, items, scratch, percent, doc_id, item_id, text)
    best = F.max(F.struct((F.col("n_shared") / F.col("m")).alias("containment"), "m", "n_shared")).alias("best")
    found = found.groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", F.col("best.m").alias("n_item_shingles"), F.col("best.n_shared").alias("n_shared"), F.col("best.containment").alias("containment"))


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it contains."""
    return contained(common.documents(spark, sf_dir), _benchmark(spark, sf_dir), Scratch(spark, "leaks"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that contain a benchmark item go; others that share their id stay."""
    scratch = Scratch(spark, "stage-leaks")
    found = matches(docs, _benchmark(spark, sf_dir), scratch)
    leaked = common.sized(scratch.table(found.select(F.col("doc_id").alias("__leaked"), F.col("row").alias("__row")).distinct(), "leaked"))
    on = docs["doc_id"].eqNullSafe(leaked["__leaked"]) & F.xxhash64(docs["text"]).eqNullSafe(leaked["__row"])
    return docs.join(leaked, on, "left_anti")


OP8_SQL = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
t AS (SELECT kind, id, md5(text) AS row, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS words FROM w),
p AS (SELECT kind, id, row, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS nth FROM t WHERE len(words) > 0),
g AS (SELECT DISTINCT kind, id, row, array_to_string(words[nth:nth + 4], ' ') AS shingle FROM p),
m AS (SELECT id, row, count(*) AS m FROM g WHERE kind = 'i' GROUP BY ALL),
c AS (SELECT d.id AS doc_id, i.id AS item_id, m.m, count(*) AS shared
      FROM g d JOIN g i ON d.shingle = i.shingle AND d.kind = 'd' AND i.kind = 'i'
      JOIN m ON m.id IS NOT DISTINCT FROM i.id AND m.row = i.row
      GROUP BY d.id, d.row, i.id, i.row, m.m HAVING 100 * count(*) >= 80 * m.m),
b AS (SELECT doc_id, item_id, max({'c': shared::DOUBLE / m, 'm': m, 's': shared}) AS best FROM c GROUP BY ALL)
SELECT doc_id, item_id, best.m::BIGINT AS n_item_shingles, best.s::BIGINT AS n_shared, best.c::DOUBLE AS containment FROM b
"""
