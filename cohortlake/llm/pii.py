"""Personal data: patterns propose spans, checksums confirm them, and words
nearby adjust their score; a word beside a list of one kind counts for the whole list. Built-in expressions only.

Defined results: a null text counts as empty (no spans); any length is scanned
whole; repeated rows give repeated results; an empty table gives an empty
table; columns beside the text pass through, but columns that start with
``prefix`` are replaced by the operator's own.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import common, spans

#: Kinds in the order of the result; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "iban", "id")
BASE = KINDS[:4]

#: Patterns. Possessive loops and look-behinds start each run of
#: characters once, so that no text takes more than linear time; the matches
#: are the leftmost non-overlapping ones of the plain patterns.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}

#: Words that make a kind likelier when they stand nearby.
CONTEXT_WORDS = {
    "email": "email|e-mail|mail|contact|courriel|correo",
    "ip": "ip|host|server|address|login|adresse",
    "card": "card|visa|mastercard|credit|payment|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|telefon|téléphone|teléfono",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "id": "ssn|social security|national id|identity|id number",
}

#: Score in percent without and with a context word, and the
#: least score at which a kind outside the base is reported.
SCORES = {"email": (70, 90), "ip": (40, 70), "card": (70, 95), "phone": (50, 80), "iban": (75, 95), "id": (30, 70)}
REPORT_FROM = 60


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn check of a string of digits: from the right, every second one doubled."""

    def step(acc: Column, c: Column) -> Column:
        d = c.cast("int") * (acc["odd"] + 1)
        return F.struct((acc["total"] + F.when(d > 9, d - 9).otherwise(d)).alias("total"), (1 - acc["odd"]).alias("odd"))

    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("odd"))
    return F.aggregate(F.split(F.reverse(number), ""), start, step, lambda acc: acc["total"] % 10 == 0)


def mod97(value: Column) -> Column:
    """Account number check: the first four characters last, letters as 10 to 35, remainder 1."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step, lambda acc: acc == 1)


def _small_parts(value: Column) -> Column:
    def fits(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(short) <= 3) & (F.when(F.length(short) <= 3, short.cast("int")).otherwise(256) <= 255)

    return F.forall(F.split(value, r"\."), fits)


def _confirmed(kind: str, p: Column) -> Column:
    value = p["value"]
    if kind == "ip":
        return _small_parts(value)
    if kind == "card":
        return luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True)


def _score(kind: str, p: Column) -> Column:
    alone, beside = SCORES[kind]
    nearby = rf"(?i)(?<![\p{{L}}])(?:{CONTEXT_WORDS[kind]})(?![\p{{L}}])"
    return F.when(F.concat_ws(" ", p["before"], p["after"], p["lead"], p["trail"]).rlike(nearby), F.lit(beside)).otherwise(F.lit(alone))


def _keeps(kind: str):
    def keep(p: Column) -> Column:
        confirmed = _confirmed(kind, p)
        return confirmed if kind in BASE else confirmed & (_score(kind, p) >= REPORT_FROM)

    return keep


def find(df: DataFrame, text: str = "text", prefix: str = "pii_") -> DataFrame:
    """Add ``<prefix>spans``: array of spans sorted by start, then kind.

    Base kinds are reported at any score; the others from ``REPORT_FROM`` on.
    """
    df = df.drop(*[c for c in df.columns if c.startswith(prefix)])
    body = F.coalesce(F.col(text), F.lit(""))
    might = {"email": body.contains("@"), "phone": body.contains("+")}
    number = body.rlike("[0-9]")
    col = lambda step, kind: f"{prefix}{step}_{kind}"
    temporary = []
    out = df.withColumns({col("hit", k): spans.hits(body, PATTERNS[k], might.get(k, number)) for k in KINDS})
    out = out.withColumns({col("piece", k): spans.pieces(body, PATTERNS[k], F.col(col("hit", k))) for k in KINDS})
    out = out.withColumns({col("found", k): spans.proposals(F.col(col("hit", k)), F.col(col("piece", k))) for k in KINDS})
    out = out.withColumns({col("placed", k): spans.placed(F.col(col("found", k)), F.col(col("piece", k))) for k in KINDS})
    parts = []
    for rank, k in enumerate(KINDS):
        temporary += [col(step, k) for step in ("hit", "piece", "found", "placed")]
        parts.append(spans.accepted(F.col(col("placed", k)), _keeps(k), k, rank, partial(_score, k)))
    return out.withColumn(f"{prefix}spans", F.array_sort(F.concat(*parts))).drop(*temporary)


def mask(df: DataFrame, text: str = "text", prefix: str = "pii_") -> DataFrame:
    """Replace every span of ``<prefix>spans`` in the text by ``[KIND]``; texts without spans are kept as they are."""
    return df.withColumn(text, spans.masked(F.col(text), F.col(f"{prefix}spans")))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the spans of every document."""
    found = find(common.documents(spark, sf_dir).select("doc_id", "text"))
    every = F.col("pii_spans")
    base = F.filter(every, lambda s: s["rank"] < len(BASE))
    return found.select(
        "doc_id",
        *[spans.count_kind(every, k).alias(f"n_{k}") for k in KINDS],
        F.sha2(spans.listed(base), 256).alias("base_sha256"),
        spans.listed(every).alias("spans"),
        F.array_join(F.transform(every, lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: personal data is masked in the text; all documents stay."""
    done = mask(find(docs)).drop("pii_spans")
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)
