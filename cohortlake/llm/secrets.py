"""Secrets: patterns propose candidates, and how many owners a value has over
the whole corpus separates copied examples from live-looking credentials.

A document is a repository and its source the owner. A value that at least
``EXAMPLE_OWNERS`` different owners hold is an example; one that a single owner
holds is live-looking; between the two it is shared. Base kinds are reported
whatever the frequency says; the kinds that the method adds are reported unless
their value is an example.

Defined results: a null text counts as empty; any length is scanned whole;
repeated rows count once for a value's frequency and give repeated results; a
null source or doc_id is an owner or a repository of its own; an empty table
gives an empty table; only the named columns are read, the result has its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import common, spans

#: Kinds in the order of the result; the first three are the base.
KINDS = ("assign", "access", "hex", "pem", "jwt", "code_host")
BASE = KINDS[:3]

#: A private key runs from its header to its END line or, without
#: one, over the base64 lines that follow (line breaks may be escaped). No
#: part runs over the five hyphens of a next header, so the search stays linear.
PEM_HEAD = r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"
PEM_END = r"-----END [A-Z ]{0,24}PRIVATE KEY-----"
NEW_LINE = r"(?:\r\n?+|\n|(?:\\r)?+\\n)"
PEM_FIELDS = rf"(?:(?:{NEW_LINE}[A-Za-z][A-Za-z-]{{0,30}}+:(?:[^\r\n\\-]|-(?!----))*+)++{NEW_LINE})?+"
PEM_LINES = (rf"{PEM_FIELDS}(?:[ \t]++[A-Za-z0-9+/]{{32,}}+={{0,2}}+)*+"
             rf"""(?:{NEW_LINE}[ \t]*+[A-Za-z0-9+/]++={{0,2}}+(?=[ \t]*+(?:{NEW_LINE}|["']|\z))[ \t]*+)*+""")

#: Patterns, written so that failing candidates that cannot be
#: told apart by length later (hex) are not proposed at all.
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?[ ]*[:=][ ]*["']?[A-Za-z0-9+/_.=-]++""",
    "access": r"AKIA[A-Z0-9]++",
    "hex": r"[0-9a-f]{24,}+",
    "pem": rf"{PEM_HEAD}(?:(?:[^-]++|-(?!----))*+{PEM_END}|{PEM_LINES})",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
    "code_host": r"gh[pousr]_[A-Za-z0-9]{36,}+",
}
ASSIGN_HEAD = r"""^(?i:password|passwd|secret|token|api_?key)["']?[ ]*[:=][ ]*["']?"""

EXAMPLE_OWNERS = 3


def _value(kind: str, match: Column) -> Column:
    """What owners are counted by: of a private key the body without line breaks
    and other layout; a header without a body stands for itself."""
    if kind == "pem":
        body = F.regexp_replace(F.regexp_replace(match, rf"^{PEM_HEAD}|{PEM_END}\z", ""), r"\\[nrt]|[^A-Za-z0-9+/=]", "")
        return F.when(body == "", match).otherwise(body)
    return F.regexp_replace(match, ASSIGN_HEAD, "") if kind == "assign" else match


def _keeps(kind: str):
    def keep(p: Column) -> Column:
        if kind == "assign":
            return F.length(_value(kind, p["value"])) >= 6
        if kind == "access":
            return F.length(p["value"]) >= 20
        return F.lit(True)

    return keep


def candidates(df: DataFrame, text: str = "text", prefix: str = "secret_") -> DataFrame:
    """Add ``<prefix>spans``: every candidate's span, sorted by start, then kind."""
    df = df.drop(*[c for c in df.columns if c.startswith(prefix)])
    body = F.coalesce(F.col(text), F.lit(""))
    might = {"access": body.contains("AKIA"), "pem": body.contains("-----BEGIN "), "jwt": body.contains("eyJ"),
             "code_host": body.contains("gh"), "assign": body.rlike("[:=]")}
    col = lambda step, kind: f"{prefix}{step}_{kind}"
    out = df.withColumns({col("hit", k): spans.hits(body, PATTERNS[k], might.get(k, F.lit(True))) for k in KINDS})
    out = out.withColumns({col("piece", k): spans.pieces(body, PATTERNS[k], F.col(col("hit", k))) for k in KINDS})
    out = out.withColumns({col("found", k): spans.proposals(F.col(col("hit", k)), F.col(col("piece", k))) for k in KINDS})
    parts = [spans.accepted(F.col(col("found", k)), _keeps(k), k, rank, lambda p: F.lit(0)) for rank, k in enumerate(KINDS)]
    valued = [F.transform(part, _with_value(k)) for k, part in zip(KINDS, parts, strict=True)]
    temporary = [col(step, k) for step in ("hit", "piece", "found") for k in KINDS]
    return out.withColumn(f"{prefix}spans", F.array_sort(F.concat(*valued))).drop(*temporary)


def _with_value(kind: str):
    return lambda s: s.withField("value", _value(kind, s["value"]))


def ownership(found: DataFrame, repository: str, owner: str, prefix: str = "secret_") -> DataFrame:
    """(value_hash, n_repositories, n_owners) over the whole corpus. Pairs are made
    distinct first, on (value, repository, owner), so a value that many
    documents hold is spread over many tasks and summed from partial counts."""
    held = found.select(
        F.explode(F.array_distinct(F.transform(F.col(f"{prefix}spans"), lambda s: F.sha2(s["value"], 256)))).alias("value_hash"),
        F.col(repository).alias("repository"), F.col(owner).alias("owner"),
    ).distinct()
    repositories = held.groupBy("value_hash", "repository").agg(F.lit(1).alias("x")).groupBy("value_hash").agg(F.count("*").alias("n_repositories"))
    owners = held.groupBy("value_hash", "owner").agg(F.lit(1).alias("x")).groupBy("value_hash").agg(F.count("*").alias("n_owners"))
    return repositories.join(owners, "value_hash")


def scan(df: DataFrame, scratch: common.Scratch, text: str = "text", repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """(repository, owner, spans): per row the reported spans, each with
    ``n_owners``, ``n_repositories`` and its class (live, shared, example).

    The candidates are written to the shared folder once, so that a lost
    executor does not bring the scan of the texts back.
    """
    rows = df.select(F.col(repository).alias("repository"), F.col(owner).alias("owner"), F.col(text).alias("text"))
    found = candidates(rows).select("repository", "owner", "secret_spans")
    found = scratch.table(found.withColumn("row", F.monotonically_increasing_id()), "candidates")
    counted = ownership(found, "repository", "owner")
    several = scratch.table(counted.filter((F.col("n_repositories") > 1) | (F.col("n_owners") > 1)), "several")
    one = found.filter(F.size("secret_spans") > 0).select("row", F.explode("secret_spans").alias("span"))
    one = one.withColumn("value_hash", F.sha2("span.value", 256))
    # only the values that several repositories or owners hold are looked up
    known = common.spread_lookup(one, several, "value_hash", F.col("row"))
    owners = F.coalesce("n_owners", F.lit(1))
    known = known.select(
        "row",
        F.struct(
            "span.start", "span.rank", "span.kind", "span.end", "span.value", owners.alias("n_owners"),
            F.coalesce("n_repositories", F.lit(1)).alias("n_repositories"),
            F.when(owners >= EXAMPLE_OWNERS, "example").when(owners == 1, "live").otherwise("shared").alias("class"),
        ).alias("span"),
    ).filter((F.col("span.rank") < len(BASE)) | (F.col("span.class") != "example"))
    per_row = known.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    return found.select("row", "repository", "owner").join(per_row, "row", "left").drop("row")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the secrets of every document."""
    found = scan(common.documents(spark, sf_dir), common.Scratch(spark, "secrets"))
    every = F.coalesce("spans", F.from_json(F.lit("[]"), found.schema["spans"].dataType))
    base = F.filter(every, lambda s: s["rank"] < len(BASE))
    of_class = lambda name: F.size(F.filter(every, lambda s: s["class"] == name)).cast("long")
    return found.select(
        F.col("repository").alias("doc_id"),
        *[spans.count_kind(every, k).alias(f"n_{k}") for k in KINDS],
        F.sha2(spans.listed(base), 256).alias("base_sha256"),
        spans.listed(every).alias("spans"),
        *[of_class(c).alias(f"n_{c}") for c in ("live", "shared", "example")],
    )
