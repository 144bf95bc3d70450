"""Personal data and secrets against plain regular expressions."""

import hashlib
import random
import re

from cohortlake.llm import pii, secrets
from cohortlake.llm.common import Scratch

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_pii(text):
    text, out = text or "", []
    for rank, (kind, pattern) in enumerate([("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)]):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}
            if (all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else ok[kind]):
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def either_case(word):
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = "(" + "|".join([*map(either_case, ["password", "passwd", "secret", "token"]), either_case("api") + "_?" + either_case("key")]) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute_secrets(text):
    text, out = text or "", []
    out += [(m.start(), 0, "assign", m.end()) for m in re.finditer(ASSIGN, text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


PII_PARTS = ["1", "2", "4", "0", "-", " ", ".", "@", "a", "Z", "+", "(", ")", "%", "_", "é", "😀", "255", "4111111111111111",
             "a@b.co", "1.2.3.4", "+1 (017) 555-7713", "\n"]
SECRET_PARTS = ["token", "api_key", "PASSWORD", "ſecret", "secret", ":", "=", " ", '"', "'", "abc123", "x", "AKIA", "ABCDEFGHIJKLMNOP",
                "deadbeef", "0123456789abcdef", "ghp_" + "a1" * 18, "é", "😀", "."]


def texts(parts, seed, extra):
    rng = random.Random(seed)
    return ["".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(600)] + [None, "", " ", *extra]


def test_personal_data_base_spans_are_the_plain_matches(spark):
    given = texts(PII_PARTS, 5, ["1 " * 20000, "a" * 50000, "9" * 50000, "1." * 20000, "a@b.c " * 500])
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.rank, s.kind, s.end) for s in r.pii_spans if s.rank < 4] for r in pii.find(df).collect()}
    assert all(got[i] == brute_pii(t) for i, t in enumerate(given))
    assert sum(map(len, got.values())) > 1000


def test_personal_data_digest(spark, tmp_path):
    spark.createDataFrame([(1, "card 4111 1111 1111 1111, mail x@y.org"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    a, b = sorted(pii.op3_pii(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id)
    assert (a.n_email, a.n_ip, a.n_card, a.n_phone, a.spans) == (1, 0, 1, 0, "card:5:24,email:31:38")
    assert a.base_sha256 == hashlib.sha256(a.spans.encode()).hexdigest()
    assert (b.n_card, b.spans, b.base_sha256) == (0, "", hashlib.sha256(b"").hexdigest())


def test_checksums_and_context_decide_on_added_spans(spark):
    given = ["iban GB82 WEST 1234 5698 7654 32 ok", "GB82WEST12345698765432", "GB82WEST12345698765433", "number 123-45-6789", "my ssn is 123-45-6789"]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.score) for s in r.pii_spans] for r in pii.find(df).collect()}
    assert got == {0: [("iban", 95)], 1: [("iban", 75)], 2: [], 3: [], 4: [("id", 70)]}


def test_masks_cover_overlapping_spans_and_keep_the_rest(spark):
    given = ["é😀 x@y.org, call +1 (017) 555-7713!", "no data", None, "1.2.3.4@mail.org"]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.mask(pii.find(df)).collect()}
    assert got == {0: "é😀 [EMAIL], call [PHONE]!", 1: "no data", 2: None, 3: "[EMAIL]"}


def test_secret_base_spans_are_the_plain_matches(spark):
    given = texts(SECRET_PARTS, 3, ["token = abcdefgh " * 500, "token" + " " * 50000, "=" * 50000, "a" * 50000])
    df = spark.createDataFrame([(i, t, f"s{i % 5}") for i, t in enumerate(given)], "doc_id long, text string, source string")
    found = secrets.scan(df, Scratch(spark, "test")).collect()
    got = {r.repository: [(s.start, s.rank, s.kind, s.end) for s in (r.spans or []) if s.rank < 3] for r in found}
    assert all(got[i] == brute_secrets(t) for i, t in enumerate(given))


def test_ownership_over_the_corpus_separates_examples_from_live_secrets(spark):
    key = "ghp_" + "A1b2" * 9
    rows = [(i, f"use {key} here", f"s{i}") for i in range(4)] + [(9, "password=hunter2hunter", "s1"), (10, "ghp_" + "Z" * 36, None), (11, "ghp_" + "Z" * 36, None)]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string"), Scratch(spark, "test")).collect()
    got = {r.repository: [(s.kind, s["class"], s.n_owners, s.n_repositories) for s in (r.spans or [])] for r in found}
    assert got[0] == [] and got[9] == [("assign", "live", 1, 1)]
    assert got[10] == got[11] == [("code_host", "live", 1, 2)]


def pem(body, end=True, kind="RSA ", line="\n"):
    return f"-----BEGIN {kind}PRIVATE KEY-----{line}{body}" + (f"{line}-----END {kind}PRIVATE KEY-----" if end else "")


def test_private_keys_are_told_apart_by_their_bodies(spark):
    lines = [["".join(random.Random(k).choices("ABCDwxyz0189+/", k=64)) for _ in range(3)] + [f"tail{k}=="] for k in range(9)]
    keys = ["\n".join(x) for x in lines]
    rows = [(k, f"a {pem(keys[k])} b", f"s{k}") for k in range(3)]  # three owners, three keys
    rows += [(10 + k, f"{pem(keys[3], kind='')} b", f"s{k}") for k in range(2)]  # one key of three owners, laid out in three ways
    rows += [(12, "x = '" + pem(keys[3].replace("\n", "\\n"), line="\\n") + "'", "s2")]
    rows += [(20 + k, f"{pem(keys[4 + k], end=False)}\nno key any more", f"s{k}") for k in range(3)]  # three keys without an END line
    rows += [(30, pem(keys[7]) + pem(keys[8], end=False) + "\n" + pem(keys[7]), "s0"), (40, pem(keys[7].replace("\n", " "), end=False, line=" "), "s4")]
    rows += [(50, pem("Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0F\n\n" + keys[8][:64], end=False) + "\n-- ", "s5")]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string"), Scratch(spark, "test")).collect()
    got = {r.repository: [(s.start, s.end, s["class"]) for s in (r.spans or []) if s.kind == "pem"] for r in found}
    assert all(got[k] == [(2, 2 + len(pem(keys[k])), "live")] for k in range(3))
    assert got[10] == got[11] == got[12] == []
    assert all(got[20 + k] == [(0, len(pem(keys[4 + k], end=False)), "live")] for k in range(3))
    one, other = len(pem(keys[7])), len(pem(keys[8], end=False))
    assert got[30] == [(0, one, "live"), (one, one + other, "live"), (one + other + 1, 2 * one + other + 1, "live")]
    assert got[40] == [(0, len("-----BEGIN RSA PRIVATE KEY----- ") + 3 * 65 - 1, "live")]
    assert got[50] == [(0, len(rows[-1][1]) - 4, "live")]


def test_private_key_search_is_linear(spark):
    given = ["-----BEGIN PRIVATE KEY-----" * 2000, "-----BEGIN PRIVATE KEY-----" + "a-" * 400000, "-----BEGIN PRIVATE KEY-----" + "\nabcd" * 100000, ("-----BEGIN PRIVATE KEY-----" + "\nab c" * 9) * 1000]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(given)], "doc_id long, text string, source string")
    got = {r.doc_id: [(s.start, s.end) for s in r.secret_spans if s.kind == "pem"] for r in secrets.candidates(df).collect()}
    assert [len(got[i]) for i in range(4)] == [2000, 1, 1, 1000]
    assert got[1] == [(0, 27)] and got[2] == [(0, len(given[2]))]


def test_lists_of_ids_are_reported_whole(spark):
    ids = [f"{100 + k}-{10 + k % 80}-{1000 + 7 * k}" for k in range(60)]
    given = ["ssn: " + ", ".join(ids), "; ".join(ids) + " (ssn)", "ids 1) " + "\n2) ".join(ids), "Identity numbers " + " | ".join(ids[:20]) + " and " + ids[20],
             f"my ssn is {ids[0]}, while the order with the number\n{ids[1]} is a parcel that has nothing to do with it", f"{ids[0]}, {ids[1]} 😀é", None,
             f"mail a {ids[0]}{' ' * 60}{ids[1]} ssn", f"ssn {ids[0]} 😀 {ids[1]}, é of {ids[2]}"]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    found = pii.find(df).collect()
    got = {r.doc_id: [s.value for s in r.pii_spans if s.kind == "id"] for r in found}
    assert got == {0: ids, 1: ids, 2: [], 3: ids[:21], 4: ids[:1], 5: [], 6: [], 7: ids[1:2], 8: ids[:3]}
    assert all(given[r.doc_id][s.start:s.end] == s.value for r in found for s in r.pii_spans)
    masked = {r.doc_id: r.text for r in pii.mask(pii.find(df)).collect()}
    assert masked[0] == "ssn: " + ", ".join(["[ID]"] * 60)


def test_context_is_cut_from_the_whole_text(spark):
    given = [t for t in texts(["123-45-6789", "987-65-4321", "ssn ", " ", ", ", "é", "word of ", "😀", "x" * 9, "\n"], 8, []) if t]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r.doc_id: {(s.start, s.end) for s in r.pii_spans if s.kind == "id"} for r in pii.find(df).collect()}
    n, near = 0, re.compile(r"(?i)(?<![^\W\d_])(?:" + pii.CONTEXT_WORDS["id"] + r")(?![^\W\d_])")
    for i, t in enumerate(given):
        beside = {m.span() for m in re.finditer(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", t) if near.search(t[max(0, m.start() - 48) : m.start()] + " " + t[m.end() : m.end() + 48])}
        assert beside <= got[i], t
        n += len(beside)
    assert n > 300


def test_a_hundred_thousand_matches_in_one_text(spark, tmp_path):
    """Positions, context and masks of a long page in time that grows with its matches."""
    import time

    text = " ".join(f"user{i}@example.com" if i % 3 else "ssn 123-45-6789," for i in range(100_000))
    spark.createDataFrame([(1, text), (2, "ann@b.co")], "doc_id long, text string").write.parquet(f"{tmp_path}/t")
    began = time.time()
    out = {r.doc_id: r for r in pii.mask(pii.find(spark.read.parquet(f"{tmp_path}/t"))).collect()}
    assert time.time() - began < 90  # quadratic steps would take hours
    found = out[1].pii_spans
    assert len(found) == 100_000 and all(text[s.start : s.end] == s.value for s in found[::997])
    assert out[1].text == " ".join("[EMAIL]" if i % 3 else "ssn [ID]," for i in range(100_000)) and out[2].text == "[EMAIL]"


def test_personal_data_needs_no_python(spark):
    plan = pii.mask(pii.find(spark.createDataFrame([(1, "x")], "doc_id long, text string")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_overlapping_spans_make_one_mask(spark):
    from pyspark.sql import functions as F

    from cohortlake.llm import spans

    rows = [(0, 0, "a", 3, 1, "x"), (1, 1, "b", 2, 1, "x"), (2, 1, "b", 6, 1, "x"), (6, 0, "c", 8, 1, "x"), (9, 0, "d", 12, 1, "x"), (10, 2, "e", 11, 1, "x")]
    df = spark.createDataFrame([("0123456789é1Z", rows)], f"text string, spans array<{spans.SPAN}>")
    assert df.select(spans.masked(F.col("text"), F.col("spans")).alias("t")).first().t == "[A][C]8[D]Z"
