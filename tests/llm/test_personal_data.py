import hashlib
import re

from pyspark.sql import functions as F

from tickwave.llm import personal_data as P
from tickwave.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else None,
            "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def brute(text):
    out = []
    for rank, (kind, p) in enumerate(PATTERNS.items()):
        out += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(p, text or "") if valid(kind, m.group())]
    out.sort()
    n = [sum(r == k for _, r, _ in out) for k in range(4)]
    return (*n, hashlib.sha256(",".join(t for _, _, t in out).encode()).hexdigest()), [t for _, _, t in out]


def check(docs, got):
    want = sorted(((r.doc_id is None, r.doc_id or 0, brute(r.text)[0]) for r in docs), key=str)
    assert sorted(((r.doc_id is None, r.doc_id or 0, (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)) for r in got), key=str) == want


def test_base_equals_brute_force(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet").collect()
    got = QUERIES["op4_personal_data"](spark, sf01).collect()
    check(docs, got)
    by = {r.doc_id: r.spans.split(",") for r in got}
    assert sum(len(brute(r.text)[1]) for r in docs) > 50
    for r in docs:
        assert set(brute(r.text)[1]) <= set(by[r.doc_id])


TEXTS = [
    "a@b.c_d@e.f x@y", "mail me: joe.doe@mail.example.org, or 1.2.3.4.5.6.7.8 and 256.1.1.1 007.1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "erntou +1 (269) 555-3296 4524132264652876 and onrend", "call +49 30 1234567-8 or +1.2.3", "@" * 2000, "a" * 100_000 + "@", "1 " * 30_000,
    "+" + "1 " * 20_000 + "x", "é" * 50 + " ü@x.de 🙂 a@b.co", "9" * 60_000, "1.1.1.1.", "x+1 (988) 555-2485y", "a@b.c" * 200, "joe (at) example (dot) com",
    "12 34  56 78-90-12-34-56-78", "+1--------------2", "1.2.3.0000255 1.2.3.0256",
]


def test_odd_texts(spark, awkward):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[1]), (5, TEXTS[1]), (None, TEXTS[2]), (0, TEXTS[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(awkward.select("doc_id", "text"))
    got = P.personal_data(docs.withColumn("key", F.lit("clash")).withColumn("kind", F.lit(1)).withColumn("m", F.lit(2))).collect()
    check(docs.collect(), got)
    assert P.personal_data(docs.limit(0)).count() == 0
    assert P.personal_data(docs.filter("doc_id = 16")).collect()[0].spans == ""


def test_reliable_labelers_win():
    """EM lets agreeing labelers overrule a noisy one."""
    patterns = {("card", 1, 1, 0, 1): 900.0, ("card", 1, 1, 0, -1): 60.0, ("card", -1, -1, 0, 1): 500.0, ("card", -1, -1, -1, -1): 300.0}
    post = P.estimate(patterns)
    assert post["card", 1, 1, 0, 1] > 0.95 and post["card", 1, 1, 0, -1] > 0.5 > post["card", -1, -1, 0, 1]


def test_added_spans(spark, sf01):
    """Phones and cards that one greedy base match swallowed come back."""
    docs = spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10_000, "onrend erntou +1 (269) 555-3296 4524132264652876 and onrend of.")], "doc_id long, text string")
    row = P.personal_data(docs.unionByName(extra)).filter("doc_id = 10000").collect()[0]
    assert row.n_card == 0 and "card:32:48" in row.spans and "phone:14:31" in row.spans
