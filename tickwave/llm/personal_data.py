"""Personal data by weak supervision (DataFrame functions only).

Base spans come from one pattern and check a kind.  Wider candidates (parts of
a base match that failed its check, written-out addresses) are judged by the
method: regex, gazetteer, context and edge labelers vote on every candidate of
the corpus; expectation-maximisation over the vote patterns estimates how
reliable each labeler is and how likely each pattern is personal data; with
these as soft labels a naive Bayes classifier over span features is trained,
and candidates that it accepts are added.

Scale: texts are read where they lie, in one scan; only matches are shuffled.  The driver
sees vote patterns and feature counts, whose numbers are bounded by the
labelers and features (at most 4 * 3^4 and a few dozen rows).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwave.session import materialize

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns, written so that no text makes them backtrack: a run of
#: one class starts only where it can, and is never given back.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider or narrower candidates of the same kinds.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|@)\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}+(?![0-9.]*[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{14,19}+|[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}\x20?)?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: Accept an added span from this probability on.
ACCEPT = 0.9
ROUNDS = 30
CONTEXT = 40

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_TLD = r"(?i)\.(?:com|org|net|edu|gov|mil|int|info|io|biz|dev|app|eu|uk|de|fr|es|it|nl|be|ch|at|se|no|dk|fi|pl|pt|ru|cn|jp|kr|in|br|mx|ca|au|us)$"
_ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|38|6011|62|64|65)"
_GOOD = {
    "email": r"(?i)mail|contact|write|schreib|courriel|correo|kontakt",
    "ip": r"(?i)\bip\b|host|server|address|adresse|direcci|login",
    "card": r"(?i)card|visa|master|amex|karte|carte|tarjeta|pay",
    "phone": r"(?i)tel|phone|call|fax|mobile|ruf|appel|llam|\+",
}
_BAD = r"(?i)token|password|secret|version|sha|hash|isbn|uuid|key\b"


def luhn(digits: Column) -> Column:
    def add(total, i):
        x = F.substr(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + x - F.when(x > 9, 9).otherwise(0)

    n = F.greatest(F.length(digits), F.lit(1))
    return F.coalesce(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0, F.lit(False))


def _of_kind(by_kind: dict[str, Column]) -> Column:
    out = F.lit(None)
    for k, c in by_kind.items():
        out = F.when(F.col("kind") == k, c).otherwise(out)
    return out


def _matches(kind: str, pattern: str) -> Column:
    """Array of the pattern's matches; null unless the text holds a character
    that every match has."""
    could = F.col("text").rlike("@|\\(at\\)|\\[at\\]") if kind == "email" else F.col("text").rlike("[0-9]")
    return F.when(could, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, key, kind, wide, m, left, right, start, end) of all matches, in
    one scan: a text gives a row for each pattern that it matches, and only
    that pattern takes it apart; left and right are ``CONTEXT`` characters."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    each = [(kind, wide, pattern) for wide, patterns in ((False, BASE), (True, WIDE)) for kind, pattern in patterns.items()]
    found = F.array(*(F.struct(F.lit(n).alias("n"), _matches(kind, pattern).alias("found")) for n, (kind, _, pattern) in enumerate(each)))
    every = d.select("doc_id", "text", F.explode(F.filter(found, lambda x: F.size(x["found"]) > 0)).alias("x")).select("doc_id", "text", "x.*")
    of = lambda values: reduce(lambda c, n: c.when(F.col("n") == n, values[n]), range(1, len(each)), F.when(F.col("n") == 0, values[0]))
    every = every.select("doc_id", F.xxhash64("text").alias("key"), of([F.lit(k) for k, _, _ in each]).alias("kind"), (F.col("n") >= len(BASE)).alias("wide"),
                         "found", of([F.split("text", p, -1) for _, _, p in each]).alias("gaps"))
    every = every.select("doc_id", "key", "kind", "wide", "found", "gaps", F.explode(F.sequence(F.lit(0), F.size("found") - 1)).alias("i"))
    gap = F.get("gaps", F.col("i"))
    every = every.select("doc_id", "key", "kind", "wide", "i", F.get("found", F.col("i")).alias("m"), F.length(gap).alias("gap"),
                         F.right(gap, F.lit(CONTEXT)).alias("left"), F.left(F.get("gaps", F.col("i") + 1), F.lit(CONTEXT)).alias("right"))
    # equal rows give equal matches: one of each is enough
    every = every.dropDuplicates(["doc_id", "key", "kind", "wide", "i"])
    order = Window.partitionBy("doc_id", "key", "kind", "wide").orderBy("i")
    end = F.sum(F.col("gap") + F.length("m")).over(order)
    return every.withColumn("end", end).withColumn("start", F.col("end") - F.length("m")).drop("gap", "i")


def base_valid() -> Column:
    digits = F.regexp_replace("m", "[^0-9]", "")
    n = F.length(digits)
    return _of_kind({
        "email": F.lit(True),
        "ip": F.col("m").rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": n.between(14, 19) & luhn(F.when(n <= 19, digits).otherwise(F.lit("1"))),
        "phone": n.between(10, 15),
    })


def votes() -> dict[str, Column]:
    """Labelers: 1 for personal data, -1 against, 0 abstains."""
    digits = F.regexp_replace("m", "[^0-9]", "")
    n = F.length(digits)
    yes_no = lambda c: F.when(c, 1).otherwise(-1)
    return {
        "form": _of_kind({
            "email": yes_no(F.col("m").rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*(?:@|\x20?[(\[]at[)\]]\x20?).*[A-Za-z]{2,}$")),
            "ip": yes_no(F.col("m").rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$") & ~F.col("m").rlike(r"(?:^|\.)0[0-9]")),
            "card": yes_no(n.between(14, 19) & luhn(F.when(n <= 19, digits).otherwise(F.lit("1")))),
            "phone": yes_no(n.between(10, 15) & F.col("m").rlike(r"[()+]")),
        }),
        "gazetteer": _of_kind({
            "email": F.when(F.col("m").rlike(_TLD), 1).otherwise(0),
            "ip": yes_no(~F.col("m").rlike(r"^(?:0|127|22[4-9]|2[3-5][0-9])\.")),
            "card": yes_no(digits.rlike(_ISSUER)),
            "phone": F.when(F.right(digits, F.lit(10)).rlike(r"^[2-9][0-9]{2}[2-9]"), 1).otherwise(0),
        }),
        "context": F.when(F.col("left").rlike(_BAD), -1).when(_of_kind({k: F.col("left").rlike(v) for k, v in _GOOD.items()}), 1).otherwise(0),
        "edges": yes_no(~F.col("left").rlike(r"[\p{L}\p{N}_]$") & ~F.col("right").rlike(r"^[\p{L}\p{N}_]")),
    }


def features() -> list[Column]:
    """Discrete span features of the final classifier, each with its kind."""
    digits = F.length(F.regexp_replace("m", "[^0-9]", ""))
    values = [F.least(F.length("m"), F.lit(40)).cast("string"), F.least(digits, F.lit(20)).cast("string"),
              F.regexp_replace(F.regexp_replace(F.substring("m", 1, 24), "[0-9]+", "9"), r"[\p{L}]+", "a"),
              F.coalesce(F.regexp_extract("left", r"(.)$", 1), F.lit("")), F.coalesce(F.regexp_extract("right", r"^(.)", 1), F.lit(""))]
    # shapes are hashed to a bounded number of values
    return [F.concat_ws(":", F.lit(str(i)), F.col("kind"), F.pmod(F.xxhash64(v), F.lit(64)).cast("string")) for i, v in enumerate(values)]


def estimate(patterns: dict[tuple, float], rounds: int = ROUNDS) -> dict[tuple, float]:
    """Probability of personal data for each (kind, votes) pattern, by EM.

    Each labeler's votes are independent given the class; their probabilities
    are estimated per kind, with one pseudo-vote each.  Starts from the share
    of votes in favour."""
    post = {p: min(0.99, max(0.01, 0.5 + sum(p[1:]) / (2 * (len(p) - 1)))) for p in patterns}
    for _ in range(rounds):
        for kind in {p[0] for p in patterns}:
            mine = {p: n for p, n in patterns.items() if p[0] == kind}
            total = {c: 1.0 + sum(n * (post[p] if c else 1 - post[p]) for p, n in mine.items()) for c in (0, 1)}
            labelers = len(next(iter(mine))) - 1
            rate = {}
            for j in range(labelers):
                for v in (-1, 0, 1):
                    for c in (0, 1):
                        # pseudo-votes say that a labeler is rather right than wrong
                        prior = 2.0 if (v > 0) == (c == 1) and v else 1.0
                        rate[j, v, c] = (prior + sum(n * (post[p] if c else 1 - post[p]) for p, n in mine.items() if p[1 + j] == v)) / (total[c] + 4.0)
            for p in mine:
                score = [math.log(total[c]) + sum(math.log(rate[j, p[1 + j], c]) for j in range(labelers)) for c in (0, 1)]
                post[p] = 1 / (1 + math.exp(max(-500.0, min(500.0, score[0] - score[1]))))
    return post


def find(docs: DataFrame, accept: float = ACCEPT) -> tuple[DataFrame, DataFrame]:
    """(texts, accepted spans): texts have doc_id and key, spans also kind,
    start, end and base."""
    v = votes()
    found = spans(docs)
    found = found.withColumn("valid", F.when(~F.col("wide"), base_valid()))
    for name, c in v.items():
        found = found.withColumn(name, c)
    found = materialize(found.withColumn("features", F.array(*features())).drop("left", "right"), "spans")
    base = found.filter("not wide and valid")
    # candidates: wide matches away from base spans of their kind
    b = base.select(F.col("doc_id").alias("bd"), F.col("key").alias("bk"), F.col("kind").alias("bkind"), F.col("start").alias("bs"), F.col("end").alias("be"))
    wide = found.filter("wide").join(b, F.col("doc_id").eqNullSafe(F.col("bd")) & (F.col("key") == F.col("bk")) & (F.col("kind") == F.col("bkind"))
                                     & (F.col("start") < F.col("be")) & (F.col("bs") < F.col("end")), "left_anti")
    judged = materialize(base.unionByName(wide), "candidates")
    names = list(v)
    rows = judged.groupBy("kind", *names).count().collect()  # at most 4 * 3^4 patterns
    post = estimate({tuple(r[c] for c in ["kind", *names]): float(r["count"]) for r in rows})
    if not post:
        return _texts(docs), judged.select("doc_id", "key", "kind", "start", "end", F.lit(True).alias("base"))
    pattern = F.concat_ws(",", "kind", *(F.col(n).cast("string") for n in names))
    soft = F.create_map(*(x for p, q in post.items() for x in (F.lit(",".join(map(str, p))), F.lit(q))))
    judged = judged.withColumn("q", soft[pattern])
    # naive Bayes from soft counts; the feature values are bounded by their hashing
    n = judged.select("kind", "q", F.explode("features").alias("f")).groupBy("f").agg(F.sum("q").alias("p"), F.sum(1 - F.col("q")).alias("n")).collect()
    classes = {r["kind"]: (r["p"] + 1, r["n"] + 1) for r in judged.groupBy("kind").agg(F.sum("q").alias("p"), F.sum(1 - F.col("q")).alias("n")).collect()}
    odds = {r["f"]: math.log((r["p"] + 1) / (classes[r["f"].split(":")[1]][0] + 64)) - math.log((r["n"] + 1) / (classes[r["f"].split(":")[1]][1] + 64)) for r in n}
    weight = F.create_map(*(x for f, o in odds.items() for x in (F.lit(f), F.lit(o))))
    prior = F.create_map(*(x for k, (p, m) in classes.items() for x in (F.lit(k), F.lit(math.log(p / m)))))
    z = prior[F.col("kind")] + F.aggregate("features", F.lit(0.0), lambda t, f: t + weight[f])
    # votes and span features are both evidence: the added span must convince either way of looking
    judged = judged.withColumn("p", 1 / (1 + F.exp(-z))).filter(~F.col("wide") | ((F.col("p") >= accept) & (F.col("q") >= accept)))
    return _texts(docs), judged.select("doc_id", "key", "kind", "start", "end", (~F.col("wide")).alias("base"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("key"))


def personal_data(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for each row.

    Counts and digest are of the base spans: leftmost non-overlapping matches
    of a kind that pass its check.  ``spans`` lists base and added spans as
    kind:start:end in code points, by start and then kind.  Added spans are
    matches of ``WIDE`` (an address's name has at most 64 characters there),
    judged by 24 characters of the match and ``CONTEXT`` around it.  A null text is
    empty.  Repeated rows, shared and null doc_ids give a row each.  An empty
    table gives an empty result; other columns are ignored.
    """
    texts, found = find(docs, accept)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    item = F.struct("start", rank.alias("rank"), "end", "base", F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string")).alias("t"))
    per = found.groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(
        F.sort_array(F.collect_list(item)).alias("all"),
        *(F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS))
    out = texts.join(per, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    text = lambda c: F.coalesce(F.array_join(F.transform(c, lambda x: x["t"]), ","), F.lit(""))
    return out.select("doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
                      F.sha2(text(F.filter("all", lambda x: x["base"])).cast("binary"), 256).alias("base_sha256"),
                      text(F.col("all")).alias("spans"))
