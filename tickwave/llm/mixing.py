"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Every document of a source has the same expected number of copies, target over
source size.  The expected copies are summed in prefix order within the
source, one random offset is added, and a document is emitted once for every
integer that its stretch crosses.

Scale: the prefix order of a source is (bucket, size, doc_id).  Buckets are
hash buckets of about ``BUCKET_ROWS`` documents, sized from the measured counts,
so a source with a third of all rows is ranked by many tasks; a running count
over the buckets (one small row each) joins the ranks up.  Within a bucket
documents go by size, which spreads the crossings evenly over sizes and so
keeps the words taken near the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwave.session import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BUCKET_ROWS = 2_000
SEED = 17


def words_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _uniform(text: Column) -> Column:
    """A number in [0, 1) from 48 bits of a digest, the same on any engine."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, docs, source_size, target) from one row a source.

    Sources by code point, null last, take the weights in turn.  They share
    ``share`` of all sizes by weight; a target stops at ``most`` times its
    source's size and the excess is shared again by weight.  The fixed point
    is found directly: sources are capped in the order of size a weight, and
    a source is capped while its cap is below what the rest would give it."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*map(F.lit, weights))
    s = sizes.withColumn("weight", F.get(w, (F.row_number().over(order) - 1) % len(weights)).cast("double"))
    # one row a source: the distinct sources are the only thing ordered here
    by = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = s.withColumn("capped", F.coalesce(F.sum("source_size").over(before), F.lit(0)).cast("double") * float(most))
    s = s.withColumn("free", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("budget", F.sum("source_size").over(everything).cast("double") * float(share))
    s = s.withColumn("level", (F.col("budget") - F.col("capped")) / F.col("free"))
    # the first source that its share does not fill sets the level for the rest
    s = s.withColumn("set", F.when(F.col("level") * F.col("weight") < F.col("source_size") * float(most), F.col("level")))
    s = s.withColumn("at", F.first("set", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return s.select("source", "docs", "source_size", F.when(F.col("at").isNull(), F.col("source_size") * float(most))
                    .otherwise(F.col("at") * F.col("weight")).alias("target"))


def mix_plan(docs: DataFrame, seed: int = SEED, size: Column | None = None) -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target and mix_copies added
    (columns of those names are replaced).  ``size``: a document's size, its
    number of words by default."""
    own = [c for c in docs.columns if c not in ("mix_size", "mix_source_size", "mix_target", "mix_copies")]
    return _planned(docs, seed, size).select(
        *[F.col("row")[c].alias(c) for c in own], F.col("size").alias("mix_size"), F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"), F.col("copies").alias("mix_copies"))


def _planned(docs: DataFrame, seed: int, size: Column | None) -> DataFrame:
    """Each row of ``docs`` as ``row``, with its size, source_size, target and copies."""
    size = words_count("text") if size is None else size
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("string").alias("id"),
                       F.col("source").cast("string").alias("source"), size.alias("size"))
    per = materialize(rows.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size")), "sources")
    plan = targets(per).withColumn("buckets", F.ceil(F.col("docs") / BUCKET_ROWS).cast("long"))
    plan = materialize(plan.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
                       .withColumn("shift", _uniform(F.concat_ws(":", F.coalesce("source", F.lit("")), F.lit(str(seed))))), "targets")
    name = F.struct(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("none"))

    def placed(x: DataFrame) -> DataFrame:
        p = plan.select(name.alias("name"), "source_size", "target", "rate", "shift", "buckets")
        spread = F.floor(_uniform(F.concat_ws(":", F.coalesce("id", F.lit("")), F.col("size").cast("string"), F.lit(str(seed))))
                         * F.col("buckets")).cast("long")
        return x.withColumn("name", name).join(p, "name").withColumn("bucket", spread)

    light = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("source").cast("string").alias("source"),
                        size.alias("size"))
    many = plan.filter("buckets > 1").limit(1).count() > 0
    rows = placed(rows)
    if many:  # running count of documents before each bucket
        before = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        starts = materialize(placed(light).groupBy("name", "bucket").agg(F.count("*").alias("k")).select(
            "name", "bucket", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("start")), "starts")
        rows = rows.join(starts, ["name", "bucket"])
    else:
        rows = rows.withColumn("start", F.lit(0).cast("long"))
    within = Window.partitionBy("name", "bucket").orderBy("size", F.col("id").asc_nulls_last())
    upto = F.col("start") + F.row_number().over(within)
    rows = rows.withColumn("upto", upto)
    crossed = (F.floor(F.col("upto") * F.col("rate") + F.col("shift"))
               - F.floor((F.col("upto") - 1) * F.col("rate") + F.col("shift")))
    return rows.select("row", "size", "source_size", "target", F.least(crossed, F.ceil("rate")).cast("long").alias("copies"))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as it is taken.

    Repeated rows and null doc_ids are rows like any other, a null source is a
    source of its own; a text without words has size 0 and goes by its place in
    its source.  An empty table gives an empty result; columns of any name come
    back as they were."""
    p = _planned(docs, seed, None).filter("copies > 0")
    return p.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def mix_report(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``.

    Size is the number of words ``[^\\x20\\x09-\\x0D]+`` (null text: 0); a null
    source is a source of its own, after all others.  A source of size 0 has
    target 0 and takes nothing.  Repeated rows and null doc_ids are rows like
    any other; equal rows are interchangeable, so the result as a whole is the
    same in every run.  An empty table gives an empty result; other columns
    are ignored.
    """
    # sizes are counted once and stored; no text is shuffled
    d = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", words_count("text").alias("words")), "sizes")
    return mix_plan(d, seed, F.col("words")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, count(*) AS docs, CAST(sum(size) AS BIGINT) AS source_size,
        CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight FROM d GROUP BY source),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
          - CAST(coalesce(sum(source_size) OVER before, 0) AS DOUBLE) * 2.0)
          / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0)) AS level
      FROM s WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a AS (SELECT *, first_value(CASE WHEN level * weight < source_size * 2.0 THEN level END IGNORE NULLS)
        OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lift FROM l),
t AS (SELECT *, CASE WHEN lift IS NULL THEN source_size * 2.0 ELSE lift * weight END AS target,
        CAST('0x' || substr(md5(coalesce(source, '') || ':17'), 1, 12) AS BIGINT) / 281474976710656.0 AS shift,
        CAST(ceil(docs / 2000.0) AS BIGINT) AS buckets FROM a),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.shift,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
        row_number() OVER (PARTITION BY t.source ORDER BY
          floor(CAST('0x' || substr(md5(concat_ws(':', coalesce(CAST(d.doc_id AS VARCHAR), ''), CAST(d.size AS VARCHAR), '17')), 1, 12) AS BIGINT)
            / 281474976710656.0 * t.buckets), d.size, CAST(d.doc_id AS VARCHAR) NULLS LAST) AS i
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
  CAST(least(floor(i * rate + shift) - floor((i - 1) * rate + shift), ceil(rate)) AS BIGINT) * size AS taken
FROM p
"""
