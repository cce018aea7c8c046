"""Audit of how filters interact: what each removes at each step, in every order in which they can be applied.

The orders of n filters are numbered by Lehmer rank, that is lexicographically.  A document is known by its mask, the set of filters
it fails: step s removes it in all orders that begin with s - 1 filters it passes and one it fails, and orders with a common
beginning are one interval of ranks.  Counts per mask are added at the beginning of each interval and taken off at its end, and one
prefix sum over the ranks gives every order's totals; no document is looked at once per order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import factorial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from terraloom.llm.common import stored
from terraloom.operators.skew import skew_join

FILTERS = "ABCDE"
LEAST_WORDS = 200
SYMBOLS = b"#$%&*|"
HOT_ROWS = 100_000  # rows of one key above which its join with labels is salted
MEASURES = ("n", "good", "toxic")
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)


def removal_intervals(n: int) -> Iterator[tuple[int, int, int, int]]:
    """(mask, step, first rank, end rank) of all orders of ``n`` filters; bit i of a mask stands for failing filter i."""
    def after(mask: int, prefix: tuple[int, ...], first: int):
        width = factorial(n - len(prefix) - 1)
        for place, at in enumerate(i for i in range(n) if i not in prefix):
            start = first + place * width
            if mask >> at & 1:
                yield mask, len(prefix) + 1, start, start + width
            else:
                yield from after(mask, (*prefix, at), start)

    for mask in range(1, 2**n):
        yield from after(mask, (), 0)


def order_of(rank: Column, filters: str) -> Column:
    """The order of a rank: each digit of the Lehmer code takes a letter out of those left."""
    left, order = F.lit(filters), F.lit("")
    for width in (factorial(k) for k in range(len(filters) - 1, -1, -1)):
        place = F.floor(rank / width).cast("int")
        rank = rank % width
        order = F.concat(order, F.substring(left, place + 1, F.lit(1)))
        left = F.concat(F.substring(left, F.lit(1), place), F.substring(left, place + 2, F.lit(len(filters))))
    return order


_MEASURED = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("digest", pa.binary())])


def failures(data: bytes, points: int) -> int:
    """Bits of the first four filters for one text."""
    words = data.split()
    capitals = len(data.translate(None, _NOT_CAPITAL))
    return (
        (len(words) < LEAST_WORDS) | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * capitals > 2 * points) << 2
        | (len(data.translate(None, SYMBOLS)) < len(data)) << 3)


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``doc_id``, ``part``, ``mask`` of the filters that look at one text, and the text's ``digest``."""
    def measure(batches):
        for batch in batches:
            masks, digests = [], []
            for value, points in zip(batch.column("text"), pc.utf8_length(batch.column("text")).to_pylist(), strict=True):
                data = value.as_py().encode()
                masks.append(failures(data, points))
                digests.append(hashlib.sha256(data).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], schema=_MEASURED)

    rows = docs.select(
        F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(measure, "doc_id bigint, part string, mask int, digest binary")


def mask_counts(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``part``, ``mask`` and how many documents have it: ``n``, of them ``good`` and ``toxic`` ones.

    The last bit is set where the same text has a smaller key anywhere.  Rows with one text meet as one row per part and label, with
    their least key and how many have it, so no group of copies is gathered.  Rows without a key are no copies and have none; of several
    labels of a key any good one and any toxic one counts.
    """
    ids = stored(
        measured(docs, key, text, part).groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n")), "audit-rows")
    labelled = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("doc_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
    joined = skew_join(ids, labelled, ["doc_id"], hot_rows=hot_rows)
    zero = F.lit(0)
    copies = joined.groupBy("digest", "part", "mask", F.coalesce("good", zero).alias("good"), F.coalesce("toxic", zero).alias("toxic")).agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("keyless"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    firsts = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = copies.withColumn("least", least).withColumn("originals", F.col("keyless") + firsts).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct("mask", F.col("originals").alias("n")),
            F.struct((F.col("mask").bitwiseOR(16)).alias("mask"), (F.col("n") - F.col("originals")).alias("n")))).alias("at"))
    return split.groupBy("part", F.col("at.mask").alias("mask")).agg(
        F.sum("at.n").alias("n"), F.sum(F.col("at.n") * F.col("good")).alias("good"), F.sum(F.col("at.n") * F.col("toxic")).alias("toxic"))


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of each part's masks.

    Zeros are included; a part whose masks are all 0 keeps everything; no parts give no rows.
    """
    spark, n = counts.sparkSession, len(filters)
    orders = factorial(n)
    bit = [1 << i for i in range(n)]
    # All tables beside the counts are made of the number of filters alone.
    intervals = spark.createDataFrame(list(removal_intervals(n)), "mask int, step int, first int, end int")
    touched = counts.join(F.broadcast(intervals), "mask")
    edges = touched.select("part", "step", F.explode(F.array(
        F.struct(F.col("first").alias("rank"), *[F.col(c) for c in MEASURES]),
        F.struct(F.col("end").alias("rank"), *[(-F.col(c)).alias(c) for c in MEASURES]))).alias("e")).select("part", "step", "e.*")
    has = F.col("mask").bitwiseAND
    parts = counts.groupBy("part").agg(
        F.sum("n").alias("total"), F.array(*[F.sum(F.when(has(b) > 0, F.col("n")).otherwise(0)) for b in bit]).alias("fails"),
        F.array(*[F.sum(F.when(F.col("mask") == b, F.col("n")).otherwise(0)) for b in bit]).alias("only"))
    grid = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")).select(
        "part", "step", F.explode(F.sequence(F.lit(0), F.lit(orders - 1))).alias("rank"), *[F.lit(0).cast("bigint").alias(c) for c in MEASURES])
    differences = edges.where(F.col("rank") < orders).unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in MEASURES])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = differences.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in MEASURES])
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    named = (
        removed.withColumn("gone", F.sum("n").over(so_far)).withColumn("filter_order", order_of(F.col("rank"), filters))
        .withColumn("letter", F.substring(F.col("filter_order"), F.col("step"), F.lit(1)))
        .withColumn("at", F.position(F.col("letter"), F.lit(filters))).join(parts, "part"))
    return named.select(
        "part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), F.col("n").alias("removed"),
        (F.get("fails", F.col("at") - 1) - F.col("n")).alias("redundant"), F.get("only", F.col("at") - 1).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "letter")).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source", **options) -> DataFrame:
    """What five filters remove from each part, in all 120 orders.

    A: under 200 words; B: fewer than half the words distinct; C: more than 2% capitals A-Z; D: any of ``#$%&*|``; E: a text
    that has a smaller key too.  A null text is empty, a null part the empty string; repeated rows count one by one, and rows that
    repeat the least key of their text are no copies of each other; no documents give no rows.
    """
    return audit(mask_counts(docs, labels, key, text, part, **options))


ORACLE = """
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
counted AS (
  SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    min(doc_id) OVER (PARTITION BY t) AS least FROM texts),
labelled AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
  FROM counted LEFT JOIN labelled USING (doc_id)),
masks AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
gone AS (
  SELECT part, filter_order, fails, n, good, toxic,
    list_min(list_transform(string_split(fails, ''), lambda f: instr(filter_order, f))) AS at_step
  FROM masks, orders WHERE fails <> ''),
removals AS (SELECT part, filter_order, at_step, sum(n) AS n, sum(good) AS good, sum(toxic) AS toxic FROM gone GROUP BY ALL),
grid AS (
  SELECT part, filter_order, step::INT AS step, substr(filter_order, step, 1) AS letter
  FROM (SELECT DISTINCT part FROM masks), orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
steps AS (
  SELECT g.*, coalesce(r.n, 0) AS removed, coalesce(r.good, 0) AS good, coalesce(r.toxic, 0) AS toxic
  FROM grid g LEFT JOIN removals r ON g.part = r.part AND g.filter_order = r.filter_order AND g.step = r.at_step),
totals AS (
  SELECT part, letter, sum(CASE WHEN contains(fails, letter) THEN n ELSE 0 END) AS fail, sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS alone,
    sum(n) AS total FROM masks, (SELECT x AS letter FROM letters) GROUP BY ALL)
SELECT part, filter_order, step,
  (total - sum(removed) OVER (PARTITION BY part, filter_order ORDER BY step))::BIGINT AS kept, removed::BIGINT AS removed,
  (fail - removed)::BIGINT AS redundant, alone::BIGINT AS unique_fails, good::BIGINT AS good_lost, toxic::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM steps JOIN totals USING (part, letter)"""
