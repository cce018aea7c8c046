"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Every document of a source is expected ``target / source_size`` times.  The whole part of that ratio is taken for
certain; for the rest the documents are ranked by the odds of a random number over the odds of their inclusion, and taken
in that order until the words that the source still lacks are reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from terraloom.llm.common import WORD, broadcast_if_small, stored
from terraloom.operators.keys import attach_row_ids

WEIGHTS = (3, 1, 2)  # fixed values: the weights of the sources in code point order, repeating
SHARE = 1.5
MOST_COPIES = 2
BINS = 16384  # per source; only the documents of one bin are ever ordered
SMALL = 20_000  # sources up to which the table of sources is broadcast
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(key: Column, seed: str = SEED) -> Column:
    """A reproducible number in (0, 1) from 52 bits of a digest of the key."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def _running(df: DataFrame, order: list, sums: dict[str, str], few: int) -> DataFrame:
    """Add ``place`` from 1 in the given order, and for each name the sum of a column over all rows before.

    Up to ``few`` rows are ordered in one task; more are placed by ranges, and summed in blocks of that many rows and over blocks.
    """
    if df.count() <= few:
        before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.select("*", F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("place"), *[
            F.coalesce(F.sum(c).over(before), F.lit(0)).alias(name) for name, c in sums.items()])
    placed = attach_row_ids(df, order, "place").withColumn("_block", F.floor(F.col("place") / few))
    if not sums:
        return placed.withColumn("place", F.col("place") + 1).drop("_block")
    blocks = placed.groupBy("_block").agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()])
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.select("_block", F.lit(0).alias("_none"), *[F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_{name}") for name in sums])
    within = Window.partitionBy("_block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    found = placed.join(totals, "_block").select("*", *[
        (F.col(f"_{name}") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(name) for name, c in sums.items()])
    return found.withColumn("place", F.col("place") + 1).drop("_block", "_none", *[f"_{name}" for name in sums])


def source_targets(
    sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, few: int = SMALL,
) -> DataFrame:
    """Words wanted of each source, given one row per source with ``source`` and ``source_size``.

    Sources in code point order, null last, get the weights in turn and share ``share`` of all words.  A target stops at
    ``most`` times its source's size; the rest is shared by the others.  With the sources ordered by cap per weight, the level that
    remains when all earlier ones are full rises as long as sources fill up and falls after that, so the highest one holds.
    """
    named = stored(_running(sizes.select("source", "source_size"), [F.col("source").asc_nulls_last()], {}, few), "mix-named")
    turn = ((F.col("place") - 1) % len(weights) + 1).cast("int")
    weighed = named.select(
        "source", "source_size", F.col("place").alias("named"),
        F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), turn).alias("weight"), (F.col("source_size") * most).alias("cap"))
    every, free = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    ordered = stored(_running(weighed, [F.col("cap") / F.col("weight"), F.col("named")], {"full": "cap", "taken": "weight"}, few), "mix-caps")
    wanted = F.lit(float(share)) * F.lit(every).cast("double")
    level = ordered.agg(F.max((wanted - F.col("full").cast("double")) / (F.lit(free) - F.col("taken")).cast("double"))).first()[0]
    return (
        ordered.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight").cast("double") * F.lit(level)))
        .withColumn("each", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
        .withColumn("whole", F.floor("each"))
        .withColumn("lack", F.col("target") - (F.col("whole") * F.col("source_size")).cast("double"))
        .withColumn("chance", F.col("each") - F.col("whole").cast("double"))
        .select("source", "source_size", "target", "whole", "lack", "chance")
    )


def with_draws(docs: DataFrame, key: str) -> DataFrame:
    """Documents with ``_draw``, a number in (0, 1) from their key.

    Where any key repeats, or more than one row has none, a document's number comes from its key, a hash of its whole row and, among equal
    rows, its turn; equal rows are counted before they meet and unfolded again, so they are decided one by one and never gathered.
    """
    keys = docs.groupBy(F.col(key).alias("_key")).count().where("count > 1")
    if keys.isEmpty():
        return docs.withColumn("_draw", uniform(F.col(key)))
    quoted = [F.col(f"`{c}`") for c in docs.columns]
    each = docs.groupBy(*quoted).agg(F.count("*").alias("_n")).withColumn("_turn", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n")))
    name = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.xxhash64(*quoted).cast("string"), F.col("_turn").cast("string"))
    return each.select(*quoted, uniform(name).alias("_draw"))


def by_source(df: DataFrame, sources: DataFrame) -> DataFrame:
    """Attach the row of each source, the null source included."""
    named = sources.withColumnRenamed("source", "_named")
    return df.join(named, df["source"].eqNullSafe(named["_named"])).drop("_named")


def pareto_rank(draw: Column, chance: Column) -> Column:
    """Random odds over inclusion odds; null where nothing more is to be drawn."""
    return F.when(chance > 0, (draw / (F.lit(1.0) - draw)) / (chance / (F.lit(1.0) - chance)))


def _sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    return with_draws(docs, key).select(
        F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.col("_draw").alias("draw"))


def mixture(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES,
) -> tuple[DataFrame, DataFrame]:
    """The sized documents, and per source its target, whole copies and the last rank that is taken once more.

    Both are stored.  A null text has size 0; a null source is a source of its own; rows of one key, or without one, are
    decided one by one; empty documents are ranked but take nothing; no documents give two
    empty tables.  A histogram of ranks over ``BINS`` bins finds the bin where the lacking words are reached, and only its
    documents are ordered, so no source, however large, is sorted in one task.
    """
    sized = stored(_sized(docs, key, text, source), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stored(source_targets(sizes, weights, share, most), "mix-sources")
    few = broadcast_if_small(sources, SMALL)
    ranked = (
        by_source(sized, few).withColumn("rank", pareto_rank(F.col("draw"), F.col("chance"))).where("rank IS NOT NULL")
        .withColumn("bin", F.floor(F.col("rank") / (F.col("rank") + 1.0) * BINS))
        .select("key", "source", "size", "rank", "bin", "lack")
    )
    sums = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.max("lack").alias("lack"))
    running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    passed = sums.withColumn("until", F.sum("words").over(running))
    # The first bin that ends beyond the lacking words; all bins before it are taken whole.
    cuts = passed.where(F.col("until") > F.col("lack")).groupBy("source").agg(
        F.min_by(F.struct("bin", (F.col("until") - F.col("words")).alias("earlier")), "bin").alias("cut"))
    cuts = cuts.select("source", F.col("cut.bin").alias("cut_bin"), F.col("cut.earlier").alias("earlier"))
    cuts = stored(cuts, "mix-cuts")
    order = Window.partitionBy("source").orderBy("rank", F.col("key").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, 0)
    edge = (
        by_source(ranked, broadcast_if_small(cuts, SMALL)).where(F.col("bin") == F.col("cut_bin"))
        .withColumn("until", F.col("earlier") + F.sum("size").over(order))
        # The document that crosses the line is taken if that comes nearer to it.
        .where((2 * F.col("until") - F.col("size")).cast("double") <= 2.0 * F.col("lack"))
        .groupBy("source").agg(F.max(F.struct("rank", "key")).alias("last"))
    )
    ends = (
        by_source(cuts, edge).select("source", "cut_bin", "last")
        .unionByName(cuts.join(edge.withColumnRenamed("source", "_s"), cuts["source"].eqNullSafe(F.col("_s")), "left_anti")
                     .select("source", "cut_bin"), allowMissingColumns=True)
    )
    named = ends.withColumnRenamed("source", "_named")
    limits = sources.join(named, sources["source"].eqNullSafe(named["_named"]), "left").drop("_named")
    return sized, stored(limits, "mix-limits")


def taken_copies(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``copies`` and the columns of its source to rows holding ``key``, ``source`` and ``draw``."""
    at = by_source(rows, broadcast_if_small(limits, SMALL)).withColumn("rank", pareto_rank(F.col("draw"), F.col("chance")))
    bin_ = F.floor(F.col("rank") / (F.col("rank") + 1.0) * BINS)
    at_edge = F.col("last").isNotNull() & (F.struct("rank", "key") <= F.col("last"))
    once_more = F.when(F.col("rank").isNull(), False).when(F.col("cut_bin").isNull() | (bin_ < F.col("cut_bin")), True).when(
        bin_ > F.col("cut_bin"), False).otherwise(at_edge)
    return at.withColumn("copies", F.col("whole") + once_more.cast("bigint"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """One row per document: ``key``, ``size``, ``source_size``, ``target`` of its source and ``taken`` words."""
    sized, limits = mixture(docs, key, text, source, **options)
    return taken_copies(sized, limits).select(
        F.col("key").alias(key), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents themselves, each repeated as often as it is taken; documents without a word are not in the mix."""
    _, limits = mixture(docs, key, text, source, **options)
    whole = with_draws(docs, key).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("key"),
        F.col(source).alias("source"), F.col("_draw").alias("draw"), word_count(F.col(text)).alias("size"))
    return (
        taken_copies(whole, limits).where((F.col("copies") > 0) & (F.col("size") > 0))
        .select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select("row.*")
    )


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 13))::BIGINT::DOUBLE + 0.5) / {2**52}::DOUBLE AS draw
  FROM documents),
placed AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source),
weighed AS (
  SELECT *, [{', '.join(map(str, WEIGHTS))}][((place - 1) % {len(WEIGHTS)} + 1)::INT] AS weight, source_size * {MOST_COPIES} AS cap FROM placed),
levels AS (
  SELECT *, ({SHARE}::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER before, 0)::DOUBLE)
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM weighed WINDOW before AS (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, weight::DOUBLE * max(level) OVER ()) AS target FROM levels),
shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS each FROM targets),
ranked AS (
  SELECT d.doc_id, d.source, d.size, s.source_size, s.target, floor(s.each)::BIGINT AS whole,
    s.target - (floor(s.each) * s.source_size)::DOUBLE AS lack,
    CASE WHEN s.each > floor(s.each)
      THEN (d.draw / (1.0::DOUBLE - d.draw)) / ((s.each - floor(s.each)) / (1.0::DOUBLE - (s.each - floor(s.each)))) END AS rank
  FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id ROWS UNBOUNDED PRECEDING) AS until FROM ranked)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN rank IS NOT NULL AND 2 * until - size <= 2.0 * lack THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed"""
