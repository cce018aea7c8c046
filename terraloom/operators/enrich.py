"""Resumable lookup enrichment: pending rows, first match, upserts, checkpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from terraloom.functions import text
from terraloom.operators.columns import quoted
from terraloom.operators.keys import reindex_left
from terraloom.operators.skew import SALTS, skew_join

# Outcome codes of one lookup.
OK, NO_RESULT, RATE_LIMITED = 200, 204, 429


def skip_completed(todo: DataFrame, completed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the completed ones; repeated completions fold before the shuffle."""
    return todo.join(completed.select(*keys).distinct(), list(keys), "left_anti")


def lacking(df: DataFrame, result: str = "lat") -> DataFrame:
    return df.where(quoted(result).isNull())


def retry_rows(df: DataFrame, status: str = "status", result: str = "lat") -> DataFrame:
    """Rows worth another try: no result by status if there is one, else no value yet."""
    return df.where(F.col(status) == NO_RESULT) if status in df.columns else lacking(df, result)


def response_status(http: Column, results: Column) -> Column:
    """Outcome code of a response: 429, another HTTP error, 204 for no hits, or 200."""
    return (
        F.when(http != OK, http)
        .when(F.coalesce(F.size(results), F.lit(0)) <= 0, F.lit(NO_RESULT))
        .otherwise(F.lit(OK))
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """First ``n`` rows per key; each task already keeps only ``n`` before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key, as if every save had overwritten the one before."""
    return first_per_key(df, keys, [F.col(c).desc() for c in order])


def best_hits(gazetteer: DataFrame, rank: str = "rank") -> DataFrame:
    """(_address, _hit) with the best-ranked place of every address."""
    places = gazetteer.select(text.normalise_address(F.col("address")).alias("_address"), rank, "lat", "lon")
    return first_per_key(places, ["_address"], [rank, "lat", "lon"]).select("_address", F.struct("lat", "lon").alias("_hit"))


def lookup_first(
    pending: DataFrame, gazetteer: DataFrame, parts: Sequence[str], rank: str = "rank",
    row_id: str = "row_id", hot_rows: int | None = None,
) -> DataFrame:
    """(row_id, lat, lon, status) of the best gazetteer hit for the composed address.

    An address shared by very many rows is looked up once and spread by salt.
    """
    asked = pending.select(row_id, text.normalise_address(text.compose_address(parts)).alias("_address"))
    hits = best_hits(gazetteer, rank)
    sized = {} if hot_rows is None else {"hot_rows": hot_rows}
    joined = skew_join(asked, hits, ["_address"], "left", spread_by=F.col(row_id), **sized)
    return joined.select(
        row_id, "_hit.lat", "_hit.lon", F.when(F.col("_hit").isNotNull(), OK).otherwise(NO_RESULT).alias("status")
    )


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], wins: str = "new") -> DataFrame:
    """Merge two keyed frames with the same columns.

    ``wins='new'``: a row present in ``new`` replaces the old one, nulls included.
    ``wins='existing'``: a row present in ``old`` is kept.
    ``wins='non_null'``: new values are taken only where they are not null.
    """
    if wins not in ("new", "existing", "non_null"):
        raise ValueError("wins must be 'new', 'existing' or 'non_null'")
    keys = list(keys)
    rest = [c for c in old.columns if c not in keys]
    if set(old.columns) != set(new.columns):
        raise ValueError("both frames must have the same columns")
    a = old.select(*keys, F.struct(*[quoted(c) for c in rest]).alias("_old"))
    b = new.select(*keys, F.struct(*[quoted(c) for c in rest]).alias("_new"))
    both = a.join(b, keys, "full_outer")

    def pick(c: str) -> Column:
        was, now = F.col("_old")[c], F.col("_new")[c]
        if wins == "non_null":
            return F.coalesce(now, was)
        if wins == "new":
            return F.when(F.col("_new").isNotNull(), now).otherwise(was)
        return F.when(F.col("_old").isNotNull(), was).otherwise(now)

    return both.select(*keys, *[pick(c).alias(c) for c in rest])


def completed_keys(*frames: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct union of the keys of several result frames."""
    out = frames[0].select(*keys)
    for frame in frames[1:]:
        out = out.union(frame.select(*keys))
    return out.distinct()


def completion(df: DataFrame, result: str = "lat") -> DataFrame:
    return df.agg(F.count(quoted(result)).alias("filled"), F.count(F.lit(1)).alias("total"))


def checkpoint_summary(checkpoints: DataFrame, keys: Sequence[str], item: str, saved_at: str = "saved_at") -> DataFrame:
    """Completed items and last save per checkpoint.

    Distinct items are found first, on (key, item), so one large checkpoint is
    counted by many tasks.
    """
    items = checkpoints.groupBy(*keys, item).agg(F.max(saved_at).alias(saved_at))
    return items.groupBy(*keys).agg(F.count(item).alias("completed"), F.max(saved_at).alias(saved_at))


def recovery_summary(failed: DataFrame, recovered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many of the failed requests a retry recovered."""
    marked = failed.join(recovered.select(*keys).distinct().withColumn("_ok", F.lit(True)), list(keys), "left")
    return marked.agg(
        F.count_if(F.col("_ok")).alias("recovered"), F.count_if(F.col("_ok").isNull()).alias("still_failed")
    )


def _fill(
    aligned: DataFrame, pending: Column, gazetteer: DataFrame, parts: Sequence[str], names: Sequence[str], row_id: str,
    hot_rows: int | None,
) -> DataFrame:
    """``names`` of every row, with the gazetteer's values put into the pending rows in one join.

    Rows that are not pending ask for nothing; they are spread over the tasks instead of
    meeting under one empty address.
    """
    asked = aligned.select(
        *names, F.when(pending, text.normalise_address(text.compose_address(parts))).alias("_address"), pending.alias("_pending"))
    hits = best_hits(gazetteer)
    if hot_rows is None:
        spread = F.when(F.col("_address").isNull(), F.pmod(F.xxhash64(F.col(row_id)), F.lit(SALTS)).cast("int")).otherwise(0)
        joined = asked.withColumn("_salt", spread).join(hits.withColumn("_salt", F.lit(0)), ["_address", "_salt"], "left")
    else:
        joined = skew_join(asked, hits, ["_address"], "left", spread_by=F.col(row_id), hot_rows=hot_rows)
    new = {
        "lat": F.col("_hit.lat"), "lon": F.col("_hit.lon"),
        "status": F.when(F.col("_pending"), F.when(F.col("_hit").isNotNull(), OK).otherwise(NO_RESULT))}
    return joined.select(*[F.coalesce(new[c], quoted(c)).alias(c) if c in new else quoted(c) for c in names])


def enrich_incremental(
    master: DataFrame, done: DataFrame, gazetteer: DataFrame, parts: Sequence[str], row_id: str = "row_id",
    hot_rows: int | None = None,
) -> DataFrame:
    """One resumable pass: look up the rows that still lack a result and merge them into ``done``."""
    aligned = reindex_left(master, done, row_id)
    return _fill(aligned, F.col("lat").isNull(), gazetteer, parts, done.columns, row_id, hot_rows)


def retry_missing(
    master: DataFrame, done: DataFrame, gazetteer: DataFrame, parts: Sequence[str], row_id: str = "row_id",
    hot_rows: int | None = None,
) -> DataFrame:
    """Look up once more the rows without a result; nothing to retry leaves ``done`` as it is."""
    aligned = reindex_left(master, done, row_id)
    pending = F.coalesce(F.col("status") == NO_RESULT, F.lit(False)) if "status" in done.columns else F.col("lat").isNull()
    return _fill(aligned, pending, gazetteer, parts, done.columns, row_id, hot_rows)
