"""Long season rows to wide feature columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from terraloom.operators.columns import quoted

SEASON_STATS = ("mean", "max", "min", "stdDev", "p90", "slope", "intercept", "auc")


def widen_seasons(
    stats: DataFrame, key: str, season_years: Sequence[tuple[str, int]], values: Sequence[str] = SEASON_STATS
) -> DataFrame:
    """One row per key with columns ``stat_year_season``.

    The season list is given, so the schema is fixed.  A key's seasons are gathered as one map, however many cells the result is
    wide, and laid out in the order of the list.  Two rows for the same key and season are an error.
    """
    name = F.concat(F.col("year").cast("string"), F.lit("_"), F.col("season"))
    wanted = [f"{y}_{s}" for s, y in season_years]
    rows = stats.select(key, name.alias("_at"), F.struct(*[quoted(v).alias(v) for v in values]).alias("_row")).where(F.col("_at").isin(wanted))
    gathered = rows.groupBy(key).agg(F.sort_array(F.collect_list("_at")).alias("_names"), F.collect_list(F.struct("_at", "_row")).alias("_rows"))
    repeated = F.filter("_names", lambda x, i: x == F.get("_names", i - 1))
    twice = F.raise_error(F.concat(F.lit("more than one row per key for "), F.get(repeated, F.lit(0))))
    # Entries hold a map only once they are known to differ, since a map would drop or refuse repeats without naming them.
    entries = F.when(F.size(repeated) > 0, twice.cast(gathered.schema["_rows"].dataType)).otherwise(F.col("_rows"))
    laid_out = gathered.select(key, F.map_from_entries(entries).alias("_map")).select(
        key, F.transform(F.array(*map(F.lit, wanted)), lambda n: F.try_element_at("_map", n)).alias("_cells"))
    return laid_out.select(key, *[
        F.get("_cells", F.lit(i))[v].alias(f"{v}_{n}") for i, n in enumerate(wanted) for v in values])


def join_wide(master: DataFrame, wide: DataFrame, key: str) -> DataFrame:
    """Side-by-side join that keeps the rows only one side has."""
    return master.join(wide, key, "full_outer")
