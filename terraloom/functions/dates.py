"""Season names, season bounds and day arithmetic.

Fixed values: Kharif runs 1 June - 31 October of its year, Rabi runs
1 November of its year - 30 April of the next one; May is in no season.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

KHARIF = "Kharif"
RABI = "Rabi"
SEASONS = (KHARIF, RABI)
SECONDS_PER_DAY = 86_400


def season_name(day: Column) -> Column:
    month = F.month(day)
    return (
        F.when(month.between(6, 10), F.lit(KHARIF))
        .when((month >= 11) | (month <= 4), F.lit(RABI))
    )


def season_year(day: Column) -> Column:
    """Year the season is named after: January-April belong to last year's Rabi."""
    return F.year(day) - (F.month(day) <= 4).cast("int")


def season_start(season: Column, year: Column) -> Column:
    return F.make_date(year, F.when(season == KHARIF, 6).otherwise(11), F.lit(1))


def season_end(season: Column, year: Column) -> Column:
    kharif = season == KHARIF
    return F.make_date(
        F.when(kharif, year).otherwise(year + F.lit(1)),
        F.when(kharif, 10).otherwise(4),
        F.when(kharif, 31).otherwise(30),
    )


def is_last_season_day(day: Column) -> Column:
    month, dom = F.month(day), F.dayofmonth(day)
    return ((month == 10) & (dom == 31)) | ((month == 4) & (dom == 30))


def compact_date(text: Column) -> Column:
    """``2022-06-01`` -> ``20220601``."""
    return F.date_format(F.to_date(text, "yyyy-MM-dd"), "yyyyMMdd")


def parse_compact_date(text: Column) -> Column:
    """``20220601`` -> DATE."""
    return F.to_date(text, "yyyyMMdd")


def epoch_days(df: DataFrame, ts: str) -> Column:
    """Fractional days since 1970-01-01 for a date or timestamp column.

    A TIMESTAMP_NTZ is read as wall-clock time, so the result does not depend
    on the session time zone.
    """
    kind = df.schema[ts].dataType
    col = F.col(ts)
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.hour(col) * 3600 + F.minute(col) * 60 + F.date_part(F.lit("SECOND"), col)
        return F.unix_date(F.to_date(col)).cast("double") + seconds.cast("double") / SECONDS_PER_DAY
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col) / F.lit(SECONDS_PER_DAY * 1e6)
    raise TypeError(f"{ts} is {kind.simpleString()}, expected a date or a timestamp")


def epoch_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970-01-01; a TIMESTAMP_NTZ is read as wall-clock time."""
    col = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        return F.unix_micros(col)
    whole = F.unix_date(F.to_date(col)).cast("bigint") * SECONDS_PER_DAY + F.hour(col) * 3600 + F.minute(col) * 60
    return whole * 1_000_000 + (F.date_part(F.lit("SECOND"), col) * 1_000_000).cast("bigint")


def epoch_millis_to_days(millis: Column) -> Column:
    return millis / F.lit(SECONDS_PER_DAY * 1000.0)
