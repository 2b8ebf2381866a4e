"""Eligibility rules and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.names import normalize_name
from lakeloom.functions.scalar import HIGH_STAKES

# States of a finished match, competitions that are kept, and words that rule one out.
COMPLETED = ["FT", "AET", "PEN"]
ALLOWED_LEAGUES = [1, 4, 5, 6, 7, 9, 10, 21, 22, 29, 30, 31, 32, 33, 34, 35, 36, 37, 536, 806, 808, 858, 913, 960]
EXCLUDED_WORDS = ["women", "woman", "u17", "u18", "u19", "u20", "u21", "u22", "u23", "youth", "olympic", "club", "clubs"]


def completed_only(df: DataFrame, col: str = "status_short", statuses: list[str] = COMPLETED) -> DataFrame:
    return df.where(F.col(col).isin(statuses))


def eligibility(df: DataFrame, id_col: str, name_col: str, country_col: str, status_col: str, allow: list[int] = ALLOWED_LEAGUES, words: list[str] = EXCLUDED_WORDS, require_completed: bool = True, season: tuple[str, int] | None = None) -> DataFrame:
    """``df`` with is_eligible and reject_reason: an excluded word, then a league (and season) not asked for, then an
    unfinished match. ``season`` is (column, year)."""
    label = F.concat_ws(" ", normalize_name(F.col(name_col), "label"), normalize_name(F.col(country_col), "label"))
    excluded = F.lit(False)
    for w in words:
        excluded = excluded | F.contains(label, F.lit(w))
    allowed = F.coalesce(F.col(id_col).isin(allow), F.lit(False))
    if season:
        allowed = allowed & F.coalesce(F.col(season[0]) == season[1], F.lit(False))
    reason = F.when(excluded, "excluded word").when(~allowed, "league not allowed")
    if require_completed:
        reason = reason.when(~F.coalesce(F.col(status_col).isin(COMPLETED), F.lit(False)), "not completed")
    return df.withColumn("reject_reason", reason).withColumn("is_eligible", F.col("reject_reason").isNull())


def keyword_eligibility(name: Column, home_national: Column | None = None, away_national: Column | None = None, kind: Column | None = None) -> Column:
    """Whether a match counts as international: both sides are national, or its competition says so; a competition's
    kind, where known, must be a cup."""
    low = F.lower(F.coalesce(name, F.lit("")))
    said = F.lit(False)
    for w in ["friendly", "friendlies", *HIGH_STAKES]:
        said = said | F.contains(low, F.lit(w))
    if home_national is not None and away_national is not None:
        said = F.coalesce(home_national & away_national, F.lit(False)) | said
    if kind is not None:
        said = said & F.lower(F.coalesce(kind, F.lit(""))).isin("", "cup")
    return said


def split_valid(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows for which the predicate is true, and all others."""
    good = F.coalesce(predicate, F.lit(False))
    return df.where(good), df.where(~good)


def played_only(df: DataFrame, col: str = "games_minutes") -> DataFrame:
    """Rows with a positive whole number of minutes."""
    return df.where(F.col(col).try_cast("int") > 0)


def due_within(df: DataFrame, ts_col: str, now: Column, minutes: float = 60.5) -> DataFrame:
    """Rows whose time is at most so many minutes from ``now`` on, or past; fractions of a second count."""
    return df.where(F.unix_micros(F.col(ts_col).cast("timestamp")) - F.unix_micros(now.cast("timestamp")) <= minutes * 60_000_000)


def on_date(df: DataFrame, ts_col: str, day: Column) -> DataFrame:
    """Rows of one day, given times or ISO texts."""
    kind = dict(df.dtypes)[ts_col]
    date = F.to_date(F.substring(ts_col, 1, 10)) if kind == "string" else F.to_date(ts_col)
    return df.where(date == day)
