"""Typed tables from raw text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.functions import dates, rates, text
from courtside.schemas import COUNT_COLUMNS, PERCENT_COLUMNS, THOUSANDS_COLUMNS


def null_text(df: DataFrame) -> DataFrame:
    """Null markers of every text column become NULL."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: text.null_tokens(F.col(c)) for c in names})


def require(df: DataFrame, *subset: str) -> DataFrame:
    """Rows without a null, in the given columns or in all."""
    return df.dropna("any", subset=list(subset) or None)


def clean_matches(df: DataFrame, *, digits_only: bool = True) -> DataFrame:
    """Typed match rows: year, days, start and end date, head-to-head rates, in/out, surface, ordinals."""
    rate = text.digits if digits_only else text.percent
    cleaned = {
        **{c: text.null_tokens(F.col(c)) for c in ("winnerName", "looserName")},
        **{c: rate(F.col(c)) for c in ("winnerRate", "looserRate")},
        **{c: text.number(F.col(c)) for c in ("winnerRateSurface", "looserRateSurface")},
        "year": dates.range_year(F.col("date")),
        "duree": dates.range_days(F.col("date")),
        "start_date": dates.range_start(F.col("date")),
        "end_date": dates.range_end(F.col("date")),
        "inOut": text.in_out(F.col("surfaceInout")),
        "surface": text.surface_of(F.col("surfaceInout")),
        "phase": rates.phase_ordinal(F.col("phase")),
        "typeTournament": rates.tournament_points(text.null_tokens(F.col("typeTournament"))),
    }
    return df.withColumns(cleaned)


def with_match_id(df: DataFrame) -> DataFrame:
    """Natural key of a raw match."""
    key = F.concat_ws("|", "url", "date", "phase", "winnerName", "looserName")
    return df.withColumn("match_id", F.sha2(key, 256))


def clean_stats(df: DataFrame, *, percent: str = "fraction", compat: bool = False) -> DataFrame:
    """Typed player statistics. Cleaned once here, on the dimension, instead of once per match side after the join.

    A ``surface`` column, as from the directory level of a lake, is kept; else the surface is read from the url.
    """
    rate = text.percent if percent == "fraction" else text.digits
    cleaned = {
        **{c: text.null_tokens(F.col(c)) for c in ("weight", "startCareer", "age")},
        **{c: rate(F.col(c)) for c in PERCENT_COLUMNS},
        **{c: text.integer(F.col(c)) for c in (*COUNT_COLUMNS, "year", "ranking", "tournCell")},
        **{c: text.thousands(F.col(c), compat) for c in (*THOUSANDS_COLUMNS, "nextBest")},
        "surface": F.col("surface") if "surface" in df.columns else text.url_surface(F.col("url")),
        "height": text.first_number(F.col("height")),
        "plays": text.hand(text.clean_plays(F.col("plays"))),
    }
    return df.withColumns(cleaned)
