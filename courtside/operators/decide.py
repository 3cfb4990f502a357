"""From probabilities to the prediction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions import text
from courtside.operators.skew import last_row

ODDS_BAND = (1.2, 3.5)
CONFIDENCE = (0.4, 0.6)


def in_odds_band(c: Column, low: float = ODDS_BAND[0], high: float = ODDS_BAND[1]) -> Column:
    return (c > low) & (c < high)


def is_confident(p: Column, low: float = CONFIDENCE[0], high: float = CONFIDENCE[1]) -> Column:
    return (p < low) | (p > high)


def playable(df: DataFrame) -> DataFrame:
    """Rows with both odds inside the band and a probability away from even, all bounds strict."""
    return df.filter(
        in_odds_band(F.col("odd0")) & in_odds_band(F.col("odd1")) & is_confident(F.col("prediction")))


def decide(df: DataFrame) -> DataFrame:
    """Prediction rows: the likelier player wins, player 1 on a tie."""
    p1 = F.col("prediction")
    p0 = F.lit(1.0) - p1
    return df.select(
        F.col("player0").alias("player_0_name"),
        F.col("player1").alias("player_1_name"),
        F.when(p0 > p1, F.col("player0")).otherwise(F.col("player1")).alias("winner_name"),
        p0.alias("probability_score_player_0"),
        p1.alias("probability_score_player_1"),
        F.col("odd0").alias("odd_player_0"),
        F.col("odd1").alias("odd_player_1"),
        F.lit(True).alias("is_visible_to_users"),
        F.col("start").alias("match_date"),
        text.prediction_id(F.col("player0"), F.col("player1"), F.col("start")).alias("complete_id"),
    )


def upsert(existing: DataFrame, new: DataFrame, key: str, order: Column | None = None) -> DataFrame:
    """Rows of ``new`` replace rows of ``existing`` with the same key; ``order`` picks among repeated new keys.

    Every column but the key may change. Applying the same batch twice changes nothing.
    """
    order = F.struct(*[c for c in new.columns if c != key]) if order is None else order
    latest = last_row(new, [key], order, [c for c in new.columns if c != key])
    kept = existing.join(latest.select(key), key, "left_anti")
    return kept.select(*existing.columns).unionByName(latest.select(*existing.columns))
