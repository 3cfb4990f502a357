"""Canonical two-sided matches and their one-row-per-player form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions import rates


def orient(df: DataFrame, winner: str = "winnerName", looser: str = "looserName") -> DataFrame:
    """Adds player0 < player1 and the label (0 when player0 won). Matches with an unknown player are dropped."""
    known = df.dropna("any", subset=[winner, looser])
    return known.withColumns({
        "player0": F.least(winner, looser),
        "player1": F.greatest(winner, looser),
        "label": rates.label(F.col(winner), F.col(looser)),
    })


def orient_offer(df: DataFrame, compat: bool = False) -> DataFrame:
    """Orders the two sides of an offer by name and moves the odds along; ``compat`` leaves the odds in place."""
    swap = F.col("joueur1") < F.col("joueur0")
    keep_odds = F.lit(False) if compat else swap
    return df.withColumns({
        "player0": F.least("joueur0", "joueur1"),
        "player1": F.greatest("joueur0", "joueur1"),
        "odd0": F.when(keep_odds, F.col("oddJoueur1")).otherwise(F.col("oddJoueur0")),
        "odd1": F.when(keep_odds, F.col("oddJoueur0")).otherwise(F.col("oddJoueur1")),
    })


def to_player_rows(df: DataFrame, keep: Sequence[str], opponent: Sequence[str] = ()) -> DataFrame:
    """Two rows per match, one for each player, with slot, win flag and the opponent's ``opponent`` columns."""

    def side(slot: int) -> object:
        other = 1 - slot
        return F.struct(
            F.col(f"player{slot}").alias("player"),
            F.col(f"player{other}").alias("opponent"),
            F.lit(slot).alias("slot"),
            (F.col("label") == slot).cast("int").alias("win"),
            *[F.col(f"{c}{other}").alias(f"opponent_{c}") for c in opponent],
        )

    return df.select(*keep, F.inline(F.array(side(0), side(1))))


def players(df: DataFrame) -> DataFrame:
    """Distinct players over both slots."""
    return df.select(F.explode(F.array("player0", "player1")).alias("player")).distinct()
