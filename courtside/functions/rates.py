"""Rate, odds and encoding expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtside.schemas import (
    DEFAULT_TOURNAMENT_POINTS, HANDS, IN_OUT, PHASE_ORDINAL, RANKING_DEFAULT, SURFACES, TOURNAMENT_POINTS,
)

SUM_TOLERANCE = 1e-9


def is_first(winner: Column, looser: Column) -> Column:
    return winner == F.least(winner, looser)


def label(winner: Column, looser: Column) -> Column:
    """0 when the winner is the lexically first player, else 1."""
    return F.when(is_first(winner, looser), F.lit(0)).otherwise(F.lit(1))


def label_code(name: Column) -> Column:
    """``joueur0`` / ``joueur1`` as 0 / 1."""
    return F.when(name == "joueur0", F.lit(0)).when(name == "joueur1", F.lit(1))


def stats_surface(surface: Column) -> Column:
    """Surface under which player statistics are kept; carpet counts as grass."""
    return (
        F.when(surface.contains("Hard"), F.lit("hard"))
        .when(surface.contains("Clay"), F.lit("clay"))
        .when(surface.contains("Grass") | surface.contains("Carpet"), F.lit("grass"))
        .otherwise(surface)
    )


def lookup(c: Column, mapping: dict) -> Column:
    """Value of a small constant mapping, NULL for an unknown key."""
    return F.create_map(*[F.lit(x) for x in chain(*mapping.items())])[c]


def phase_ordinal(phase: Column) -> Column:
    """Round label as 1..8; a label that already is a number is kept, anything else is NULL."""
    return F.coalesce(lookup(phase, PHASE_ORDINAL), phase.try_cast("int"))


def tournament_points(badge: Column) -> Column:
    named = F.coalesce(lookup(badge, TOURNAMENT_POINTS), badge, F.lit(DEFAULT_TOURNAMENT_POINTS))
    return named.try_cast("double")


def mental(faced: Column, converted: Column, return_won: Column, service_won: Column) -> Column:
    return faced + converted + return_won + service_won


def rank_gap(rank0: Column, rank1: Column) -> Column:
    """Expected rates from a ranking gap as ``struct(rate0, rate1)``; the better (smaller) rank gets the larger one."""
    r0, r1 = (F.coalesce(r.cast("double"), F.lit(RANKING_DEFAULT)) for r in (rank0, rank1))
    gap = F.abs(r0 - r1) / F.lit(300.0)
    low, high = (F.lit(1.0) - gap) / 2, (F.lit(1.0) + gap) / 2
    large, small = F.greatest(low, high), F.least(low, high)
    second_better = r1 < r0
    return F.struct(
        F.when(second_better, small).otherwise(large).alias("rate0"),
        F.when(second_better, large).otherwise(small).alias("rate1"),
    )


def impute_rates(rate0: Column, rate1: Column, rank0: Column, rank1: Column) -> Column:
    """The pair of rates, or the ranking gap when either one is missing."""
    gap = rank_gap(rank0, rank1)
    missing = rate0.isNull() | rate1.isNull()
    return F.struct(
        F.when(missing, gap["rate0"]).otherwise(rate0).alias("rate0"),
        F.when(missing, gap["rate1"]).otherwise(rate1).alias("rate1"),
    )


def normalise_pair(rate0: Column, rate1: Column) -> Column:
    """Rates that sum to 1 are kept, those that sum to 100 become fractions, any other pair is even."""
    total = rate0 + rate1
    unit = F.abs(total - 1) <= SUM_TOLERANCE
    hundred = F.abs(total - 100) <= SUM_TOLERANCE

    def side(rate: Column) -> Column:
        return F.when(unit, rate).when(hundred, rate / 100).otherwise(F.lit(0.5))

    return F.struct(side(rate0).alias("rate0"), side(rate1).alias("rate1"))


def serve_rate(count: Column, service_games: Column, per_game: float) -> Column:
    return F.try_divide(count.cast("double"), service_games * F.lit(per_game))


def decimal_odds(fraction: Column) -> Column:
    """``5/4`` as 2.25 and ``2`` as 3.0; NULL when the text is no fraction or the divisor is zero."""
    pieces = F.split(fraction, "/")
    over = F.get(pieces, F.lit(0)).try_cast("double")
    under = F.when(F.size(pieces) == 1, F.lit(1.0)).when(
        F.size(pieces) == 2, F.get(pieces, F.lit(1)).try_cast("double"))
    return F.lit(1.0) + F.try_divide(over, under)


def in_out_flags(value: Column) -> list[Column]:
    """Indoor / Outdoor flags, anything that is not indoor counts as outdoor."""
    indoor = value.contains(IN_OUT[0])
    return [indoor.cast("double").alias(IN_OUT[0]), (~indoor).cast("double").alias(IN_OUT[1])]


def surface_flags(value: Column) -> list[Column]:
    """One flag per surface, an unknown one counts as hard."""
    lowered = F.lower(value)
    known = [s for s in SURFACES if s != "Hard"]
    flags = [(lowered == s.lower()).cast("double").alias(s) for s in known]
    hard = (~lowered.isin(*[s.lower() for s in known])).cast("double").alias("Hard")
    return flags + [hard]


def hand_flags(plays: Column, suffix: str = "") -> list[Column]:
    """Left / right flags, anything that is not left counts as right."""
    left = F.lower(plays).contains("left")
    return [left.cast("double").alias(HANDS[0] + suffix), (~left).cast("double").alias(HANDS[1] + suffix)]


def one_hot(value: Column, vocabulary: list[str], suffix: str = "") -> list[Column]:
    """One flag per vocabulary entry; a value outside it has no flag set."""
    return [
        F.when(value == v, F.lit(1.0)).otherwise(F.lit(0.0)).alias(v + suffix) for v in vocabulary
    ]
