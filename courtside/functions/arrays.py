"""Expressions over lists taken from a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUALIFYING = "Qualifying"
QUALIFICATION = "Qualification"


def every_second(items: Column) -> Column:
    return F.filter(items, lambda _, i: i % 2 == 0)


def without_first(items: Column) -> Column:
    return F.filter(items, lambda _, i: i > 0)


def without_last(items: Column, n: Column) -> Column:
    return F.slice(items, F.lit(1), F.greatest(F.size(items) - n, F.lit(0)))


def keep_containing(items: Column, word: str) -> Column:
    return F.filter(items, lambda x: x.contains(word))


def count_containing(items: Column, word: str) -> Column:
    return F.size(keep_containing(items, word))


def surface_share(winners: Column, surfaces: Column, surface: Column, player: Column) -> Column:
    """Share of the listed meetings on one surface that a player won; NULL when there was none."""
    on_surface = F.filter(
        F.arrays_zip(winners.alias("winner"), surfaces.alias("surface")), lambda m: m["surface"] == surface)
    won = F.size(F.filter(on_surface, lambda m: m["winner"] == player))
    return F.try_divide(won, F.size(on_surface))


def round_of(rounds: Column, position: Column, compat: bool = False) -> Column:
    """Round label of a match link from its position on a tournament page, final first.

    Each round holds twice as many links as the one before. ``compat`` keeps the historical banding: positions 15 to
    30 repeat the fourth label, positions above 190 have none, and a page without a qualifying header is all
    qualification.
    """
    qualifying = count_containing(rounds, QUALIFYING)
    if compat:
        final_rounds = F.when(qualifying > 0, without_last(rounds, qualifying)).otherwise(F.slice(rounds, 1, 0))
        upper = [0, 2, 6, 14, 30, 62, 126, 190]
        label_at = [0, 1, 2, 3, 3, 4, 5, 6]
        band = F.when(position <= upper[0], F.lit(label_at[0]))
        for bound, label in zip(upper[1:], label_at[1:]):
            band = band.when(position <= bound, F.lit(label))
    else:
        final_rounds = without_last(rounds, qualifying)
        band = F.floor(F.log2(position + F.lit(1.0))).cast("int")
    beyond = position > F.pow(F.lit(2.0), F.size(final_rounds))
    return (
        F.when(beyond, F.lit(QUALIFICATION))
        .when(band.isNotNull(), F.coalesce(F.get(final_rounds, band), F.lit(QUALIFICATION)))
    )
