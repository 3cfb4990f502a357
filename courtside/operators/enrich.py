"""Statistics and tournament lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions import rates
from courtside.operators.skew import last_row, rows_per_key_at_most
from courtside.session import materialize

STATS_KEY = ("player", "year", "surface")


def suffixed(df: DataFrame, suffix: int | str, cols: Sequence[str] | None = None) -> DataFrame:
    """Every column, or ``cols``, with a side suffix; by name, so column order does not matter."""
    return df.select(*[F.col(c).alias(f"{c}{suffix}") for c in (cols or df.columns)])


def latest_stats(stats: DataFrame, cols: Sequence[str], seq: str = "seq") -> DataFrame:
    """One row per player, year and surface: the last one in landing order."""
    return last_row(stats, STATS_KEY, F.col(seq), [c for c in cols if c not in STATS_KEY])


def attach_stats(matches: DataFrame, stats: DataFrame, cols: Sequence[str], seq: str = "seq") -> DataFrame:
    """Left joins the statistics of both players of a match by player, year and normalised surface.

    The dimension is reduced to its last row per key once and used for both sides; a match without statistics keeps
    nulls, and no match is multiplied. Adaptive execution picks broadcast or sort-merge and splits skewed keys.
    """
    cols = [c for c in cols if c not in STATS_KEY]
    return attach_latest(matches, latest_stats(stats, cols, seq), cols)


def written_latest(stats: DataFrame, cols: Sequence[str], seq: str = "seq") -> DataFrame:
    """``latest_stats`` as a written table, for lookups that are made one after another."""
    return materialize(latest_stats(stats, cols, seq), "latest-stats")


def attach_latest(matches: DataFrame, dim: DataFrame, cols: Sequence[str], slots: Sequence[int | str] = (0, 1)) -> DataFrame:
    """``attach_stats`` from the last rows per key; ``slots``: the ends of the columns that name the players."""
    cols = [c for c in cols if c not in STATS_KEY]
    out = matches.withColumn("_surface", rates.stats_surface(F.col("surface")))
    for slot in slots:
        side = dim.select(
            F.col("player").alias(f"player{slot}"), "year", F.col("surface").alias("_surface"),
            *[F.col(c).alias(f"{c}{slot}") for c in cols])
        out = out.join(side, [f"player{slot}", "year", "_surface"], "left")
    sides = [f"{c}{slot}" for slot in slots for c in cols]
    return out.select(*matches.columns, *sides)


def player_states(stats: DataFrame, cols: Sequence[str], seq: str = "seq") -> DataFrame:
    """Per player and surface, from one pass over the statistics: ``previous``, the last but one row as a struct of ``cols`` (NULL
    with fewer than two rows), ``first_missing``, the missing values of the first row, and ``complete``, whether any row has none.

    A row plays up to three parts: one of the two newest, the oldest, a complete one. Each part keeps two rows per player and
    surface in every task before the shuffle, so a player with very many rows costs no more than one with few.
    """
    keys = ["player", "surface"]
    cols = [c for c in cols if c not in keys]
    missing = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    rows = stats.select(*keys, F.col(seq).alias("_seq"), missing.alias("_missing"), F.struct(*cols).alias("_row"))
    none_seq, none_row = (F.lit(None).cast(rows.schema[c].dataType) for c in ("_seq", "_row"))

    def part(name: str, down: Column, up: Column, row: Column) -> Column:
        return F.struct(F.lit(name).alias("_part"), down.alias("_down"), up.alias("_up"), row.alias("_row"))

    parts = F.array(
        part("newest", F.col("_seq"), none_seq, F.col("_row")), part("oldest", none_seq, F.col("_seq"), none_row),
        F.when(F.col("_missing") == 0, part("complete", none_seq, none_seq, none_row)))
    # the third part is NULL for a row with missing values
    dealt = rows.select(*keys, "_missing", F.explode(F.array_compact(parts)).alias("_p")).select(*keys, "_missing", "_p.*")
    ends = rows_per_key_at_most(dealt, [*keys, "_part"], [F.desc("_down"), F.asc("_up")], 2, "_rank")
    first = F.col("_rank") == 1
    return ends.groupBy(*keys).agg(
        F.first(F.when((F.col("_part") == "newest") & ~first, F.col("_row")), ignorenulls=True).alias("previous"),
        F.max(F.when((F.col("_part") == "oldest") & first, F.col("_missing"))).alias("first_missing"),
        (F.count_if(F.col("_part") == "complete") > 0).alias("complete"))


def with_previous_stats(
    upcoming: DataFrame, states: DataFrame, *, player: str = "player", surface: str = "surface", fallback: str = "hard",
    out: str = "previous",
) -> DataFrame:
    """Left joins the last but one statistics row of a player on a surface as the struct ``out``, from written states.

    When the first row of that surface is incomplete the ``fallback`` surface is used. The row is NULL when the player has no
    complete row on the surface or the chosen surface has fewer than two rows.
    """
    own = states.filter("complete").select(
        F.col("player").alias("_own_player"), F.col("surface").alias("_own_surface"), F.col("previous").alias("_own"), "first_missing")
    other = states.filter(F.col("surface") == fallback).select(F.col("player").alias("_other_player"), F.col("previous").alias("_other"))
    joined = (
        upcoming.join(own, (F.col(player) == F.col("_own_player")) & (F.col(surface) == F.col("_own_surface")), "left")
        .join(other, F.col(player) == F.col("_other_player"), "left"))
    # the fallback belongs to players with a complete row on the surface
    chosen = F.when(F.col("first_missing") > 0, F.col("_other")).otherwise(F.col("_own"))
    return joined.select(*[F.col(c) for c in upcoming.columns], chosen.alias(out))


def previous_stats(
    upcoming: DataFrame, stats: DataFrame, cols: Sequence[str], *, player: str = "player",
    fallback: str = "hard", seq: str = "seq",
) -> DataFrame:
    """Inner joins the last but one statistics row of a player on a surface; a match without one is dropped."""
    cols = [c for c in cols if c not in ("player", "surface")]
    # written: it is joined for the surface and for the fallback
    states = materialize(player_states(stats, cols, seq), "player-states")
    found = with_previous_stats(upcoming, states, player=player, fallback=fallback, out="_previous")
    return found.filter(F.col("_previous").isNotNull()).select(*upcoming.columns, *[F.col("_previous")[c].alias(c) for c in cols])


def with_tournament(df: DataFrame, lookup: DataFrame, name: str = "tournement", how: str = "inner") -> DataFrame:
    """Adds surface, inOut and points of the tournament; rows with an unknown tournament are dropped, or kept by a left join."""
    info = lookup.select(F.col("name").alias(name), "surface", "inOut", "points")
    return df.join(info, name, how)


def with_parent(children: DataFrame, parents: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Carries columns of a parent page onto the rows of the pages it links to."""
    return children.join(parents.select(key, *cols), key, "inner")
