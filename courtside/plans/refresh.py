"""Raw tables to feature rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside import schemas
from courtside.operators import clean, dataset, enrich, form, h2h, orient
from courtside.operators.skew import HOT_ROWS, hot_keys
from courtside.session import materialize
from courtside.sources import lake, sinks

KEYS = ("match_id", "player0", "player1", "year", "start_date", "phase")
#: what features are made of; nothing else of a match or of statistics is carried through their joins
MATCH_INPUTS = (
    "match_id", "player0", "player1", "year", "start_date", "surface", "inOut", "typeTournament", "label", "winnerRate", "looserRate",
    "winnerRateSurface", "looserRateSurface")
STAT_INPUTS = [*schemas.SIDE_FEATURES, "plays"]
STATS_WANTED = [c for c in schemas.STAT_COLUMNS if c not in ("player", "year", "url")]


def consolidate(spark: SparkSession, lake_path: str, store: str, year: int | None = None) -> None:
    """Lands the one-row files of a year, or of all years, as two tables; other years stay as they are."""
    for name, rows in (
        ("players", lake.read_players(spark, f"{lake_path}/Players", year)),
        ("tournaments", lake.read_tournaments(spark, f"{lake_path}/Tournaments", year)),
    ):
        kept = [c for c in rows.columns if not c.startswith("_")]
        season = rows.select(*kept, F.col("_year").cast("int").alias("season"))
        sinks.write_table(season, f"{store}/{name}", ["season"], keep_other_partitions=True)


def oriented_matches(raw: DataFrame) -> DataFrame:
    """Clean matches with a key and canonical sides."""
    return orient.orient(clean.clean_matches(clean.with_match_id(raw)))


def with_stats(matches: DataFrame, latest: DataFrame, wanted: Sequence[str] = STATS_WANTED) -> DataFrame:
    """Matches with the latest statistics of both sides and ages in the year of the match."""
    return dataset.with_age(enrich.attach_latest(matches, latest, wanted))


def with_beaten(matches: DataFrame, latest: DataFrame) -> DataFrame:
    """Adds rankingBeaten, the ranking of the player who lost: form reads no other one, so one lookup a match is enough."""
    named = matches.withColumn("playerBeaten", F.when(F.col("label") == 0, F.col("player1")).otherwise(F.col("player0")))
    return enrich.attach_latest(named, latest, ["ranking"], ("Beaten",)).drop("playerBeaten")


def with_form(matches: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Adds Forme and WinMean of both sides from each player's three matches before this one, to written matches with
    rankingBeaten.

    Player rows are put back on their match with one aggregation by match, not with a join per side. The plan for players with more
    than ``hot_rows`` rows moves all rows twice more to find theirs, so it is left out when there are none.
    """
    # the ranking of the side that lost; nothing reads that of a winner
    ranked = matches.withColumns({f"ranking{s}": F.when(F.col("label") != s, F.col("rankingBeaten")) for s in (0, 1)})
    rows = form.player_rows(ranked, ("match_id", "start_date"))
    if hot_rows is not None and materialize(hot_keys(rows, ["player"], hot_rows), "crowded").isEmpty():
        hot_rows = None
    formed = form.recent_form(rows, 3, hot_rows=hot_rows)
    sides = formed.groupBy("match_id").agg(*[
        F.max(F.when(F.col("slot") == s, F.col(source))).alias(f"{name}{s}")
        for s in (0, 1) for name, source in (("Forme", "forme"), ("WinMean", "win_mean"))])
    joined = matches.drop("rankingBeaten").join(sides, "match_id", "left")
    return dataset.impute(joined, dataset.FORM_DEFAULTS)


def feature_rows(
    raw: DataFrame, raw_stats: DataFrame, keep: Sequence[str] = KEYS, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Keys and the 72 features of every match.

    Form needs no statistics but the rankings of the beaten, so it is made of matches with these alone. Statistics are attached last
    and the rows are not moved again; each step before is written, and what it has shuffled goes with it.
    """
    oriented = oriented_matches(raw)
    # the digest as bytes takes half the room of its digits in every shuffle
    narrow = oriented.select(*[c for c in oriented.columns if c in {*MATCH_INPUTS, *keep}]).withColumn("match_id", F.unhex("match_id"))
    latest = enrich.written_latest(clean.clean_stats(raw_stats), STAT_INPUTS)
    formed = materialize(with_form(materialize(with_beaten(narrow, latest), "with-beaten"), hot_rows), "with-form")
    matches = with_stats(formed, latest, STAT_INPUTS)
    rated = h2h.normalise_h2h(h2h.impute_h2h(h2h.h2h_rates(matches)))
    return dataset.build_features(rated.withColumn("match_id", F.lower(F.hex("match_id"))), keep)
