"""Upcoming matches from a landed odds feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions import rates, text
from courtside.operators.skew import last_row
from courtside.schemas import EXCLUDED_TOURNAMENT_WORDS, OFFER_LABEL, TOURNAMENT_GROUPS


def feed_tournaments(groups: DataFrame) -> DataFrame:
    """Singles tournaments of the allowed groups: tournement, groupId. A repeated name keeps its last id."""
    kinds = groups.select(F.posexplode("group.groups").alias("_p0", "kind")).filter(
        F.col("kind.name").isin(*TOURNAMENT_GROUPS))
    listed = kinds.select("_p0", F.posexplode("kind.groups").alias("_p1", "t")).select(
        F.col("t.name").alias("tournement"), F.col("t.id").alias("groupId"), "_p0", "_p1")
    for word in EXCLUDED_TOURNAMENT_WORDS:
        listed = listed.filter(~F.col("tournement").contains(word))
    return last_row(listed, ["tournement"], F.struct("_p0", "_p1"), ["groupId"])


def feed_events(events: DataFrame, tournaments: DataFrame) -> DataFrame:
    """eventId and tournement of every listed event."""
    listed = events.select("groupId", F.inline("events")).withColumnRenamed("id", "eventId")
    return listed.join(tournaments, "groupId").select("eventId", "tournement")


def feed_offers(offers: DataFrame) -> DataFrame:
    """Match offers with the name and start of their own event, and when they landed."""
    if "landed" not in offers.columns:
        offers = offers.withColumn("landed", F.lit(""))
    flat = offers.select("landed", "events", F.posexplode("betOffers").alias("position", "bet"))
    event = F.get(F.filter("events", lambda e: e["id"] == F.col("bet.eventId")), F.lit(0))
    return (
        flat.withColumn("event", event)
        .filter(F.col("event").isNotNull() & F.col("bet.criterion.label").contains(OFFER_LABEL))
        .select(
            F.col("bet.eventId").alias("eventId"), F.col("event.englishName").alias("englishName"),
            F.col("event.start").alias("start"), "landed", "position",
            F.get("bet.outcomes", F.lit(0))["oddsFractional"].alias("odds0"),
            F.get("bet.outcomes", F.lit(1))["oddsFractional"].alias("odds1"))
    )


def with_sides(offers: DataFrame, compat: bool = False) -> DataFrame:
    """Adds both player names, their key and decimal odds; what does not parse is NULL."""
    sides = offers.withColumns({
        f"_side{s}": text.fixture_side(F.col("englishName"), s, compat) for s in (0, 1)})
    return sides.withColumns({
        "key": F.concat(F.get("_side0", F.lit(0)), F.get("_side1", F.lit(0))),
        "joueur0": text.fixture_player(F.col("_side0")),
        "joueur1": text.fixture_player(F.col("_side1")),
        "oddJoueur0": rates.decimal_odds(F.col("odds0")),
        "oddJoueur1": rates.decimal_odds(F.col("odds1")),
    }).drop("_side0", "_side1")


def split_rejects(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every check, and the others with the name of the first check that failed."""
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()])
    marked = df.withColumn("reason", reason)
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")


def offer_checks() -> dict[str, Column]:
    return {
        "players": F.col("joueur0").isNotNull() & F.col("joueur1").isNotNull(),
        "odds": F.col("oddJoueur0").isNotNull() & F.col("oddJoueur1").isNotNull(),
    }


def latest_offers(offers: DataFrame, order: Sequence[str] = ("landed", "eventId", "position")) -> DataFrame:
    """Last offer per pair of players: of the poll that landed last, and in it of the newest event."""
    cols = [c for c in offers.columns if c != "key"]
    return last_row(offers, ["key"], F.struct(*order), cols)


def polled(landed: Column) -> Column:
    """When the documents of a folder were polled, from the 14 digits in its name; NULL if it has none."""
    return F.try_to_timestamp(F.regexp_extract(landed, r"poll-([0-9]{14})[^/]*$", 1), F.lit("yyyyMMddHHmmss"))


def flatten_feed(
    groups: DataFrame, events: DataFrame, offers: DataFrame, *, compat: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Upcoming matches (tournement, start, both players and odds) and the rejected offers with a reason."""
    listed = feed_events(events, feed_tournaments(groups))
    named = with_sides(feed_offers(offers).join(listed, "eventId"), compat)
    good, rejects = split_rejects(named, offer_checks())
    upcoming = latest_offers(good).select(
        "key", "tournement", "start", "joueur0", "joueur1", "oddJoueur0", "oddJoueur1")
    return upcoming, rejects
