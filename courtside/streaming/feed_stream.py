"""Landed offers as a stream, upserted by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside import schemas
from courtside.operators import feed
from courtside.operators.skew import last_row
from courtside.sources import lake
from courtside.sources.sinks import read_current, write_version

#: an offer of an upcoming match is known by the names of its players; the newest poll, event and position win
OFFER_KEY = ("key",)
OFFER_ORDER = ("polled", "eventId", "position")


def without_repeats(stream: DataFrame, time: str, delay: str, columns: Sequence[str]) -> DataFrame:
    """Drops records equal in ``columns`` to one seen within ``delay``; state older than that is released.

    ``columns`` must tell records apart (an id): a value that goes back to a former one is news, not a repeat. Rows later
    than ``delay`` are dropped by the watermark.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(columns))


def stream_upsert(
    stream: DataFrame, target: str, checkpoint: str, key: Sequence[str], order: Sequence[Column],
    *, available_now: bool = True,
):
    """Starts a query that writes the newest row per key of every micro-batch as one version of ``target``.

    The version is the batch id, so a batch that is run again after a failure replaces its own output.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        cols = [c for c in batch.columns if c not in key]
        ranked = batch.withColumn("_order", F.struct(*order))
        write_version(last_row(ranked, list(key), F.col("_order"), cols), target, batch_id)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def upsert_available(
    spark: SparkSession, stream: DataFrame, target: str, checkpoint: str, key: Sequence[str],
    order: Sequence[Column],
) -> DataFrame:
    """Processes what is there now and returns the current state of the target."""
    stream_upsert(stream, target, checkpoint, key, order).awaitTermination()
    return read_current(spark, target, key, order)


def offers_of(stream: DataFrame, listed: DataFrame, delay: str) -> DataFrame:
    """Offers of listed events from streamed feed documents, each delivered poll once.

    Event time is the time of the poll. A poll that is landed again, in whatever folder, repeats offers equal in poll, event,
    position and odds; they are dropped as long as the state remembers them, that is for ``delay`` of event time, after which the
    state is released. Odds that change, or change back, come with another poll and pass. Polls later than ``delay`` are dropped.
    """
    named = feed.with_sides(feed.feed_offers(stream).join(listed, "eventId"))
    good, _ = feed.split_rejects(named, feed.offer_checks())
    timed = good.withColumn("polled", feed.polled(F.col("landed"))).filter("polled IS NOT NULL")
    once = without_repeats(timed, "polled", delay, [*OFFER_ORDER, "oddJoueur0", "oddJoueur1"])
    return once.select("key", "tournement", "start", "joueur0", "joueur1", "oddJoueur0", "oddJoueur1", *OFFER_ORDER)


def upsert_offers(
    spark: SparkSession, landing: str, listed: DataFrame, target: str, checkpoint: str, *, delay: str = "1 hour",
    files_per_trigger: int = 100, available_now: bool = True,
):
    """Starts a query from landed polls (``landing/poll-<yyyyMMddHHmmss>*/``) to the latest offer per match in ``target``."""
    documents = lake.stream_feed(spark, f"{landing}/poll-*", schemas.FEED_OFFERS, files_per_trigger)
    return stream_upsert(
        offers_of(documents, listed, delay), target, checkpoint, list(OFFER_KEY), [F.col(c) for c in OFFER_ORDER],
        available_now=available_now)


def current_offers(spark: SparkSession, target: str) -> DataFrame:
    """The latest offer of every match."""
    return read_current(spark, target, list(OFFER_KEY), [F.col(c) for c in OFFER_ORDER])
