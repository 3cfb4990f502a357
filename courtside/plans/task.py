"""The run as a whole: refresh the tables, train, predict. State lives in tables below one store path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.operators import clean, dataset, feed, model, orient
from courtside.operators.names import NameIndex
from courtside.plans import prediction, refresh, training
from courtside.schemas import FEATURES
from courtside.session import materialize
from courtside.sources import sinks

KEY = ["complete_id"]


def matches(spark: SparkSession, store: str) -> DataFrame:
    """Landed matches, clean and oriented."""
    return refresh.oriented_matches(spark.read.parquet(f"{store}/tournaments").drop("season"))


def features(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store}/features").select(*refresh.KEYS, *[f"`{c}`" for c in FEATURES])


def predictions(spark: SparkSession, store: str) -> DataFrame:
    """Current prediction per match."""
    return sinks.read_current(spark, f"{store}/predictions", KEY)


def refresh_data(spark: SparkSession, lake_path: str, store: str, year: int | None = None) -> None:
    """Lands the files of a year (all years by default) and rebuilds the feature table from everything landed.

    Form looks back over the turn of the year, so features are built from all seasons. Names not yet known are added to the
    index of names.
    """
    refresh.consolidate(spark, lake_path, store, year)
    raw = [spark.read.parquet(f"{store}/{n}").drop("season") for n in ("tournaments", "players")]
    sinks.write_table(refresh.feature_rows(*raw), f"{store}/features", ["year"])
    index = NameIndex(spark, f"{store}/names")
    index.extend(raw[1].select("player"), "statistics", name="player")
    index.extend(orient.players(features(spark, store)), "history", name="player")


def train_model(spark: SparkSession, store: str, algorithm: str = "logistic", **params: object) -> float:
    """Fits on complete rows of known rounds, saves model and scaler, and returns the accuracy on the test part."""
    rows = features(spark, store)
    complete = dataset.numeric_phase(rows).dropna("any", subset=[f"`{c}`" for c in FEATURES])
    fitted = training.fit(complete, algorithm=algorithm, **params)
    model.save(fitted.model, f"{store}/model")
    sinks.write_table(fitted.scaler, f"{store}/scaler")
    return fitted.accuracy


def predict_upcoming(
    spark: SparkSession, store: str, groups: DataFrame, events: DataFrame, offers: DataFrame, lookup: DataFrame,
    *, as_of_year: int, version: int,
) -> DataFrame:
    """Upserts predictions of the matches in the feed and returns what was not predicted: tournement, start, joueur0, joueur1,
    reason and detail, of offers that do not parse and of matches that cannot be scored.

    Names are resolved against the landed index: the spellings of the statistics, and for form those of the match history.
    """
    upcoming, unparsed = feed.flatten_feed(groups, events, offers)
    stats = clean.clean_stats(spark.read.parquet(f"{store}/players").drop("season"))
    last = features(spark, store).withColumn("seq", F.struct("start_date", "match_id"))
    asked = upcoming.select(F.explode(F.array("joueur0", "joueur1")).alias("query"))
    index = NameIndex(spark, f"{store}/names")
    judged = materialize(prediction.judged_matches(
        upcoming, lookup, stats, matches(spark, store), last, as_of_year=as_of_year,
        names=index.resolve(asked, "statistics"), form_names=index.resolve(asked, "history")), "judged")
    out = prediction.predict(prediction.scorable(judged), spark.read.parquet(f"{store}/scaler"), model.load(f"{store}/model"))
    sinks.write_version(out, f"{store}/predictions", version, KEY, [F.col("match_date"), F.col("probability_score_player_0")])
    cols = ["tournement", "start", "joueur0", "joueur1", "reason", "detail"]
    unscored = prediction.rejects(judged).withColumnsRenamed({"feed0": "joueur0", "feed1": "joueur1"})
    return unparsed.withColumn("detail", F.col("englishName")).select(*cols).unionByName(unscored.select(*cols))
