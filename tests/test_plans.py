"""Whole flows, and what the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from courtside import schemas
from courtside.operators import form, model, orient
from courtside.operators.skew import rows_per_key_at_most
from courtside.plans import prediction, refresh, task, training
from courtside.session import materialize, scratch_path
from courtside.workload import analogue as a
from courtside.workload import feeds


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return materialize(a.matches_raw(spark, sf_dir)), materialize(a.stats_raw(spark, sf_dir))


@pytest.fixture(scope="module")
def features(raw):
    keep = ("match_id", "player0", "player1", "year", "start_date", "phase")
    return materialize(refresh.feature_rows(*raw, keep=keep))


def test_feature_columns(features):
    assert len(schemas.FEATURES) == 72
    assert features.columns[6:] == schemas.FEATURES
    assert set(t for c, t in features.dtypes if c in schemas.FEATURES) == {"double"}


def test_rates_sum_to_one(features):
    for kind in ("", "Surface"):
        total = F.abs(F.col(f"RateFace2Face{kind}0") + F.col(f"RateFace2Face{kind}1") - 1)
        assert features.agg(F.max(total)).first()[0] < 1e-9


def test_orientation_ignores_who_is_named_first(spark):
    df = spark.createDataFrame([("m", "b", "a")], "id string, winnerName string, looserName string")
    swapped = orient.orient(df, winner="looserName", looser="winnerName")
    straight = orient.orient(df)
    assert straight.select("player0", "player1").first() == swapped.select("player0", "player1").first()
    assert straight.first().label + swapped.first().label == 1


def test_train_and_predict(spark, raw, features):
    rows = features.dropna("any", subset=[f"`{c}`" for c in schemas.FEATURES])
    trained = training.fit(rows, algorithm="logistic", maxIter=10)
    majority = rows.agg(F.avg("label")).first()[0]
    assert trained.accuracy > max(majority, 1 - majority)

    matches, raw_stats = raw
    stats = refresh.clean.clean_stats(raw_stats)
    history = refresh.oriented_matches(matches)
    # upcoming matches between known players, spelt differently
    upcoming = history.select(
        F.translate("winnerName", "-", " ").alias("joueur0"), F.translate("looserName", "-", " ").alias("joueur1"),
        F.lit("open").alias("tournement"), F.col("date").alias("start"), F.lit(2.0).alias("oddJoueur0"),
        F.lit(1.8).alias("oddJoueur1")).limit(50)
    lookup = spark.createDataFrame([("open", "Hard", "Outdoor", "250")], "name string, surface string, inOut string, points string")
    form_rows = features.join(history.select("match_id", "seq"), "match_id")
    built = prediction.prediction_rows(upcoming, lookup, stats, history, form_rows, as_of_year=2020)
    assert built.columns[5:] == schemas.FEATURES
    out = prediction.predict(built, trained.scaler, trained.model)
    assert out.schema.fieldNames() == schemas.PREDICTIONS.fieldNames()
    got = out.collect()
    assert got and all(abs(r.probability_score_player_0 + r.probability_score_player_1 - 1) < 1e-9 for r in got)


def test_the_three_entries(spark, sf_dir, tmp_path):
    """Landed files to a prediction table, twice."""
    store = scratch_path(spark, "store")
    for name, root in (("Players", feeds._land_players(spark, sf_dir)), ("Tournaments", feeds._land_matches(spark, sf_dir))):
        (tmp_path / name).symlink_to(root)
    task.refresh_data(spark, str(tmp_path), store)
    features = task.features(spark, store)
    assert features.count() == a.matches(spark, sf_dir).count()
    # landing one year again changes nothing
    refresh.consolidate(spark, str(tmp_path), store, 1998)
    assert task.matches(spark, store).count() == features.count()

    assert 0.5 < task.train_model(spark, store, maxIter=10) <= 1
    feed = [feeds._parsed(make(spark, sf_dir), schema) for make, schema in (
        (feeds.group_documents, schemas.FEED_GROUPS), (feeds.event_documents, schemas.FEED_EVENTS),
        (feeds.offer_documents, schemas.FEED_OFFERS))]
    names = feed[0].select(F.explode("group.groups").alias("g")).select(F.explode("g.groups").alias("t"))
    lookup = names.select(
        F.col("t.name").alias("name"), F.lit("Hard").alias("surface"), F.lit("Outdoor").alias("inOut"),
        F.lit("500").alias("points"))
    for version in (1, 1, 2):
        task.predict_upcoming(spark, store, *feed, lookup, as_of_year=2001, version=version)
    current = task.predictions(spark, store)
    assert current.count() == current.select("complete_id").distinct().count() > 0
    assert set(schemas.PREDICTIONS.fieldNames()) == set(current.columns)


@pytest.mark.parametrize("algorithm", ["boosted", "perceptron"])
def test_other_classifiers(features, algorithm):
    rows = features.dropna("any", subset=[f"`{c}`" for c in schemas.FEATURES])
    prepared = materialize(training.prepare(rows)[0])
    inputs = ["ranking0", "ranking1", "RateFace2Face0", "RateFace2Face1"]
    fitted = model.train(prepared, inputs, algorithm, maxIter=5)
    scored = model.score(fitted, prepared)
    assert scored.count() == prepared.count()
    assert scored.select("prediction").agg(F.min("prediction")).first()[0] >= 0


# --- plans -------------------------------------------------------------------------------------------------------------------

def test_row_limits_run_before_the_shuffle(spark, sf_dir):
    rows = orient.to_player_rows(a.matches(spark, sf_dir), ["seq"])
    text = plan(rows_per_key_at_most(rows, ["player"], [F.col("seq")], 3))
    assert text.count("WindowGroupLimit") == 2
    assert plan(form.recent_form_year_prefix(a.player_rows(spark, sf_dir))).count("WindowGroupLimit") >= 2


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = plan(orders.filter("o_orderdate > '1998-01-01'").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in text
    lines = plan(a.matches_raw(spark, sf_dir).select("seq"))
    assert "l_discount" not in lines and "l_tax" not in lines
