"""Operators on hand-made rows, against plain computations."""

import datetime
import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from courtside.operators import dataset, decide, enrich, form, fuzzy, h2h, model, orient, skew
from courtside.session import scratch_path
from courtside.sources import sinks
from test_functions import ratio

DAY = datetime.date(2020, 1, 1)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- sides -------------------------------------------------------------------------------------------------------------


def test_orient(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "a"), (None, "a")], "winnerName string, looserName string")
    assert rows(orient.orient(df).select("player0", "player1", "label")) == [("a", "b", 0), ("a", "b", 1)]


def test_orient_offer_moves_odds(spark):
    df = spark.createDataFrame([("b", "a", 2.0, 3.0), ("a", "b", 3.0, 2.0)], "joueur0 string, joueur1 string, oddJoueur0 double, oddJoueur1 double")
    out = orient.orient_offer(df).select("player0", "player1", "odd0", "odd1")
    assert rows(out) == [("a", "b", 3.0, 2.0)] * 2
    assert rows(orient.orient_offer(df, compat=True).select("odd0", "odd1")) == [(2.0, 3.0), (3.0, 2.0)]


# --- statistics -----------------------------------------------------------------------------------------------------------

STATS = "player string, year int, surface string, seq string, aces int"


def test_attach_stats(spark):
    stats = spark.createDataFrame([
        ("a", 2020, "grass", "1", 10), ("a", 2020, "grass", "2", 20), ("b", 2020, "hard", "1", 30)], STATS)
    matches = spark.createDataFrame([("m1", "a", "b", 2020, "Carpet"), ("m2", "a", "b", 2019, "Hard")],
                                    "match_id string, player0 string, player1 string, year int, surface string")
    out = enrich.attach_stats(matches, stats, ["aces"]).select("match_id", "aces0", "aces1")
    assert rows(out, "match_id") == [("m1", 20, None), ("m2", None, None)]


@pytest.mark.parametrize("stats, expected", [
    ([], None),
    ([("hard", 1, 5)], None),
    ([("clay", 1, 5), ("clay", 2, 6)], 5),
    ([("clay", 1, 5), ("clay", 2, 6), ("clay", 3, 7)], 6),
    ([("clay", 1, None), ("clay", 2, 6), ("hard", 1, 8), ("hard", 2, 9)], 8),
    ([("clay", 1, None), ("clay", 2, None), ("hard", 1, 8), ("hard", 2, 9)], None),
])
def test_previous_stats(spark, stats, expected):
    dim = spark.createDataFrame([("a", *s) for s in stats], "player string, surface string, seq int, aces int")
    up = spark.createDataFrame([("m", "a", "clay")], "match_id string, player string, surface string")
    got = rows(enrich.previous_stats(up, dim, ["aces"]).select("aces"))
    assert got == ([] if expected is None else [(expected,)])


# --- head-to-head ---------------------------------------------------------------------------------------------------------


def test_last_confrontation(spark):
    history = spark.createDataFrame([
        ("a", "b", "hard", datetime.date(2018, 1, 1), 1, 60.0, 40.0, 0.6, 0.4),
        ("b", "a", "hard", datetime.date(2019, 1, 1), 2, 55.0, 45.0, 0.5, 0.5),
        ("a", "b", "clay", datetime.date(2016, 1, 1), 3, 90.0, 10.0, 0.9, 0.1),
    ], "winnerName string, looserName string, surface string, start_date date, seq int, winnerRate double, "
       "looserRate double, winnerRateSurface double, looserRateSurface double")
    up = spark.createDataFrame([("a", "b", "hard", 10, 40), ("a", "b", "clay", 10, 40), ("a", "c", "hard", 40, 10)],
                               "player0 string, player1 string, surface string, ranking0 int, ranking1 int")
    out = h2h.last_confrontation(up, history).select(
        "player1", "surface", F.round("RateFace2Face0", 4), F.round("RateFace2Face1", 4), "RateFace2FaceSurface0")
    got = rows(out, "player1", "surface")
    assert got[0][:4] == ("b", "clay", 0.55, 0.45)  # the only meeting on clay is too old
    assert got[1] == ("b", "hard", 45.0, 55.0, 0.5)
    assert got[2][:4] == ("c", "hard", 0.45, 0.55)


def test_rates_by_label(spark):
    df = spark.createDataFrame([(0, 60.0, 40.0, 0.7, 0.3), (1, 60.0, 40.0, 0.7, 0.3)],
                               "label int, winnerRate double, looserRate double, winnerRateSurface double, looserRateSurface double")
    names = ["RateFace2Face0", "RateFace2Face1", "RateFace2FaceSurface0", "RateFace2FaceSurface1"]
    assert rows(h2h.h2h_rates(df).select(*names)) == [(0.6, 0.4, 0.7, 0.3), (0.4, 0.6, 0.3, 0.7)]
    assert rows(h2h.h2h_rates(df, compat=True).select(*names)) == [(0.6, 0.4, 0.7, 0.3)] * 2


def test_impute_uses_the_other_ranking(spark):
    df = spark.createDataFrame([(None, 0.5, None, 0.5, 10, 40), (0.2, 0.8, 0.3, None, 10, 40)],
                               "RateFace2Face0 double, RateFace2Face1 double, RateFace2FaceSurface0 double, "
                               "RateFace2FaceSurface1 double, ranking0 int, ranking1 int")
    got = rows(h2h.impute_h2h(df).select(*df.columns[:4]))
    assert [tuple(round(v, 6) for v in r) for r in got] == [(0.55, 0.45, 0.55, 0.45), (0.2, 0.8, 0.55, 0.45)]


# --- form ------------------------------------------------------------------------------------------------------------------


def player_history(spark, n=400, hot=True, seed=3):
    """Matches where one player has most of the rows, several on the same day."""
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        player = "hot" if hot and rnd.random() < 0.7 else f"p{rnd.randrange(6)}"
        data.append((player, DAY + datetime.timedelta(days=rnd.randrange(12)), f"{rnd.randrange(16**8):08x}-{i}", i,
                     rnd.randrange(2), rnd.randrange(2), rnd.choice([None, rnd.randrange(1, 300)])))
    return spark.createDataFrame(
        data, "player string, start_date date, match_id string, num long, slot int, win int, opponent_ranking int"), data


def expected_form(data, k=3):
    out = {}
    for row in data:
        before = sorted(r[1:] for r in data if r[0] == row[0] and (r[1], r[2]) < (row[1], row[2]))[-k:]
        beaten = [r[5] for r in before if r[4] == 1 and r[5] is not None]
        out[row[2]] = (
            len(before), sum(r[4] for r in before) / len(before) if before else None,
            sum(beaten) / len(beaten) if beaten else None)
    return out


@pytest.mark.parametrize("hot_rows", [None, 10, 1_000_000])
def test_recent_form(spark, hot_rows):
    df, data = player_history(spark)
    got = {r.match_id: (r.n, r.forme, r.win_mean) for r in form.recent_form(df, hot_rows=hot_rows).collect()}
    expected = expected_form(data)
    assert got.keys() == expected.keys()
    for key, (n, forme, mean) in expected.items():
        assert got[key][0] == n
        assert got[key][1] == pytest.approx(forme)
        assert got[key][2] == pytest.approx(mean)


def test_hot_keys_with_numeric_ids(spark):
    df, _ = player_history(spark)
    plain = skew.previous_rows(df, ["player"], "start_date", "num", ["win", "num"], 5, hot_rows=None)
    cut = skew.previous_rows(df, ["player"], "start_date", "num", ["win", "num"], 5, hot_rows=10)
    assert rows(plain.select("num", "previous"), "num") == rows(cut.select("num", "previous"), "num")


@pytest.mark.parametrize("tie", ["match_id", "num"])
def test_running_totals_of_hot_keys(spark, tie):
    df, _ = player_history(spark)
    totals = {"n": F.lit(1).cast("long"), "w": F.col("win").cast("long")}
    plain, cut = (
        skew.running_totals(df, ["player"], "start_date", tie, totals, hot_rows=h).select("num", "n", "w")
        for h in (None, 10))
    assert rows(plain, "num") == rows(cut, "num")


@pytest.mark.parametrize("tie", ["match_id", "num", "named"])
def test_hot_keys_are_cut_in_ordered_pieces(spark, tie):
    df, _ = player_history(spark)
    df = df.withColumn("named", F.concat(F.lit("match-"), F.lpad(F.col("num").cast("string"), 5, "0")))
    cold, hot = skew.split_hot(df, ["player"], "start_date", tie, hot_rows=20)
    counts = {r.player: r["count"] for r in df.groupBy("player").count().collect()}
    assert {r.player for r in hot.select("player").distinct().collect()} == {p for p, n in counts.items() if n > 20}
    assert cold.count() + hot.count() == df.count()
    in_row_order = [(r._piece_run, r._piece_cut) for r in hot.filter("player = 'hot'").orderBy("start_date", tie).collect()]
    assert in_row_order == sorted(in_row_order) and len(set(in_row_order)) > 5


def history(spark, days, per_day, ident):
    rows = [(None if k % 2 else "p", DAY + datetime.timedelta(days=d), ident(d * per_day + k)) for d in range(days) for k in range(per_day)]
    return spark.createDataFrame(rows, "player string, start_date date, id string")


@pytest.mark.parametrize("days, per_day, ident", [
    (3000, 2, lambda k: hashlib.sha256(str(k).encode()).hexdigest()),  # a long history
    (1, 6000, lambda k: f"same-prefix-for-all-{k}"),  # one huge day, crowded ids
    (3, 2000, lambda k: "x" * 40 + chr(0x4E00 + k // 200) * (k % 200 + 1)),  # ids that differ late
])
def test_pieces_follow_counts(spark, days, per_day, ident):
    df = history(spark, days, per_day, ident)
    target = 200
    cold, hot = skew.split_hot(df, ["player"], "start_date", "id", hot_rows=target)
    assert cold.count() == 0
    sizes = [r["count"] for r in hot.groupBy("player", "_piece_run", "_piece_cut").count().collect()]
    assert sum(sizes) == df.count() and max(sizes) <= 2 * target and len(sizes) <= 2 * df.count() / target + 2


def test_null_keys_are_cut_and_keep_their_rows(spark):
    df = history(spark, 40, 10, lambda k: f"{k:06d}").withColumn("n", F.col("id").cast("long"))
    plain, cut = (skew.previous_rows(df, ["player"], "start_date", "id", ["n"], 3, hot_rows=h) for h in (None, 20))
    assert rows(plain.select("n", "previous"), "n") == rows(cut.select("n", "previous"), "n")
    totals = {"before": F.lit(1).cast("long")}
    plain, cut = (skew.running_totals(df, ["player"], "start_date", "id", totals, hot_rows=h) for h in (None, 20))
    assert rows(plain.select("n", "before"), "n") == rows(cut.select("n", "before"), "n")


def test_matches_without_a_surface_stay(spark):
    df = spark.createDataFrame([("a", "b", None, 0, "m1"), ("a", "b", "hard", 0, "m2")], "player0 string, player1 string, surface string, label int, match_id string")
    df = df.withColumn("start_date", F.lit("2020-01-01").cast("date"))
    for compat in (True, False):
        assert h2h.surface_h2h(df, compat=compat).count() == 2


def test_rows_with_missing_inputs_are_scored_null(spark):
    data = [(k, float(k % 7), float(k % 3), k % 2, "train") for k in range(60)] + [(99, None, 1.0, 0, "train"), (98, float("nan"), 1.0, 0, "train")]
    df = spark.createDataFrame(data, "id int, x double, y double, label int, part string")
    scored = {r.id: r for r in model.score(model.train(df, ["x", "y"], maxIter=5), df).collect()}
    assert len(scored) == 62 and scored[99].prediction is None and scored[98].prediction is None
    assert scored[99].x is None and scored[5].x == 5.0 and all(0 <= scored[k].prediction <= 1 for k in range(60))


def expected_prefix(data, year, player, k=3):
    seen = sorted((r[1], r[2], r[3], r[4]) for r in data if r[0] == player and r[5] <= year)
    kept = seen[:k] if len(seen) > k else seen
    won = [r for r in kept if r[2] == 1]
    if not won:
        return (len(seen), 0.5, 150.0) if len(seen) > k else (len(seen), 0.0, 0.0)
    means = []
    for slot in (1, 0):
        ranks = [r[3] for r in won if r[1] == slot and r[3] is not None]
        means.append(sum(ranks) / len(ranks) if ranks else None)
    rank = None if None in means else sum(means) / len(won)
    return len(seen), len(won) / len(kept), rank


def test_recent_form_year_prefix(spark):
    rnd = random.Random(5)
    data = [(rnd.choice("abcd"), i, rnd.randrange(2), rnd.randrange(2), rnd.choice([None, 5, 20, 80]), 2010 + i % 4)
            for i in range(40)]
    data += [("loser", 100 + i, 0, 0, 9, 2010 + i) for i in range(5)]
    df = spark.createDataFrame(data, "player string, seq int, slot int, win int, opponent_ranking int, year int")
    got = form.recent_form_year_prefix(df).collect()
    assert {(r.player, r.year) for r in got} == {(d[0], d[5]) for d in data}
    for r in got:
        n, forme, rank = expected_prefix(data, r.year, r.player)
        assert (r.n, r.forme, r["rank"]) == (n, pytest.approx(forme), pytest.approx(rank))
    losers = {r.year: (r.forme, r["rank"]) for r in got if r.player == "loser"}
    assert losers[2010] == (0.0, 0.0) and losers[2013] == (0.5, 150.0)


def test_last_form(spark):
    features = spark.createDataFrame([
        (1, "a", "b", 0, 0.1, 0.9, 10.0, 90.0), (2, "a", "c", 1, 0.2, 0.8, 20.0, 80.0)],
        "seq int, player0 string, player1 string, label int, Forme0 double, Forme1 double, WinMean0 double, WinMean1 double")
    up = spark.createDataFrame([("a", "b"), ("a", "z")], "player0 string, player1 string")
    assert rows(form.last_form(up, features), "player1") == [("a", "b", 0.2, 0.9, 20.0, 90.0), ("a", "z", 0.2, None, 20.0, None)]
    # a player who lost in slot 0 gets the other slot's form in the historical rule
    assert rows(form.last_form(up, features, compat=True), "player1")[0] == ("a", "b", 0.8, 0.9, 80.0, 90.0)


# --- names -------------------------------------------------------------------------------------------------------------


def names(n, seed):
    rnd = random.Random(seed)
    return sorted({" ".join("".join(rnd.choice("abcdelnors") for _ in range(rnd.randrange(2, 8))) for _ in range(2))
                   for _ in range(n)})


def altered(word, rnd):
    chars = list(word)
    for _ in range(rnd.randrange(0, 4)):
        at = rnd.randrange(len(chars))
        kind = rnd.randrange(3)
        if kind == 0:
            chars[at] = rnd.choice("abcxyz-")
        elif kind == 1 and len(chars) > 2:
            del chars[at]
        else:
            chars.insert(at, rnd.choice("abcxyz-"))
    return "".join(chars)


@pytest.mark.parametrize("block_rows", [37, 20_000])
def test_resolve_names_is_exact(spark, block_rows):
    rnd = random.Random(11)
    vocab = names(120, 1) + ["ab", "ba", "a"]
    rnd.shuffle(vocab)
    asked = sorted({altered(rnd.choice(vocab), rnd) for _ in range(80)} | {"", "zzzz", "b", "??", "abba"})
    v = spark.createDataFrame([(n, i) for i, n in enumerate(vocab)], "name string, pos long")
    q = spark.createDataFrame([(a,) for a in asked] + [(None,)], "query string")
    got = {r.query: (r.name, r.score) for r in fuzzy.resolve_names(
        q, v, position="pos", block_rows=block_rows).collect()}
    assert got.keys() == set(asked)
    for query in asked:
        scores = [ratio(n, query) for n in vocab]
        best = max(range(len(vocab)), key=lambda i: (scores[i], -i))
        assert got[query] == (vocab[best] if scores[best] > 0 else "", scores[best]), query


def test_many_open_and_long_names(spark):
    """A thousand names that are like no other against twenty thousand, and names of any length."""
    rnd = random.Random(2)
    name = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    vocab = [name(rnd.randint(8, 24)) for _ in range(20_000)] + ["z" * 5000 + "q", "z" * 300]
    asked = [name(rnd.randint(8, 24)) for _ in range(998)] + ["z" * 4990, "zz" * 160]
    started = time.perf_counter()
    got = {r.query: (r.name, r.score) for r in fuzzy.resolve_names(
        spark.createDataFrame([(q,) for q in asked], "query string"), spark.createDataFrame([(n,) for n in vocab], "name string")).collect()}
    assert time.perf_counter() - started < 60
    assert len(got) == len(set(asked)) and got["z" * 4990][0] == "z" * 5000 + "q" and got["zz" * 160] == ("z" * 300, 97)
    for q in asked[:3]:
        best = max(ratio(q, n) for n in vocab[:20_000])
        assert got[q] == (min(n for n in vocab[:20_000] if ratio(q, n) == best), best)


def test_resolve_names_without_vocabulary(spark):
    q = spark.createDataFrame([("a",)], "query string")
    assert fuzzy.resolve_names(q, q.filter("false").withColumnRenamed("query", "name")).count() == 0


# --- dataset -------------------------------------------------------------------------------------------------------------


def test_minmax(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    bounds = dataset.fit_minmax(df, ["x", "c"])
    assert rows(dataset.apply_minmax(df, bounds, ["x", "c"])) == [(0.0, 0.0), (1.0, 0.0)]
    other = spark.createDataFrame([(5.0, 6.0)], "x double, c double")
    assert rows(dataset.apply_minmax(other, bounds, ["x", "c"])) == [(2.0, 1.0)]


def test_split_is_stable_and_has_the_shares(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    parts = {r.part: r["count"] / 20_000 for r in dataset.split(df, "k").groupBy("part").count().collect()}
    assert parts["train"] == pytest.approx(0.81, abs=0.02)
    assert parts["validation"] == pytest.approx(0.09, abs=0.02)
    again = dataset.split(df.repartition(7), "k")
    assert again.join(dataset.split(df, "k"), ["k", "part"]).count() == 20_000


def test_training_set_drops_unknown_rounds(spark):
    cols = "phase string, x double"
    a = spark.createDataFrame([("3", 1.0), ("Lucky", 2.0)], cols)
    b = spark.createDataFrame([("4", None), ("5", 5.0)], cols)
    assert rows(dataset.training_set(a, b, ["x"]), "phase") == [("3", 1.0), ("5", 5.0)]


# --- decisions -------------------------------------------------------------------------------------------------------------


def test_decide(spark):
    df = spark.createDataFrame([("a", "b", "d", 2.0, 3.0, p) for p in (0.3, 0.5, 0.7)],
                               "player0 string, player1 string, start string, odd0 double, odd1 double, prediction double")
    assert [r.winner_name for r in decide.decide(df).collect()] == ["a", "b", "b"]
    assert decide.playable(df).count() == 2
    edge = df.withColumn("odd0", F.lit(1.2))
    assert decide.playable(edge).count() == 0


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 3), ("c", 4)], "k string, v int")
    once = decide.upsert(old, new, "k", F.col("v"))
    assert rows(once, "k") == [("a", 1), ("b", 2), ("c", 4)]
    assert rows(decide.upsert(once, new, "k", F.col("v")), "k") == rows(once, "k")


def test_versions_replace_themselves(spark):
    path = scratch_path(spark, "versions")
    batch = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    sinks.write_version(batch, path, 1)
    for _ in range(2):
        sinks.write_version(spark.createDataFrame([("b", 2)], "k string, v int"), path, 2)
    # the folder of the replaced attempt stays for readers that hold an older manifest; it is not live
    assert sinks.read_live(spark, path).count() == 3
    assert rows(sinks.read_current(spark, path, ["k"]), "k") == [("a", 1), ("b", 2)]
    sinks.compact(spark, path, path + "-compact", ["k"])
    assert rows(spark.read.parquet(path + "-compact").select("k", "v"), "k") == [("a", 1), ("b", 2)]
