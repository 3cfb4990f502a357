"""What must not grow faster than the input: compared names, shuffled columns, repeated work."""

import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from courtside.functions import similarity
from courtside.operators import enrich, form, fuzzy, html, model_table
from courtside.plans import prediction, refresh
from courtside.session import CLEANUP, materialize
from courtside.workload import analogue, feeds, models, predictions


def test_names_beyond_reach_are_not_compared(monkeypatch):
    """Of numbered names only those with the letters of the query are compared, not the whole block."""
    compared = []
    common = similarity.NameBlock._common
    monkeypatch.setattr(similarity.NameBlock, "_common", lambda self, q, ids: compared.append(ids.shape[1]) or common(self, q, ids))
    block = similarity.NameBlock([f"SUPPLIER#{i:09d}" for i in range(10_000)])
    assert [block.best(f"uppler#{i:09d}")[1] for i in (17, 4711, 9999)] == [17, 4711, 9999]
    assert sum(compared) < 3 * 2_000


def test_bounds_do_not_change_the_best_name():
    rnd = random.Random(5)
    for letters, longest, n in (("abc", 9, 300), ("ab", 90, 80), ("ab", 300, 30), ("".join(map(chr, range(0x4E00, 0x4F00))), 12, 300)):
        word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randint(0, longest)))
        names = [word() for _ in range(n)]
        block, (codes, lengths) = similarity.NameBlock(names), similarity.encode_names(names)
        for query in [word() + "?" for _ in range(20)] + ["", names[3]]:
            scores = similarity.indel_ratios(query, codes, lengths)
            assert block.best(query) == (int(scores.max()), int(np.argmax(scores)))


def test_cells_are_not_merged_into_one_task(spark):
    """A cell is few bytes and much work, so adaptive execution must not put all cells into one task."""
    asked = spark.range(400).select(F.concat(F.lit("q"), F.col("id").cast("string")).alias("query"))
    known = spark.range(400).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"), F.col("id").alias("pos"))
    best = fuzzy.block_matches(asked, known, 4, 4)
    assert best.count() == 400
    text = best._jdf.queryExecution().executedPlan().toString()
    assert text.count("REPARTITION_BY_NUM") >= 2


def test_common_subsequence_of_any_lengths(spark):
    """The bits of a long and the whole table give the same, on both sides of the limit."""
    rnd = random.Random(9)
    word = lambda n: "".join(rnd.choice("abcé漢😀") for _ in range(n))
    pairs = [(word(n), word(m)) for n in (0, 1, 5, 61, 62, 63, 70) for m in (0, 2, 9, 62, 63, 75)] + [("a" * 62, "a" * 62), ("a" * 80, "a" * 62), (None, "a")]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", similarity.common_subsequence(F.col("a"), F.col("b")).alias("n"))

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    assert all(r.n == (None if r.a is None else common(r.a, r.b)) for r in df.collect())


def test_ratio_of_short_names_grows_no_table(spark):
    """A name of 60 characters takes sums of bits; a table of growing arrays for each of a few thousand names would take minutes."""
    names = spark.range(0, 3000, 1, 2).select(F.concat(F.repeat(F.lit("abcde fghij "), 4), F.col("id").cast("string")).alias("a"))
    started = time.perf_counter()
    total = names.select(F.sum(similarity.indel_ratio(F.col("a"), F.reverse("a")))).first()[0]
    assert total > 0 and time.perf_counter() - started < 30


def test_page_parts_are_cut_out_once(spark):
    """A pattern that the plan holds twice searches the page twice."""
    pages = spark.createDataFrame([("u", "<p>")], "url string, html string").repartition(1)
    links = spark.createDataFrame([("u", "n", "d", "250", "Finals", "Outdoor Clay")], "link string, name string, date string, typeTournament string, phase string, surfaceInout string")
    text = html.versus_rows(pages, links)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count(html.MEETINGS_TABLE) == 1 and text.count(html.WINS["winner"]) == 1
    statistics = html.player_rows(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert statistics.count("<tr") == 1


def test_scores_by_a_table_move_no_rows(spark):
    """Inputs stay where they are; unpivoted ones, or a row for every tree, would all be shuffled."""
    rows = spark.range(0, 4, 1, 2).select(F.col("id").alias("key"), F.when(F.col("id") < 3, F.col("id") / 4).alias("a"), F.lit(0.5).alias("b"))
    linear = spark.createDataFrame([("a", 2.0), ("b", -1.0), (model_table.INTERCEPT, 0.25)], model_table.COEFFICIENTS)
    nodes = spark.createDataFrame(
        [(0, 1.0, 0, 0, 0.25, 1, 2, None), (0, 1.0, 1, None, None, None, None, 0.5), (0, 1.0, 2, 1, 0.4, 3, 4, None),
         (0, 1.0, 3, None, None, None, None, 9.0), (0, 1.0, 4, None, None, None, None, -0.5), (1, 0.5, 0, None, None, None, None, 0.2)], model_table.NODES)
    logistic = lambda x: 1 / (1 + np.exp(-x))
    for scored, margins in ((model_table.linear_scores(rows, "key", ["a", "b"], linear), [2 * k / 4 - 0.25 for k in range(3)]),
                            (model_table.tree_scores(rows, "key", ["a", "b"], nodes), [1.2, 1.2, -0.8])):
        lines = scored._jdf.queryExecution().sparkPlan().toString().splitlines()
        main = "\n".join(x for x in lines if not x.lstrip().startswith(":"))  # without the model's own plan
        assert "Join" not in main and "Aggregate" not in main and "Exchange" not in main
        got = {r.key: r.prediction for r in scored.collect()}
        assert got[3] is None and all(abs(got[k] - logistic(m)) < 1e-12 for k, m in enumerate(margins))


def test_bounds_of_the_rows_do_not_repeat_their_joins(spark, sf_dir):
    """The rows of a fit are read back from one written table."""
    assert "Join" not in models._rows(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


def _calls(monkeypatch, name):
    made, original = [], getattr(analogue, name)
    monkeypatch.setattr(analogue, name, lambda *args: made.append(args) or original(*args))
    return made


def test_prediction_run_derives_matches_once(spark, sf_dir, monkeypatch):
    """Offers, names, form and last meetings start from one written table of matches."""
    made = _calls(monkeypatch, "matches_raw")
    total = predictions.flt_12_account(spark, sf_dir).groupBy(F.col("outcome") == "upcoming").agg(F.sum("n").alias("n")).collect()
    assert len(made) == 1 and len({r.n for r in total}) == 1


def test_stream_run_derives_matches_once(spark, sf_dir, monkeypatch):
    """Four polls and the listed events are made from one written table."""
    made = _calls(monkeypatch, "matches_raw")
    assert feeds.strm_1(spark, sf_dir).count() > 0 and len(made) == 1


def test_features_carry_only_their_inputs(spark, sf_dir, monkeypatch):
    """The written rows have no column that no feature reads, and the digest of a match as bytes."""
    written, original = [], refresh.materialize
    monkeypatch.setattr(refresh, "materialize", lambda df, name: written.append(df.dtypes) or original(df, name))
    rows = refresh.feature_rows(analogue.matches_raw(spark, sf_dir), analogue.stats_raw(spark, sf_dir), ("match_id",))
    columns = dict(written[0])
    assert columns["match_id"] == "binary" and not {"url", "date", "name", "winnerName", "looserName", "surfaceInout", "weight0"} & set(columns)
    assert rows.first().match_id in {r.match_id for r in analogue.matches(spark, sf_dir).select("match_id").collect()}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _joins(text):
    return len(re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash|BroadcastNestedLoop)Join", text))


def test_lines_of_an_order_are_moved_once(spark, sf_dir):
    """Values per supplier, ends of an order and the order itself are found by one shuffle of the lines."""
    assert _plan(analogue.matches_raw(spark, sf_dir)).count("Exchange hashpartitioning(l_orderkey") == 1


def test_shuffles_of_a_written_table_are_removed(spark):
    """The files go when the write ends, not when the driver collects its garbage; other queries keep theirs."""
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {x for x in files.split("\n") if "/shuffle_" in x}

    before, setting = shuffles(), spark.conf.get(CLEANUP)
    assert materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "cleaned").count() == 7
    until = time.time() + 20
    while time.time() < until and any(x.endswith(".data") for x in shuffles() - before):
        time.sleep(0.2)
    # the count itself has shuffled one row a file
    assert len([x for x in shuffles() - before if x.endswith(".data")]) <= 1
    assert spark.conf.get(CLEANUP) == setting


def test_prediction_run_looks_up_sides_beside_the_matches(spark, sf_dir, monkeypatch):
    """Matches are joined with the lookup, each side and the last meeting; statistics are derived once, for names and rows."""
    written = []

    def noting(df, name):
        written.append((df.columns, _plan(df)))
        return materialize(df, name)

    for module in (predictions, prediction, fuzzy):
        monkeypatch.setattr(module, "materialize", noting)
    assert predictions.judged(spark, sf_dir, columns=["start", "reject"]).columns == ["start", "reject"]
    assert sum(_joins(text) for columns, text in written if "reject" in columns) == 4
    assert sum(text.count("lineitem.parquet") for _, text in written) == 2
    # the statistics of a side are in a table of names and surfaces
    assert all(c in ("start", "reject") for c in written[-1][0])


def test_features_move_no_matches_after_their_statistics(spark, sf_dir):
    """The last plan attaches statistics to written matches with their form; it has no form, no shuffle by match, no second plan for hot players."""
    rows = refresh.feature_rows(analogue.matches_raw(spark, sf_dir), analogue.stats_raw(spark, sf_dir), ("match_id", "year"))
    text = _plan(rows)
    assert _joins(text) == 2 and "Window" not in text and "Union" not in text and "hashpartitioning(match_id" not in text


def test_form_reads_the_rankings_of_the_beaten(spark):
    """One lookup a match gives the form that both rankings give, with and without hot players."""
    rnd = random.Random(3)
    days = [f"2000-01-{d:02d}" for d in range(1, 10)]
    played = [(f"m{k:03d}", *sorted(rnd.sample("abcde", 2)), 2000, rnd.choice(days), rnd.choice(["Hard", "Carpet", None]), rnd.randint(0, 1)) for k in range(80)]
    matches = spark.createDataFrame(played, "match_id string, player0 string, player1 string, year int, start_date string, surface string, label int").withColumn(
        "start_date", F.col("start_date").cast("date"))
    known = spark.createDataFrame([(p, 2000, s, 10 * k + len(s)) for k, p in enumerate("abcd") for s in ("hard", "grass")],
                                  "player string, year int, surface string, ranking int")
    both = enrich.attach_latest(matches, known, ["ranking"])
    want = form.recent_form(form.player_rows(both, ("match_id", "start_date")), 3, hot_rows=None)
    want = {(r.match_id, r.slot): (0.5 if r.forme is None else r.forme, r.win_mean) for r in want.collect()}
    assert any(m is not None for _, m in want.values())
    beaten = materialize(refresh.with_beaten(matches, known), "beaten")
    for hot_rows in (None, 5, 1000):
        got = refresh.with_form(beaten, hot_rows).collect()
        assert {(r.match_id, s): (r[f"Forme{s}"], r[f"WinMean{s}"]) for r in got for s in (0, 1)} == want
