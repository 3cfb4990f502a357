"""Pages, feed files, lake files and streams."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from courtside import schemas
from courtside.operators import feed, html
from courtside.session import scratch_path
from courtside.sources import lake, sinks
from courtside.streaming import feed_stream
from courtside.workload import feeds

HOST = "https://example.test"


def pages(spark, *items):
    return spark.createDataFrame(list(items), "url string, html string")


def test_index_page(spark):
    row = ('<tr><td class="title"><a href="/title/{0}">t</a></td><td><div class="tourney-details">no link</div></td>'
           '<td><div class="tourney-details"><a href="/t/{0}">x</a></div></td><td>$100</td>'
           '<td><div><div> {1} <span class="item-value"> {2} </span></div></div></td></tr>')
    page = pages(spark, ("i", '<table class="results-archive-table mega-table">' + row.format("one", "Outdoor", "Clay")
                         + row.format("two", "Indoor", "Hard") + "</table>"))
    got = [tuple(r) for r in html.index_rows(page, HOST).orderBy("url").collect()]
    assert got == [(f"{HOST}/t/one", "Outdoor Clay"), (f"{HOST}/t/two", "Indoor Hard")]


def tournament_html(rounds, n):
    heads = "".join(f'<thead><tr><th colspan="9">{r}</th></tr></thead>' for r in rounds)
    links = "".join(f'<td class="day-table-button"><a href="/en/players/h2h/{i}">H2H</a></td>' for i in range(n))
    return (
        '<td class="tourney-badge-wrapper"><img src="/img/categorystamps_500.png"></td>'
        '<table><tr class="tourney-result with-icons"><td></td><td><a href="/en/tournaments/spring-open/1/overview">x</a>'
        '</td></tr></table><span class="tourney-dates"> 2020.01.06 - 2020.01.12 <br></span><table class="day-table">' + heads + "</table>" + links
        + '<td class="day-table-button"><a href="/en/scores/1">score</a></td>')


def test_tournament_page(spark):
    page = pages(spark, ("t", tournament_html(["Finals", "Semi-Finals", "1st Round Qualifying"], 4)))
    rows = html.tournament_links(page, HOST).orderBy("position").collect()
    assert [r.phase for r in rows] == ["Finals", "Semi-Finals", "Semi-Finals", "Qualification"]
    assert {(r.name, r.date, r.typeTournament) for r in rows} == {("spring-open", "2020.01.06 - 2020.01.12", "500")}
    assert rows[0].link == f"{HOST}/en/players/h2h/0"


def test_versus_page(spark):
    def player(side, name):
        return (f'<div class="player-{side}-name"><a href="/en/players/{name}/x1/overview">n</a></div>'
                f'<div class="player-{side}-wins" data-x="1"><div class="a"><div id="l">W</div><div> {60 if side == "left" else 40}% </div></div></div>')

    def meeting(surface, name):
        return (f'<tr><td>1</td><td>e</td><td><span> {surface} </span></td><td>F</td>'
                f'<td><a href="/en/players/{name}/x1">n</a></td></tr>')

    body = (player("left", "bob") + player("right", "al") + '<table class="modal-event-breakdown-table">' + meeting("Outdoor Clay", "bob")
            + meeting("Outdoor Clay", "al") + meeting("Outdoor Clay", "bob") + meeting("Indoor Hard", "al") + "</table>")
    links = spark.createDataFrame([("v", "open", "d", None, "Finals", "Outdoor Clay")],
                                  "link string, name string, date string, typeTournament string, phase string, surfaceInout string")
    row = html.versus_rows(pages(spark, ("v", body)), links).first()
    assert (row.winnerName, row.looserName, row.winnerRate, row.looserRate) == ("bob", "al", "60%", "40%")
    assert (round(row.winnerRateSurface, 4), round(row.looserRateSurface, 4)) == (0.6667, 0.3333)
    assert row.typeTournament == "250" and row.phase == "Finals"
    assert [c for c in row.asDict()] == schemas.MATCH_COLUMNS


def test_ranking_page(spark):
    def line(rank, name):
        return (f'<tr><td class="rank-cell"> {rank} </td><td class="player-cell"><a href="/en/players/{name}/x/overview">n</a>'
                f'</td><td class="points-cell"><a href="#">1,{rank}00</a></td><td class="tourn-cell"><a href="#">20</a></td>'
                f'<td class="pts-cell"> 10 </td><td class="next-cell"> 0 </td></tr>')

    page = pages(spark, ("r", "<table>" + line(1, "bob") + line("2T", "di") + line("2T", "ed") + line("-", "fy") + line(300, "al") + line(301, "cy") + "</table>"))
    rows = {r.url.split("/")[5]: r for r in html.ranking_rows(page, HOST).collect()}
    assert rows.keys() == {"bob", "di", "ed", "fy", "al"} and rows["bob"].url == f"{HOST}/en/players/bob/x/player-stats"
    assert tuple(rows["bob"])[1:] == ("1", "1,100", "20", "10", "0")
    dates = pages(spark, ("d", "<ul><li> 2019.12.30 </li><li>2020.01.06</li><li>2020.01.13</li></ul>"))
    assert html.ranking_date(dates, 2020).first()[0] == datetime.date(2020, 1, 6)


def test_player_page(spark):
    def table(values):
        return "<table><tbody>" + "".join(
            f"<tr><td>label</td><td> {v} </td></tr>" for v in values) + "</tbody></table>"

    body = ('<span class="table-weight-lbs">187</span><span class="table-height-cm-wrapper">(185cm)</span>'
            '<span class="table-birthday"> (1987.05.22) </span>'
            + "".join(f'<div class="table-big-value"> {v} </div>' for v in ("10", "1", "2004"))
            + "".join(f'<div class="table-value">{v}</div>' for v in ("a", "b", "Left-Handed, x"))
            + '<div id="playerMatchFactsContainer">' + table(range(100, 110)) + table(range(200, 208)) + "</div>")
    url = f"{HOST}/en/players/bob/player-stats?year=2020&surfaceType=clay"
    row = html.player_rows(pages(spark, (url, body))).first()
    assert (row.player, row.aces, row.totalServicePointsWon) == ("bob", "100", "109")
    assert (row.firstServeReturnPointsWon, row.totalPointsWon) == ("200", "207")
    assert (row.weight, row.height, row.age, row.startCareer, row.plays) == (
        "187", "(185cm)", "(1987.05.22)", "2004", "Left-Handed, x")
    assert html.player_rows(pages(spark, (url, "<p>"))).first().aces is None


def test_odds_page(spark):
    body = ('<b>0</b><table><tr><td><b>9</b></td></tr></table><div id="main"><article><div><span><span>date</span><span> Open </span></span></div>'
            '<div><table><tr><td><a href="#">Al - Bo</a></td><td><b>1.5</b></td><td><b> 2.5 </b></td></tr></table></div></article></div>')
    row = html.odds_rows(pages(spark, ("o", body))).first()
    assert (row.tournement, row.odds, row.player) == (["Open"], ["1.5", "2.5"], ["Al - Bo"])


# --- feed ------------------------------------------------------------------------------------------------------------------


def documents(spark, schema, *docs):
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "json string")
    return df.select(F.from_json("json", schema).alias("d")).select("d.*")


def test_feed(spark):
    groups = documents(spark, schemas.FEED_GROUPS, {"group": {"groups": [
        {"name": "ATP", "groups": [{"name": "Open", "id": 1}, {"name": "Open Doubles", "id": 2}]},
        {"name": "WTA", "groups": [{"name": "Other", "id": 3}]}]}})
    events = documents(spark, schemas.FEED_EVENTS, {"groupId": 1, "events": [{"id": 10}, {"id": 11}]},
                       {"groupId": 3, "events": [{"id": 12}]})

    def doc(event_id, name, bets):
        return {"events": [{"id": event_id, "englishName": name, "start": f"s{event_id}"}], "betOffers": [
            {"eventId": e, "criterion": {"label": label}, "outcomes": [{"oddsFractional": o} for o in odds]}
            for e, label, odds in bets]}

    offers = documents(
        spark, schemas.FEED_OFFERS,
        doc(10, "Nadal, Rafael - Auger-Aliassime, Felix", [
            (10, "Match Odds", ["5/4", "4/5"]), (10, "Match Odds", ["1", "1"]), (10, "Set Odds", ["9", "9"]),
            (99, "Match Odds", ["9", "9"])]),
        doc(11, "Solo", [(11, "Match Odds", ["1/2", "2"])]),
        doc(12, "Not, Listed - Too, Bad", [(12, "Match Odds", ["1/2", "2"])]))
    upcoming, rejects = feed.flatten_feed(groups, events, offers)
    assert [tuple(r) for r in upcoming.collect()] == [
        ("nadalauger-aliassime", "Open", "s10", "rafael nadal", "felix auger-aliassime", 2.0, 2.0)]
    assert [(r.eventId, r.reason) for r in rejects.collect()] == [(11, "players")]


def test_tournament_lookup_file(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps(
        {"Open": {"surface": "clay", "inOut": "Outdoor", "points": 250}, "Cup": {"surface": "hard", "inOut": "Indoor", "points": 500}},
        indent=1))
    got = {tuple(r) for r in lake.read_tournament_lookup(spark, str(tmp_path / "t.json")).collect()}
    assert got == {("Open", "clay", "Outdoor", "250"), ("Cup", "hard", "Indoor", "500")}


# --- lake ------------------------------------------------------------------------------------------------------------------


def one_row_file(root, parts, columns, values):
    folder = root.joinpath(*parts[:-1])
    folder.mkdir(parents=True, exist_ok=True)
    text = "," + ",".join(columns) + "\n0," + ",".join(f'"{v}"' for v in values) + "\n"
    (folder / parts[-1]).write_text(text)


def test_lake_of_one_row_files(spark, tmp_path):
    for year in ("2019", "2020"):
        for week in ("6-1", "13-1"):
            values = ["bob" if c == "player" else "[]" if c == "aces" else week for c in schemas.STAT_COLUMNS]
            one_row_file(tmp_path, ("Players", year, week, "clay", "bob.csv"), schemas.STAT_COLUMNS, values)
    values = ["n"] * len(schemas.MATCH_COLUMNS)
    one_row_file(tmp_path, ("Tournaments", "2020", "250", "Outdoor Clay", "open", "a_b.csv"), schemas.MATCH_COLUMNS, values)

    everything = lake.read_players(spark, str(tmp_path / "Players"))
    one_year = lake.read_players(spark, str(tmp_path / "Players"), 2020)
    assert (everything.count(), one_year.count()) == (4, 2)
    assert {(r._year, r._week, r._surface, r.player, r.aces) for r in one_year.collect()} == {
        ("2020", "6-1", "clay", "bob", "[]"), ("2020", "13-1", "clay", "bob", "[]")}
    # the last file of a listing in path order
    assert one_year.agg(F.max_by("height", "seq")).first()[0] == "6-1"
    match = lake.read_tournaments(spark, str(tmp_path / "Tournaments"), 2020).first()
    assert (match._type, match._surfaceInout, match._tournament) == ("250", "Outdoor Clay", "open")


def test_table_round_trips(spark):
    df = spark.createDataFrame([("a", " x ", "2019"), ("b", None, "2020")], "k string, v string, y string")
    for fmt in ("parquet", "csv"):
        path = scratch_path(spark, fmt)
        sinks.write_table(df, path, fmt=fmt)
        back = spark.read.parquet(path) if fmt == "parquet" else lake.read_table_csv(spark, path, df.columns)
        assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}
    path = scratch_path(spark, "parts")
    sinks.write_table(df, path, partition_by=["y"])
    assert spark.read.parquet(path).filter("y = 2019").select("k").collect()[0][0] == "a"


# --- streams ---------------------------------------------------------------------------------------------------------------


def test_stream_equals_batch(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_type", "event_id", "ts", "value")
    source, target, state = (scratch_path(spark, n) for n in ("source", "target", "state"))
    key, order = ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]

    def run():
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
        return feed_stream.upsert_available(spark, stream, target, state, key, order)

    halves = [events.filter("event_id % 2 = 1"), events.filter("event_id % 2 = 0")]
    halves[0].coalesce(1).write.mode("append").parquet(source)
    run()
    halves[1].repartition(3).write.mode("append").parquet(source)
    got = run()
    batch = sinks.last_row(events, key, F.struct(*order), ["event_id", "ts", "value"])
    assert got.select(batch.columns).exceptAll(batch).count() == 0
    assert got.count() == batch.count()
    assert spark.read.parquet(target).select("version").distinct().count() > 1


def test_stream_without_repeats(spark):
    source, out = scratch_path(spark, "source"), scratch_path(spark, "out")
    df = spark.createDataFrame([(1, datetime.datetime(2020, 1, 1)), (1, datetime.datetime(2020, 1, 1)),
                                (2, datetime.datetime(2020, 1, 1))], "id int, ts timestamp")
    df.coalesce(1).write.parquet(source)
    stream = feed_stream.without_repeats(spark.readStream.schema(df.schema).parquet(source), "ts", "1 hour", ["id"])
    stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]


# --- versions --------------------------------------------------------------------------------------------------------------


def test_compaction_and_readers(spark):
    path = scratch_path(spark, "versions")
    frame = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    state = lambda at=None: {(r.k, r.v) for r in sinks.read_current(spark, path, ["k"], at=at).collect()}
    with pytest.raises(ValueError):
        sinks.read_current(spark, path, ["k"])
    for version, rows in enumerate([[("a", 1), ("b", 1)], [("b", 2)], [("c", 3)], [("a", 4)]]):
        sinks.write_version(frame(*rows), path, version)
    sinks.write_version(frame(("c", 5)), path, 2)
    want = {("a", 4), ("b", 2), ("c", 5)}
    held = sinks.live(spark, path)
    assert state() == want and len(held.folders) == 4
    assert sinks.compact_versions(spark, path, ["k"])
    now = sinks.live(spark, path)
    # one folder is read now; a reader with the older manifest still has its own
    assert [v for v, _ in now.folders] == [sinks.COMPACTED] and state() == state(held) == want
    assert all(now.folders[0][1] in f for f in sinks.read_live(spark, path).inputFiles())
    # versions older than the rows that were compacted do not win when they come again
    sinks.write_version(frame(("b", 1), ("a", 1)), path, 0)
    assert state() == want
    sinks.write_version(frame(("b", 6)), path, 5)
    assert state() == {("a", 4), ("b", 6), ("c", 5)} and state(held) == want
    gone = sinks.vacuum(spark, path)
    assert {f for _, f in held.folders} <= set(gone) and state() == {("a", 4), ("b", 6), ("c", 5)}


def test_two_writers_at_once(spark, monkeypatch):
    """A switch that comes second is made again on top of the first one; a compaction of a folder replaced meanwhile is given up."""
    path = scratch_path(spark, "versions")
    frame = lambda k: spark.createDataFrame([(k, 1)], "k string, v int")
    sinks.write_version(frame("a"), path, 0)
    original, others = sinks._switch, [("b", 1)]

    def interrupted(spark, path, now, folders):
        if others:
            key, version = others.pop()
            sinks.write_version(frame(key), path, version)
        return original(spark, path, now, folders)

    monkeypatch.setattr(sinks, "_switch", interrupted)
    sinks.write_version(frame("c"), path, 2)
    keys = lambda: sorted(r.k for r in sinks.read_current(spark, path, ["k"]).collect())
    assert keys() == ["a", "b", "c"] and [v for v, _ in sinks.live(spark, path).folders] == [0, 1, 2]
    others.append(("d", 7))
    assert sinks.compact_versions(spark, path, ["k"]) and keys() == ["a", "b", "c", "d"]
    assert [v for v, _ in sinks.live(spark, path).folders] == [sinks.COMPACTED, 7]
    others.append(("e", 7))
    assert not sinks.compact_versions(spark, path, ["k"]) and keys() == ["a", "b", "c", "e"]


def test_layouts_prune_directories(spark, sf_dir):
    path = feeds._land_entities(spark, sf_dir)
    rows = lake.read_entities(spark, path, schemas.STAT_COLUMNS, lake.PLAYER_LAYOUT)
    week = rows.filter((F.col("_year") == "1997") & (F.col("_week") == "1-4"))
    assert 0 < week.count() < rows.count()
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_year" in plan and "DataFilters: []" in plan
    # many rows a file, and the directories of other weeks are not read
    read = week.select(F.input_file_name().alias("f")).distinct().collect()
    assert read and all("/_year=1997/_week=1-4/" in r.f for r in read) and len(rows.inputFiles()) < rows.count()


# --- streamed polls --------------------------------------------------------------------------------------------------------


def test_polls_as_a_stream(spark, sf_dir):
    """One poll a batch; stopped and started again after two of them; the state equals the batch query over the polls that count."""
    landing, target, checkpoint = (scratch_path(spark, n) for n in ("polls", "offers", "offers-state"))
    staged = scratch_path(spark, "staged")
    feeds.land_polls(spark, sf_dir, staged)
    listed = feeds._listed(spark, sf_dir).cache()

    def land(*names):
        for name in names:
            spark.read.text(f"{staged}/{name}").repartition(2).write.text(f"{landing}/{name}")

    def run():
        query = feed_stream.upsert_offers(spark, landing, listed, target, checkpoint, files_per_trigger=2)
        query.awaitTermination()
        return query

    land("poll-20200105120000", "poll-20200105130000")
    first = run()
    land("poll-20200105130000-again", "poll-20200101120000")
    second = run()
    batches = [p for q in (first, second) for p in q.recentProgress if p["numInputRows"]]
    assert len(batches) >= 4
    # the repeated poll passes nothing on, the late one is dropped by the watermark
    state = [s for p in second.recentProgress for s in p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in state) > 0
    versions = sinks.read_live(spark, target).groupBy(sinks.VERSION).count().collect()
    assert sum(r["count"] > 0 for r in versions) == 2

    polls = spark.read.schema(schemas.FEED_OFFERS).json([f"{staged}/poll-20200105120000", f"{staged}/poll-20200105130000"])
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
    named = feed.with_sides(feed.feed_offers(polls.select("events", "betOffers", folder.alias("landed"))).join(listed, "eventId"))
    want = feed.latest_offers(feed.split_rejects(named, feed.offer_checks())[0])
    cols = ["key", "tournement", "oddJoueur0", "oddJoueur1"]
    got = feed_stream.current_offers(spark, target).select(*cols)
    assert got.count() == want.count() > 0 and got.exceptAll(want.select(*cols)).count() == 0

    # a poll much later moves the watermark beyond all others: what the state remembered of them is released
    remembered = [s["numRowsTotal"] for s in state][-1]
    for name in ("poll-20200109000000", "poll-20200110000000"):
        spark.read.text(f"{staged}/poll-20200105130000").filter("rand(1) < 0.3").repartition(1).write.text(f"{landing}/{name}")
        later = run()
    assert later.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < remembered / 2
