"""Joins, head-to-head and form queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from courtside.functions.rates import stats_surface
from courtside.operators import dataset, enrich, form, h2h, orient
from courtside.operators.skew import last_row, rows_per_key_at_most
from courtside.session import materialize
from courtside.workload import analogue as a
from courtside.workload.registry import query

ATTACH = ["ranking", "aces", "firstServe", "points", "plays"]
RANKED = (a.SQL_MATCHES, a.SQL_STATS, a.SQL_STATS_LAST, a.sql_attached(["ranking"]))
ROWS = (*RANKED, a.SQL_PLAYER_ROWS)


@query("join_1", a.with_sql(
    """SELECT match_id, player0, player1, year, surface, ranking0, aces0, "firstServe0", points0, plays0,
              ranking1, aces1, "firstServe1", points1, plays1 FROM attached""",
    a.SQL_MATCHES, a.SQL_STATS, a.SQL_STATS_LAST, a.sql_attached(ATTACH)))
def join_1(spark, sf_dir):
    """Statistics of both sides on every match."""
    return a.attached(spark, sf_dir, ATTACH).select(
        "match_id", "player0", "player1", "year", "surface", *[f"{c}{s}" for s in (0, 1) for c in ATTACH])


@query("flt_1", a.with_sql(
    " UNION ALL ".join(f"""SELECT m.match_id, {k} AS slot, s.seq FROM matches m JOIN stats s
       ON s.player = m.player{k} AND s.year = m.year AND s.surface = m.stats_surface""" for k in (0, 1)), a.SQL_MATCHES, a.SQL_STATS))
def flt_1(spark, sf_dir):
    """Every statistics row that a side of a match selects by player, year and surface."""
    m = a.matches(spark, sf_dir).select(
        "match_id", F.posexplode(F.array("player0", "player1")).alias("slot", "player"), "year",
        stats_surface(F.col("surface")).alias("surface"))
    s = a.stats(spark, sf_dir).select("player", "year", "surface", "seq")
    return m.join(s, ["player", "year", "surface"]).select("match_id", "slot", "seq")


@query("win_4", a.with_sql(
    'SELECT player, year, surface, seq, ranking, points, plays FROM stats_last', a.SQL_STATS, a.SQL_STATS_LAST))
def win_4(spark, sf_dir):
    """Last statistics row per player, year and surface."""
    s = a.stats(spark, sf_dir).withColumn("order", F.col("seq"))
    return enrich.latest_stats(s, ["seq", "ranking", "points", "plays"], "order")


_UPCOMING_SQL = "upcoming AS (" + " UNION ALL ".join(
    f"SELECT match_id, {k} AS slot, player{k} AS player, stats_surface AS surface FROM matches" for k in (0, 1)) + ")"
_SECOND_SQL = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY player, surface ORDER BY seq DESC) AS rn,
                  row_number() OVER (PARTITION BY player, surface ORDER BY seq) AS rn_first,
                  ("doubleFautes" IS NULL OR "breakPointsSaved" IS NULL OR "breakPointsOpportunities" IS NULL) AS gap
           FROM stats),
state AS (SELECT player, surface, bool_or(NOT gap) AS any_complete, bool_or(gap AND rn_first = 1) AS first_gap
          FROM ranked GROUP BY player, surface),
second AS (SELECT * FROM ranked WHERE rn = 2)"""


@query("join_4", a.with_sql(
    """SELECT u.match_id, u.slot, u.player, u.surface,
              CASE WHEN t.first_gap THEN h.seq ELSE o.seq END AS stats_seq,
              CASE WHEN t.first_gap THEN h.ranking ELSE o.ranking END AS ranking
       FROM upcoming u JOIN state t ON t.player = u.player AND t.surface = u.surface AND t.any_complete
       LEFT JOIN second o ON o.player = u.player AND o.surface = u.surface
       LEFT JOIN second h ON h.player = u.player AND h.surface = 'hard'
       WHERE CASE WHEN t.first_gap THEN h.seq ELSE o.seq END IS NOT NULL""",
    a.SQL_MATCHES, a.SQL_STATS, _UPCOMING_SQL, _SECOND_SQL))
def join_4(spark, sf_dir):
    """Last but one statistics row of both players, with the hard court fallback."""
    up = a.matches(spark, sf_dir).select(
        "match_id", F.posexplode(F.array("player0", "player1")).alias("slot", "player"), stats_surface(F.col("surface")).alias("surface"))
    s = a.stats(spark, sf_dir).withColumn("stats_seq", F.col("seq"))
    cols = ["stats_seq", "ranking", "doubleFautes", "breakPointsSaved", "breakPointsOpportunities"]
    return enrich.previous_stats(up, s, cols).select("match_id", "slot", "player", "surface", "stats_seq", "ranking")


@query("win_5", a.with_sql(
    "SELECT player, surface, seq, ranking FROM second", a.SQL_STATS, _SECOND_SQL))
def win_5(spark, sf_dir):
    """Last but one statistics row per player and surface."""
    ranked = rows_per_key_at_most(a.stats(spark, sf_dir), ["player", "surface"], [F.desc("seq")], 2)
    return ranked.filter("rank = 2").select("player", "surface", "seq", "ranking")


@query("agg_3", a.with_sql(
    """SELECT match_id, CAST(n AS BIGINT) AS meetings, won0 / nullif(n, 0) AS rate0, (n - won0) / nullif(n, 0) AS rate1
       FROM (SELECT match_id, count(*) OVER w AS n,
                    CAST(coalesce(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) OVER w, 0) AS DOUBLE) AS won0
             FROM matches WINDOW w AS (PARTITION BY player0, player1, surface ORDER BY start_date, match_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""", a.SQL_MATCHES))
def agg_3(spark, sf_dir):
    """Share of earlier meetings on the same surface won by each side."""
    m = a.matches(spark, sf_dir).select("match_id", "start_date", "player0", "player1", "surface", "label")
    return h2h.surface_h2h(materialize(m)).select("match_id", "meetings", "rate0", "rate1")


@query("agg_3_all", a.with_sql(
    """SELECT match_id, CAST(count(*) OVER w AS BIGINT) AS meetings,
              CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) OVER w AS DOUBLE) / count(*) OVER w AS rate0,
              CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) OVER w AS DOUBLE) / count(*) OVER w AS rate1
       FROM matches WINDOW w AS (PARTITION BY player0, player1, surface)""", a.SQL_MATCHES))
def agg_3_all(spark, sf_dir):
    """Share of all meetings on the same surface won by each side."""
    return h2h.surface_h2h(a.matches(spark, sf_dir), compat=True).select("match_id", "meetings", "rate0", "rate1")


_LAST_MEETING_SQL = """
last_meeting AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player0, player1, surface ORDER BY start_date DESC, seq DESC)
                        AS rn FROM matches WHERE start_date > DATE '1997-01-01') WHERE rn = 1)"""


def _upcoming(spark, sf_dir):
    """Every match again, as if it were to be played next on hard court."""
    return a.attached(spark, sf_dir, ["ranking"]).select(
        "match_id", "player0", "player1", F.lit("Hard").alias("surface"), "ranking0", "ranking1")


@query("join_5", a.with_sql(
    """SELECT u.match_id,
              CASE WHEN l.match_id IS NULL THEN g.rate0 WHEN l.label = 0 THEN l."winnerRate" ELSE l."looserRate" END
                AS "RateFace2Face0",
              CASE WHEN l.match_id IS NULL THEN g.rate1 WHEN l.label = 0 THEN l."looserRate" ELSE l."winnerRate" END
                AS "RateFace2Face1",
              CASE WHEN l.match_id IS NULL THEN g.rate0 WHEN l.label = 0 THEN l."winnerRateSurface"
                   ELSE l."looserRateSurface" END AS "RateFace2FaceSurface0",
              CASE WHEN l.match_id IS NULL THEN g.rate1 WHEN l.label = 0 THEN l."looserRateSurface"
                   ELSE l."winnerRateSurface" END AS "RateFace2FaceSurface1"
       FROM (SELECT *, CAST(coalesce(ranking0, 300) AS DOUBLE) AS r0, CAST(coalesce(ranking1, 300) AS DOUBLE) AS r1
             FROM attached) u
       LEFT JOIN last_meeting l ON l.player0 = u.player0 AND l.player1 = u.player1 AND l.surface = 'Hard'
       JOIN (SELECT match_id,
                    CASE WHEN r1 < r0 THEN least((1 - b) / 2, (1 + b) / 2) ELSE greatest((1 - b) / 2, (1 + b) / 2) END
                      AS rate0,
                    CASE WHEN r1 < r0 THEN greatest((1 - b) / 2, (1 + b) / 2) ELSE least((1 - b) / 2, (1 + b) / 2) END
                      AS rate1
             FROM (SELECT match_id, r0, r1, abs(r0 - r1) / 300.0 AS b
                   FROM (SELECT match_id, CAST(coalesce(ranking0, 300) AS DOUBLE) AS r0,
                                CAST(coalesce(ranking1, 300) AS DOUBLE) AS r1 FROM attached))) g
         ON g.match_id = u.match_id""", *RANKED, _LAST_MEETING_SQL))
def join_5(spark, sf_dir):
    """Rates of the last meeting on hard court since 1997, else from the ranking gap."""
    history = a.matches(spark, sf_dir)
    out = h2h.last_confrontation(_upcoming(spark, sf_dir), history, since="1997-01-01")
    return out.select("match_id", *[f"RateFace2Face{k}{s}" for k in ("", "Surface") for s in (0, 1)])


_WIN6_SQL = """SELECT player0, player1, surface, "winnerName", "winnerRate", start_date FROM last_meeting"""


@query("win_6", a.with_sql(_WIN6_SQL, a.SQL_MATCHES, _LAST_MEETING_SQL))
def win_6(spark, sf_dir):
    """First row per pair and surface, newest meeting first."""
    recent = a.matches(spark, sf_dir).filter(F.col("start_date") > F.lit("1997-01-01").cast("date"))
    return last_row(
        recent, ["player0", "player1", "surface"], F.struct("start_date", "seq"),
        ["winnerName", "winnerRate", "start_date"])


@query("srt_2", a.with_sql(
    """SELECT player0, player1, max(start_date) AS last_date FROM matches GROUP BY player0, player1""", a.SQL_MATCHES))
def srt_2(spark, sf_dir):
    """Date of the newest meeting of every pair: the first of a descending sort, without sorting."""
    return last_row(
        a.matches(spark, sf_dir), ["player0", "player1"], F.struct("start_date", "seq"), ["start_date"],
    ).withColumnRenamed("start_date", "last_date")


@query("set_2", a.with_sql(
    """SELECT player0, player1, surface, CAST(count(*) AS BIGINT) AS meetings FROM (
         SELECT "winnerName" AS player0, "looserName" AS player1, surface FROM matches WHERE "winnerName" < "looserName"
         UNION ALL
         SELECT "looserName", "winnerName", surface FROM matches WHERE "looserName" < "winnerName")
       GROUP BY 1, 2, 3""", a.SQL_MATCHES))
def set_2(spark, sf_dir):
    """Meetings of a pair in either order, through the canonical pair instead of a union."""
    return a.matches(spark, sf_dir).groupBy("player0", "player1", "surface").agg(F.count("*").alias("meetings"))


_FORM_SQL = """
formed AS (
  SELECT *, count(*) OVER w AS n, avg(CAST(win AS DOUBLE)) OVER w AS forme,
         avg(CASE WHEN win = 1 THEN CAST(opponent_ranking AS DOUBLE) END) OVER w AS win_mean
  FROM player_rows
  WINDOW w AS (PARTITION BY player ORDER BY start_date, match_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))"""
_FORM_SELECT = """SELECT match_id, player, slot, CAST(n AS INTEGER) AS n, round(forme, 6) AS forme,
                         round(win_mean, 6) AS win_mean FROM formed"""


@query("win_2", a.with_sql(_FORM_SELECT, *ROWS, _FORM_SQL))
def win_2(spark, sf_dir):
    """Form over the three matches of a player before each match."""
    out = form.recent_form(materialize(a.player_rows(spark, sf_dir)))
    return out.select(
        "match_id", "player", "slot", "n", F.round("forme", 6).alias("forme"),
        F.round("win_mean", 6).alias("win_mean"))


_PREFIX_SQL = """
years AS (SELECT DISTINCT player, year FROM player_rows),
prefixed AS (SELECT y.player, y.year, r.slot, r.win, r.opponent_ranking,
                    row_number() OVER (PARTITION BY y.player, y.year ORDER BY r.seq, r.slot) AS rn,
                    count(*) OVER (PARTITION BY y.player, y.year) AS n
             FROM years y JOIN player_rows r ON r.player = y.player AND r.year <= y.year),
summed AS (SELECT player, year, max(n) AS n, count(*) AS kept, sum(win) AS won,
                  avg(CASE WHEN win = 1 AND slot = 1 THEN CAST(opponent_ranking AS DOUBLE) END) AS mean1,
                  avg(CASE WHEN win = 1 AND slot = 0 THEN CAST(opponent_ranking AS DOUBLE) END) AS mean0
           FROM prefixed WHERE rn <= 3 GROUP BY player, year)"""
_PREFIX_SELECT = """SELECT player, year, CAST(n AS BIGINT) AS n,
       round(CASE WHEN won = 0 THEN CASE WHEN n > 3 THEN 0.5 ELSE 0.0 END
                  ELSE CAST(won AS DOUBLE) / kept END, 6) AS forme,
       round(CASE WHEN won = 0 THEN CASE WHEN n > 3 THEN 150.0 ELSE 0.0 END
                  ELSE (mean1 + mean0) / CAST(won AS DOUBLE) END, 6) AS rank
FROM summed"""


@query("win_1", a.with_sql(_PREFIX_SELECT, *ROWS, _PREFIX_SQL))
def win_1(spark, sf_dir):
    """Form over the first three matches of all years up to a year."""
    out = form.recent_form_year_prefix(a.player_rows(spark, sf_dir))
    return out.select("player", "year", "n", F.round("forme", 6).alias("forme"), F.round("rank", 6).alias("rank"))


@query("join_11", a.with_sql(
    """SELECT y.player, y.year, CAST(count(*) AS BIGINT) AS upto,
              CAST(count(*) FILTER (WHERE r.year < y.year) AS BIGINT) AS before
       FROM (SELECT DISTINCT player, year FROM player_rows) y
       JOIN player_rows r ON r.player = y.player AND r.year <= y.year GROUP BY 1, 2""", *ROWS))
def join_11(spark, sf_dir):
    """Matches of a player up to and before a year: a range join as a running sum over years."""
    rows = orient.to_player_rows(a.matches(spark, sf_dir), ["year"])
    per_year = rows.groupBy("player", "year").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(
        Window.partitionBy("player").orderBy("year").rowsBetween(Window.unboundedPreceding, 0))
    return per_year.select("player", "year", upto.alias("upto"), (upto - F.col("n")).alias("before"))


@query("win_3", a.with_sql(
    """SELECT player, year, n, CASE WHEN n > 3 THEN CASE WHEN zero > 0 THEN least(zero, 4) / 4.0 END
                               WHEN zero > 0 THEN zero / CAST(n AS DOUBLE) ELSE 0.5 END AS share
       FROM (SELECT y.player, y.year, CAST(count(*) FILTER (WHERE r.slot = 0 OR r.year < y.year) AS BIGINT) AS n,
                    CAST(count(*) FILTER (WHERE r.slot = 0) AS DOUBLE) AS zero
             FROM (SELECT DISTINCT player, year FROM player_rows) y JOIN player_rows r ON r.player = y.player
             GROUP BY 1, 2)""", *ROWS))
def win_3(spark, sf_dir):
    """Share of slot-0 matches among the first four."""
    rows = orient.to_player_rows(a.matches(spark, sf_dir), ["year"])
    return form.slot_share(rows).select("player", "year", "n", "share")


_FEATURE_FORM_SQL = """
form_rows AS (
  SELECT seq, player0, player1, label, "winnerRate" / 100 AS "Forme0", "looserRate" / 100 AS "Forme1",
         "winnerRate" AS "WinMean0", "looserRate" AS "WinMean1" FROM matches),
form_sides AS (
  SELECT seq, player0 AS player, {0} AS f, {1} AS w FROM form_rows
  UNION ALL SELECT seq, player1, "Forme1", "WinMean1" FROM form_rows),
form_last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player ORDER BY seq DESC) AS rn FROM form_sides)
              WHERE rn = 1)"""
_LAST_FORM_SELECT = """SELECT m.match_id, x.f AS "Forme0", y.f AS "Forme1", x.w AS "WinMean0", y.w AS "WinMean1"
FROM matches m LEFT JOIN form_last x ON x.player = m.player0 LEFT JOIN form_last y ON y.player = m.player1"""


def _form_rows(spark, sf_dir, matches=None):
    return (a.matches(spark, sf_dir) if matches is None else matches).select(
        "seq", "player0", "player1", "label", (F.col("winnerRate") / 100).alias("Forme0"),
        (F.col("looserRate") / 100).alias("Forme1"), F.col("winnerRate").alias("WinMean0"),
        F.col("looserRate").alias("WinMean1"))


@query("join_6", a.with_sql(
    _LAST_FORM_SELECT, a.SQL_MATCHES, _FEATURE_FORM_SQL.format('"Forme0"', '"WinMean0"')))
def join_6(spark, sf_dir):
    """Form of both sides from the last feature row of each player."""
    up = a.matches(spark, sf_dir).select("match_id", "player0", "player1")
    return form.last_form(up, _form_rows(spark, sf_dir)).drop("player0", "player1")


@query("join_6_compat", a.with_sql(
    _LAST_FORM_SELECT, a.SQL_MATCHES, _FEATURE_FORM_SQL.format(
        'CASE WHEN label = 0 THEN "Forme0" ELSE "Forme1" END',
        'CASE WHEN label = 0 THEN "WinMean0" ELSE "WinMean1" END')))
def join_6_compat(spark, sf_dir):
    """As above, with the historical slot rule."""
    up = a.matches(spark, sf_dir).select("match_id", "player0", "player1")
    return form.last_form(up, _form_rows(spark, sf_dir), compat=True).drop("player0", "player1")


@query("unp_1", a.with_sql(
    "SELECT match_id, player, opponent, slot, win FROM player_rows", *ROWS))
def unp_1(spark, sf_dir):
    """Matches as one row per player."""
    return orient.to_player_rows(a.matches(spark, sf_dir), ["match_id"])


@query("agg_1", a.with_sql(
    """SELECT player, CAST(sum(win) AS BIGINT) AS won, CAST(count(*) AS BIGINT) AS played,
              sum(win) / CAST(count(*) AS DOUBLE) AS rate FROM player_rows GROUP BY player""", *ROWS))
def agg_1(spark, sf_dir):
    """Win rate per player."""
    rows = orient.to_player_rows(a.matches(spark, sf_dir), [])
    counted = rows.groupBy("player").agg(F.sum("win").alias("won"), F.count("*").alias("played"))
    return counted.withColumn("rate", F.try_divide("won", "played"))


@query("agg_2", a.with_sql(
    """SELECT player, slot, round(avg(CASE WHEN win = 1 THEN opponent_ranking END), 6) AS mean_rank
       FROM player_rows GROUP BY player, slot""", *ROWS))
def agg_2(spark, sf_dir):
    """Mean ranking of beaten opponents per player and slot; unknown rankings are left out."""
    rows = a.player_rows(spark, sf_dir)
    beaten = F.when(F.col("win") == 1, F.col("opponent_ranking"))
    return rows.groupBy("player", "slot").agg(F.round(F.avg(beaten), 6).alias("mean_rank"))


@query("agg_4", a.with_sql(
    """SELECT player, seq, CAST(("doubleFautes" IS NULL)::INT + ("breakPointsSaved" IS NULL)::INT
              + ("breakPointsOpportunities" IS NULL)::INT + (aces IS NULL)::INT AS INTEGER) AS nulls FROM stats""",
    a.SQL_STATS))
def agg_4(spark, sf_dir):
    """Nulls per statistics row."""
    cols = ["doubleFautes", "breakPointsSaved", "breakPointsOpportunities", "aces"]
    return a.stats(spark, sf_dir).select("player", "seq", dataset.null_count(cols).alias("nulls"))


@query("agg_5", a.with_sql(
    "SELECT player0 AS player, year, CAST(count(*) AS BIGINT) AS n FROM matches GROUP BY 1, 2", a.SQL_MATCHES))
def agg_5(spark, sf_dir):
    """How often a player is in slot 0, per year."""
    return a.matches(spark, sf_dir).groupBy(F.col("player0").alias("player"), "year").agg(F.count("*").alias("n"))


@query("agg_7", a.with_sql(
    "SELECT player0 AS player FROM matches UNION SELECT player1 FROM matches", a.SQL_MATCHES))
def agg_7(spark, sf_dir):
    """Players over both slots."""
    return orient.players(a.matches(spark, sf_dir))


@query("set_3", a.with_sql(
    'SELECT "winnerName" AS player FROM matches UNION SELECT "looserName" FROM matches', a.SQL_MATCHES))
def set_3(spark, sf_dir):
    """Set union of winners and losers."""
    m = a.matches(spark, sf_dir)
    return m.select(F.col("winnerName").alias("player")).union(m.select("looserName")).distinct()


@query("agg_9", a.with_sql(
    """SELECT player, CAST(count(*) FILTER (WHERE "doubleFautes" <> 0 AND "doubleFautes" IS NOT NULL) AS BIGINT) AS n
       FROM stats GROUP BY player""", a.SQL_STATS))
def agg_9(spark, sf_dir):
    """Truthy values per player."""
    return a.stats(spark, sf_dir).groupBy("player").agg(
        F.count_if(F.coalesce(F.col("doubleFautes") != 0, F.lit(False))).alias("n"))


@query("lim_1", a.with_sql(
    """SELECT player, match_id, CAST(rank AS INTEGER) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY player ORDER BY seq) AS rank FROM player_rows) WHERE rank <= 3""",
    *ROWS))
def lim_1(spark, sf_dir):
    """First three matches of every player in landing order."""
    rows = orient.to_player_rows(a.matches(spark, sf_dir), ["match_id", "seq"])
    return rows_per_key_at_most(rows, ["player"], [F.col("seq")], 3).select("player", "match_id", "rank")


@query("lim_2_given", a.with_sql(
    "SELECT player, seq, ranking FROM stats WHERE ranking <= 100", a.SQL_STATS))
def lim_2_given(spark, sf_dir):
    """Statistics of players ranked in the top hundred."""
    return a.stats(spark, sf_dir).filter("ranking <= 100").select("player", "seq", "ranking")


@query("srt_1", a.with_sql(
    "SELECT player, surface, year, seq FROM stats ORDER BY player, surface, year DESC, seq", a.SQL_STATS))
def srt_1(spark, sf_dir):
    """Statistics in order of player and surface, newest year first."""
    return a.stats(spark, sf_dir).select("player", "surface", "year", "seq").orderBy(
        "player", "surface", F.desc("year"), "seq")
