"""Raw match data derived from the order tables, with the same text formats as landed files.

An order with lines of two or more suppliers is a match: the supplier with the highest line value wins, the one with the
lowest loses. Order status is the surface, order priority the round. Player statistics come from the lines of a supplier
per year, quarter and surface. Values are built from whole numbers, so both engines agree to the last digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.operators import clean, enrich
from courtside.operators.orient import to_player_rows
from courtside.plans.refresh import oriented_matches
from courtside.schemas import COUNT_COLUMNS, PERCENT_COLUMNS, PHASE_ORDINAL, THOUSANDS_COLUMNS


PLAYER_BASE = 10**12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hundredths(name: str) -> Column:
    """A non-negative amount with two decimals as a whole number."""
    return F.floor(F.col(name) * 100 + 0.5)


def _player(suppkey: Column) -> Column:
    """Text whose order is the order of the keys."""
    return F.concat(F.lit("p-"), (suppkey + PLAYER_BASE).cast("string"))


def _case(c: Column, mapping: dict[str, str | None]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out


# order priority -> round label, badge
PHASES = {
    "1-URGENT": "Finals", "2-HIGH": "Semi-Finals", "3-MEDIUM": "Quarterfinals", "4-NOT SPECIFIED": "Round of 16",
    "5-LOW": "Lucky Loser",
}
BADGES = {"1-URGENT": "finals", "2-HIGH": "grandslam", "3-MEDIUM": "1000", "4-NOT SPECIFIED": "500"}
SURFACES = {"O": "Outdoor Hard", "F": "Outdoor Clay", "P": "Indoor Grass"}


def _sql_case(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def matches_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """12 text columns and ``seq``."""
    # dealt by order once: the values of its suppliers, its ends and the order itself are then found where its lines are
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_orderkey").isNotNull()).select(
        "l_orderkey", "l_suppkey", _hundredths("l_extendedprice").alias("cents")).repartition("l_orderkey")
    value = lines.groupBy("l_orderkey", "l_suppkey").agg(F.sum("cents").alias("v"))
    ranked = F.struct("v", (-F.col("l_suppkey")).alias("s"))
    ends = value.groupBy("l_orderkey").agg(F.max(ranked).alias("hi"), F.min(ranked).alias("lo")).filter("hi.s <> lo.s")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("d"), "o_orderpriority")
    m = ends.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rate = F.expr("100 * hi.v div (hi.v + lo.v)")
    fmt = "yyyy.MM.dd"
    known = F.col("o_orderpriority") != "4-NOT SPECIFIED"
    surface = F.when(
        (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), F.lit("Indoor Carpet")
    ).otherwise(_case(F.col("o_orderstatus"), SURFACES))
    return m.select(
        F.concat(F.lit("open-"), F.pmod("o_custkey", F.lit(5)).cast("string")).alias("name"),
        _case(F.col("o_orderpriority"), PHASES).alias("phase"),
        surface.alias("surfaceInout"),
        _case(F.col("o_orderpriority"), BADGES).alias("typeTournament"),
        F.concat(F.date_format("d", fmt), F.lit(" - "), F.date_format(F.date_add("d", 6), fmt)).alias("date"),
        F.concat(rate.cast("string"), F.lit("%")).alias("winnerRate"),
        F.concat((100 - rate).cast("string"), F.lit("%")).alias("looserRate"),
        _player(-F.col("lo.s")).alias("looserName"),
        _player(-F.col("hi.s")).alias("winnerName"),
        F.when(known, F.concat(F.lit("0."), F.lpad(rate.cast("string"), 2, "0"))).otherwise(F.lit("NaN"))
        .alias("winnerRateSurface"),
        F.when(known, F.concat(F.lit("0."), F.lpad((100 - rate).cast("string"), 2, "0"))).otherwise(F.lit("NaN"))
        .alias("looserRateSurface"),
        F.concat(F.lit("https://example.test/h2h/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.col("o_orderkey").alias("seq"),
    )


_SQL_PLAYER = f"'p-' || CAST({{0}} + {PLAYER_BASE} AS VARCHAR)"

SQL_MATCHES_RAW = f"""
_value AS (
  SELECT l_orderkey, l_suppkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS v
  FROM lineitem GROUP BY l_orderkey, l_suppkey),
_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY v DESC, l_suppkey) AS top,
            row_number() OVER (PARTITION BY l_orderkey ORDER BY v, l_suppkey DESC) AS bottom
  FROM _value),
_ends AS (
  SELECT h.l_orderkey, h.l_suppkey AS hi_s, h.v AS hi_v, l.l_suppkey AS lo_s, l.v AS lo_v,
         100 * h.v // (h.v + l.v) AS rate
  FROM _ranked h JOIN _ranked l ON h.l_orderkey = l.l_orderkey AND h.top = 1 AND l.bottom = 1
  WHERE h.l_suppkey <> l.l_suppkey),
matches_raw AS (
  SELECT 'open-' || CAST(o_custkey % 5 AS VARCHAR) AS name,
         {_sql_case("o_orderpriority", PHASES)} AS phase,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'Indoor Carpet'
              ELSE {_sql_case("o_orderstatus", SURFACES)} END AS "surfaceInout",
         {_sql_case("o_orderpriority", BADGES)} AS "typeTournament",
         strftime(o_orderdate, '%Y.%m.%d') || ' - ' || strftime(o_orderdate + INTERVAL 6 DAY, '%Y.%m.%d') AS date,
         CAST(rate AS VARCHAR) || '%' AS "winnerRate",
         CAST(100 - rate AS VARCHAR) || '%' AS "looserRate",
         {_SQL_PLAYER.format("lo_s")} AS "looserName",
         {_SQL_PLAYER.format("hi_s")} AS "winnerName",
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN '0.' || lpad(CAST(rate AS VARCHAR), 2, '0')
              ELSE 'NaN' END AS "winnerRateSurface",
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN '0.' || lpad(CAST(100 - rate AS VARCHAR), 2, '0')
              ELSE 'NaN' END AS "looserRateSurface",
         'https://example.test/h2h/' || CAST(o_orderkey AS VARCHAR) AS url,
         o_orderkey AS seq
  FROM _ends JOIN orders ON l_orderkey = o_orderkey)"""


def stats_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """31 text columns, ``surface`` and ``seq``, one row per supplier, year, quarter and surface."""
    # joined before it is aggregated: lines of one order rarely share a supplier, so grouping them first saves nothing
    # and both flags go as one number, their unknown values as one of their own
    returned, status = F.col("l_returnflag"), F.col("l_linestatus")
    marks = F.when(returned.isNull(), 3).when(returned == "R", 1).when(returned == "A", 2).otherwise(0) + 4 * (
        F.when(status.isNull(), 2).when(status == "O", 1).otherwise(0))

    def flag(part: str, value: int, unknown: int) -> Column:
        return F.expr(f"IF({part} = {unknown}, NULL, CAST({part} = {value} AS INT))")

    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", F.lit(1).alias("n"), F.col("l_quantity").cast("long").alias("q"),
        _hundredths("l_discount").alias("d"), _hundredths("l_tax").alias("t"), marks.alias("marks"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("qt"),
        _case(F.col("o_orderstatus"), {"O": "hard", "F": "clay", "P": "grass"}).alias("s"))
    g = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_suppkey", "y", "qt", "s")
        .agg(*[F.sum(c).alias(c) for c in ("n", "q", "d", "t")], F.sum(flag("marks % 4", 1, 3)).alias("r"),
             F.sum(flag("marks % 4", 2, 3)).alias("a"), F.sum(flag("marks div 4", 1, 2)).alias("o"))
    )

    def pct(expr: str) -> Column:
        return F.concat(F.expr(f"CAST({expr} AS STRING)"), F.lit("%"))

    def txt(expr: str) -> Column:
        return F.expr(f"CAST({expr} AS STRING)")

    def dirty(expr: str) -> Column:
        return F.expr(f"CASE WHEN {expr} = 0 THEN '[]' ELSE CAST({expr} AS STRING) END")

    player = _player(F.col("l_suppkey"))
    week = F.concat(F.lit("1-"), (3 * F.col("qt") - 2).cast("string"))
    thousands = (
        "CASE WHEN {0} >= 1000 THEN concat(CAST({0} div 1000 AS STRING), ',', lpad(CAST({0} % 1000 AS STRING), 3, '0')) "
        "ELSE CAST({0} AS STRING) END")
    return g.select(
        player.alias("player"), txt("q").alias("aces"), dirty("r").alias("doubleFautes"),
        pct("100 * q div (50 * n)").alias("firstServe"), pct("100 * d div (10 * n)").alias("firstServePointsWon"),
        pct("100 * t div (8 * n)").alias("secondServePointsWon"), txt("n + r").alias("breakPointsFaced"),
        F.when(F.col("r") == 0, F.lit("[]")).otherwise(pct("100 * r div n")).alias("breakPointsSaved"),
        txt("n").alias("serviceGamePlayed"), pct("100 * a div n").alias("serviceGamesWon"),
        pct("100 * o div n").alias("totalServicePointsWon"),
        pct("(q + 7 * d) % 100").alias("firstServeReturnPointsWon"),
        pct("(q + 3 * t) % 100").alias("secondServeReturnPointsWon"),
        dirty("a").alias("breakPointsOpportunities"), pct("(q + d) % 100").alias("breakPointsConverted"),
        txt("n + a").alias("returnGamesPlayed"), pct("(q + t) % 100").alias("returnGamesWon"),
        pct("(d + t) % 100").alias("returnPointsWon"), pct("(q + r) % 100").alias("totalPointsWon"),
        F.concat(
            F.lit("https://example.test/en/players/"), player, F.lit("/player-stats?year="), txt("y"),
            F.lit("&surfaceType="), F.col("s")).alias("url"),
        txt("y").alias("year"), txt("150 + q % 80").alias("weight"),
        F.concat(F.lit("("), txt("170 + l_suppkey % 40"), F.lit("cm)")).alias("height"),
        F.concat(F.lit("("), txt("1970 + l_suppkey % 25"), F.lit(".05.22)")).alias("age"),
        txt("1990 + l_suppkey % 25").alias("startCareer"),
        F.expr(
            "CASE t % 3 WHEN 0 THEN ' Right-Handed, Two-Handed Backhand ' "
            "WHEN 1 THEN ' Left-Handed, One-Handed Backhand ' ELSE 'Eric Lambert' END").alias("plays"),
        txt("1 + (q + 13 * d) % 300").alias("ranking"),
        F.expr(thousands.format("(10 * q + d)")).alias("points"), txt("n + o").alias("tournCell"),
        F.expr(thousands.format("(7 * q + t)")).alias("pointsDropping"), txt("r + o").alias("nextBest"),
        F.concat(
            F.lit("Players/"), txt("y"), F.lit("/"), week, F.lit("/"), F.col("s"), F.lit("/"), player, F.lit(".csv")
        ).alias("seq"),
        F.col("s").alias("surface"),
    )


def _pct(e: str) -> str:
    return f"CAST({e} AS VARCHAR) || '%'"


def _txt(e: str) -> str:
    return f"CAST({e} AS VARCHAR)"


def _dirty(e: str) -> str:
    return f"CASE WHEN {e} = 0 THEN '[]' ELSE CAST({e} AS VARCHAR) END"


def _thousands(e: str) -> str:
    return (
        f"CASE WHEN {e} >= 1000 THEN CAST({e} // 1000 AS VARCHAR) || ',' || lpad(CAST({e} % 1000 AS VARCHAR), 3, '0') "
        f"ELSE CAST({e} AS VARCHAR) END")


_P = _SQL_PLAYER.format("l_suppkey")
SQL_STATS_RAW = f"""
_lines AS (
  SELECT l_suppkey, year(o_orderdate) AS y, quarter(o_orderdate) AS qt,
         CASE o_orderstatus WHEN 'O' THEN 'hard' WHEN 'F' THEN 'clay' WHEN 'P' THEN 'grass' END AS s,
         count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS d,
         CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS t,
         count(*) FILTER (WHERE l_returnflag = 'R') AS r, count(*) FILTER (WHERE l_returnflag = 'A') AS a,
         count(*) FILTER (WHERE l_linestatus = 'O') AS o
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4),
stats_raw AS (
  SELECT {_P} AS player, {_txt("q")} AS aces, {_dirty("r")} AS "doubleFautes",
         {_pct("100 * q // (50 * n)")} AS "firstServe", {_pct("100 * d // (10 * n)")} AS "firstServePointsWon",
         {_pct("100 * t // (8 * n)")} AS "secondServePointsWon", {_txt("n + r")} AS "breakPointsFaced",
         CASE WHEN r = 0 THEN '[]' ELSE {_pct("100 * r // n")} END AS "breakPointsSaved",
         {_txt("n")} AS "serviceGamePlayed", {_pct("100 * a // n")} AS "serviceGamesWon",
         {_pct("100 * o // n")} AS "totalServicePointsWon",
         {_pct("(q + 7 * d) % 100")} AS "firstServeReturnPointsWon",
         {_pct("(q + 3 * t) % 100")} AS "secondServeReturnPointsWon",
         {_dirty("a")} AS "breakPointsOpportunities", {_pct("(q + d) % 100")} AS "breakPointsConverted",
         {_txt("n + a")} AS "returnGamesPlayed", {_pct("(q + t) % 100")} AS "returnGamesWon",
         {_pct("(d + t) % 100")} AS "returnPointsWon", {_pct("(q + r) % 100")} AS "totalPointsWon",
         'https://example.test/en/players/' || {_P} || '/player-stats?year=' || {_txt("y")} || '&surfaceType=' || s
           AS url,
         {_txt("y")} AS year, {_txt("150 + q % 80")} AS weight,
         '(' || {_txt("170 + l_suppkey % 40")} || 'cm)' AS height,
         '(' || {_txt("1970 + l_suppkey % 25")} || '.05.22)' AS age,
         {_txt("1990 + l_suppkey % 25")} AS "startCareer",
         CASE t % 3 WHEN 0 THEN ' Right-Handed, Two-Handed Backhand '
              WHEN 1 THEN ' Left-Handed, One-Handed Backhand ' ELSE 'Eric Lambert' END AS plays,
         {_txt("1 + (q + 13 * d) % 300")} AS ranking, {_thousands("(10 * q + d)")} AS points,
         {_txt("n + o")} AS "tournCell", {_thousands("(7 * q + t)")} AS "pointsDropping",
         {_txt("r + o")} AS "nextBest",
         'Players/' || {_txt("y")} || '/1-' || {_txt("3 * qt - 2")} || '/' || s || '/' || {_P} || '.csv' AS seq
  FROM _lines)"""


_PHASE_SQL = {v: str(PHASE_ORDINAL[v]) for v in PHASES.values() if v in PHASE_ORDINAL}
_RATE_SURFACE = """CASE WHEN "{0}" <> 'NaN' THEN CAST("{0}" AS DOUBLE) END AS "{0}\""""
_DIGITS = """CAST(regexp_replace("{0}", '[^0-9]+', '', 'g') AS DOUBLE) AS "{0}\""""

# clean, oriented matches
SQL_MATCHES = f"""{SQL_MATCHES_RAW},
matches AS (
  SELECT sha256(concat_ws('|', url, date, phase, "winnerName", "looserName")) AS match_id, seq, name, url, date,
         "surfaceInout", "winnerName", "looserName",
         CAST({_sql_case("phase", _PHASE_SQL)} AS INTEGER) AS phase,
         CASE WHEN "typeTournament" IS NULL THEN 250.0 WHEN "typeTournament" IN ('finals', 'grandslam') THEN 2000.0
              ELSE CAST("typeTournament" AS DOUBLE) END AS "typeTournament",
         CAST(split_part(date, '.', 1) AS INTEGER) AS year,
         CAST(strptime(split_part(date, ' - ', 1), '%Y.%m.%d') AS DATE) AS start_date,
         CAST(strptime(split_part(date, ' - ', 2), '%Y.%m.%d') AS DATE) AS end_date,
         CAST(date_diff('day', strptime(split_part(date, ' - ', 1), '%Y.%m.%d'),
                        strptime(split_part(date, ' - ', 2), '%Y.%m.%d')) AS INTEGER) AS duree,
         {_DIGITS.format("winnerRate")}, {_DIGITS.format("looserRate")},
         {_RATE_SURFACE.format("winnerRateSurface")}, {_RATE_SURFACE.format("looserRateSurface")},
         split_part("surfaceInout", ' ', 1) AS "inOut", split_part("surfaceInout", ' ', 2) AS surface,
         least("winnerName", "looserName") AS player0, greatest("winnerName", "looserName") AS player1,
         CAST(CASE WHEN "winnerName" < "looserName" THEN 0 ELSE 1 END AS INTEGER) AS label,
         CASE split_part("surfaceInout", ' ', 2) WHEN 'Hard' THEN 'hard' WHEN 'Clay' THEN 'clay' ELSE 'grass' END
           AS stats_surface
  FROM matches_raw)"""


def _sql_percent(c: str) -> str:
    return f"""TRY_CAST(rtrim(nullif("{c}", '[]'), '%') AS DOUBLE) / 100.0 AS "{c}\""""


def _sql_count(c: str) -> str:
    return f"""CAST(nullif("{c}", '[]') AS INTEGER) AS "{c}\""""


def _sql_thousands(c: str) -> str:
    return f"""CAST(replace("{c}", ',', '') AS DOUBLE) AS "{c}\""""


# cleaned statistics
SQL_STATS = f"""{SQL_STATS_RAW},
stats AS (
  SELECT player, CAST(year AS INTEGER) AS year, split_part(url, '=', 3) AS surface, seq, url, weight, "startCareer", age,
         {", ".join(map(_sql_percent, PERCENT_COLUMNS))}, {", ".join(map(_sql_count, COUNT_COLUMNS))},
         {", ".join(map(_sql_thousands, THOUSANDS_COLUMNS))},
         CAST(regexp_extract(height, '([0-9]+)', 1) AS INTEGER) AS height,
         CASE WHEN trim(plays) = 'Eric Lambert' THEN 'Right-Handed' ELSE split_part(trim(plays), ',', 1) END AS plays,
         CAST(ranking AS INTEGER) AS ranking, CAST("tournCell" AS INTEGER) AS "tournCell",
         CAST("nextBest" AS DOUBLE) AS "nextBest"
  FROM stats_raw)"""

# last statistics row per player, year and surface
SQL_STATS_LAST = """
stats_last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, year, surface ORDER BY seq DESC) AS _rn FROM stats)
  WHERE _rn = 1)"""


def sql_attached(columns: list[str]) -> str:
    """Matches with the last statistics of both sides."""
    sides = ", ".join(f'a{s}."{c}" AS "{c}{s}"' for s in (0, 1) for c in columns)
    joins = " ".join(
        f"LEFT JOIN stats_last a{s} ON a{s}.player = m.player{s} AND a{s}.year = m.year "
        f"AND a{s}.surface = m.stats_surface" for s in (0, 1))
    return f"attached AS (SELECT m.*, {sides} FROM matches m {joins})"


# one row per match and player
SQL_PLAYER_ROWS = """
player_rows AS (
  SELECT match_id, seq, year, start_date, surface, player0 AS player, player1 AS opponent, 0 AS slot,
         CASE WHEN label = 0 THEN 1 ELSE 0 END AS win, ranking1 AS opponent_ranking FROM attached
  UNION ALL
  SELECT match_id, seq, year, start_date, surface, player1, player0, 1,
         CASE WHEN label = 1 THEN 1 ELSE 0 END, ranking0 FROM attached)"""


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, oriented matches."""
    return oriented_matches(matches_raw(spark, sf_dir))


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_stats(stats_raw(spark, sf_dir))


def attached(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    return enrich.attach_stats(matches(spark, sf_dir), stats(spark, sf_dir), columns)


def player_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attached(spark, sf_dir, ["ranking"])
    return to_player_rows(rows, ["match_id", "seq", "year", "start_date", "surface"], ["ranking"])


def with_sql(query: str, *ctes: str) -> str:
    """A statement with the given common table expressions in front."""
    return "WITH " + ",".join(ctes) + "\n" + query if ctes else query
