"""Projection, filter, encoding, scaling and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtside.functions import rates
from courtside.operators import clean, dataset, decide, enrich, form, h2h, orient
from courtside.operators.skew import rows_per_key_at_most
from courtside.plans import refresh
from courtside.schemas import FEATURES, HANDS, IN_OUT, LABEL, SIDE_FEATURES, SURFACES
from courtside.workload import analogue as a
from courtside.workload.registry import query

M = (a.SQL_MATCHES,)
S = (a.SQL_STATS,)
INPUTS = [c for c in FEATURES if c != LABEL]


def attached_sql(*columns: str) -> tuple[str, ...]:
    return a.SQL_MATCHES, a.SQL_STATS, a.SQL_STATS_LAST, a.sql_attached(list(columns))


# --- projections ---------------------------------------------------------------------------------------------------------


@query("prj_1", a.with_sql(
    "SELECT name, phase, year, duree, surface, url FROM matches", *M))
def prj_1(spark, sf_dir):
    """Derived columns between the given ones."""
    return a.matches(spark, sf_dir).select("name", "phase", "year", "duree", "surface", "url")


_PRJ2 = ["player", "aces", "points", "ranking", "surface", "year"]


@query("prj_2", a.with_sql(
    "SELECT " + ", ".join(f'"{c}" AS "{c}0"' for c in _PRJ2) + " FROM stats", *S))
def prj_2(spark, sf_dir):
    """Statistics columns with a side suffix, by name."""
    return enrich.suffixed(a.stats(spark, sf_dir), 0, _PRJ2)


_DROPPED = ["url", "weight", "startCareer", "age"]


@query("prj_3", a.with_sql(
    "SELECT * EXCLUDE (" + ", ".join(f'"{c}"' for c in _DROPPED) + ") FROM stats", *S))
def prj_3(spark, sf_dir):
    """All columns but a list."""
    return a.stats(spark, sf_dir).drop(*_DROPPED)


_HOTS_SQL = ", ".join(
    [f"""CAST("inOut" = '{v}' AS INTEGER)::DOUBLE AS "{v}\"""" for v in IN_OUT]
    + [f"""CAST(surface = '{v}' AS INTEGER)::DOUBLE AS "{v}\"""" for v in SURFACES])


@query("prj_4", a.with_sql(
    """SELECT match_id, "typeTournament", CAST(label AS INTEGER) AS label, 0.0::DOUBLE AS "Carpet" FROM matches""", *M))
def prj_4(spark, sf_dir):
    """The column list of another table; a column it has and this one lacks is 0."""
    return dataset.conform(a.matches(spark, sf_dir), ["match_id", "typeTournament", "label", "Carpet"])


@query("prj_6", a.with_sql(f"SELECT match_id, {_HOTS_SQL} FROM matches", *M))
def prj_6(spark, sf_dir):
    """In/out and surface flags; a value that does not occur still has its column."""
    m = a.matches(spark, sf_dir)
    return m.select(
        "match_id", *rates.one_hot(F.col("inOut"), IN_OUT), *rates.one_hot(F.col("surface"), SURFACES))


@query("piv_1", a.with_sql(
    """SELECT "surfaceInout", CAST(count(*) AS BIGINT) AS n, """ + ", ".join(
        f"""CAST(count(*) FILTER (WHERE surface = '{v}') AS DOUBLE) AS "{v}\"""" for v in SURFACES)
    + """ FROM matches GROUP BY 1""", *M))
def piv_1(spark, sf_dir):
    """Sums of the surface flags per in/out and surface text."""
    m = a.matches(spark, sf_dir).select("surfaceInout", *rates.one_hot(F.col("surface"), SURFACES))
    return m.groupBy("surfaceInout").agg(F.count("*").alias("n"), *[F.sum(v).alias(v) for v in SURFACES])


@query("piv_2", a.with_sql(
    "SELECT match_id, " + ", ".join(
        f"""CASE WHEN plays{s} = '{h}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "{h}{suffix}\""""
        for s, suffix in ((0, ""), (1, ".1")) for h in HANDS) + " FROM attached", *attached_sql("plays")))
def piv_2(spark, sf_dir):
    """Hand flags of both sides; an unknown hand has none."""
    m = a.attached(spark, sf_dir, ["plays"])
    return m.select(
        "match_id", *rates.one_hot(F.col("plays0"), HANDS), *rates.one_hot(F.col("plays1"), HANDS, ".1"))


@query("piv_3", a.with_sql(
    """SELECT match_id, CASE WHEN "inOut" = 'Indoor' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "Indoor",
              CASE WHEN "inOut" = 'Indoor' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS "Outdoor",
              CASE WHEN surface = 'Carpet' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "Carpet",
              CASE WHEN surface = 'Clay' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "Clay",
              CASE WHEN surface = 'Grass' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "Grass",
              CASE WHEN surface IN ('Carpet', 'Clay', 'Grass') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS "Hard",
              """ + ", ".join(
        f"""CASE WHEN plays{k} = 'Left-Handed' THEN {yes} WHEN plays{k} IS NOT NULL THEN {no} END AS "{hand}{suffix}\""""
        for k, suffix in ((0, ""), (1, ".1"))
        for hand, yes, no in (("Left-Handed", "1.0::DOUBLE", "0.0::DOUBLE"), ("Right-Handed", "0.0::DOUBLE", "1.0::DOUBLE"))) + " FROM attached",
    *attached_sql("plays")))
def piv_3(spark, sf_dir):
    """Flags with an else branch, as for a single upcoming match."""
    m = a.attached(spark, sf_dir, ["plays"])
    return m.select(
        "match_id", *rates.in_out_flags(F.col("inOut")), *rates.surface_flags(F.col("surface")),
        *rates.hand_flags(F.col("plays0")), *rates.hand_flags(F.col("plays1"), ".1"))


@query("prj_7", a.with_sql("SELECT match_id, 0.0::DOUBLE AS label FROM matches", *M))
def prj_7(spark, sf_dir):
    """Placeholder label of rows to be scored."""
    return dataset.conform(a.matches(spark, sf_dir).select("match_id"), ["match_id", "label"])


@query("prj_8", a.with_sql(
    """SELECT match_id, CAST(n AS INTEGER) AS n0 FROM (
         SELECT match_id, slot, count(*) OVER (PARTITION BY player ORDER BY start_date, match_id
                ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS n FROM player_rows) WHERE slot = 0""",
    *attached_sql("ranking"), a.SQL_PLAYER_ROWS))
def prj_8(spark, sf_dir):
    """A computed column put next to its match by key, not by position."""
    m = a.matches(spark, sf_dir)
    rows = form.previous_rows(
        orient.to_player_rows(m, ["match_id", "start_date"]), ["player"], "start_date", "match_id", ["win"], 3)
    n = rows.filter("slot = 0").select("match_id", F.size("previous").alias("n0"))
    return m.select("match_id").join(n, "match_id")


# --- filters -------------------------------------------------------------------------------------------------------------


@query("flt_2", a.with_sql(
    "SELECT match_id FROM attached WHERE ranking0 IS NOT NULL AND ranking1 IS NOT NULL", *attached_sql("ranking")))
def flt_2(spark, sf_dir):
    """Rows with both keys."""
    m = a.attached(spark, sf_dir, ["ranking"])
    return clean.require(m, "ranking0", "ranking1").select("match_id")


@query("flt_3", a.with_sql(
    """SELECT match_id, phase, "winnerRateSurface" FROM matches
       WHERE phase IS NOT NULL AND "winnerRateSurface" IS NOT NULL""", *M))
def flt_3(spark, sf_dir):
    """Complete rows."""
    return clean.require(a.matches(spark, sf_dir).select("match_id", "phase", "winnerRateSurface"))


@query("flt_4", a.with_sql(
    "SELECT match_id, start_date FROM matches WHERE start_date > DATE '1998-01-01'", *M))
def flt_4(spark, sf_dir):
    """Matches after a day."""
    return a.matches(spark, sf_dir).filter(F.col("start_date") > F.lit("1998-01-01").cast("date")).select(
        "match_id", "start_date")


@query("flt_5", a.with_sql("SELECT seq, phase FROM matches WHERE phase IS NOT NULL", *M))
def flt_5(spark, sf_dir):
    """Rows whose round is a number."""
    return dataset.numeric_phase(a.matches(spark, sf_dir)).select("seq", "phase")


@query("flt_9", a.with_sql(
    """SELECT match_id, "winnerRate" / 20.0 AS odd0, "looserRate" / 20.0 AS odd1, "winnerRate" / 100.0 AS prediction
       FROM matches WHERE "winnerRate" / 20.0 > 1.2 AND "winnerRate" / 20.0 < 3.5 AND "looserRate" / 20.0 > 1.2
         AND "looserRate" / 20.0 < 3.5 AND ("winnerRate" / 100.0 < 0.4 OR "winnerRate" / 100.0 > 0.6)""", *M))
def flt_9(spark, sf_dir):
    """Odds inside the band and a confident probability."""
    return decide.playable(_priced(spark, sf_dir)).select("match_id", "odd0", "odd1", "prediction")


def _priced(spark, sf_dir):
    return a.matches(spark, sf_dir).select(
        "match_id", "player0", "player1", F.col("date").alias("start"), (F.col("winnerRate") / 20).alias("odd0"),
        (F.col("looserRate") / 20).alias("odd1"), (F.col("winnerRate") / 100).alias("prediction"))


@query("flt_10", a.with_sql(
    """SELECT match_id, CASE WHEN "winnerRate" / 100.0 > 0.6 THEN 'high' ELSE 'low' END AS side FROM matches
       WHERE "winnerRate" / 100.0 > 0.6 OR "winnerRate" / 100.0 < 0.4""", *M))
def flt_10(spark, sf_dir):
    """Confident predictions by side."""
    p = F.col("prediction")
    return _priced(spark, sf_dir).filter(decide.is_confident(p)).select(
        "match_id", F.when(p > decide.CONFIDENCE[1], F.lit("high")).otherwise(F.lit("low")).alias("side"))


# --- head-to-head rates --------------------------------------------------------------------------------------------------

_RATES_SQL = """
rates AS (
  SELECT match_id, ranking0, ranking1,
         CASE WHEN label = 0 THEN "winnerRate" ELSE "looserRate" END / 100 AS f0,
         CASE WHEN label = 0 THEN "looserRate" ELSE "winnerRate" END / 100 AS f1,
         CASE WHEN label = 0 THEN "winnerRateSurface" ELSE "looserRateSurface" END AS s0,
         CASE WHEN label = 0 THEN "looserRateSurface" ELSE "winnerRateSurface" END AS s1
  FROM attached),
gaps AS (
  SELECT *, CASE WHEN r1 < r0 THEN least((1 - b) / 2, (1 + b) / 2) ELSE greatest((1 - b) / 2, (1 + b) / 2) END AS g0,
         CASE WHEN r1 < r0 THEN greatest((1 - b) / 2, (1 + b) / 2) ELSE least((1 - b) / 2, (1 + b) / 2) END AS g1
  FROM (SELECT *, abs(r0 - r1) / 300.0::DOUBLE AS b FROM (
    SELECT *, CAST(coalesce(ranking0, 300) AS DOUBLE) AS r0, CAST(coalesce(ranking1, 300) AS DOUBLE) AS r1
    FROM rates)))"""
_RATED = (*attached_sql("ranking"), _RATES_SQL)


def _rated(spark, sf_dir):
    return h2h.h2h_rates(a.attached(spark, sf_dir, ["ranking"]))


_RATE_NAMES = ["RateFace2Face0", "RateFace2Face1", "RateFace2FaceSurface0", "RateFace2FaceSurface1"]


@query("f_7", a.with_sql(
    """SELECT match_id, f0 AS "RateFace2Face0", f1 AS "RateFace2Face1", s0 AS "RateFace2FaceSurface0",
              s1 AS "RateFace2FaceSurface1" FROM rates""", *_RATED))
def f_7(spark, sf_dir):
    """Winner and loser rates on sides 0 and 1."""
    return _rated(spark, sf_dir).select("match_id", *_RATE_NAMES)


@query("f_7_compat", a.with_sql(
    """SELECT match_id, "winnerRate" / 100 AS "RateFace2Face0", "looserRate" / 100 AS "RateFace2Face1" FROM matches""", *M))
def f_7_compat(spark, sf_dir):
    """The same with the winner always on side 0."""
    return h2h.h2h_rates(a.matches(spark, sf_dir), compat=True).select("match_id", *_RATE_NAMES[:2])


@query("f_8", a.with_sql("SELECT match_id, g0 AS rate0, g1 AS rate1 FROM gaps", *_RATED))
def f_8(spark, sf_dir):
    """Rates from the ranking gap."""
    m = a.attached(spark, sf_dir, ["ranking"])
    gap = rates.rank_gap(F.col("ranking0"), F.col("ranking1"))
    return m.withColumn("gap", gap).select("match_id", "gap.rate0", "gap.rate1")


_IMPUTED_SQL = """
imputed AS (
  SELECT match_id, CASE WHEN f0 IS NULL OR f1 IS NULL THEN g0 ELSE f0 END AS f0,
         CASE WHEN f0 IS NULL OR f1 IS NULL THEN g1 ELSE f1 END AS f1,
         CASE WHEN s0 IS NULL OR s1 IS NULL THEN g0 ELSE s0 END AS s0,
         CASE WHEN s0 IS NULL OR s1 IS NULL THEN g1 ELSE s1 END AS s1 FROM gaps)"""


@query("f_9", a.with_sql(
    """SELECT match_id, f0 AS "RateFace2Face0", f1 AS "RateFace2Face1", s0 AS "RateFace2FaceSurface0",
              s1 AS "RateFace2FaceSurface1" FROM imputed""", *_RATED, _IMPUTED_SQL))
def f_9(spark, sf_dir):
    """Missing rates from the ranking gap."""
    return h2h.impute_h2h(_rated(spark, sf_dir)).select("match_id", *_RATE_NAMES)


@query("f_10", a.with_sql(
    """SELECT match_id, CAST(coalesce(ranking0, 300) AS INTEGER) AS ranking0,
              CAST(coalesce(ranking1, 300) AS INTEGER) AS ranking1,
              coalesce("winnerRateSurface", 50.0) AS "winnerRateSurface" FROM attached""", *attached_sql("ranking")))
def f_10(spark, sf_dir):
    """Constants for missing values."""
    m = a.attached(spark, sf_dir, ["ranking"]).select("match_id", "ranking0", "ranking1", "winnerRateSurface")
    return dataset.impute(m, {"ranking0": 300, "ranking1": 300, "winnerRateSurface": 50.0})


_SUM = "CASE WHEN abs({0} + {1} - 1) <= 1e-9 THEN {2} WHEN abs({0} + {1} - 100) <= 1e-9 THEN {2} / 100 ELSE 0.5 END"


@query("f_12", a.with_sql(
    "SELECT match_id, " + _SUM.format("f0", "f1", "f0") + ' AS "RateFace2Face0", ' + _SUM.format("f0", "f1", "f1")
    + ' AS "RateFace2Face1", ' + _SUM.format("s0", "s1", "s0") + ' AS "RateFace2FaceSurface0", '
    + _SUM.format("s0", "s1", "s1") + ' AS "RateFace2FaceSurface1" FROM imputed', *_RATED, _IMPUTED_SQL))
def f_12(spark, sf_dir):
    """Rate pairs that sum to one."""
    return h2h.normalise_h2h(h2h.impute_h2h(_rated(spark, sf_dir))).select("match_id", *_RATE_NAMES)


@query("f_13", a.with_sql(
    """SELECT match_id, "winnerRate" / 100 AS "winnerRate", "looserRate" / 100 AS "looserRate" FROM matches""", *M))
def f_13(spark, sf_dir):
    """Rates in one unit, the fraction."""
    return clean.clean_matches(
        clean.with_match_id(a.matches_raw(spark, sf_dir)), digits_only=False).select(
        "match_id", "winnerRate", "looserRate")


# --- other features ------------------------------------------------------------------------------------------------------


@query("f_2", a.with_sql(
    """SELECT match_id, player0, player1,
              CASE WHEN label = 0 THEN "winnerRate" ELSE "looserRate" END / 20.0 AS odd0,
              CASE WHEN label = 0 THEN "looserRate" ELSE "winnerRate" END / 20.0 AS odd1 FROM matches""", *M))
def f_2(spark, sf_dir):
    """Offers with sides in name order; the odds move along."""
    offers = a.matches(spark, sf_dir).select(
        "match_id", F.col("winnerName").alias("joueur0"), F.col("looserName").alias("joueur1"),
        (F.col("winnerRate") / 20).alias("oddJoueur0"), (F.col("looserRate") / 20).alias("oddJoueur1"))
    return orient.orient_offer(offers).select("match_id", "player0", "player1", "odd0", "odd1")


_MENTAL = ["breakPointsFaced", "breakPointsConverted", "returnGamesWon", "serviceGamesWon"]


@query("f_4", a.with_sql(
    "SELECT match_id, " + ", ".join(
        " + ".join(f'"{c}{s}"' for c in _MENTAL) + f" AS mental{s}" for s in (0, 1)) + " FROM attached",
    *attached_sql(*_MENTAL)))
def f_4(spark, sf_dir):
    """Mental strength of both sides."""
    return dataset.with_mental(a.attached(spark, sf_dir, _MENTAL)).select("match_id", "mental0", "mental1")


_SERVE = ["aces", "doubleFautes", "serviceGamePlayed"]


@query("f_11", a.with_sql(
    "SELECT match_id, " + ", ".join(
        f'aces{s} / ("serviceGamePlayed{s}" * 4.0) AS aces{s}, '
        f'"doubleFautes{s}" / ("serviceGamePlayed{s}" * 3.5) AS "doubleFautes{s}"' for s in (0, 1))
    + " FROM attached", *attached_sql(*_SERVE)))
def f_11(spark, sf_dir):
    """Aces and double faults per service point."""
    m = dataset.with_serve_rates(a.attached(spark, sf_dir, _SERVE))
    return m.select("match_id", *[f"{c}{s}" for c in ("aces", "doubleFautes") for s in (0, 1)])


@query("f_17", a.with_sql(
    """SELECT player0 || player1 || date AS complete_id, player0 AS player_0_name, player1 AS player_1_name,
              CASE WHEN 1 - "winnerRate" / 100.0 > "winnerRate" / 100.0 THEN player0 ELSE player1 END AS winner_name,
              1 - "winnerRate" / 100.0 AS probability_score_player_0, "winnerRate" / 100.0 AS probability_score_player_1,
              "winnerRate" / 20.0 AS odd_player_0, "looserRate" / 20.0 AS odd_player_1, true AS is_visible_to_users,
              date AS match_date FROM matches""", *M))
def f_17(spark, sf_dir):
    """Prediction rows with the likelier player as the winner."""
    return decide.decide(_priced(spark, sf_dir))


# the full feature row in SQL
_ALL_SIDE = sorted({*SIDE_FEATURES, "plays", *_MENTAL})


def _feature_sql() -> str:
    def side(c: str, s: int) -> str:
        if c == "aces":
            return f'aces{s} / ("serviceGamePlayed{s}" * 4.0::DOUBLE) AS aces{s}'
        if c == "doubleFautes":
            return f'"doubleFautes{s}" / ("serviceGamePlayed{s}" * 3.5::DOUBLE) AS "doubleFautes{s}"'
        if c == "age":
            return f"CAST(year - CAST(regexp_extract(age{s}, '([0-9]{{4}})', 1) AS INTEGER) AS DOUBLE) AS age{s}"
        if c == "ranking":
            return f"CAST(coalesce(a.ranking{s}, 300) AS DOUBLE) AS ranking{s}"
        return f'CAST("{c}{s}" AS DOUBLE) AS "{c}{s}"'

    def flag(test: str, name: str) -> str:
        return f'CASE WHEN {test} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "{name}"'

    columns = ["a.match_id", '"typeTournament"', "CAST(label AS DOUBLE) AS label"]
    columns += [side(c, s) for s in (0, 1) for c in SIDE_FEATURES]
    columns += [" + ".join(f'"{c}{s}"' for c in _MENTAL) + f" AS mental{s}" for s in (0, 1)]
    columns += [flag(f"\"inOut\" = '{v}'", v) for v in IN_OUT] + [flag(f"surface = '{v}'", v) for v in SURFACES]
    columns += [flag(f"plays{s} = '{h}'", h + x) for s, x in ((0, ""), (1, ".1")) for h in HANDS]
    for kind, x in (("", "f"), ("Surface", "s")):
        columns += [f'CAST({_SUM.format(x + "0", x + "1", x + str(s))} AS DOUBLE) AS "RateFace2Face{kind}{s}"'
                    for s in (0, 1)]
    columns += [f'round(coalesce(forme{s}, 0.5), 6) AS "Forme{s}"' for s in (0, 1)]
    columns += [f'round(coalesce(win_mean{s}, 200.0), 6) AS "WinMean{s}"' for s in (0, 1)]
    return ("SELECT " + ", ".join(columns)
            + " FROM attached a JOIN imputed USING (match_id) JOIN formed_sides USING (match_id)")


_FORMED_SQL = """
formed AS (
  SELECT match_id, slot, avg(CAST(win AS DOUBLE)) OVER w AS forme,
         avg(CASE WHEN win = 1 THEN CAST(opponent_ranking AS DOUBLE) END) OVER w AS win_mean
  FROM player_rows
  WINDOW w AS (PARTITION BY player ORDER BY start_date, match_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
formed_sides AS (
  SELECT match_id, max(forme) FILTER (WHERE slot = 0) AS forme0, max(forme) FILTER (WHERE slot = 1) AS forme1,
         max(win_mean) FILTER (WHERE slot = 0) AS win_mean0, max(win_mean) FILTER (WHERE slot = 1) AS win_mean1
  FROM formed GROUP BY match_id)"""
FEATURE_CTES = (*attached_sql(*_ALL_SIDE), _RATES_SQL, _IMPUTED_SQL, a.SQL_PLAYER_ROWS, _FORMED_SQL)
FEATURE_SQL = _feature_sql()


def feature_rows(spark, sf_dir, keep=("match_id",)):
    rows = refresh.feature_rows(a.matches_raw(spark, sf_dir), a.stats_raw(spark, sf_dir), keep)
    rounded = {c: F.round(c, 6) for c in ("Forme0", "Forme1", "WinMean0", "WinMean1")}
    return rows.withColumns(rounded)


@query("prj_5", a.with_sql(FEATURE_SQL, *FEATURE_CTES))
def prj_5(spark, sf_dir):
    """The 72 feature columns of every match."""
    return feature_rows(spark, sf_dir)


_TRAIN_CTE = f"""
features AS ({FEATURE_SQL}),
complete AS (SELECT * FROM features WHERE {" AND ".join(f'"{c}" IS NOT NULL' for c in FEATURES)})"""


@query("set_1", a.with_sql(
    """SELECT f.match_id, f."RateFace2Face0", f."WinMean0" FROM complete f JOIN matches m USING (match_id)
       WHERE m.phase IS NOT NULL""", *FEATURE_CTES, _TRAIN_CTE))
def set_1(spark, sf_dir):
    """History and season together, complete rows of known rounds."""
    rows = feature_rows(spark, sf_dir, ("match_id", "year", "phase"))
    both = dataset.training_set(rows.filter("year < 2000"), rows.filter("year >= 2000"))
    return both.select("match_id", "RateFace2Face0", "WinMean0")


@query("agg_6", a.with_sql(
    "SELECT " + ", ".join(
        f'CAST(min("{c}") AS DOUBLE) AS "min_{c}", CAST(max("{c}") AS DOUBLE) AS "max_{c}"'
        for c in ("aces", "points", "ranking", "height")) + " FROM stats", *S))
def agg_6(spark, sf_dir):
    """Bounds of columns in one pass."""
    return dataset.fit_minmax(a.stats(spark, sf_dir), ["aces", "points", "ranking", "height"])


@query("agg_8", a.with_sql(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - count("{c}") AS BIGINT) AS nulls
            FROM stats""" for c in ("player", "doubleFautes", "breakPointsSaved", "points")), *S))
def agg_8(spark, sf_dir):
    """Row and null counts per column."""
    cols = ["player", "doubleFautes", "breakPointsSaved", "points"]
    return dataset.profile(a.stats(spark, sf_dir).select(*cols))


_SCALED = ["aces", "points", "ranking", "height", "constant"]


@query("ml_1", a.with_sql(
    "SELECT seq, " + ", ".join(
        f'(CAST("{c}" AS DOUBLE) - min("{c}") OVER ()) / (max("{c}") OVER () - min("{c}") OVER ()) AS "{c}"'
        for c in _SCALED[:-1]) + ", 0.0::DOUBLE AS constant FROM stats", *S))
def ml_1(spark, sf_dir):
    """Min-max scaling; a constant column becomes 0."""
    s = a.stats(spark, sf_dir).withColumn("constant", F.lit(5.0)).select("seq", *_SCALED)
    return dataset.apply_minmax(s, dataset.fit_minmax(s, _SCALED), _SCALED)


@query("ml_2", a.with_sql(
    """SELECT match_id, CASE WHEN b < 10 THEN 'test' WHEN b < 19 THEN 'validation' ELSE 'train' END AS part
       FROM (SELECT match_id, CAST('0x' || substr(md5(match_id), 1, 8) AS BIGINT) % 100 AS b FROM matches)""", *M))
def ml_2(spark, sf_dir):
    """Stable split by match."""
    return dataset.split(a.matches(spark, sf_dir), "match_id").select("match_id", "part")


@query("ml_9_lookups", a.with_sql(
    """SELECT u.match_id, u.player0, u.player1, o.ranking AS ranking0, p.ranking AS ranking1,
              o.seq AS seq0, p.seq AS seq1, x.label AS last_label
       FROM matches u
       JOIN second o ON o.player = u.player0 AND o.surface = u.stats_surface
       JOIN second p ON p.player = u.player1 AND p.surface = u.stats_surface
       JOIN (SELECT player0, player1, surface, arg_max(label, (start_date, seq)) AS label FROM matches
             GROUP BY 1, 2, 3) x ON x.player0 = u.player0 AND x.player1 = u.player1 AND x.surface = u.surface""",
    a.SQL_MATCHES, a.SQL_STATS, """
second AS (SELECT player, surface, seq, ranking FROM (
  SELECT *, row_number() OVER (PARTITION BY player, surface ORDER BY seq DESC) AS rn FROM stats) WHERE rn = 2)"""))
def ml_9_lookups(spark, sf_dir):
    """Lookups of a prediction row: last but one statistics of both sides and the last meeting."""
    m = a.matches(spark, sf_dir)
    stats = a.stats(spark, sf_dir)
    second = rows_per_key_at_most(
        stats.select("player", "surface", "seq", "ranking"), ["player", "surface"], [F.desc("seq")], 2).filter("rank = 2")
    up = m.select("match_id", "player0", "player1", "surface", rates.stats_surface(F.col("surface")).alias("_s"))
    for s in (0, 1):
        side = second.select(
            F.col("player").alias(f"player{s}"), F.col("surface").alias("_s"), F.col("seq").alias(f"seq{s}"),
            F.col("ranking").alias(f"ranking{s}"))
        up = up.join(side, [f"player{s}", "_s"])
    last = m.groupBy("player0", "player1", "surface").agg(
        F.max_by("label", F.struct("start_date", "seq")).alias("last_label"))
    return up.join(last, ["player0", "player1", "surface"]).select(
        "match_id", "player0", "player1", "ranking0", "ranking1", "seq0", "seq1", "last_label")
