"""Text, date and value cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtside.functions import arrays, dates, rates, text
from courtside.functions.similarity import indel_ratio
from courtside.operators import clean, fuzzy
from courtside.schemas import COUNT_COLUMNS, PERCENT_COLUMNS
from courtside.workload import analogue as a
from courtside.workload.registry import query


def _raw(spark, sf_dir):
    return a.stats_raw(spark, sf_dir)


def _raw_matches(spark, sf_dir):
    return a.matches_raw(spark, sf_dir)


def _stats_sql(select: str) -> str:
    return a.with_sql(f"SELECT {select} FROM stats_raw", a.SQL_STATS_RAW)


def _matches_sql(select: str) -> str:
    return a.with_sql(f"SELECT {select} FROM matches_raw", a.SQL_MATCHES_RAW)


@query("str_1", """
SELECT page_id, trim(replace(replace('<td> ' || regexp_extract(html, '<title>([^<]*)</title>', 1) || ' </td>', '<td>', ''),
                             '</td>', '')) AS cell FROM pages""")
def str_1(spark, sf_dir):
    """Cell text without tags and outer blanks."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    cell = text.first_cell(F.array(F.concat(F.lit("<td> "), title, F.lit(" </td>"))))
    return a.table(spark, sf_dir, "pages").select("page_id", cell.alias("cell"))


@query("str_2", _stats_sql("""seq, TRY_CAST(nullif(regexp_replace("breakPointsSaved", '[^0-9]+', '', 'g'), '') AS DOUBLE)
       AS "breakPointsSaved", TRY_CAST(nullif(regexp_replace(points, '[^0-9]+', '', 'g'), '') AS DOUBLE) AS points"""))
def str_2(spark, sf_dir):
    """Digits only as a number."""
    return _raw(spark, sf_dir).select(
        "seq", *[text.digits(F.col(c)).alias(c) for c in ("breakPointsSaved", "points")])


@query("str_3", _stats_sql("seq, " + ", ".join(
    f"""TRY_CAST(rtrim("{c}", '%') AS DOUBLE) / 100.0 AS "{c}\"""" for c in PERCENT_COLUMNS)))
def str_3(spark, sf_dir):
    """Percent text as fractions."""
    return _raw(spark, sf_dir).select("seq", *[text.percent(F.col(c)).alias(c) for c in PERCENT_COLUMNS])


@query("str_4", _stats_sql("seq, CAST(regexp_extract(height, '([0-9]+)', 1) AS INTEGER) AS height"))
def str_4(spark, sf_dir):
    """First digit run of a height."""
    return _raw(spark, sf_dir).select("seq", text.first_number(F.col("height")).alias("height"))


@query("str_5", _stats_sql("seq, split_part(url, '=', 3) AS surface, split_part(url, '/', 6) AS player"))
def str_5(spark, sf_dir):
    """Surface and player from a url."""
    url = F.col("url")
    return _raw(spark, sf_dir).select(
        "seq", text.url_surface(url).alias("surface"), text.url_player(url).alias("player"))


@query("str_6", _matches_sql(
    """seq, split_part("surfaceInout", ' ', 1) AS "inOut", lower(split_part("surfaceInout", ' ', 2)) AS surface"""))
def str_6(spark, sf_dir):
    """In/out and surface from their joint text."""
    both = F.col("surfaceInout")
    return _raw_matches(spark, sf_dir).select(
        "seq", text.in_out(both).alias("inOut"), F.lower(text.surface_of(both)).alias("surface"))


@query("str_7", _stats_sql("seq, trim(plays) AS plays"))
def str_7(spark, sf_dir):
    """Trimmed text."""
    return _raw(spark, sf_dir).select("seq", text.strip(F.col("plays")).alias("plays"))


@query("str_8", _stats_sql("""seq, CAST(replace(points, ',', '') AS DOUBLE) AS points,
       CAST(replace(points, ',', '.') AS DOUBLE) AS points_compat"""))
def str_8(spark, sf_dir):
    """Thousands text, as a whole number and with the comma read as a point."""
    return _raw(spark, sf_dir).select(
        "seq", text.thousands(F.col("points")).alias("points"),
        text.thousands(F.col("points"), compat=True).alias("points_compat"))


@query("str_9", _stats_sql("""seq, CASE WHEN trim(plays) IN ('Eric Lambert', 'Brent Larkham', 'Nelen Brodar',
       'Tony Graham', '') THEN 'Right-Handed, Two-Handed Backhand' ELSE trim(plays) END AS plays"""))
def str_9(spark, sf_dir):
    """Values that are no playing hand replaced by the default hand."""
    return _raw(spark, sf_dir).select("seq", text.clean_plays(F.col("plays")).alias("plays"))


@query("str_10", _stats_sql("seq, trim(split_part(plays, ',', 1)) AS hand"))
def str_10(spark, sf_dir):
    """First comma part."""
    return _raw(spark, sf_dir).select("seq", text.hand(F.col("plays")).alias("hand"))


@query("str_11", a.with_sql(
    """SELECT seq, split_part(l, ' ', 2) || ' ' || split_part(l, ' ', 1) AS joueur0,
              split_part(r, ' ', 2) || ' ' || split_part(r, ' ', 1) AS joueur1,
              split_part(l, ' ', 1) || split_part(r, ' ', 1) AS key
       FROM (SELECT seq, replace(lower(trim("winnerName" || ', Ann')), ',', '') AS l,
                    replace(lower(trim("looserName" || ', Bob')), ',', '') AS r FROM matches_raw)""",
    a.SQL_MATCHES_RAW))
def str_11(spark, sf_dir):
    """Player names and key from a fixture title; names may contain a hyphen."""
    title = F.concat(F.col("winnerName"), F.lit(", Ann - "), F.col("looserName"), F.lit(", Bob"))
    side0, side1 = (text.fixture_side(title, s) for s in (0, 1))
    return _raw_matches(spark, sf_dir).select(
        "seq", text.fixture_player(side0).alias("joueur0"), text.fixture_player(side1).alias("joueur1"),
        F.concat(F.get(side0, F.lit(0)), F.get(side1, F.lit(0))).alias("key"))


@query("str_12", a.with_sql(
    """SELECT seq, least("winnerName", "looserName") || greatest("winnerName", "looserName") || date AS complete_id,
              regexp_replace(date, '[^0-9]', '', 'g') || "looserName" || "winnerName" AS dated_id FROM matches_raw""",
    a.SQL_MATCHES_RAW))
def str_12(spark, sf_dir):
    """Prediction keys."""
    return _raw_matches(spark, sf_dir).select(
        "seq", text.prediction_id(
            F.least("winnerName", "looserName"), F.greatest("winnerName", "looserName"), F.col("date"),
        ).alias("complete_id"),
        text.dated_id(F.col("date"), F.col("looserName"), F.col("winnerName")).alias("dated_id"))


@query("str_14", _stats_sql(
    "seq, contains(lower(plays), 'left') AS is_left, lower(split_part(url, '=', 3)) = 'clay' AS is_clay"))
def str_14(spark, sf_dir):
    """Case-insensitive tests."""
    return _raw(spark, sf_dir).select(
        "seq", text.contains_ignore_case(F.col("plays"), "Left").alias("is_left"),
        (F.lower(text.url_surface(F.col("url"))) == "clay").alias("is_clay"))


@query("str_15", _stats_sql("""seq, 'https://example.test' || replace('/en/players/' || player || '/overview', 'overview',
       'player-stats') || '?year=' || year || '&surfaceType=' || split_part(url, '=', 3) AS url"""))
def str_15(spark, sf_dir):
    """Statistics url from an overview link."""
    link = F.concat(F.lit("/en/players/"), F.col("player"), F.lit("/overview"))
    return _raw(spark, sf_dir).select("seq", text.stats_url(
        "https://example.test", link, F.col("year"), text.url_surface(F.col("url"))).alias("url"))


@query("str_16", _stats_sql("seq, regexp_extract(age, '\\(([^)]*)\\)', 1) AS birthday"))
def str_16(spark, sf_dir):
    """Text between brackets."""
    return _raw(spark, sf_dir).select("seq", text.between_brackets(F.col("age")).alias("birthday"))


@query("str_17", _stats_sql("seq, " + ", ".join(
    f"""nullif("{c}", '[]') AS "{c}\"""" for c in COUNT_COLUMNS)))
def str_17(spark, sf_dir):
    """Null markers of every text column as NULL."""
    return clean.null_text(_raw(spark, sf_dir).select("seq", *COUNT_COLUMNS))


@query("f_14", _stats_sql("seq, " + ", ".join(f"""nullif("{c}", '[]') AS "{c}\"""" for c in (
    "breakPointsConverted", "breakPointsFaced", "breakPointsOpportunities", "breakPointsSaved", "doubleFautes",
    "firstServe", "firstServePointsWon", "firstServeReturnPointsWon"))))
def f_14(spark, sf_dir):
    """The eight columns that may hold an empty-list marker."""
    return clean.null_text(_raw(spark, sf_dir).select(
        "seq", "breakPointsConverted", "breakPointsFaced", "breakPointsOpportunities", "breakPointsSaved",
        "doubleFautes", "firstServe", "firstServePointsWon", "firstServeReturnPointsWon"))


@query("f_15", _stats_sql("""seq, TRY_CAST("breakPointsFaced" AS DOUBLE) AS "breakPointsFaced",
    TRY_CAST("breakPointsOpportunities" AS DOUBLE) AS "breakPointsOpportunities",
    TRY_CAST("breakPointsSaved" AS DOUBLE) AS "breakPointsSaved" """))
def f_15(spark, sf_dir):
    """Text as numbers; what is no number becomes NULL instead of failing the job."""
    cols = ("breakPointsFaced", "breakPointsOpportunities", "breakPointsSaved")
    return _raw(spark, sf_dir).select("seq", *[text.number(F.col(c)).alias(c) for c in cols])


@query("f_18", _stats_sql("seq, CAST(CAST(aces AS INTEGER) / (CAST(\"serviceGamePlayed\" AS INTEGER) * 4) AS DOUBLE) AS rate"))
def f_18(spark, sf_dir):
    """A ratio of whole numbers as a double."""
    return _raw(spark, sf_dir).select("seq", F.try_divide(
        text.integer(F.col("aces")), text.integer(F.col("serviceGamePlayed")) * 4).cast("double").alias("rate"))


@query("dt_1", _matches_sql("seq, CAST(split_part(date, '.', 1) AS INTEGER) AS year"))
def dt_1(spark, sf_dir):
    """Year of a date range."""
    return _raw_matches(spark, sf_dir).select("seq", dates.range_year(F.col("date")).alias("year"))


_START = "CAST(strptime(split_part(date, ' - ', 1), '%Y.%m.%d') AS DATE)"
_END = "CAST(strptime(split_part(date, ' - ', 2), '%Y.%m.%d') AS DATE)"


@query("dt_2", _matches_sql(f"seq, CAST(date_diff('day', {_START}, {_END}) AS INTEGER) AS duree"))
def dt_2(spark, sf_dir):
    """Days of a date range."""
    return _raw_matches(spark, sf_dir).select("seq", dates.range_days(F.col("date")).alias("duree"))


@query("dt_3", _matches_sql(f"seq, {_START} AS start_date, {_END} AS end_date"))
def dt_3(spark, sf_dir):
    """First and last day of a date range."""
    return _raw_matches(spark, sf_dir).select(
        "seq", dates.range_start(F.col("date")).alias("start_date"), dates.range_end(F.col("date")).alias("end_date"))


@query("dt_4", _stats_sql(
    """seq, CAST(year AS INTEGER) - CAST(regexp_extract(age, '([0-9]{4})', 1) AS INTEGER) AS age,
       2020 - CAST(regexp_extract(age, '([0-9]{4})', 1) AS INTEGER) AS age_2020"""))
def dt_4(spark, sf_dir):
    """Age in the year of the row and in a given year."""
    return _raw(spark, sf_dir).select(
        "seq", dates.age_in(text.integer(F.col("year")), F.col("age")).alias("age"),
        dates.age_in(F.lit(2020), F.col("age")).alias("age_2020"))


@query("dt_5", """SELECT o_orderkey, CAST(day(o_orderdate) AS VARCHAR) || '-' || CAST(month(o_orderdate) AS VARCHAR) AS week
FROM orders""")
def dt_5(spark, sf_dir):
    """Week tag of a date."""
    return a.table(spark, sf_dir, "orders").select("o_orderkey", dates.week_tag(F.col("o_orderdate")).alias("week"))


@query("dt_6", a.with_sql(
    f"""SELECT seq, {_START} AS day FROM matches_raw UNION ALL SELECT seq, {_END} FROM matches_raw""",
    a.SQL_MATCHES_RAW))
def dt_6(spark, sf_dir):
    """A list of date texts as dates, one row each."""
    listed = dates.parse_dates(F.split("date", " - "))
    return _raw_matches(spark, sf_dir).select("seq", F.explode(listed).alias("day"))


@query("srt_3", a.with_sql(
    f"""SELECT seq, CASE WHEN year({_START}) = year({_END}) THEN {_START}
               WHEN year({_END}) = year({_END}) THEN {_END} END AS first_date,
               CAST(CASE WHEN abs(1998 - year({_START})) <= abs(1998 - year({_END})) THEN year({_START})
                    ELSE year({_END}) END AS INTEGER) AS nearest FROM matches_raw""", a.SQL_MATCHES_RAW))
def srt_3(spark, sf_dir):
    """First date of a list in a year, and the listed year nearest to 1998."""
    listed = dates.parse_dates(F.split("date", " - "))
    last_year = F.year(dates.range_end(F.col("date")))
    return _raw_matches(spark, sf_dir).select(
        "seq", dates.first_date_in(listed, last_year).alias("first_date"),
        dates.nearest_year(F.transform(listed, F.year), F.lit(1998)).alias("nearest"))


# --- names -----------------------------------------------------------------------------------------------------------

# altered names: a missing and a replaced character, told apart by the size of the part
_ALTERED_SQL = """CASE WHEN p_size <= 25 THEN substr(p_name, 1, 2) || substr(p_name, 4)
                       ELSE replace(p_name, ' ', '-') || 'x' END"""


def _altered():
    name = F.col("p_name")
    cut = F.concat(F.substring(name, 1, 2), F.substring(name, F.lit(4), F.length(name)))
    return F.when(F.col("p_size") <= 25, cut).otherwise(F.concat(F.translate(name, " ", "-"), F.lit("x")))


# length of the longest common subsequence, one row of the usual table per character of the query
_COMMON_SQL = """
lcs(query, name, i, cells) AS (
  SELECT query, name, 0, list_transform(range(0, length(name) + 1), lambda x: CAST(0 AS BIGINT)) FROM pairs
  UNION ALL
  SELECT query, name, i + 1, list_concat([CAST(0 AS BIGINT)], list_transform(range(1, length(name) + 1),
           lambda j: list_max(list_transform(range(1, j + 1), lambda p:
             CASE WHEN substr(name, CAST(p AS INTEGER), 1) = substr(query, i + 1, 1) THEN cells[p] + 1
                  ELSE cells[p + 1] END))))
  FROM lcs WHERE i < length(query)),
ratios AS (
  SELECT query, name, CAST(round_even(100.0::DOUBLE * (2 * cells[length(name) + 1]) / (length(query) + length(name)), 0)
                           AS INTEGER) AS score
  FROM lcs WHERE i = length(query))"""


@query("join_3", f"""
WITH RECURSIVE asked AS (SELECT DISTINCT {_ALTERED_SQL} AS query FROM part),
vocab AS (SELECT p_name AS name, min(p_partkey) AS pos FROM part GROUP BY p_name),
pairs AS (SELECT query, name FROM asked, vocab),
{_COMMON_SQL}
SELECT query, name, score FROM (
  SELECT r.*, row_number() OVER (PARTITION BY query ORDER BY score DESC, pos) AS rn
  FROM ratios r JOIN vocab USING (name)) WHERE rn = 1""")
def join_3(spark, sf_dir):
    """Best known name of every altered name; the first one in the table wins a tie."""
    part = a.table(spark, sf_dir, "part")
    return fuzzy.resolve_names(part.select(_altered().alias("query")), part, name="p_name", position="p_partkey")


@query("str_13", f"""
WITH RECURSIVE pairs AS (
  SELECT DISTINCT split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) AS query, p_name AS name FROM part),
{_COMMON_SQL}
SELECT p_partkey, score AS ratio FROM part JOIN ratios ON name = p_name""")
def str_13(spark, sf_dir):
    """Indel ratio of every part name with its own reversed word order."""
    name = F.col("p_name")
    swapped = F.concat_ws(" ", F.reverse(F.split(name, " ")))
    return a.table(spark, sf_dir, "part").select("p_partkey", indel_ratio(name, swapped).alias("ratio"))


@query("flt_13", "SELECT DISTINCT p_name AS name FROM part WHERE p_name IS NOT NULL")
def flt_13(spark, sf_dir):
    """Distinct known names: what may enter a name comparison."""
    return fuzzy.distinct_names(a.table(spark, sf_dir, "part"), "p_name").select("name")


# --- encodings ---------------------------------------------------------------------------------------------------------


@query("f_1", a.with_sql(
    """SELECT seq, CAST(CASE WHEN "winnerName" < "looserName" THEN 0 ELSE 1 END AS INTEGER) AS label,
              CAST(CASE CASE WHEN "winnerName" < "looserName" THEN 'joueur0' ELSE 'joueur1' END
                   WHEN 'joueur0' THEN 0 WHEN 'joueur1' THEN 1 END AS INTEGER) AS code FROM matches_raw""",
    a.SQL_MATCHES_RAW))
def f_1(spark, sf_dir):
    """Label of a match, as a number and from its text form."""
    label = rates.label(F.col("winnerName"), F.col("looserName"))
    name = F.concat(F.lit("joueur"), label.cast("string"))
    return _raw_matches(spark, sf_dir).select("seq", label.alias("label"), rates.label_code(name).alias("code"))


@query("f_3", _matches_sql("""seq, CASE WHEN contains("surfaceInout", 'Hard') THEN 'hard'
       WHEN contains("surfaceInout", 'Clay') THEN 'clay' ELSE 'grass' END AS surface"""))
def f_3(spark, sf_dir):
    """Surface under which statistics are kept."""
    return _raw_matches(spark, sf_dir).select("seq", rates.stats_surface(F.col("surfaceInout")).alias("surface"))


@query("f_5", _matches_sql("""seq, CASE WHEN "typeTournament" IS NULL THEN 250.0
       WHEN "typeTournament" IN ('finals', 'grandslam') THEN 2000.0 ELSE CAST("typeTournament" AS DOUBLE) END AS points"""))
def f_5(spark, sf_dir):
    """Tournament points from a badge."""
    return _raw_matches(spark, sf_dir).select("seq", rates.tournament_points(F.col("typeTournament")).alias("points"))


@query("f_6", _matches_sql("""seq, CAST(CASE phase WHEN 'Finals' THEN 8 WHEN 'Semi-Finals' THEN 7
       WHEN 'Quarterfinals' THEN 6 WHEN 'Round of 16' THEN 5 END AS INTEGER) AS phase"""))
def f_6(spark, sf_dir):
    """Round as a number."""
    return _raw_matches(spark, sf_dir).select("seq", rates.phase_ordinal(F.col("phase")).alias("phase"))


@query("f_16", """SELECT p_partkey, 1.0 + p_size / 10.0 AS odds, 1.0 + CAST(p_size AS DOUBLE) AS whole FROM part""")
def f_16(spark, sf_dir):
    """Decimal odds of a fraction and of a whole number."""
    size = F.col("p_size").cast("string")
    return a.table(spark, sf_dir, "part").select(
        "p_partkey", rates.decimal_odds(F.concat(size, F.lit("/10"))).alias("odds"),
        rates.decimal_odds(size).alias("whole"))


@query("arr_1", a.with_sql(
    """SELECT seq, 0 AS position, "winnerName" AS player, "winnerRate" AS rate FROM matches_raw
       UNION ALL SELECT seq, 1, "looserName", "looserRate" FROM matches_raw""", a.SQL_MATCHES_RAW))
def arr_1(spark, sf_dir):
    """Parallel lists zipped to rows."""
    zipped = F.arrays_zip(
        F.array("winnerName", "looserName").alias("player"), F.array("winnerRate", "looserRate").alias("rate"))
    return _raw_matches(spark, sf_dir).select("seq", F.posexplode(zipped).alias("position", "z")).select(
        "seq", "position", "z.player", "z.rate")


@query("arr_2", """
SELECT page_id, array_to_string(list_filter(l, lambda x, i: i % 2 = 1), ' ') AS every_second,
       array_to_string(l[2:], ' ') AS without_first, array_to_string(l[:greatest(len(l) - 2, 0)], ' ') AS without_last
FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)""")
def arr_2(spark, sf_dir):
    """Every second item, all but the first, all but the last two."""
    page = a.table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)).alias("l"))
    links = F.col("l")
    return page.select(
        "page_id", F.concat_ws(" ", arrays.every_second(links)).alias("every_second"),
        F.concat_ws(" ", arrays.without_first(links)).alias("without_first"),
        F.concat_ws(" ", arrays.without_last(links, F.lit(2))).alias("without_last"))


@query("arr_3", a.with_sql(
    """SELECT seq, won / CAST(won + lost AS DOUBLE) AS share_winner, lost / CAST(won + lost AS DOUBLE) AS share_looser
       FROM (SELECT seq, 1 + CASE WHEN "surfaceInout" = 'Indoor Grass' THEN 1 ELSE 0 END AS won,
                    CASE WHEN "surfaceInout" = 'Outdoor Hard' THEN 1 ELSE 0 END AS lost FROM matches_raw)""",
    a.SQL_MATCHES_RAW))
def arr_3(spark, sf_dir):
    """Share of the listed meetings on the surface of a match that each side won, from parallel lists."""
    winners = F.array("winnerName", "looserName", "winnerName")
    surfaces = F.array(F.col("surfaceInout"), F.lit("Outdoor Hard"), F.lit("Indoor Grass"))
    return _raw_matches(spark, sf_dir).select("seq", *[
        arrays.surface_share(winners, surfaces, F.col("surfaceInout"), F.col(f"{side}Name")).alias(f"share_{side}")
        for side in ("winner", "looser")])


@query("arr_4_given", """
SELECT page_id, array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), '|') AS links,
       array_to_string(regexp_extract_all(html, '<h1>([^<]*)</h1>', 1), '|') AS heads,
       array_to_string(regexp_extract_all(html, '<title>([^<]*)</title>', 1), '|') AS titles FROM pages""")
def arr_4_given(spark, sf_dir):
    """Three parallel lists of a page."""
    def every(pattern):
        return F.concat_ws("|", F.regexp_extract_all("html", F.lit(pattern), F.lit(1)))

    return a.table(spark, sf_dir, "pages").select(
        "page_id", every('<a href="([^"]*)"').alias("links"), every("<h1>([^<]*)</h1>").alias("heads"),
        every("<title>([^<]*)</title>").alias("titles"))
