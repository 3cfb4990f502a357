"""Feed, page, storage and stream queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtside import schemas
from courtside.functions import arrays, text
from courtside.operators import decide, enrich, feed, html
from courtside.operators.dataset import fit_minmax
from courtside.operators.skew import last_row
from courtside.session import materialize, scratch_path
from courtside.sources import lake, sinks
from courtside.streaming import feed_stream
from courtside.workload import analogue as a
from courtside.workload.registry import query

M = (a.SQL_MATCHES,)

# --- feed documents --------------------------------------------------------------------------------------------------------

KINDS = {0: "ATP", 1: "Grand Chelem", 2: "ITF", 3: "ATP", 4: "WTA"}
_KIND_SQL = "CASE n_regionkey " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in KINDS.items()) + " END"
_NAME_SQL = "n_name || CASE WHEN n_nationkey < 5 THEN ' Femmes' WHEN n_nationkey < 8 THEN ' Doubles' ELSE '' END"


def _kind():
    return F.element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), F.col("n_regionkey"))


def _tournament():
    suffix = F.when(F.col("n_nationkey") < 5, F.lit(" Femmes")).when(
        F.col("n_nationkey") < 8, F.lit(" Doubles")).otherwise(F.lit(""))
    return F.concat(F.col("n_name"), suffix)


def group_documents(spark, sf_dir):
    """One JSON document per nation with its kind and its tournament."""
    one = F.struct(_tournament().alias("name"), F.col("n_nationkey").cast("long").alias("id"))
    kind = F.struct(_kind().alias("name"), F.array(one).alias("groups"))
    return a.table(spark, sf_dir, "nation").select(
        F.to_json(F.struct(F.struct(F.array(kind).alias("groups")).alias("group"))).alias("json"))


def event_documents(spark, sf_dir, base=None):
    """One JSON document per match with the tournament it belongs to."""
    return (_offers_base(spark, sf_dir) if base is None else base).select(F.to_json(F.struct(
        (F.col("seq") % 25).alias("groupId"), F.array(F.struct(F.col("seq").alias("id"))).alias("events"),
    )).alias("json"))


def _offers_base(spark, sf_dir):
    return a.matches_raw(spark, sf_dir).select(
        "seq", "winnerName", "looserName", "date", text.digits(F.col("winnerRate")).cast("int").alias("rate"),
        "surfaceInout")


def offer_documents(spark, sf_dir, base=None):
    """One JSON document per match: its event, a match offer and an offer of another kind."""
    def outcomes(first, second):
        return F.array(F.struct(first.alias("oddsFractional")), F.struct(second.alias("oddsFractional")))

    def offer(label, odds):
        return F.struct(
            F.col("seq").alias("eventId"), F.struct(F.lit(label).alias("label")).alias("criterion"),
            odds.alias("outcomes"))

    rate = F.col("rate").cast("string")
    first = F.when(F.col("surfaceInout") == "Indoor Carpet", F.lit("evens")).otherwise(F.concat(rate, F.lit("/50")))
    event = F.struct(
        F.col("seq").alias("id"),
        F.concat("winnerName", F.lit(", Ann - "), "looserName", F.lit(", Bob")).alias("englishName"),
        F.col("date").alias("start"))
    return (_offers_base(spark, sf_dir) if base is None else base).select(F.to_json(F.struct(
        F.array(event).alias("events"),
        F.array(
            offer("Total Games", outcomes(F.lit("1/2"), F.lit("3/2"))),
            offer("Match Odds (regular)", outcomes(first, F.lit("5/4")))).alias("betOffers"),
    )).alias("json"))


def _parsed(df, schema):
    return df.select(F.from_json("json", schema).alias("d")).select("d.*")


_FEED_SQL = f"""
tournaments AS (
  SELECT {_NAME_SQL} AS tournement, CAST(n_nationkey AS BIGINT) AS "groupId" FROM nation
  WHERE {_KIND_SQL} IN ('Grand Chelem', 'ATP') AND NOT contains({_NAME_SQL}, 'Femmes')
    AND NOT contains({_NAME_SQL}, 'Doubles')),
feed_events AS (
  SELECT seq AS "eventId", tournement FROM matches_raw JOIN tournaments ON "groupId" = seq % 25),
feed_offers AS (
  SELECT seq AS "eventId", "winnerName" || ', Ann - ' || "looserName" || ', Bob' AS "englishName", date AS start,
         CASE WHEN "surfaceInout" = 'Indoor Carpet' THEN NULL
              ELSE 1.0 + CAST(replace("winnerRate", '%', '') AS DOUBLE) / 50.0 END AS odds0, 2.25::DOUBLE AS odds1,
         'ann ' || "winnerName" AS joueur0, 'bob ' || "looserName" AS joueur1, "winnerName" || "looserName" AS key
  FROM matches_raw)"""
_FEED = (a.SQL_MATCHES_RAW, _FEED_SQL)


def _listed(spark, sf_dir, base=None):
    tournaments = feed.feed_tournaments(_parsed(group_documents(spark, sf_dir), schemas.FEED_GROUPS))
    return feed.feed_events(_parsed(event_documents(spark, sf_dir, base), schemas.FEED_EVENTS), tournaments)


def _offers(spark, sf_dir):
    return feed.feed_offers(_parsed(offer_documents(spark, sf_dir), schemas.FEED_OFFERS))


@query("jsn_1", a.with_sql('SELECT tournement, "groupId" FROM tournaments', *_FEED))
def jsn_1(spark, sf_dir):
    """Tournaments of nested groups."""
    return feed.feed_tournaments(_parsed(group_documents(spark, sf_dir), schemas.FEED_GROUPS))


@query("flt_6", f"SELECT n_nationkey, {_KIND_SQL} AS kind FROM nation WHERE {_KIND_SQL} IN ('Grand Chelem', 'ATP')")
def flt_6(spark, sf_dir):
    """Allowed tournament groups."""
    return a.table(spark, sf_dir, "nation").select("n_nationkey", _kind().alias("kind")).filter(
        F.col("kind").isin(*schemas.TOURNAMENT_GROUPS))


@query("flt_7", f"""SELECT {_NAME_SQL} AS tournement FROM nation
WHERE NOT contains({_NAME_SQL}, 'Femmes') AND NOT contains({_NAME_SQL}, 'Doubles')""")
def flt_7(spark, sf_dir):
    """Names without an excluded word."""
    names = a.table(spark, sf_dir, "nation").select(_tournament().alias("tournement"))
    for word in schemas.EXCLUDED_TOURNAMENT_WORDS:
        names = names.filter(~F.col("tournement").contains(word))
    return names


@query("jsn_2", a.with_sql('SELECT "eventId", tournement FROM feed_events', *_FEED))
def jsn_2(spark, sf_dir):
    """Events with their tournament."""
    return _listed(spark, sf_dir)


@query("join_8", a.with_sql(
    'SELECT "eventId", tournement, "englishName" FROM feed_events JOIN feed_offers USING ("eventId")', *_FEED))
def join_8(spark, sf_dir):
    """Tournament and name of every event by id."""
    names = _parsed(offer_documents(spark, sf_dir), schemas.FEED_OFFERS).select(F.inline("events"))
    named = names.select(F.col("id").alias("eventId"), "englishName")
    return _listed(spark, sf_dir).join(named, "eventId")


@query("jsn_3", a.with_sql(
    """SELECT "eventId", "englishName", start, CASE WHEN odds0 IS NULL THEN 'evens'
              ELSE replace("winnerRate", '%', '') || '/50' END AS odds0, '5/4' AS odds1
       FROM feed_offers JOIN matches_raw ON seq = "eventId" """, *_FEED))
def jsn_3(spark, sf_dir):
    """Match offers with their two prices."""
    return _offers(spark, sf_dir).select("eventId", "englishName", "start", "odds0", "odds1")


@query("flt_8", a.with_sql('SELECT "eventId", CAST(1 AS INTEGER) AS position FROM feed_offers', *_FEED))
def flt_8(spark, sf_dir):
    """Offers of listed events with the match label."""
    return _offers(spark, sf_dir).select("eventId", "position")


@query("join_9", a.with_sql(
    'SELECT "eventId" FROM feed_offers WHERE "eventId" IN (SELECT "eventId" FROM feed_events)', *_FEED))
def join_9(spark, sf_dir):
    """Offers whose event is listed."""
    return _offers(spark, sf_dir).join(_listed(spark, sf_dir), "eventId", "left_semi").select("eventId")


@query("flt_12_feed", a.with_sql(
    """SELECT "eventId", 'odds' AS reason FROM feed_offers JOIN feed_events USING ("eventId") WHERE odds0 IS NULL""", *_FEED))
def flt_12_feed(spark, sf_dir):
    """Offers that do not parse, with the reason."""
    _, rejects = feed.flatten_feed(
        _parsed(group_documents(spark, sf_dir), schemas.FEED_GROUPS),
        _parsed(event_documents(spark, sf_dir), schemas.FEED_EVENTS),
        _parsed(offer_documents(spark, sf_dir), schemas.FEED_OFFERS))
    return rejects.select("eventId", "reason")


@query("src_8", a.with_sql(
    f"""SELECT key, tournement, start, joueur0, joueur1, odds0 AS "oddJoueur0", poll_odds AS "oddJoueur1" FROM (
         SELECT *, row_number() OVER (PARTITION BY key ORDER BY poll DESC, "eventId" DESC) AS rn
         FROM (SELECT *, 1 AS poll, 3.0 AS poll_odds FROM feed_offers
               UNION ALL SELECT *, 2, odds1 FROM feed_offers WHERE "eventId" % 3 = 0)
         JOIN feed_events USING ("eventId") WHERE odds0 IS NOT NULL) WHERE rn = 1""", *_FEED))
def src_8(spark, sf_dir):
    """Upcoming matches from landed feed files: every event in the first poll, a third of them again, with other odds, in the second."""
    def landed(name, *polls):
        path = scratch_path(spark, f"feed-{name}")
        for number, documents in enumerate(polls, 1):
            documents.write.text(f"{path}/poll-{number:04d}")
        schema = {"groups": schemas.FEED_GROUPS, "events": schemas.FEED_EVENTS, "offers": schemas.FEED_OFFERS}[name]
        return lake.read_feed(spark, f"{path}/*", schema, per_line=True)

    offers = offer_documents(spark, sf_dir)
    first = offers.select(F.replace("json", F.lit('"5/4"'), F.lit('"2/1"')).alias("json"))
    third = offers.filter(F.get_json_object("json", "$.events[0].id").cast("long") % 3 == 0)
    return feed.flatten_feed(
        landed("groups", group_documents(spark, sf_dir)), landed("events", event_documents(spark, sf_dir)), landed("offers", first, third))[0]


_PROPS_SQL = """
SELECT user_id, event_type, event_id, ts, CAST(json_extract(props, '$.k') AS INTEGER) AS k, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


def _events(df):
    return df.select(
        "user_id", "event_type", "event_id", "ts", F.from_json("props", "k int")["k"].alias("k"), "value")


@query("win_7", _PROPS_SQL)
def win_7(spark, sf_dir):
    """Last event per user and type wins."""
    return last_row(
        _events(a.table(spark, sf_dir, "events")), ["user_id", "event_type"], F.struct("ts", "event_id"),
        ["event_id", "ts", "k", "value"])


@query("strm_1_events", _PROPS_SQL)
def strm_1_events(spark, sf_dir):
    """The same from a file stream, upserted batch by batch."""
    batch = a.table(spark, sf_dir, "events")
    stream = spark.readStream.schema(batch.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return feed_stream.upsert_available(
        spark, _events(stream), scratch_path(spark, "stream"), scratch_path(spark, "stream-state"),
        ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])


FILES_PER_POLL = 4


def land_polls(spark, sf_dir, landing, base=None):
    """Four polls of the odds feed, each as many files: most events, a third of them with other odds, the same poll again in another
    folder, and one that comes days too late with events that no other poll has."""
    # the matches behind the documents are written once; a poll makes the documents of its own events only
    base = materialize(_offers_base(spark, sf_dir), "offers-base") if base is None else base
    event = F.col("seq")

    def documents_of(events):
        return offer_documents(spark, sf_dir, base.filter(events))

    changed = F.replace("json", F.lit('"5/4"'), F.lit('"2/1"')).alias("json")
    polls = [
        ("poll-20200105120000", documents_of(event % 7 != 0).select(changed)),
        ("poll-20200105130000", documents_of((event % 7 != 0) & (event % 3 == 0))),
        ("poll-20200105130000-again", documents_of((event % 7 != 0) & (event % 3 == 0))),
        ("poll-20200101120000", documents_of(event % 7 == 0))]
    for name, documents in polls:
        documents.repartition(FILES_PER_POLL).write.text(f"{landing}/{name}")


@query("strm_1", a.with_sql(
    f"""SELECT key, tournement, start, joueur0, joueur1, odds0 AS "oddJoueur0", poll_odds AS "oddJoueur1", polled FROM (
         SELECT *, row_number() OVER (PARTITION BY key ORDER BY polled DESC, "eventId" DESC) AS rn
         FROM (SELECT *, '2020-01-05 12:00:00' AS polled, 3.0 AS poll_odds FROM feed_offers
               UNION ALL SELECT *, '2020-01-05 13:00:00', odds1 FROM feed_offers WHERE "eventId" % 3 = 0)
         JOIN feed_events USING ("eventId") WHERE odds0 IS NOT NULL AND "eventId" % 7 <> 0) WHERE rn = 1""", *_FEED))
def strm_1(spark, sf_dir):
    """Latest offer per match from streamed polls of the feed, one poll a batch: a repeated poll and a late one change nothing."""
    landing, target = scratch_path(spark, "polls"), scratch_path(spark, "offers")
    base = materialize(_offers_base(spark, sf_dir), "offers-base")
    land_polls(spark, sf_dir, landing, base)
    listed = materialize(_listed(spark, sf_dir, base), "listed")
    feed_stream.upsert_offers(
        spark, landing, listed, target, scratch_path(spark, "offers-state"), files_per_trigger=FILES_PER_POLL).awaitTermination()
    cols = ["key", "tournement", "start", "joueur0", "joueur1", "oddJoueur0", "oddJoueur1"]
    return feed_stream.current_offers(spark, target).select(*cols, F.col("polled").cast("string").alias("polled"))


# --- pages -------------------------------------------------------------------------------------------------------------------

_LINKS_SQL = """
links AS (SELECT page_id, url, CAST(i - 1 AS INTEGER) AS position, l[i] AS link, t[i] AS label
          FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l,
                       regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1) AS t FROM pages) p,
               generate_series(1, len(l)) g(i))"""
LINK_PAGE = {
    "link": html.Selector('<a href="([^"]*)"'),
    "label": html.Selector('<a href="[^"]*">([^<]*)</a>'),
}
HEAD_PAGE = {
    "lang": html.Selector('<html lang="([^"]*)"', many=False),
    "title": html.Selector("<title>([^<]*)</title>", many=False),
    "heading": html.Selector("<h1>([^<]*)</h1>", many=False),
}


def _pages(spark, sf_dir):
    return a.table(spark, sf_dir, "pages")


def _links(spark, sf_dir):
    return html.exploded(html.extract(_pages(spark, sf_dir), LINK_PAGE), ["link", "label"])


@query("src_9", "SELECT url, CAST(length(html) AS INTEGER) AS size FROM pages")
def src_9(spark, sf_dir):
    """Pages to extract from."""
    return lake.read_pages(spark, f"{sf_dir}/pages.parquet").select("url", F.length("html").alias("size"))


@query("htm_1_given", "WITH " + _LINKS_SQL + " SELECT 'https://example.test' || link AS url, label FROM links")
def htm_1_given(spark, sf_dir):
    """Absolute links of an index page with their texts."""
    return _links(spark, sf_dir).select(
        F.concat(F.lit("https://example.test"), text.strip_cell(F.col("link"))).alias("url"), "label")


@query("htm_2_given", """
SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
       regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS heading,
       CAST(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS INTEGER) AS links FROM pages""")
def htm_2_given(spark, sf_dir):
    """Header fields and the number of links of a page."""
    page = html.extract(_pages(spark, sf_dir), {**HEAD_PAGE, "link": LINK_PAGE["link"]})
    return page.select(
        "page_id", *[F.coalesce(c, F.lit("")).alias(c) for c in HEAD_PAGE], F.size("link").alias("links"))


@query("htm_3_given", "WITH " + _LINKS_SQL + """
SELECT page_id, CAST(count(*) FILTER (WHERE link = first_link) AS DOUBLE) / count(*) AS share FROM (
  SELECT *, first(link) OVER (PARTITION BY page_id ORDER BY position) AS first_link FROM links)
GROUP BY page_id, first_link""")
def htm_3_given(spark, sf_dir):
    """Share of a page's links that repeat the first one: a breakdown table counted in the list."""
    page = html.extract(_pages(spark, sf_dir), LINK_PAGE)
    links = F.col("link")
    same = F.transform(links, lambda x: F.lit("all"))
    share = arrays.surface_share(links, same, F.lit("all"), F.get(links, F.lit(0)))
    return page.select("page_id", share.alias("share")).filter("share IS NOT NULL")


@query("htm_4_given", "WITH " + _LINKS_SQL + " SELECT page_id, position, link, label FROM links")
def htm_4_given(spark, sf_dir):
    """Rows of parallel lists."""
    return _links(spark, sf_dir).select("page_id", "position", "link", "label")


@query("htm_5_given", """
SELECT page_id, nullif(regexp_extract(row, '>([^<]*)</a>', 1), '') AS cell,
       nullif(regexp_extract(row, 'href="([^"]*)"', 1), '') AS link
FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '<ul>(.*?)</ul>', 1), '<li>(.*?)</li>', 1)[2] AS row
      FROM pages) WHERE row IS NOT NULL""")
def htm_5_given(spark, sf_dir):
    """A cell found by list and row number."""
    lists = F.regexp_extract("html", "<ul>(.*?)</ul>", 1)
    row = F.get(F.regexp_extract_all(lists, F.lit("<li>(.*?)</li>"), F.lit(1)), F.lit(1))
    cells = _pages(spark, sf_dir).select("page_id", row.alias("row")).filter("row IS NOT NULL")
    fields = {
        "cell": html.Selector(">([^<]*)</a>", many=False), "link": html.Selector('href="([^"]*)"', many=False)}
    return html.extract(cells, fields, "row")


@query("flt_11", "WITH " + _LINKS_SQL + " SELECT page_id, link FROM links WHERE contains(link, 'th')")
def flt_11(spark, sf_dir):
    """Links that contain a word."""
    page = html.extract(_pages(spark, sf_dir), LINK_PAGE)
    return page.select("page_id", F.explode(arrays.keep_containing(F.col("link"), "th")).alias("link"))


@query("agg_10", """
SELECT page_id, CAST(len(list_filter(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x: contains(x, 'th')))
                     AS INTEGER) AS n FROM pages""")
def agg_10(spark, sf_dir):
    """How many items of a list contain a word."""
    page = html.extract(_pages(spark, sf_dir), LINK_PAGE)
    return page.select("page_id", arrays.count_containing(F.col("link"), "th").alias("n"))


_ROUNDS = ["Finals", "Semi-Finals", "Quarterfinals", "Round of 16", "2nd Round Qualifying", "1st Round Qualifying"]


@query("win_8", "WITH " + _LINKS_SQL + """
SELECT page_id, position, CASE WHEN position = 0 THEN 'Finals' WHEN position <= 2 THEN 'Semi-Finals'
       WHEN position <= 6 THEN 'Quarterfinals' WHEN position <= 14 THEN 'Round of 16' ELSE 'Qualification' END AS phase
FROM links""")
def win_8(spark, sf_dir):
    """Round of every link from its position."""
    rounds = F.array(*[F.lit(r) for r in _ROUNDS])
    return _links(spark, sf_dir).select(
        "page_id", "position", arrays.round_of(rounds, F.col("position")).alias("phase"))


@query("join_12_given", "WITH " + _LINKS_SQL + """
SELECT l.page_id, l.link, regexp_extract(p.html, '<title>([^<]*)</title>', 1) AS title,
       regexp_extract(p.html, '<html lang="([^"]*)"', 1) AS lang FROM links l JOIN pages p ON p.url = l.url""")
def join_12_given(spark, sf_dir):
    """Header fields of a page on the rows extracted from it."""
    parents = html.extract(_pages(spark, sf_dir), HEAD_PAGE)
    children = _links(spark, sf_dir).select("page_id", "url", "link")
    rows = enrich.with_parent(children, parents, "url", ["title", "lang"])
    return rows.select("page_id", "link", F.coalesce("title", F.lit("")).alias("title"), "lang")


# --- lookups, storage --------------------------------------------------------------------------------------------------------

_LOOKUP_SQL = """
lookup AS (SELECT 'open-' || CAST(r_regionkey AS VARCHAR) AS name, CASE WHEN r_regionkey < 2 THEN 'Hard' ELSE 'Clay' END
             AS surface, CASE WHEN r_regionkey = 3 THEN 'Indoor' ELSE 'Outdoor' END AS "inOut",
             CAST(250 * (r_regionkey + 1) AS VARCHAR) AS points FROM region WHERE r_regionkey <> 4)"""


def _lookup_documents(spark, sf_dir):
    key = F.col("r_regionkey")
    info = F.struct(
        F.when(key < 2, F.lit("Hard")).otherwise(F.lit("Clay")).alias("surface"),
        F.when(key == 3, F.lit("Indoor")).otherwise(F.lit("Outdoor")).alias("inOut"),
        (250 * (key + 1)).cast("string").alias("points"))
    return a.table(spark, sf_dir, "region").filter(key != 4).select(
        F.to_json(F.create_map(F.concat(F.lit("open-"), key.cast("string")), info)).alias("json"))


@query("src_7", a.with_sql("SELECT * FROM lookup", _LOOKUP_SQL))
def src_7(spark, sf_dir):
    """Tournament lookup from a JSON file."""
    path = scratch_path(spark, "lookup")
    _lookup_documents(spark, sf_dir).write.text(path)
    return lake.tournament_lookup(spark.read.text(path), "value")


@query("join_7", a.with_sql(
    """SELECT m.seq, l.surface, l."inOut", l.points FROM matches_raw m JOIN lookup l ON l.name = m.name""",
    a.SQL_MATCHES_RAW, _LOOKUP_SQL))
def join_7(spark, sf_dir):
    """Tournament fields of every match; an unknown tournament drops the match."""
    m = a.matches_raw(spark, sf_dir).select("seq", F.col("name").alias("tournement"))
    lookup = lake.tournament_lookup(_lookup_documents(spark, sf_dir))
    return enrich.with_tournament(m, lookup).drop("tournement")


_STATS_COLUMNS_SQL = ", ".join(f'"{c}"' for c in schemas.STAT_COLUMNS)
_MATCH_COLUMNS_SQL = ", ".join(f'"{c}"' for c in schemas.MATCH_COLUMNS)


def _land_players(spark, sf_dir):
    """Statistics as one-row-per-record CSV files below year / week / surface, with an unnamed row number."""
    raw = a.stats_raw(spark, sf_dir)
    path = scratch_path(spark, "lake")
    rows = raw.select(
        F.lit("0").alias("_c0"), *schemas.STAT_COLUMNS, F.split_part("seq", F.lit("/"), F.lit(2)).alias("_year"),
        F.split_part("seq", F.lit("/"), F.lit(3)).alias("_week"), F.split_part("seq", F.lit("/"), F.lit(4)).alias("_kind"))
    sinks.write_table(rows, path, ["_year", "_week", "_kind"], fmt="csv")
    return path


def _land_matches(spark, sf_dir):
    path = scratch_path(spark, "lake")
    raw = a.matches_raw(spark, sf_dir)
    rows = raw.select(
        F.lit("0").alias("_c0"), *schemas.MATCH_COLUMNS, F.substring("date", 1, 4).alias("_year"),
        F.coalesce("typeTournament", F.lit("250")).alias("_type"), F.col("surfaceInout").alias("_place"),
        F.col("name").alias("_name"))
    sinks.write_table(rows, path, ["_year", "_type", "_place", "_name"], fmt="csv")
    return path


@query("src_1", a.with_sql(
    """SELECT player, aces, plays, split_part(seq, '/', 2) AS dir_year, split_part(seq, '/', 3) AS dir_week,
              split_part(seq, '/', 4) AS dir_surface FROM stats_raw WHERE year = '1998'""", a.SQL_STATS_RAW))
def src_1(spark, sf_dir):
    """Player files of one year; other years are not listed."""
    rows = lake.read_players(spark, _land_players(spark, sf_dir), 1998)
    return rows.select(
        "player", "aces", "plays", F.col("_year").alias("dir_year"), F.col("_week").alias("dir_week"),
        F.col("_surface").alias("dir_surface"))


@query("src_2", a.with_sql(
    """SELECT url, "surfaceInout" AS dir_surface, coalesce("typeTournament", '250') AS dir_type, name AS dir_name
       FROM matches_raw WHERE split_part(date, '.', 1) = '1999'""", a.SQL_MATCHES_RAW))
def src_2(spark, sf_dir):
    """Match files of one year with the levels of their path."""
    rows = lake.read_tournaments(spark, _land_matches(spark, sf_dir), 1999)
    return rows.select(
        "url", F.col("_surfaceInout").alias("dir_surface"), F.col("_type").alias("dir_type"),
        F.col("_tournament").alias("dir_name"))


@query("src_3", a.with_sql(f"SELECT {_STATS_COLUMNS_SQL} FROM stats_raw", a.SQL_STATS_RAW))
def src_3(spark, sf_dir):
    """All player files as one table."""
    return lake.read_players(spark, _land_players(spark, sf_dir)).select(*schemas.STAT_COLUMNS)


@query("src_4", a.with_sql(f"SELECT {_MATCH_COLUMNS_SQL} FROM matches_raw", a.SQL_MATCHES_RAW))
def src_4(spark, sf_dir):
    """All match files as one table."""
    return lake.read_tournaments(spark, _land_matches(spark, sf_dir)).select(*schemas.MATCH_COLUMNS)


@query("src_5", a.with_sql('SELECT player, "nextBest" FROM stats_raw', a.SQL_STATS_RAW))
def src_5(spark, sf_dir):
    """A consolidated file without its unnamed row number."""
    path = scratch_path(spark, "consolidated")
    rows = a.stats_raw(spark, sf_dir).select(F.lit("7").alias("_c0"), *schemas.STAT_COLUMNS)
    sinks.write_table(rows, path, fmt="csv")
    return lake.read_table_csv(spark, path, schemas.STAT_COLUMNS, index=True).select("player", "nextBest")


@query("src_6", a.with_sql(
    """SELECT seq, "doubleFautes", "breakPointsSaved" FROM stats_raw
       WHERE "doubleFautes" <> '[]' AND "breakPointsSaved" <> '[]'""", a.SQL_STATS_RAW))
def src_6(spark, sf_dir):
    """Complete rows of a consolidated file; null markers count as missing."""
    path = scratch_path(spark, "consolidated")
    cols = ["seq", "doubleFautes", "breakPointsSaved"]
    sinks.write_table(a.stats_raw(spark, sf_dir).select(*cols), path, fmt="csv")
    return lake.read_table_csv(spark, path, cols, complete_only=True)


def _round_trip(spark, df, name, **options):
    path = scratch_path(spark, name)
    sinks.write_table(df, path, **options)
    return spark.read.parquet(path)


@query("snk_1", a.with_sql("SELECT * FROM matches_raw", a.SQL_MATCHES_RAW))
def snk_1(spark, sf_dir):
    """Consolidated matches, written and read back."""
    return _round_trip(spark, a.matches_raw(spark, sf_dir), "tournaments")


@query("snk_2", a.with_sql(
    "SELECT match_id, ranking0, ranking1, points0, points1 FROM attached",
    a.SQL_MATCHES, a.SQL_STATS, a.SQL_STATS_LAST, a.sql_attached(["ranking", "points"])))
def snk_2(spark, sf_dir):
    """Matches with statistics, written and read back."""
    m = a.attached(spark, sf_dir, ["ranking", "points"])
    return _round_trip(spark, m.select("match_id", "ranking0", "ranking1", "points0", "points1"), "with-stats")


# the levels of landed files, from their path
_LEVELS_SQL = """split_part(seq, '/', 2) AS _year, split_part(seq, '/', 3) AS _week, split_part(seq, '/', 4) AS _surface"""


def _land_entities(spark, sf_dir):
    """All statistics below year / week / surface, many rows a file."""
    rows = a.stats_raw(spark, sf_dir)
    levels = [F.split_part("seq", F.lit("/"), F.lit(k)).alias(f"_{name}") for k, name in enumerate(lake.PLAYER_LAYOUT, 2)]
    path = scratch_path(spark, "entities")
    sinks.write_entities(rows.select(*schemas.STAT_COLUMNS, *levels), path, [f"_{name}" for name in lake.PLAYER_LAYOUT])
    return path


@query("snk_4", a.with_sql(f"SELECT {_STATS_COLUMNS_SQL}, {_LEVELS_SQL} FROM stats_raw", a.SQL_STATS_RAW))
def snk_4(spark, sf_dir):
    """Statistics by year, week and surface directory, all columns, written and read back."""
    return lake.read_entities(spark, _land_entities(spark, sf_dir), schemas.STAT_COLUMNS, lake.PLAYER_LAYOUT)


@query("snk_4_week", a.with_sql(
    f"""SELECT {_STATS_COLUMNS_SQL}, {_LEVELS_SQL} FROM stats_raw
        WHERE split_part(seq, '/', 2) = '1997' AND split_part(seq, '/', 3) = '1-4'""", a.SQL_STATS_RAW))
def snk_4_week(spark, sf_dir):
    """One week of them; the directories of other weeks are not listed as input."""
    return lake.read_entities(spark, _land_entities(spark, sf_dir), schemas.STAT_COLUMNS, lake.PLAYER_LAYOUT).filter(
        (F.col("_year") == "1997") & (F.col("_week") == "1-4"))


@query("snk_4_tournaments", a.with_sql(
    f"""SELECT {_MATCH_COLUMNS_SQL}, split_part(date, '.', 1) AS _year, coalesce("typeTournament", '250') AS _type,
               "surfaceInout" AS "_surfaceInout", name AS _tournament FROM matches_raw""", a.SQL_MATCHES_RAW))
def snk_4_tournaments(spark, sf_dir):
    """Matches by year, type, surface and tournament directory, all columns, written and read back."""
    levels = [F.substring("date", 1, 4), F.coalesce("typeTournament", F.lit("250")), F.col("surfaceInout"), F.col("name")]
    names = [f"_{name}" for name in lake.TOURNAMENT_LAYOUT]
    path = scratch_path(spark, "entities")
    rows = a.matches_raw(spark, sf_dir).select(*schemas.MATCH_COLUMNS, *[c.alias(n) for c, n in zip(levels, names)])
    sinks.write_entities(rows, path, names)
    return lake.read_entities(spark, path, schemas.MATCH_COLUMNS, lake.TOURNAMENT_LAYOUT)


_SCALED = [*schemas.COUNT_COLUMNS, *schemas.PERCENT_COLUMNS, *schemas.THOUSANDS_COLUMNS, "height", "ranking", "tournCell", "nextBest"]


@query("snk_5", a.with_sql(
    "SELECT " + ", ".join(f'CAST({f}("{c}") AS DOUBLE) AS "{f}_{c}"' for c in _SCALED for f in ("min", "max")) + " FROM stats", a.SQL_STATS))
def snk_5(spark, sf_dir):
    """Scaler bounds of every numeric statistic, written and read back."""
    return _round_trip(spark, fit_minmax(a.stats(spark, sf_dir), _SCALED), "scaler")


def _prediction_rows(spark, sf_dir):
    m = a.matches(spark, sf_dir).select(
        "player0", "player1", F.col("date").alias("start"), (F.col("winnerRate") / 20).alias("odd0"),
        (F.col("looserRate") / 20).alias("odd1"), (F.col("winnerRate") / 100).alias("prediction"), "seq", "surface")
    return m


_PREDICTED_SQL = """
predicted AS (SELECT player0 || player1 || date AS complete_id, "winnerRate" / 100 AS p1, seq, surface, "winnerRate" / 20 AS o0,
              "looserRate" / 20 AS o1 FROM matches)"""


@query("snk_7", a.with_sql(
    """SELECT complete_id, p1 AS probability_score_player_1 FROM predicted""", *M, _PREDICTED_SQL))
def snk_7(spark, sf_dir):
    """Prediction rows of two runs appended to one table."""
    path = scratch_path(spark, "predictions")
    rows = _prediction_rows(spark, sf_dir)
    for part in (F.col("surface") == "Hard", F.col("surface") != "Hard"):
        sinks.append_predictions(decide.decide(rows.filter(part)), path)
    return spark.read.parquet(path).select("complete_id", "probability_score_player_1")


_UPSERTED_SQL = a.with_sql(
    """SELECT complete_id, p1 AS probability_score_player_1, "from" FROM (
         SELECT *, row_number() OVER (PARTITION BY complete_id ORDER BY "from" DESC, p1 DESC) AS rn FROM (
           SELECT complete_id, p1, 1 AS "from" FROM predicted
           UNION ALL SELECT complete_id, 1 - p1, 2 FROM predicted WHERE surface = 'Hard'))
       WHERE rn = 1""", *M, _PREDICTED_SQL)
_UPSERT_KEY = ["complete_id"]
_UPSERT_COLUMNS = ["complete_id", "probability_score_player_1", "from"]


def _upsert_order():
    return [F.col("from"), F.col("probability_score_player_1")]


def _upserted(spark, sf_dir):
    """The path of a table of two batches, the second one applied twice."""
    path = scratch_path(spark, "upserts")
    rows = _prediction_rows(spark, sf_dir)
    first = decide.decide(rows).withColumn("from", F.lit(1))
    again = decide.decide(rows.filter("surface = 'Hard'").withColumn("prediction", 1 - F.col("prediction")))
    sinks.write_version(first.select(*_UPSERT_COLUMNS), path, 1)
    for _ in range(2):
        sinks.write_version(again.withColumn("from", F.lit(2)).select(*_UPSERT_COLUMNS), path, 2)
    return path


@query("snk_8", _UPSERTED_SQL)
def snk_8(spark, sf_dir):
    """Two batches upserted by key; the second one is applied twice."""
    return sinks.read_current(spark, _upserted(spark, sf_dir), _UPSERT_KEY, _upsert_order())


@query("snk_8_compacted", _UPSERTED_SQL)
def snk_8_compacted(spark, sf_dir):
    """The same table compacted: rows that a reader who came before the compaction, the same one after it, and a new one agree on."""
    path, order = _upserted(spark, sf_dir), _upsert_order()
    held = sinks.live(spark, path)
    before = materialize(sinks.read_current(spark, path, _UPSERT_KEY, order), "before")
    sinks.compact_versions(spark, path, _UPSERT_KEY, order)
    during = sinks.read_current(spark, path, _UPSERT_KEY, order, held)
    after = sinks.read_current(spark, path, _UPSERT_KEY, order)
    return before.select(*_UPSERT_COLUMNS).intersectAll(during.select(*_UPSERT_COLUMNS)).intersectAll(after.select(*_UPSERT_COLUMNS))


@query("snk_9", a.with_sql(
    """SELECT complete_id, o0 AS odd_player_0, o1 AS odd_player_1 FROM predicted
       WHERE o0 > 1.2 AND o0 < 3.5 AND o1 > 1.2 AND o1 < 3.5 AND (p1 < 0.4 OR p1 > 0.6)""", *M, _PREDICTED_SQL))
def snk_9(spark, sf_dir):
    """Playable predictions in one write."""
    rows = decide.decide(decide.playable(_prediction_rows(spark, sf_dir)))
    return _round_trip(spark, rows, "published").select("complete_id", "odd_player_0", "odd_player_1")


@query("upsert", a.with_sql(
    """SELECT seq, CASE WHEN surface = 'Hard' THEN 'new' ELSE 'old' END AS state FROM matches""", *M))
def upsert(spark, sf_dir):
    """Keyed merge of two tables."""
    m = a.matches(spark, sf_dir)
    old = m.select("seq", F.lit("old").alias("state"))
    new = m.filter("surface = 'Hard'").select("seq", F.lit("new").alias("state"))
    return decide.upsert(old, new, "seq")
