"""Page queries: the real page operators over pages built from the raw match and statistics texts.

The pages have what makes extraction hard: attributes everywhere, cells without links before those with one, prize cells, boxes
with markup in them, tied ranks. A page holds a bounded number of rows whatever the size of the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from courtside.operators import html
from courtside.plans import pages as chains
from courtside.workload import analogue as a
from courtside.workload.registry import query

HOST = "https://example.test"
ROWS_PER_PAGE = 100
# position of the first match of a round on a tournament page
FIRST_OF_ROUND = {"Finals": 0, "Semi-Finals": 1, "Quarterfinals": 3, "Round of 16": 7}
M = (a.SQL_MATCHES_RAW,)


def _text(pattern: str, **parts) -> F.Column:
    """``pattern`` with ``{name}`` replaced by columns."""
    out, rest = [], pattern
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        out += [F.lit(before), F.coalesce(parts[name].cast("string"), F.lit(""))]
    return F.concat(*out, F.lit(rest))


def _many(items) -> F.Column:
    """Texts of a page in the order of their numbers: (number, text) pairs."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(items)), lambda x: x["t"]), "\n")


def _matches(spark, sf_dir):
    return a.matches_raw(spark, sf_dir)


def index_pages(spark, sf_dir):
    row = _text(
        '<tr class="tourney-result"><td class="title"><a href="/en/wrong/{seq}">t</a></td><td><div class="tourney-details">none</div></td>'
        '<td class="c"><div class="tourney-details" data-x="1">\n<a class="y" href="/en/t/{seq}/overview">z</a></div></td><td>$100</td>'
        '<td class="w"><div class="o"><div class="item-details">\n {io} <span class="item-value"> {surface} </span></div></div></td><td>end</td></tr>',
        seq=F.col("seq"), io=F.split_part("surfaceInout", F.lit(" "), F.lit(1)), surface=F.split_part("surfaceInout", F.lit(" "), F.lit(2)))
    page = F.floor(F.col("seq") / ROWS_PER_PAGE).alias("page")
    rows = _matches(spark, sf_dir).groupBy(page).agg(_many(F.struct("seq", row.alias("t"))).alias("rows"))
    return rows.select(F.lit(f"{HOST}/archive").alias("url"), _text(
        '<html><body><table class="other"><tr><td>1</td></tr></table><table id="a" class="results-archive-table mega-table"><tbody>{rows}</tbody></table>',
        rows=F.col("rows")).alias("html"))


def tournament_pages(spark, sf_dir):
    position = F.lit(0)
    for phase, at in FIRST_OF_ROUND.items():
        position = F.when(F.col("phase") == phase, F.lit(at)).otherwise(position)
    fillers = F.transform(F.sequence(F.lit(1), position), lambda i: F.concat(
        F.lit('<td class="day-table-button"><a href="/en/players/filler/'), i.cast("string"), F.lit('">H2H</a></td>')))
    before = F.when(position > 0, F.array_join(fillers, "")).otherwise(F.lit(""))
    heads = F.when(F.col("phase").isin(*FIRST_OF_ROUND), F.lit("|".join(FIRST_OF_ROUND))).otherwise(F.col("phase"))
    rounds = F.array_join(F.transform(F.split(F.concat(heads, F.lit("|1st Round Qualifying")), r"\|"), lambda r: F.concat(
        F.lit('<thead class="h"><tr><th colspan="9"> '), r, F.lit(" </th></tr></thead><tbody><tr><th>not a round</th></tr></tbody>"))), "")
    badge = F.when(F.col("typeTournament").isNotNull(), _text(
        '<td class="tourney-badge-wrapper" x="1"><img alt="b" src="/img/categorystamps_{badge}.png"></td>', badge=F.col("typeTournament"))).otherwise(F.lit(""))
    return _matches(spark, sf_dir).select(_text(HOST + "/en/t/{seq}/overview", seq=F.col("seq")).alias("url"), _text(
        '{badge}<table><tr id="r" class="tourney-result with-icons"><td><a href="/en/tournaments/wrong/1">w</a></td><td class="n">'
        '<a class="q" href="/en/tournaments/{name}/1/overview">x</a></td></tr></table><span id="d" class="tourney-dates">\n {date} <br></span>'
        '<table class="day-table">{rounds}</table><td class="day-table-button"><a href="/en/scores/1">score</a></td><td class="day-table-button"></td>{before}'
        '<td class="day-table-button"><a title="h" href="/en/players/h2h/{seq}">H2H</a></td>',
        badge=badge, name=F.col("name"), date=F.col("date"), rounds=rounds, before=before, seq=F.col("seq")).alias("html"))


def versus_pages(spark, sf_dir):
    n = F.pmod("seq", F.lit(4))
    won = F.least(n, F.pmod("seq", F.lit(3)))
    meeting = ('<tr><td>1</td><td>event</td><td class="s"><span class="v"> {surface} </span></td><td>F</td>'
               '<td class="win"><a href="/en/players/{player}/x1">n</a></td></tr>')
    rows = F.concat(*[
        F.repeat(_text(meeting, surface=s, player=F.col(p)), k.cast("int"))
        for s, p, k in ((F.col("surfaceInout"), "winnerName", won), (F.col("surfaceInout"), "looserName", n - won), (F.lit("Outdoor Sand"), "looserName", F.lit(1)))])

    def block(side, name, rate):
        return (f'<div class="player-{side}-name"><a class="u" href="/en/players/{{{name}}}/x1/overview">n</a></div>'
                f'<div class="player-{side}-wins" data-a="1"><div class="w"><div class="l"><b>Wins</b></div><div class="v">\n {{{rate}}} </div></div></div>')

    return _matches(spark, sf_dir).select(_text(HOST + "/en/players/h2h/{seq}", seq=F.col("seq")).alias("url"), _text(
        block("left", "winner", "wr") + block("right", "looser", "lr")
        + '<table><tr><td>x</td></tr></table><table class="modal-event-breakdown-table"><tbody>{rows}</tbody></table>',
        winner=F.col("winnerName"), looser=F.col("looserName"), wr=F.col("winnerRate"), lr=F.col("looserRate"), rows=rows).alias("html"))


@query("htm_1", a.with_sql(f"""SELECT '{HOST}/en/t/' || CAST(seq AS VARCHAR) || '/overview' AS url, "surfaceInout" FROM matches_raw""", *M))
def htm_1(spark, sf_dir):
    """Tournament rows of index pages."""
    return html.index_rows(index_pages(spark, sf_dir), HOST)


@query("htm_2", a.with_sql(f"""
SELECT '{HOST}/en/t/' || CAST(seq AS VARCHAR) || '/overview' AS url, '{HOST}/en/players/h2h/' || CAST(seq AS VARCHAR) AS link,
       CAST(CASE phase {' '.join(f"WHEN '{p}' THEN {k}" for p, k in FIRST_OF_ROUND.items())} ELSE 0 END AS INTEGER) AS position,
       name, date, "typeTournament", phase FROM matches_raw""", *M))
def htm_2(spark, sf_dir):
    """Match links of tournament pages with name, date, badge and round."""
    return html.tournament_links(tournament_pages(spark, sf_dir), HOST).filter(F.col("link").contains("/h2h/"))


_VERSUS_SQL = f"""
SELECT name, phase, "surfaceInout", coalesce("typeTournament", '250') AS "typeTournament", date, "winnerRate", "looserRate", "looserName",
       "winnerName", CAST(least(seq % 4, seq % 3) AS DOUBLE) / nullif(seq % 4, 0) AS "winnerRateSurface",
       CAST(seq % 4 - least(seq % 4, seq % 3) AS DOUBLE) / nullif(seq % 4, 0) AS "looserRateSurface",
       '{HOST}/en/players/h2h/' || CAST(seq AS VARCHAR) AS url FROM matches_raw"""


@query("htm_3", a.with_sql(_VERSUS_SQL, *M))
def htm_3(spark, sf_dir):
    """Head-to-head pages with the links that lead to them."""
    links = _matches(spark, sf_dir).select(
        _text(HOST + "/en/players/h2h/{seq}", seq=F.col("seq")).alias("link"), "name", "date", "typeTournament", "phase", "surfaceInout")
    return html.versus_rows(versus_pages(spark, sf_dir), links)


@query("join_12", a.with_sql(_VERSUS_SQL, *M))
def join_12(spark, sf_dir):
    """Index, tournament and head-to-head pages composed into landed matches."""
    return chains.match_rows(index_pages(spark, sf_dir), tournament_pages(spark, sf_dir), versus_pages(spark, sf_dir), HOST)


# --- players -----------------------------------------------------------------------------------------------------------------

S = (a.SQL_STATS_RAW,)


def ranking_pages(rows):
    """Ranking pages of statistics rows: even ranks are tied, every 25th has no digits."""
    rank = F.col("ranking").cast("int")
    tied = F.when(rank % 2 == 0, F.lit("T")).otherwise(F.lit(""))
    shown = F.when(rank % 25 == 0, F.lit("-")).otherwise(F.concat((2 * rank).cast("string"), tied))
    row = _text(
        '<tr class="r"><td class="rank-cell" x="1">\n {rank} </td><td class="player-cell"><a class="p" href="/en/players/{player}/overview">n</a></td>'
        '<td class="points-cell"><a href="#">{points}</a></td><td class="tourn-cell"><a href="#"> {tourn} </a></td>'
        '<td class="pts-cell"> {drop} </td><td class="next-cell"><b>{next}</b></td></tr>',
        rank=shown, player=F.col("player"), points=F.col("points"), tourn=F.col("tournCell"), drop=F.col("pointsDropping"), next=F.col("nextBest"))
    page = F.pmod(F.xxhash64("player"), F.lit(16)).alias("page")
    pages = rows.groupBy("year", F.split_part("seq", F.lit("/"), F.lit(3)).alias("week"), "surface", F.substring("player", 1, 13).alias("block"), page).agg(
        _many(F.struct("seq", row.alias("t"))).alias("rows"))
    return pages.select(F.lit(HOST).alias("url"), _text(
        '<table><tr><th class="rank-cell">Rank</th></tr><tr><td class="rank-cell">0</td><td class="player-cell">nobody</td></tr>{rows}</table>',
        rows=F.col("rows")).alias("html"))


_RANKING_SQL = """
SELECT 'https://example.test/en/players/' || player || '/player-stats' AS url, shown AS ranking{more} FROM (
  SELECT *, CASE WHEN CAST(ranking AS INTEGER) % 25 = 0 THEN '-' ELSE CAST(2 * CAST(ranking AS INTEGER) AS VARCHAR)
                 || CASE WHEN CAST(ranking AS INTEGER) % 2 = 0 THEN 'T' ELSE '' END END AS shown FROM stats_raw)
WHERE shown = '-' OR 2 * CAST(ranking AS INTEGER) <= {last}"""


@query("htm_4", a.with_sql(_RANKING_SQL.format(more=', points, "tournCell", "pointsDropping", "nextBest"', last=300), *S))
def htm_4(spark, sf_dir):
    """Rows of ranking pages, tied ranks included."""
    return html.ranking_rows(ranking_pages(a.stats_raw(spark, sf_dir)), HOST)


@query("lim_2", a.with_sql(_RANKING_SQL.format(more="", last=100), *S))
def lim_2(spark, sf_dir):
    """Ranking pages down to a rank."""
    return html.ranking_rows(ranking_pages(a.stats_raw(spark, sf_dir)), HOST, 100).select("url", "ranking")


def statistics_pages(rows):
    def table(number):
        cells = [c for c, (t, _) in html.PLAYER_CELLS.items() if t == number]
        return "<table class=\"t\"><tbody>" + "".join(f'<tr class="x"><td>label</td><td class="v">\n {{{c}}} </td></tr>' for c in cells) + "</tbody></table>"

    bio = ('<table><tr><td>1</td><td>2</td></tr></table><span class="table-weight-lbs">{weight}</span><span class="table-height-cm-wrapper">{height}</span>'
           '<span class="table-birthday">\n {age} </span><div class="table-big-value">1</div><div class="table-big-value">2</div>'
           '<div class="table-big-value" x="y"> {startCareer} </div><div class="table-value">a</div><div class="table-value">b</div><div class="table-value">{plays}</div>')
    columns = [*html.PLAYER_CELLS, "weight", "height", "age", "startCareer", "plays"]
    return rows.select("url", _text(bio + '<div class="c" id="playerMatchFactsContainer">' + table(0) + table(1) + "</div>",
                                    **{c: F.col(c) for c in columns}).alias("html"))


_PLAYER_COLUMNS = ["player", *html.PLAYER_CELLS, "url", "weight", "height", "age", "startCareer", "plays"]


@query("htm_5", a.with_sql("SELECT " + ", ".join(f'"{c}"' for c in _PLAYER_COLUMNS) + " FROM stats_raw", *S))
def htm_5(spark, sf_dir):
    """Statistic cells by table and row, and the fields of a biography."""
    return html.player_rows(statistics_pages(a.stats_raw(spark, sf_dir)))


_CHAIN = [c for c in _PLAYER_COLUMNS if c not in ("player", "url")]


@query("join_12_players", a.with_sql(f"""
SELECT s.player, s.url, {', '.join(f's."{c}"' for c in _CHAIN)}, '1998' AS year, r.shown AS ranking, r.points, r."tournCell", r."pointsDropping", r."nextBest"
FROM (SELECT *, CASE WHEN CAST(ranking AS INTEGER) % 25 = 0 THEN '-' ELSE CAST(2 * CAST(ranking AS INTEGER) AS VARCHAR)
                     || CASE WHEN CAST(ranking AS INTEGER) % 2 = 0 THEN 'T' ELSE '' END END AS shown
      FROM stats_raw WHERE year = '1998' AND seq LIKE '%/1-1/hard/%') r
JOIN (SELECT * FROM stats_raw WHERE seq LIKE '%/1-1/hard/%') s
  ON s.player = r.player AND s.year = CASE WHEN right(r.player, 1) IN ('1', '3', '5', '7', '9') THEN '1997' ELSE '1998' END
WHERE shown = '-' OR 2 * CAST(r.ranking AS INTEGER) <= 300""", *S))
def join_12_players(spark, sf_dir):
    """Ranking, player and statistics pages composed into landed statistics of one date; odd players lack that year."""
    rows = a.stats_raw(spark, sf_dir).filter(F.col("seq").contains("/1-1/hard/"))
    odd = F.substring("player", -1, 1).isin("1", "3", "5", "7", "9")
    years = F.when(odd, F.lit("<li>2004</li><li> 1997 </li>")).otherwise(F.lit("<li>2004</li><li> 1997 </li><li>1998</li>"))
    overviews = rows.select("player").distinct().select(
        _text(HOST + "/en/players/{player}/player-stats", player=F.col("player")).alias("url"),
        _text('<div id="playerMatchFactsFilter"><ul class="u"><li>Career</li>{years}</ul></div><ul><li>1999</li></ul>', years=years).alias("html"))
    return chains.player_rows(ranking_pages(rows.filter("year = '1998'")), overviews, statistics_pages(rows), HOST, 1998, "hard")


# --- odds --------------------------------------------------------------------------------------------------------------------

@query("arr_4", a.with_sql("""
SELECT CAST(page AS VARCHAR) AS url, string_agg(name, '|' ORDER BY seq) AS tournement,
       string_agg("winnerRate" || '|' || "looserRate", '|' ORDER BY seq) AS odds,
       string_agg("winnerName" || ' - ' || "looserName", '|' ORDER BY seq) AS player
FROM (SELECT *, seq // 100 AS page FROM matches_raw) GROUP BY page""", *M))
def arr_4(spark, sf_dir):
    """Three parallel lists of an odds archive page."""
    article = _text(
        '<article class="a"><div><span class="t"><span>date</span><span class="n"> {name} </span></span></div><div><table><tr><td class="d">12:00</td>'
        '<td><a href="#">{winner} - {looser}</a></td><td><b>{first}</b></td><td class="o"><b> {second} </b></td></tr></table></div></article>',
        name=F.col("name"), winner=F.col("winnerName"), looser=F.col("looserName"), first=F.col("winnerRate"), second=F.col("looserRate"))
    page = F.floor(F.col("seq") / ROWS_PER_PAGE).cast("string").alias("url")
    pages = _matches(spark, sf_dir).groupBy(page).agg(_many(F.struct("seq", article.alias("t"))).alias("rows")).select("url", _text(
        '<table><tr><td><b>9.9</b></td></tr></table><span><span>x</span><span>menu</span></span><div class="m" id="main">{rows}</div>', rows=F.col("rows")).alias("html"))
    return html.odds_rows(pages).select("url", *[F.array_join(c, "|").alias(c) for c in ("tournement", "odds", "player")])
