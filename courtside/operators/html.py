"""Page extraction by patterns. Real pages are not well-formed XML, so text patterns are used instead of ``xpath``."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions import arrays, dates, text


@dataclass(frozen=True)
class Selector:
    """Where a field is: a pattern whose group 1 is the value."""

    pattern: str
    many: bool = True


def _class(name: str, inner: str) -> str:
    return rf'(?s)class="{name}"[^>]*>{inner}'


_TEXT = r"\s*([^<]*?)\s*<"

# fixed values: class names, cell numbers (from 0) and ids of the page layouts
INDEX_TABLE, INDEX_LINK, INDEX_PLACE_CELL = "results-archive-table mega-table", "tourney-details", 4
RESULT_ROW, RESULT_NAME_CELL, DATES, BADGE = "tourney-result with-icons", 1, "tourney-dates", "tourney-badge-wrapper"
ROUNDS_TABLE, ROUND_LINK = "day-table", "day-table-button"
WINS, NAMES = {"winner": "player-left-wins", "looser": "player-right-wins"}, {"winner": "player-left-name", "looser": "player-right-name"}
MEETINGS_TABLE, MEETING_SURFACE_CELL, MEETING_WINNER_CELL = "modal-event-breakdown-table", 2, 4
RANKING_CELLS = {
    "ranking": "rank-cell", "points": "points-cell", "tournCell": "tourn-cell", "pointsDropping": "pts-cell", "nextBest": "next-cell"}
RANKING_LINK = "player-cell"
FACTS, FACTS_FILTER = "playerMatchFactsContainer", "playerMatchFactsFilter"
PLAYER_PAGE = {
    "weight": Selector(_class("table-weight-lbs", _TEXT)),
    "height": Selector(_class("table-height-cm-wrapper", _TEXT)),
    "age": Selector(_class("table-birthday", _TEXT)),
    "big": Selector(_class("table-big-value", _TEXT)),
    "values": Selector(_class("table-value", r"([^<]*)<")),
}

# fixed values: statistic -> (table, row) of the two tables on a player page
PLAYER_CELLS = {
    "aces": (0, 0), "doubleFautes": (0, 1), "firstServe": (0, 2), "firstServePointsWon": (0, 3),
    "secondServePointsWon": (0, 4), "breakPointsFaced": (0, 5), "breakPointsSaved": (0, 6),
    "serviceGamePlayed": (0, 7), "serviceGamesWon": (0, 8), "totalServicePointsWon": (0, 9),
    "firstServeReturnPointsWon": (1, 0), "secondServeReturnPointsWon": (1, 1),
    "breakPointsOpportunities": (1, 2), "breakPointsConverted": (1, 3), "returnGamesPlayed": (1, 4),
    "returnGamesWon": (1, 5), "returnPointsWon": (1, 6), "totalPointsWon": (1, 7),
}


def select_all(html: Column, selector: Selector) -> Column:
    """Every match of a selector, or the first one as text."""
    if selector.many:
        return F.regexp_extract_all(html, F.lit(selector.pattern), F.lit(1))
    return F.nullif(F.regexp_extract(html, selector.pattern, 1), F.lit(""))


def extract(pages: DataFrame, selectors: Mapping[str, Selector], html: str = "html") -> DataFrame:
    """One column per selector in place of the page text."""
    return pages.withColumns({n: select_all(F.col(html), s) for n, s in selectors.items()}).drop(html)


def exploded(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per position of parallel lists, with the position."""
    kept = [c for c in df.columns if c not in columns]
    zipped = F.arrays_zip(*[F.col(c) for c in columns])
    rows = df.select(*kept, F.posexplode(zipped).alias("position", "_item"))
    return rows.select(*kept, "position", *[F.col("_item")[c].alias(c) for c in columns])


def every(part: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(part, F.lit(pattern), F.lit(group))


def first_in(part: Column, pattern: str, group: int = 1) -> Column:
    """The first match, NULL when there is none."""
    return text.filled(F.regexp_extract(part, pattern, group))


def _element(name: str, tag: str) -> str:
    return rf'(?s)<({tag})\b[^>]*\bclass="{name}"[^>]*>(.*?)</\1>'


def elements(part: Column, name: str, tag: str = r"\w++") -> Column:
    """Inner markup of every element with exactly this class, up to its own end tag."""
    return every(part, _element(name, tag), 2)


def element(part: Column, name: str, tag: str = r"\w++") -> Column:
    """Inner markup of the first of these elements, empty when there is none; the rest of the part is not searched."""
    return F.regexp_extract(part, _element(name, tag), 2)


def rows_of(part: Column) -> Column:
    return every(part, r"(?s)<tr\b[^>]*>(.*?)</tr>")


def cells_of(row: Column) -> Column:
    return every(row, r"(?s)<td\b[^>]*>(.*?)</td>")


def link_in(part: Column) -> Column:
    """Address of the first link inside a part that was cut out before, so the match cannot leave it."""
    return text.strip(first_in(part, r'(?s)<a\b[^>]*\bhref="([^"]*)"'))


def text_of(part: Column) -> Column:
    """Text of a part without its tags, NULL when nothing is left."""
    return text.filled(text.strip(F.regexp_replace(part, "<[^>]*>", "")))


def _known(items: Column) -> Column:
    return F.filter(items, lambda x: x.isNotNull())


def index_rows(pages: DataFrame, host: str) -> DataFrame:
    """Tournament index page: one row per table row with a tournament link, with its absolute url and in/out + surface text."""
    table = F.concat_ws("", elements(F.col("html"), INDEX_TABLE, "table"))
    rows = pages.select(F.explode(rows_of(table)).alias("row"))
    link = F.get(_known(F.transform(elements(F.col("row"), INDEX_LINK), link_in)), F.lit(0))
    place = F.get(cells_of(F.col("row")), F.lit(INDEX_PLACE_CELL))
    inside = first_in(place, r"(?s)<div\b[^>]*>\s*<div\b[^>]*>\s*([^<]*?)\s*<")
    surface = first_in(place, r"(?s)<span\b[^>]*>\s*([^<]*?)\s*</span>")
    return rows.select(F.concat(F.lit(host), link).alias("url"), F.concat_ws(" ", inside, surface).alias("surfaceInout")).filter(
        "url IS NOT NULL")


def tournament_links(pages: DataFrame, host: str, *, compat: bool = False) -> DataFrame:
    """Tournament page: one row per match link with name, date, badge and round."""
    page = F.col("html")
    result = element(page, RESULT_ROW, "tr")
    heads = F.transform(elements(page, ROUNDS_TABLE, "table"), lambda t: every(t, r"(?s)<thead\b[^>]*>(.*?)</thead>"))
    rounds = F.flatten(F.transform(F.flatten(heads), lambda h: F.transform(every(h, r"(?s)<th\b[^>]*>(.*?)</th>"), text_of)))
    links = _known(F.transform(elements(page, ROUND_LINK), lambda x: F.concat(F.lit(host), link_in(x))))
    rows = pages.select(
        "url", text.link_name(link_in(F.get(cells_of(result), F.lit(RESULT_NAME_CELL)))).alias("name"),
        first_in(page, _class(DATES, _TEXT)).alias("date"),
        text.badge_points(first_in(element(page, BADGE), r'(?s)<img\b[^>]*\bsrc="([^"]*)"')).alias("typeTournament"),
        _known(rounds).alias("rounds"), arrays.keep_containing(links, "players").alias("links"))
    return rows.select("url", "name", "date", "typeTournament", "rounds", F.posexplode("links").alias("position", "link")).select(
        "url", "link", "position", "name", "date", "typeTournament", arrays.round_of(F.col("rounds"), F.col("position"), compat).alias("phase"))


def _wins(page: Column, name: str) -> Column:
    """Second inner box of a player's block; the block ends where the next player block or table starts."""
    block = first_in(page, rf'(?s)class="{name}"[^>]*>(.*?)(?:class="player-|<table\b|</body|$)')
    return text_of(F.get(every(block, r"(?s)<div\b[^>]*>((?:(?!</?div\b).)*)</div>"), F.lit(1)))


def versus_rows(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Head-to-head page joined with the tournament page that links to it: one raw match row."""
    page = F.col("html")
    # the cells of a meeting are cut out once for both fields
    meetings = F.transform(rows_of(F.concat_ws("", elements(page, MEETINGS_TABLE, "table"))), cells_of)
    rows = pages.select(
        F.col("url").alias("link"),
        *[_wins(page, name).alias(f"{side}Rate") for side, name in WINS.items()],
        *[text.link_name(link_in(element(page, name))).alias(f"{side}Name") for side, name in NAMES.items()],
        F.transform(meetings, lambda cells: F.struct(
            first_in(F.get(cells, F.lit(MEETING_SURFACE_CELL)), r"(?s)<span\b[^>]*>\s*([^<]*?)\s*</span>").alias("surface"),
            text.link_name(link_in(F.get(cells, F.lit(MEETING_WINNER_CELL)))).alias("winner"))).alias("meetings"))
    joined = rows.join(links, "link")
    share = {
        f"{side}RateSurface": arrays.surface_share(
            F.col("meetings.winner"), F.col("meetings.surface"), F.col("surfaceInout"), F.col(f"{side}Name"))
        for side in ("winner", "looser")
    }
    return joined.withColumns(share).select(
        "name", "phase", "surfaceInout", F.coalesce("typeTournament", F.lit("250")).alias("typeTournament"), "date",
        "winnerRate", "looserRate", "looserName", "winnerName", "winnerRateSurface", "looserRateSurface",
        F.col("link").alias("url"))


def ranking_rows(pages: DataFrame, host: str, last_rank: int | None = 300) -> DataFrame:
    """Ranking page: one row per table row with a player link, with the five ranking columns, down to ``last_rank``.

    A tied rank (``2T``) counts by its digits; a rank without digits is kept.
    """
    rows = pages.select(F.explode(rows_of(F.col("html"))).alias("row"))
    link = link_in(element(F.col("row"), RANKING_LINK))
    cells = {c: text_of(element(F.col("row"), name)) for c, name in RANKING_CELLS.items()}
    url = F.replace(F.concat(F.lit(host), link), F.lit("overview"), F.lit("player-stats"))
    out = rows.select(url.alias("url"), *[v.alias(c) for c, v in cells.items()]).filter("url IS NOT NULL")
    return out if last_rank is None else out.filter(F.coalesce(text.first_number(F.col("ranking")) <= last_rank, F.lit(True)))


def table_cell(tables: Column, table: int, row: int) -> Column:
    """Second cell of a row of tables that are lists of rows."""
    return text_of(F.get(cells_of(F.get(F.get(tables, F.lit(table)), F.lit(row))), F.lit(1)))


def listed_years(pages: DataFrame) -> DataFrame:
    """Player page: url and the years it has statistics for, without the first entry, which stands for all years."""
    part = first_in(F.col("html"), rf'(?s)id="{FACTS_FILTER}"[^>]*>(.*?)</ul>')
    items = F.transform(every(part, r"(?s)<li\b[^>]*>(.*?)</li>"), lambda x: text_of(x).try_cast("int"))
    return pages.select("url", _known(arrays.without_first(items)).alias("years"))


def player_rows(pages: DataFrame) -> DataFrame:
    """Player page: 18 statistic cells and the biography fields, keyed by url."""
    body = F.regexp_extract("html", rf'(?s)id="{FACTS}"[^>]*>(.*)$', 1)
    # the rows of a table are cut out once for all of its cells
    tables = F.transform(every(body, r"(?s)<table\b[^>]*>(.*?)</table>"), rows_of)
    cells = pages.withColumn("_tables", tables).withColumns({
        c: table_cell(F.col("_tables"), *at) for c, at in PLAYER_CELLS.items()}).drop("_tables")
    bio = extract(cells, PLAYER_PAGE)
    return bio.select(
        text.url_player(F.col("url")).alias("player"), *PLAYER_CELLS, "url",
        *[F.get(c, F.lit(0)).alias(c) for c in ("weight", "height", "age")],
        F.get("big", F.lit(2)).alias("startCareer"), F.get("values", F.lit(2)).alias("plays"))


def odds_rows(pages: DataFrame) -> DataFrame:
    """Odds archive page as three parallel lists, from the articles of its main part."""
    main = F.regexp_extract("html", r'(?s)<div\b[^>]*\bid="main"[^>]*>(.*)$', 1)
    articles = every(main, r"(?s)<article\b[^>]*>(.*?)</article>")
    rows = pages.select("url", articles.alias("_articles"))
    cells = F.flatten(F.transform("_articles", lambda a: F.flatten(F.transform(every(a, r"(?s)<table\b[^>]*>(.*?)</table>"), cells_of))))

    def inside(tag: str) -> Column:
        return F.flatten(F.transform(cells, lambda c: every(c, rf"(?s)<{tag}\b[^>]*>\s*([^<]*?)\s*</{tag}>")))

    names = F.flatten(F.transform("_articles", lambda a: every(
        a, r"(?s)<span\b[^>]*>\s*<span\b[^>]*>[^<]*</span>\s*<span\b[^>]*>\s*([^<]*?)\s*</span>")))
    return rows.select("url", names.alias("tournement"), inside("b").alias("odds"), inside("a").alias("player"))


def ranking_date(pages: DataFrame, year: int) -> DataFrame:
    """First listed ranking date of a year."""
    listed = F.regexp_extract_all("html", F.lit(r"<li[^>]*>\s*(\d{4}\.\d{2}\.\d{2})\s*</li>"), F.lit(1))
    return pages.select(dates.first_date_in(dates.parse_dates(listed), F.lit(year)).alias("date")).dropna()
