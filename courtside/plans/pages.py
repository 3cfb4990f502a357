"""Crawled pages to landed rows: matches of a year, and statistics of the players of a ranking date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions import dates
from courtside.operators import html
from courtside.schemas import MATCH_COLUMNS, STAT_COLUMNS


def match_rows(index: DataFrame, tournaments: DataFrame, versus: DataFrame, host: str) -> DataFrame:
    """The 12 columns of a landed match, from index, tournament and head-to-head pages (url, html)."""
    listed = html.index_rows(index, host)
    links = html.tournament_links(tournaments, host).join(listed, "url")
    return html.versus_rows(versus, links.drop("url", "position")).select(*MATCH_COLUMNS)


def stats_urls(rankings: DataFrame, overviews: DataFrame, host: str, year: int, surface: str, last_rank: int = 300) -> DataFrame:
    """One row per ranked player with statistics: the ranking columns and the url of the statistics page to read, of the listed
    year nearest to ``year``."""
    ranked = html.ranking_rows(rankings, host, last_rank)
    known = html.listed_years(overviews).filter(F.size("years") > 0)
    nearest = dates.nearest_year(F.col("years"), F.lit(year)).cast("string")
    url = F.concat("url", F.lit("?year="), nearest, F.lit("&surfaceType="), F.lit(surface))
    return ranked.join(known, "url").select(url.alias("url"), *html.RANKING_CELLS)


def player_rows(rankings: DataFrame, overviews: DataFrame, statistics: DataFrame, host: str, year: int, surface: str) -> DataFrame:
    """The 31 columns of a landed statistics row, from ranking, player and statistics pages (url, html).

    The year column is that of the ranking date, as the landed file's directory is."""
    wanted = stats_urls(rankings, overviews, host, year, surface)
    return html.player_rows(statistics).join(wanted, "url").withColumn("year", F.lit(str(year))).select(*STAT_COLUMNS)
