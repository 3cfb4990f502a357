"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtside.schemas import DEFAULT_PLAYS, DIRTY_PLAYS

# fixed values: text that stands for a missing value in the raw files
NULL_TOKENS = ("[]", "", "NaN")


def null_tokens(c: Column) -> Column:
    """Text null markers become NULL."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def nan_to_null(c: Column) -> Column:
    """A floating NaN becomes NULL; Spark compares NaN as a large number otherwise."""
    return F.when(~F.isnan(c), c)


def number(c: Column) -> Column:
    """Text as a number; null markers and anything that is no number become NULL."""
    return F.nullif(c.try_cast("double"), F.lit(float("nan")))


def filled(c: Column) -> Column:
    """Text, NULL when it is empty. The text is worked out once, also inside a function over a list, where ``nullif`` does it twice."""
    return F.get(F.filter(F.array(c), lambda x: x != ""), F.lit(0))


def integer(c: Column) -> Column:
    return c.try_cast("int")


def strip(c: Column) -> Column:
    """Trim any white space, line ends included."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def strip_cell(c: Column) -> Column:
    """Text of a table cell without its tags."""
    return strip(F.regexp_replace(c, "</?td>", ""))


def first_cell(cells: Column) -> Column:
    """First cell of an extracted list, cleaned; NULL for an empty list."""
    return strip_cell(F.get(cells, F.lit(0)))


def digits(c: Column) -> Column:
    """Every digit of the text as one number: ``65%`` is 65 and ``65.5%`` is 655."""
    return F.nullif(F.regexp_replace(c, "[^0-9]+", ""), F.lit("")).try_cast("double")


def percent(c: Column) -> Column:
    """``65%`` as the fraction 0.65."""
    return number(F.rtrim(c, F.lit("%"))) / 100


def first_number(c: Column) -> Column:
    """First run of digits, as in ``(190cm)``."""
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")).try_cast("int")


def part(c: Column, separator: str, index: int) -> Column:
    """Part ``index`` of a split on a literal separator, NULL when there is none or it is empty."""
    return filled(F.split_part(c, F.lit(separator), F.lit(index + 1)))


def url_surface(url: Column) -> Column:
    return part(url, "=", 2)


def url_player(url: Column) -> Column:
    return part(url, "/", 5)


def link_name(link: Column) -> Column:
    return part(link, "/", 3)


def badge_points(src: Column) -> Column:
    """``.../categorystamps_250.png`` gives ``250``."""
    name = F.substring_index(F.substring_index(src, "/", -1), "_", -1)
    return F.substring_index(name, ".", 1)


def in_out(surface_in_out: Column) -> Column:
    return part(surface_in_out, " ", 0)


def surface_of(surface_in_out: Column) -> Column:
    return part(surface_in_out, " ", 1)


def thousands(c: Column, compat: bool = False) -> Column:
    """``1,234`` as 1234.0; ``compat`` reads the comma as a decimal point."""
    return number(F.translate(c, ",", "." if compat else ""))


def clean_plays(c: Column) -> Column:
    """Playing hand text with values that are no hand replaced by the default one."""
    trimmed = F.trim(c)
    return F.when(trimmed.isin(*DIRTY_PLAYS), F.lit(DEFAULT_PLAYS)).otherwise(trimmed)


def hand(c: Column) -> Column:
    """First comma part of the playing hand text."""
    return F.trim(F.substring_index(c, ",", 1))


def contains_ignore_case(c: Column, word: str) -> Column:
    return F.lower(c).contains(word.lower())


def stats_url(host: str, link: Column, year: Column, surface: Column) -> Column:
    """Absolute statistics url of a player's overview link."""
    page = F.replace(link, F.lit("overview"), F.lit("player-stats"))
    return F.concat(F.lit(host), page, F.lit("?year="), year.cast("string"), F.lit("&surfaceType="), surface)


def between_brackets(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"\(([^)]*)\)", 1), F.lit(""))


def fixture_side(event_name: Column, side: int, compat: bool = False) -> Column:
    """``Last, First`` tokens of one side of ``Last, First - Last, First``."""
    separator = "-" if compat else " - "
    text = F.translate(F.lower(F.trim(part(event_name, separator, side))), ",", "")
    return F.split(text, " ")


def fixture_player(tokens: Column) -> Column:
    """``first last`` from the tokens of one side; NULL with fewer than two tokens."""
    return F.concat(F.get(tokens, F.lit(1)), F.lit(" "), F.get(tokens, F.lit(0)))


def prediction_id(player0: Column, player1: Column, date: Column) -> Column:
    return F.concat(player0, player1, date)


def dated_id(date: Column, player1: Column, player0: Column) -> Column:
    """Digits of a date followed by both players."""
    return F.concat(F.regexp_replace(date, "[^0-9]", ""), player1, player0)
