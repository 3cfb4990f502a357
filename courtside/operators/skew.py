"""Ordered per-key work that survives one key holding a large share of all rows.

A window puts a whole key into one task. Keys with more than ``hot_rows`` rows are therefore cut into ordered pieces of about
``hot_rows`` rows, and the window runs inside a piece while a small per-piece table carries the state across piece borders.

Pieces follow counts: the days of a hot key are counted and summed up in order, and a piece is a run of days. A day that has
more than ``hot_rows`` rows itself is cut between its ids, at places taken from the ids: every id whose hash falls into one
of ``hot_rows / GAPS`` residues is a place, ``GAPS`` places make a piece. A key has about ``2 * rows / hot_rows`` pieces, a
piece about twice ``hot_rows`` rows at most, whatever the lengths of histories, the sizes of days or the spread of ids. There
is no limit on hot keys; NULL keys are keys like others. Ordinary keys take the plain window. Everything is one lazy plan:
when no key is hot, adaptive execution drops the second branch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 2_000_000
#: cutting places per piece of a large day; sums of this many random gaps hardly vary
GAPS = 32

_RUN, _CUT = "_piece_run", "_piece_cut"


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A join by equal keys in which NULL equals NULL; the keys of the right side are dropped."""
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") if k in keys else F.col(k) for k in right.columns])
    on = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"_right_{k}"])
        on = same if on is None else on & same
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys with more than ``hot_rows`` rows; there are at most rows / hot_rows of them."""
    return df.groupBy(*keys).count().filter(F.col("count") > hot_rows).select(*keys)


def _before(by: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _cut_of(value: Column, places: Column) -> Column:
    """How many of the sorted ``places`` are not above ``value``: a look at every n-th place, then at the n after it."""
    size = F.size(places)
    step = F.greatest(F.floor(F.sqrt(size)).cast("int"), F.lit(1))
    blocks = F.size(F.filter(F.transform(F.sequence(F.lit(0), F.greatest(F.floor((size - 1) / step).cast("int"), F.lit(0))), lambda k: F.get(places, k * step)),
                             lambda p: p <= value))
    start = F.greatest(blocks - 1, F.lit(0)) * step
    return start + F.size(F.filter(F.slice(places, start + 1, step), lambda p: p <= value))


def split_hot(
    df: DataFrame, keys: Sequence[str], date: str, tie_break: str, hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys, and rows of hot keys with their piece: columns that never decrease in row order."""
    hot = hot_keys(df, keys, hot_rows)
    day = "_piece_day"
    rows = null_safe(df, hot, keys, "left_semi").withColumn(day, F.coalesce(F.to_date(date), F.lit("0001-01-01").cast("date")))
    days = rows.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("_n"))
    # a large day is the last one of its run: the next one starts beyond it
    runs = days.select(
        *keys, day, (F.col("_n") > hot_rows).alias("_large"),
        F.floor(F.coalesce(F.sum("_n").over(_before(keys, [day])), F.lit(0)) / hot_rows).alias(_RUN))
    large = runs.filter("_large").select(*keys, day)
    residue = F.pmod(F.xxhash64(tie_break), F.lit(max(1, math.ceil(hot_rows / GAPS)))) == 0
    places = (null_safe(rows.filter(residue), large, [*keys, day], "left_semi")
              .groupBy(*keys, day).agg(F.sort_array(F.collect_set(tie_break)).alias("_places")))
    placed = null_safe(null_safe(rows, runs, [*keys, day], "inner"), places, [*keys, day], "left")
    # the ids of a large day come after the rows of the days before it in the same run
    cut = F.when(F.col("_large"), 1 + F.coalesce(F.floor(_cut_of(F.col(tie_break), F.col("_places")) / GAPS), F.lit(0))).otherwise(0)
    return null_safe(df, hot, keys, "left_anti"), placed.withColumn(_CUT, cut.cast("long")).drop(day, "_large", "_places")


def previous_rows(
    df: DataFrame, keys: Sequence[str], date: str, tie_break: str, cols: Sequence[str], k: int,
    out: str = "previous", hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Adds ``out``: the up to ``k`` rows of the key before this one, oldest first, as structs of ``cols``."""
    row = F.struct(*cols)

    def plain(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(date, tie_break).rowsBetween(-k, -1)
        return rows.withColumn(out, F.collect_list(row).over(w))

    if hot_rows is None:
        return plain(df, keys)

    cold, hot = split_hot(df, keys, date, tie_break, hot_rows)
    piece = [*keys, _RUN, _CUT]

    # last k rows of every piece; the row limit is applied map-side before the shuffle
    newest_first = Window.partitionBy(*piece).orderBy(F.desc(date), F.desc(tie_break))
    tails = (
        hot.select(*piece, date, tie_break, row.alias("_row"))
        .withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") <= k)
        .withColumn("_tail_row", F.struct((-F.col("_rank")).alias("pos"), "_row"))
        .groupBy(*piece).agg(F.sort_array(F.collect_list("_tail_row")).alias("_tail"))
    )
    # every piece has at least one row, so the k pieces before it hold the k rows before it
    pieces_before = Window.partitionBy(*keys).orderBy(_RUN, _CUT).rowsBetween(-k, -1)
    carried = F.flatten(F.collect_list(F.col("_tail")).over(pieces_before))
    carry = tails.select(*piece, F.transform(carried, lambda x: x["_row"]).alias("_carry"))

    joined = null_safe(plain(hot, piece), carry, piece, "left")
    both = F.concat(F.coalesce(F.col("_carry"), F.slice(F.col(out), 1, 0)), F.col(out))
    last_k = F.slice(both, F.greatest(F.size(both) - k + 1, F.lit(1)), F.lit(k))
    stitched = joined.withColumn(out, last_k).select(*cold.columns, out)
    return plain(cold, keys).unionByName(stitched)


def running_totals(
    df: DataFrame, keys: Sequence[str], date: str, tie_break: str, totals: dict[str, Column],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Adds, per name in ``totals``, the sum of its expression over the rows of the key before this one (0 if none)."""

    def plain(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        w = _before(by, [date, tie_break])
        return rows.withColumns({n: F.coalesce(F.sum(e).over(w), F.lit(0)) for n, e in totals.items()})

    if hot_rows is None:
        return plain(df, keys)

    cold, hot = split_hot(df, keys, date, tie_break, hot_rows)
    piece = [*keys, _RUN, _CUT]
    sums = hot.groupBy(*piece).agg(*[F.sum(e).alias(f"_sum_{n}") for n, e in totals.items()])
    w = _before(keys, [_RUN, _CUT])
    carry = sums.select(*piece, *[F.coalesce(F.sum(f"_sum_{n}").over(w), F.lit(0)).alias(f"_carry_{n}") for n in totals])
    stitched = null_safe(plain(hot, piece), carry, piece, "left").select(
        *cold.columns, *[(F.col(n) + F.coalesce(F.col(f"_carry_{n}"), F.lit(0))).alias(n) for n in totals])
    return plain(cold, keys).unionByName(stitched)


def rows_per_key_at_most(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank",
) -> DataFrame:
    """First ``k`` rows of every key. Spark limits each map task to ``k`` rows per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def last_row(df: DataFrame, keys: Sequence[str], order: Column, cols: Sequence[str]) -> DataFrame:
    """The row of every key with the greatest ``order``; partial aggregation leaves one row per key and map task."""
    return (
        df.groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("_last"))
        .select(*keys, *[F.col("_last")[c].alias(c) for c in cols])
    )
