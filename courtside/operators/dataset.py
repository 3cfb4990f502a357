"""Feature rows, training sets, scaling and splitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.functions import rates
from courtside.functions.dates import age_in
from courtside.schemas import (
    FEATURES, HANDS, IN_OUT, LABEL, RANKING_DEFAULT, SURFACES, WIN_MEAN_DEFAULT,
)

ACES_PER_GAME = 4.0
FAULTS_PER_GAME = 3.5
#: form of a player without earlier matches, in training and in prediction
FORM_DEFAULTS = {"Forme0": 0.5, "Forme1": 0.5}


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def with_age(df: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Ages of both players from their birthdays, in the year of the match or in ``as_of_year``."""
    year = F.col("year") if as_of_year is None else F.lit(as_of_year)
    return df.withColumns({f"age{s}": age_in(year, F.col(f"age{s}")) for s in (0, 1)})


def with_mental(df: DataFrame) -> DataFrame:
    return df.withColumns({
        f"mental{s}": rates.mental(*[
            F.col(f"{c}{s}") for c in
            ("breakPointsFaced", "breakPointsConverted", "returnGamesWon", "serviceGamesWon")])
        for s in (0, 1)
    })


def with_serve_rates(df: DataFrame) -> DataFrame:
    """Aces and double faults per service point, each side by its own service games."""
    return df.withColumns({
        **{f"aces{s}": rates.serve_rate(F.col(f"aces{s}"), F.col(f"serviceGamePlayed{s}"), ACES_PER_GAME)
           for s in (0, 1)},
        **{f"doubleFautes{s}": rates.serve_rate(
            F.col(f"doubleFautes{s}"), F.col(f"serviceGamePlayed{s}"), FAULTS_PER_GAME) for s in (0, 1)},
    })


def with_one_hots(df: DataFrame, *, otherwise: bool = False) -> DataFrame:
    """In/out, surface and hand flags from fixed vocabularies, so a value that never occurs still has its column.

    ``otherwise`` sets the last flag of a group for unknown values, as at prediction time.
    """
    if otherwise:
        flags = [
            *rates.in_out_flags(F.col("inOut")), *rates.surface_flags(F.col("surface")),
            *rates.hand_flags(F.col("plays0")), *rates.hand_flags(F.col("plays1"), ".1"),
        ]
    else:
        flags = [
            *rates.one_hot(F.col("inOut"), IN_OUT), *rates.one_hot(F.col("surface"), SURFACES),
            *rates.one_hot(F.col("plays0"), HANDS), *rates.one_hot(F.col("plays1"), HANDS, ".1"),
        ]
    return df.select("*", *flags)


def impute(df: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """Constants for missing values."""
    return df.fillna(defaults)


def feature_defaults() -> dict[str, float]:
    return {
        **{f"ranking{s}": RANKING_DEFAULT for s in (0, 1)},
        **{f"WinMean{s}": WIN_MEAN_DEFAULT for s in (0, 1)},
    }


def conform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns of another table, in its order; a missing one-hot column is 0."""
    have = set(df.columns)
    return df.select(*[_q(c) if c in have else F.lit(0.0).alias(c) for c in columns])


def build_features(df: DataFrame, keep: Sequence[str] = (), *, otherwise: bool = False) -> DataFrame:
    """The 72 feature columns, all double, after the key columns in ``keep``."""
    out = with_one_hots(with_serve_rates(with_mental(df)), otherwise=otherwise)
    if LABEL not in out.columns:
        out = out.withColumn(LABEL, F.lit(0.0))
    typed = out.select(*keep, *[_q(c).cast("double").alias(c) for c in FEATURES])
    return impute(typed, feature_defaults())


def training_set(history: DataFrame, season: DataFrame, required: Sequence[str] = FEATURES) -> DataFrame:
    """History and current season together, complete rows of known rounds only."""
    both = history.unionByName(season)
    known = numeric_phase(both) if "phase" in both.columns else both
    return known.dropna("any", subset=[f"`{c}`" if "." in c else c for c in required])


def numeric_phase(df: DataFrame, phase: str = "phase") -> DataFrame:
    """Rows whose round is a number."""
    return df.filter(F.col(phase).try_cast("int").isNotNull())


def profile(df: DataFrame) -> DataFrame:
    """One row per column with row and null counts, from a single aggregate."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(_q(c)).alias(c) for c in df.columns])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("_rows").alias("rows"), (F.col("_rows") - _q(c)).alias("nulls"))
        for c in df.columns
    ])
    return counted.select(F.inline(pairs))


def null_count(columns: Sequence[str]) -> Column:
    """Number of nulls in a row."""
    return sum((_q(c).isNull().cast("int") for c in columns), F.lit(0))


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the minimum and maximum of every column; this row is the scaler."""
    return df.agg(*[f(_q(c)).cast("double").alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def apply_minmax(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scales columns to 0..1 by fitted bounds; a constant column becomes 0.

    The bounds are one row, the parameters of the fit; they enter the plan as constants.
    """
    bounds = stats.first()

    def scaled(c: str) -> Column:
        low, high = bounds[f"min_{c}"], bounds[f"max_{c}"]
        if low is None:
            return F.lit(None).cast("double").alias(c)
        return ((_q(c) - low) / ((high - low) or 1.0)).alias(c)

    wanted = set(columns)
    return df.select(*[scaled(c) if c in wanted else _q(c) for c in df.columns])


def split(
    df: DataFrame, key: str, test: int = 10, validation: int = 9, out: str = "part",
) -> DataFrame:
    """Adds train / validation / test by a stable hash of the key, in percent of all rows.

    The same match falls into the same part on every run and after any repartitioning.
    """
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % 100
    part = F.when(bucket < test, F.lit("test")).when(bucket < test + validation, F.lit("validation"))
    return df.withColumn(out, part.otherwise(F.lit("train")))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (LABEL,)) -> list[str]:
    """Numeric columns other than the excluded ones: the inputs of a model."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]

