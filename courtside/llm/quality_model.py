"""A quality score from document statistics: random Fourier features, ridge regression, isotonic calibration.

Statistics of a whole text (shares of character classes, word lengths, repetition of words, word pairs and lines, sizes) are
standardised with the moments of the training rows. Random Fourier features ``sqrt(2 / D) * cos(W x + b)`` approximate a
Gaussian kernel over them; together with the statistics themselves and a constant they are the inputs of a ridge regression.
Its normal equations are summed per partition, rows of the sums are added up by Spark, and one matrix of a fixed size reaches the
driver. Raw scores are calibrated by an isotonic fit over ``GRID`` steps of the raw score per unit (counts and sums of labels
per step; a bounded table), and interpolated between its levels, so the score rises with the raw one.

All labelled training rows count; there is no sample. Scores depend on the text only. NULL text counts as empty and gets a
score like any other. Without labels of both kinds every score is the share of label 1, or a half without labels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.texts import add_from_text, quoted
from courtside.session import materialize, ship_package

FEATURES = 192
WIDTH = 4.0
RIDGE = 1e-3
SEED = 41
GRID = 512
FOLDS = 5

# Characters that count as symbols and as sentence marks.
SYMBOLS = b"#*$%&|<>"
SHOUTS = b"!?"
MARKS = b".,;:'\"()-"

STATISTICS = [
    "log_chars", "log_words", "upper", "lower", "digits", "spaces", "line_feeds", "symbols", "shouts", "marks", "beyond_ascii", "word_size",
    "distinct_words", "top_word", "distinct_pairs", "distinct_lines", "line_words", "bare_words",
]


def _classes():
    import numpy as np

    of = lambda chars: np.isin(np.arange(256), list(chars))
    return np.stack([
        of(range(65, 91)), of(range(97, 123)), of(range(48, 58)), of(b" \t\x0b\x0c\r"), of(b"\n"), of(SYMBOLS), of(SHOUTS), of(MARKS),
        np.arange(256) >= 128]).astype(float)


def statistics_of(text: str, classes) -> list[float]:
    """The statistics of one text, in the order of STATISTICS; all are finite, also for an empty text."""
    from collections import Counter

    import numpy as np

    data = text.encode("utf-8", "replace")
    shares = classes @ np.bincount(np.frombuffer(data, np.uint8), minlength=256) / max(len(data), 1)
    words = text.split()
    n = len(words)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    # the share of distinct words falls with the length of any text, so it is measured against a power of it
    return [
        math.log1p(len(text)), math.log1p(n), *shares, math.log1p(sum(map(len, words)) / max(n, 1)),
        len(counts) / max(n, 1) ** 0.8, max(counts.values(), default=0) / max(n, 1), pairs / max(n - 1, 1), len(set(lines)) / max(len(lines), 1),
        math.log1p(n / max(len(lines), 1)), sum(map(str.isalnum, words)) / max(n, 1)]


def with_statistics(df: DataFrame, text: str, into: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and an array of statistics."""

    def make():
        classes = _classes()
        return lambda texts: [[statistics_of(t, classes) for t in texts]]

    fields = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType(), False), False)])
    return add_from_text(df, text, make, into, fields, keep).select(*[quoted(c) for c in keep], F.col(f"{into}.x").alias(into))


@dataclass
class Model:
    """Everything that scoring needs; a few kilobytes whatever the data are."""

    center: list[float]
    scale: list[float]
    weights: list[float]
    knots: list[float]
    levels: list[float]

    def inputs(self, x):
        return _inputs(x, self.center, self.scale)

    def score(self, x):
        import numpy as np

        raw = self.inputs(x) @ np.array(self.weights)
        level = np.interp(raw, self.knots, self.levels)
        # a trace of the raw score keeps the order inside a level
        return 0.98 * level + 0.02 * np.clip((raw + 1) / 3, 0, 1)


def _inputs(x, center, scale):
    """Rows of statistics to rows of inputs: Fourier features, standardised statistics, a constant."""
    import numpy as np

    z = np.clip((np.asarray(x) - center) / scale, -8, 8)
    rng = np.random.default_rng(SEED)
    w = rng.standard_normal((z.shape[1], FEATURES)) / WIDTH
    b = rng.uniform(0, 2 * np.pi, FEATURES)
    return np.hstack([math.sqrt(2 / FEATURES) * np.cos(z @ w + b), z, np.ones((len(z), 1))])


def held_out(row_id: Column) -> Column:
    """Whether a row is never learned from: crc32 of its id as text, modulo FOLDS, is 0. Rows without an id are held out of
    learning as well, but not counted as such."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _matrix(rows: DataFrame, center: list[float], scale: list[float]):
    """The normal equations of rows (x, label): inputs' products among themselves and with the label."""
    import numpy as np

    width = FEATURES + len(center) + 1

    def run(batches):
        import pyarrow as pa

        total = np.zeros((width, width + 1))
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                z = _inputs(x, center, scale)
                total += z.T @ np.hstack([z, batch.column(1).to_numpy(zero_copy_only=False).reshape(-1, 1)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    ship_package(rows.sparkSession)
    sums = rows.mapInArrow(run, "i int, v array<double>").groupBy("i").agg(*[F.sum(F.get("v", F.lit(j))).alias(f"c{j}") for j in range(width + 1)])
    out = np.zeros((width, width + 1))
    # one matrix: its size depends on the number of features only
    for row in sums.collect():
        out[row["i"]] = row[1:]
    return out


def isotonic(steps: list[tuple[float, float, float]]) -> tuple[list[float], list[float]]:
    """Pool adjacent violators over (place, weight, mean), ascending by place: knots and levels."""
    pools: list[list[float]] = []
    for place, weight, mean in steps:
        pools.append([place * weight, weight, mean * weight])
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return [p[0] / p[1] for p in pools], [p[2] / p[1] for p in pools]


def fit(rows: DataFrame) -> Model:
    """A model of training rows (x, label 0 or 1)."""
    import numpy as np

    width = len(STATISTICS)
    columns = [F.get("x", F.lit(k)) for k in range(width)]
    m = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("share"), *[F.avg(c).alias(f"a{k}") for k, c in enumerate(columns)],
                 *[F.stddev_pop(c).alias(f"s{k}") for k, c in enumerate(columns)]).first()
    share = 0.5 if m["share"] is None else m["share"]
    if not m["n"] or not 0 < share < 1:
        return Model([0.0] * width, [1.0] * width, [0.0] * (FEATURES + width + 1), [0.0], [share])
    center = [m[f"a{k}"] for k in range(width)]
    scale = [max(m[f"s{k}"], 1e-6) for k in range(width)]
    sums = _matrix(rows, center, scale)
    penalty = RIDGE * m["n"] * np.eye(len(sums))
    penalty[-1, -1] = 0
    weights = np.linalg.solve(sums[:, :-1] + penalty, sums[:, -1]).tolist()

    def raw(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([pa.array(_inputs(x, center, scale) @ np.array(weights)), batch.column(1)], names=["raw", "label"])

    # raw scores beyond these ends count at the ends, so there are at most 3 * GRID + 1 steps
    step = F.round(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), F.col("raw"))) * GRID)
    steps = (rows.mapInArrow(raw, "raw double, label double").groupBy(step.alias("step"))
             .agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean")).collect())
    knots, levels = isotonic(sorted((r["step"] / GRID, float(r["n"]), r["mean"]) for r in steps))
    return Model(center, scale, weights, knots, levels)


def score(df: DataFrame, model: Model, statistics: str, into: str) -> DataFrame:
    """``df`` with a score from its column of statistics."""
    names, schema = df.columns, T.StructType([*df.schema.fields, T.StructField(into, T.DoubleType(), False)])
    at = names.index(statistics)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                x = batch.column(at).flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], names=[*names, into])

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def scored(documents: DataFrame, labels: DataFrame, row_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per document: id, held_out, score. Learned from the labelled documents that are not held out."""
    rows = documents.select(quoted(row_id).alias("id"), quoted(text).alias("text"))
    known = materialize(with_statistics(rows, "text", "x", ["id"]), "statistics")
    marked = labels.select(quoted(row_id).alias("id"), quoted(label).cast("double").alias("label")).filter("label in (0, 1) and id is not null")
    train = materialize(known.join(marked.filter(~held_out(F.col("id"))), "id").select("x", "label"), "train")
    return score(known.withColumn("held_out", held_out(F.col("id"))), fit(train), "x", "score").select("id", "held_out", "score")
