"""Shared plumbing: whole texts in Arrow batches, free column names, rows with keys of their own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from courtside.session import ship_package

#: Texts that a task holds as Python objects at a time; memory, not meaning.
SLICE_BYTES = 4 << 20


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores in front until no column of ``df`` has that name (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def quoted(name: str) -> Column:
    """A column by its exact name, also with dots or spaces in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def _slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about SLICE_BYTES of text, one row at least; one very long text is a piece of its own."""
    start, held = 0, 0
    for i, size in enumerate(pa.compute.binary_length(batch.column(at)).to_pylist()):
        if held and held + (size or 0) > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += (size or 0) + 64
    if start < batch.num_rows:
        yield batch.slice(start)


def add_from_text(
    df: DataFrame, text: str, make: Callable[[], Callable[[list[str]], list[list]]], into: str, fields: T.StructType,
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` (or its columns ``keep``) with a struct column ``into`` that Python makes from whole texts, batch by batch.

    ``make`` is called once per task and returns a function from texts (a NULL text comes as the empty one) to the columns
    of ``fields``. Rows keep their order and number; nothing is shuffled.
    """
    ship_package(df.sparkSession)
    names = df.columns if keep is None else keep
    kept = [f for f in df.schema.fields if f.name in names]
    # plain names on the way: the columns of a table may have any
    places = [f"c{k}" for k in range(len(kept))]
    source = df.select(*[quoted(f.name).alias(c) for f, c in zip(kept, places)], quoted(text).cast("string").alias("whole_text"))
    schema = T.StructType([*(T.StructField(c, f.dataType, f.nullable) for f, c in zip(kept, places)), T.StructField("made", fields, False)])
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        at = len(kept)
        for batch in batches:
            for part in _slices(batch, at):
                columns = work(["" if t is None else t for t in part.column(at).to_pylist()])
                made = pa.StructArray.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=fields.names)
                yield pa.RecordBatch.from_arrays([*part.columns[:at], made], names=[*places, "made"])

    return source.mapInArrow(run, schema).toDF(*[f.name for f in kept], into)
