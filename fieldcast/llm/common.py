"""Helpers that the corpus operators share: stored tables, text columns in Arrow batches, word rules."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.session import scratch_path, send_with_tasks

send_with_tasks(__name__)

#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE = 500
#: Words are runs of anything but ASCII white space, which is what ``bytes.split()`` cuts at.
WORD = r"[^\x20\x09-\x0D]+"

TextJob = Callable[[list[str | None]], list[list[Any]]]


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it back.

    Later jobs, and tasks that run again after an executor is lost, all see the same rows,
    and Spark knows the size of what it joins.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True where a document's label is kept from training: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def each_text(frame: DataFrame, text: Column, make: Callable[[], TextJob], fields: list[T.StructField]) -> DataFrame:
    """Append columns that Python computes from a text, in Arrow batches.

    ``make()`` runs once in each task and returns a function from a list of texts to one list of values
    for each field.  Columns of ``frame`` pass through as they are; one whose name equals a
    field's (in any letter case) gives way to it.
    """
    taken = {f.name.lower() for f in fields}
    kept = [c for c in frame.columns if c.lower() not in taken]
    source = frame.select(*kept, text.alias("lm given text"))
    schema = T.StructType([source.schema[c] for c in kept] + fields)
    names = schema.names
    types = [_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        job = make()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                got = job(batch.column(len(kept)).to_pylist())
                made = [pa.array(values, kind) for values, kind in zip(got, types, strict=True)]
                yield pa.RecordBatch.from_arrays(batch.columns[: len(kept)] + made, names=names)

    return source.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    simple = {
        T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(),
        T.BinaryType(): pa.binary(), T.StringType(): pa.string(), T.BooleanType(): pa.bool_(),
    }
    return pa.list_(simple[kind.elementType]) if isinstance(kind, T.ArrayType) else simple[kind]
