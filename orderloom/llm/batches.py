"""Arrow batches in and out of Python tasks, row by row."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Cells turned into Python texts at a time: rows and bytes, whichever is first.
ROWS, BYTES = 512, 2_000_000


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(rows: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``rows`` does not have yet, in any letter case."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts, each run small unless one text alone is large."""
    start = size = 0
    for i, length in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        size += length
        if i + 1 - start >= ROWS or size >= BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def map_texts(rows: DataFrame, schema: StructType,
              work: Callable[[list[str | None]], Iterable[list]]) -> DataFrame:
    """``work`` on the last column of ``rows``, a text; other columns pass through.

    ``schema`` is of the result: the passed columns, then one field per list that
    ``work`` gives for a list of texts.
    """
    passed = len(rows.columns) - 1
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(batch.column(passed)):
                part = batch.slice(start, end - start)
                made = work(part.column(passed).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).cast(arrow.field(i).type) for i in range(passed)]
                    + [pa.array(v, arrow.field(passed + i).type) for i, v in enumerate(made)],
                    schema=arrow)

    return rows.mapInArrow(run, schema)
