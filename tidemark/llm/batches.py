"""Arrow batches of texts: bounded slices, raw bytes, and columns added beside the others."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType
from tidemark.llm.shipping import map_arrow

#: Bytes of text that are worked on at once; one longer text makes a slice of its own.
SLICE_BYTES = 2 << 20

Worker = Callable[[pa.Array], list[pa.Array]]


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts together stay near ``most`` bytes."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of ``texts`` in a row, and where each begins (one more entry: the end).

    Nulls count as empty.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def spark_schema(df: DataFrame, kept: list[str], fields: list[StructField]) -> StructType:
    return StructType([df.schema[name] for name in kept] + fields)


def with_columns(
    df: DataFrame, text: str, fields: list[StructField], worker: Callable[[], Worker]
) -> DataFrame:
    """``df`` with the columns that ``worker()`` makes of the texts.

    ``worker`` is called once in each task. Columns of ``df`` that have one of the new
    names, in any case, give way to the new ones.
    """
    taken = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in taken]
    names = kept + [f.name for f in fields]
    read = kept if text in kept else [*kept, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = worker()
        for batch in batches:
            for part in slices(batch, text):
                own = [part.column(name) for name in kept]
                yield pa.RecordBatch.from_arrays(own + work(part.column(text)), names)

    return df.select(*(f"`{c}`" for c in read)).transform(map_arrow, run, spark_schema(df, kept, fields))
