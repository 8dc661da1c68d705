"""Map functions over Arrow batches that leave ids as they are (no detour of nullable ids over floats)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def map_columns(df: DataFrame, schema: str, make: Callable[[pa.RecordBatch], Iterable[list]]) -> DataFrame:
    """`make` gives, for a batch, lists of columns (Arrow arrays or Python lists) in the order of the schema."""
    target = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in make(batch):
                arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, target)]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, column: str, keep: Callable[[str], bool]) -> DataFrame:
    """The rows whose text passes, all columns as they were; null counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([keep(t or "") for t in batch.column(column).to_pylist()], type=pa.bool_()))

    return df.mapInArrow(run, df.schema)
