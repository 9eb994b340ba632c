"""Run a Python kernel over bounded slices of a DataFrame's rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of Arrow data that a kernel sees at once; a single longer row comes alone.
SLICE_BYTES = 2 << 20


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes each, keeping the order."""
    pieces = min(batch.num_rows, -(-batch.nbytes // limit))
    step = -(-batch.num_rows // pieces) if pieces else 1
    for start in range(0, batch.num_rows, step):
        piece = batch.slice(start, step)
        if piece.num_rows > 1 and piece.nbytes > 2 * limit:
            yield from slices(piece, limit)
        else:
            yield piece


def map_slices(
    df: DataFrame, kernel: Callable[[dict[str, list]], dict[str, list]], schema: str
) -> DataFrame:
    """``kernel`` gets the columns as lists by name and returns the output columns by name.

    A column named ``row`` is not given to the kernel but passed on unchanged after its columns.
    """
    out = T.StructType.fromDDL(schema)
    if "row" in df.columns:
        out = T.StructType([*out.fields, df.schema["row"]])
    fields = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                made = kernel({n: piece.column(i).to_pylist() for i, n in enumerate(piece.schema.names) if n != "row"})
                arrays = [piece.column("row").cast(f.type) if f.name == "row" else pa.array(made[f.name], type=f.type) for f in fields]
                yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    return df.mapInArrow(run, out)


def id_and_text(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """(id, text) of documents, and with ``carry`` each whole row as ``row``, whatever its columns are called."""
    row = [F.struct(*(docs[c] for c in docs.columns)).alias("row")] if carry else []
    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"), *row)
