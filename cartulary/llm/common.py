"""What the corpus operators share: materialised tables, text batches, hashing rules."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.tables import materialize, shared_folder  # noqa: F401  (what operators import from here)

#: Rows that a Python operator turns into Python objects at a time.
SLICE_ROWS = 128


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches into runs of a few rows, so that long texts never meet in one list."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def record_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """A batch from lists, numpy arrays or Arrow columns by name."""
    got = [columns[f.name].cast(f.type) if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], type=f.type) for f in schema]
    return pa.RecordBatch.from_arrays(got, schema=schema)


def renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns c0, c1, ..., so that no name of theirs meets an operator's own; and {old name: new name}."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, mod 5: the folds that the queries hold out by. A null id counts as 0's text ''."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5, F.lit(0)).cast("int")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
