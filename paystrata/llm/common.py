"""What the text operators share: reading documents, stored intermediate results, whole texts as byte arrays.

Operators take the columns they need by name and ignore all others, so extra columns never clash.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.session import scratch_dir
from paystrata.sources.files import Folder

#: Bytes of text that a task looks at in one go; a longer text is looked at alone.
BLOCK_BYTES = 1 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of all executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="paystrata-code-"), "paystrata.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(os.path.join(root, "paystrata"))):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, root))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` written to the shared scratch folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.scratch_path = path
    return written


def discard(*frames: DataFrame) -> None:
    """Delete what ``stored`` wrote for these frames. For results that nothing will read again, also not anew."""
    for frame in frames:
        Folder(frame.sparkSession, frame.scratch_path).delete("")


def pick(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator works on, under fixed names."""
    ship(df.sparkSession)
    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))


def fold(doc_id: str, folds: int):
    """The fold of a document: crc32 of its id as text, modulo ``folds``; a missing id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(0))


def byte_view(column) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow string column as (bytes, offsets) without copying; a null is an empty text."""
    n = len(column)
    if n == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8), ends


def text_blocks(column, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of at most ``limit`` bytes of text: (first row, end row, bytes, offsets from 0)."""
    data, ends = byte_view(column)
    first, n = 0, len(column)
    while first < n:
        last = int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[ends[first]:ends[last]], ends[first:last + 1] - ends[first]
        first = last


def annotate(df: DataFrame, text_col: str, compute, fields: list[T.StructField]) -> DataFrame:
    """``df`` with columns computed from one text column, in one pass.

    ``compute`` is called once per task and returns a function from (bytes, offsets) of a block of texts to one array
    or list per field. The new columns must not be named like one of ``df``.
    """
    ship(df.sparkSession)
    taken = {f.name for f in fields} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} exist already")
    schema = T.StructType([*df.schema.fields, *fields])
    at = df.columns.index(text_col)
    kinds = [_arrow_type(f.dataType) for f in fields]

    def run(batches):
        block = compute()
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(at)):
                new = [pa.array(values, kind) for values, kind in zip(block(data, offsets), kinds)]
                own = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*own.columns, *new], names=schema.names)

    return df.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    simple = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
              "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
              "array<bigint>": pa.list_(pa.int64())}
    return simple[kind.simpleString()]


def free_name(taken: list[str], name: str) -> str:
    """A column name like ``name`` that is not taken, in any case of letters."""
    lowered = {t.lower() for t in taken}
    while name.lower() in lowered:
        name = f"_{name}"
    return name


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)
