"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoforge.session import checkpoint_dir

#: a table of ids is broadcast up to this many rows (16 bytes each: 16 MB)
BROADCAST_IDS = 1_000_000
#: a table with a binary column is broadcast up to this many bytes
BROADCAST_BYTES = 24 << 20
#: bytes of an Arrow batch within ``small_batches``: with its last row mostly one slice of the 2 MB and 4 MB that operators take
BATCH_BYTES = 1_800_000


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def inputs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of any document table, whatever its other columns are called; the workers can
    import this package from here on."""
    checkpoint_dir(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


#: lists that the names of new scratch tables are added to, innermost last
_RECORDS: list[list[str]] = []


def scratch(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder as Parquet and read it back: lineage ends here,
    the files survive lost executors, and later reads prune columns."""
    path = f"{checkpoint_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    for names in _RECORDS:
        names.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def recorded() -> Iterator[list[str]]:
    """The names of all scratch tables made inside, for ``remove`` once nothing reads them any more."""
    names: list[str] = []
    _RECORDS.append(names)
    try:
        yield names
    finally:
        _RECORDS.pop()


def remove(spark: SparkSession, names: list[str]) -> None:
    """Delete scratch tables, and let Spark drop the shuffle files of frames that nothing refers to any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    names.clear()
    gc.collect()
    jvm.System.gc()


@contextlib.contextmanager
def small_batches(spark: SparkSession, n_bytes: int = BATCH_BYTES) -> Iterator[None]:
    """Jobs run inside hand Python batches of about ``n_bytes`` at most: executor and worker each hold whole ones."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n_bytes))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small(df: DataFrame, rows: int, bound: int = BROADCAST_IDS) -> DataFrame:
    """A hint to broadcast ``df`` if its counted ``rows`` are within ``bound``; else it shuffles."""
    return F.broadcast(df) if rows <= bound else df


def having_ids(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose doc_id is (``left_semi``) or is not (``left_anti``) in ``ids(id)``.
    ``ids`` must be a scratch table: it is counted, and broadcast only within the bound."""
    keys = ids.select(F.col("id").alias("__id")).distinct()
    return docs.join(small(keys, ids.count()), F.col("doc_id") == F.col("__id"), how)


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type, from_pandas=False) for f in schema], schema=schema)


def table_of(schema: pa.Schema, columns: dict) -> pa.Table:
    return pa.Table.from_batches([batch_of(schema, columns)])


