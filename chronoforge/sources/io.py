"""Readers and writers.

Everything goes through Spark's data sources, so reads split across files and tasks and writes
are one file set per partition. Scratch output of the registered queries goes under the
session's shared checkpoint folder, never a machine-local temporary folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from chronoforge.functions.columns import nan_to_null
from chronoforge.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/io-{name}-{uuid.uuid4().hex[:12]}"


# --------------------------------------------------------------------------------------------
# A1 / A3: CSV
# --------------------------------------------------------------------------------------------


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             missing_ok: bool = False) -> DataFrame:
    """CSV with header. Give a schema (no inference pass at scale). A missing path raises,
    unless ``missing_ok`` (then an empty DataFrame with ``schema``). NaN is read as NULL."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return nan_to_null(reader.csv(path))
    except AnalysisException as e:
        if missing_ok and "PATH_NOT_FOUND" in str(e) and schema is not None:
            st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
            return spark.createDataFrame([], st)
        raise


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """CSV sink with header, no index column; parent folders are created by the writer."""
    w = df.write.mode(mode).option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


# --------------------------------------------------------------------------------------------
# A3 / A4: Parquet tables (holdout, predictions, comparisons)
# --------------------------------------------------------------------------------------------


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Parquet sink, optionally partitioned (e.g. by key or month for pruning on read)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; NaN is read as NULL."""
    return nan_to_null(spark.read.parquet(path))


# --------------------------------------------------------------------------------------------
# A2: hourly struct-of-arrays payloads
# --------------------------------------------------------------------------------------------


def read_hourly_payload(spark: SparkSession, path: str, variables: list[str],
                        multiline: bool = False) -> DataFrame:
    """Landed JSON payloads ``{"hourly": {"time": [...], var: [...], ...}}`` -> one row per hour
    with ``time`` as TIMESTAMP_NTZ. A payload without ``hourly.time`` or with arrays of unequal
    length raises (``arrays_zip`` would pad silently). NaN is read as NULL."""
    schema = T.StructType([T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]))])
    raw = spark.read.schema(schema).option("multiLine", multiline).json(path)
    h = F.col("hourly")
    ok_time = h["time"].isNotNull()
    same = None
    for v in variables:
        c = F.coalesce(F.size(h[v]), F.lit(-1)) == F.size(h["time"])
        same = c if same is None else same & c
    checked = raw.withColumn("__ok", F.when(~ok_time, F.raise_error(F.lit("payload without hourly.time")))
                             .when(~same, F.raise_error(F.lit("hourly arrays of unequal length")))
                             .otherwise(F.lit(True)))
    zipped = checked.filter("__ok").select(F.inline(F.arrays_zip(h["time"].alias("time"),
                                                                 *[h[v].alias(v) for v in variables])))
    return nan_to_null(zipped.withColumn("time", F.to_timestamp_ntz("time")))


def hourly_payloads(df: DataFrame, variables: list[str], time: str = "time",
                    keys: list[str] | None = None) -> DataFrame:
    """Inverse of :func:`read_hourly_payload` for landing data: one payload per series and
    calendar day. The input is an hourly series (one row per hour per key), so every array holds
    at most 24 elements and no group grows with the table."""
    keys = list(keys or [])
    day = F.to_date(time).alias("__day")
    packed = F.struct(F.col(time).alias("t"), *[F.col(v) for v in variables])
    g = df.groupBy(*keys, day).agg(F.array_sort(F.collect_list(packed)).alias("__rows"))

    def field_of(name):
        return lambda r: r[name]

    return g.select(*keys, F.struct(
        F.transform("__rows", lambda r: F.date_format(r["t"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
        *[F.transform("__rows", field_of(v)).alias(v) for v in variables]).alias("hourly"))


# --------------------------------------------------------------------------------------------
# Fitted models and metadata
# --------------------------------------------------------------------------------------------


@dataclass
class ModelMetadata:
    model_name: str
    trained_at: str
    version: str
    target: str
    metrics: dict
    hyperparameters: dict
    features: list[str]
    n_features: int
    n_train: int
    n_test: int
    model_path: str
    curve_path: str = ""
    best_iterations: int | None = None
    extra: dict = field(default_factory=dict)


METADATA_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("trained_at", T.StringType()),
    T.StructField("version", T.StringType()), T.StructField("target", T.StringType()),
    T.StructField("metrics", T.StructType([T.StructField(n, T.DoubleType()) for n in
                                           ("test_rmse", "test_mae", "cv_rmse", "cv_mae")])),
    T.StructField("hyperparameters", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("n_features", T.IntegerType()), T.StructField("n_train", T.IntegerType()),
    T.StructField("n_test", T.IntegerType()), T.StructField("model_path", T.StringType()),
    T.StructField("curve_path", T.StringType()), T.StructField("best_iterations", T.IntegerType()),
])


def _as_type(value, kind: T.DataType):
    """``value`` as the schema's type wants it; the schema alone decides."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return tuple(_as_type(value.get(f.name), f.dataType) for f in kind.fields)
    if isinstance(kind, T.MapType):
        return {str(k): _as_type(v, kind.valueType) for k, v in value.items()}
    if isinstance(kind, T.ArrayType):
        return [_as_type(v, kind.elementType) for v in value]
    return {T.StringType: str, T.DoubleType: float, T.IntegerType: int}[type(kind)](value)


def write_metadata(spark: SparkSession, meta: ModelMetadata, path: str) -> str:
    """One-row nested record (struct / map / array) written as JSON, each field cast as METADATA_SCHEMA says."""
    row = _as_type(vars(meta), METADATA_SCHEMA)
    spark.createDataFrame([row], METADATA_SCHEMA).coalesce(1).write.mode("overwrite").json(path)
    return path


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).json(path)


LINEAR_MODEL_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("intercept", T.DoubleType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("params", T.MapType(T.StringType(), T.DoubleType())),
])


def save_linear_model(spark: SparkSession, model, path: str) -> str:
    """Persist a fitted linear model (coefficients, not a pickle) as Parquet."""
    row = (model.name, float(model.intercept), list(model.features), [float(w) for w in model.coef],
           {k: float(v) for k, v in model.params.items()})
    spark.createDataFrame([row], LINEAR_MODEL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_linear_model(spark: SparkSession, path: str):
    from chronoforge.operators.linear import LinearModel

    r = spark.read.schema(LINEAR_MODEL_SCHEMA).parquet(path).first()
    return LinearModel(r["name"], list(r["features"]), r["intercept"], np.array(r["coef"]), dict(r["params"]))
