"""Sources and sinks.

Readers normalise NaN to NULL at the source (Spark keeps the two apart, and
NaN poisons ``avg``/``max``/``median``), so every later operator sees SQL NULL
only.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

_FLOATS = (T.DoubleType, T.FloatType)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column (one projection)."""
    exprs = []
    changed = False
    for f in df.schema.fields:
        if isinstance(f.dataType, _FLOATS):
            c = F.col(f"`{f.name}`")
            exprs.append(F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
            changed = True
        else:
            exprs.append(F.col(f"`{f.name}`"))
    return df.select(*exprs) if changed else df


def within(df: DataFrame, ranges: dict) -> DataFrame:
    """Rows whose columns lie in ``{column: (low, high)}``, ends included, None for an open end."""
    for c, (lo, hi) in ranges.items():
        for cond in ([F.col(f"`{c}`") >= lo] if lo is not None else []) + ([F.col(f"`{c}`") <= hi] if hi is not None else []):
            df = df.where(cond)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str, ranges: dict | None = None) -> DataFrame:
    """One parquet table of a scale-factor directory; NaN -> NULL.

    ``ranges`` (see ``within``) reach the scan: a filter on top of the NaN projection does not,
    so the rows are filtered below it, where NaN counts as large, and NULLs fall out above it.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return within(nan_to_null(within(df, ranges)), ranges) if ranges else nan_to_null(df)


def read_panel(spark: SparkSession, path: str, fmt: str | None = None,
               schema: T.StructType | str | None = None) -> DataFrame:
    """Read a panel from CSV (header, typed) or Parquet; NaN -> NULL.

    Pass ``schema`` for production reads; without it CSV types are inferred
    (an extra pass over the file).
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("nanValue", "NaN")
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        df = reader.csv(path)
    else:
        df = reader.schema(schema).parquet(path) if schema is not None else reader.parquet(path)
    return nan_to_null(df)


def read_checked(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ","):
    """S1 with damaged rows kept apart: ``(panel, rejected, report)`` of a CSV with a header.

    A row that does not fit ``schema`` (too many or few fields, a value that is no number) is not
    read as nulls: ``rejected`` holds its text and file, ``panel`` the other rows, and ``report`` counts
    rows, accepted and rejected rows of each file, so that none is lost silently."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    bad = "_corrupt_record"
    # sensitive to the header: a file with other columns fails instead of shifting values
    raw = (spark.read.option("header", True).option("nanValue", "NaN").option("mode", "PERMISSIVE")
           .option("enforceSchema", False).option("columnNameOfCorruptRecord", bad).option("sep", sep)
           .schema(T.StructType([*schema.fields, T.StructField(bad, T.StringType())])).csv(path))
    # Spark skips parsing of columns that a query does not use, and with it the check: read all of them
    raw = raw.select(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]).alias("row"), F.col(bad).alias("text"),
                     F.col("_metadata.file_path").alias("file")).withColumn(
        "ok", F.col("text").isNull() & (F.hash("row").isNotNull()))
    raw = cut_lineage(raw)
    panel = nan_to_null(raw.where("ok").select("row.*"))
    rejected = raw.where("not ok").select("file", "text")
    report = raw.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.count_if("ok").alias("accepted"),
                                     F.count_if(~F.col("ok")).alias("rejected"))
    return panel, rejected, report


def load_split(spark: SparkSession, train_path: str, test_path: str, fmt: str | None = None):
    """S1 for a train/test pair; returns ``(train, test, alignment_report)``."""
    train = read_panel(spark, train_path, fmt)
    test = read_panel(spark, test_path, fmt)
    return train, test, alignment_report(train, test)


def alignment_report(train: DataFrame, test: DataFrame) -> DataFrame:
    """S3: columns present on only one side, as ``(column_name, side)`` rows.

    Computed from the two schemas on the driver (no job); the result has at
    most as many rows as there are columns.
    """
    spark = train.sparkSession
    tr, te = train.columns, test.columns
    rows = [(c, "train") for c in tr if c not in set(te)]
    rows += [(c, "test") for c in te if c not in set(tr)]
    return spark.createDataFrame(rows, "column_name string, side string")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None, keep_others: bool = False) -> str:
    """Write a stage table (Parquet by default, CSV with header).

    With ``keep_others`` an overwrite replaces only the partitions that ``df`` holds."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if keep_others else "static")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_predictions(preds: DataFrame, path: str, key: str = "row_id",
                      pred_col: str = "prediction", model_col: str | None = "model",
                      out_name: str = "market_forward_excess_returns") -> str:
    """``(key, prediction)`` per model, partitioned by model name; the files of models
    that ``preds`` does not hold stay."""
    cols = [F.col(key), F.col(pred_col).alias(out_name)]
    part = None
    if model_col and model_col in preds.columns:
        cols.append(F.col(model_col))
        part = model_col
    return write_table(preds.select(*cols), path, partition_by=part, keep_others=part is not None)


def save_model(model, path: str) -> str:
    """Spark ML persistence (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, path: str):
    """Load any saved Spark ML model; the class is read from the model's
    own metadata file (works on any Hadoop-compatible file system)."""
    import importlib

    cls_name = spark.read.json(os.path.join(path, "metadata")).select("class").first()[0]
    module, _, name = cls_name.rpartition(".")
    py_module = module.replace("org.apache.spark.ml", "pyspark.ml")
    cls = getattr(importlib.import_module(py_module), name)
    return cls.load(path)
