"""Reading and writing panels, predictions and trial logs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRIAL_SCHEMA = T.StructType(
    [
        T.StructField("trial_number", T.LongType()),
        T.StructField("params", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("value", T.DoubleType()),
        T.StructField("datetime", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField(
            "configuracion",
            T.StructType(
                [
                    T.StructField("semilla", T.LongType()),
                    T.StructField("mes_train", T.ArrayType(T.IntegerType())),
                    T.StructField("mes_validacion", T.ArrayType(T.IntegerType())),
                    T.StructField("undersampling", T.DoubleType()),
                    T.StructField("metric", T.StringType()),
                ]
            ),
        ),
    ]
)


def read_panel_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    sep: str = ",",
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """CSV with a header, plain or compressed; an empty field is NULL.

    Give a schema on large data: without one the file is read twice. A gzip file cannot be split, so ``partitions``
    spreads its rows for the steps that follow.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("nullValue", "")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path if isinstance(path, str) else list(path))
    df = df.select(*columns) if columns else df
    return df.repartition(partitions) if partitions else df


def read_panel(
    spark: SparkSession,
    path: str,
    periods: Sequence[int] | None = None,
    *,
    period: str = "foto_mes",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Parquet panel, all of it or some periods. Period list and columns reach the scan."""
    df = spark.read.parquet(path)
    if periods is not None:
        df = df.where(F.col(period).isin(*periods))
    return df.select(*columns) if columns else df


def read_trials(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Trial log: a file with one JSON array of trials, or one trial per line."""
    return spark.read.option("multiLine", True).schema(schema or TRIAL_SCHEMA).json(path)


def write_panel(df: DataFrame, path: str, *, period: str | None = "foto_mes", mode: str = "overwrite") -> None:
    """Gzip parquet with one folder per period, so a list of periods reads only their folders.

    Rows are first gathered by period with a rebalance hint: adaptive execution cuts a large period into several files
    and puts small ones together, so the number of files does not grow with tasks times periods.
    """
    if period is None:
        df.write.mode(mode).option("compression", "gzip").parquet(path)
    else:
        spread = df.hint("rebalance", period)
        spread.write.mode(mode).option("compression", "gzip").partitionBy(period).parquet(path)


def write_csv(
    df: DataFrame, path: str, *, sep: str = ",", header: bool = True, mode: str = "overwrite", compression: str = "none"
) -> None:
    df.write.mode(mode).option("header", header).option("sep", sep).option("compression", compression).csv(path)


def write_submission(
    df: DataFrame, path: str, *, key: str = "numero_de_cliente", predicted: str = "Predicted", only_selected: bool = False
) -> None:
    """Key and prediction with a header, or only the selected keys, without one."""
    if only_selected:
        write_csv(df.where(F.col(predicted) == 1).select(key), path, header=False)
    else:
        write_csv(df.select(key, predicted), path)


def append_table(df: DataFrame, path: str) -> None:
    """Add rows to a parquet table: predictions of a model, a row per experiment, a line of a log."""
    df.write.mode("append").parquet(path)


def append_once(df: DataFrame, path: str, run: str) -> None:
    """Like ``append_table``, but the rows of one run: a run that is repeated, or tried again after a failure, replaces itself.

    Each run has a folder, so runs may be written at the same time, and readers see a run when it is complete.
    """
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")


def run_done(spark: SparkSession, path: str, run: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/run={run}/_SUCCESS")


def read_runs(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """All runs of ``append_once``; ``name`` keeps the run as a column."""
    df = spark.read.option("basePath", path).parquet(path)
    return df.withColumnRenamed("run", name) if name else df.drop("run")


def named_table(df: DataFrame, name: str) -> DataFrame:
    """Name an intermediate result for SQL, replacing an earlier one."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def load_or_build(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    *,
    periods: Sequence[int] | None = None,
    period: str = "foto_mes",
) -> DataFrame:
    """Read a stored feature table, building and storing it first when it is not complete there."""
    if not path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        write_panel(build(), path, period=period)
    return read_panel(spark, path, periods, period=period)
