"""Sources and sinks.

Readers declare schemas where the reference relied on all-string CSV, keep
column pruning and filter push-down intact (plain ``spark.read``), and
sinks write Parquet through the DataFrame writer.  Stage materialisation
uses reliable checkpoints in the shared folder named by
``spark.checkpoint.dir`` -- never executor-local storage.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadtime.functions.geo import dms_to_decimal
from leadtime.session import checkpoint_dir


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Parquet scan of ``directory/name.parquet`` (or a folder)."""
    path = os.path.join(directory, name if name.endswith(".parquet") else f"{name}.parquet")
    return spark.read.parquet(path)


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """Header CSV (plain or .gz).  Without a schema every column is a
    string, exactly as the reference reads it; with a schema no inference
    pass over the data is made."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def load_adjacency(spark: SparkSession, path: str) -> DataFrame:
    """S3: text lines "node<TAB>{'nbr': n, ...}" -> (node, nbrs map<string,int>)."""
    from leadtime.functions.text import parse_adjacency
    node, nbrs = parse_adjacency("value")
    return spark.read.text(path).select(node.alias("node"), nbrs.alias("nbrs"))


def adjacency_from_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Same parse as S3 for lines already in a DataFrame."""
    from leadtime.functions.text import parse_adjacency
    node, nbrs = parse_adjacency(value_col)
    return lines.select(node.alias("node"), nbrs.alias("nbrs"))


def parse_fixed_width(df: DataFrame, layout: list[tuple[str, int, int, str]],
                      value_col: str = "value") -> DataFrame:
    """Fixed-width lines -> typed columns.

    ``layout`` holds (name, 1-based start, width, type); strings are
    trimmed, blanks become NULL, numbers/dates use ``try_`` parsers so a
    bad field is NULL instead of failing the job.
    """
    cols = []
    for name, start, width, typ in layout:
        raw = F.trim(F.substring(F.col(value_col), start, width))
        raw = F.when(raw != "", raw)
        if typ == "string":
            c = raw
        elif typ.startswith("date:"):
            c = F.try_to_date(raw, typ.split(":", 1)[1]) if hasattr(F, "try_to_date") else F.to_date(raw, typ.split(":", 1)[1])
        else:
            c = raw.try_cast(typ)
        cols.append(c.alias(name))
    return df.select(*cols)


def station_history(df: DataFrame, layout, lat_parts=("lat_deg", "lat_min", "lat_sec"),
                    lon_parts=("lon_deg", "lon_min", "lon_sec"), country_col: str = "country",
                    countries=("US",), end_col: str = "end_date", active_after: str | None = None) -> DataFrame:
    """Station-history parse, DMS -> decimal degrees, country and
    active-date filter (filters applied after the typed parse)."""
    out = parse_fixed_width(df, layout)
    out = out.withColumns({
        "lat": dms_to_decimal(*lat_parts), "lon": dms_to_decimal(*lon_parts)})
    cond = F.col(country_col).isin(*countries)
    if active_after:
        cond = cond & (F.col(end_col) >= F.lit(active_after).cast("date"))
    return out.filter(cond)


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """Small in-memory table (fold list, manual zone rows)."""
    return spark.createDataFrame(rows, schema)


def save(df: DataFrame, path: str, mode: str = "errorifexists", partition_by=None) -> None:
    """Parquet sink; ``partition_by`` enables partition pruning later."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def stage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise a stage and cut its lineage.

    A reliable checkpoint in the cluster's shared checkpoint folder
    survives executor loss (unlike a local checkpoint or a cache).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


# the open scopes of this thread or task, outermost first
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("stage_scopes", default=())


@contextmanager
def stage_scope(spark: SparkSession):
    """Stages made inside the block are removed at its end: write the result
    inside, to a path of your own.  Scopes of other threads are theirs."""
    mine: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), mine))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in mine:
            remove_path(spark, path)


def stage_path(spark: SparkSession, name: str = "stage") -> str:
    """A new folder under the shared checkpoint folder."""
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    if _SCOPES.get():
        _SCOPES.get()[-1].append(path)
    return path


def stage_to(df: DataFrame, path: str | None = None) -> DataFrame:
    """S7 variant: write the stage as Parquet under the shared checkpoint
    folder (or ``path``) and read it back -- lineage cut, files reusable.
    Loops name the path and remove it (``remove_path``) when done."""
    spark = df.sparkSession
    path = path or stage_path(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a stage that no later plan reads (any Hadoop file system)."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Hadoop-FS existence test (works for any scheme, not only local paths)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def load_or_compute(spark: SparkSession, path: str, fn: Callable[[], DataFrame],
                    partition_by=None) -> DataFrame:
    """Reuse a saved stage if present, else compute, save and read back."""
    if not path_exists(spark, path):
        save(fn(), path, mode="overwrite", partition_by=partition_by)
    return spark.read.parquet(path)


def register(df: DataFrame, name: str) -> DataFrame:
    """Temp view for SQL."""
    df.createOrReplaceTempView(name)
    return df


def dataset_size(spark: SparkSession, path: str) -> DataFrame:
    """File count and total bytes below a path, computed by executors."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(path).select("path", "length"))
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Recursive file list (path, length)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(path).select("path", "length"))


def save_model(model, path: str) -> None:
    """Persist a fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Reload a fitted pipeline."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def profile_stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Stage metadata -- row count, column count and an
    order-independent content hash -- in a single aggregate pass."""
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.agg(
        F.lit(label).alias("stage"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.sum(h.cast("decimal(38,0)")).cast("string").alias("content_hash"))
