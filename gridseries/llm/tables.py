"""Reading the corpus tables, and the shared folder for what operators write."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.session import ensure_checkpoint_dir


BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
# Spark's default, and ours
SPARK_BATCH_BYTES, BATCH_BYTES = "67108864b", "8m"


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors once per context, where it may not be installed.

    The archive goes to the shared folder, from where Spark takes it. Batches of rows that go to Python are bounded by
    BATCH_BYTES, unless the session has another bound than Spark's own: a batch lies in memory several times, in
    the executor and in its workers.
    """
    if spark.conf.get(BATCH_SETTING) == SPARK_BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    context = spark.sparkContext
    if getattr(context, "_gridseries_shipped", False):
        return
    top, archive = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(top.rglob("*.py")):
            out.write(source, source.relative_to(top.parent))
    path = f"{shared_folder(spark, 'code')}/gridseries.zip"
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    out.write(archive.getvalue())
    out.close()
    context.addPyFile(path)
    context._gridseries_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_aside(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table with all other columns under names no operator uses, and what gives them their names back."""
    names = df.columns
    apart = [c if c in needed else f"_column{i}" for i, c in enumerate(names)]
    return df.toDF(*apart), lambda out: out.select(*(F.col(a).alias(n) for a, n in zip(apart, names)))


def remainder(key: str, of: int) -> Column:
    """crc32 of the key as text, modulo `of`; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % of


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's checkpoint folder, which all executors see."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def text_bytes(df: DataFrame, *columns: str) -> int:
    total = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0))
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).cast("long")).first()[0]


def pieces(df: DataFrame, bytes_each: int, least: int, *columns: str) -> int:
    """How many parts of about `bytes_each` a table's texts make; follows the input."""
    return max(least, -(-text_bytes(df, *columns) // bytes_each))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write the rows once below the shared folder and read them back from there.

    Unlike checkpoint() this evaluates the plan once. `drop_stored` removes the folders of a session
    when their results are no longer read.
    """
    folder = shared_folder(df.sparkSession, name)
    _written.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_written: list[str] = []


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_stored(spark: SparkSession, keep: int = 0) -> None:
    """Remove the stored tables of this session, but for the first `keep`."""
    while len(_written) > keep:
        remove_folder(spark, _written.pop())


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables stored within the block are removed at its end."""
    held = len(_written)
    try:
        yield
    finally:
        drop_stored(spark, held)
