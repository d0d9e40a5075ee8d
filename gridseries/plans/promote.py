"""Moving settled rows from the current to the historic tier of a written table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.operators.lifecycle import mark_settled, remaining_current, replaced
from gridseries.operators.quality import series_mismatch
from gridseries.schema import CURRENT, HISTORIC, OBS_SCHEMA
from gridseries.sinks.versions import replace_rows, work_folder
from gridseries.sinks.writers import write_obs
from gridseries.sources.snapshots import newest, read_rows
from gridseries.sources.tables import scan_series


class SeriesMismatch(RuntimeError):
    """Series in only one tier; `report` is the folder that lists them all."""

    def __init__(self, n: int, report: str):
        super().__init__(f"{n} series are in only one tier, see {report}")
        self.n, self.report = n, report


def touched_partitions(rows: DataFrame) -> set[tuple]:
    """Distinct (source, var, year); bounded by dictionary size times years."""
    found = rows.select("source", "var", F.year("time").alias("year")).distinct().collect()
    return {(r["source"], r["var"], r["year"]) for r in found}


def promote(spark: SparkSession, path: str, source: str, force: bool = False) -> bool:
    """Promote the settled rows of one source; False if there was nothing to do.

    Only the historic partitions that receive rows are rewritten. Readers see both tiers change at once; a
    promotion that stops before its end has changed nothing.
    """
    current = read_rows(spark, path, lambda p: (p.source, p.tier) == (source, CURRENT)).select(OBS_SCHEMA.names)
    current = current.filter((F.col("source") == source) & (F.col("tier") == CURRENT))
    if current.isEmpty():
        return False
    if not force:
        report = f"{path.rstrip('/')}/_mismatch/source={source}"
        listed = scan_series(spark, path).filter(F.col("source") == source)
        series_mismatch(listed.filter(F.col("tier") == CURRENT), listed.filter(F.col("tier") == HISTORIC)).write.mode("overwrite").parquet(report)
        n = spark.read.parquet(report).count()
        if n:
            raise SeriesMismatch(n, report)

    # judged once; the rest reads what is written aside
    work = work_folder(path)
    mark_settled(current, force).write.parquet(f"{work}/marked")
    marked = spark.read.parquet(f"{work}/marked")
    settled = marked.filter("settled").drop("settled").withColumn("tier", F.lit(HISTORIC))
    touched = touched_partitions(settled)
    if not touched:
        return False
    affected = read_rows(spark, path, lambda p: p.tier == HISTORIC and (p.source, p.var, p.year) in touched).select(OBS_SCHEMA.names)
    # the current tier is small and is replaced as a whole
    replace_rows(replaced(settled, affected).unionByName(remaining_current(marked)), path, {(source, CURRENT)})
    return True


def promoted(current: DataFrame, historic: DataFrame, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """Lazy form: (new history, remaining current) of two tables."""
    marked = mark_settled(current, force)
    settled = marked.filter("settled").drop("settled").withColumn("tier", F.lit(HISTORIC))
    return replaced(settled, historic), remaining_current(marked)


def refresh_current(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Land freshly ingested current rows: they replace stored rows with the same key.

    Only the partitions they fall in are read and rewritten. The rows are written aside first,
    so that finding those partitions does not run the ingest a second time.
    """
    if newest(spark, path) is None:
        # also refuses a table from elsewhere
        write_obs(rows, path, mode="append")
        return
    work = work_folder(path)
    rows.select(OBS_SCHEMA.names).write.parquet(f"{work}/incoming")
    fresh = spark.read.schema(OBS_SCHEMA).parquet(f"{work}/incoming")
    touched = touched_partitions(fresh)
    if touched:
        stored = read_rows(spark, path, lambda p: p.tier == CURRENT and (p.source, p.var, p.year) in touched).select(OBS_SCHEMA.names)
        replace_rows(replaced(fresh, stored), path)
