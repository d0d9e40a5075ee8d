"""Which columns each landed file has, found in tasks by a number of jobs that does not grow with the files."""

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The footer of a file lies in its last part; a file with a longer one, or one too large to be taken
# into a task's memory, is asked by a job of its own.
TAIL_BYTES = 1 << 20
WHOLE_BYTES = 256 << 20
HEAD_BYTES = 1 << 16


def _footers(files: DataFrame) -> DataFrame:
    tail = F.expr(f"substring(content, cast(greatest(1, length - {TAIL_BYTES} + 1) as int), {TAIL_BYTES})")

    def layouts(batches: Iterator) -> Iterator:
        import json

        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            names, found = [], []
            for end in batch.column("tail"):
                try:
                    fields = pq.read_schema(pa.BufferReader(end.as_buffer()))
                except pa.ArrowException:
                    names.append(None)
                    found.append(None)
                    continue
                names.append(fields.names)
                found.append(json.dumps([[f.name, str(f.type)] for f in fields]))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(names, pa.list_(pa.string())), pa.array(found, pa.string())],
                                             ["path", "columns", "layout"])

    return files.select("path", tail.alias("tail")).mapInArrow(layouts, "path string, columns array<string>, layout string")


def _headers(files: DataFrame) -> DataFrame:
    line = F.split_part(F.decode(F.expr(f"substring(content, 1, {HEAD_BYTES})"), "UTF-8"), F.lit("\n"), F.lit(1))
    line = F.regexp_replace(line, '[\\r"\\uFEFF]', "")
    return files.select("path", F.split(line, ",").alias("columns"), line.alias("layout"))


def describe_files(spark: SparkSession, paths: str | list[str], fmt: str = "parquet", glob: str | None = None) -> DataFrame:
    """(path, columns, layout) of every file of the paths, or in the folders they name.

    `layout` is a text that is equal for files with the same columns, types and order. It can be kept in a
    manifest. It is null for files that this cannot tell of: other formats, footers beyond TAIL_BYTES, larger files.
    """
    files = spark.read.format("binaryFile")
    files = (files.option("pathGlobFilter", glob) if glob else files).load(paths)
    unknown = files.select("path", F.lit(None).cast("array<string>").alias("columns"), F.lit(None).cast("string").alias("layout"))
    if fmt not in ("parquet", "csv"):
        return unknown
    told = (_footers if fmt == "parquet" else _headers)(files.filter(F.col("length") <= WHOLE_BYTES))
    return told.unionByName(unknown.filter(files.length > WHOLE_BYTES))


def by_layout(spark: SparkSession, described: DataFrame, fmt: str = "parquet") -> list[DataFrame]:
    """One scan for each layout of the described files; the lists of their paths go through the driver."""
    groups = described.groupBy("layout").agg(F.sort_array(F.collect_set("path")).alias("paths")).orderBy("layout").collect()
    reader = spark.read.format(fmt).option("header", True)
    scans: dict[str, tuple] = {}
    for group in groups:
        for paths in [[p] for p in group["paths"]] if group["layout"] is None else [group["paths"]]:
            schema = reader.load(paths[0]).schema
            scans.setdefault(schema.json(), (schema, []))[1].extend(paths)
    return [spark.read.format(fmt).option("header", True).schema(schema).load(paths) for schema, paths in scans.values()]
