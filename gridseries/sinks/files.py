"""Folders of a table's file system, through the session's own configuration."""

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _open(spark, path)
    return files.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    files, target = _open(spark, path)
    if not files.exists(target):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(target) if f.isDirectory())


def move_files(spark: SparkSession, folder: str, target: str, name: str, extension: str) -> None:
    """Move the data files of a written folder to `target`, named after `name`."""
    files, source = _open(spark, folder)
    _, place = _open(spark, target)
    files.mkdirs(place)
    found = sorted(f.getPath().getName() for f in files.listStatus(source) if f.getPath().getName().startswith("part-"))
    for i, part in enumerate(found):
        _, old = _open(spark, f"{folder}/{part}")
        _, new = _open(spark, f"{target}/{name}{f'.{i}' if i else ''}{extension}")
        files.rename(old, new)


def remove(spark: SparkSession, path: str) -> None:
    files, target = _open(spark, path)
    files.delete(target, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, in order; none if it is not there. Hidden ones are left out."""
    files, target = _open(spark, path)
    if not files.exists(target):
        return []
    found = [f.getPath().getName() for f in files.listStatus(target) if f.isFile()]
    return sorted(n for n in found if not n.startswith((".", "_")))


def folders_below(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Folders at a depth below a folder, relative to it; none if it is not there. Names are as the file system has them."""
    files, target = _open(spark, path)
    if not files.exists(target):
        return []
    _, pattern = _open(spark, f"{path}/{'/'.join('*' * depth)}")
    found = [f.getPath().toString().split("/") for f in files.globStatus(pattern) if f.isDirectory()]
    return sorted("/".join(parts[-depth:]) for parts in found)


def read_text(spark: SparkSession, path: str) -> str:
    files, target = _open(spark, path)
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there whole or not at all. Raises if one of that name is there."""
    files, target = _open(spark, path)
    if files.exists(target):
        raise FileExistsError(path)
    folder, _, name = path.rpartition("/")
    _, aside = _open(spark, f"{folder}/.{name}")
    out = files.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(aside, target):
        raise OSError(f"cannot move {path} into place")
