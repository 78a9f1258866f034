"""Files through Spark's own file systems, so any store that Spark reads will do.

The only place that reaches behind the DataFrame API.
"""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, target = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.mkdirs(target)


def write_line(spark: SparkSession, path: str, line: str) -> None:
    fs, target = _at(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(line.encode()))
    finally:
        out.close()


def create_line(spark: SparkSession, path: str, line: str) -> None:
    """A new file; fails if there is one already."""
    fs, target = _at(spark, path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(line.encode()))
    finally:
        out.close()


def rename(spark: SparkSession, path: str, target: str) -> bool:
    """Move a folder to a name that nothing has; False if something has it."""
    fs, there = _at(spark, target)
    fs.mkdirs(there.getParent())
    return not fs.exists(there) and fs.rename(spark._jvm.org.apache.hadoop.fs.Path(path), there)


def size(spark: SparkSession, path: str) -> int:
    """Bytes in a folder."""
    fs, target = _at(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def read_line(spark: SparkSession, path: str) -> str | None:
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return None
    source = fs.open(target)
    try:
        return bytes(source.readAllBytes()).decode().strip()
    finally:
        source.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.delete(target, True)
