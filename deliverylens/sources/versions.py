"""Tables kept as numbered version folders; the newest whole one is the table.

A write goes to a folder of its own and counts once Spark has put its
``_SUCCESS`` file there, so a write that fails, for instance on a quality rule,
leaves the last good version as it was. Older versions go after a whole write.
One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _hadoop(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _hadoop(spark, path)
    fs.delete(place, True)


def numbers(spark: SparkSession, root: str, whole: bool = True) -> list[int]:
    """Version numbers below ``root``, ascending; with ``whole`` only finished ones."""
    fs, place = _hadoop(spark, root)
    if not fs.exists(place):
        return []
    out = []
    for status in fs.listStatus(place):
        name = status.getPath().getName()
        if name.startswith("v=") and (not whole or fs.exists(_hadoop(spark, f"{root}/{name}/_SUCCESS")[1])):
            out.append(int(name[2:]))
    return sorted(out)


def folder(root: str, version: int) -> str:
    return f"{root}/v={version}"


def publish(df: DataFrame | list[DataFrame], root: str) -> int:
    """Write ``df``, or its parts one after the other, as the next version and drop the ones before it; its number."""
    parts = df if isinstance(df, list) else [df]
    spark = parts[0].sparkSession
    every = numbers(spark, root, whole=False)
    version = max(every, default=-1) + 1
    for part in parts:  # whole only with the last
        (part.write.mode("append").option("compression", "zstd")
         .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(part is parts[-1]).lower())
         .parquet(folder(root, version)))
    for old in every:
        remove(spark, folder(root, old))
    return version


def current(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    """The newest whole version, None if there is none."""
    done = numbers(spark, root)
    if not done:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(folder(root, done[-1]))
