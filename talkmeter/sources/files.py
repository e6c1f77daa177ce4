"""Small files in shared folders, made and read by the driver through Hadoop's file systems."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """(file system, path) as Hadoop sees them, whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = located(spark, path)
    return store.exists(place)


def read_text(spark: SparkSession, path: str) -> str:
    store, place = located(spark, path)
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    store, place = located(spark, path)
    store.delete(place, True)


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create the file with its whole content; False, and nothing changes, if there is one already.

    The content is written under another name first and takes its own by one step that fails where the
    name is taken: a hard link on local disks, a rename on HDFS. Stores whose rename copies (object
    stores) don't promise that, so they want one writer at a time.
    """
    store, place = located(spark, path)
    folder = place.getParent()
    store.mkdirs(folder)
    draft = spark._jvm.org.apache.hadoop.fs.Path(folder, f".{place.getName()}.{uuid.uuid4().hex}")
    stream = store.create(draft, False)
    stream.write(bytearray(content.encode()))
    stream.close()
    try:
        real = store.resolvePath(folder).toUri()
        if real.getScheme() != "file":
            return not store.exists(place) and store.rename(draft, place)
        try:
            os.link(f"{real.getPath()}/{draft.getName()}", f"{real.getPath()}/{place.getName()}")
        except FileExistsError:
            return False
        return True
    finally:
        store.delete(draft, False)
