"""Numbered versions of a stored dataset, published all at once.

A version is a small text below ``<folder>/<number>``. It is written under another name and then renamed,
which fails if the number is taken: readers see a version whole or not at all, and of two writers on one
predecessor one fails. Texts that a crash left empty are no versions, but their numbers stay taken. Object
stores without an exclusive rename need one writer at a time.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def files(spark: SparkSession, path: str):
    """Hadoop path and file system of a location."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, folder: str) -> dict[int, object]:
    place, system = files(spark, folder)
    if not system.exists(place):
        return {}
    return {int(s.getPath().getName()): s for s in system.listStatus(place) if s.getPath().getName().isdigit()}


def _text(spark: SparkSession, status) -> str:
    system = status.getPath().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = system.open(status.getPath())
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def published(spark: SparkSession, folder: str) -> dict[int, str]:
    """The text of every version by its number, in order. File times play no part."""
    texts = {number: _text(spark, status) for number, status in sorted(_numbers(spark, folder).items())}
    return {number: text for number, text in texts.items() if text.strip()}


def latest(spark: SparkSession, folder: str) -> tuple[int, dict] | None:
    """Number and content of the last version that was published as JSON."""
    for _, status in sorted(_numbers(spark, folder).items(), reverse=True):
        text = _text(spark, status)
        if text.strip():
            return int(status.getPath().getName()), json.loads(text)
    return None


def content(spark: SparkSession, folder: str, number: int) -> dict:
    """One published version as JSON."""
    return json.loads(_text(spark, _numbers(spark, folder)[number]))


def next_number(spark: SparkSession, folder: str) -> int:
    return max(_numbers(spark, folder), default=0) + 1


def publish(spark: SparkSession, folder: str, number: int, text: str) -> None:
    """Takes the number for this text; ``FileExistsError`` if another writer has it."""
    jvm = spark.sparkContext._jvm
    target, system = files(spark, f"{folder}/{number:012d}")
    draft, _ = files(spark, f"{folder}/.{number:012d}-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(target), options)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise FileExistsError(f"version {number} of {folder} is taken") from None
        raise
