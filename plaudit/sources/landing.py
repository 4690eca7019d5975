"""Raw CSV files of any column order as review rows, without loss.

Every file is read by its own header. Files of one header form a group that is read in one scan; columns are
found by name. What the review table has no column for is kept as JSON in ``rescued``: cells of unknown
columns, of a second column of one name, and, under ``_record``, the text of records with more or fewer
cells than the header. A file whose header lacks a required column is not landed but reported.
"""

from __future__ import annotations

import csv
import fnmatch
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.schemas import RAW_REVIEW
from plaudit.sources.versions import files
from plaudit.storage import together

RESCUED = "rescued"
RECORD = "_record"
REQUIRED = ("review_id", "rating", "review_text", "review_date")
#: A file up to this size is one task anyway, so quoted line breaks cost nothing there.
ONE_TASK_BYTES = 128 << 20


@dataclass(frozen=True)
class LandingFile:
    path: str
    size: int
    header: tuple[str, ...]

    @property
    def missing(self) -> tuple[str, ...]:
        return tuple(name for name in RAW_REVIEW.names if name not in self.header)

    @property
    def unknown(self) -> tuple[str, ...]:
        return tuple(name for name in self.header if name not in RAW_REVIEW.names)

    def lands(self, required: Sequence[str] = REQUIRED) -> bool:
        return not set(required) & set(self.missing)


def data_files(spark: SparkSession, source: str) -> list[tuple[str, int]]:
    """Path and size of the files at a path, below a folder, or that a pattern matches; hidden names left out."""
    place, system = files(spark, source)
    found = []
    for status in system.globStatus(place) or []:
        if not status.isDirectory():
            found.append((str(status.getPath()), status.getLen()))
            continue
        root = str(status.getPath())
        listed = system.listFiles(status.getPath(), True)
        while listed.hasNext():
            each = listed.next()
            path = str(each.getPath())
            if not any(fnmatch.fnmatch(part, "[_.]*") for part in path[len(root):].split("/") if part):
                found.append((path, each.getLen()))
    return sorted(found)


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The names in the first line of a file, which may be compressed; none for an empty file."""
    jvm = spark.sparkContext._jvm
    place, system = files(spark, path)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    codec = codecs.getCodec(place)
    stream = system.open(place)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(name.strip() for name in next(csv.reader([line.removeprefix("﻿")]), ())) if line else ()


def landing_files(spark: SparkSession, source: str) -> list[LandingFile]:
    """The files of a source with their headers, which are read a few files at a time."""
    listed = data_files(spark, source)
    if not listed:
        raise FileNotFoundError(f"no files at {source}")
    headers = together(spark, [partial(_header, spark, path) for path, _ in listed], at_once=16)
    return [LandingFile(path, size, header) for (path, size), header in zip(listed, headers)]


REPORT = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("size", T.LongType()),
    T.StructField("header", T.ArrayType(T.StringType())), T.StructField("missing", T.ArrayType(T.StringType())),
    T.StructField("unknown", T.ArrayType(T.StringType())), T.StructField("landed", T.BooleanType())])


def landing_report(spark: SparkSession, found: Sequence[LandingFile], required: Sequence[str] = REQUIRED) -> DataFrame:
    """One row per file: its header, the review columns it lacks, those unknown, and whether it lands."""
    rows = [(f.path, f.size, list(f.header), list(f.missing), list(f.unknown), f.lands(required)) for f in found]
    return spark.createDataFrame(rows, REPORT)


def quoted_breaks(spark: SparkSession, paths: Sequence[str]) -> bool:
    """Whether a line may end inside a quoted cell: then it has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    return bool(spark.read.text(list(paths)).filter(quotes % 2 == 1).take(1))


def _group(spark: SparkSession, header: tuple[str, ...], paths: list[str], options: dict, multi_line: bool) -> DataFrame:
    """Rows of files of one header as text cells, with what has no column in ``rescued``."""
    cells = [f"c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(cell, T.StringType()) for cell in [*cells, RECORD]])
    rows = spark.read.schema(schema).options(
        **options, multiLine=str(multi_line).lower(), enforceSchema="true", columnNameOfCorruptRecord=RECORD).csv(paths)
    first: dict[str, str] = {}
    rest: dict[str, Column] = {}
    for name, cell in zip(header, cells):
        if name in RAW_REVIEW.names and name not in first:
            first[name] = cell
            continue
        key, copy = name, 2
        while key in rest or key == RECORD or (copy == 2 and name in first):
            key, copy = f"{name}_{copy}", copy + 1
        rest[key] = F.col(cell)
    rest[RECORD] = F.col(RECORD)
    kept = F.map_filter(F.create_map(*[part for key, value in rest.items() for part in (F.lit(key), value)]), lambda _, v: v.isNotNull())
    return rows.select(
        *[(F.col(first[name]) if name in first else F.lit(None).cast("string")).alias(name) for name in RAW_REVIEW.names],
        F.when(F.size(kept) > 0, F.to_json(kept)).alias(RESCUED))


def read_by_header(
    spark: SparkSession, found: Sequence[LandingFile], options: dict, multi_line: bool | None = None,
    required: Sequence[str] = REQUIRED,
) -> DataFrame:
    """Text cells of all files that land, with ``rescued``.

    ``multi_line`` says whether cells may hold line breaks, which makes a file one task. By default files
    beyond ``ONE_TASK_BYTES`` are looked through for such breaks first, in a scan that is split like any other.
    """
    groups: dict[tuple[str, ...], list[LandingFile]] = {}
    for file in found:
        if file.header and file.lands(required):
            groups.setdefault(file.header, []).append(file)
    parts = []
    for header, members in sorted(groups.items()):
        big = [file.path for file in members if file.size > ONE_TASK_BYTES]
        breaks = multi_line if multi_line is not None else not big or quoted_breaks(spark, big)
        parts.append(_group(spark, header, [file.path for file in members], options, breaks))
    if not parts:
        names = [*RAW_REVIEW.names, RESCUED]
        return spark.createDataFrame([], T.StructType([T.StructField(name, T.StringType()) for name in names]))
    while len(parts) > 1:  # a balanced tree; a chain would analyse its head once per further part
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]
