"""Bronze / Silver / Gold layers and file sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.schemas import RAW_REVIEW, SILVER_REVIEW
from plaudit.sources.landing import RESCUED, data_files, landing_files, read_by_header
from plaudit.sources.versions import files

CSV_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"',
    # Blanks at the edges of a cell are data; the CSV writer would cut them by default.
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


@dataclass(frozen=True)
class Lake:
    """Names datasets below one root, which may be ``s3a://bucket``, ``hdfs:`` or ``file:``."""

    root: str
    layers: dict[str, str] = field(
        default_factory=lambda: {"bronze": "bronze", "silver": "silver", "gold": "gold"}
    )

    def path(self, layer: str, *parts: str) -> str:
        """Path of a dataset; an unknown layer raises ``KeyError``."""
        tail = [part.strip("/") for part in parts]
        return "/".join([self.root.rstrip("/"), self.layers[layer], *tail]).rstrip("/")

    def read(self, spark: SparkSession, layer: str, *parts: str) -> DataFrame:
        return spark.read.parquet(self.path(layer, *parts))

    def write(self, df: DataFrame, layer: str, *parts: str, partition_by: tuple[str, ...] = ()) -> str:
        path = self.path(layer, *parts)
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return path

    def read_mart(self, spark: SparkSession, name: str) -> DataFrame:
        return self.read(spark, "gold", name)

    def write_mart(self, df: DataFrame, name: str) -> str:
        return self.write(df, "gold", name)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = RAW_REVIEW, multi_line: bool = True
) -> DataFrame:
    """Typed CSV scan of a file or a directory of files.

    Doubled quotes and quoted line breaks are understood. A cell that does not fit its type is
    null, the row stays; a header other than the schema's names raises. Quoted line breaks make a
    file one task (:func:`land` cuts its files for that); without them in the data,
    ``multi_line=False`` lets Spark split big files.
    """
    options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower(), "enforceSchema": "false"}
    return spark.read.schema(schema).options(**options).csv(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path, compression=compression)


BRONZE_REVIEW = T.StructType([*RAW_REVIEW, T.StructField(RESCUED, T.StringType())])


def read_bronze(spark: SparkSession, lake: Lake, dataset: str = "reviews", rescued: bool = False) -> DataFrame:
    """All landed reviews with their ``ingest_date`` partition; ``rescued`` cells on request."""
    rows = read_csv(spark, lake.path("bronze", dataset), BRONZE_REVIEW)
    return rows if rescued else rows.drop(RESCUED)


def read_landed(spark: SparkSession, lake: Lake, paths: Sequence[str], dataset: str = "reviews") -> DataFrame:
    """Reviews of some Bronze files, as :func:`read_bronze` gives them without ``ingest_date``."""
    rows = spark.read.schema(BRONZE_REVIEW).options(**CSV_OPTIONS, multiLine="true", enforceSchema="false")
    return rows.csv(list(paths)).select(*RAW_REVIEW.names)


def bronze_files(spark: SparkSession, lake: Lake, dataset: str = "reviews") -> list[str]:
    """Paths of the landed files, relative to the dataset."""
    root = lake.path("bronze", dataset)
    place, system = files(spark, root)
    if not system.exists(place):
        return []
    full = str(system.makeQualified(place))
    return [path[len(full) + 1:] for path, _ in data_files(spark, root)]


def read_silver(spark: SparkSession, lake: Lake, dataset: str = "reviews") -> DataFrame:
    """Silver reviews; the fixed schema keeps number-like categories text and allows an empty table."""
    return spark.read.schema(SILVER_REVIEW).parquet(lake.path("silver", dataset))


def land_csv(
    spark: SparkSession, lake: Lake, source: str, dataset: str = "reviews", multi_line: bool | None = None
) -> str:
    """Append raw review files to Bronze, under today's ``ingest_date``; see :mod:`plaudit.sources.landing`.

    Cells are carried as text and columns found by the header of each file; an empty cell comes back as
    null. Files that lack a required column stop the landing before anything is written.
    """
    found = landing_files(spark, source)
    refused = [f"{file.path} lacks {', '.join(file.missing)}" for file in found if file.header and not file.lands()]
    if refused:
        raise ValueError("not landed: " + "; ".join(refused))
    return land(read_by_header(spark, found, CSV_OPTIONS, multi_line), lake, dataset)


def land(df: DataFrame, lake: Lake, dataset: str = "reviews", max_records: int = 1_000_000) -> str:
    """Append rows to Bronze as CSV; files are cut at ``max_records`` so that reading them scales.

    A file is read by one task anyway, as cells may hold line breaks, so it is compressed.
    """
    path = lake.path("bronze", dataset)
    rescued = F.col(RESCUED) if RESCUED in df.columns else F.lit(None).cast("string").alias(RESCUED)
    (
        df.select(*RAW_REVIEW.names, rescued)
        .withColumn("ingest_date", F.date_format(F.current_timestamp(), "yyyy-MM-dd"))
        .write.mode("append")
        .partitionBy("ingest_date")
        .option("maxRecordsPerFile", max_records)
        .options(**CSV_OPTIONS)
        .csv(path, compression="gzip")
    )
    return path


LABELLED = T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.IntegerType())])


def read_labelled(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType = LABELLED) -> DataFrame:
    """Labelled texts ``(text, label)``; other fields, such as the store's own ``_id``, are left out."""
    return spark.read.format(fmt).schema(schema).load(path).drop("_id")


def write_report(report: DataFrame, path: str) -> None:
    """A report as JSON lines."""
    report.write.mode("overwrite").json(path)
