"""Log files as lines.

Landed files stand in a partitioned folder, one leaf per log file of a server:

    <root>/server_id=<id>/source_file_path=<path>/<segment>

with the path escaped as Spark escapes partition values. A file may be landed whole, as one
segment, or piece by piece, as segments whose names sort in the order of writing. A job lists the
segments, picks those it has not read to their end, and opens only these.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.functions.text import charset, decoded

FILE_COLUMNS = ["server_id", "source_file_path"]
BLOCK_COLUMNS = ["segment", "block_start"]
# Typed here: Spark would otherwise read a server id like 007 as a number.
LANDED = "value string, server_id string, source_file_path string"
SCANNED = (
    "server_id string, source_file_path string, segment string, block_start bigint, "
    "place bigint, line string"
)
LISTING = (
    "path string, modificationTime timestamp, length bigint, content binary, "
    "server_id string, source_file_path string"
)


_GLOB = str.maketrans({c: f"\\{c}" for c in "\\*?[]{}"})


def scan_landed(
    spark: SparkSession, root: str, segments: list[str] | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """Lines of the landed files, each with its block and its place in the scan.

    `operators.numbering` turns blocks and places into line numbers. `segments` are the paths to
    open, as `landed_segments` lists them; without it all are opened.
    """
    if segments is not None and not segments:
        return spark.createDataFrame([], SCANNED)
    paths = root if segments is None else [path.translate(_GLOB) for path in segments]
    raw = spark.read.schema(LANDED).option("basePath", root).text(paths)
    return with_places(raw.select("*", "_metadata"), encoding)


def scan_files(spark: SparkSession, paths, encoding: str = "UTF-8") -> DataFrame:
    """Lines of the named files (any path Spark's text source takes), without server or leaf."""
    raw = spark.read.text(paths)
    # Plus signs are left alone in file URIs but mean a blank to url_decode.
    uri = F.replace(raw["_metadata.file_path"], F.lit("+"), F.lit("%2B"))
    named = raw.select("value", "_metadata", F.url_decode(uri).alias("source_file_path"))
    return with_places(named, encoding)


def with_places(raw: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """Add segment, block and place to lines that come straight from a file scan."""
    names = [c for c in raw.columns if c not in ("value", "_metadata")]
    with charset(raw.sparkSession, encoding):
        return raw.select(
            *names,
            F.col("_metadata.file_name").alias("segment"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("place"),
            decoded(F.col("value"), encoding).alias("line"),
        )


def landed_segments(spark: SparkSession, root: str) -> DataFrame:
    """FILE_COLUMNS, path, segment, length and modified of the segments that hold bytes."""
    listing = spark.read.format("binaryFile").schema(LISTING).load(root)
    return listing.select(
        *FILE_COLUMNS, "path",
        F.element_at(F.split("path", "/"), -1).alias("segment"),
        "length", F.col("modificationTime").alias("modified"),
    )


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Bytes per landed log file, from the listing; no file is opened.

    A scan never sees files of zero bytes, but the listing behind it, which Spark holds on the
    driver, names them: their leaves are added with size 0.
    """
    listing = spark.read.format("binaryFile").schema(LISTING).load(root)
    leaves = {tuple(name.rsplit("/", 3)[1:3]) for name in listing.inputFiles()}
    names = spark.createDataFrame(sorted(leaves), "server string, file string")
    # A listed name is a URI of the path, in which Spark has escaped the partition values. Plus
    # signs are left alone in file URIs but mean a blank to url_decode.
    for column in ("server", "file"):
        for _ in range(2):
            plain = F.replace(F.col(column), F.lit("+"), F.lit("%2B"))
            names = names.withColumn(column, F.url_decode(plain))
    names = names.select(
        F.regexp_replace("server", "^server_id=", "").alias("server_id"),
        F.regexp_replace("file", "^source_file_path=", "").alias("source_file_path"),
        F.lit(0).cast("bigint").alias("length"),
    )
    found = listing.select(*FILE_COLUMNS, "length").unionByName(names)
    return found.groupBy(*FILE_COLUMNS).agg(F.sum("length").alias("file_size_bytes"))
