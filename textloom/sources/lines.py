"""Line-oriented text files: URL lists, labelled lines, plain corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.fixed import LABEL_HIGH
from textloom.functions.text import label_of, not_blank, one_line, strip_label, strip_space
from textloom.session import BROADCAST_ROWS, materialize


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row for each line; gzip files are read as they are."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def trim_urls(df: DataFrame, url: str = "url") -> DataFrame:
    return df.withColumn(url, strip_space(F.col(url))).filter(F.col(url) != "")


def number_lines(spark: SparkSession, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Lines with their running number over all files, from 0, files in order of their paths.

    Rows of a split follow each other in a task, so their place in it is the
    distance to its first row.  The splits before it are counted in a pass that
    reads no text beyond line ends; only one row for a split is ordered.
    """
    split = ("path", "block")
    read = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))
    splits = materialize(read.groupBy(*split).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")), "splits")
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(*split, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    if splits.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    return read.join(starts, [*split]).select((F.col("row") + F.col("shift")).alias(key), F.col("value").alias(text))


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """``url_rank, url`` in the order of files and lines, blank lines skipped."""
    return trim_urls(number_lines(spark, path, "url", "url_rank"))


def parse_labelled(df: DataFrame, text: str = "text") -> DataFrame:
    """Split a labelled line into ``label`` and text; blank lines go."""
    kept = df.filter(not_blank(F.col(text)))
    return kept.withColumns({"label": label_of(F.col(text)), text: strip_label(F.col(text))})


def read_labelled_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_labelled(read_lines(spark, path)).select("label", "text")


def write_lines(df: DataFrame, path: str, text: str = "text", mode: str = "errorifexists") -> None:
    """One document per line."""
    df.select(one_line(F.col(text)).alias("value")).write.mode(mode).text(path)


def labelled(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn(text, F.concat(F.lit(LABEL_HIGH), F.col(text)))


def write_labelled_lines(df: DataFrame, path: str, text: str = "text", mode: str = "errorifexists") -> None:
    write_lines(labelled(df, text), path, text, mode)


def export_split(df: DataFrame, path: str, text: str = "text") -> None:
    """Write the text of every record; an existing target is left alone."""
    df.select(F.col(text).alias("value")).write.mode("ignore").text(path)
