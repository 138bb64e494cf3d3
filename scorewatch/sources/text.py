"""Text tables: numbered lines and score files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import is_blank, strip
from ..session import materialise


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of text files, lines counted from 1 within each file.

    A line's number is the number of lines in the earlier blocks of its file plus
    its place in its own block, so no task ever has to see more than its block.
    The files are read once: lines are written with their block and place, and
    blocks are counted from those two columns.
    """
    raw = materialise(spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    ), "lines")
    # One row per block: a file's size over the block size.
    blocks = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return raw.join(starts, ["file", "block"]).select(
        "file", (F.col("offset") + F.col("place") - F.col("first") + 1).alias("line_no"), "value"
    )


def token_lines(lines: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """(…, line_no, value) from a column that holds whole texts."""
    from ..functions.text import lines as split_lines

    return lines.select(*keep, F.posexplode(split_lines(F.col(text))).alias("pos", "value")).select(
        "*", (F.col("pos") + 1).cast("bigint").alias("line_no")
    ).drop("pos")


def text_files(spark: SparkSession, path: str) -> list[str]:
    """The files a path, folder or pattern names, hidden ones left out, as Spark's readers do."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, open_ = [], [s.getPath() for s in store.globStatus(target) or ()]
    while open_:
        for status in store.listStatus(open_.pop()):
            if status.getPath().getName()[0] in "._":
                continue
            if status.isDirectory():
                open_.append(status.getPath())
            elif status.getLen():
                found.append(status.getPath().toString())
    return sorted(found)


def first_character(spark: SparkSession, file: str) -> str:
    """The first character of a file that is no blank; only as much is read as it takes."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        while (byte := stream.read()) >= 0:
            if not chr(byte).isspace():
                return chr(byte)
    finally:
        stream.close()
    return ""


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Scores of files that hold a JSON array of numbers, or one number per line; the two may stand in one folder.

    The first character of each file that is no blank decides how it is read.
    An array is cut at its commas, so it may span lines or be one line of any
    length, and large files are split among tasks. Text that is no number, and
    an array that is not closed, raise; blank lines are skipped.
    """
    files = text_files(spark, path)
    arrays = [f for f in files if first_character(spark, f) == "["]
    plain = [f for f in files if f not in set(arrays)]

    def numbers(rows: DataFrame) -> DataFrame:
        number = F.col("text").try_cast("double")
        broken = F.raise_error(F.concat(F.lit("no number: "), F.substring("text", 1, 80))).cast("double")
        return rows.select(F.when(number.isNotNull(), number).otherwise(broken).alias("score"))

    found = spark.createDataFrame([], "score double")
    if plain:
        lines = spark.read.text(plain).where(~is_blank(F.col("value")))
        found = numbers(lines.select(strip(F.col("value")).alias("text")))
    if arrays:
        parts = spark.read.option("lineSep", ",").text(arrays).select(strip(F.col("value")).alias("text"), F.col("_metadata.file_path").alias("file"))
        ends = parts.groupBy("file").agg(F.count_if(F.col("text").startswith("[")).alias("opened"), F.count_if(F.col("text").endswith("]")).alias("closed"))
        odd = ends.where("opened <> 1 OR closed <> 1").limit(1).collect()
        if odd:
            raise ValueError(f"{odd[0]['file']} is no JSON array of numbers")
        inner = strip(F.regexp_replace("text", r"^\[|\]$", ""))
        empty = F.col("text").rlike(r"^\[\s*\]$")
        found = found.unionByName(numbers(parts.where(~empty).select(inner.alias("text"))))
    return found
