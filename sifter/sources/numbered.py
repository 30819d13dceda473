"""Text files as numbered records, in the order of the files.

Spark reads a file's blocks in any order and on any task, so a row has no
number of its own.  ``numbered_lines`` gives every line its number over all
files (by path, then place): the lines are written once with their file, the
start of their block and a number that rises by one within a task; the
lines of each block are counted; running sums over a file's blocks, and
over the files, give each block its first number.  Only the table of blocks
is sorted, by file; no line is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sifter.session import stage


def numbered_lines(spark: SparkSession, path: str, keep_empty: bool = False, line_sep: str | None = None) -> DataFrame:
    """(number, value, file, block): the lines below ``path`` from 0 on.  Empty
    lines are no records unless ``keep_empty``."""
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                     F.col("_metadata.file_block_start").alias("block"))
    if not keep_empty:
        lines = lines.filter(F.col("value") != "")
    # a block's lines are read one after the other by one task
    lines = stage(lines.withColumn("place", F.monotonically_increasing_id()), "numbered-lines")
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    files = blocks.groupBy("file").agg(F.sum("n").alias("n"))
    # one row a file
    ahead = files.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    in_file = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    starts = blocks.withColumn("in_file", in_file).join(ahead, "file").select(
        "file", "block", (F.col("before") + F.col("in_file") - F.col("first")).alias("start"))
    return lines.join(starts, ["file", "block"]).select((F.col("start") + F.col("place")).alias("number"), "value", "file", "block")


def quoted_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(number, record, file, first): the records of files whose quoted fields
    may hold line ends, read by many tasks a file.

    A line starts a record if an even number of quotes stands before it in
    its file (a doubled quote counts two and changes nothing).  That number
    is a running sum inside the line's block and another over the file's
    blocks; likewise the record of a line is the last start in its block or,
    if there is none, in the blocks before.  Lines are grouped by block once
    and by record once; a record may span blocks.  ``number`` is the place of
    the record's first line, ``first`` marks a file's first record.  A file
    that ends inside quotes ends its last record there.  Empty records are
    left out.
    """
    lines = numbered_lines(spark, path, keep_empty=True, line_sep="\n").withColumn(
        "quotes", F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit(""))))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = lines.groupBy("file", "block").agg(F.sum("quotes").alias("n")).select(
        "file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    in_block = Window.partitionBy("file", "block").orderBy("number")
    running = F.col("before") + F.sum("quotes").over(in_block) - F.col("quotes")
    lines = lines.join(before, ["file", "block"]).withColumn("start", F.when(running % 2 == 0, F.col("number")))
    lines = stage(lines.select("number", "value", "file", "block", "start", F.last("start", True).over(in_block).alias("own")), "csv-lines")
    carried = lines.groupBy("file", "block").agg(F.max("start").alias("last"), F.min("number").alias("least")).select(
        "file", "block", F.max("last").over(earlier).alias("carried"), F.min("least").over(Window.partitionBy("file")).alias("least"))
    keyed = lines.join(carried, ["file", "block"]).select(
        "file", "least", F.coalesce("own", "carried").alias("record_start"), F.struct("number", "value").alias("line"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["value"]), "\n")
    records = keyed.groupBy("file", "least", "record_start").agg(F.regexp_replace(text, "\r$", "").alias("record"))
    return records.filter(F.col("record") != "").select(
        F.col("record_start").alias("number"), "record", "file", (F.col("record_start") == F.col("least")).alias("first"))
