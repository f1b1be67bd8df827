"""Sinks: event reports, pixel cubes, lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fringeline.functions.scalar import coherence_to_byte, pair_name


def append_unseen(rows: DataFrame, path: str, on: list[str], sep: str = ";") -> None:
    """Append rows whose key the CSV at ``path`` lacks; write them all if there is none yet."""
    spark = rows.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        old = spark.read.option("header", True).option("sep", sep).schema(rows.schema).csv(path)
        rows = rows.join(old.select(*on), on, "left_anti")
    rows.write.mode("append").option("header", True).option("sep", sep).csv(path)


def rewrite_report(rows: DataFrame, path: str, sep: str = ";") -> None:
    """The whole report anew, in place of what is there."""
    rows.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def morton(x: Column, y: Column, bits: int = 16) -> Column:
    """Interleaved bits of two whole numbers from 0 to 2**bits - 1: neighbours in both stay near one another in order."""
    out = F.lit(0).cast("long")
    for i in range(bits):
        for shift, c in ((2 * i, x), (2 * i + 1, y)):
            out = out + F.shiftleft(F.shiftright(c.cast("long"), i).bitwiseAND(F.lit(1).cast("long")), shift)
    return out


def with_cell(points: DataFrame, x: str, y: str, size: float, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """``points`` with the number of their cell in Morton order, for cells of ``size`` from (x0, y0) on. Places before that are in the first cells, and
    their rows are found as others are."""
    at = lambda c, low: F.greatest(F.least(F.floor((F.col(c) - low) / size), F.lit(65_535)), F.lit(0))
    return points.withColumn("cell", morton(at(x, x0), at(y, y0)))


def clustered(points: DataFrame, path: str, x: str, y: str, size: float, x0: float = 0.0, y0: float = 0.0, files: int | None = None, group_bytes: int = 16 << 20, rows: int | None = None) -> None:
    """A Parquet table whose row groups are compact areas: rows are dealt to files by ranges of their cell, and sorted by it within. A clip by x and y then
    skips the row groups whose bounds lie outside. ``rows`` bounds a row group's rows too."""
    dealt = with_cell(points, x, y, size, x0, y0)
    dealt = dealt.repartitionByRange(files, "cell") if files else dealt.repartitionByRange("cell")
    out = dealt.sortWithinPartitions("cell").write.mode("overwrite").option("parquet.block.size", str(group_bytes))
    out = out.option("parquet.block.row.count.limit", str(rows)) if rows else out
    out.parquet(path)


def pixel_cube(pixels: DataFrame, path: str, coh: str = "coh", cell: int = 64) -> None:
    """Pixels by frame and epoch, with coherence as bytes and the number of inputs as a column. A frame's epoch is cut into ranges of cells of
    ``cell`` x ``cell`` pixels, which are a column of the table, so that row groups are compact."""
    rows = with_cell(pixels.withColumn(coh, coherence_to_byte(F.col(coh))), "col", "row", cell)
    rows.repartitionByRange("frame", "epoch", "cell").sortWithinPartitions("frame", "epoch", "cell").write.mode("overwrite").partitionBy("frame", "epoch").parquet(path)


def pair_file(pairs: DataFrame, path: str) -> None:
    pairs.select(pair_name(F.col("epoch1"), F.col("epoch2")).alias("value")).write.mode("overwrite").text(path)


def text_list(rows: DataFrame, column: str, path: str) -> None:
    rows.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
