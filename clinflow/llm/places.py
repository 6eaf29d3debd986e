"""Rows of stored tables found again by their place, so that a text nobody asked for stays where it is.

A place is the hash of a file's path and the number of a row within it. Which rows are wanted is a set of bits: per file
and 32,768 rows, a bitmap that Spark aggregates. The bitmaps meet the scan as a broadcast, a bit per row scanned. Where
those of a whole table would be too large, the table is gone through in groups of files, each scanned once with the bitmaps
of its own files alone; what is made of a group is stored before the next begins. So no text moves to find the wanted ones, at any
size. Only if a single file has more rows than a broadcast has bits, its group is joined by a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from clinflow.scratch import materialize, new_path

FILE, ROW, MARKED = "__file", "__row", "__marked"
PLACE = (FILE, ROW)
# Rows of one bitmap, and what it takes at most.
_BUCKET = 32_768
_BUCKET_BYTES = 4_200


def place() -> dict[str, Column]:
    return {FILE: F.xxhash64("_metadata.file_path"), ROW: F.col("_metadata.row_index")}


def with_place(rows: DataFrame) -> DataFrame:
    """``rows`` with their places. They must be rows of files, selected or filtered at most; a frame of no files is stored first."""
    try:
        if rows.inputFiles():
            return rows.withColumns(place())
    except AnalysisException:  # of files, but not straight from them
        pass
    return materialize(rows, "placed").withColumns(place())


def _has(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bits, F.shiftright(position, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, position % 8) == 1, F.lit(False))


def marked(rows: DataFrame, marks: DataFrame, most_bytes: int) -> list[DataFrame]:
    """``rows``, which have places, in groups of files, with MARKED: whether ``marks`` names their place.

    One group, unless the bitmaps take more than ``most_bytes``.
    """
    row = F.col(ROW)
    bucket, position = F.floor(row / _BUCKET).cast("int"), F.pmod(row, F.lit(_BUCKET)).cast("int")
    bits = marks.select(F.col(FILE).alias("__f"), bucket.alias("__bucket"), position.cast("long").alias("at"))
    bits = materialize(bits.groupBy("__f", "__bucket").agg(F.bitmap_construct_agg("at").alias("__bits")), "place-bits")

    def largest(groups: int) -> int:
        sizes = bits.groupBy(F.pmod("__f", F.lit(groups))).count()
        return (sizes.agg(F.max("count").alias("n")).first()["n"] or 0) * _BUCKET_BYTES

    files = bits.select("__f").distinct().count()
    groups, size = 1, largest(1)
    while size > most_bytes and groups < 4 * files:
        groups *= 2
        size = largest(groups)
    out = []
    for group in range(groups):
        mine, held = rows, bits
        if groups > 1:
            # Files of other groups are not opened: the condition is on the path alone.
            mine = rows.filter(F.pmod(FILE, F.lit(groups)) == group)
            held = bits.filter(F.pmod("__f", F.lit(groups)) == group)
        held = F.broadcast(held) if size <= most_bytes else held
        found = mine.join(held, (F.col(FILE) == F.col("__f")) & (bucket == F.col("__bucket")), "left")
        out.append(found.withColumn(MARKED, _has(F.col("__bits"), position)).drop("__f", "__bucket", "__bits"))
    return out


def by_mark(rows: DataFrame, marks: DataFrame, made: Callable[[DataFrame], DataFrame], most_bytes: int = 64 << 20) -> DataFrame:
    """What ``made`` makes of ``rows`` with MARKED, group by group; each row is made into something by itself."""
    groups = marked(rows, marks, most_bytes)
    if len(groups) == 1:
        return made(groups[0])
    path = new_path(rows.sparkSession, "by-mark")
    for group in groups:
        found = made(group)
        found.write.mode("append").parquet(path)
    return rows.sparkSession.read.schema(found.schema).parquet(path)
