"""A table clustered by a space-filling order, so that ranges of several columns meet few files.

Each clustering column is cut into ranges of about equal frequency; the bits of the range numbers are interleaved
(Z order) and rows are range-partitioned and sorted by that value, then by the columns, so that one hot value is
split over files. A small table beside it holds least and greatest values per file; ``read`` opens only the files whose
bounds meet the ranges asked for, and within them the sort lets Parquet skip row groups.

Numbers, dates and timestamps are ordered as numbers, texts by their first seven bytes, which only decides how well
files are cut: bounds and filters use the whole values. Nulls come first; a range never holds them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import folder_bytes

FILE_BYTES = 128 << 20


def _number(df: DataFrame, name: str) -> Column:
    """The column as a number in its own order."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        head = F.hex(F.substring(F.encode(c, "utf-8"), 1, 7))
        return F.conv(F.rpad(head, 14, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double")
    return c.cast("double")


def _range_of(c: Column, borders: list[float]) -> Column:
    """How many of the sorted borders are at most ``c``: a balanced tree of comparisons."""
    def part(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c >= borders[mid], part(mid + 1, hi)).otherwise(part(lo, mid))
    return F.coalesce(F.when(c.isNull(), F.lit(0)).otherwise(part(0, len(borders))), F.lit(0))


def curve(df: DataFrame, cols: list[str], bits: int = 5) -> Column:
    """The place of a row on the Z curve over ``cols``, each cut into at most 2**bits ranges of about equal frequency."""
    if bits * len(cols) > 62:
        raise ValueError("a place has at most 62 bits")
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(_number(df, c), steps, 10_000).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    place = F.lit(0).cast("long")
    for i, c in enumerate(cols):
        at = _range_of(_number(df, c), sorted(set(found[f"b{i}"] or []))).cast("long")
        for bit in range(bits):
            one = F.shiftright(at, bit).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(cols) + len(cols) - 1 - i))
    return place


class Clustered:
    """A clustered table under ``path``: ``rows/`` and ``bounds/`` (file, number of rows, least and greatest values)."""

    def __init__(self, spark: SparkSession, path: str, cols: list[str]):
        self.spark, self.path, self.cols = spark, path, list(cols)

    def write(self, df: DataFrame, files: int, bits: int = 5) -> None:
        """Write ``df`` in about ``files`` files. ``df`` is read twice (borders, rows), and once more for the borders of
        the partitions: give a written table."""
        (df.withColumn("__place", curve(df, self.cols, bits)).repartitionByRange(max(1, files), "__place", *self.cols)
         .sortWithinPartitions("__place", *self.cols).drop("__place").write.mode("overwrite").parquet(f"{self.path}/rows"))
        rows = self.rows()
        # the columns of the bounds come from the files' own statistics where Parquet has them
        ends = [f(c).alias(f"{n}_{c}") for c in self.cols for n, f in (("min", F.min), ("max", F.max))]
        (rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"), *ends)
         .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/bounds"))

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def bounds(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/bounds")

    def files(self, ranges: Mapping[str, tuple]) -> list[str]:
        """The files that may hold rows within all ``ranges`` (column: least and greatest value, both inside, None: open)."""
        b = self.bounds()
        for c, (low, high) in ranges.items():
            if c not in self.cols:
                raise ValueError(f"{c} is not a clustering column")
            b = b.where(F.col(f"max_{c}") >= F.lit(low)) if low is not None else b.where(F.col(f"max_{c}").isNotNull())
            if high is not None:
                b = b.where(F.col(f"min_{c}") <= F.lit(high))
        return sorted(r[0] for r in b.select("file").collect())     # file names only, as many as a listing has

    def read(self, ranges: Mapping[str, tuple]) -> DataFrame:
        """The rows within all ``ranges``, from the files that may hold some."""
        found, schema = self.files(ranges), self.rows().schema
        df = self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)
        for c, (low, high) in ranges.items():
            df = df.where(F.col(c).isNotNull())
            df = df if low is None else df.where(F.col(c) >= F.lit(low))
            df = df if high is None else df.where(F.col(c) <= F.lit(high))
        return df


def files_for(spark: SparkSession, path: str, least: int = 1, file_bytes: int = FILE_BYTES) -> int:
    """A number of files by the size of the written table that is to be clustered."""
    return max(least, math.ceil(folder_bytes(spark, path) / file_bytes))
