"""Zone maps: what each file of an archive holds, so that a question opens only the files that can answer it.

The map of a family is a Parquet table beside its files, one row a file: bytes, rows, first and last time, and for
chosen columns the lowest and highest value and which of SKETCH_BITS hash values occur. It is asked with a filter
or a join, and only the names of the files that are left come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.archive import ArchiveError, open_family, part_files

#: Hash values of a column that a file's sketch tells apart; a sketch has no more entries than that.
SKETCH_BITS = 8192
#: Files that are named one by one; where more are left, the folder is read and only filtered.
MOST_FILES = 50_000
_NAME = r"(?:day=[^/]*/)?[^/]*$"


def _bit(c: str) -> Column:
    return F.pmod(F.xxhash64(F.col(c)), F.lit(SKETCH_BITS)).cast("int")


def _folder(root: str, family: str) -> str:
    return f"{root}/zones/family={family}"


def write_zones(spark: SparkSession, root: str, entry: dict, columns: Sequence[str] = ()) -> None:
    """Write the map of one exported family. columns: those that a question may name besides the time."""
    at = entry["at"]
    path = f"{root}/family={entry['family']}"
    rows = spark.read.schema(StructType.fromJson(entry["schema"])).parquet(path).select(F.regexp_extract("_metadata.file_path", _NAME, 0).alias("file"), at, *[c for c in columns if c != at])
    facts = [F.count(F.lit(1)).alias("rows"), F.min(at).alias("first"), F.max(at).alias("last"), F.count_if(F.col(at).isNull()).alias("timeless")]
    for c in columns:
        facts += [F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"), F.collect_set(_bit(c)).alias(f"bits_{c}")]
    found = part_files(spark, path).join(rows.groupBy("file").agg(*facts), "file", "left").fillna(0, ["rows", "timeless"])
    found.write.mode("errorifexists").parquet(_folder(root, entry["family"]))


def zones(spark: SparkSession, root: str, family: str) -> DataFrame:
    return spark.read.parquet(_folder(root, family))


def _times(start: str | None, end: str | None, first: Column, last: Column) -> Column:
    inside = F.lit(True)
    if start is not None:
        inside &= last >= F.lit(start).cast("timestamp_ntz")
    if end is not None:
        inside &= first < F.lit(end).cast("timestamp_ntz")
    return inside


def files_for(spark: SparkSession, root: str, family: str, start: str | None = None, end: str | None = None, among: DataFrame | None = None) -> DataFrame:
    """Rows of the map of the files that may hold a row with time in [start, end) and, where `among` (one column, named as in the family) is given, one of its values."""
    found = zones(spark, root, family).filter("rows > 0").filter(_times(start, end, F.col("first"), F.col("last")))
    if among is None:
        return found
    (c,) = among.columns
    if f"bits_{c}" not in found.columns:
        raise ArchiveError(f"the zone map of {family} does not have {c}")
    wanted = among.filter(F.col(c).isNotNull()).select(_bit(c).alias("bit"), F.col(c).alias("value"))
    # A row for each bit of the sketches and of the values asked for: neither side grows with the rows of the archive.
    wanted = wanted.groupBy("bit").agg(F.min("value").alias("least"), F.max("value").alias("greatest"))
    bits = found.select("file", f"low_{c}", f"high_{c}", F.explode(f"bits_{c}").alias("bit"))
    hit = bits.join(wanted, "bit").filter((F.col("greatest") >= F.col(f"low_{c}")) & (F.col("least") <= F.col(f"high_{c}"))).select("file").distinct()
    return found.join(hit, "file", "left_semi")


def open_range(spark: SparkSession, root: str, entry: dict, start: str | None = None, end: str | None = None, among: DataFrame | None = None) -> DataFrame:
    """The rows of a family with time in [start, end), from the files alone that may have any. among: a one-column table of values; rows with one of them are kept."""
    family, schema = entry["family"], StructType.fromJson(entry["schema"])
    names = [r["file"] for r in files_for(spark, root, family, start, end, among).select("file").limit(MOST_FILES + 1).collect()]
    if not names:
        return spark.createDataFrame([], schema)
    if len(names) > MOST_FILES:
        df = open_family(spark, root, entry)
    else:
        df = spark.read.schema(schema).parquet(*[f"{root}/family={family}/{n}" for n in sorted(names)])
    at = F.col(entry["at"])
    if start is not None or end is not None:
        df = df.filter(_times(start, end, at, at))
    return df if among is None else df.join(among.distinct(), among.columns, "left_semi")
