"""Merkle trees over sorted rows, so that two tables are compared by a few digests and the first difference is found by descent.

Rows have places 0, 1, ... in an order. A leaf is the SHA-256 of the digests of FAN rows in a row, a node that of FAN nodes
below it, up to one root. Groups of FAN are all that is ever put together, and levels are logarithmic in the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.archive import ArchiveError
from tidemark.work import durable

FAN = 512


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row as JSON with its nulls, columns by name."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256))


def _up(nodes: DataFrame, by: Sequence[str]) -> DataFrame:
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "digest"))), lambda x: x["digest"])
    joined = F.aggregate(ordered, F.lit(b""), lambda a, x: F.concat(a, x))
    return nodes.groupBy(*by, F.floor(F.col("place") / FAN).alias("place")).agg(F.unhex(F.sha2(joined, 256)).alias("digest"))


def tree(placed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, level, place, digest: all nodes of the tree of each `by` from level 1 (leaves) to its root. placed: by, place, digest (of a row). Durable levels."""
    level, nodes, out = 1, durable(_up(placed, by), "merkle-1"), None
    while True:
        named = nodes.withColumn("level", F.lit(level))
        out = named if out is None else out.unionByName(named)
        if (nodes.agg(F.max("place")).first()[0] or 0) == 0:
            return out.select(*by, "level", "place", "digest")
        level += 1
        # Trees that already have one node carry it on as it is, so all roots are on the last level.
        nodes = durable(_up(nodes, by), f"merkle-{level}")


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """df with place: its rank in the order, which must tell rows apart. One range shuffle; only a count for each partition is summed up."""
    rows = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    rows = durable(rows.withColumn("_part", F.shiftright("_id", 33)), "in-order")
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("_start"))  # a row for each partition
    return rows.join(F.broadcast(starts), "_part").withColumn("place", F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_id", "_start")


def content_tree(df: DataFrame, *order: str) -> DataFrame:
    """The tree of a table's rows in an order that tells them apart: the same however the table is cut into files or partitions."""
    placed = in_order(df, *order)
    return tree(placed.select("place", row_digest(df).alias("digest")))


def root_of(nodes: DataFrame) -> str | None:
    """The root of a tree without `by`, as hex; None for one without rows."""
    top = nodes.orderBy(F.desc("level"), "place").limit(1).select(F.lower(F.hex("digest"))).collect()
    return top[0][0] if top else None


def first_difference(one: DataFrame, two: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, first_row and rows_until: for each tree that differs, the first FAN rows among which there is a difference. A side's missing tree differs from row 0 on.

    Leaves alone differ where rows do, so they are joined; the nodes above tell whether there is anything to join."""
    keys = [*by, "place"]
    leaf = lambda t, name: t.filter("level = 1").select(*keys, F.col("digest").alias(name))
    apart = leaf(one, "a").join(leaf(two, "b"), keys, "full").filter(~F.col("a").eqNullSafe(F.col("b")))
    first = (F.min("place") * FAN).alias("first_row")
    found = apart.groupBy(*by).agg(first) if by else apart.agg(first).filter("first_row IS NOT NULL")
    return found.withColumn("rows_until", F.col("first_row") + FAN)


def _tree_folder(root: str, family: str) -> str:
    return f"{root}/trees/family={family}"


def _file_digests(spark: SparkSession, root: str, family: str) -> DataFrame:
    """SHA-256 of the bytes of each file, hashed where it is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{root}/family={family}")
    return files.select(F.regexp_extract("path", r"(?:day=[^/]*/)?[^/]*$", 0).alias("file"), F.sha2("content", 256).alias("sha256"))


def _file_trees(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    """The tree of the rows of each file, as they stand in it."""
    df = spark.read.schema(StructType.fromJson(entry["schema"])).parquet(f"{root}/family={entry['family']}")
    name = F.regexp_extract("_metadata.file_path", r"(?:day=[^/]*/)?[^/]*$", 0)
    columns = [f["name"] for f in entry["schema"]["fields"]]
    plain = df.select(*[F.col(f"`{c}`") for c in columns])
    return tree(df.select(name.alias("file"), F.col("_metadata.row_index").alias("place"), row_digest(plain).alias("digest")), ["file"])


def seal(spark: SparkSession, root: str, entry: dict) -> None:
    """Write the digests of a family's files and the trees of their rows beside them."""
    family = entry["family"]
    _file_trees(spark, root, entry).write.mode("errorifexists").parquet(_tree_folder(root, family))
    _file_digests(spark, root, family).write.mode("errorifexists").parquet(f"{root}/digests/family={family}")


def broken(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    """file, fault, first_row: files of a sealed family that are missing, not of it, or of other bytes, and the first rows that are not where they were. Empty if it is sound.

    Bytes are compared first; only the rows of a family with a fault in them are looked at."""
    family = entry["family"]
    said = spark.read.parquet(f"{root}/digests/family={family}")
    found = durable(_file_digests(spark, root, family).withColumnRenamed("sha256", "now").join(said, "file", "full"), "file-digests")
    fault = F.when(F.col("now").isNull(), "missing").when(F.col("sha256").isNull(), "not of the archive").when(F.col("now") != F.col("sha256"), "altered")
    faults = found.select("file", fault.alias("fault")).filter("fault IS NOT NULL")
    altered = faults.filter("fault = 'altered'")
    if altered.isEmpty():
        return faults.withColumn("first_row", F.lit(None).cast("long"))
    try:
        now = _file_trees(spark, root, entry)
    except Exception as e:  # noqa: BLE001  a file that can't be read as Parquet at all
        raise ArchiveError(f"{family}: a file can't be read: {e}") from e
    differ = first_difference(spark.read.parquet(_tree_folder(root, family)), now, ["file"]).select("file", "first_row")
    return faults.join(differ, "file", "left")
