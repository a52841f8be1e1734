"""Archives: Parquet by family and day with a manifest that a reader can verify.

Rows are written and counted by Spark; only counts, digests, times and names of parts
reach the driver, one row for each day and one for each file.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class ArchiveError(ValueError):
    pass


def _file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in any store that Spark reaches; it appears whole, by a rename."""
    p, fs = _file(spark, path)
    half, _ = _file(spark, path + ".part")
    out = fs.create(half, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    if not fs.rename(half, p):
        raise ArchiveError(f"{path} could not be published")


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def _hash(columns: Sequence[str], kinds: dict[str, str], seed: int) -> Column:
    # A map has no hash of its own; its text has.
    return F.xxhash64(F.lit(seed), *[F.to_json(c) if "map<" in kinds[c] else F.col(f"`{c}`") for c in columns])


def family_facts(df: DataFrame, at: str, key: Sequence[str]) -> DataFrame:
    """For each day: rows, digests of the key and of all columns, nulls of each column that has any, and bounds of key and time.

    Digests are sums over rows of 32 bits of a hash, so they don't depend on order; that of all columns has two, of different hashes."""
    kinds = dict(df.dtypes)
    total = lambda columns, seed: F.sum(_hash(columns, kinds, seed).bitwiseAND(F.lit((1 << 32) - 1)))
    nulls = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(f"`{c}`").isNull()).alias("n")) for c in df.columns]
    keys = F.struct(*key)
    each = df.groupBy(F.date_format(at, "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), total(key, 0).alias("digest"), F.array(total(df.columns, 1), total(df.columns, 2)).alias("content"),
        F.array(*nulls).alias("nulls"),
        F.to_json(F.min(keys)).alias("lowest"), F.to_json(F.max(keys)).alias("highest"), F.min(at).cast("string").alias("first"),
        F.max(at).cast("string").alias("last"),
    )
    return each.withColumn("nulls", F.map_from_entries(F.filter("nulls", lambda x: x["n"] > 0)))


def part_files(spark: SparkSession, path: str) -> DataFrame:
    """Name and bytes of each Parquet file below a path, as the store lists them; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.regexp_extract("path", r"(?:day=[^/]*/)?[^/]*$", 0).alias("file"), F.col("length").alias("bytes"))


def export_family(df: DataFrame, root: str, family: str, at: str, key: Sequence[str], max_rows: int = 1_000_000) -> dict:
    """Write one family by day, sorted by time and key within files; returns its manifest entry.

    A family without rows still gets a file with its schema."""
    path = f"{root}/family={family}"
    days = df.withColumn("day", F.date_format(at, "yyyy-MM-dd"))
    # A range, not a hash of the day: a large day spreads over several tasks and files.
    ordered = days.repartitionByRange(F.col("day"), F.col(at), *key).sortWithinPartitions("day", at, *key)
    if df.isEmpty():
        days.drop("day").coalesce(1).write.mode("errorifexists").parquet(path)
    else:
        ordered.write.mode("errorifexists").option("compression", "zstd").option("maxRecordsPerFile", max_rows).partitionBy("day").parquet(path)
    parts = [r.asDict() for r in family_facts(df, at, key).orderBy("day").collect()]
    files = {r["file"]: r["bytes"] for r in part_files(df.sparkSession, path).collect()}
    return {"family": family, "at": at, "key": list(key), "schema": json.loads(df.schema.json()), "days": parts, "files": files}


def publish(spark: SparkSession, root: str, entries: Sequence[dict]) -> str:
    """Write the manifest last, with its digest beside it."""
    text = json.dumps({"version": 2, "entries": sorted(entries, key=lambda e: e["family"])}, sort_keys=True, separators=(",", ":"))
    digest = hashlib.sha256(text.encode()).hexdigest()
    write_text(spark, f"{root}/manifest.json", text)
    write_text(spark, f"{root}/manifest.sha256", digest)
    return digest


def read_manifest(spark: SparkSession, root: str) -> dict:
    text = read_text(spark, f"{root}/manifest.json")
    if hashlib.sha256(text.encode()).hexdigest() != read_text(spark, f"{root}/manifest.sha256").strip():
        raise ArchiveError("the manifest does not match its digest")
    return json.loads(text)


#: Files of a family that are named one by one; where there are more, the folder is read.
MOST_NAMES = 10_000


def open_family(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    """The rows of the files that the manifest names; a stray file beside them is no data."""
    from pyspark.sql.types import StructType

    schema, path = StructType.fromJson(entry["schema"]), f"{root}/family={entry['family']}"
    files = sorted(entry.get("files") or {})
    if "files" in entry and not files:
        return spark.createDataFrame([], schema)
    paths = [f"{path}/{f}" for f in files] if 0 < len(files) <= MOST_NAMES else [path]
    return spark.read.schema(schema).parquet(*paths).select(*schema.names)


def verify(spark: SparkSession, root: str, manifest: dict | None = None) -> list[str]:
    """Faults of an archive, none if it is sound: files that are missing, new or of another size, days of
    which counts, digests of keys or of whole rows, nulls or bounds differ, and repeated keys."""
    faults = []
    for e in (manifest or read_manifest(spark, root))["entries"]:
        stored = {r["file"]: r["bytes"] for r in part_files(spark, f"{root}/family={e['family']}").collect()}
        for name in sorted({*stored, *e["files"]}):
            if stored.get(name) != e["files"].get(name):
                faults.append(f"{e['family']} {name}: {stored.get(name)} bytes instead of {e['files'].get(name)}")
        df = open_family(spark, root, e | {"files": stored})  # all that is there, so that a stray file shows in its day too
        found = {r["day"]: r.asDict() for r in family_facts(df, e["at"], e["key"]).collect()}
        said = {d["day"]: d for d in e["days"]}
        for day in sorted({*found, *said}):
            if found.get(day) != said.get(day):
                differ = [k for k in {**(found.get(day) or {}), **(said.get(day) or {})} if (found.get(day) or {}).get(k) != (said.get(day) or {}).get(k)]
                faults.append(f"{e['family']} {day}: {', '.join(differ)} not as the manifest says")
        if not df.groupBy(*e["key"]).count().filter("count > 1").isEmpty():
            faults.append(f"{e['family']}: repeated keys")
    return faults


def open_verified(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The families of an archive by name, only if the whole of it is sound."""
    manifest = read_manifest(spark, root)
    if faults := verify(spark, root, manifest):
        raise ArchiveError("; ".join(faults))
    return {e["family"]: open_family(spark, root, e) for e in manifest["entries"]}


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.filter(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def copy_archive(spark: SparkSession, source: str, target: str) -> list[str]:
    """Copy an archive to another store that Spark reaches, then compare it there; the manifest comes last, so a
    reader never finds half an archive. Families already copied are left as they are. Returns the faults, none if sound."""
    manifest = read_manifest(spark, source)
    for e in manifest["entries"]:
        copied, fs = _file(spark, f"{target}/family={e['family']}/_SUCCESS")
        if fs.exists(copied):
            continue
        df = spark.read.parquet(f"{source}/family={e['family']}")
        writer = df.write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy("day") if "day" in df.columns and "day" not in [f["name"] for f in e["schema"]["fields"]] else writer).parquet(f"{target}/family={e['family']}")
    # The copy's own files; days and digests must be those of the source.
    entries = [e | {"files": {r["file"]: r["bytes"] for r in part_files(spark, f"{target}/family={e['family']}").collect()}} for e in manifest["entries"]]
    publish(spark, target, entries)
    return verify(spark, target)


def stored_bytes(df: DataFrame) -> DataFrame:
    """Files and bytes behind a table read from files."""
    files = df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(F.max("file_size").alias("size"))
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def may_be_deleted(states: DataFrame, checks: Sequence[str]) -> DataFrame:
    """Archives with eligible (all checks hold; an unknown one does not) and the names of the checks that do not."""
    failed = F.filter(F.array(*[F.when(~F.coalesce(F.col(c), F.lit(False)), F.lit(c)) for c in checks]), lambda x: x.isNotNull())
    return states.withColumn("failed", failed).withColumn("eligible", F.size("failed") == 0)
