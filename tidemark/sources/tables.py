"""Reading families of facts: tolerant scans, hot and cold halves, idempotent appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.work import spread


def tolerant(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of the schema, in its order and types; a column that is not there is null."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def family(spark: SparkSession, paths: Sequence[str], schema: StructType) -> DataFrame:
    """A family's files as one table; without files an empty one."""
    if not paths:
        return spark.createDataFrame([], schema)
    return tolerant(spark.read.option("mergeSchema", "true").parquet(*paths), schema)


def time_range(df: DataFrame, at: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """start <= at < end; a bound that is not given leaves no predicate behind."""
    kind = dict(df.dtypes)[at]
    if start is not None:
        df = df.filter(F.col(at) >= F.lit(start).cast(kind))
    return df.filter(F.col(at) < F.lit(end).cast(kind)) if end is not None else df


def _content(columns: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def conflicts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose rows differ in content; equal repeats are none."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.countDistinct(_content(rest)).alias("versions")).filter("versions > 1")


def unanimous(df: DataFrame, key: Sequence[str], said: Sequence[str], what: str) -> DataFrame:
    """One row for each key: the key and the columns `said`. Evaluating it raises, naming `what`, if rows of a key say different things."""
    each = df.groupBy(*key).agg(F.min(_content(said)).alias("_low"), F.max(_content(said)).alias("_high"), F.first(F.struct(*said)).alias("_said"))
    wrong = F.raise_error(F.concat(F.lit(f"{what}: "), F.to_json(F.struct(*key)))).cast("boolean")
    return each.filter(F.when(F.col("_low") == F.col("_high"), F.lit(True)).otherwise(wrong)).select(*key, "_said.*")


def hot_cold(cold: DataFrame, hot: DataFrame, at: str, hot_from: str, key: str | None = None) -> DataFrame:
    """Cold rows before the cutoff and hot rows from it on, with the side.

    With a key, each fact comes once, and evaluating the union raises if any two rows of a key, on whichever
    side of the cutoff, have different content."""
    if key is None:
        return time_range(cold, at, None, hot_from).withColumn("side",
            F.lit("cold")).unionByName(time_range(hot, at, hot_from).withColumn("side", F.lit("hot")), allowMissingColumns=True)
    kind = dict(cold.dtypes)[at]
    early = F.col(at) < F.lit(hot_from).cast(kind)
    both = cold.withColumn("_own", early).unionByName(hot.withColumn("_own", ~early), allowMissingColumns=True)
    columns = [c for c in both.columns if c != "_own"]
    rest = [c for c in columns if c != key]
    owned = both.groupBy(key).agg(F.bool_or("_own").alias("_own")).filter("_own").select(key)
    return unanimous(both, [key], rest, "hot and cold facts have conflicting content").join(owned, key, "left_semi").select(*columns,
        F.when(early, "cold").otherwise("hot").alias("side"))


def epoch_validity(*parts: DataFrame) -> DataFrame:
    """epoch_id and data_valid of every epoch; raises on evaluation if the parts disagree about one."""
    both = parts[0].select("epoch_id", "data_valid")
    for p in parts[1:]:
        both = both.unionByName(p.select("epoch_id", "data_valid"))
    return unanimous(both, ["epoch_id"], ["data_valid"], "histories disagree about the validity of an epoch")


def append_new(stored: DataFrame, batch: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to add, repeats): of a batch the rows whose key is not stored, one for each key, and the rows that lost."""
    held, batch = spread(stored.select(*key), *key), spread(batch, *key)
    fresh = batch.join(held, list(key), "left_anti").dropDuplicates(list(key))
    return fresh, batch.join(held, list(key), "left_semi")


def get_or_create(stored: DataFrame, seen: DataFrame, key: Sequence[str], at: str, payload: Sequence[str], parent: Sequence[str] = ()) -> DataFrame:
    """A dimension with a row for each key: the stored one, else the payload seen first.

    parent: those columns of the payload that a key never changes; evaluating the result raises if what is seen differs in them
    from what is stored or from what else is seen."""
    first = seen.groupBy(*key).agg(F.min_by(F.struct(*payload), F.struct(at, *payload)).alias("_p")).select(*key, "_p.*")
    out = stored.select(*key, *payload).unionByName(first.join(stored.select(*key), list(key), "left_anti"))
    if parent:
        held = stored.select(*key, *parent).unionByName(seen.select(*key, *parent))
        out = out.join(unanimous(held, key, parent, "a key has two parents").select(*key), list(key))
    return out


def verified_append(stored: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of a batch whose key is new. Evaluating it raises if a key comes with content other than what is
    stored or what another row of the batch holds."""
    rest = [c for c in stored.columns if c not in key]
    digest = lambda df: df.select(*key, *rest, _content(rest).alias("_content"))
    both = digest(stored).withColumn("_held", F.lit(1)).unionByName(digest(batch).withColumn("_held", F.lit(0)))
    keyed = both.groupBy(*key).agg(F.max("_held").alias("_held"), F.min("_content").alias("_low"), F.max("_content").alias("_high"),
        F.first(F.struct(*rest)).alias("_row"))
    same = F.when(F.col("_low") == F.col("_high"),
        F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("other content under a known key: "), F.to_json(F.struct(*key)))).cast("boolean"))
    return keyed.filter(same).filter("_held = 0").select(*key, "_row.*")


def policy_dimension(stored: DataFrame, documents: DataFrame, body: str = "body") -> DataFrame:
    """Policies addressed by the SHA-256 of their text: stored ones and those that are new, each once."""
    new = documents.select(F.sha2(F.col(body).cast("binary"), 256).alias("policy_sha256"), F.col(body).alias("body")).dropDuplicates(["policy_sha256"])
    return stored.select("policy_sha256", "body").unionByName(new.join(stored.select("policy_sha256"), "policy_sha256", "left_anti"))


def inventory(families: Mapping[str, DataFrame]) -> DataFrame:
    """family, position, name, type, nullable, rows and nulls of every column of every family; a family's rows are counted in one pass."""
    out = []
    for family, df in families.items():
        fields = df.schema.fields
        counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_{i}") for i, f in enumerate(fields)])
        each = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.nullable).alias("nullable"), F.col(f"_{i}").alias("nulls"))
            for i, f in enumerate(fields)])
        out.append(counted.select(F.lit(family).alias("family"), "rows", F.explode(each).alias("x")).select("family", "x.position", "x.name", "x.type", "x.nullable", "rows", "x.nulls"))
    return reduce(DataFrame.unionByName, out)
