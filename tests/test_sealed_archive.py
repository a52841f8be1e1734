"""Archives: only files that can answer are opened, altered, swapped and moved rows are named, and families are checked against each other."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import fact_queries
from tidemark.sources import archive, integrity, merkle, zones


@pytest.fixture(scope="module")
def sealed(spark, sf_dir, tmp_path_factory):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    root = f"file://{tmp_path_factory.mktemp('sealed')}/a"
    entry = archive.export_family(events, root, "events", "ts", ["event_id"], max_rows=40)
    zones.write_zones(spark, root, entry, ["user_id", "event_id"])
    merkle.seal(spark, root, entry)
    return root, entry, events


def opened(df):
    return {f.rpartition("/family=events/")[2] for f in df.inputFiles()}


def test_only_files_that_overlap_are_opened(spark, sealed):
    root, entry, events = sealed
    days = sorted(r.d for r in events.select(F.date_format("ts", "yyyy-MM-dd").alias("d")).distinct().collect())
    start, end = days[3], days[6]
    got = zones.open_range(spark, root, entry, start, end)
    inside = events.filter((F.col("ts") >= start) & (F.col("ts") < end))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, inside.select(*got.columns).collect()), key=str)
    held = opened(got)
    assert held and all(start <= f[4:14] < end for f in held) and len(held) < len(entry["files"]) / 2
    assert zones.open_range(spark, root, entry, "1990-01-01", "1990-01-02").count() == 0
    assert zones.open_range(spark, root, entry).count() == events.count()


def test_values_pick_files(spark, sealed):
    root, entry, events = sealed
    few = events.orderBy("ts", "event_id").limit(2).select("event_id")
    got = zones.open_range(spark, root, entry, among=few)
    assert got.count() == 2 and 1 <= len(opened(got)) < len(entry["files"]) / 2
    users = events.select("user_id").limit(1)
    want = events.join(users, "user_id", "left_semi").count()
    assert zones.open_range(spark, root, entry, among=users).count() == want > 0
    with pytest.raises(archive.ArchiveError):
        zones.open_range(spark, root, entry, among=events.select("value"))


def test_a_sound_family_has_no_faults_and_every_change_is_named(spark, sealed, tmp_path):
    root, entry, events = sealed
    assert merkle.broken(spark, root, entry).count() == 0
    rows = events.orderBy("ts", "event_id").limit(2000).select("event_id", "ts", "value").collect()
    for change in ("reordered", "swapped", "altered", "missing"):
        at = f"file://{tmp_path}/{change}"
        one = archive.export_family(spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, value double"), at, "events", "ts", ["event_id"], max_rows=3000)
        merkle.seal(spark, at, one)
        name = sorted(one["files"], key=lambda f: -one["files"][f])[0]
        path = f"{at}/family=events/{name}".removeprefix("file://")
        held = spark.read.parquet(f"file://{path}").toPandas()
        k = len(held) - 1
        if change == "reordered":
            held.iloc[[k - 1, k]] = held.iloc[[k, k - 1]].values
        if change == "swapped":
            held.loc[[k - 1, k], "value"] = held.loc[[k, k - 1], "value"].values
        if change == "altered":
            held.loc[k, "value"] += 1
        import os

        if change == "missing":
            os.remove(path)
        else:
            held.to_parquet(path, index=False, coerce_timestamps="us")
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
        (fault,) = merkle.broken(spark, at, one).collect()
        assert fault.file == name and fault.fault == ("missing" if change == "missing" else "altered")
        assert change == "missing" or fault.first_row == k // merkle.FAN * merkle.FAN


def test_digest_of_content_does_not_depend_on_the_cut(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_comment" if False else "l_returnflag")
    order = ("l_orderkey", "l_linenumber")
    one, two = merkle.content_tree(lines.repartition(3), *order), merkle.content_tree(lines.repartition(7, "l_returnflag"), *order)
    assert merkle.root_of(one) == merkle.root_of(two) and merkle.first_difference(one, two).count() == 0
    rows = lines.count()
    place = merkle.in_order(lines, *order)
    assert sorted(r.place for r in place.select("place").collect()) == list(range(rows))
    late = place.filter(F.col("place") == 4000).first()
    changed = lines.withColumn("l_quantity", F.when((F.col("l_orderkey") == late.l_orderkey) & (F.col("l_linenumber") == late.l_linenumber), F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    other = merkle.content_tree(changed, *order)
    assert merkle.root_of(other) != merkle.root_of(one)
    (r,) = merkle.first_difference(one, other).collect()
    assert r.first_row <= 4000 < r.rows_until
    assert merkle.root_of(merkle.content_tree(lines.limit(0), *order)) is None


def test_one_orphan_a_rule_and_counts_and_keys(spark):
    families = {
        "tokens": spark.createDataFrame([(1,), (2,)], "id long"), "pairs": spark.createDataFrame([(10, 1), (11, 2), (12, 9), (12, 1)], "id long, token_id long"),
        "observations": spark.createDataFrame([(i, 10 if i else 77) for i in range(50)] + [(60, None)], "id long, pair_id long"), "boosts": spark.createDataFrame([(1, 2), (2, 5)], "id long, token_id long"),
    }
    rules = fact_queries.REFERENCES
    got = {(r.rule, r.key): r.rows for r in integrity.missing_references(families, rules).collect()}
    assert got == {("pairs_missing_token", "9"): 1, ("observations_missing_pair", "77"): 1, ("observations_missing_pair", None): 1, ("boosts_missing_token", "5"): 1}
    again = [tuple(r) for r in integrity.repeated_keys(families, {"pairs": ["id"], "tokens": ["id"], "absent": ["id"]}).collect()]
    assert again == [("pairs", '{"id":12}', 2)]
    t = lambda *rows: spark.createDataFrame(list(rows), "id long, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    differ = integrity.counts_that_differ({"a": t((1, "2024-01-01"), (2, "2024-01-02")), "b": t((1, "2024-01-01"))}, {"a": t((1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02"))}, {"a": "at", "b": "at"})
    assert sorted(map(tuple, differ.collect())) == [("a", "2024-01-02", 1, 2), ("b", "2024-01-01", 1, 0)]


def test_stray_and_missing_files(spark, sf_dir, tmp_path):
    import os
    import shutil

    events, root = spark.read.parquet(f"{sf_dir}/events.parquet"), f"file://{tmp_path}/a"
    entry = archive.export_family(events, root, "events", "ts", ["event_id"])
    archive.publish(spark, root, [entry])
    one = sorted(entry["files"])[0]
    held = f"{tmp_path}/a/family=events/{one}"
    shutil.copy(held, f"{os.path.dirname(held)}/part-stray.parquet")
    assert archive.open_family(spark, root, entry).count() == events.count()
    assert any("part-stray" in f for f in archive.verify(spark, root))
    os.remove(f"{os.path.dirname(held)}/part-stray.parquet")
    assert archive.verify(spark, root) == []
    os.remove(held)
    faults = archive.verify(spark, root)
    assert any(one in f for f in faults) and any("not as the manifest says" in f for f in faults)
