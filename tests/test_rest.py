"""Policies, graph, archive, sources and streams."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.functions import scalar
from tidemark.operators.graph import connected_components
from tidemark.operators.stats import concentration
from tidemark.plans import policies
from tidemark.sources import archive, tables
from tidemark.streaming import events

T0 = datetime(2026, 8, 16, 12)


@pytest.mark.parametrize(
    ("state", "m5", "h1", "liquidity", "after"),
    [("NEW", 100, None, None, "ACTIVE"), ("NEW", 99, None, 1000, "WATCH"), ("ACTIVE", 25, None, None, "FADING"), ("WATCH", 10, None, None, "FADING"), ("FADING", None, 10, 100, "DORMANT"),
     ("DORMANT", 100, None, 500, "RESURRECTED"), ("NEW", None, None, None, "NEW"), ("NEW", None, None, 5000, "NEW"), ("RESURRECTED", 0, 0, 0, "RESURRECTED")],
)
def test_lifecycle(spark, state, m5, h1, liquidity, after):
    row = spark.createDataFrame([(state, m5, h1, liquidity)], "state string, volume_m5 int, volume_h1 int, liquidity int")
    got = row.select(policies.next_state(F.col("state"), {c: F.col(c) for c in ("volume_m5", "volume_h1", "liquidity")})).first()[0]
    assert got == after


@pytest.mark.parametrize(("age", "name", "interval"), [(0, "INITIAL", 15), (119, "INITIAL", 15), (120, "EARLY", 30), (600, "MATURE", 300), (3600, "COOLED", 1800), (21600, "LONG_TAIL_DAY", 7200), (86400, "LONG_TAIL_WEEK", 43200), (604800, "RETIRED", None)])
def test_coverage(spark, age, name, interval):
    r = spark.range(1).select(policies.coverage_class(F.lit(age)).alias("c"), policies.coverage_interval(F.lit(age)).alias("i")).first()
    assert (r.c, r.i) == (name, interval)


@pytest.mark.parametrize(
    ("state", "age", "state_age", "name", "interval", "left"),
    [("NEW", 119.0, 119.0, "INITIAL", 15, 1), ("NEW", 604800.0, 0.0, "RETIRED_CONTROL", None, None), ("ACTIVE", 9e6, 0.0, "PROTECTED_ACTIVE", 5, None), ("RESURRECTED", 9e6, 0.0, "PROTECTED_RESURRECTED", 5, None),
     ("WATCH", 50.0, 50.0, "PROTECTED_WATCH", 15, None), ("FADING", 9e6, 1799.0, "FADING_TAIL", 120, 1), ("FADING", 9e6, 1800.0, "FADING_COOL", 1800, 19800), ("FADING", 9e6, 21600.0, "RETIRED_CONTROL", None, None),
     ("DORMANT", 9.0, 9.0, "RETIRED_CONTROL", None, None), ("FADING", 9.0, -1.0, None, None, None), ("NEW", -1.0, 0.0, None, None, None), ("FADING", 9.0, None, None, None, None)],
)
def test_coverage_by_state(spark, state, age, state_age, name, interval, left):
    r = spark.createDataFrame([(state, age, state_age)], "s string, a double, b double").withColumn("c", policies.coverage_for(F.col("s"), F.col("a"), F.col("b")))
    assert tuple(r.select("c", policies.interval_for(F.col("c")), policies.seconds_to_transition(F.col("c"), F.col("a"), F.col("b"))).first()) == (name, interval, left)


def test_capacity():
    intervals, weights = {"a": 15, "b": 300}, {"a": 4.0, "b": 1.0}
    assert policies.plan_capacity({"a": 10, "b": 100}, intervals, weights, 100)["mode"] == "NORMAL"
    tight = policies.plan_capacity({"a": 100, "b": 1000}, intervals, weights, 300)
    assert tight["mode"] == "DEGRADED" and abs(sum(tight["granted"].values()) - 300) < 1e-6 and tight["granted"]["a"] > tight["granted"]["b"]
    assert policies.plan_capacity({"a": 1e6, "b": 1e6}, intervals, weights, 10)["mode"] == "CRITICAL"


def test_components_do_not_depend_on_order(spark):
    rows = [("a", "b"), ("b", "c"), ("x", "y"), ("p", "p")] + [(f"n{i:02}", f"n{i + 1:02}") for i in range(40)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(rows, "s string, t string"), "s", "t").collect()}
    back = {r.node: r.component for r in connected_components(spark.createDataFrame([(t, s) for s, t in rows[::-1]], "s string, t string"), "s", "t").collect()}
    assert got == back and got["c"] == "a" and got["y"] == "x" and got["n40"] == "n00" and "p" not in got


def test_components_of_chains_hubs_and_cycles(spark):
    import random

    rng, rows = random.Random(4), []
    for base, n in ((0, 300), (1000, 1), (2000, 64)):
        ids = list(range(base, base + n + 1))
        rng.shuffle(ids)
        rows += list(zip(ids, ids[1:], strict=False))
    rows += [(5000, 5001 + i) for i in range(400)] + [(9000 + i, 9000 + (i + 1) % 7) for i in range(7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(rows, "s long, t long"), "s", "t").collect()}
    first = lambda i: next(b for b in (9000, 5000, 2000, 1000, 0) if i >= b)
    assert len(got) == 301 + 2 + 65 + 401 + 7 and all(c == first(i) for i, c in got.items())
    assert connected_components(spark.createDataFrame([], "s long, t long"), "s", "t").count() == 0


def test_concentration(spark):
    rows = [("pool", 400), ("wallet-a", 300), ("wallet-a", 100), ("wallet-b", 50), ("rest", 150)]
    r = concentration(spark.createDataFrame([("t", *x) for x in rows], "t string, owner string, amount int"), ["t"], "owner", "amount", (1, 2)).first()
    assert r.owners == 4 and r.top1_pct == pytest.approx(40) and r.top2_pct == pytest.approx(80) and r.hhi == pytest.approx(0.16 + 0.16 + 0.0025 + 0.0225)


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(scalar.ratio(F.lit(1), F.lit(0))) is None and one(scalar.change(F.lit(3.0), F.lit(2.0))) == 0.5 and one(scalar.change(F.lit(3.0), F.lit(0.0))) is None
    assert one(scalar.decimal_text(F.lit("1200.500").cast("decimal(38,18)"))) == "1200.5" and one(scalar.decimal_text(F.lit("100").cast("decimal(38,0)"))) == "100"
    assert one(scalar.epoch_time(F.lit("1700000000"))) == one(scalar.epoch_time(F.lit("1700000000000"))) and one(scalar.epoch_time(F.lit("nan"))) is None
    assert one(scalar.has_nul(F.lit('{"a": "\\u0000"}'))) and not one(scalar.has_nul(F.lit('{"a": "\\\\u0000"}'))) and not one(scalar.has_nul(F.lit(None).cast("string")))
    assert [one(scalar.tri_state(F.lit(a), F.lit(b))) for a, b in ((True, False), (False, True), (None, None))] == ["TRUE", "FALSE", "UNKNOWN"]


def facts(spark, n=10):
    return spark.createDataFrame([(i, T0 + timedelta(hours=6 * i), "0.000000000000000123" if i == 3 else None) for i in range(n)], "id long, at timestamp_ntz, price string").withColumn("price", F.col("price").cast("decimal(38,18)"))


def test_archive(spark, tmp_path):
    root = f"file://{tmp_path}/a"
    entries = [archive.export_family(facts(spark), root, "observations", "at", ["id"], 4), archive.export_family(facts(spark).limit(0), root, "boosts", "at", ["id"])]
    archive.publish(spark, root, entries)
    assert archive.verify(spark, root) == []
    back = {e["family"]: archive.open_family(spark, root, e) for e in archive.read_manifest(spark, root)["entries"]}
    assert back["boosts"].count() == 0 and back["boosts"].schema == facts(spark).schema
    assert sorted(back["observations"].collect()) == sorted(facts(spark).collect())
    facts(spark).limit(1).withColumn("id", F.lit(77).cast("long")).write.mode("append").parquet(f"{root}/family=observations/day=2026-08-16")
    assert any("observations 2026-08-16" in f for f in archive.verify(spark, root))
    with open(tmp_path / "a" / "manifest.json", "a") as f:
        f.write(" ")
    (tmp_path / "a" / ".manifest.json.crc").unlink()
    with pytest.raises(archive.ArchiveError):
        archive.read_manifest(spark, root)


def test_an_archive_shows_any_change(spark, tmp_path):
    import glob
    import shutil

    rows = facts(spark).withColumns({"note": F.concat(F.lit("n"), "id"), "tags": F.create_map(F.lit("k"), "id")})
    root = f"{tmp_path}/a"
    archive.publish(spark, f"file://{root}", [archive.export_family(rows, f"file://{root}", "observations", "at", ["id"])])
    assert set(archive.open_verified(spark, f"file://{root}")) == {"observations"}
    day = "2026-08-16"
    part = glob.glob(f"{root}/family=observations/day={day}/*.parquet")[0]
    held = spark.createDataFrame(spark.read.parquet(part).collect(), spark.read.parquet(part).schema)
    first = held.agg(F.min("id")).first()[0]
    changes = {
        "content": held.withColumn("note", F.when(F.col("id") == first, "other").otherwise(F.col("note"))), "nulls": held.withColumn("price", F.lit(None).cast("decimal(38,18)")).withColumn("note", F.lit(None).cast("string")),
        "digest, content, lowest": held.withColumn("id", F.when(F.col("id") == first, -5).otherwise(F.col("id"))), "rows": held.filter(F.col("id") != first),
    }
    for k, (what, df) in enumerate(changes.items()):
        other = f"{tmp_path}/{k}"
        shutil.copytree(root, other)
        target = part.replace(root, other)
        df.coalesce(1).write.parquet(f"{tmp_path}/part{k}")
        for f in glob.glob(f"{other}/family=observations/day={day}/.*.crc"):
            shutil.os.remove(f)
        shutil.copy(glob.glob(f"{tmp_path}/part{k}/*.parquet")[0], target)
        faults = archive.verify(spark, f"file://{other}")
        assert any(day in f and what.split(",")[0] in f and "manifest" in f for f in faults), (what, faults)
        with pytest.raises(archive.ArchiveError):
            archive.open_verified(spark, f"file://{other}")
    shutil.os.remove(part)
    assert any("None bytes" in f for f in archive.verify(spark, f"file://{root}"))


def test_conflicts_between_sides_raise(spark):
    whole = facts(spark)
    other = whole.withColumn("price", F.when(F.col("id") == 5, F.lit(9).cast("decimal(38,18)")).otherwise(F.col("price")))
    sides = lambda cold, hot: tables.hot_cold(cold, hot, "at", "2026-08-17 12:00:00", "id")
    assert sides(whole, whole).count() == 10
    for cold, hot in ((whole, other), (other, whole), (whole.union(other), whole.limit(0))):
        with pytest.raises(Exception, match="conflicting content"):
            sides(cold, hot).collect()
    epochs = spark.createDataFrame([("e", True), ("f", False)], "epoch_id string, data_valid boolean")
    assert tables.epoch_validity(epochs, epochs).count() == 2
    with pytest.raises(Exception, match="validity"):
        tables.epoch_validity(epochs, epochs.withColumn("data_valid", F.lit(True))).collect()


def test_a_pair_keeps_its_parent(spark):
    stored = spark.createDataFrame([("p1", "t1", "x")], "pair string, token string, name string")
    seen = lambda *rows: spark.createDataFrame(list(rows), "pair string, at int, token string, name string")
    make = lambda df: tables.get_or_create(stored, df, ["pair"], "at", ["token", "name"], ["token"])
    assert sorted(tuple(r) for r in make(seen(("p1", 1, "t1", "y"), ("p2", 2, "t2", "a"), ("p2", 1, "t2", "b"))).collect()) == [("p1", "t1", "x"), ("p2", "t2", "b")]
    for bad in (seen(("p1", 1, "t9", "x")), seen(("p3", 1, "t1", "x"), ("p3", 2, "t2", "x"))):
        with pytest.raises(Exception, match="two parents"):
            make(bad).collect()


def test_tolerant_reading_and_halves(spark):
    schema = StructType([StructField("id", LongType()), StructField("name", StringType())])
    assert tables.tolerant(spark.createDataFrame([(1, 2)], "id int, other int"), schema).collect() == [(1, None)]
    assert tables.family(spark, [], schema).count() == 0
    whole = facts(spark)
    both = tables.hot_cold(whole.filter("id < 7"), whole.filter("id > 2"), "at", "2026-08-17 12:00:00", "id")
    assert sorted((r.id, r.side) for r in both.collect()) == [(i, "cold" if i < 4 else "hot") for i in range(10)]
    clash = tables.conflicts(whole.union(whole).union(whole.filter("id = 1").withColumn("price", F.lit(1).cast("decimal(38,18)"))), ["id"])
    assert [r.id for r in clash.collect()] == [1]
    fresh, again = tables.append_new(whole.filter("id < 5"), whole.union(whole), ["id"])
    assert fresh.count() == 5 and again.count() == 10


def test_stream_is_effectively_once(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    rows = spark.createDataFrame([(i, float(i)) for i in range(6)] + [(None, 1.0)], "id long, value double")
    rows.coalesce(1).write.parquet(source)
    run = lambda: events.append_once(spark.readStream.schema(rows.schema).parquet(source), target, ["id"], F.col("id").isNotNull(), f"{tmp_path}/c").awaitTermination()
    run()
    rows.filter("id >= 4 OR id IS NULL").unionByName(spark.createDataFrame([(9, 9.0)], rows.schema)).coalesce(1).write.mode("append").parquet(source)
    run()
    run()  # nothing new
    assert sorted(r.id for r in spark.read.parquet(f"{target}/facts").collect()) == [0, 1, 2, 3, 4, 5, 9]
    assert sorted((r.id, r.repeats) for r in spark.read.parquet(f"{target}/conflicts").collect()) == [(4, 1), (5, 1)]
    assert spark.read.parquet(f"{target}/rejected").count() == 2


def test_stream_state_equals_batch_replay(spark, tmp_path):
    rows = [(k, i, T0 + timedelta(minutes=i), v) for k, vs in (("a", (120.0, 20.0, 5.0)), ("b", (50.0, 300.0, 10.0, 400.0)), ("c", (99.0,))) for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, id long, at timestamp_ntz, v double")
    batch = policies.replay_lifecycle(df, ["k"], ["at", "id"], {"volume_m5": "v", "volume_h1": "v", "liquidity": "v"})
    for i in range(3):
        df.filter(F.col("id") == i if i < 2 else F.col("id") >= 2).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def step(state, v):
        for r in policies.LIFECYCLE:
            if r.source == state and v is not None and all(v >= b for _, b in r.at_least) and all(v <= b for _, b in r.at_most):
                return r.target
        return state

    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = {}

    def put(b, n):
        got.update({r.key: (r.state, r.changes) for r in b.collect()})

    events.keyed_state(stream, "k", "at", "id", "v", step, "NEW").writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert got == {r.k: (r.state, r.changes) for r in batch.collect()}


def test_tier_transitions(spark):
    rows = [
        ("a", 1, 0, 0, "TIER_1", True, 100), ("a", 2, 10, 10, "TIER_2", True, 100), ("a", 3, 20, 5, "TIER_0", False, 0), ("a", 4, 30, 10, "TIER_1", True, 100), ("a", 5, 50, 50, "TIER_0", False, 0),
        ("a", 6, 200, 200, "TIER_0", False, 0), ("b", 7, 5, 5, "TIER_0", False, 0), ("c", 8, 0, 0, "TIER_1", True, 10), ("c", 9, 20, 20, "TIER_1", True, 10),
    ]
    got = policies.tier_transitions(spark.createDataFrame(rows, "token_id string, id long, t long, watermark long, tier string, eligible boolean, ttl long")).orderBy("id").collect()
    assert [(r.id, r.previous, r.tier, r.covered_until) for r in got] == [(1, "TIER_0", "TIER_1", 100.0), (2, "TIER_1", "TIER_2", 110.0), (6, "TIER_2", "TIER_0", None), (8, "TIER_0", "TIER_1", 10.0), (9, "TIER_1", "TIER_1", 30.0)]


def test_copies_and_retention(spark, tmp_path):
    root, other = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    archive.publish(spark, root, [archive.export_family(facts(spark), root, "observations", "at", ["id"], 4), archive.export_family(facts(spark).limit(0), root, "boosts", "at", ["id"])])
    assert archive.copy_archive(spark, root, other) == []
    days = lambda r: [(e["family"], e["days"], e["schema"]) for e in archive.read_manifest(spark, r)["entries"]]
    assert days(root) == days(other)
    size = archive.stored_bytes(spark.read.parquet(f"{other}/family=observations")).first()
    assert size.files >= 3 and size.bytes > 0
    states = spark.createDataFrame([("x", True, True), ("y", True, None)], "archive string, verified boolean, copied boolean")
    assert [(r.archive, r.eligible, r.failed) for r in archive.may_be_deleted(states, ["verified", "copied"]).collect()] == [("x", True, []), ("y", False, ["copied"])]


def test_verified_append_and_policies(spark):
    stored = spark.createDataFrame([(1, "a"), (2, None)], "id long, v string")
    batch = lambda *rows: tables.verified_append(stored, spark.createDataFrame(list(rows), "id long, v string"), ["id"])
    assert sorted(batch((1, "a"), (2, None), (3, "c"), (3, "c")).collect()) == [(3, "c")]
    for bad in ((1, "b"), (2, "x")):
        with pytest.raises(Exception, match="other content"):
            batch(bad).collect()
    held = tables.policy_dimension(spark.createDataFrame([], "policy_sha256 string, body string"), spark.createDataFrame([("p",), ("p",), ("q",)], "body string"))
    assert held.count() == 2 and tables.policy_dimension(held, spark.createDataFrame([("q",), ("r",)], "body string")).count() == 3


def test_spans_expire_as_in_the_batch(spark, tmp_path):
    rows = [("a", 0, 5.0), ("a", 50, 5.0), ("a", 400, 5.0), ("b", 10, 1.0), ("b", 20, 9.0), ("z", 2000, 0.0), ("a", 2100, 5.0)]
    df = spark.createDataFrame([(k, T0 + timedelta(seconds=t), v) for k, t, v in rows], "k string, at timestamp_ntz, v double")
    for low, high in ((0, 100), (100, 1000), (1000, 2050), (2050, 9999)):
        part = df.filter((F.col("at") >= F.lit(T0 + timedelta(seconds=low))) & (F.col("at") < F.lit(T0 + timedelta(seconds=high))))
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = []
    events.expiring_spans(stream, "k", "at", "v", 2.0, 100).writeStream.outputMode("append").foreachBatch(lambda b, n: got.extend(b.collect())).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    batch = policies.simulate_tiers(df, "k", scalar.micros("at") / scalar.MICROS, "v", policies.TierPolicy(2.0, 100))
    closed = batch.filter(F.col("ended") <= scalar.micros(F.lit(T0 + timedelta(seconds=2100))) / scalar.MICROS)
    assert sorted((r.key, r.started, r.ended, r.renewals) for r in got) == sorted((r.key, r.started, r.ended, r.renewals) for r in closed.collect()) and len(got) == 3
