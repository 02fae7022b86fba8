"""Readers and writers: round trips, pruning, file layout; and the plans that scale depends on."""

import glob

import pytest
from pyspark.sql import functions as F

from zonepulse.functions.parsing import parse_multi_ts
from zonepulse.operators import cleaning, impact, profiling, reshape
from zonepulse.plans import CATALOG
from zonepulse.plans.views import Views
from zonepulse.schemas import TAXI
from zonepulse.sources import lookups, readers, scratch, writers


@pytest.fixture(scope="module")
def curated(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curated") / "trips")
    writers.write_curated(reshape.type_and_partition_trips(Views(spark, sf_dir)["text_trips"]), path)
    return path


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_curated_round_trip_and_pruning(spark, curated):
    table = readers.read_curated(spark, curated, "trips")
    assert table.count() > 0
    assert dict(table.dtypes)["pickup_ts"] == "timestamp_ntz"
    month = table.filter("year = 2024 AND month = 5").select("passenger_count")
    plan = plan_of(month)
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "ReadSchema: struct<passenger_count:int>" in plan
    months = {(r.year, r.month) for r in profiling.partition_counts(table).collect()}
    assert all((y, m) in months for y, m in [(2024, 1), (2024, 12), (2025, 9)])
    assert not any(y == 2025 and m > 9 for y, m in months)


def test_dynamic_overwrite_leaves_other_partitions(spark, curated, tmp_path):
    table = readers.read_curated(spark, curated, "trips")
    path = str(tmp_path / "t")
    writers.insert_curated(table, path, clustered=True)
    before = {(r.year, r.month): r.n for r in profiling.partition_counts(readers.read_curated(spark, path)).collect()}
    writers.insert_curated(table.filter("year = 2024 AND month = 3").limit(2), path, overwrite=True)
    after = {(r.year, r.month): r.n for r in profiling.partition_counts(readers.read_curated(spark, path)).collect()}
    assert after.pop((2024, 3)) == 2
    before.pop((2024, 3))
    assert after == before


def test_register_lists_partitions(spark, curated):
    names = writers.register(spark, "registered_trips", curated,
                             "pickup_ts timestamp_ntz, passenger_count int, year int, month int")
    assert "year=2024/month=1" in {r.partition for r in names.collect()}
    assert spark.table("registered_trips").filter("year = 2025").count() > 0
    spark.sql("DROP TABLE registered_trips")


def test_compact_makes_few_files(spark, tmp_path):
    df = spark.range(1000).withColumn("name", F.lit('a "quoted", text '))
    many, few = str(tmp_path / "many"), str(tmp_path / "few")
    df.repartition(40).write.parquet(many)
    writers.compact(spark.read.parquet(many), few, rows_per_file=600, fmt="parquet")
    files = glob.glob(few + "/part-*")
    assert len(files) < 10
    assert max(spark.read.parquet(f).count() for f in files) <= 600
    assert spark.read.parquet(few).exceptAll(df).isEmpty()


@pytest.mark.parametrize("text", ['a,b', 'say "hi"', "  padded  ", "plain", '"'])
def test_csv_round_trip(spark, tmp_path, text):
    path = str(tmp_path / "csv")
    writers.write_text(spark.createDataFrame([(text, "x")], "a string, b string"), path, header=True)
    assert readers.read_csv(spark, path, ["a", "b"]).first().a == text


def test_unknown_text_format(spark, tmp_path):
    with pytest.raises(ValueError):
        writers.write_text(spark.range(1), str(tmp_path / "x"), "yaml")


@pytest.mark.parametrize("line, n", [
    ("a,b,c", 3), ('a,"b,c",d', 3), ('a,"b ""x, y"" c",d', 3), (",,", 3), ("a", 1), ('a,"open, to the end', 2),
])
def test_quoted_field_count(spark, line, n):
    df = spark.createDataFrame([(line,)], "value string")
    assert df.select(readers.quoted_field_count(F.col("value"))).first()[0] == n


def test_short_quoted_rows_give_nulls(spark):
    df = spark.createDataFrame([("1,x",)], "value string")
    row = readers.parse_quoted(df, ["a", "b", "c"]).first()
    assert (row.a, row.b, row.c, row.n_fields) == ("1", "x", None, 2)


def test_trip_scan_accepts_any_number_type(spark, tmp_path):
    path = str(tmp_path / "trips")
    spark.createDataFrame(
        [(1, 2, 3.0, 7.5, 5, 6.0)],
        "pickup_datetime bigint, dropoff_datetime bigint, extra double, trip_miles float, "
        "PULocationID bigint, DOLocationID double").write.parquet(path)
    row = readers.read_trips(spark, path, "fhv").first()
    assert (row.pickup_datetime, row.trip_miles, row.PULocationID, row.DOLocationID) == (1, 7.5, 5, 6)
    assert "extra" not in row.asDict()


def test_lookups_take_one_row_per_key(spark):
    rows = [('"A"', "1", "2", "7", 1), ("A", "3", "4", "5", 2), ("B", "", "4", "5", 3), ("", "1", "1", "1", 4)]
    df = spark.createDataFrame(rows, "raw_location string, lat string, lon string, location_id string, n int")
    assert [tuple(r) for r in lookups.load_locations(df, "n").collect()] == [("A", "3", "4", "5")]
    assert [tuple(r) for r in lookups.load_locations(df).collect()] == [("A", "1", "2", "7")]


def test_broadcast_only_below_the_limit(spark):
    df = spark.range(10)
    assert "ResolvedHint (strategy=broadcast)" in scratch.broadcast_if_small(df, 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in scratch.broadcast_if_small(df, 9)._jdf.queryExecution().analyzed().toString()


def test_large_lookups_give_the_same_rows(spark, sf_dir, monkeypatch):
    """The way beyond the broadcast limit returns what the broadcast returns."""
    v = Views(spark, sf_dir)
    wide = impact.daily_baseline(v["permits"], v["taxi_rides"], TAXI)
    monkeypatch.setattr(impact, "is_small", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = impact.daily_baseline(v["permits"], v["taxi_rides"], TAXI)
        assert "BroadcastHashJoin" not in plan_of(shuffled)
        assert shuffled.count() == wide.count()
        assert shuffled.exceptAll(wide).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_clean_trips_filters_reach_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "typed")
    Views(spark, sf_dir)["typed_yellow"].write.parquet(path)
    plan = plan_of(cleaning.clean_yellow(spark.read.parquet(path)))
    assert "PushedFilters: [IsNotNull(" in plan
    assert "Exchange" not in plan


def test_few_events_filter_trips_before_the_first_shuffle(spark, sf_dir, curated, tmp_path):
    """The needed blocks are joined below the partial aggregate, in the scan stage, and totals are shuffled once."""
    v = Views(spark, sf_dir)
    events = impact.sample_midweek_events(v["permits"], v["subway_rides"], salt="s")
    df = impact.sampled_impact(events, readers.read_curated(spark, curated, "trips"), TAXI)
    lines = plan_of(df).splitlines()
    join = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line and "near#" in line)
    above = [line for line in reversed(lines[:join]) if "HashAggregate" in line or "Exchange" in line]
    assert "partial_sum" in above[0] and "Exchange hashpartitioning" in above[1] and " sum(" in above[2].replace("[sum(", " sum(")
    assert sum("pickup_ts" in line and "FileScan" in line for line in lines) == 1


def test_mixed_trip_files_lose_nothing(spark, tmp_path):
    """A column that only some files have, numbers of several types; the order of the files does not matter."""
    rows = [(i, float(i % 7), i / 2, 1 + i % 263, 1 + i % 200) for i in range(60)]
    names = ["t", "passenger_count", "trip_distance", "PULocationID", "DOLocationID"]
    whole = spark.createDataFrame(rows, names).withColumn("t", F.timestamp_seconds("t").cast("timestamp_ntz"))
    whole = whole.select(F.col("t").alias("tpep_pickup_datetime"), F.col("t").alias("tpep_dropoff_datetime"), *names[1:])
    found = []
    for order in ("abc", "cba"):
        for k, name in enumerate(order):
            part = whole.filter(F.col("PULocationID") % 3 == "abc".index(name))
            if name == "a":
                part = part.drop("passenger_count").withColumn("PULocationID", F.col("PULocationID").cast("double"))
            if name == "b":
                part = part.withColumn("passenger_count", F.col("passenger_count").cast("int"))
            part.coalesce(1).write.parquet(str(tmp_path / order / f"{k} of 3"))
        read = readers.read_trips(spark, str(tmp_path / order), "yellow", recursive=True)
        found.append(sorted(tuple(r) for r in read.fillna(-1.0, ["passenger_count"]).collect()))
        assert cleaning.clean_yellow(read).count() > 0
    assert found[0] == found[1] and len(found[0]) == 60
    assert sum(r[2] == -1.0 for r in found[0]) == 20 and {r[3] for r in found[0]} == {i / 2 for i in range(60)}


def test_key_lookup_reads_one_folder(spark, sf_dir):
    plan = plan_of(CATALOG["p16_find_by_ids"].run(spark, sf_dir))
    assert "PartitionFilters: [isnotnull(year" in plan and "month" in plan.split("PartitionFilters:")[1][:120]


def test_clock_without_seconds(spark):
    texts = {"01/02/2024 13:05": "2024-01-02 13:05:00", "2024-01-02 13:05": "2024-01-02 13:05:00", "01/02/2024 1:05 PM": "2024-01-02 13:05:00", "2024-01-02": "2024-01-02 00:00:00"}
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: str(r.p) for r in frame.select("t", parse_multi_ts(F.col("t")).alias("p")).collect()} == texts
