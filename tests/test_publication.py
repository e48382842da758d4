import pytest
from pyspark.sql import functions as F

from helpers import make
from perigee.plans import adhoc
from perigee.plans.quality import publication_check
from perigee.sources import publication as P
from perigee.sources.sinks import write_csv
from perigee.sources.tables import read_csv


def approaches(spark, *rows):
    return make(spark, "asteroids", *[{"name": "n", "hazardous": False, **r} for r in rows])


@pytest.fixture
def root(spark, tmp_path):
    root = f"{tmp_path}/lake"
    first = approaches(spark, *[dict(id=str(i), closest_approach_date=f"2026-10-0{1 + i % 4}", miss_distance_km=float(i)) for i in range(1, 13)])
    P.stage(first, root, "a", "approach", F.col("closest_approach_date"))
    P.stage(spark.createDataFrame([('{"x":1}', "2026-10-01")], "payload string, day0 string"), root, "a", "approach_raw", F.col("day0"))
    return root, first


def test_nothing_is_seen_before_the_commit(spark, root):
    root, _ = root
    assert P.read_published(spark, root, "approach").count() == 0
    listed = P.commit(spark, root, "a", "2026-10-05")
    assert {r.place for r in listed.collect()} == {"processed/approaches", "raw/approaches"}
    assert P.read_published(spark, root, "approach").count() == 12
    assert [r.value for r in P.read_published(spark, root, "approach_raw").collect()] == ['{"x":1}']
    assert P.read_published(spark, root, "risk").count() == 0


def test_a_later_run_replaces_its_days_only_and_a_broken_one_nothing(spark, root):
    root, first = root
    P.commit(spark, root, "a", "2026-10-05")
    again = approaches(spark, dict(id="77", closest_approach_date="2026-10-02", miss_distance_km=7.0), dict(id="78", closest_approach_date="2026-10-09", miss_distance_km=8.0))
    P.stage(again, root, "b", "approach", F.col("closest_approach_date"))
    before = {r.id for r in P.read_published(spark, root, "approach").collect()}
    P.commit(spark, root, "b", "2026-10-06")
    P.stage(first.withColumn("id", F.lit("bad")), root, "c", "approach", F.col("closest_approach_date"))
    seen = {(r.id, r.day) for r in P.read_published(spark, root, "approach").collect()}
    assert before == {str(i) for i in range(1, 13)}
    assert seen == {(str(i), f"0{1 + i % 4}") for i in range(1, 13) if 1 + i % 4 != 2} | {("77", "02"), ("78", "09")}
    assert {r.id for r in P.read_published(spark, root, "approach", latest=True).collect()} == {"77", "78"}


def test_a_day_is_read_from_its_partition_alone(spark, root):
    root, _ = root
    P.commit(spark, root, "a", "2026-10-05")
    day = adhoc.daily_listing(P.read_published(spark, root, "approach"), "2026", "10", "03")
    assert {r.id for r in day.collect()} == {"2", "6", "10"}
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "dynamicpruning" in P.read_published(spark, root, "approach")._jdf.queryExecution().optimizedPlan().toString()


def test_lost_and_changed_files(spark, root):
    root, _ = root
    P.commit(spark, root, "a", "2026-10-05")
    files = P.stored_files(spark, root).filter("key LIKE 'processed/%'")
    known = files.collect()
    assert len(known) == 4 and all(f.bytes > 0 and not f.key.startswith("/") for f in known)
    keys = files.select("key").unionByName(spark.createDataFrame([("processed/approaches/run=a/year=2026",), ("no/such/key",), (known[0].key,)], "key string"))
    assert [r.key for r in P.publication_gaps(spark, root, keys).collect()] == ["no/such/key"]
    check = publication_check(spark, root, keys, verify=True).first()
    assert check.status == "FAILED" and check.metrics["total_keys"] == "6" and check.metrics["lost_keys"] == "no/such/key"
    assert publication_check(spark, root, keys).first().status == "NOT_APPLICABLE"
    assert publication_check(spark, root, None, verify=True).first().status == "PASSED"
    assert P.changed_files(spark, root).count() == 0
    with open(f"{root}/{known[0].key}", "ab") as f:
        f.write(b"more")
    assert [r.key for r in P.changed_files(spark, root).collect()] == [known[0].key]


def test_csv_keeps_any_text(spark, tmp_path):
    names = ["a\nb", "\\N", "", None, " x ", '"q"', "a,b", "c\rd", "\r\n", "\\n", "\\\\", "\\", "e\\\nf", "\\\\n", "#", "\\E", "'", "tab\t", "é z", '\\"']
    rows = approaches(spark, *[dict(id=str(i), name=n, closest_approach_date="2026-10-01", miss_distance_km=1.0) for i, n in enumerate(names)])
    path = f"{tmp_path}/csv"
    write_csv(rows, path)
    assert {int(r.id): r.name for r in read_csv(spark, path).collect()} == dict(enumerate(names))
    lines = spark.read.text(path).count()
    assert lines == len(names) + spark.read.text(path).filter("value LIKE 'id,%'").count()
    P.stage(rows, f"{tmp_path}/lake", "a", "approach_csv", F.col("closest_approach_date"))
    P.commit(spark, f"{tmp_path}/lake", "a", "1")
    assert {int(r.id): r.name for r in P.read_published(spark, f"{tmp_path}/lake", "approach_csv").collect()} == dict(enumerate(names))


def test_only_the_date_is_shuffled_beside_the_rows(spark, tmp_path, monkeypatch):
    kind, seen = type(spark.range(1)), []
    plain = kind.hint
    monkeypatch.setattr(kind, "hint", lambda df, *args: seen.append(df.columns) or plain(df, *args))
    rows = spark.createDataFrame([("a", "2024-03-01T07:00"), ("b", "2024-03-01"), ("c", None)], "payload string, moment string")
    P.stage(rows, str(tmp_path), "r1", "approach_raw", F.col("moment"))
    assert seen == [["payload", "__day"]]
    stored = spark.read.option("basePath", f"{tmp_path}/raw/approaches").text(f"{tmp_path}/raw/approaches")
    got = {r.value: (r.run, r.year, r.month, r.day) for r in stored.collect()}
    assert got == {"a": ("r1", 2024, 3, 1), "b": ("r1", 2024, 3, 1), "c": ("r1", None, None, None)}
