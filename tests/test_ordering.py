import pytest
from pyspark.sql import functions as F

from perigee.operators import ordering
from perigee.operators.tallying import page


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('ordered')}/t.parquet"
    rows = spark.range(3000).select(
        F.when(F.col("id") % 10 > 0, F.col("id") * 7919 % 500).alias("km"), F.col("id").cast("string").alias("name"), F.lit("x").alias("rest")).repartition(5)
    ordering.publish_in_order(rows, ["km desc", "name"], path, files=6)
    return path, sorted(((r.km, r.name) for r in rows.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))


def test_places_are_the_order(spark, stored):
    path, want = stored
    rows = ordering.read_in_order(spark, path)
    assert [(r.km, r.name) for r in sorted(rows.collect(), key=lambda r: r.place)] == want
    assert sorted(r.place for r in rows.collect()) == list(range(3000))
    files = ordering.manifest(spark, path).orderBy("n_before").collect()
    assert len(files) > 1 and sum(f.n_rows for f in files) == 3000
    assert all((a.last_key.km, a.last_key.name) != (b.first_key.km, b.first_key.name) for a, b in zip(files, files[1:]))


@pytest.mark.parametrize("start", [0, 1, 700, 2990, 3000, 9000])
def test_pages_read_the_files_they_touch(spark, stored, start):
    path, want = stored
    rows, figures = ordering.page_of(spark, path, 20, start)
    assert [(r.km, r.name) for r in rows.collect()] == want[start : start + 20]
    assert figures.first().asDict() == dict(total=3000, limit=20, offset=start, returned=max(0, min(20, 3000 - start)))
    assert "TakeOrdered" not in plan_of(rows) and "Offset" not in plan_of(rows)
    touched = {f.name for f in ordering.manifest(spark, path).collect() if f.n_before < start + 20 and f.n_before + f.n_rows > start}
    assert {f.rsplit("/", 1)[1] for f in rows.inputFiles()} == touched


def test_a_page_of_a_plan_runs_it_once(spark):
    rows, figures = page(spark.range(100).select("id"), ["id desc"], 3, 96)
    assert [r.id for r in rows.collect()] == [3, 2, 1] and figures.first().returned == 3
    empty, figures = page(spark.range(0).select("id"), ["id"])
    assert empty.count() == 0 and figures.first().total == 0


def test_order_is_proved_and_disorder_is_found(spark, stored, tmp_path):
    path, _ = stored
    proof = ordering.order_proof(spark, path, ["km desc", "name"]).first()
    assert (proof.stored_rows, proof.inversions, proof.overlaps, proof.unlisted_rows) == (3000, 0, 0, 0)
    assert ordering.order_proof(spark, path, ["name"]).first().inversions > 0
    # A file that is written again after publication is no longer what the manifest says.
    other = f"{tmp_path}/u.parquet"
    ordering.publish_in_order(spark.range(50).select("id"), ["id"], other)
    spark.range(7).select("id").write.mode("append").parquet(other)
    proof = ordering.order_proof(spark, other, ["id"]).first()
    assert proof.unlisted_rows == 7


def test_equal_keys_and_empty_tables(spark, tmp_path):
    path = f"{tmp_path}/e.parquet"
    ordering.publish_in_order(spark.range(100).select((F.col("id") % 2).alias("k")), ["k"], path, files=4)
    assert [r.k for r in ordering.rows_between(spark, path, 45, 55).collect()] == [0] * 5 + [1] * 5
    path = f"{tmp_path}/n.parquet"
    ordering.publish_in_order(spark.range(0).select("id"), ["id"], path)
    assert ordering.read_in_order(spark, path).count() == 0
    assert ordering.order_proof(spark, path, ["id"]).first().stored_rows == 0
