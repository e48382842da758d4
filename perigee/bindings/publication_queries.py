"""Published tables: their order, their pages, their proofs."""

from __future__ import annotations

from pyspark.sql import functions as F

from perigee.bindings import domain as D
from perigee.bindings.registry import metrics_as_text, query
from perigee.bindings.sql import with_tables
from perigee.operators.ordering import manifest, order_proof, page_of, publish_in_order, read_in_order
from perigee.operators.resolution import BRIDGE_ORDER, IDENTIFIER
from perigee.plans import adhoc, world
from perigee.plans.quality import publication_check
from perigee.runtime import fresh_path
from perigee.sources import publication as P


def _published_world(spark, sf) -> str:
    lake = D.lakehouse(spark, sf)
    path = fresh_path(spark, "world")
    world.publish_world(world.world_snapshot(lake.asteroids, lake.risk, lake.objects, lake.orbits, lake.bridge, lake.audit), path)
    return path


@query("world_in_order", "T4 C12", with_tables("""
SELECT row_number() OVER (ORDER BY miss_distance_km NULLS LAST, neows_id) - 1 AS place, neows_id, miss_distance_km, closest_approach_date, match_state
FROM wld""", "wld"))
def _(spark, sf):
    rows = read_in_order(spark, _published_world(spark, sf))
    return rows.select("place", "neows_id", "miss_distance_km", "closest_approach_date", "match_state")


@query("world_page", "T4 T3", with_tables("""
SELECT neows_id, name, miss_distance_km FROM wld
QUALIFY row_number() OVER (ORDER BY miss_distance_km NULLS LAST, neows_id) - 1
  BETWEEN count(*) OVER () * 2 // 3 AND count(*) OVER () * 2 // 3 + 199""", "wld"))
def _(spark, sf):
    path = _published_world(spark, sf)
    total = manifest(spark, path).agg(F.sum("n_rows")).first()[0]
    return world.nearest_objects(spark, path, 200, total * 2 // 3)[0].select("neows_id", "name", "miss_distance_km")


LINES = ["l_extendedprice desc", "l_orderkey", "l_linenumber"]


@query("deep_line_page", "T3", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) - 1
  BETWEEN count(*) OVER () * 5 // 6 AND count(*) OVER () * 5 // 6 + 499""")
def _(spark, sf):
    path = fresh_path(spark, "lines")
    files = publish_in_order(D.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), LINES, path)
    return page_of(spark, path, 500, files.agg(F.sum("n_rows")).first()[0] * 5 // 6)[0]


@query("crosswalk_in_order", "T7 K7", with_tables("""
SELECT 'bridge' AS stored, row_number() OVER (ORDER BY asteroid_key, source_system, identifier_name, identifier_value) - 1 AS place,
  asteroid_key, source_system, identifier_name, identifier_value AS value FROM brg
UNION ALL SELECT 'audit', row_number() OVER (ORDER BY source_system, identifier_name, source_identifier_value) - 1,
  assigned_asteroid_key, source_system, identifier_name, source_identifier_value FROM aud""", "brg", "aud"))
def _(spark, sf):
    folder = D.crosswalk_folder(spark, sf)
    bridge = read_in_order(spark, f"{folder}/bridge_asteroid_identifier.parquet")
    audit = read_in_order(spark, f"{folder}/fact_entity_resolution.parquet")
    keys = ["source_system", "identifier_name"]
    return bridge.select(F.lit("bridge").alias("stored"), "place", "asteroid_key", *keys, F.col("identifier_value").alias("value")).unionByName(
        audit.select(F.lit("audit").alias("stored"), "place", F.col("assigned_asteroid_key").alias("asteroid_key"), *keys, F.col("source_identifier_value").alias("value")))


@query("crosswalk_order_proof", "T7 K7", with_tables("""
SELECT 'bridge' AS stored, count(*) AS stored_rows, 0 AS inversions, 0 AS overlaps, 0 AS unlisted_rows FROM brg
UNION ALL SELECT 'audit', count(*), 0, 0, 0 FROM aud""", "brg", "aud"))
def _(spark, sf):
    folder = D.crosswalk_folder(spark, sf)
    proofs = [order_proof(spark, f"{folder}/{name}.parquet", order).withColumn("stored", F.lit(stored)).drop("files")
              for stored, name, order in (("bridge", "bridge_asteroid_identifier", BRIDGE_ORDER), ("audit", "fact_entity_resolution", IDENTIFIER))]
    return proofs[0].unionByName(proofs[1])


# --- runs --------------------------------------------------------------------------------------

_FOLDERS: dict[tuple[str, str], str] = {}


def _runs(spark, sf) -> str:
    """Two committed runs, the second with one year again, and one that stops before its second table.

    Approaches are published by the month they were asked for. The queries of an application share the folder.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key in _FOLDERS:
        return _FOLDERS[key]
    root = fresh_path(spark, "published")
    lake = D.lakehouse(spark, sf)
    rows, month = lake.asteroids.drop("year", "month", "day"), F.concat(F.substring("closest_approach_date", 1, 7), F.lit("-01"))
    P.stage(rows, root, "run-1", "approach", month)
    # The other stagings read what the first has written, so that approaches are joined once.
    rows = spark.read.schema(rows.schema).parquet(f"{root}/{P.dataset_place('approach')}/run=run-1").select(*rows.columns)
    again = rows.filter(F.col("closest_approach_date").startswith("1998")).withColumn("miss_distance_km", F.col("miss_distance_km") * 2)
    P.stage(rows, root, "run-1", "approach_csv", month)
    P.stage(lake.bridge, root, "run-1", "crosswalk", F.lit("2024-03-01"), "bridge_asteroid_identifier")
    P.commit(spark, root, "run-1", "2024-03-01T00:00:00Z")
    P.stage(again, root, "run-2", "approach", month)
    P.stage(lake.bridge.filter("is_primary_pivot"), root, "run-2", "crosswalk", F.lit("2024-03-02"), "bridge_asteroid_identifier")
    P.commit(spark, root, "run-2", "2024-03-02T00:00:00Z")
    # The third one never reaches its commit.
    P.stage(again.withColumn("miss_distance_km", F.lit(-1.0)), root, "run-3", "approach", month)
    _FOLDERS[key] = root
    return root


_AGAIN = "CASE WHEN closest_approach_date LIKE '1998%' THEN miss_distance_km * 2 ELSE miss_distance_km END"


@query("published_approaches", "K4 K1 S3", with_tables(f"""
SELECT id, name, closest_approach_date, {_AGAIN} AS miss_distance_km, hazardous, substr(closest_approach_date, 1, 4) AS year,
  substr(closest_approach_date, 6, 2) AS month, '01' AS day FROM apr""", "apr"))
def _(spark, sf):
    rows = P.read_published(spark, _runs(spark, sf), "approach")
    return rows.select("id", "name", "closest_approach_date", "miss_distance_km", "hazardous", "year", "month", "day")


@query("published_day", "P10 S3", with_tables(f"""
SELECT id, name, closest_approach_date, {_AGAIN} AS miss_distance_km, hazardous FROM apr WHERE closest_approach_date LIKE '1998-07%'""", "apr"))
def _(spark, sf):
    return adhoc.daily_listing(P.read_published(spark, _runs(spark, sf), "approach"), "1998", "07", "01")


@query("published_csv", "K4 K3 S4", with_tables("""
SELECT id, name, closest_approach_date, miss_distance_km, hazardous, substr(closest_approach_date, 1, 4) AS year, substr(closest_approach_date, 6, 2) AS month FROM apr""", "apr"))
def _(spark, sf):
    return P.read_published(spark, _runs(spark, sf), "approach_csv").drop("day")


@query("published_crosswalks", "K4 K7", with_tables("""
SELECT 'all days' AS shown, count(*) AS n, count(DISTINCT asteroid_key) AS entities FROM (SELECT asteroid_key FROM brg UNION ALL SELECT asteroid_key FROM brg WHERE is_primary_pivot)
UNION ALL SELECT 'latest run', count(*), count(DISTINCT asteroid_key) FROM brg WHERE is_primary_pivot""", "brg"))
def _(spark, sf):
    root, name = _runs(spark, sf), "bridge_asteroid_identifier"
    count = lambda df, shown: df.agg(F.lit(shown).alias("shown"), F.count(F.lit(1)).alias("n"), F.countDistinct("asteroid_key").alias("entities"))
    return count(P.read_published(spark, root, "crosswalk", name), "all days").unionByName(
        count(P.read_published(spark, root, "crosswalk", name, latest=True), "latest run"))


_EXPECTED = "SELECT DISTINCT strftime(o_orderdate, 'processed/approaches/run=run-2/year=%Y/month=%m/day=01') AS key, year(o_orderdate) AS y FROM orders"


def _expected(spark, sf):
    """A key per month of the orders, as if the second run had published them all."""
    return D.table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "'processed/approaches/run=run-2/year='yyyy'/month='MM'/day=01'").alias("key")).distinct()


@query("publication_gaps", "Q15 Q9", f"SELECT key, 0 AS bytes FROM ({_EXPECTED}) WHERE y <> 1998")
def _(spark, sf):
    return P.publication_gaps(spark, _runs(spark, sf), _expected(spark, sf))


@query("publication_verification", "Q15", f"""
WITH keys AS ({_EXPECTED}) SELECT 's3_publication_verification' AS check_name, 's3' AS dataset, CASE WHEN lost = 0 THEN 'PASSED' ELSE 'FAILED' END AS status,
  'total_keys=' || n || ';verified_count=' || n - lost || ';lost_keys=' || coalesce((SELECT string_agg(key, ',' ORDER BY key) FROM (SELECT key FROM keys WHERE y <> 1998 ORDER BY key LIMIT 20)), '') AS metrics
FROM (SELECT count(*) AS n, count(*) FILTER (y <> 1998) AS lost FROM keys)""")
def _(spark, sf):
    return metrics_as_text(publication_check(spark, _runs(spark, sf), _expected(spark, sf), verify=True))
