"""Domain tables derived from the driver's star schema by fixed projections over whole tables.

customer -> catalog identities, orders -> approaches, snapshots and orbits, lineitem -> elements and
physical parameters, events -> risk snapshots. Each projection gives every rule something to do:
shared designations, contradicting names, blank ids, calendar gaps, missing values. `bindings.sql`
states the same projections for the SQL checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators.resolution import resolve
from perigee.runtime import fresh_path, tune
from perigee.sources.sinks import save_crosswalk
from perigee.sources.tables import Lakehouse, read_table

RUN_ID = "run-0001"
RESOLVED_AT = "2024-03-01T00:00:00Z"
AS_OF = "2024-02-03T00:00:00Z"

ELEMENT_BY_LINE = {1: "e", 2: "a", 3: "q", 4: "i", 5: "per", 6: "om", 7: "ma"}
PARAMETER_BY_FLAGS = {
    "AF": "H", "NO": "diameter", "RF": "albedo", "RO": "rot_per", "AO": "extent", "NF": "GM",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _text(value: Column) -> Column:
    return value.cast("string")


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the columns the identity projections use."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nat"),
        F.col("c_name").alias("cname"), F.col("c_acctbal").alias("bal"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumns(
        {"day": F.col("o_orderdate").cast("date"), "yr": F.year("o_orderdate"), "k": F.col("o_custkey")})


def designation(k: Column, seg: Column, nat: Column, yr: Column) -> Column:
    even = (yr % 2) == 0
    return (
        F.when((seg == "MACHINERY") & (nat < 5), F.concat(F.lit("M "), _text(nat)))
        .when((seg == "AUTOMOBILE") & (nat == 24) & even, F.concat(F.lit("2024 X"), _text(k)))
        .otherwise(F.concat(F.lit("2024 C"), _text(k)))
    )


def catalog_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object snapshot per customer and year with orders."""
    # Dealt out by customer once, for the aggregate and the join.
    years = _orders(spark, sf_dir).repartition("k").groupBy("k", "yr").agg(F.max("o_orderkey").alias("last_order"))
    rows = years.join(identities(spark, sf_dir), "k")
    k, seg, nat, yr = F.col("k"), F.col("seg"), F.col("nat"), F.col("yr")
    own = designation(k, seg, nat, yr)
    second_name = (seg == "BUILDING") & (nat == 24) & ((yr % 2) == 0)
    day = F.concat(_text(yr), F.lit("-12-31"))
    return rows.select(
        day.alias("snapshot_key"), F.concat(F.lit("cat-"), _text(yr)).alias("run_id"),
        F.concat(day, F.lit("T06:00:00Z")).alias("snapshot_time"),
        F.when((seg == "FURNITURE") & (nat == 20), "  ").otherwise(F.concat(F.lit("20"), _text(k))).alias("spkid"),
        own.alias("designation"),
        F.concat(F.lit("("), "cname", F.when(second_name, " bis").otherwise(""), F.lit(")")).alias("fullname"),
        F.when(F.col("bal") >= 0, F.col("cname")).alias("shortname"), F.lit("an").alias("object_kind"),
        F.when(nat % 3 == 0, True).when(nat % 3 == 1, False).alias("is_neo"),
        F.when(F.col("bal") > 5000, True).when(F.col("bal") >= 0, False).alias("is_pha"),
        F.substring("seg", 1, 3).alias("orbit_class_code"), F.col("seg").alias("orbit_class_name"),
        _text(F.col("last_order")).alias("orbit_id"), F.lit(None).cast("string").alias("prefix"),
        F.when(nat == 23, None).when(nat == 22, F.array().cast("array<string>"))
        .when(nat == 21, F.array(F.lit("A-21")))
        .otherwise(F.array(F.concat(F.lit(" A-"), _text(k), F.lit(" ")), own)).alias("alternate_designations"),
    )


def approaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One approach per order, with date partition columns."""
    rows = _orders(spark, sf_dir).join(identities(spark, sf_dir), "k")
    k, seg, nat, yr = F.col("k"), F.col("seg"), F.col("nat"), F.col("yr")
    own, following = F.concat(F.lit("2024 C"), _text(k)), F.concat(F.lit("2024 C"), _text(k + 1))
    ident = (
        F.when(seg == "AUTOMOBILE", F.concat(F.lit("20"), _text(k)))
        .when(seg == "BUILDING", F.concat(F.lit("30"), _text(k)))
        .when(seg == "FURNITURE", F.concat(F.lit("40"), _text(k)))
        .when(seg == "HOUSEHOLD", F.concat(F.lit("50"), _text(k)))
        .when(nat == 10, " ").when(nat == 9, F.concat(F.lit("N"), _text(k)))
        .otherwise(F.concat(F.lit("60"), _text(k)))
    )
    name = (
        F.when((seg == "AUTOMOBILE") & (nat < 5), following)
        .when(seg == "AUTOMOBILE", F.concat(F.lit("("), own, F.lit(")")))
        .when((seg == "BUILDING") & (nat == 6) & ((yr % 2) == 0), following)
        .when(seg == "BUILDING", F.concat(F.lit("(  2024   c"), _text(k), F.lit(" )")))
        .when(seg == "FURNITURE", F.col("cname"))
        .when((seg == "HOUSEHOLD") & (nat == 21), "A-21")
        .when(seg == "HOUSEHOLD", F.concat(F.lit("a-"), _text(k)))
        .when(nat < 5, F.concat(F.lit("M "), _text(nat))).when(nat == 11, None)
        .otherwise(own)
    )
    price, priority = F.col("o_totalprice"), F.substring("o_orderpriority", 1, 1)
    return rows.select(
        ident.alias("id"), name.alias("name"), F.date_format("day", "yyyy-MM-dd").alias("closest_approach_date"),
        (price * 100).alias("miss_distance_km"),
        F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False).alias("hazardous"),
        F.when(priority != "4", F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T07:18"))).alias("close_approach_datetime"),
        (F.col("o_orderkey") * 1000).alias("close_approach_epoch_ms"),
        F.when(priority != "3", price / 10000).alias("relative_velocity_km_s"),
        (F.lit(10) + nat / F.lit(2.0)).alias("absolute_magnitude_h"),
        F.when(priority != "2", price / 1e6).alias("estimated_diameter_min_km"),
        F.when(priority != "2", price / 4e5).alias("estimated_diameter_max_km"),
        F.when(priority == "1", True).when(priority == "5", False).alias("is_sentry_object"),
        F.date_format("day", "yyyy").alias("year"), F.date_format("day", "MM").alias("month"), F.date_format("day", "dd").alias("day"),
    )


def _risk(spark: SparkSession, sf_dir: str, runs_per_day: int) -> DataFrame:
    """Risk snapshots per (day, user). After every tenth day the calendar skips one, so some dates
    are uncaptured though no event is left out."""
    events = table(spark, sf_dir, "events")
    days = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    half = F.when(F.hour("ts") < 12, "a").otherwise("b") if runs_per_day == 2 else F.lit("a")
    seen = events.select(
        "event_id", "user_id", "event_type", "value", "ts", half.alias("half"),
        F.date_add(F.lit("2024-01-01").cast("date"), (days + F.floor(days / 10)).cast("int")).alias("snap"))
    typed = lambda kind: F.when(F.col("event_type") == kind, F.col("value"))
    rows = seen.groupBy("snap", "half", "user_id").agg(
        F.max("value").alias("hi"), F.min("value").alias("lo"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_type") == "error").alias("errors"), F.max(typed("view")).alias("view_hi"),
        F.min(typed("purchase")).alias("buy_lo"), F.min("ts").alias("first_ts"), F.max("event_id").alias("last_event"))
    u, day = F.col("user_id"), F.date_format("snap", "yyyy-MM-dd")
    partner = F.when(u % 4 == 3, u - 1).otherwise(u)
    des = (
        F.when(u % 50 == 49, " ").when(u % 50 == 48, "M 3").otherwise(F.concat(F.lit("2024 C"), _text(partner)))
    )
    return rows.select(
        day.alias("snapshot_key"), F.concat(F.lit("risk-"), day, "half").alias("run_id"),
        F.concat(day, F.lit("T"), F.date_format("first_ts", "HH:mm:ss"), F.lit("Z")).alias("snapshot_time"),
        F.concat(F.lit("u"), _text(u)).alias("sentry_id"), des.alias("designation"),
        F.concat(F.lit("("), des, F.lit(")")).alias("fullname"),
        F.floor(F.col("buy_lo")).cast("double").alias("absolute_magnitude"),
        (F.floor(F.col("view_hi") / 10) / 100).alias("estimated_diameter_km"),
        (F.floor(F.col("hi") / 100) / 1000).alias("impact_probability"), F.col("n").alias("potential_impacts_count"),
        (F.floor(F.col("lo")) / 4 - 6).alias("palermo_scale_cum"), (F.floor(F.col("hi") / 50) / 2 - 5).alias("palermo_scale_max"),
        F.col("errors").alias("torino_scale_max"), F.floor(F.col("hi")).cast("double").alias("v_infinity_km_s"),
        F.when(F.col("n") == 1, "").otherwise(F.concat(F.lit("2030-"), _text(F.lit(2030) + F.col("n")))).alias("impact_year_range"),
        F.date_format(F.date_sub("snap", (F.col("n") % 4).cast("int")), "yyyy-MM-dd").alias("last_obs_date"),
        (F.lit(2460000.5) + F.col("last_event")).alias("last_obs_jd"),
    )


def risk_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _risk(spark, sf_dir, 1)


def risk_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with two runs a day."""
    return _risk(spark, sf_dir, 2)


def _snapshot(yr: Column) -> list[Column]:
    day = F.concat(_text(yr), F.lit("-12-31"))
    return [day.alias("snapshot_key"), F.concat(F.lit("cat-"), _text(yr)).alias("run_id"),
            F.concat(day, F.lit("T06:00:00Z")).alias("snapshot_time")]


def orbits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One orbit solution per customer, year and order status."""
    # An aggregate of texts sorts its rows: here those of a shuffled part, not of a whole split of the file.
    rows = _orders(spark, sf_dir).repartition("k").groupBy("k", "yr", "o_orderstatus").agg(
        F.min("day").alias("d0"), F.max("day").alias("d1"), F.count(F.lit(1)).alias("n"),
        F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"), F.max("o_orderkey").alias("last_order"),
        F.max(F.substring("o_orderpriority", 1, 1)).alias("p"))
    none = F.lit(None).cast("string")
    return rows.select(
        *_snapshot(F.col("yr")), F.concat(F.lit("20"), _text(F.col("k"))).alias("spkid"),
        F.col("o_orderstatus").alias("orbit_id"), (F.lit(2450000.5) + F.col("last_order")).alias("epoch_jd"),
        F.when(F.col("p") == "2", "").otherwise("J2000").alias("equinox"), F.date_format("d1", "yyyy-MM-dd").alias("soln_date"),
        F.lit("JPL").alias("orbit_source"), none.alias("producer"),
        F.date_format("d0", "yyyy-MM-dd").alias("first_obs"), F.date_format("d1", "yyyy-MM-dd").alias("last_obs"),
        F.when(F.col("p") != "4", F.datediff("d1", "d0").cast("bigint")).alias("data_arc_days"),
        F.when(F.col("p") != "4", F.col("n") * 15).alias("n_obs_used"),
        F.when(F.col("p") == "4", None).when(F.col("p") == "5", "unknown").otherwise(F.col("p")).alias("condition_code"),
        (F.col("lo") / 1e6).alias("rms"), (F.col("lo") / 1e7).alias("earth_moid_au"), (F.col("hi") / 1e5).alias("jupiter_moid_au"),
        (F.col("n") / F.lit(2.0)).alias("t_jup"), none.alias("pe_used"), none.alias("sb_used"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the catalog id of their customer, dealt out by it, as everything about an object is grouped by it."""
    orders = _orders(spark, sf_dir).select("o_orderkey", F.concat(F.lit("20"), _text(F.col("k"))).alias("spkid"), "yr", "o_orderstatus")
    return table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).repartition("spkid")


def _lookup(mapping: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[key]


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orbit elements by line number, the largest scaled price per (customer, year, status, element)."""
    rows = _lines(spark, sf_dir).groupBy("spkid", "yr", "o_orderstatus", "l_linenumber").agg(
        F.max("l_extendedprice").alias("v"), F.max("l_discount").alias("s"))
    none = F.lit(None).cast("string")
    return rows.select(
        *_snapshot(F.col("yr")), "spkid",
        F.col("o_orderstatus").alias("orbit_id"), F.lit(2450000.5).alias("epoch_jd"), F.lit("J2000").alias("equinox"),
        _lookup(ELEMENT_BY_LINE, F.col("l_linenumber")).alias("element_name"), (F.col("v") / 1e4).alias("element_value"),
        F.col("s").alias("sigma"), none.alias("units"), none.alias("title"), none.alias("label"),
    )


def physical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical parameters by flag pair."""
    rows = _lines(spark, sf_dir).groupBy("spkid", "yr", "l_returnflag", "l_linestatus").agg(F.max("l_quantity").alias("v"))
    name = _lookup(PARAMETER_BY_FLAGS, F.concat("l_returnflag", "l_linestatus"))
    none = F.lit(None).cast("string")
    return rows.select(
        *_snapshot(F.col("yr")), "spkid", name.alias("param_name"),
        F.when(name != "extent", F.col("v")).alias("param_value_numeric"),
        F.concat(_text(F.col("v").cast("bigint")), F.when(name == "extent", " x 2").otherwise("")).alias("param_value_raw"),
        F.lit(None).cast("double").alias("sigma"), none.alias("units"), none.alias("bib_reference"), none.alias("notes"),
        none.alias("title"), none.alias("desc"),
    )


def crosswalk(spark: SparkSession, sf_dir: str):
    return resolve(approaches(spark, sf_dir), catalog_objects(spark, sf_dir), risk_snapshots(spark, sf_dir), RUN_ID, RESOLVED_AT)


_PUBLISHED: dict[tuple[str, str], str] = {}


def crosswalk_folder(spark: SparkSession, sf_dir: str) -> str:
    """Where the resolution stage publishes the crosswalk: written once per application to the shared
    folder; every later stage reads it back."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PUBLISHED:
        folder = fresh_path(spark, "crosswalk")
        save_crosswalk(crosswalk(tune(spark), sf_dir), folder)
        _PUBLISHED[key] = folder
    return _PUBLISHED[key]


def published_crosswalk(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Bridge and audit as published."""
    folder = crosswalk_folder(spark, sf_dir)
    return (read_table(spark, f"{folder}/bridge_asteroid_identifier.parquet", "bridge_asteroid_identifier"),
            read_table(spark, f"{folder}/fact_entity_resolution.parquet", "fact_entity_resolution"))


def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    bridge, audit = published_crosswalk(spark, sf_dir)
    return Lakehouse(
        approaches(spark, sf_dir), risk_snapshots(spark, sf_dir), catalog_objects(spark, sf_dir), orbits(spark, sf_dir),
        elements(spark, sf_dir), physical(spark, sf_dir), bridge, audit)
