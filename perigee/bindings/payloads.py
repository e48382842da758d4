"""Raw JSON documents derived row by row from orders, events and part.

Each row gives one document with a sound record, a copy or a broken variant, chosen by the row's key,
so every rejection is met. No rows are grouped to build them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.bindings.domain import table

RUN = {"run_id": "raw-1", "snapshot_time": "2024-03-01T00:00:00Z"}


def _spread(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table spread over the cores: the given files hold one row group each, and parsing the
    documents costs far more than moving the narrow rows. Stored raw files need no such step."""
    return table(spark, sf_dir, name).repartition(2 * spark.sparkContext.defaultParallelism, key)


def _obj(**pieces: Column | str) -> Column:
    """A JSON object of already encoded values; a NULL value leaves its key out."""
    parts = [F.concat(F.lit(f'"{k}":'), v if isinstance(v, Column) else F.lit(v)) for k, v in pieces.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _q(value: Column) -> Column:
    return F.concat(F.lit('"'), value.cast("string"), F.lit('"'))


def _either(condition: Column, yes, no) -> Column:
    wrap = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.when(condition, wrap(yes)).otherwise(wrap(no))


def _silenced(doc: Column, turn: Column, first: int, empty: Column) -> Column:
    """The document, cut short where `turn` is `first` and without records at the next turn."""
    return F.when(turn == first, F.substring(doc, F.lit(1), F.length(doc) - 2)).when(turn == first + 1, empty).otherwise(doc)


def approach_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed document per order: a record that may be broken, its copy, and a sound one on another date."""
    orders = _spread(spark, sf_dir, "orders", "o_orderkey")
    v, key = F.col("o_orderkey") % 16, F.col("o_orderkey")
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    price = F.col("o_totalprice")

    def record(ident: Column, day: Column, case) -> Column:
        is_case = lambda n: (v == n) & F.lit(case)
        none = F.lit(None).cast("string")
        approach = _obj(
            close_approach_date=_either(is_case(3), none, _either(is_case(4), '"2024-13-01"', _q(day))),
            close_approach_date_full=_either(is_case(12), '"soon"', _q(F.date_format("o_orderdate", "yyyy-MMM-dd 07:18"))),
            epoch_date_close_approach=_either(is_case(11), '"123"', (key * 1000).cast("string")),
            miss_distance=_either(is_case(5), none, _obj(
                kilometers=_either(is_case(6), '"abc"', _either(is_case(7), '"-5"', _q(price))))),
            relative_velocity=_obj(kilometers_per_second=_either(is_case(10), '"0"', '"12.5"')),
        )
        low, high = (price / 1e6).cast("string"), (price / 4e5).cast("string")
        return _obj(
            id=_either(is_case(0), none, _q(ident)), name=_either(is_case(1), '""', _q(F.concat(F.lit("N "), key.cast("string")))),
            absolute_magnitude_h="21.5",
            estimated_diameter=_obj(kilometers=_obj(
                estimated_diameter_min=_either(is_case(9), high, low), estimated_diameter_max=_either(is_case(9), low, high))),
            is_potentially_hazardous_asteroid=_either(is_case(8), '"true"', _either(F.col("o_orderstatus") == "F", "true", "false")),
            is_sentry_object=_either(is_case(13), '"false"', "false"),
            links=_obj(self=_q(F.concat(F.lit("http://x/neo?id="), key.cast("string"), F.lit("&api_key=S3cret&z=1")))),
            close_approach_data=_either(is_case(2), "[]", F.concat(F.lit("["), approach, F.lit("]"))),
        )

    main = record(F.concat(F.lit("7"), key.cast("string")), date, True)
    other_day = F.date_format(F.date_sub(F.col("o_orderdate").cast("date"), 1), "yyyy-MM-dd")
    sound = record(F.concat(F.lit("8"), key.cast("string")), other_day, False)
    copy = F.when(v < 14, F.concat(F.lit(","), main)).otherwise(F.lit(""))
    near = F.concat(F.lit("{"), _q(date), F.lit(":["), main, copy, F.lit("],"), _q(other_day), F.lit(":["), sound, F.lit("]}"))
    doc = _silenced(_obj(near_earth_objects=near), key % 97, 3, F.concat(F.lit('{"near_earth_objects":{},"n":'), key.cast("string"), F.lit("}")))
    return orders.select(key.cast("string").alias("source_file"), doc.alias("payload"))


def risk_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalog document per event: a record that may be broken, its copy, and something that is no record."""
    events = _spread(spark, sf_dir, "events", "event_id")
    v, key = F.col("event_id") % 14, F.col("event_id")
    none = F.lit(None).cast("string")
    rec = _obj(
        id=_q(F.concat(F.lit(" e"), key.cast("string"), F.lit(" "))),
        des=_either(v == 11, '" "', _q(F.concat(F.lit("D "), F.col("user_id").cast("string")))),
        fullname=_either(v == 8, none, '"(Full)"'),
        ip=_either(v == 0, '"0"', _either(v == 1, '"1"', _either(v == 2, '"1.5"', '"4.5e-07"'))),
        n_imp=_either(v == 3, '"0"', _either(v == 12, "7", '"5"')),
        ps_cum='"-3.25"', ps_max=_q(F.col("value")),
        ts_max=_either(v == 4, '"-1"', '"0"'), v_inf=_either(v == 5, '"-1"', '"17.25"'),
        range=_either(v == 9, none, '"2061-2094"'), last_obs=_either(v == 10, '"2024-2-1"', _q(F.date_format("ts", "yyyy-MM-dd"))),
        h=_either(v == 6, '" "', _either(v == 7, '"x"', '"20.25"')), diameter='"0.31"', last_obs_jd="2455555.5",
    )
    doc = _obj(data=F.concat(F.lit("["), rec, F.lit(","), rec, F.lit(",3]")))
    doc = _silenced(doc, key % 89, 5, F.lit('{"data":[]}'))
    return events.select(
        key.alias("file_no"), F.lit(RUN["run_id"]).alias("run_id"), F.lit(RUN["snapshot_time"]).alias("snapshot_time"),
        F.concat(F.lit("2024-03-01#"), key.cast("string")).alias("snapshot_key"), doc.alias("payload"))


def catalog_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object document per part; two neighbouring parts are two targets of one object."""
    part = _spread(spark, sf_dir, "part", "p_partkey")
    v, key = F.col("p_partkey") % 20, F.col("p_partkey")
    none = F.lit(None).cast("string")
    text = key.cast("string")
    spkid = F.floor(key / 2).cast("bigint").cast("string")
    des = F.concat(F.lit("P"), text)
    obj = _obj(
        spkid=_either(v == 0, none, _q(F.concat(F.lit("9"), spkid))), des=_either(v == 2, '" "', _q(des)),
        fullname=_either(v == 4, none, _q(F.col("p_name"))), kind=_either(v == 4, '""', '"an"'),
        neo=_either(v == 5, none, _either(v == 6, '"true"', "true")), pha=_either(F.col("p_size") > 25, "true", "false"),
        orbit_class=_either(v == 8, '{"code":"APO"}', _obj(code='"APO"', name=_q(F.col("p_brand")))),
        orbit_id='"14"',
        des_alt=_either(v == 5, none, _either(v == 6, "[]", F.concat(
            F.lit('[{"des":"  alt   '), text, F.lit('"},{"pri":"'), des, F.lit('"},{"des":"alt '), text, F.lit('"},"plain"]')))),
    )
    element = lambda name, value: F.concat(F.lit(f'{{"name":"{name}","value":"'), value, F.lit('","sigma":"0.1","units":" au "}'))
    size = F.col("p_size").cast("string")
    elements = F.concat(
        F.lit("["), element("e", _either(v == 10, "-.5", F.concat(F.lit("."), size))), F.lit(","),
        element("a", F.col("p_retailprice").cast("string")), F.lit(","), element("q", F.lit("n/a")), F.lit(',{"value":"1"}]'))
    orbit = _obj(
        orbit_id='"14"', epoch=_either(v == 12, '"0"', '"2461000.5"'), equinox='"J2000"', n_obs_used=_either(v == 14, "-1", size),
        rms=_either(v == 16, '"bad"', '".42"'), moid='".01"', moid_jup=_either(v == 5, "null", '"2.5"'), data_arc='"3844"',
        condition_code=_either(v == 7, none, '"1"'), elements=_either(v == 18, "[]", elements),
    )
    parameter = lambda name, value: F.concat(F.lit('{"name":"'), name, F.lit('","value":'), value, F.lit(',"ref":"R1"}'))
    phys = F.concat(
        F.lit("["), parameter(F.lit("H"), _q(F.col("p_retailprice"))), F.lit(","),
        parameter(_either(v == 19, "H", "extent"), F.lit('"1 x 2"')), F.lit(","), parameter(F.lit("albedo"), F.lit("null")), F.lit("]"))
    return part.select(
        F.lit("2024-03-01").alias("snapshot_key"), F.lit(RUN["run_id"]).alias("run_id"), F.lit(RUN["snapshot_time"]).alias("snapshot_time"),
        F.concat(F.lit("T"), F.lpad(text, 10, "0")).alias("target"), _obj(object=obj, orbit=orbit, phys_par=phys).alias("payload"))
