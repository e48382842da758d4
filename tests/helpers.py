"""Small tables under the stored schemas."""

from __future__ import annotations

from perigee.schemas import table_schema

RISK_DEFAULTS = dict(
    run_id="run", designation="2031 QT7", fullname="(2031 QT7)", impact_probability=1e-6, potential_impacts_count=5,
    palermo_scale_cum=-4.25, palermo_scale_max=-4.5, torino_scale_max=0, v_infinity_km_s=11.5, last_obs_date="2019-12-15",
    impact_year_range="2061-2094")


def make(spark, name, *rows, extra=""):
    """A table from dicts; absent columns are NULL."""
    schema = table_schema(name)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def risk_rows(spark, *rows):
    full = []
    for r in rows:
        day = r["snapshot_key"]
        full.append({**RISK_DEFAULTS, "sentry_id": "id_1", "snapshot_time": f"{day}T00:00:00Z", **r})
    return make(spark, "fact_sentry_risk_snapshot", *full)


def bridge_rows(spark, *rows):
    """(key, system, name, value[, pivot])"""
    return make(spark, "bridge_asteroid_identifier", *[
        dict(asteroid_key=r[0], source_system=r[1], identifier_name=r[2], identifier_value=r[3],
             is_primary_pivot=r[4] if len(r) > 4 else (r[1], r[2]) == ("sbdb", "spkid")) for r in rows])


def by(df, *keys):
    """Rows as dicts, keyed."""
    out = {}
    for r in df.collect():
        key = tuple(r[k] for k in keys)
        out[key[0] if len(key) == 1 else key] = r.asDict(recursive=True)
    return out
