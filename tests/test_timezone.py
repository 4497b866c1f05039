"""Results do not depend on the session time zone (event times are
wall-clock values read as UTC)."""

import __spark_entry__ as E
from conftest import SF001

NAMES = ("velocity_windows", "activity_by_step", "dest_velocity", "split_summary")


def test_session_time_zone_does_not_matter(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    seen = {}
    try:
        for tz in ("UTC", "Asia/Kolkata", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            seen[tz] = {n: sorted(tuple(r) for r in E.queries()[n](spark, SF001).collect()) for n in NAMES}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert seen["Asia/Kolkata"] == seen["UTC"] == seen["America/Los_Angeles"]
