"""Session defaults and sizing."""

from __future__ import annotations

from tidemill.session import shuffle_partitions_for


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_shuffle_partitions_cover_cores_and_bytes():
    assert shuffle_partitions_for(10, cores=64) == 64
    assert shuffle_partitions_for(100 * 10**12, cores=8000) == 745_059
