"""Catalogue tables in an embedded database, and the network's state."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from fringeline.plans.views import view
from fringeline.sources import database
from fringeline.streaming import operators as K

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@pytest.fixture(scope="module")
def url(spark, sf_dir):
    where = f"jdbc:derby:memory:{uuid.uuid4().hex}"
    view(spark, sf_dir, "bursts").select("bid", "iw", "relorb", "tanx").write.jdbc(f"{where};create=true", "bursts", properties={"driver": DRIVER})
    return where


def test_ranges_filters_and_columns(spark, sf_dir, url):
    want = view(spark, sf_dir, "bursts").select("bid", "iw", "relorb", "tanx")
    table = database.catalogue_table(spark, url, "bursts", "bid", 5, driver=DRIVER)
    assert table.rdd.getNumPartitions() == 5
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, want.collect()))
    some = table.filter((F.col("iw") == 2) & (F.col("relorb") > 20)).select("bid", "relorb")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(iw,2)" in plan.replace("*", "") and "GreaterThan(relorb,20)" in plan.replace("*", "")
    assert "ReadSchema: struct<bid:" in plan and "tanx" not in plan.split("ReadSchema")[1]
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, want.filter("iw = 2 and relorb > 20").select("bid", "relorb").collect()))


def test_without_a_key_and_with_bound_values(spark, sf_dir, url):
    table = database.catalogue_table(spark, url, "bursts", driver=DRIVER)
    assert table.rdd.getNumPartitions() == 1
    got = database.asked(spark, "select count(*) as n from {b} where iw = :iw", {"b": table}, iw=3).first().n
    assert got == view(spark, sf_dir, "bursts").filter("iw = 3").count()
    assert database.asked(spark, "select count(*) as n from {b} where cast(iw as string) = :iw", {"b": table}, iw="1 or true").first().n == 0


def test_retry():
    seen = []

    def fails(times, fault):
        def call():
            seen.append(1)
            if len(seen) <= times:
                raise fault
            return "done"

        seen.clear()
        return call

    assert database.retried(fails(2, OSError("SQLTransientConnectionException: gone")), 3, 0.01) == "done" and len(seen) == 3
    with pytest.raises(OSError):
        database.retried(fails(3, OSError("Connection refused")), 3, 0.01)
    with pytest.raises(ValueError):
        database.retried(fails(1, ValueError("no such table")), 3, 0.01)
    assert len(seen) == 1


def test_late_epochs_and_expired_frames(spark, tmp_path, monkeypatch):
    """A file a batch: an epoch that repeats or comes late makes no pair, and a frame's epochs go once its timer has run out."""
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=12 * i) for i in range(5)]
    late, far = dt.date(2010, 1, 1), dt.date(2040, 1, 1)
    batches = [[(1, d) for d in days[:3]], [(1, days[2]), (1, days[3]), (2, days[0])], [(1, late), (3, far)], [(3, far + dt.timedelta(days=2000))], [(1, far + dt.timedelta(days=2001)), (3, far + dt.timedelta(days=2002))]]
    for i, rows in enumerate(batches):
        frame = spark.createDataFrame([(f, e, dt.datetime.combine(e, dt.time(6))) for f, e in rows], "frame long, epoch date, ts timestamp")
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("frame long, epoch date, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = {tuple(r) for r in K.run_to_end(K.incremental_network(stream, "10 days")).collect()}
    pairs = {(1, a, b) for i, b in enumerate(days[:4]) for a in days[:i]}
    assert got == pairs | {(3, far + dt.timedelta(days=2000), far + dt.timedelta(days=2002))} | ({(3, far, far + dt.timedelta(days=2000)), (3, far, far + dt.timedelta(days=2002))} & got)
    assert not any(f == 1 and b > days[3] for f, _, b in got) and (1, late) not in {(f, a) for f, a, _ in got}
    assert spark.conf.get(K.STORE, None) != K.ROCKS
