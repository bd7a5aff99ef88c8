"""Store, pipeline and streaming: atomic commits, create-if-missing, partition replacement, rerun idempotence."""
import datetime as dt
import tempfile
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewater.plans.pipeline import RunContext, run_staging
from tidewater.plans.queries import landing_from_tables
from tidewater.sources.store import ConcurrentCommit, StagingStore
from tidewater.schemas import TABLES

SF = "/root/testdata/sf0.001"


def test_missing_table_reads_empty_with_schema(spark):
    store = StagingStore(spark, tempfile.mkdtemp(prefix="tw-store-"))
    df = store.read("Campaign")
    assert df.count() == 0 and df.schema == TABLES["Campaign"].schema


def test_two_table_commit_is_atomic(spark):
    store = StagingStore(spark, tempfile.mkdtemp(prefix="tw-store-"))
    good = spark.createDataFrame([("1", "c1", None)], TABLES["Creative"].schema)
    bad = spark.range(1).select(F.raise_error(F.lit("boom")).alias("x"))
    with pytest.raises(Exception):
        store.commit({"Creative": good, "Ad": bad})
    assert not store.exists("Creative") and not store.exists("Ad")
    store.commit({"Creative": good})
    assert store.read("Creative").count() == 1


def test_racing_writers_publish_exactly_one_version(spark, tmp_path):
    """Two writers that read the same manifest version: the second commit
    fails instead of overwriting the first one's tables."""
    root = str(tmp_path / "store")
    a, b = StagingStore(spark, root), StagingStore(spark, root)
    first = spark.createDataFrame([("1", "c1", None)], TABLES["Creative"].schema)
    second = spark.createDataFrame([("2", "c2", None)], TABLES["Creative"].schema)
    seen = b.manifest()
    a.commit({"Creative": first})
    b.manifest = lambda: seen  # b still holds the version it read before a committed
    with pytest.raises(ConcurrentCommit):
        b.commit({"Creative": second})
    assert [r.CreativeId for r in StagingStore(spark, root).read("Creative").collect()] == ["1"]


def test_manifest_without_jvm_gateway_uses_local_files(spark, tmp_path):
    """The Spark Connect fallback (no JVM in this process) keeps the same
    create-if-absent rule on a local path."""
    store = StagingStore(spark, str(tmp_path / "store"))
    store.files._jvm = None
    good = spark.createDataFrame([("1", "c1", None)], TABLES["Creative"].schema)
    store.commit({"Creative": good})
    assert store.manifest()["version"] == 1
    assert not store.files.create_new(store._manifest_path(1), "{}")
    assert store.read("Creative").count() == 1


def test_partitioned_fact_replaces_only_touched_days(spark):
    store = StagingStore(spark, tempfile.mkdtemp(prefix="tw-store-"))
    schema = TABLES["PageInsightsDaily"].schema
    d = dt.date
    rows = [(1, 20240101, "m", d(2024, 1, 1), None, None), (1, 20240102, "m", d(2024, 1, 2), None, None)]
    store.commit({"PageInsightsDaily": spark.createDataFrame(rows, schema)},
                 touched={"PageInsightsDaily": [20240101, 20240102]})
    # second run replaces day 2 with nothing: the day disappears, day 1 untouched
    store.commit({"PageInsightsDaily": spark.createDataFrame(rows[:1], schema)},
                 touched={"PageInsightsDaily": [20240102]})
    got = sorted(r.DateKey for r in store.read("PageInsightsDaily").collect())
    assert got == [20240101]


def test_vacuum_keeps_what_current_manifests_reference(spark, tmp_path):
    store = StagingStore(spark, str(tmp_path / "store"))
    cre = TABLES["Creative"].schema
    for i in range(3):
        store.commit({"Creative": spark.createDataFrame([(str(i), "c", None)], cre)})
    pid = TABLES["PageInsightsDaily"].schema
    d = dt.date
    day1, day2 = (1, 20240101, "m", d(2024, 1, 1), None, None), (1, 20240102, "m", d(2024, 1, 2), None, None)
    store.commit({"PageInsightsDaily": spark.createDataFrame([day1, day2], pid)},
                 touched={"PageInsightsDaily": [20240101, 20240102]})
    store.commit({"PageInsightsDaily": spark.createDataFrame([day2], pid)}, touched={"PageInsightsDaily": [20240102]})
    assert store.vacuum(keep_manifests=1) == []  # everything is younger than a day
    time.sleep(1.1)  # version stamps have one-second resolution; same-second folders count as young
    deleted = store.vacuum(keep_manifests=1, older_than=dt.timedelta(0))
    # two old Creative versions and the superseded day-2 partition of the first fact version
    assert len(deleted) == 3 and sum("DateKey=20240102" in p for p in deleted) == 1
    assert [r.CreativeId for r in store.read("Creative").collect()] == ["2"]
    assert sorted(r.DateKey for r in store.read("PageInsightsDaily").collect()) == [20240101, 20240102]


def test_partitioned_read_scans_only_requested_days(spark):
    store = StagingStore(spark, tempfile.mkdtemp(prefix="tw-store-"))
    schema = TABLES["PageInsightsDaily"].schema
    d = dt.date
    rows = [(1, 20240101 + i, "m", d(2024, 1, 1 + i), None, None) for i in range(5)]
    store.commit({"PageInsightsDaily": spark.createDataFrame(rows, schema)},
                 touched={"PageInsightsDaily": [r[1] for r in rows]})
    part = store.read("PageInsightsDaily", partitions=[20240102, 20240104, 20240199])
    assert sorted(r.DateKey for r in part.collect()) == [20240102, 20240104]
    assert store.read("PageInsightsDaily", partitions=[]).count() == 0


def test_daily_staging_twice_is_idempotent(spark):
    landing_path = tempfile.mkdtemp(prefix="tw-land-") + "/l"
    landing_from_tables(spark, SF).write.partitionBy("entity").parquet(landing_path)
    landing = spark.read.parquet(landing_path)
    store = StagingStore(spark, tempfile.mkdtemp(prefix="tw-store-"))
    ctx = dict(spark=spark, landing=landing, store=store, run_date=dt.date(2024, 1, 20),
               load_ts=dt.datetime(2024, 1, 20, 6), since=dt.date(2024, 1, 10), until=dt.date(2024, 1, 20),
               on_conflict="ignore")
    first = run_staging(RunContext(**ctx))
    assert all(r.status == "succeeded" for r in first), [r.error for r in first]
    snap = {t: sorted(map(tuple, store.read(t).collect()), key=str) for t in TABLES if store.exists(t)}
    second = run_staging(RunContext(**ctx))
    assert all(r.status == "succeeded" for r in second), [r.error for r in second]
    again = {t: sorted(map(tuple, store.read(t).collect()), key=str) for t in TABLES if store.exists(t)}
    assert snap == again
    assert store.read("Business").count() == 25
    assert store.read("AdAccount").count() == 150
    assert store.run_log().count() == 20


def test_snapshot_rerun_conflict_is_logged(spark):
    landing_path = tempfile.mkdtemp(prefix="tw-land-") + "/l"
    landing_from_tables(spark, SF).write.partitionBy("entity").parquet(landing_path)
    store = StagingStore(spark, tempfile.mkdtemp(prefix="tw-store-"))
    ctx = dict(spark=spark, landing=spark.read.parquet(landing_path), store=store, run_date=dt.date(2024, 1, 20),
               load_ts=dt.datetime(2024, 1, 20, 6), since=dt.date(2024, 1, 10), until=dt.date(2024, 1, 20))
    run_staging(RunContext(**ctx))
    second = {r.name: r for r in run_staging(RunContext(**ctx))}
    assert second["fact_post_insights_daily"].status == "failed"
    assert second["dimension_campaign"].status == "succeeded"


def test_rows_only_queries_run(spark):
    assert E.queries()["landing_stream"](spark, SF).count() == 1500
    log = E.queries()["daily_staging"](spark, SF).collect()
    assert len(log) == 10 and all(r.Status == "succeeded" for r in log)


def test_stream_processes_new_files_once(spark, tmp_path):
    from tidewater.plans.pipeline import DIMENSION_STEPS
    from tidewater.plans.queries import _campaign_pages
    from tidewater.sources import adapters as A
    from tidewater.streaming.landing_stream import start_landing_stream
    orders = A.table(spark, SF, "orders")
    land = str(tmp_path / "land")
    first = orders.where(F.col("o_orderkey") % 2 == 0)
    _campaign_pages(first, renumber=True).write.parquet(land + "/b1")
    store = StagingStore(spark, str(tmp_path / "store"))
    steps = [s for s in DIMENSION_STEPS if s[0] == "dimension_campaign"]
    ckpt = str(tmp_path / "ckpt")
    run = lambda: start_landing_stream(spark, land + "/*", store, ckpt, dt.date(2024, 1, 20),
                                       dt.datetime(2024, 1, 20), steps=steps).awaitTermination()
    run()
    n1 = store.read("Campaign").count()
    second = orders.where(F.col("o_orderkey") % 2 == 1)
    _campaign_pages(second, renumber=True).write.parquet(land + "/b2")
    keys1 = {r.CampaignID for r in store.read("Campaign").select("CampaignID").collect()}
    run()
    keys2 = {r.CampaignID for r in store.read("Campaign").select("CampaignID").collect()}
    # batch 2 passes the watermarks batch 1 committed (incremental), nothing of batch 1 is lost
    assert n1 == first.count() and keys1 < keys2
    assert all(k % 2 == 1 for k in keys2 - keys1)
    markers = store.manifest()["markers"]
    assert len(markers) == 2 and all(m.endswith(":Campaign") for m in markers)


def test_bounded_micro_batches_equal_one_batch(spark, tmp_path):
    """One landed file per micro-batch (each parent's pages in one file) gives
    the same Campaign table as one batch over everything."""
    import glob

    from tidewater.plans import entities
    from tidewater.plans.pipeline import DIMENSION_STEPS
    from tidewater.plans.queries import _campaign_pages
    from tidewater.schemas import RAW_CAMPAIGN
    from tidewater.sources import adapters as A
    from tidewater.sources import landing as L
    from tidewater.streaming.landing_stream import start_landing_stream
    pages = _campaign_pages(A.table(spark, SF, "orders"), renumber=True)
    land = str(tmp_path / "land")
    pages.repartition(3, "parent_id").write.parquet(land)
    files = glob.glob(land + "/*.parquet")
    store = StagingStore(spark, str(tmp_path / "store"))
    steps = [s for s in DIMENSION_STEPS if s[0] == "dimension_campaign"]
    start_landing_stream(spark, land, store, str(tmp_path / "ckpt"), dt.date(2024, 1, 20),
                         dt.datetime(2024, 1, 20), steps=steps, max_files_per_trigger=1).awaitTermination()
    epochs = {m.split(":")[1] for m in store.manifest()["markers"]}     # of the last two, which a replay may meet
    assert len(files) > 1 and epochs == {str(len(files) - 2), str(len(files) - 1)}
    got = store.read("Campaign").drop("LoadDate")
    want = entities.campaign(L.explode_pages(spark.read.parquet(land), RAW_CAMPAIGN)).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_cli_daily_and_replay(spark, tmp_path):
    from tidewater.__main__ import main
    land = str(tmp_path / "land")
    landing_from_tables(spark, SF).write.parquet(land)
    args = ["daily", "--landing", land, "--store", str(tmp_path / "store"), "--run-date", "2024-01-20",
            "--since", "2024-01-10", "--until", "2024-01-20"]
    assert main(args) == 0
    # a same-day rerun violates the snapshot key (error mode) but every other step succeeds
    assert main(args) == 1
    assert main(args + ["--on-conflict", "ignore"]) == 0
    # three runs left superseded dimension versions; vacuum keeps what the last manifest reads
    store = StagingStore(spark, str(tmp_path / "store"))
    before = store.read("Campaign").count()
    assert main(["vacuum", "--store", str(tmp_path / "store"), "--keep-manifests", "1",
                 "--older-than-hours", "0"]) == 0
    assert StagingStore(spark, str(tmp_path / "store")).read("Campaign").count() == before
