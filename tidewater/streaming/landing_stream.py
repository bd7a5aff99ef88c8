"""Incremental staging as a Structured Streaming job.

The landing folder is a file source; each micro-batch of newly landed pages
runs the same pipeline steps through ``foreachBatch``. With
``trigger(availableNow=True)`` a scheduled run processes everything landed
since the last run and stops, and the stream checkpoint records which files
were consumed. A failed step fails its epoch, which is replayed: each step's
commit records "<stream>:<epoch>:<table>" in the same atomic manifest swap, so
the replay skips the steps that were published (also the insert-only snapshot).

What a micro-batch holds does not change the result. Pages of a fetch
(entity, run, parent) that has not landed in full are carried to the next
epoch in the table ``LandingCarry``; the table also shows which fetches are
unfinished. A carried page gives way to the same page landed again, and a
carried fetch to one of a later run, or of the batch alone, that finished.
Without run dates all pages of one parent count as one fetch. The runs of a
backlog are staged one after the other, oldest first, each with its own date;
facts older than a run's window are upserted, not dropped, as their files are
consumed.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.plans.pipeline import DIMENSION_STEPS, FACT_STEPS, RunContext, run_steps
from tidewater.schemas import LANDING, TableSpec
from tidewater.sources import landing as L
from tidewater.sources.store import StagingStore

CARRY = TableSpec("LandingCarry", L.LANDED, (), "replace")


def _carried(store: StagingStore, batch: DataFrame) -> DataFrame:
    """Pages of earlier epochs that may still finish a fetch together with ``batch``."""
    old = L.pages_without(store.read(CARRY.name, CARRY), L.finished_fetches(batch))
    return L.pages_without(old, batch, (*L.FETCH, "page_no"))


def _unfinished(pages: DataFrame) -> DataFrame:
    """Pages to carry on: of no finished fetch, and no later run finished the same parent."""
    finished = L.finished_fetches(pages)
    held = L.pages_without(pages, finished)
    later = finished.groupBy("entity", "parent_id").agg(F.max("run_date").alias("_run")).select(
        F.col("entity").alias("_entity"), F.col("parent_id").alias("_parent"), "_run")
    return held.join(later, (F.col("entity") == F.col("_entity")) & F.col("parent_id").eqNullSafe(F.col("_parent"))
                     & (F.col("run_date") < F.col("_run")), "left_anti")


def start_landing_stream(spark: SparkSession, landing_path: str, store: StagingStore, checkpoint: str,
                         run_date: dt.date, load_ts: dt.datetime, steps=None,
                         since: dt.date | None = None, until: dt.date | None = None,
                         available_now: bool = True,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    steps = steps if steps is not None else DIMENSION_STEPS + FACT_STEPS
    reader = spark.readStream.schema(L.LANDED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = reader.parquet(landing_path)

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        # the query's own id, which its checkpoint holds: another checkpoint is another stream
        stream = json.loads(batch.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
        marker = f"{stream}:{epoch_id}"
        if store.committed(f"{marker}:{CARRY.name}"):
            return  # the last commit of an epoch: all its steps are published
        carrying = store.exists(CARRY.name)
        old = _carried(store, batch).persist(StorageLevel.MEMORY_AND_DISK) if carrying else None
        try:
            pages = batch.select(*L.LANDED.fieldNames())
            pages = pages.unionByName(old) if carrying else pages
            # one row per run in the batch; pages without a date are of the job's own run
            runs = {r.run_date for r in pages.select("run_date").distinct().collect()} or {None}
            for day in sorted(runs, key=lambda d: (d is None, d)):
                own = f":{day}" if day else ""
                ctx = RunContext(spark=batch.sparkSession, store=store, run_date=day or run_date, load_ts=load_ts,
                                 landing=pages.where(F.col("run_date").eqNullSafe(F.lit(day).cast("date")))
                                 .select(*LANDING.fieldNames()),
                                 since=since, until=until, backlog=since is None,
                                 run_id=f"stream-{epoch_id}{own}", commit_marker=f"{marker}{own}")
                failed = [r for r in run_steps(ctx, steps) if r.status != "succeeded"]
                if failed:  # the epoch must not count as consumed: its replay skips the steps that were published
                    raise RuntimeError("; ".join(f"{r.name}: {r.error}" for r in failed))
            held = _unfinished(pages)
            if carrying or not held.isEmpty():
                store.commit({CARRY.name: held}, specs={CARRY.name: CARRY}, marker=f"{marker}:{CARRY.name}")
        finally:
            if old is not None:
                old.unpersist()

    writer = source.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
