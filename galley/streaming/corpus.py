"""Continuous corpus state on Structured Streaming.

State is a table of paper records in immutable pieces with a pointer (sources.state).
A micro-batch is merged by ``foreachBatch``: last write wins by (batch, sequence). A batch that runs again after a crash puts the same rows in place of
the same keys: exactly once in effect. Only the buckets of its keys are rewritten."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from galley import schemas as S
from galley.operators import rollup
from galley.sources.corpus import read_control
from galley.sources.state import load_state, load_stats, merge_state


def upsert(state: DataFrame, batch: DataFrame, key: str = "arxiv_id", sequence: str | None = None) -> DataFrame:
    """State with the batch's rows in place of those of the same key; in the batch the largest sequence wins.

    Reads the batch's keys once: rows of other keys pass by an anti join and aren't ranked."""
    if sequence is not None:
        newest = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(sequence)))
        batch = batch.withColumn("_n", newest).filter("_n = 1").drop("_n")
    return state.join(batch.select(key), key, "left_anti").select(batch.columns).unionByName(batch)


def latest(events: DataFrame, key: str, *order: str) -> DataFrame:
    """The last event of each key by the order given: what any split of events into batches leads to."""
    last = F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(o) for o in order]))
    return events.withColumn("_n", last).filter("_n = 1").drop("_n")


def unseen(batch: DataFrame, state: DataFrame, key: str = "arxiv_id") -> DataFrame:
    return batch.dropDuplicates([key]).join(state.select(key), key, "left_anti")


def start_upserts(stream: DataFrame, root: str, checkpoint: str, schema, key: str = "arxiv_id", sequence: str | None = None, then: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Merge a stream of records into the state under ``root``; ``then`` sees the state after each batch."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            merge_state(batch, root, schema, key, lambda state, new: upsert(state, new, key, sequence))
        finally:
            batch.unpersist()
        if then is not None:
            then(load_state(spark, root, schema), number)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rollup_stream(events: DataFrame, event_time: str = "ts", late: str = "1 hour", every: str = "1 day") -> DataFrame:
    """Counts by window and status of a record stream, for append mode. Windows are not in the reference
    behaviour; they are offered because streams of records have times."""
    return events.withWatermark(event_time, late).groupBy(F.window(event_time, every).alias("w"), "status").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "status", "n")


def dashboard(papers: DataFrame, k: int = 10) -> dict:
    """Totals and top lists of the current state; small by construction."""
    out = rollup.totals(papers).first().asDict()
    for name in ("archive", "year", "primary_category"):
        out[name] = [(r.key, r.n) for r in rollup.top(rollup.histogram(papers, name), k).collect()]
    out["kinds"] = [(r.key, r.n) for r in rollup.top(rollup.merged_map(papers), 12).collect()]
    return out


class CorpusLoop:
    """pick -> candidates -> process -> upsert -> report, until a target, a stop request or exhaustion.

    ``query(archive, lo, hi, state, offset)`` gives candidates and ``process(candidates)`` records, both as DataFrames:
    catalogue scans and compile connectors plug in here. Control is read anew for each step. Offsets
    grow by archive when a query brings nothing new."""

    def __init__(self, spark: SparkSession, root: str, query, process, *, control: str | None = None, quota: int | None = None, archives: tuple[str, ...] = S.ARCHIVES,
                 batch: int = 20, max_images: int | None = None, max_papers: int | None = None, report_every: int = 0, report=print, seed: int = 0):
        self.spark, self.root, self.query, self.process = spark, root, query, process
        self.control, self.quota, self.archives, self.batch = control, quota, archives, batch
        self.max_images, self.max_papers, self.every, self.report, self.seed = max_images, max_papers, report_every, report, seed
        self.offsets: dict[str, int] = {}
        self.stopped, self.steps = False, 0

    def stop(self) -> None:
        self.stopped = True

    @property
    def state(self) -> DataFrame:
        return load_state(self.spark, self.root)

    def step(self) -> bool:
        """One cycle; False when there is nothing left to do."""
        control = read_control(self.spark, self.control) if self.control else {}
        state = self.state
        if rollup.target_reached(state, self.max_images, self.max_papers):
            return False
        found = rollup.pick(state, self.spark, control, self.quota, self.archives, self.seed + self.steps)
        if found is None:
            return False
        archive, (lo, hi) = found
        self.steps += 1
        offset = self.offsets.get(archive, 0)
        new = rollup.screened(unseen(self.query(archive, lo, hi, state, offset), state), state, list(control.get("skip_primary_cats") or []))
        new = new.withColumn("archive", F.lit(archive))
        if not new.limit(1).count():
            self.offsets[archive] = offset + self.batch
            return True
        skipped = new.filter("status = 'failed'")
        done = self.process(new.filter("status <> 'failed'"))
        blank = {f.name: F.lit(None).cast(f.dataType) for f in S.PAPER}
        shape = lambda df: df.select(*[(F.col(n) if n in df.columns else v).cast(S.PAPER[n].dataType).alias(n) for n, v in blank.items()])
        batch = shape(done).unionByName(shape(skipped)).persist()
        try:
            merge_state(batch, self.root, S.PAPER)
        finally:
            batch.unpersist()
        if self.every and load_stats(self.spark, self.root)["papers_total"] % self.every == 0:
            self.report(dashboard(self.state))
        return True

    def run(self, most: int = 1_000_000) -> int:
        """Steps until nothing is left, a stop is asked for, or ``most`` steps are done."""
        done = 0
        while not self.stopped and done < most and self.step():
            done += 1
        return done
