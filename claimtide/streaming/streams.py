"""Stream forms of the polling jobs, over landed files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions import labels as lb
from ..session import scratch_path
from ..sources.versions import VersionedTables


def file_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None, glob: str | None = None
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def run_available(stream: DataFrame, target: str | None = None, mode: str = "append") -> str:
    """Process what has landed into Parquet and stop; the checkpoint keeps the place."""
    spark = stream.sparkSession
    target = target or scratch_path(spark, "stream")
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", f"{target}-state")
        .option("path", target)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return target


def run_each_batch(stream: DataFrame, handle, state: str, mode: str = "append") -> None:
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def unique_by(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """First row of a key; its state is dropped once the watermark passes."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


class UpsertLog:
    """Keyed table as parts of per-batch last rows, folded while the stream runs.

    A batch commits one part with a row per key it touched, under its number, so
    a repeated batch changes nothing and no batch rewrites the table. As soon as
    `fan` parts of one size class stand together they are folded to one of the
    next, so n batches leave about `fan` times log(n) parts, and only the newest
    `keep` versions stay readable. Readers take the last row per key.
    """

    def __init__(
        self, path: str, key: str, order: list[str], payload: list[str], links: str | None = None, fan: int = 8, keep: int = 4
    ):
        self.path, self.key, self.order, self.payload, self.links = path, key, order, payload, links
        self.fan, self.keep = fan, keep

    def tables(self, spark: SparkSession) -> VersionedTables:
        return VersionedTables(spark, self.path, self.fan)

    def _fold(self, rows: DataFrame, writes) -> DataFrame:
        last = F.max_by(F.struct(*self.payload), F.struct(*self.order)).alias("p")
        at = F.max(F.struct(*self.order)).alias("o")
        folded = rows.groupBy(self.key).agg(last, at, writes.alias("writes"))
        return folded.select(self.key, "p.*", *[F.col(f"o.{c}").alias(c) for c in self.order if c not in self.payload], "writes")

    def _rows(self, parts: DataFrame) -> DataFrame:
        return self._fold(parts, F.sum("writes"))

    def _links(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(self.key, self.links).agg(F.sum("pushes").alias("pushes"))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        parts = {"rows": self._fold(batch, F.count("*"))}
        if self.links:
            parts["links"] = batch.groupBy(self.key, self.links).agg(F.count("*").alias("pushes"))
        store = self.tables(batch.sparkSession)
        store.commit(run=f"batch {batch_id}", append=parts, folds={"rows": self._rows, "links": self._links})
        store.expire(self.keep)

    def current(self, spark: SparkSession) -> DataFrame:
        return self._rows(self.tables(spark).table("rows"))

    def current_links(self, spark: SparkSession) -> DataFrame:
        return self._links(self.tables(spark).table("links"))

    def compact(self, spark: SparkSession, target: str) -> UpsertLog:
        """The same table as one part, elsewhere."""
        other = UpsertLog(target, self.key, self.order, self.payload, self.links, self.fan, self.keep)
        whole = {"rows": self.current(spark)} | ({"links": self.current_links(spark)} if self.links else {})
        other.tables(spark).commit(replace=whole)
        return other


def upsert_stream(stream: DataFrame, log: UpsertLog) -> UpsertLog:
    run_each_batch(stream, log.write, f"{log.path}-state")
    return log


def day_counts(stream: DataFrame, time: str, keys: list[str], delay: str) -> DataFrame:
    """Counts per day and keys; a day is final when the watermark passes it."""
    counted = stream.withWatermark(time, delay).groupBy(F.window(time, "1 day"), *keys).agg(
        F.count("*").alias("count")
    )
    return counted.select(F.col("window.start").alias("day"), *keys, "count")


def sliding_activity(
    stream: DataFrame, time: str, delay: str, length: str = "12 hours", step: str = "1 hour", keys: tuple = ()
) -> DataFrame:
    counted = stream.withWatermark(time, delay).groupBy(F.window(time, length, step), *keys).agg(
        F.count("*").alias("count")
    )
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "count")


def sessions(stream: DataFrame, time: str, keys: list[str], gap: str, delay: str) -> DataFrame:
    counted = stream.withWatermark(time, delay).groupBy(F.session_window(time, gap), *keys).agg(
        F.count("*").alias("count")
    )
    return counted.select(
        F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "count"
    )


def label_arrivals(
    stream: DataFrame, claim_vectors: DataFrame, task: str, threshold: float, vector: str = "vector"
) -> DataFrame:
    """Label arriving (message_id, fact_id, vector) rows against static claims."""
    from ..functions import vectors as vx

    claims = claim_vectors.select("fact_id", F.col("vector").alias("_c"), vx.norm("vector").alias("_n"))
    joined = stream.join(claims, "fact_id", "left")
    score = vx.cosine(F.col("_c"), F.col(vector), F.col("_n"))
    return joined.withColumn("score", score).withColumn(
        task, lb.label_above(F.col("score"), threshold, task)
    ).drop("_c", "_n", vector)


class Marks(StatefulProcessor):
    """State of one channel: its highest id, until nothing of it has come for a while."""

    def __init__(self, channel: str, row_id: str, time: str, idle_ms: int):
        self.channel, self.row_id, self.time, self.idle_ms = channel, row_id, time, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.mark = handle.getValueState("mark", "mark long, seen long")

    def handleInputRows(self, key, rows, timerValues):
        mark, seen = self.mark.get() if self.mark.exists() else (None, None)
        for part in rows:
            # milliseconds since 1970, whatever unit the column came in
            latest = int(part[self.time].astype("datetime64[ms]").astype("int64").max())
            highest = int(part[self.row_id].max())
            mark, seen = max(highest, highest if mark is None else mark), max(latest, latest if seen is None else seen)
        self.mark.update((mark, seen))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(seen + self.idle_ms)
        yield pd.DataFrame({self.channel: [key[0]], "mark": [mark], "idle": [False]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = self.mark.get()[0]
        self.mark.clear()
        yield pd.DataFrame({self.channel: [key[0]], "mark": [mark], "idle": [True]})

    def close(self) -> None:
        pass


class HighWaterMarks:
    """Highest id per channel, kept in the state of a stream.

    The state holds one number per channel that was active lately: a channel of
    which nothing has come for `idle_days` of event time gives its mark to a
    versioned table, which is folded like an upsert log, and leaves the state.
    `current` reads both; no log of batches is kept. After a restart the stream
    goes on from its checkpoint.
    """

    PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    SETTING = "spark.sql.streaming.stateStore.providerClass"

    def __init__(self, path: str, channel: str, row_id: str, time: str, delay: str = "1 hour", idle_days: float = 30):
        self.path, self.channel, self.row_id, self.time, self.delay = path, channel, row_id, time, delay
        self.idle_ms = int(idle_days * 86_400_000)
        self.asleep = UpsertLog(f"{path}/asleep", channel, ["mark"], ["mark"])

    def marked(self, stream: DataFrame) -> DataFrame:
        """(channel, mark, idle): changed marks of each batch."""
        kind = stream.schema[self.channel].dataType.simpleString()
        rows = stream.where(F.col(self.channel).isNotNull() & F.col(self.row_id).isNotNull() & F.col(self.time).isNotNull())
        rows = rows.select(self.channel, F.col(self.row_id).cast("long").alias(self.row_id), self.time).withWatermark(self.time, self.delay)
        keeper = Marks(self.channel, self.row_id, self.time, self.idle_ms)
        out = f"`{self.channel}` {kind}, mark long, idle boolean"
        return rows.groupBy(self.channel).transformWithStateInPandas(keeper, out, "Update", "EventTime")

    def _with_provider(self, spark: SparkSession, work):
        before = spark.conf.get(self.SETTING)
        spark.conf.set(self.SETTING, self.PROVIDER)
        try:
            return work()
        finally:
            spark.conf.set(self.SETTING, before)

    def run(self, stream: DataFrame) -> None:
        """Take in what has landed and stop."""

        def put_to_sleep(batch: DataFrame, batch_id: int) -> None:
            gone = batch.where("idle").select(self.channel, "mark")
            if not gone.isEmpty():
                self.asleep.write(gone, batch_id)

        self._with_provider(stream.sparkSession, lambda: run_each_batch(self.marked(stream), put_to_sleep, f"{self.path}/state", "update"))

    def in_state(self, spark: SparkSession) -> DataFrame:
        """(channel, mark) of the channels in the stream's state."""
        state = spark.read.format("statestore").option("path", f"{self.path}/state").option("stateVarName", "mark")
        rows = self._with_provider(spark, state.load)
        return rows.select(F.col(f"key.`{self.channel}`").alias(self.channel), "value.mark")

    def current(self, spark: SparkSession) -> DataFrame:
        """(channel, mark) of all channels ever seen."""
        marks = self.in_state(spark)
        if self.asleep.tables(spark).version():
            marks = marks.unionByName(self.asleep.current(spark).select(self.channel, "mark"))
        return marks.groupBy(self.channel).agg(F.max("mark").alias("mark"))


def near_claim_stream(
    messages: DataFrame, claims: DataFrame, days: int, delay: str, message_time: str = "date", claim_time: str = "claim_date"
) -> DataFrame:
    """Message and claim streams joined on fact_id within +-N days, bounds excluded.

    Both watermarks and the interval let Spark drop state it cannot need.
    """
    m = messages.withWatermark(message_time, delay)
    c = claims.withColumnRenamed("fact_id", "claim_fact_id").withWatermark(claim_time, delay)
    span = F.make_dt_interval(days=F.lit(days))
    near = (
        (F.col("fact_id") == F.col("claim_fact_id"))
        & (F.col(message_time) > F.col(claim_time) - span)
        & (F.col(message_time) < F.col(claim_time) + span)
    )
    return m.join(c, near).drop("claim_fact_id")
