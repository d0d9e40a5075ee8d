"""Late-tolerant upsert of arriving rows into the current tier.

Each series keeps a state: its latest time, and the newest arrival of every time within its provisional window.
A row that is older than the window is late; a row that arrived before one that is in already changes nothing.
Both are told from the state alone. What is left of a batch is added to the table as a delta, which replaces older
rows when it is read, so a batch reads no rows of the table; deltas are folded into one version when they are many.
"""

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gridseries.schema import CURRENT, KEEP_MONTHS, OBS_SCHEMA, SERIES
from gridseries.sinks.versions import append_rows, work_folder
from gridseries.sources.snapshots import newest
from gridseries.sources.tables import scan_series

ARRIVALS = T.StructType([*[f for f in OBS_SCHEMA.fields if f.name != "tier"],
                         T.StructField("arrival", T.TimestampNTZType())])
JUDGED = T.StructType([*[f for f in OBS_SCHEMA.fields if f.name != "tier"], T.StructField("late", T.BooleanType())])
# microseconds; parallel arrays, one entry for each time of the window
STATE = "latest long, times array<long>, arrivals array<long>, values array<double>"
# a series without arrivals for this long keeps its latest time only
IDLE_DAYS = 31


def judge(keep_months: dict[str, int], idle_days: int = IDLE_DAYS) -> Callable:
    """The function of one series and its arrivals; it carries all it needs to the executors.

    A batch calls it for every series that has arrivals, each with few rows: they are taken as arrays, as a single
    step on a data frame would cost more than all of them do.
    """

    def run(key: tuple, frames: Iterator, state: GroupState) -> Iterator:
        import numpy as np
        import pandas as pd

        never = np.iinfo(np.int64).min
        latest, *held = state.get if state.exists else (never, [], [], [])
        if state.hasTimedOut:
            state.update((latest, [], [], []))
            return

        def micros(column) -> np.ndarray:
            # a missing time has the smallest number
            return np.asarray(column, "datetime64[us]").view(np.int64)

        def newest_of(time, arrival, value) -> np.ndarray:
            # places, in order of time; of one time: the latest arrival, then the largest value, a missing one last of all
            missing = np.isnan(value)
            order = np.lexsort((np.where(missing, 0, value), ~missing, arrival, time))
            ordered = time[order]
            return order[np.append(ordered[1:] != ordered[:-1], True)] if len(order) else order

        def window_start(last: int) -> int:
            months = keep_months.get(key[0])
            if months is None or last == never:
                return never
            return int((np.datetime64(int(last), "us").astype("datetime64[M]") - months).astype("datetime64[us]").astype(np.int64))

        seen = None
        for frame in frames:
            part = [micros(frame["time"]), micros(frame["arrival"]), np.asarray(frame["value"], float)]
            latest = max(latest, int(micros(frame["_latest"]).max(initial=never)))
            rows = part if seen is None else [np.concatenate(both) for both in zip(seen, part)]
            chosen = newest_of(*rows)
            seen = [column[chosen] for column in rows]
        if seen is None:
            return
        start = window_start(latest)
        late = (seen[0] < start) & (seen[0] != never)
        held = [np.array(held[0], np.int64), np.array(held[1], np.int64), np.array(held[2], float)]
        both = [np.concatenate([h, s[~late]]) for h, s in zip(held, seen)]
        # a row that equals the held one comes second to it
        chosen = newest_of(*both)
        window = [column[chosen] for column in both]
        # the held rows are in order of time, each time once
        before = np.searchsorted(held[0], window[0])
        time, arrival, value = (np.append(column, 0)[before] for column in held)
        same = (before < len(held[0])) & (time == window[0]) & (arrival == window[1]) & ((value == window[2]) | (np.isnan(value) & np.isnan(window[2])))
        fresh = (chosen >= len(held[0])) & ~same
        latest = max(latest, int(window[0].max(initial=never)))
        inside = window[0] >= window_start(latest)
        state.update((latest, *(column[inside].tolist() for column in window)))
        state.setTimeoutDuration(idle_days * 86_400_000)
        times = np.concatenate([window[0][fresh], seen[0][late]])
        if len(times):
            yield pd.DataFrame({"source": key[0], "var": key[1], "loc_id": key[2], "time": times.view("datetime64[us]"),
                                "value": np.concatenate([window[2][fresh], seen[2][late]]), "late": np.arange(len(times)) >= fresh.sum()})

    return run


def judged(arrivals: DataFrame, latest: DataFrame) -> DataFrame:
    """The rows that are to be stored, and late ones. `latest` has (source, var, loc_id, _latest) of series stored before."""
    known = arrivals.join(latest, SERIES, "left")
    return known.groupBy(*SERIES).applyInPandasWithState(judge(KEEP_MONTHS), JUDGED, STATE, "update", GroupStateTimeout.ProcessingTimeTimeout)


def let_in(batch: DataFrame, path: str, rejects: str, stream: str, batch_id: int) -> None:
    """Store one judged batch. A replay of the batch gives the same table and the same rejects."""
    spark = batch.sparkSession
    work = work_folder(path)
    batch.write.parquet(work)
    rows = spark.read.schema(JUDGED).parquet(work).withColumn("tier", F.lit(CURRENT))
    rows.filter("late").select(OBS_SCHEMA.names).write.mode("overwrite").parquet(f"{rejects.rstrip('/')}/batch={batch_id}")
    append_rows(rows.filter("not late").select(OBS_SCHEMA.names), path, delta=True, stream=(stream, batch_id))


def stored_latest(spark: SparkSession, path: str) -> DataFrame:
    """The latest time of each series of the current tier, from the table's lists."""
    current = scan_series(spark, path).filter(F.col("tier") == CURRENT)
    return current.groupBy(*SERIES).agg(F.max("time").alias("_latest"))


def stream_ingest(spark: SparkSession, incoming: str, path: str, rejects: str, checkpoint: str,
                  available_now: bool = True, interval: str = "10 minutes", files_per_batch: int | None = None):
    """Start the stream over Parquet files of `ARRIVALS` rows; returns the running query.

    `path` is a table that `write_obs` has written. What it holds when the stream starts is read once, from its lists
    of series. With `available_now` the query stops after what has arrived so far.
    """
    start = newest(spark, path)
    if start is None:
        raise ValueError(f"{path} is no table that write_obs has written")
    known = f"{checkpoint.rstrip('/')}-known/{start.number}"
    stored_latest(spark, path).write.mode("overwrite").parquet(known)
    reader = spark.readStream.schema(ARRIVALS)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader

    def store(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        let_in(batch, path, rejects, stream, batch_id)

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    # idle series are looked at in batches that have arrivals; batches for them alone would never end
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return (judged(reader.parquet(incoming), spark.read.parquet(known))
                .writeStream
                .outputMode("update")
                .foreachBatch(store)
                .option("checkpointLocation", checkpoint)
                .trigger(**trigger)
                .start())
    finally:
        spark.conf.set(setting, before)
