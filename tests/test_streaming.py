import datetime as dt
import time

import pandas as pd
import pytest

from gridseries.schema import KEEP_MONTHS, OBS_SCHEMA
from gridseries.sinks import versions
from gridseries.sinks.writers import write_obs
from gridseries.sources.snapshots import newest
from gridseries.sources.tables import scan_obs, scan_series
from gridseries.streaming.upsert import ARRIVALS, JUDGED, judge, let_in, stream_ingest

T = "temperature_2m"


def at(month, day=1):
    return dt.datetime(2024, month, day)


def land(spark, path, rows):
    frame = spark.createDataFrame([("nasapower", T, loc, time, value, arrival) for loc, time, value, arrival in rows], ARRIVALS)
    frame.coalesce(1).write.mode("append").parquet(path)
    return frame


def current(spark, path):
    return {(r["loc_id"], r["time"]): r["value"] for r in scan_obs(spark, path, tiers=["current"]).collect()}


def start(spark, tmp_path):
    path = str(tmp_path / "obs")
    rows = [("nasapower", "current", T, 0, at(m), float(m)) for m in (4, 5, 6)]
    rows += [("nasapower", "historic", T, 0, at(1), 1.0)]
    write_obs(spark.createDataFrame(rows, OBS_SCHEMA), path)
    return path


def late_rows(spark, path):
    return sorted(r["value"] for r in spark.read.schema(OBS_SCHEMA).option("recursiveFileLookup", "true").parquet(path).collect())


def test_stream_upserts_and_rejects_late_rows(spark, tmp_path):
    path, incoming = start(spark, tmp_path), str(tmp_path / "incoming")
    # the stored series reaches June: before May is settled
    land(spark, incoming, [(0, at(6), 60.0, at(7)), (0, at(6), 61.0, at(8)), (0, at(7), 70.0, at(8)),
                           (0, at(2), 20.0, at(8)), (9, at(2), 90.0, at(8))])
    run = lambda: stream_ingest(spark, incoming, path, str(tmp_path / "late"), str(tmp_path / "cp")).awaitTermination()
    run()
    want = {(0, at(4)): 4.0, (0, at(5)): 5.0, (0, at(6)): 61.0, (0, at(7)): 70.0, (9, at(2)): 90.0}
    assert current(spark, path) == want
    assert late_rows(spark, str(tmp_path / "late")) == [20.0]
    land(spark, incoming, [(0, at(7), 71.0, at(9))])
    run()
    assert current(spark, path) == {**want, (0, at(7)): 71.0}
    assert scan_obs(spark, path, tiers=["historic"]).count() == 1


def test_later_batches_are_judged_from_state(spark, tmp_path):
    """The window moves with the arrivals of earlier batches; an older arrival that comes later changes nothing."""
    path, incoming, late = start(spark, tmp_path), str(tmp_path / "incoming"), str(tmp_path / "late")
    batches = [
        [(0, at(6, 5), 1.0, at(8)), (3, at(3), 3.0, at(8))],
        # the window of 0 still starts in May, that of 3 in February
        [(0, at(6, 5), 2.0, at(7)), (0, at(5, 2), 52.0, at(9)), (3, at(1), 31.0, at(9)), (0, at(9), 90.0, at(9))],
        # now it starts in August
        [(0, at(6, 5), 3.0, at(10)), (0, at(8, 2), 82.0, at(10)), (3, at(2), 32.0, at(10))],
    ]
    for rows in batches:
        land(spark, incoming, rows)
        stream_ingest(spark, incoming, path, late, str(tmp_path / "cp")).awaitTermination()
    assert current(spark, path) == {(0, at(4)): 4.0, (0, at(5)): 5.0, (0, at(6)): 6.0, (0, at(6, 5)): 1.0, (0, at(5, 2)): 52.0, (0, at(9)): 90.0,
                                    (0, at(8, 2)): 82.0, (3, at(3)): 3.0, (3, at(2)): 32.0}
    assert late_rows(spark, late) == [3.0, 31.0]
    # nothing was rewritten: what the table began with is still there, the batches lie beside it
    assert sum(f.split("/")[0].endswith("-delta") for f in newest(spark, path).folders) == 3
    assert scan_series(spark, path).filter("tier = 'current' and loc_id = 0").agg({"last": "max"}).first()[0] == at(9)
    versions.compact(spark, path)
    assert len(current(spark, path)) == 9


def test_several_batches_of_one_run(spark, tmp_path):
    path, incoming = start(spark, tmp_path), str(tmp_path / "incoming")
    for i in range(4):
        land(spark, incoming, [(0, at(6, 2), float(i), at(7, 1 + i)), (0, at(6, 3 + i), 5.0, at(7))])
    stream_ingest(spark, incoming, path, str(tmp_path / "late"), str(tmp_path / "cp"), files_per_batch=1).awaitTermination()
    got = current(spark, path)
    assert got[0, at(6, 2)] == 3.0 and len(got) == 8 and len(newest(spark, path).streams) == 1


def test_replayed_batch_changes_nothing(spark, tmp_path):
    path, late = start(spark, tmp_path), str(tmp_path / "late")
    batch = spark.createDataFrame([("nasapower", T, 0, at(9), 90.0, False), ("nasapower", T, 0, at(2), 20.0, True)], JUDGED)
    for _ in range(2):
        let_in(batch, path, late, "stream", 0)
        assert len(current(spark, path)) == 4 and late_rows(spark, late) == [20.0] and newest(spark, path).number == 2
    let_in(batch.limit(0), path, late, "stream", 1)
    assert newest(spark, path).streams == {"stream": 1} and len(current(spark, path)) == 4


class State:
    """What Spark hands to the function of a key."""

    def __init__(self):
        self.value, self.hasTimedOut, self.waits = None, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def setTimeoutDuration(self, ms):
        self.waits = ms


def arrivals(rows, latest=None):
    return pd.DataFrame([(pd.Timestamp(t) if t else pd.NaT, v, pd.Timestamp(a) if a else pd.NaT, pd.Timestamp(latest) if latest else pd.NaT) for t, v, a in rows],
                        columns=["time", "value", "arrival", "_latest"])


def judged(state, frames, source="nasapower"):
    return {(None if pd.isna(t) else t.to_pydatetime(), None if pd.isna(v) else v, late) for out in judge(KEEP_MONTHS)((source, T, 0), iter(frames), state)
            for t, v, late in zip(out["time"], out["value"], out["late"])}


def test_state_of_a_series():
    state = State()
    # chunks of one batch; the largest of equal arrivals, a missing value after any
    assert judged(state, [arrivals([(at(6), 1.0, at(7)), (at(5), 5.0, None)]), arrivals([(at(6), 2.0, at(7)), (at(6), None, at(7)), (at(1), 0.0, at(7))], at(5, 20))]) == {
        (at(6), 2.0, False), (at(5), 5.0, False), (at(1), 0.0, True)}
    assert state.waits and len(state.value[1]) == 2
    # equal rows are not stored again
    assert judged(state, [arrivals([(at(6), 2.0, at(7)), (at(5), 4.0, None)])]) == set()
    assert judged(state, [arrivals([(at(6), 1.5, at(7)), (at(5), 6.0, at(3))])]) == {(at(5), 6.0, False)}
    # the window moves on and the state with it
    assert judged(state, [arrivals([(at(9), 9.0, at(9))])]) == {(at(9), 9.0, False)}
    assert len(state.value[1]) == 1 and judged(state, [arrivals([(at(6), 3.0, at(9))])]) == {(at(6), 3.0, True)}
    # an idle series keeps its latest time
    state.hasTimedOut = True
    assert judged(state, []) == set() and state.value[1] == []
    state.hasTimedOut = False
    assert judged(state, [arrivals([(at(7), 3.0, at(9)), (None, 1.0, at(9))])]) == {(at(7), 3.0, True), (None, 1.0, False)}


@pytest.mark.parametrize("source,late", [("era5", at(3)), ("stations", None)])
def test_windows_follow_the_source(source, late):
    got = judged(State(), [arrivals([(at(m), float(m), at(12)) for m in range(1, 9)], at(9))], source)
    assert {t for t, _, is_late in got if is_late} == ({at(m) for m in range(1, 9) if at(m) <= late} if late else set())


def test_a_series_with_few_arrivals_is_judged_quickly():
    """Every series of a batch is a call of its own, so the time of a call is that of the stream."""
    frame, states = arrivals([(at(6, 1 + i), float(i), at(7)) for i in range(20)], at(5)), [State() for _ in range(400)]
    judged(State(), [frame])
    run, begun = judge(KEEP_MONTHS), time.process_time()
    for _ in range(2):
        for loc, state in enumerate(states):
            list(run(("nasapower", T, loc), iter([frame]), state))
    assert time.process_time() - begun < 2.0
