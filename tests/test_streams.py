import datetime
import random
import time

from pyspark.sql import Row
from pyspark.sql import functions as F

from readloom.streaming import folders, jobs

T0 = datetime.datetime(2024, 3, 1)
HOUR = datetime.timedelta(hours=1)
REPORTS = "run long, ts timestamp, ord long, job string, failed boolean, midi boolean, hcv boolean, nfl boolean"


def added(spark, where, rows, schema):
    time.sleep(0.01)  # files are taken in the order of their times
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(where))


def followed(spark, where, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(where))


def test_new_work_of_shuffled_events_equals_a_batch(spark, tmp_path):
    """Events come up to a day and a half late, markers before and after their flags, in files of a few."""
    rng = random.Random(1)
    events = [(rng.randrange(30), T0 + HOUR * rng.random() * 480, rng.choice(("flag", "mark"))) for _ in range(600)]
    events += [(99, T0 + 5 * HOUR, "flag"), (99, T0 + 11 * HOUR, "mark"), (98, T0 + 5 * HOUR, "flag"), (98, T0 + 11.1 * HOUR, "mark")]
    events.sort(key=lambda e: e[1] + HOUR * 36 * rng.random())
    schema = "run long, ts timestamp, kind string"
    for i in range(0, len(events), 100):
        added(spark, tmp_path / "e", events[i : i + 100], schema)
    of = lambda kind: followed(spark, tmp_path / "e", schema).filter(F.col("kind") == kind).select("run", "ts")
    out = folders.drained(folders.new_work(of("flag"), of("mark")), "append").collect()
    seen = min(max(t for _, t, k in events if k == kind) for kind in ("flag", "mark")) - 48 * HOUR
    marks = [(r, t) for r, t, k in events if k == "mark"]
    want = [(r, t) for r, t, k in events if k == "flag" and t + 6 * HOUR < seen and not any(q == r and abs(m - t) <= 6 * HOUR for q, m in marks)]
    assert sorted((r.run, r.flagged) for r in out) == sorted(want) and (98, T0 + 5 * HOUR) in want and len(want) > 20


def changes(spark, where, more=None):
    return [(r.run, r.job, r.change, r.ts) for r in folders.drained(jobs.job_changes(followed(spark, where, REPORTS)), "append", jobs.PROVIDER, more).collect()]


def test_jobs_start_when_those_before_them_are_finished(spark, tmp_path):
    at = lambda h: T0 + h * HOUR
    plain, all_of = (False, False, False), (True, True, True)
    rows = [(1, at(h), i, job, False, *plain) for i, (h, job) in enumerate([(0, "none"), (1, "resistance"), (2, "main"), (3, "resistance"), (4, "denovo_main"), (5, "denovo_resistance"), (6, "main")])]
    order = ["main", "denovo_main", "mixed_main", "midi", "resistance", "denovo_midi", "proviral", "mixed_midi", "denovo_resistance"]
    rows += [(2, at(10 + i), i, job, False, *all_of) for i, job in enumerate(["none", *order])]
    rows += [(3, at(0), 0, "main", True, *plain), (3, at(1), 1, "denovo_main", False, *plain), (4, at(0), 0, "main", False, *plain), (9, at(400), 0, "none", False, *plain)]
    added(spark, tmp_path / "r", rows, REPORTS)
    found = changes(spark, tmp_path / "r")
    of = lambda run: [(j, c, (t - T0) // HOUR) for r, j, c, t in sorted(found, key=lambda x: x[3]) if r == run]
    assert set(of(1)) == {("main", "start", 0), ("denovo_main", "start", 0), ("main", "finished", 2), ("resistance", "start", 2), ("resistance", "finished", 3), ("denovo_main", "finished", 4), ("denovo_resistance", "start", 4), ("denovo_resistance", "finished", 5), ("sample", "complete", 5)}
    starts = {j: t for j, c, t in of(2) if c == "start"}
    assert starts == {"main": 10, "midi": 10, "mixed_main": 10, "mixed_midi": 10, "denovo_main": 10, "denovo_midi": 10, "resistance": 14, "denovo_resistance": 16, "proviral": 16}
    assert of(2)[-1] == ("sample", "complete", 19)
    assert set(of(3)) == {("main", "start", 0), ("denovo_main", "start", 0), ("main", "failed", 0), ("sample", "failed", 0), ("denovo_main", "finished", 1)}
    assert set(of(4)) == {("main", "start", 0), ("denovo_main", "start", 0), ("main", "finished", 0), ("resistance", "start", 0), ("resistance", "lost", 96), ("denovo_main", "lost", 96), ("sample", "failed", 96)}


def test_states_go_on_from_a_checkpoint(spark, tmp_path):
    rng = random.Random(2)
    rows = sorted((run, T0 + HOUR * rng.random() * 300, 0, rng.choice(list(jobs.JOBS)), rng.random() < 0.01, run % 2 == 0, run % 3 == 0, run % 5 == 0) for run in range(25) for _ in range(40))
    rows.sort(key=lambda r: r[1])
    added(spark, tmp_path / "whole", rows, REPORTS)
    for i in (0, 120):
        added(spark, tmp_path / "parts", rows[i : i + 120], REPORTS)
    first = changes(spark, tmp_path / "parts", str(tmp_path / "state"))
    added(spark, tmp_path / "parts", rows[240:], REPORTS)
    second = changes(spark, tmp_path / "parts", str(tmp_path / "state"))
    assert sorted(first + second) == sorted(changes(spark, tmp_path / "whole")) and min(len(first), len(second)) > 20
    assert {"start", "finished", "failed", "lost", "complete"} == {c for _, _, c, _ in first + second}


class Store:
    """A state's store in memory that counts its calls."""

    def __init__(self):
        self.value, self.values, self.timers, self.calls = None, {}, [], 0

    def getValueState(self, *_):
        return self

    getMapState = getValueState

    def __getattribute__(self, name):
        if name in ("exists", "get", "update", "containsKey", "getValue", "updateValue", "iterator", "registerTimer"):
            self.calls += 1
        return object.__getattribute__(self, name)

    exists = lambda self: self.value is not None
    get = lambda self: self.value
    update = lambda self, value: setattr(self, "value", value)
    containsKey = lambda self, key: key in self.values
    getValue = lambda self, key: self.values[key]
    updateValue = lambda self, key, value: self.values.update({key: value})
    iterator = lambda self: iter([*self.values.items()])
    registerTimer = lambda self, at: self.timers.append(at)


def test_the_store_is_called_a_few_times_a_sample_not_a_report():
    store, hour = Store(), 3_600_000_000
    of = lambda at, job: Row(at=at * hour, ord=at, job=job, failed=False, midi=False, hcv=False, nfl=False)
    machine = jobs.SampleJobs()
    machine.init(store)
    told = lambda rows: [(r.job, r.change, r.at // hour) for r in rows]
    first = told(machine.handleInputRows((1,), iter([of(3, "main"), of(0, "none"), *(of(i, "none") for i in range(4, 50)), of(50, "resistance")]), None))
    assert first == [("main", "start", 0), ("denovo_main", "start", 0), ("main", "finished", 3), ("resistance", "start", 3), ("resistance", "finished", 50)]
    assert store.calls <= 5 and store.timers == [96 * 3600 * 1000]
    second = told(machine.handleInputRows((1,), iter([of(i, "denovo_resistance") for i in range(97, 200)]), None))
    assert second == [("denovo_main", "lost", 96), ("sample", "failed", 96)] and store.calls <= 10
    assert not [*machine.handleInputRows((1,), iter([of(201, "main")]), None)] and store.calls <= 11
