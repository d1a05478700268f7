"""The jobs of each sample as a state machine: which run, which may start next, and when the sample is done.

Reports of finished and failed jobs come as events, each with its sample's traits. Times are those of the events, so the result doesn't
depend on how they are cut into batches as long as a sample's reports come in order.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The jobs of a sample, with the trait of samples that have it (None: all), and the jobs after which it starts.
JOBS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "main": ((), ()),
    "midi": (("midi",), ()),
    "resistance": ((), ("main", "midi")),
    "mixed_main": (("hcv",), ()),
    "mixed_midi": (("hcv", "midi"), ()),
    "denovo_main": ((), ()),
    "denovo_midi": (("midi",), ()),
    "denovo_resistance": ((), ("denovo_main", "denovo_midi")),
    "proviral": (("nfl",), ("denovo_main", "denovo_midi")),
}
TRAITS = ("midi", "hcv", "nfl")
LATE = "2 days"
#: A job from which nothing is heard for so long is lost, and its sample has failed.
LOST = datetime.timedelta(days=4)
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "run long, job string, change string, at long"
STATE = ", ".join(f"{t} boolean" for t in TRAITS) + ", over boolean, jobs array<string>, statuses array<string>, times array<long>"


class SampleJobs(StatefulProcessor):
    """A map from job to its status (running, finished, failed or lost) and when it got it; a timer is due when a running job is lost.

    A call to the state's store takes longer than a report, so a sample's state is read once and written once for all of its
    reports in a batch, and timers are for jobs that run at the batch's end. Times are microseconds; timers have milliseconds.
    """

    def __init__(self, lost: datetime.timedelta = LOST) -> None:
        self.lost = lost // datetime.timedelta(microseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sample = handle.getValueState("sample", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        known = self._read()
        if known and self._next_loss() is None:
            return
        ordered = sorted(((row.at, row.ord, row) for row in rows), key=lambda r: r[:2])
        if not known:
            at, _, first = ordered[0]
            self.traits, self.over, self.jobs = tuple(bool(first[t]) for t in TRAITS), False, {}
            yield from self._advance(key[0], at)
        before, loss = dict(self.jobs) if known else {}, self._next_loss()
        for at, _, row in ordered:
            if loss is None:
                break
            if loss < at:
                yield from self._expire(key[0], at)
                loss = self._next_loss()
            if self._status(row.job) == "running":
                yield from self._end(key[0], row.job, "failed" if row.failed else "finished", at)
                loss = self._next_loss()
        self._write(before)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        self._read()
        before = dict(self.jobs)
        yield from self._expire(key[0], 1000 * expiredTimerInfo.getExpiryTimeInMs() + 1)
        self._write(before)

    def close(self) -> None:
        pass

    def _read(self) -> bool:
        """Whether the sample is known."""
        state = self.sample.get()
        if state is not None:
            *traits, self.over, names, statuses, times = state
            self.traits, self.jobs = tuple(traits), {job: (status, at) for job, status, at in zip(names, statuses, times, strict=True)}
        return state is not None

    def _write(self, before: dict[str, tuple[str, int]]) -> None:
        """The state, if a job's differs from `before`; a sample is over only by a change of a job."""
        if self.jobs != before:
            self.sample.update((*self.traits, self.over, [*self.jobs], [status for status, _ in self.jobs.values()], [at for _, at in self.jobs.values()]))
            for at in {at for job, (status, at) in self.jobs.items() if status == "running" and job not in before}:
                self.handle.registerTimer(-(-(at + self.lost) // 1000))

    def _status(self, job: str) -> str | None:
        return self.jobs.get(job, (None,))[0]

    def _next_loss(self) -> int | None:
        """When the first of the running jobs is lost; None: none runs, and none can start."""
        return min((at + self.lost for status, at in self.jobs.values() if status == "running"), default=None)

    def _expire(self, run: int, now: int) -> Iterator[Row]:
        """Jobs lost before `now`, in the order in which they were."""
        running = [(at, job) for job, (status, at) in self.jobs.items() if status == "running"]
        for at, job in sorted(running):
            if at + self.lost < now:
                yield from self._end(run, job, "lost", at + self.lost)

    def _end(self, run: int, job: str, status: str, at: int) -> Iterator[Row]:
        self.jobs[job] = (status, at)
        yield Row(run=run, job=job, change=status, at=at)
        yield from self._advance(run, at)

    def _advance(self, run: int, at: int) -> Iterator[Row]:
        """Start what may start; tell once that the sample has failed, or that all of its jobs are finished."""
        if self.over:
            return
        held = {t for t, has in zip(TRAITS, self.traits, strict=True) if has}
        own = {job: after for job, (needs, after) in JOBS.items() if held.issuperset(needs)}
        now = {job: self._status(job) for job in own}
        over = None
        if {"failed", "lost"} & {*now.values()}:
            over = "failed"
        elif all(status == "finished" for status in now.values()):
            over = "complete"
        else:
            for job, after in own.items():
                if now[job] is None and all(now[x] == "finished" for x in after if x in own):
                    self.jobs[job] = ("running", at)
                    yield Row(run=run, job=job, change="start", at=at)
        if over:
            self.over = True
            yield Row(run=run, job="sample", change=over, at=at)


def job_changes(reports: DataFrame, lost: datetime.timedelta = LOST) -> DataFrame:
    """run, job, change (start, finished, failed, lost; of job "sample": complete, failed), ts, of `reports(run, ts, ord, job, failed, midi,
    hcv, nfl)`.

    A sample's first report shows that it is there: jobs that wait for none start then. A job that waits for others starts when
    those of them that the sample has are finished. After a job has failed or is lost no more start, and those that run go on.
    Reports of jobs that don't run, unknown ones too, change nothing; reports later than LATE may be dropped. The session's state
    store has to be PROVIDER.
    """
    kept = reports.withWatermark("ts", LATE).select("run", "ts", F.unix_micros("ts").alias("at"), "ord", "job", "failed", *(F.coalesce(t, F.lit(False)).alias(t) for t in TRAITS))
    changes = kept.groupBy("run").transformWithState(SampleJobs(lost), CHANGES, "append", "eventTime")
    return changes.select("run", "job", "change", F.timestamp_micros("at").alias("ts"))
