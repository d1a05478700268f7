"""Queries that drain a stream of the events table, with the SQL of their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.plans.registry import duck, query
from readloom.streaming import folders, jobs


@query("st1_completed_runs", duck("WITH s AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY run ORDER BY ts) < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS new FROM file_events), k AS (SELECT *, sum(new) OVER (PARTITION BY run ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM s) SELECT run, min(ts) AS first, max(ts) AS last, count(*) AS n FROM k GROUP BY run, g HAVING max(ts) + INTERVAL 6 HOURS <= (SELECT max(ts) FROM file_events) - INTERVAL 2 DAYS", "file_events"))
def st1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = folders.drained(folders.completed_runs(folders.event_stream(spark, sf_dir)), "append")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first", "last")})


_DUE = "flagged + INTERVAL 6 HOURS < (SELECT least(max(ts) FILTER (WHERE kind = 'click'), max(ts) FILTER (WHERE kind IN ('error', 'purchase'))) - INTERVAL 2 DAYS FROM file_events)"


@query("st2_new_work", duck(f"SELECT run, ts AS flagged FROM file_events f WHERE kind = 'click' AND {_DUE.replace('flagged', 'f.ts')} AND NOT EXISTS (SELECT 1 FROM file_events m WHERE m.run = f.run AND m.kind IN ('error', 'purchase') AND m.ts BETWEEN f.ts - INTERVAL 6 HOURS AND f.ts + INTERVAL 6 HOURS)", "file_events"))
def st2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks flag runs; errors and purchases mark them. The newest come first."""
    flags = folders.event_stream(spark, sf_dir).filter("kind = 'click'").select("run", "ts")
    markers = folders.event_stream(spark, sf_dir).filter("kind IN ('error', 'purchase')").select("run", "ts")
    out = folders.drained(folders.new_work(flags, markers), "append")
    return out.withColumn("flagged", F.col("flagged").cast("timestamp_ntz")).orderBy(F.desc("flagged"), "run")


_JOBS = list(jobs.JOBS)
_REPORTS = f"reports AS (SELECT run, ts, ord, CASE {' '.join(f'WHEN ord % 9 = {i} THEN {chr(39)}{j}{chr(39)}' for i, j in enumerate(_JOBS))} END AS job, kind = 'error' AND ord % 37 = 0 AS failed, run % 3 = 0 AS midi, run % 5 = 0 AS hcv, run % 4 = 0 AS nfl FROM file_events)"
_ENDED = """SELECT b.run, b.job, b.start, CASE WHEN seen <= b.start + INTERVAL 4 DAYS THEN CASE WHEN bad THEN 'failed' ELSE 'finished' END WHEN b.start + INTERVAL 4 DAYS <= greatest(last, wm) THEN 'lost' END AS change,
  CASE WHEN seen <= b.start + INTERVAL 4 DAYS THEN seen WHEN b.start + INTERVAL 4 DAYS <= greatest(last, wm) THEN b.start + INTERVAL 4 DAYS END AS done
  FROM (SELECT x.run, x.job, x.start, min(r.ts) AS seen, arg_min(r.failed, r.ts) AS bad FROM {0} x LEFT JOIN reports r ON r.run = x.run AND r.job = x.job AND r.ts >= x.start GROUP BY ALL) b JOIN samples s ON s.run = b.run, mark"""
_THEN = "SELECT e.run, '{0}' AS job, max(done) AS start FROM ended1 e JOIN samples s ON s.run = e.run WHERE e.job IN ('{1}', '{2}') AND {3} GROUP BY e.run HAVING bool_and(change = 'finished') AND count(change) = count(*)"


@query(
    "st3_job_states",
    duck(
        f"""WITH {_REPORTS}, samples AS (SELECT run, min(ts) AS t0, max(ts) AS last, any_value(midi) AS midi, any_value(hcv) AS hcv, any_value(nfl) AS nfl FROM reports GROUP BY run), mark AS (SELECT max(ts) - INTERVAL 2 DAYS AS wm FROM reports),
    began1 AS (SELECT run, job, t0 AS start FROM samples, (VALUES ('main', false, false), ('midi', true, false), ('mixed_main', false, true), ('mixed_midi', true, true), ('denovo_main', false, false), ('denovo_midi', true, false)) j(job, m, h) WHERE (midi OR NOT m) AND (hcv OR NOT h)),
    ended1 AS ({_ENDED.format('began1')}),
    began2 AS ({_THEN.format('resistance', 'main', 'midi', 'true')} UNION ALL {_THEN.format('denovo_resistance', 'denovo_main', 'denovo_midi', 'true')} UNION ALL {_THEN.format('proviral', 'denovo_main', 'denovo_midi', 'nfl')}),
    ended2 AS ({_ENDED.format('began2')}), both_ AS (SELECT * FROM ended1 UNION ALL SELECT * FROM ended2), broken AS (SELECT run, min(done) AS f FROM both_ WHERE change IN ('failed', 'lost') GROUP BY run),
    valid AS (SELECT o.* FROM both_ o LEFT JOIN broken b ON b.run = o.run WHERE f IS NULL OR start < f OR o.job NOT IN ('resistance', 'denovo_resistance', 'proviral'))
    SELECT run, job, 'start' AS change, start AS ts FROM valid UNION ALL SELECT run, job, change, done FROM valid WHERE change IS NOT NULL UNION ALL SELECT run, 'sample', 'failed', f FROM broken
    UNION ALL SELECT v.run, 'sample', 'complete', max(done) FROM valid v JOIN samples s ON s.run = v.run GROUP BY v.run HAVING count(*) = 4 + any_value(CAST(nfl AS INT) + 2 * CAST(midi AS INT) + CAST(hcv AS INT) + CAST(hcv AND midi AS INT)) AND bool_and(coalesce(change = 'finished', false))""",
        "file_events",
    ),
)
def st3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events are reports of jobs of the run's sample: of which job is told by their number."""
    job = F.element_at(F.array(*map(F.lit, _JOBS)), (F.col("ord") % len(_JOBS) + 1).cast("int"))
    failed = (F.col("kind") == "error") & (F.col("ord") % 37 == 0)
    reports = folders.event_stream(spark, sf_dir).select("run", "ts", "ord", job.alias("job"), failed.alias("failed"), *((F.col("run") % n == 0).alias(t) for t, n in zip(jobs.TRAITS, (3, 5, 4), strict=True)))
    return folders.drained(jobs.job_changes(reports), "append", provider=jobs.PROVIDER).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("st4_folder_counts", duck("SELECT run, count(*) AS n, bool_or(kind = 'purchase') AS complete FROM file_events GROUP BY run", "file_events"))
def st4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folders.drained(folders.folder_counts(folders.event_stream(spark, sf_dir)), "complete")


@query("st5_kind_counts", duck("SELECT kind, count(*) AS n FROM file_events GROUP BY kind", "file_events"))
def st5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folders.drained(folders.kind_counts(folders.event_stream(spark, sf_dir)), "complete")
