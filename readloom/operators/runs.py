"""Run, app and release level tables: statistics, joins of reports, comparisons, reviews, sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.operators.edits import edit_distance
from readloom.operators.groups import spread
from readloom.operators.ranks import numbered


def numeric(value: str | Column) -> Column:
    """A number, or null for what isn't one."""
    return (F.col(value) if isinstance(value, str) else value).try_cast("double")


def run_statistics(rows: DataFrame, key: list[str], averages: list[str], distinct: str) -> DataFrame:
    """key, the averages of numeric values, and matches: rows, distinct and duplicate values of `distinct`.

    Rows are spread by key and value before they are counted, as there may be as many of these as rows: a task holds those of a bounded number.
    """
    n = F.count(distinct)
    own = F.count_distinct(distinct)
    return spread(rows, *key, distinct).groupBy(*key).agg(*(F.avg(numeric(a)).alias(a) for a in averages), n.alias("matches"), own.alias("unique_matches"), (n - own).alias("duplicate_matches"))


def soft_clip_total(rows: DataFrame, key: list[str], position: list[str], value: str) -> DataFrame:
    """key, clips: each position's largest value, added."""
    per = rows.groupBy(*key, *position).agg(F.max(value).alias("_v"))
    return per.groupBy(*key).agg(F.sum("_v").alias("clips"))


def app_means(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.groupBy("app").agg(*(F.avg(c).alias(c) for c in columns), F.count(F.lit(1)).alias("n"))


def concordance_statistics(rows: DataFrame, key: list[str], least: int = 10) -> DataFrame:
    """key, mean and population deviation of concordance, mean product with depth in percent; groups of `least` covered rows."""
    covered = rows.filter("depth > 0").groupBy(*key)
    product = F.avg(F.col("depth") * F.col("concordance") / 100)
    return covered.agg(F.avg("concordance").alias("mean"), F.stddev_pop("concordance").alias("deviation"), product.alias("product"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def midpoint_quartiles(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """key, mean, q1, median, q3, iqr; a quartile between two values is their midpoint. By ranks, so no group is gathered."""
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    ranked = numbered(rows.select(*key, value), key, [value], "_i").join(sizes, key)

    def at(share: float) -> Column:
        place = (F.col("_n") - 1) * share
        return (F.max(F.when(F.col("_i") == F.floor(place), F.col(value))) + F.max(F.when(F.col("_i") == F.ceil(place), F.col(value)))) / 2

    out = ranked.groupBy(*key).agg(F.avg(value).alias("mean"), at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    return out.withColumn("iqr", F.col("q3") - F.col("q1"))


def median_coverage(rows: DataFrame, samples: DataFrame) -> DataFrame:
    """sample, median of its nonzero coverage, rows; samples without any have 0."""
    median = rows.filter("coverage > 0").groupBy("sample").agg(F.percentile("coverage", 0.5).alias("median"), F.count(F.lit(1)).alias("n"))
    return samples.join(median, "sample", "left").fillna(0, ["median", "n"])


def project_combinations(rows: DataFrame) -> DataFrame:
    """projects (sorted, + joined), samples, latest of `rows(sample, project, run)`."""
    per = rows.groupBy("sample").agg(F.array_join(F.array_sort(F.collect_set("project")), "+").alias("projects"), F.max("run").alias("run"))
    return per.groupBy("projects").agg(F.count(F.lit(1)).alias("samples"), F.max("run").alias("latest"))


def joined_tables(tables: list[DataFrame], column: str) -> DataFrame:
    """All tables outer-joined on one column; other names that two share are an error; missing values are ''."""
    seen: set[str] = {column}
    for t in tables:
        clash = seen & set(t.columns) - {column}
        if clash:
            raise ValueError(f"columns in more than one table: {sorted(clash)}")
        seen |= set(t.columns)
    whole = reduce(lambda a, b: a.join(b, column, "full"), tables)
    return whole.select(column, *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in whole.columns if c != column))


def app_differences(rows: DataFrame, first: str, second: str, numbers: list[str], texts: list[str]) -> DataFrame:
    """sample, per number the second app's mean less the first's and the first's as _base; per text a, or a/b where they differ.

    Only samples of both apps.
    """
    per = rows.groupBy("app", "sample").agg(*(F.avg(n).alias(n) for n in numbers), *(F.min(t).alias(t) for t in texts))
    a, b = (per.filter(F.col("app") == app).drop("app") for app in (first, second))
    b = b.select("sample", *(F.col(c).alias(f"_{c}") for c in (*numbers, *texts)))
    joined = a.join(b, "sample")
    differences = [c for n in numbers for c in ((F.col(f"_{n}") - F.col(n)).alias(n), F.col(n).alias(f"{n}_base"))]
    changed = [F.when(F.col(t).eqNullSafe(F.col(f"_{t}")), F.col(t)).otherwise(F.concat_ws("/", t, f"_{t}")).alias(t) for t in texts]
    return joined.select("sample", *differences, *changed)


def consecutive_differences(rows: DataFrame, order: list[str], value: str) -> DataFrame:
    """sample, mean absolute difference between consecutive runs of one app."""
    w = Window.partitionBy("sample").orderBy(*order)
    step = F.abs(F.col(value) - F.lag(value).over(w))
    return rows.select("sample", step.alias("_d")).groupBy("sample").agg(F.avg("_d").alias(value))


def sample_groups(samples: DataFrame, suffix: str = "MIDI", stripped: str = "WG") -> DataFrame:
    """main, secondary: X with XMIDI, or XWG with it; secondaries without a main are alone, as main."""
    mains = samples.filter(~F.col("sample").endswith(suffix))
    seconds = samples.filter(F.col("sample").endswith(suffix)).select(F.col("sample").alias("secondary"), F.regexp_replace("sample", f"{suffix}$", "").alias("_base"))
    exact = mains.select(F.col("sample").alias("main"), F.col("sample").alias("_key"))
    short = mains.filter(F.col("sample").endswith(stripped)).select(F.col("sample").alias("_short"), F.regexp_replace("sample", f"{stripped}$", "").alias("_skey"))
    owner = seconds.join(exact, F.col("_base") == F.col("_key"), "left").join(short, F.col("_base") == F.col("_skey"), "left")
    owned = owner.select("secondary", F.coalesce("main", "_short").alias("main"))
    found = mains.select(F.col("sample").alias("main")).join(owned.filter("main IS NOT NULL"), "main", "left").select("main", "secondary")
    return found.unionByName(owned.filter("main IS NULL").select(F.col("secondary").alias("main"), F.lit(None).cast("string").alias("secondary")))


def best_decisions(rows: DataFrame, targeted: Column) -> DataFrame:
    """The row of each (sample, region) with the best score; a targeted project replaces an equal score, the last one at that, else the first stays."""
    marked = rows.withColumn("_t", targeted.cast("int"))
    order = Window.partitionBy("sample", "region").orderBy(F.desc("score"), F.desc("_t"), F.when(F.col("_t") == 1, -F.col("ord")).otherwise(F.col("ord")))
    return marked.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", "_t")


def running_best(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows, by descending ord, whose score reaches the best so far and 1."""
    before = Window.partitionBy(*key).orderBy(F.desc("ord")).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_b", F.greatest(F.lit(1), F.coalesce(F.max("score").over(before), F.lit(1)))).filter("score >= _b").drop("_b")


def every_nth(rows: DataFrame, order: str, n: int) -> DataFrame:
    """Every n-th of distinct names, in order."""
    return numbered(rows.select(order).distinct(), [], [order], "_k").filter(F.col("_k") % n == 0).select(order)


def in_order(rows: DataFrame, column: str, listed: list[str]) -> DataFrame:
    """`rows` with place: that of the column's value in a list, values that aren't in it last."""
    place = F.array_position(F.array(*map(F.lit, listed)), F.col(column))
    return rows.withColumn("place", F.when(place > 0, place).otherwise(len(listed) + 1).cast("long")).orderBy("place", column)


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def reconcile(ours: DataFrame, theirs: DataFrame, key: str, value: str) -> DataFrame:
    """status (matching, changed, missing, unused), n over two sets of named sequences."""
    a, b = ours.select(key, F.col(value).alias("_a"), F.lit(1).alias("_ina")), theirs.select(key, F.col(value).alias("_b"), F.lit(1).alias("_inb"))
    status = F.when(F.col("_ina").isNull(), "unused").when(F.col("_inb").isNull(), "missing").when(F.col("_a") == F.col("_b"), "matching").otherwise("changed")
    return a.join(b, key, "full").groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def overridden(rows: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """`rows` with values replaced by overrides; an override of an unknown key is an error."""
    both = rows.join(overrides.select(key, F.col(value).alias("_new")), key, "full")
    unknown = both.withColumn(value, F.when(F.col(value).isNull(), F.raise_error(F.concat(F.lit("unknown: "), F.col(key).cast("string"))).cast(rows.schema[value].dataType)).otherwise(F.coalesce("_new", value)))
    return unknown.drop("_new")


def call_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """sample, before, after of final calls that changed, or whose X4 share moved by 2 points or can't be read."""
    a, b = (d.select("sample", F.col("final").alias(f"f{n}"), F.col("x4").alias(f"x{n}")) for n, d in ((1, before), (2, after)))
    moved = F.coalesce(F.abs(numeric("x1") - numeric("x2")) >= 2.0, F.col("x1").isNotNull() | F.col("x2").isNotNull())
    both = a.join(b, "sample", "full")
    return both.filter(~F.col("f1").eqNullSafe(F.col("f2")) | moved).select("sample", F.col("f1").alias("before"), F.col("f2").alias("after"))


def score_changes(before: DataFrame, after: DataFrame, counts: DataFrame) -> DataFrame:
    """key, before, after, kind: coverage scores that differ, 1 being none; kind tells whether the sample's read counts changed too."""
    key = ["sample", "project", "region"]
    a, b = (d.groupBy(*key).agg(F.max("score").alias("s")).select(*key, F.when(F.col("s") > 1, F.col("s")).alias(n)) for n, d in (("before", before), ("after", after)))
    differ = a.join(b, key, "full").filter(~F.col("before").eqNullSafe(F.col("after")))
    return differ.join(counts, "sample", "left").withColumn("kind", F.when(F.col("changed"), "counts").otherwise("plain")).drop("changed")


def consensus_change(first: Column, second: Column) -> Column:
    """Kind of a changed consensus: only deletions, extended (one holds the other), other; null for none."""
    plain = lambda s: F.replace(s, F.lit("-"), F.lit(""))
    return F.when(first == second, None).when(plain(first) == plain(second), "deletions").when(second.contains(first), "extended").otherwise("other")


def padded_distance(first: Column, second: Column) -> tuple[Column, Column]:
    """Edit distance of two sequences padded with dashes to one length, and its share in percent."""
    size = F.greatest(F.length(first), F.length(second))
    distance = edit_distance(F.rpad(first, size, F.lit("-")), F.rpad(second, size, F.lit("-")))
    return distance, F.when(size > 0, 100 * distance / size).otherwise(0.0)


def filled(rows: DataFrame, expected: DataFrame, key: list[str]) -> DataFrame:
    """`rows`, and a row of nulls for each expected key that they lack."""
    return rows.unionByName(expected.join(rows, key, "left_anti"), allowMissingColumns=True)


def properties_table(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row an app of `rows(app, key, value)`, with the listed keys as columns."""
    return rows.groupBy("app").pivot("key", keys).agg(F.first("value"))


def significant_changes(old: DataFrame, new: DataFrame, key: list[str], least: float = 0.05) -> DataFrame:
    """key, old_base, new_base of positions of `old` and `new(key, base, A, C, G, T, coverage)` whose consensus differs much.

    Either base may show it: a mixture always; a plain base if its share of the coverage moved by more than `least`, or if a
    coverage is 0. Too little coverage (x) and deletions don't, but x on one side does if one coverage is less than half the
    other. A position that is missing on one side has no base and no coverage there.
    """
    counts = ["A", "C", "G", "T", "coverage"]
    side = lambda d, n: d.select(*key, *(F.col(c).alias(f"{n}_{c}") for c in ["base", *counts]))
    both = side(old, "old").join(side(new, "new"), key, "full").fillna(0, [f"{n}_{c}" for n in ("old", "new") for c in counts]).fillna("", ["old_base", "new_base"])
    share = lambda n, b: sum((F.when(b == c, F.col(f"{n}_{c}")).otherwise(0) for c in "ACGT"), F.lit(0)) / F.col(f"{n}_coverage")
    bare = (F.col("old_coverage") == 0) | (F.col("new_coverage") == 0)
    moved = lambda b: F.when(b.isin("x", "-", ""), False).when(~b.isin(*"ACGT"), True).when(bare, True).otherwise(F.abs(share("old", b) - share("new", b)) > least)
    halved = (F.col("old_coverage") < F.col("new_coverage") / 2) | (F.col("new_coverage") < F.col("old_coverage") / 2)
    thin = ((F.col("old_base") == "x") | (F.col("new_base") == "x")) & halved
    differ = F.col("old_base") != F.col("new_base")
    return both.filter(differ & (moved(F.col("old_base")) | moved(F.col("new_base")) | thin)).select(*key, "old_base", "new_base")
