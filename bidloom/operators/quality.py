"""Data checks. Reports are long tables (section, name, value) unless a check needs more columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bidloom import fixed_values as fv
from bidloom.functions.scalars import band
from bidloom.session import materialize
from bidloom.sources.files import file_inventory

METRIC_SCHEMA = "section string, name string, value bigint"


def long_metrics(wide: DataFrame, section: str) -> DataFrame:
    """One row per column of a one-row table."""
    pairs = [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("bigint").alias("value")) for c in wide.columns]
    return wide.select(F.explode(F.array(*pairs)).alias("m")).select(F.lit(section).alias("section"), "m.*")


def row_counts(tables: Mapping[str, DataFrame], section: str = "counts") -> DataFrame:
    """Rows of every table, counted in one job."""
    counted = [df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(section).alias("section"),
               F.lit(name).alias("name"), "value") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def distinct_rows(c: str) -> Column:
    """Distinct values, counting null as one value, as distinct().count() does."""
    has_null = F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))
    return F.count_distinct(c) + has_null


def key_overlap(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], name: str, section: str = "overlap"
) -> DataFrame:
    """Distinct complete keys present on both sides.

    Both sides are tagged and reduced in one aggregation, so a key with most of the rows costs a row per task and
    no join is needed.
    """
    def side(df: DataFrame, columns: list[str], is_left: bool) -> DataFrame:
        keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(columns)]
        tags = [F.lit(is_left).alias("_l"), F.lit(not is_left).alias("_r")]
        return df.dropna(subset=columns).select(*keys, *tags)

    tagged = side(left, [a for a, _ in pairs], True).unionByName(side(right, [b for _, b in pairs], False))
    keys = [f"k{i}" for i in range(len(pairs))]
    seen = tagged.groupBy(*keys).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return seen.agg(F.count_if(F.col("_l") & F.col("_r")).alias("value")).select(
        F.lit(section).alias("section"), F.lit(name).alias("name"), "value"
    )


def key_overlaps(
    left: DataFrame, checks: Sequence[tuple[str, DataFrame, Sequence[tuple[str, str]]]], section: str = "overlap"
) -> DataFrame:
    """Several overlap checks of one table (name, right table, key pairs), one aggregation for each key set.

    Every key set is read and reduced by itself, so scans, shuffles and the tasks' tables of distinct keys hold its
    columns only. Each key collects one bit per table that has it.
    """
    key_sets = sorted({tuple(a for a, _ in pairs) for _, _, pairs in checks})

    def side(df: DataFrame, given: dict[str, str], keys: tuple[str, ...], bit: int) -> DataFrame:
        values = [F.col(given[c]).cast(left.schema[c].dataType).alias(c) for c in keys]
        return df.dropna(subset=list(given.values())).select(*values, F.lit(1 << bit).cast("bigint").alias("_seen"))

    def counted(keys: tuple[str, ...]) -> DataFrame:
        own = [(bit, name, right, dict(pairs)) for bit, (name, right, pairs) in enumerate(checks, start=1)
               if tuple(a for a, _ in pairs) == keys]
        sides = [side(left, {c: c for c in keys}, keys, 0), *[side(right, given, keys, bit) for bit, _, right, given in own]]
        seen = reduce(DataFrame.unionByName, sides).groupBy(*keys).agg(F.bit_or("_seen").alias("_seen"))
        return seen.agg(*[
            F.count_if((F.col("_seen").bitwiseAND(F.lit(1)) != 0) & (F.col("_seen").bitwiseAND(F.lit(1 << bit)) != 0))
            .alias(name) for bit, name, _, _ in own])

    # One row for each key set.
    wide = reduce(DataFrame.crossJoin, [counted(keys) for keys in key_sets])
    return long_metrics(wide.select(*[f"`{name}`" for name, _, _ in checks]), section)


# Entries of an overlap sketch, as a power of two.
SKETCH_LG = 14


def overlap_estimates(
    left: DataFrame, checks: Sequence[tuple[str, DataFrame, Sequence[tuple[str, str]]]], lg: int = SKETCH_LG
) -> DataFrame:
    """name, estimate, error: the checks of `key_overlaps` from theta sketches, one scan of each table, no key shuffled.

    `error` is five standard errors, of the keys of both sides together over the root of the sketch's entries.
    """
    key_sets = sorted({tuple(a for a, _ in pairs) for _, _, pairs in checks})

    def sketch(df: DataFrame, keys: Sequence[str]) -> Column:
        typed = [F.col(k).cast(left.schema[a].dataType) if df is not left else F.col(k) for a, k in zip(of, keys)]
        complete = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        return F.theta_sketch_agg(F.when(complete, F.xxhash64(*typed)), lg)

    own = []
    for i, of in enumerate(key_sets):
        own.append(sketch(left, of).alias(f"_own{i}"))
    row, parts = left.agg(*own), []
    for name, right, pairs in checks:
        of = tuple(a for a, _ in pairs)
        mine, other = F.col(f"_own{key_sets.index(of)}"), right.agg(sketch(right, [b for _, b in pairs])).scalar()
        both, every = F.theta_intersection(mine, other), F.theta_union(mine, other, lg)
        parts.append(F.struct(F.lit(name).alias("name"), F.theta_sketch_estimate(both).alias("estimate"),
                              (F.theta_sketch_estimate(every) * (5.0 / 2 ** (lg / 2))).alias("error")))
    return row.select(F.inline(F.array(*parts)))


def top_per_group(counted: DataFrame, group: str, rows: str, tie: str, n: int) -> DataFrame:
    """The n largest rows of every group; Spark keeps only n per group and task before the shuffle."""
    order = Window.partitionBy(group).orderBy(F.desc(rows), tie)
    return counted.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n).drop("_rank")


def top_keys(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The n most frequent keys; ties by key, so the list is repeatable."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), *keys).limit(n)


def hot_keys(df: DataFrame, key: str, n: int, default: object | None = None) -> DataFrame:
    """The n largest key groups (null included) with their share of all rows and whether they are a filler value."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    filler = F.col(key).isNull() if default is None else (F.col(key).isNull() | (F.col(key) == F.lit(default)))
    return groups.orderBy(F.desc("rows"), key).limit(n).select(
        key, "rows", (F.col("rows").cast("double") / total).alias("share"), filler.alias("is_null_or_default")
    )


def late_feedback(same_hour: DataFrame, late_hour: DataFrame, kind: str) -> DataFrame:
    """Rows of each hour that carry the feedback type expected there."""
    both = same_hour.select(kind, F.lit(False).alias("_late")).unionByName(
        late_hour.select(kind, F.lit(True).alias("_late"))
    )
    counted = both.agg(
        F.count_if(~F.col("_late") & (F.col(kind) == "same_hour")).alias("same_hour_rows"),
        F.count_if(F.col("_late") & (F.col(kind) == "late_n_plus_1")).alias("late_n_plus_1_rows"),
    )
    return long_metrics(counted, "late_feedback")


def match_rates(joined: DataFrame, probes: Mapping[str, str], weight: Column | None = None) -> DataFrame:
    """Rows with a match per join and their share, in one pass; `probes` names a never-null right column per join."""
    w = F.lit(1).cast("bigint") if weight is None else weight
    zero = F.lit(0).cast("bigint")
    matched = [F.sum(F.when(F.col(c).isNotNull(), w).otherwise(zero)).alias(name) for name, c in probes.items()]
    wide = joined.agg(F.sum(w).alias("_rows"), *matched)
    rows = [
        F.struct(F.lit(n).alias("name"), F.col("_rows").alias("rows"), F.col(n).alias("matched")) for n in probes
    ]
    return wide.select(F.explode(F.array(*rows)).alias("m")).select("m.*").withColumn(
        "match_rate", F.col("matched").cast("double") / F.col("rows").cast("double")
    )


def branch_conservation(joined: DataFrame, is_high: str, weight: Column | None = None) -> DataFrame:
    """Joined rows, both branches, and the rows that fall in neither because the test is null."""
    w = F.lit(1).cast("bigint") if weight is None else weight
    zero = F.lit(0).cast("bigint")
    test = F.col(is_high)

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, w).otherwise(zero))

    wide = joined.agg(
        F.sum(w).alias("joined"),
        rows_where(test).alias("high"),
        rows_where(~test).alias("low"),
        rows_where(test.isNull()).alias("unclassified"),
    )
    return wide.withColumn("missing", F.col("joined") - F.col("high") - F.col("low") - F.col("unclassified"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls per column, in one pass."""
    names = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("rows"), F.col(c).alias("nulls"))
            for c in names]
    return wide.select(F.explode(F.array(*rows)).alias("m")).select("m.*").withColumn(
        "null_rate", F.col("nulls").cast("double") / F.nullif(F.col("rows").cast("double"), F.lit(0.0))
    )


def hour_completeness(df: DataFrame, ts: str, expected_hours: int = 24) -> DataFrame:
    """Per day, how many hours have data and whether the day is ready to be processed."""
    hours = df.select(F.to_date(ts).alias("day"), F.hour(ts).alias("hour")).groupBy("day").agg(
        F.count_distinct("hour").alias("hours"), F.count(F.lit(1)).alias("rows")
    )
    return hours.withColumn("ready_to_process", F.col("hours") == expected_hours)


def join_key_profile(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, distinct keys and null keys of each table's join key.

    Distinct keys are counted over one row per key, so the null group and hot keys are reduced before the shuffle.
    """
    def one(name: str, df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        return per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
            F.count(key).alias("distinct_keys"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("null_keys"),
        ).select(F.lit(name).alias("table_name"), F.lit(key).alias("join_key"), "*")

    return reduce(DataFrame.unionByName, [one(n, df, key) for n, (df, key) in tables.items()])


def join_key_files(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """The join-key profile of file-backed tables, with the files and bytes behind each."""
    stored = [file_inventory(df).select(F.lit(name).alias("table_name"), "files", "bytes") for name, (df, _) in tables.items()]
    return join_key_profile(tables).join(reduce(DataFrame.unionByName, stored), "table_name")


def join_inventory(profile: DataFrame, joins: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Both sides of every named join and the smaller one. `profile` has one row per table, `joins` a few names."""
    spark = profile.sparkSession
    wanted = spark.createDataFrame(list(joins), "join_name string, left_table string, right_table string")
    left = profile.select(F.col("table_name").alias("left_table"), F.col("rows").alias("left_rows"),
                          F.col("distinct_keys").alias("left_keys"))
    right = profile.select(F.col("table_name").alias("right_table"), F.col("rows").alias("right_rows"),
                           F.col("distinct_keys").alias("right_keys"))
    both = wanted.join(left, "left_table").join(right, "right_table")
    smaller = F.when(F.col("left_rows") < F.col("right_rows"), F.col("left_table")).otherwise(F.col("right_table"))
    return both.withColumn("smaller_side", smaller)


def compare_runs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two metric tables side by side with change and percent; a metric missing in one run stays null there."""
    old = before.select("section", "name", F.col("value").alias("before"))
    new = after.select("section", "name", F.col("value").alias("after"))
    both = old.join(new, ["section", "name"], "full")
    change = F.col("after") - F.col("before")
    percent = change.cast("double") * F.lit(100.0) / F.nullif(F.col("before").cast("double"), F.lit(0.0))
    return both.withColumns({"change": change, "percent": percent})


def run_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that one run has more often than the other: side and surplus copies. One shuffle, empty when equal."""
    signed = before.withColumn("_sign", F.lit(-1)).unionByName(after.withColumn("_sign", F.lit(1)))
    net = signed.groupBy(*before.columns).agg(F.sum("_sign").alias("_net")).filter("_net <> 0")
    side = F.when(F.col("_net") > 0, F.lit("only_after")).otherwise(F.lit("only_before"))
    return net.select(*before.columns, side.alias("side"), F.abs("_net").alias("copies"))


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """The row count of a table; evaluating it fails when the table is empty."""
    count = F.count(F.lit(1))
    return df.agg(count.alias("rows")).select(
        F.lit(name).alias("name"),
        F.when(F.col("rows") > 0, F.col("rows")).otherwise(
            F.raise_error(F.lit(f"{name} is empty")).cast("bigint")
        ).alias("rows"),
    )


class AuditError(ValueError):
    """A job's output that must not be published."""


def audit(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """name, rows, duplicate_keys, null_keys of a table that should have one row per key; null equals null."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    unnamed = reduce(Column.__and__, [F.col(k).isNull() for k in keys])
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        F.count_if(unnamed).alias("null_keys"),
    ).select(F.lit(name).alias("name"), "rows", "duplicate_keys", "null_keys")


def audited(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """`df`, written to the work folder and checked there: raises AuditError if it has no rows or a key twice.

    Publish what this returns: a job that fails its audit then leaves its target as it was.
    """
    return checked(materialize(df, name, "zstd"), name, keys)


def checked(staged: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """A table that is written already, checked as `audited` does."""
    audit_passed(audit(staged, name, keys))
    return staged


def audit_passed(report: DataFrame) -> None:
    """Raises AuditError if the table that `audit` reports on has no rows or a key twice."""
    found = report.first()
    if not found["rows"]:
        raise AuditError(f"{found['name']} is empty")
    if found["duplicate_keys"]:
        raise AuditError(f"{found['name']} has {found['duplicate_keys']} keys more than once")


def audit_report(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """What `audited` checks, as a table: the output is staged, audited once, and its report written."""
    report = materialize(audit(materialize(df, name, "zstd"), name, keys), f"{name}_audit")
    audit_passed(report)
    return report


# --- task diagnosis over a table of task metrics ----------------------------

def _duration_histogram(tasks: DataFrame, stage: str, millis: str) -> DataFrame:
    """One row per stage and whole millisecond: bounded by the longest task, however many tasks there are."""
    return tasks.groupBy(F.col(stage).alias("stage"), F.col(millis).alias("_ms")).agg(
        F.count(F.lit(1)).alias("_n")
    )


def _stage_times(tasks: DataFrame, stage: str, millis: str) -> DataFrame:
    median = F.percentile(F.col("_ms").cast("double"), F.lit(0.5), F.col("_n"))
    return _duration_histogram(tasks, stage, millis).groupBy("stage").agg(
        F.sum("_n").alias("tasks"), median.alias("median_ms"), F.max("_ms").alias("max_ms")
    )


def task_skew(tasks: DataFrame, stage: str, millis: str) -> DataFrame:
    """Slowest over median task per stage, classed ok / watch / likely."""
    ratio = F.col("max_ms").cast("double") / F.nullif(F.col("median_ms"), F.lit(0.0))
    return _stage_times(tasks, stage, millis).withColumn("ratio", ratio).withColumn(
        "skew_class", band("ratio", fv.SKEW_RATIO_CLASSES, fv.DIAGNOSIS_OK)
    )


def gc_pressure(tasks: DataFrame, stage: str, millis: str, gc_millis: str) -> DataFrame:
    """Share of run time spent in garbage collection per stage, classed ok / watch / pressure / severe."""
    totals = tasks.groupBy(F.col(stage).alias("stage")).agg(
        F.sum(millis).alias("run_ms"), F.sum(gc_millis).alias("gc_ms")
    )
    share = F.col("gc_ms").cast("double") / F.nullif(F.col("run_ms").cast("double"), F.lit(0.0))
    return totals.withColumn("gc_share", share).withColumn(
        "gc_class", band("gc_share", fv.GC_SHARE_CLASSES, fv.DIAGNOSIS_OK)
    )


def task_waves(tasks: DataFrame, stage: str, millis: str, slots: int) -> DataFrame:
    """How often the slots are refilled, and the stage time that many median tasks would take."""
    waves = F.ceil(F.col("tasks").cast("double") / F.lit(float(slots)))
    return _stage_times(tasks, stage, millis).select(
        "stage", "tasks", "median_ms", waves.alias("waves"), (waves * F.col("median_ms")).alias("expected_ms")
    )
