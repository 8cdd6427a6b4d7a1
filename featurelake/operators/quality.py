"""Data-quality profiles, numeric summaries and mean drift.

Profiles are one aggregate pass per table (partial + final aggregation), then a
narrow ``unpivot`` into tidy ``(dataset, column_name, stat, value)`` rows.
Quantiles are exact, by ranks in a sort by ranges (``values_at_ranks``) or by
distributed selection without a sort (``exact_quantiles``), rather than by collecting a column into one aggregation buffer.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.functions.columns import literal_frame, nan_to_null
from featurelake.operators.transform import numeric_columns
from featurelake.session import discard, written

_FIXED_WIDTH = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
                T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8}


def _null(c: str, dt) -> Column:
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def profile(df: DataFrame, dataset: str) -> DataFrame:
    """A1/A2/A4: row and column count, NULL (and NaN) count per column, logical size in bytes.

    Size = fixed width x rows for fixed-width types (decimals: 8 bytes up to 18 digits, else 16) + total UTF-8 bytes of
    strings, and of the JSON form of arrays, maps and structs.
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(_null(f.name, f.dataType)).alias(f"n::{f.name}") for f in fields]
    nested = (T.ArrayType, T.MapType, T.StructType)
    var = [F.coalesce(F.sum(F.octet_length(F.to_json(f.name) if isinstance(f.dataType, nested) else f.name)), F.lit(0)).alias(f"b::{f.name}")
           for f in fields if isinstance(f.dataType, (T.StringType, T.BinaryType, *nested))]
    one = df.agg(*aggs, *var)
    fixed = sum(w for f in fields for t, w in _FIXED_WIDTH.items() if isinstance(f.dataType, t))
    fixed += sum(8 if f.dataType.precision <= 18 else 16 for f in fields if isinstance(f.dataType, T.DecimalType))
    size = F.col("__rows") * F.lit(fixed)
    for f in fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType, *nested)):
            size = size + F.col(f"`b::{f.name}`")
    def stat(col_name: str, name: str, value: Column) -> Column:
        return F.struct(F.lit(col_name).alias("column_name"), F.lit(name).alias("stat"),
                        value.cast("double").alias("value"))

    stats = [stat("*", "row_count", F.col("__rows")), stat("*", "column_count", F.lit(len(fields))),
             stat("*", "memory_bytes", size)]
    stats += [stat(f.name, "null_count", F.col(f"`n::{f.name}`")) for f in fields]
    return one.select(F.explode(F.array(*stats)).alias("s")).select(
        F.lit(dataset).alias("dataset"), F.col("s.column_name").alias("column_name"),
        F.col("s.stat").alias("stat"), F.col("s.value").alias("value"))


def schema_rows(df: DataFrame, dataset: str) -> DataFrame:
    """A3: column types as rows, with each column's observed non-NULL count (one aggregate pass)."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = [F.struct(F.lit(dataset).alias("dataset"), F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(f.nullable).alias("nullable"),
                     F.col(f"c{i}").alias("non_null")) for i, f in enumerate(fields)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], window: int = 50000,
                    splits: int = 64, max_rounds: int | None = None,
                    moments: bool = False) -> dict[str, dict]:
    """Exact linear-interpolated quantiles (like ``quantile_cont``) by distributed selection.

    For every (column, target rank) a value bracket ``(lo, hi]`` with a known
    row count is narrowed round by round. A bracket with more than ``window``
    rows gets up to ``splits`` cut points from ``percentile_approx`` of its rows;
    one grouped count then tags every row with its bracket and sub-bracket
    (number of cuts below the value, or "equal to hi"), which picks the
    sub-bracket holding the rank. A bracket with at most ``window`` rows is
    grouped by value instead and the rank is resolved exactly. Each round is at
    most two jobs for all columns together; no job returns more than ``splits``
    counts or ``window`` (value, count) pairs per bracket, whatever the table
    size, so rounds ~ log_splits(n / window). The projected columns are
    persisted once, so rounds re-read executor storage rather than the source.
    Every round either shrinks a bracket or resolves it; the loop ends when all
    ranks are resolved. ``max_rounds`` is a guard: reached before that, it raises.
    With ``moments=True`` the first pass also returns count, mean, sample std,
    min and max per column under the keys "count", "mean", "std", "min", "max".
    """
    from pyspark import StorageLevel

    names = [f"v{i}" for i in range(len(cols))]
    vals = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(n)
                       for c, n in zip(cols, names)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        qs_sql = ", ".join(repr(j / splits) for j in range(1, splits))
        # the first bracket of every column is its whole range: its cut points ride on the first pass
        first = [F.count(n).alias(n) for n in names]
        first += [F.expr(f"percentile_approx({n}, array({qs_sql}), {10 * splits})").alias(f"{n}_cuts") for n in names]
        if moments:
            first += [e for n in names for e in (F.avg(n).alias(f"{n}_mean"), F.stddev_samp(n).alias(f"{n}_std"),
                                                 F.min(n).alias(f"{n}_min"), F.max(n).alias(f"{n}_max"))]
        ns = vals.agg(*first).first()
        targets = {(i, r) for i, n in enumerate(names) if ns[n] > 0
                   for p in probs for r in (math.floor(p * (ns[n] - 1)), math.ceil(p * (ns[n] - 1)))}
        # bracket = (column, lo, hi, rows below lo, rows in (lo, hi]); None = unbounded
        state = {t: (t[0], None, None, 0, ns[names[t[0]]]) for t in targets}
        found: dict[tuple[int, int], float] = {}

        # Expressions are built as SQL text: one gateway call per expression,
        # however many brackets and cut points it carries.
        def lit(x: float) -> str:
            return f"CAST('{x!r}' AS DOUBLE)"  # quoted: inf and -inf have no literal of their own

        def bucket_of(v: str, cs: list[float], lo: int, hi: int) -> str:
            """Number of cut points below v, as a balanced CASE tree (log2 comparisons, codegen-friendly)."""
            if lo == hi:
                return str(lo)
            mid = (lo + hi) // 2
            return (f"CASE WHEN {v} <= {lit(cs[mid])} THEN {bucket_of(v, cs, lo, mid)} "
                    f"ELSE {bucket_of(v, cs, mid + 1, hi)} END")

        def inside(i, lo, hi) -> str:
            c = f"{names[i]} IS NOT NULL"
            if lo is not None:
                c += f" AND {names[i]} > {lit(lo)}"
            if hi is not None:
                c += f" AND {names[i]} <= {lit(hi)}"
            return c

        done = 0
        while todo := sorted({state[t] for t in targets if t not in found}, key=str):
            if max_rounds is not None and done >= max_rounds:
                raise RuntimeError(f"{len(todo)} brackets are unresolved after max_rounds={max_rounds} rounds")
            done += 1
            large = [b for b in todo if b[4] > window]
            cuts: dict[int, list[float]] = {}
            for b in [b for b in large if b[1] is None and b[2] is None]:  # whole column: cuts known
                cuts[todo.index(b)] = sorted({x for x in (ns[f"{names[b[0]]}_cuts"] or []) if x is not None})
            large = [b for b in large if not (b[1] is None and b[2] is None)]
            if large:
                qs = ", ".join(repr(j / splits) for j in range(1, splits))
                row = vals.agg(*[F.expr(f"percentile_approx(CASE WHEN {inside(i, lo, hi)} THEN {names[i]} END, "
                                        f"array({qs}), {10 * splits})").alias(f"q{k}")
                                 for k, (i, lo, hi, _, _) in enumerate(large)],
                               *[F.expr(f"min(CASE WHEN {inside(i, lo, hi)} THEN {names[i]} END)").alias(f"m{k}")
                                 for k, (i, lo, hi, _, _) in enumerate(large)]).first()
                for k, (i, lo, hi, _, _) in enumerate(large):
                    cs = sorted({x for x in (row[f"q{k}"] or []) if x is not None
                                 and (lo is None or x > lo) and (hi is None or x < hi)})
                    least = row[f"m{k}"]
                    if not cs and least is not None and (hi is None or least < hi):
                        # the sketch offers no interior cut: part the bracket between its least value and its end
                        mid = (least + hi) / 2 if hi is not None else least
                        cs = [mid if least < mid and (hi is None or mid < hi) else least]
                    cuts[todo.index(large[k])] = cs
            recs = []
            for k, (i, lo, hi, _, _) in enumerate(todo):
                v = names[i]
                if k in cuts:
                    bucket = f"CAST({bucket_of(v, cuts[k], 0, len(cuts[k]))} AS DOUBLE)"
                    key = f"CASE WHEN {v} = {lit(hi)} THEN -1.0D ELSE {bucket} END" if hi is not None else bucket
                else:
                    key = v
                recs.append(f"CASE WHEN {inside(i, lo, hi)} THEN named_struct('b', {k}, 'key', {key}) END")
            tagged = F.expr(f"filter(array({', '.join(recs)}), x -> x IS NOT NULL)")
            got = (vals.select(F.explode(tagged).alias("r"))
                   .groupBy("r.b", "r.key").agg(F.count(F.lit(1)).alias("c")).toPandas())
            per: dict[int, list[tuple[float, int]]] = {}
            for b_, key_, c_ in zip(got["b"].tolist(), got["key"].tolist(), got["c"].tolist()):
                per.setdefault(int(b_), []).append((float(key_), int(c_)))
            for k, b in enumerate(todo):
                i, lo, hi, below, n_in = b
                mine = [t for t in targets if t not in found and state[t] == b]
                pairs = sorted(per.get(k, []))
                if k not in cuts:  # exact: walk the (value, count) pairs
                    for t in mine:
                        cum = below
                        for val, c in pairs:
                            if cum <= t[1] < cum + c:
                                found[t] = val
                                break
                            cum += c
                    continue
                eq_hi = sum(c for key, c in pairs if key == -1.0)
                buckets = dict((int(key), c) for key, c in pairs if key != -1.0)
                edges = [lo] + cuts[k] + [hi]
                for t in mine:
                    cum = below
                    for j in range(len(edges) - 1):
                        c = buckets.get(j, 0)
                        if j == len(edges) - 2:
                            if t[1] >= cum + c and hi is not None:
                                found[t] = hi  # the rank falls on rows equal to hi
                            else:
                                state[t] = (i, edges[j], edges[j + 1], cum, c + eq_hi)
                            break
                        if cum + c > t[1]:
                            state[t] = (i, edges[j], edges[j + 1], cum, c)
                            break
                        cum += c
        out: dict[str, dict] = {}
        for i, c in enumerate(cols):
            out[c] = {}
            if moments:
                n = names[i]
                out[c].update({"count": ns[n], "mean": ns[f"{n}_mean"], "std": ns[f"{n}_std"],
                               "min": ns[f"{n}_min"], "max": ns[f"{n}_max"]})
            for p in probs:
                if ns[names[i]] == 0:
                    out[c][p] = None
                    continue
                pos = p * (ns[names[i]] - 1)
                a, b = found.get((i, math.floor(pos))), found.get((i, math.ceil(pos)))
                out[c][p] = a if a == b else a + (b - a) * (pos - math.floor(pos))
        return out
    finally:
        vals.unpersist()


def values_at_ranks(df: DataFrame, cols: list[str], ranks: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """The values at the given ranks (0 is the least; NULL and NaN are left out) of each column, all columns in one sort.

    1. (column, value) pairs are counted (a partial aggregate, so a value that fills a third of a column is one row), dealt out by
       ranges of (column, value), sorted, and written with the number of their range: nothing is left to one task, however many
       rows or columns there are;
    2. each range's count per column is summed over the ranges before it (a table of ranges plus columns, not of rows), which tells the
       range and the place in it of every asked rank;
    3. only these ranges are read again, and a running count inside each finds the value.

    The driver gets a place and a value per asked rank, nothing else. Ranks outside a column have no entry.
    """
    spark = df.sparkSession
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("col"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(cols)])).alias("p"))
    counted = pairs.select("p.col", "p.v").filter("v IS NOT NULL AND NOT isnan(v)").groupBy("col", "v").agg(F.count(F.lit(1)).alias("n"))
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table, path = written(counted.repartitionByRange(ranges, "col", "v").sortWithinPartitions("col", "v").withColumn("part", F.spark_partition_id()), "ranks")
    try:
        before = Window.partitionBy("col").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        held = table.groupBy("part", "col").agg(F.sum("n").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        asked = spark.createDataFrame([(i, int(r)) for i, c in enumerate(cols) for r in sorted(set(ranks.get(c, [])))], "col int, rank bigint")
        places = held.join(F.broadcast(asked), "col").filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        found = [(r["part"], r["col"], r["rank"], r["before"]) for r in places.select("part", "col", "rank", "before").collect()]
        if not found:
            return {}
        wanted = spark.createDataFrame(found, "part int, col int, rank bigint, before bigint")
        within = Window.partitionBy("part", "col").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = table.filter(F.col("part").isin(sorted({f[0] for f in found}))).withColumn("upto", F.sum("n").over(within))
        hits = running.join(F.broadcast(wanted), ["part", "col"]).filter(
            (F.col("before") + F.col("upto") > F.col("rank")) & (F.col("before") + F.col("upto") - F.col("n") <= F.col("rank")))
        return {(cols[r["col"]], r["rank"]): r["v"] for r in hits.select("col", "rank", "v").collect()}
    finally:
        discard(spark, path)


def sorted_quantiles(df: DataFrame, cols: list[str], probs: list[float], counts: dict[str, int]) -> dict[str, dict[float, float | None]]:
    """Exact quantiles with linear interpolation between neighbouring ranks, by ``values_at_ranks``; None for a column without values."""
    at = {c: [p * (counts[c] - 1) for p in probs] for c in cols if counts[c]}
    value = values_at_ranks(df, cols, {c: [r for x in xs for r in (math.floor(x), math.ceil(x))] for c, xs in at.items()})

    def between(c: str, x: float) -> float:
        a, b = value[c, math.floor(x)], value[c, math.ceil(x)]
        return a if a == b else a + (b - a) * (x - math.floor(x))

    return {c: {p: between(c, at[c][k]) if c in at else None for k, p in enumerate(probs)} for c in cols}


def describe(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """A5: count, mean, std (n-1), min, 25/50/75 %, max per numeric column, one row per column.

    Exact (default): one aggregate for the moments, then ``sorted_quantiles``; the summary
    (a handful of numbers per column) is returned as a small DataFrame.
    ``exact=False`` is one lazy aggregate with ``percentile_approx``.
    """
    cols = cols or numeric_columns(df)
    schema = ("column_name string, count bigint, mean double, std double, min double, p25 double, p50 double, "
              "p75 double, max double")
    if exact:
        clean = df.select(*[nan_to_null(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
        m = clean.agg(*[f(f"v{i}").alias(f"{n}{i}") for i in range(len(cols)) for n, f in
                        (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]).first()
        q = sorted_quantiles(df, cols, [0.25, 0.5, 0.75], {c: m[f"count{i}"] for i, c in enumerate(cols)})
        rows = [(c, m[f"count{i}"], m[f"mean{i}"], m[f"std{i}"], m[f"min{i}"], q[c][0.25], q[c][0.5], q[c][0.75], m[f"max{i}"])
                for i, c in enumerate(cols)]
        return literal_frame(df.sparkSession, rows, schema)
    clean = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in cols])
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}::count"), F.avg(c).alias(f"{c}::mean"), F.stddev_samp(c).alias(f"{c}::std"),
                 F.min(c).alias(f"{c}::min"), F.max(c).alias(f"{c}::max"),
                 F.percentile_approx(c, [0.25, 0.5, 0.75], 100000).alias(f"{c}::q")]
    mom = clean.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}::count`").alias("count"),
                     F.col(f"`{c}::mean`").alias("mean"), F.col(f"`{c}::std`").alias("std"),
                     F.col(f"`{c}::min`").alias("min"), F.col(f"`{c}::q`")[0].alias("p25"),
                     F.col(f"`{c}::q`")[1].alias("p50"), F.col(f"`{c}::q`")[2].alias("p75"),
                     F.col(f"`{c}::max`").alias("max")) for c in cols]
    return mom.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def mean_drift(df: DataFrame, period_col: str, reference: str = "reference", current: str = "current",
               cols: list[str] | None = None, threshold_pct: float = 10.0) -> DataFrame:
    """Per-column mean shift between two periods of one table, in one pass.

    drift % = |(cur - ref) / ref| * 100, 0 when ref = 0; flagged when > threshold. NULL and NaN values are left out of
    the means; a period without any value has a NULL mean, and no drift is flagged.
    Both means come from a single conditional aggregate (no self-join). The
    result also carries the number of drifted columns.
    """
    cols = cols or numeric_columns(df, exclude=(period_col,))
    p = F.col(period_col)
    aggs = []
    for c in cols:
        aggs += [F.avg(F.when(p == reference, nan_to_null(c))).alias(f"{c}::ref"),
                 F.avg(F.when(p == current, nan_to_null(c))).alias(f"{c}::cur")]
    one = df.agg(*aggs)

    def pct(c: str) -> Column:
        ref, cur = F.col(f"`{c}::ref`"), F.col(f"`{c}::cur`")
        return F.when(ref != 0, F.abs((cur - ref) / ref) * 100).when(ref == 0, F.lit(0.0))

    # the count of drifted columns is computed on the same single aggregate row
    n_drift = sum((F.coalesce((pct(c) > threshold_pct).cast("int"), F.lit(0)) for c in cols), F.lit(0))
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}::ref`").alias("reference_mean"),
                     F.col(f"`{c}::cur`").alias("current_mean"), pct(c).alias("drift_percentage"),
                     F.coalesce(pct(c) > threshold_pct, F.lit(False)).alias("drift_detected")) for c in cols]
    return one.select(F.explode(F.array(*rows)).alias("r"), n_drift.cast("bigint").alias("drifted_features")) \
        .select("r.*", "drifted_features")


def report_rows(report: DataFrame, validated_at, ttl_seconds: int = 3600) -> DataFrame:
    """Stamp report rows with their validation time and expiry (retention of 3600 s)."""
    at = F.lit(validated_at).cast("timestamp_ntz")
    return report.select("*", at.alias("validated_at"),
                         (at + F.make_interval(secs=F.lit(ttl_seconds))).alias("expires_at"))


def live_reports(reports: DataFrame, now) -> DataFrame:
    """Reports that are still within their retention at ``now``."""
    return reports.filter(F.col("expires_at") > F.lit(now).cast("timestamp_ntz"))
