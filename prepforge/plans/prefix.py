"""P3: distributed running sums, ranks and exact quantiles, one way for every size.

``Window.orderBy`` with no ``partitionBy`` moves all rows to one task.  Running
sums and ranks here range-partition the rows by (group, order key), so a hot
group is spread over many tasks, write them once to the checkpoint folder
(range bounds are sampled, so the partition numbers must not be computed
twice), add the totals of the partitions before, and finish with a window per
partition.  The offset table has at most partitions + groups rows per group and
is joined null-safe, without a broadcast hint.

Exact quantiles bracket each wanted rank by a sketch (one scan), count what lies
below the bracket and keep only the values inside it (a second scan), and select
the rank among those.  Nothing is shuffled but sketches and bracket contents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PID = "__pid"
# Accuracy of the sketches: a rank is known to within n / ACCURACY.
ACCURACY = 10_000
# Rows of a table that may become a local relation (and so be broadcast).
MAX_LOCAL = 10_000
# Values inside a bracket that one window task is meant to see; wider brackets are
# narrowed by another sketch of their contents.
BRACKET_ROWS = 2_000_000


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as written once below the checkpoint folder."""
    from prepforge.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/prepforge-plans/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_written(df: DataFrame) -> None:
    """Delete the table behind a frame of :func:`written` that nothing reads any more; other frames are left alone."""
    files = df.inputFiles()
    if not files or "/prepforge-plans/" not in files[0]:
        return
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def _n_partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def null_safe_join(left: DataFrame, right: DataFrame, cols, how: str = "inner") -> DataFrame:
    """Join on ``cols`` where null equals null; the right key columns are dropped."""
    r = right.withColumnsRenamed({c: f"__r_{c}" for c in cols})
    if not cols:
        return left.crossJoin(r)  # ``right`` is one row
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"__r_{c}" for c in cols])


def _ranged(df: DataFrame, group_cols, order: list[Column], tag: str) -> DataFrame:
    """``df`` range-partitioned by (group, order), with its partition number, written."""
    return written(df.repartitionByRange(_n_partitions(df), *[F.col(c) for c in group_cols], *order)
                   .withColumn(PID, F.spark_partition_id()), tag)


def _offsets(work: DataFrame, group_cols, aggs: dict[str, Column]) -> DataFrame:
    totals = work.groupBy(*group_cols, PID).agg(*[v.alias(k) for k, v in aggs.items()])
    w = Window.partitionBy(*(group_cols or [F.lit(0)])).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*group_cols, PID, *[F.coalesce(F.sum(k).over(w), F.lit(0)).alias(f"__off_{k}") for k in aggs])


def running_sums(df: DataFrame, order_col: str, sum_cols, group_cols=(), descending: bool = False,
                 inclusive: bool = True, suffix: str = "_cum") -> DataFrame:
    """Add ``<c><suffix>`` = sum of ``c`` over rows ordered before (and at, if
    ``inclusive``) the current row within ``group_cols`` (null is a group).

    ``df`` should hold one row per (group, order value); ties share the RANGE
    frame and get the same running sum, which is what ranking needs."""
    g, sum_cols = list(group_cols), list(sum_cols)
    key = F.col(order_col).desc() if descending else F.col(order_col).asc()
    work = _ranged(df, g, [key], "sums")
    off = _offsets(work, g, {c: F.sum(c) for c in sum_cols})
    w = Window.partitionBy(*g, PID).orderBy(key).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = null_safe_join(work, off, g + [PID], "left")
    for c in sum_cols:
        s = F.coalesce(F.sum(c).over(w), F.lit(0))
        if not inclusive:
            s = s - F.col(c)
        out = out.withColumn(f"{c}{suffix}", s + F.col(f"__off_{c}"))
    return out.drop(PID, *[f"__off_{c}" for c in sum_cols])


def range_rank(df: DataFrame, order: list, group_cols=(), out: str = "rank") -> DataFrame:
    """0-based rank of each row in ``order`` (columns of any sortable type) within
    ``group_cols`` (null is a group)."""
    g = list(group_cols)
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    work = _ranged(df, g, keys, "rank")
    off = _offsets(work, g, {"n": F.count(F.lit(1))})
    w = Window.partitionBy(*g, PID).orderBy(*keys)
    return (null_safe_join(work, off, g + [PID], "left")
            .withColumn(out, (F.row_number().over(w) - 1 + F.col("__off_n")).cast("long"))
            .drop(PID, "__off_n"))


def hash_rank(df: DataFrame, hash_col: str, group_cols=(), tie_col: str | None = None,
              out: str = "rank") -> DataFrame:
    """0-based rank of rows by a hash, ties by ``tie_col``, within ``group_cols``."""
    return range_rank(df, [hash_col] + ([tie_col] if tie_col else []), group_cols, out)


def _local_if_small(df: DataFrame) -> DataFrame:
    """``df`` as a local relation if it has at most ``MAX_LOCAL`` rows (so that joins with it
    need no shuffle), else written to the checkpoint folder."""
    rows = df.limit(MAX_LOCAL + 1).collect()
    if len(rows) <= MAX_LOCAL:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if rows else df.limit(0)
    return written(df, "small")


def _select_ranks(rows: DataFrame, g: list[str], wanted: DataFrame, n_max: int) -> DataFrame:
    """The values at 0-based ranks ``__lo`` and ``__hi`` (at most one apart) of ``__x`` within
    ``g``, for each row of ``wanted`` (g..., __pi, __lo, __hi, __a, __b): [__a, __b] is a bracket
    of values that holds both.  Adds ``__vlo`` and ``__vhi``."""
    wanted = _local_if_small(wanted)
    size = n_max
    grid = [i / 1000 for i in range(1001)]
    while size * 4 / ACCURACY > BRACKET_ROWS:
        # narrow: the ranks' places among the bracket's own values, on a grid of their sketch
        j = null_safe_join(rows, wanted, g).where(F.col("__x") <= F.col("__b"))
        inside = F.when(F.col("__x") >= F.col("__a"), F.col("__x"))
        keys = [*g, "__pi", "__lo", "__hi", "__a", "__b"]
        s = j.groupBy(*keys).agg(F.count_if(F.col("__x") < F.col("__a")).alias("__below"), F.count(inside).alias("__in"),
                                 F.percentile_approx(inside, grid, ACCURACY).alias("__g"))
        place = lambda r: F.try_divide(F.col(r) - F.col("__below"), F.col("__in")) * 1000
        # steps of the grid that the sketch's error and two ranks may take
        slack = F.lit(2 + 2000 // ACCURACY) + F.ceil(F.try_divide(F.lit(2000), F.col("__in")))
        lo = F.element_at("__g", F.greatest(F.floor(place("__lo")) - slack, F.lit(0)).cast("int") + 1)
        hi = F.element_at("__g", F.least(F.ceil(place("__hi")) + slack, F.lit(1000)).cast("int") + 1)
        wanted = _local_if_small(s.select(*g, "__pi", "__lo", "__hi", lo.alias("__a"), hi.alias("__b")))
        size = size * 4 // 1000
    j = null_safe_join(rows, wanted, g).where(F.col("__x") <= F.col("__b"))
    # one row for all values below the bracket (null), one per distinct value inside it
    cell = F.when(F.col("__x") >= F.col("__a"), F.col("__x"))
    cells = j.groupBy(*g, "__pi", "__lo", "__hi", cell.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(*g, "__pi").orderBy(F.col("__v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("__e", F.sum("__c").over(w))
    at = lambda r: F.max(F.when((F.col(r) >= F.col("__e") - F.col("__c")) & (F.col(r) < F.col("__e")), F.col("__v")))
    return cells.groupBy(*g, "__pi").agg(at("__lo").alias("__vlo"), at("__hi").alias("__vhi"))


def _brackets(rows: DataFrame, g: list[str], probs) -> tuple[DataFrame, int]:
    """(one row per group and probability with the group's size ``__n`` and a bracket of
    its ranks, the largest group's size)."""
    d = 2.0 / ACCURACY
    lows, highs = [max(p - d, 0.0) for p in probs], [min(p + d, 1.0) for p in probs]
    x = F.col("__x")
    head = rows.groupBy(*g).agg(F.count(x).alias("__n"), F.min(x).alias("__min"), F.max(x).alias("__max"),
                                F.percentile_approx(x, lows, ACCURACY).alias("__as"),
                                F.percentile_approx(x, highs, ACCURACY).alias("__bs")).where("__n > 0")
    head = _local_if_small(head)
    n_max = head.agg(F.max("__n")).first()[0] or 0
    arr = F.array(*[F.struct(F.lit(i).alias("__pi"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    # a group no larger than the sketch is taken whole
    whole = F.col("__n") <= ACCURACY
    t = head.withColumn("__z", F.explode(arr)).select(
        *g, "__n", "__z.__pi", "__z.p",
        F.when(whole, F.col("__min")).otherwise(F.element_at("__as", F.col("__z.__pi") + 1)).alias("__a"),
        F.when(whole, F.col("__max")).otherwise(F.element_at("__bs", F.col("__z.__pi") + 1)).alias("__b"))
    return t, n_max


def exact_quantiles(long_df: DataFrame, value_col: str, probs, group_cols=()) -> DataFrame:
    """Exact quantiles with linear interpolation (position p * (n - 1)) per group; null is a
    group, null values don't count.  Returns rows (group..., p, q)."""
    out_g = list(group_cols)
    g = [f"__g{i}" for i in range(len(out_g))] or ["__g0"]
    keys = [F.col(c).alias(k) for c, k in zip(out_g, g)] or [F.lit(0).alias("__g0")]
    rows = long_df.where(F.col(value_col).isNotNull()).select(*keys, F.col(value_col).cast("double").alias("__x"))
    t, n_max = _brackets(rows, g, [float(p) for p in probs])
    if not n_max:
        return long_df.limit(0).select(*out_g, F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))
    t = t.withColumn("__h", F.col("p") * (F.col("__n") - 1))
    t = t.withColumn("__lo", F.floor("__h")).withColumn("__hi", F.ceil("__h"))
    got = _select_ranks(rows, g, t.select(*g, "__pi", "__lo", "__hi", "__a", "__b"), n_max)
    back = null_safe_join(got, t.select(*g, "__pi", "p", "__h"), g + ["__pi"])
    frac = F.col("__h") - F.floor("__h")
    q = F.when(frac == 0, F.col("__vlo")).otherwise(F.col("__vlo") + frac * (F.col("__vhi") - F.col("__vlo")))
    return back.select(*[F.col(k).alias(c) for k, c in zip(g, out_g)], "p", q.alias("q"))


def wide_quantiles(df: DataFrame, cols, probs, rank: int | None = None) -> dict[tuple[str, float], float | None]:
    """Exact quantiles (linear interpolation) of whole columns: {(column, p): value}, None without values.

    Two wide scans, nothing unpivoted: the first sketches all columns and brackets each wanted rank, the
    second counts what lies below the brackets and keeps the few values inside them, brackets being
    literals. A column no larger than the sketch is taken whole. Where a bracket would hold over
    ``BRACKET_ROWS`` values :func:`exact_quantiles` narrows it. ``rank`` asks for the value at that 0-based rank, of
    which the one probability is the share, instead of interpolating."""
    cols, probs = list(cols), [float(p) for p in probs]
    out: dict[tuple[str, float], float | None] = {}
    if len(cols) > 50:  # keeps generated code below the JVM's method limit
        for i in range(0, len(cols), 50):
            out.update(wide_quantiles(df, cols[i:i + 50], probs))
        return out
    if not cols or not probs:
        return out
    x = [F.col(c).cast("double") for c in cols]
    d = 2.0 / ACCURACY
    marks = [max(p - d, 0.0) for p in probs] + [min(p + d, 1.0) for p in probs]
    head = df.agg(*[e.alias(f"{n}{i}") for i, v in enumerate(x) for n, e in (
        ("n", F.count(v)), ("a", F.min(v)), ("b", F.max(v)), ("s", F.percentile_approx(v, marks, ACCURACY)))]).first()
    brackets: dict[tuple, int] = {}
    wanted = []  # column, p, bracket, lower rank, share of the upper
    for i, c in enumerate(cols):
        n = head[f"n{i}"]
        if n * 2 * d > BRACKET_ROWS:
            long = df.select(x[i].alias("__x"))
            out.update({(c, r["p"]): r["q"] for r in exact_quantiles(long, "__x", probs).collect()})
            continue
        for j, p in enumerate(probs):
            if not n:
                out[c, p] = None
                continue
            key = (i, head[f"a{i}"], head[f"b{i}"]) if n <= ACCURACY else (i, head[f"s{i}"][j], head[f"s{i}"][len(probs) + j])
            h = p * (n - 1) if rank is None else rank
            wanted.append((c, p, brackets.setdefault(key, len(brackets)), int(h), h - int(h)))
    if not wanted:
        return out
    below = dict.fromkeys(range(len(brackets)), 0)
    part = {k: (i, a) for (i, a, _), k in brackets.items() if head[f"n{i}"] > ACCURACY}
    if part:
        r = df.agg(*[F.count_if(x[i] < F.lit(a)).alias(f"k{k}") for k, (i, a) in part.items()]).first()
        below.update({k: r[f"k{k}"] for k in part})
    inside = F.array(*[F.when((x[i] >= F.lit(a)) & (x[i] <= F.lit(b)), F.struct(F.lit(k).alias("k"), x[i].alias("v")))
                       for (i, a, b), k in brackets.items()])
    cells = df.select(F.explode(F.array_compact(inside)).alias("z")).groupBy("z.k", "z.v").agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("e", F.sum("c").over(upto))
    ranks = list(dict.fromkeys((k, r) for _, _, k, lo, frac in wanted for r in ((lo, lo + 1) if frac else (lo,))))
    # one row for each rank that is asked for
    at = F.array(*[F.when((F.col("k") == k) & (F.col("e") - F.col("c") <= r - below[k]) & (F.col("e") > r - below[k]), F.lit(q))
                   for q, (k, r) in enumerate(ranks)])
    got = {ranks[r["q"]]: r["v"] for r in cells.select("v", F.explode(F.array_compact(at)).alias("q")).collect()}
    for c, p, k, lo, frac in wanted:
        v = got[k, lo]
        out[c, p] = v if not frac else v + frac * (got[k, lo + 1] - v)
    return out


def value_at_rank(df: DataFrame, value_col: str, rank: int) -> float | None:
    """The value at a 0-based ascending rank among the non-null values."""
    n = df.agg(F.count(value_col)).first()[0]
    if not 0 <= rank < n:
        return None
    if n * 4 / ACCURACY <= BRACKET_ROWS:
        p = rank / max(n - 1, 1)
        return wide_quantiles(df, [value_col], [p], rank)[value_col, p]
    rows = df.where(F.col(value_col).isNotNull()).select(F.lit(0).alias("__g0"), F.col(value_col).cast("double").alias("__x"))
    t, n_max = _brackets(rows, ["__g0"], [rank / max(n - 1, 1)])
    t = t.withColumn("__lo", F.lit(rank).cast("long")).withColumn("__hi", F.lit(rank).cast("long"))
    return _select_ranks(rows, ["__g0"], t.select("__g0", "__pi", "__lo", "__hi", "__a", "__b"), n_max).first()["__vlo"]


def top_n_exact(df: DataFrame, key_col: str, tie_cols, n: int) -> DataFrame:
    """The first ``n`` rows ordered by the numeric ``key_col`` descending (nulls last), then by
    ``tie_cols`` of any sortable type: the cut value, a filter above it, and a distributed rank
    of the rows that tie with it."""
    if n <= 0:
        return df.limit(0)
    known = df.agg(F.count(key_col), F.count(F.lit(1))).first()
    if n >= known[1]:
        return df
    key = F.col(key_col)
    if n >= known[0]:
        above, ties, need = df.where(key.isNotNull()), df.where(key.isNull()), n - known[0]
    else:
        v = value_at_rank(df, key_col, known[0] - n)
        above, ties = df.where(key > F.lit(v)), df.where(key == F.lit(v))
        need = n - above.count()
    ranked = range_rank(ties, list(tie_cols), out="__rk")
    return above.unionByName(ranked.where(F.col("__rk") < need).drop("__rk"))
