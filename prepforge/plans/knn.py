"""P4: exact nearest-neighbour and range joins over any number of columns, by a pivot index.

Locations go to the block of their nearest pivot. A block's pivots come from a bounded sample of it,
three in four farthest first (one in each cluster before any cluster gets a second), one at random;
blocks that stay too large are cut again by pivots of their own. A block knows its pivot and the least
and largest distance to it, so by the triangle inequality a query at distance d from the pivot is
no nearer to any of its locations than ``d - largest``, ``least - d`` and (pivots of one set share
out the space) ``(d - d') / 2`` for the distance d' to any other pivot of the set.

A search starts in the query's own block, which bounds the distance of its k-th neighbour (or, for a count
within a distance, mostly ends there). Queries of near blocks then form groups, each held by one task: it gets the
pivots of all blocks, says which of them may come near enough to one of its queries, and gets the rows of
those, nearest block first; what it finds tightens the distance, and most blocks that follow are
compared with few of its queries. The answer is exact. A row is sent to a group, never to each of its
queries, and no visits or pairs are written: what is shuffled is the rows times the groups that need them.

The search in the own block and the way to it are one primitive, :func:`_meet`: rows keyed by a block meet that
block's locations or pivots, of which there is a bounded number, in one task; a block that many rows
come to is salted, its own side copied to each salt. :func:`_grouped` is that of the groups. No cross join and
nothing data-sized on the driver. On data without structure in many columns no exact index prunes much: all rows go to
all groups and the comparisons are quadratic; on clustered data the pairs a query stay flat as rows grow
(``pairs`` of :class:`PivotIndex`).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepforge.plans.prefix import null_safe_join, written

#: Locations a block is meant to hold; it is cut again above ``AGAIN`` times that. Most pivots of a set
#: and locations they are picked from. Rows of a block that one task takes.
LEAF, AGAIN, MAX_PIVOTS, SAMPLE, SALT = 32, 4, 1024, 8192, 50_000
#: Where a location is on average farther from its pivot than ``LOOSE`` times the distance of any two, blocks
#: do not prune, and larger ones (``COARSE`` times) cost less to meet.
LOOSE, COARSE = 0.5, 8
#: Queries that a group holds at most, neighbours that its task holds for them, groups a core and least queries of one.
GROUP, HELD, PER_CORE, FEW = 65_536, 1_500_000, 3, 256
#: Rows of a batch that a task says, numbers in a product of matrices (kept in a core's cache).
ROWS_OUT, CACHED = 100_000, 1 << 18
#: Bounds are loosened by this share against rounding.
SLACK = 1e-9
#: Numbers in a matrix of distances.
CELLS = 1 << 21


def distances(q: np.ndarray, qc: np.ndarray, r: np.ndarray, rc: np.ndarray, penalty: float) -> np.ndarray:
    """Distances of all rows of ``q`` to all rows of ``r``: Euclidean, with ``penalty`` added to the
    square for each code that differs."""
    d2 = np.zeros((len(q), len(r)))
    for j in range(q.shape[1]):
        x = q[:, j, None] - r[None, :, j]
        d2 += x * x
    for j in range(qc.shape[1]):
        d2 += penalty * (qc[:, j, None] != rc[None, :, j])
    return np.sqrt(d2)


def pick_pivots(x: np.ndarray, c: np.ndarray, m: int, penalty: float) -> list[int]:
    """Row numbers of at most ``m`` distinct pivots: three in four farthest first, the rest the first rows."""
    chosen, least = [0], distances(x, c, x[:1], c[:1], penalty)[:, 0]
    while len(chosen) < max(1, 3 * m // 4) and least.max() > 0:
        i = int(np.argmax(least))
        chosen.append(i)
        least = np.minimum(least, distances(x, c, x[i:i + 1], c[i:i + 1], penalty)[:, 0])
    taken = set(chosen)
    return chosen + [i for i in range(len(x)) if i not in taken][:m - len(chosen)]


def _matrix(col: pa.Array, dtype) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(col), -1) if len(flat) else np.zeros((len(col), 0), dtype)


_SIDE = ["loc", "name", "w", "x", "c", "lo", "hi"]


def _meet(side: DataFrame, many: DataFrame, step: Callable, schema: T.StructType) -> DataFrame:
    """For each ``blk`` the rows of ``many`` (blk, loc, w, x, c, t) with those of ``side`` (blk and ``_SIDE``).

    ``step(side, many)`` gets dicts of arrays, ``side`` whole and ``many`` in chunks, and returns the
    arrays of the output's columns. Rows of ``many`` without a side are left out."""
    spark = side.sparkSession
    loc_type = many.schema["loc"].dataType
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = many.groupBy("blk").count().where(F.col("count") > SALT) \
        .select("blk", F.ceil(F.col("count") / SALT).cast("int").alias("parts"))
    if hot.isEmpty():
        side, many = (df.withColumn("parts", F.lit(1)) for df in (side, many))
    else:
        side, many = (df.join(hot, "blk", "left").withColumn("parts", F.coalesce("parts", F.lit(1))) for df in (side, many))
    a = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .select("blk", "salt", F.lit(0).alias("kind"), *_SIDE, F.lit(None).cast("double").alias("t"))
    b = many.select(
        "blk", F.pmod(F.xxhash64("loc"), F.col("parts")).cast("int").alias("salt"), F.lit(1).alias("kind"), "loc",
        F.lit(None).cast("string").alias("name"), "w", "x", "c", F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, ready = None, [], None

        def arrays(t: pa.RecordBatch) -> dict:
            col = lambda n: t.column(t.schema.get_field_index(n))
            num = lambda n: col(n).to_numpy(zero_copy_only=False)
            return {"loc": col("loc"), "name": np.array(col("name").to_pylist(), object), "w": num("w"), "x": _matrix(col("x"), float),
                    "c": _matrix(col("c"), np.int64), "lo": num("lo"), "hi": num("hi"), "t": num("t")}
        for b in batches:
            if not b.num_rows:
                continue
            blk, salt, kind = np.array(b.column(0).to_pylist(), object), b.column(1).to_numpy(), b.column(2).to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], (blk[1:] != blk[:-1]) | (salt[1:] != salt[:-1]) | (kind[1:] != kind[:-1]), [True]]))
            for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
                key = (blk[s], salt[s])
                if key != now:
                    now, own, ready = key, [], None
                if kind[s] == 0:
                    own.append(b.slice(s, e - s))
                    continue
                if not own and ready is None:
                    continue
                if ready is None:
                    ready, own = arrays(pa.Table.from_batches(own).combine_chunks().to_batches()[0]), []
                chunk = max(1, CELLS // len(ready["x"]))
                for i in range(s, e, chunk):
                    out = step(ready, arrays(b.slice(i, min(chunk, e - i))), key[0])
                    yield pa.RecordBatch.from_arrays([pa.array(v, type=f) if not isinstance(v, pa.Array) else v
                                                      for v, f in zip(out, arrow)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type
    arrow, names = [to_arrow_type(f.dataType) for f in schema.fields], schema.names
    return a.withColumn("loc", F.col("loc").cast(loc_type)).unionByName(b).repartition(n, "blk", "salt") \
        .sortWithinPartitions("blk", "salt", "kind").mapInArrow(run, schema)


class PivotIndex:
    """Index of distinct locations: ``points`` has ``loc`` (a unique key), ``w`` (its weight), ``x`` (an array of
    doubles, no null or NaN) and ``c`` (an array of longs, of which each that differs adds ``penalty``
    to the squared distance)."""

    def __init__(self, points: DataFrame, penalty: float = 0.0, leaf: int = LEAF):
        self.penalty, self.spark = float(penalty), points.sparkSession
        self.pairs = 0  # compared so far, as sums of the sizes of the blocks that queries met
        self.id_type = points.schema["loc"].dataType
        self.levels: list[DataFrame] = []  # children (blk the parent, name, pivot x and c, lo, hi, w: 1 for a block of rows, n)
        self._build(points, leaf)

    def _build(self, points: DataFrame, leaf: int) -> None:
        penalty = self.penalty

        def pivots(pdf: pd.DataFrame) -> pd.DataFrame:
            x = np.array(pdf["x"].tolist(), float).reshape(len(pdf), -1)
            c = np.array(pdf["c"].tolist(), np.int64).reshape(len(pdf), -1)
            n, room, blk = int(pdf["n"].iloc[0]), leaf, pdf["blk"].iloc[0]
            own = pick_pivots(x, c, min(MAX_PIVOTS, max(2, math.ceil(n / leaf))), penalty)
            some = slice(0, 200)
            d = distances(x[some], c[some], x[own], c[own], penalty)
            if d.min(axis=1).mean() > LOOSE * distances(x[some], c[some], x[some], c[some], penalty).mean():
                room = COARSE * leaf
                own = pick_pivots(x, c, min(MAX_PIVOTS, max(2, math.ceil(n / room))), penalty)
            return pd.DataFrame({"blk": blk, "name": [f"{blk}.{i}" for i in range(len(own))], "room": room,
                                 "x": [x[i].tolist() for i in own], "c": [c[i].tolist() for i in own]})

        def nearest(side, many, _):
            d = distances(many["x"], many["c"], side["x"], side["c"], penalty)
            i = d.argmin(axis=1)
            return (pa.array(side["name"][i], pa.string()), many["loc"], pa.array(many["w"].astype(np.int64)), many["x"].tolist(), many["c"].tolist(),
                    d[np.arange(len(i)), i])

        rows = written(points.select(F.lit("").alias("blk"), "loc", F.col("w").cast("long").alias("w"), "x", "c"), "knnrows")
        schema = T.StructType([*rows.schema.fields, T.StructField("d", T.DoubleType())])
        done, n = None, rows.count()
        big = self.spark.createDataFrame([("", n)] if n > 2 * leaf else [], "blk string, n long")
        while not big.isEmpty():
            w = Window.partitionBy("blk").orderBy(F.xxhash64("loc"), "loc")
            some = rows.join(big, "blk").withColumn("k", F.row_number().over(w)).where(F.col("k") <= SAMPLE).drop("k", "loc", "w")
            at = written(some.groupBy("blk").applyInPandas(
                pivots, "blk string, name string, room long, x array<double>, c array<bigint>"), "knnpivots")
            rest = rows.join(big.select("blk"), "blk", "left_anti")
            moved = written(_meet(self._side(at), rows.join(big.select("blk"), "blk", "left_semi").withColumn("t", F.lit(None).cast("double")),
                                  nearest, schema), "knnrows")
            stats = moved.groupBy(F.col("blk").alias("name")).agg(
                F.count(F.lit(1)).alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi"), F.sum("w").alias("sum_w"))
            fits = F.col("n") <= AGAIN * F.col("room")
            level = written(at.join(stats, "name").withColumn("w", fits.cast("long")), "knnlevel")
            self.levels.append(level)
            done = rest if done is None else done.unionByName(rest)
            rows, big = moved.drop("d"), level.where("w = 0").select(F.col("name").alias("blk"), "n")
        self.rows = rows if done is None else done.unionByName(rows)
        self.sizes = written(self.rows.groupBy("blk").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("sum_w")), "knnsizes")

    def _side(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns of a side that it has not."""
        kinds = {"loc": self.id_type.simpleString(), "name": "string", "w": "long", "lo": "double", "hi": "double"}
        return df.select("blk", *[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in _SIDE])

    def _walk(self, states: DataFrame) -> DataFrame:
        """(loc, blk) of the block of rows that a query (loc, w, x, c, t) belongs to, by the nearest pivot of each level."""
        penalty = self.penalty
        schema = T.StructType([T.StructField("loc", self.id_type), T.StructField("blk", T.StringType()), T.StructField("leaf", T.BooleanType())])

        def step(side, many, _):
            j = distances(many["x"], many["c"], side["x"], side["c"], penalty).argmin(axis=1)
            return many["loc"], pa.array(side["name"][j], pa.string()), pa.array(side["w"][j] > 0)

        found = None
        at = states.withColumn("blk", F.lit(""))
        for level in self.levels:
            met = written(_meet(self._side(level), at, step, schema), "knnwalk")
            hit = met.where("leaf").drop("leaf")
            found = hit if found is None else found.unionByName(hit)
            at = met.where("not leaf").select("loc", "blk").join(states, "loc")
        return at.select("loc", "blk") if found is None else found

    def _own(self, q: DataFrame, own: DataFrame | None) -> DataFrame:
        """The queries (loc, w, x, c, t) with ``blk``, the block that they belong to; ``own`` (loc, blk), if it is known."""
        return (self._walk(q) if own is None else own.select("loc", "blk")).join(q, "loc")

    def _first(self, queries: DataFrame, value: Callable, kind: str) -> DataFrame:
        """(loc, v) of queries (blk, loc, w, x, c, t): ``value(distances, weights, t)`` over the rows of their block."""
        penalty = self.penalty
        schema = T.StructType([T.StructField("loc", self.id_type), T.StructField("v", T.DoubleType() if kind == "double" else T.LongType())])

        def step(side, many, _):
            return many["loc"], value(distances(many["x"], many["c"], side["x"], side["c"], penalty), side["w"].astype(np.int64), many["t"])
        return _meet(self._side(self.rows), queries, step, schema)

    def _scan(self, queries: DataFrame, rows: DataFrame, make: Callable, schema: T.StructType, held: int) -> DataFrame:
        """What ``make`` says of the queries (blk, loc, x, c, t) from the ``rows`` (blk, loc, w, x, c) of all blocks that
        come within ``t`` of one of them.

        Queries of near blocks form a group of at most ``GROUP`` or so, held by one task. The pivots of all blocks are
        sent to every group, which tells the blocks it needs; then their rows are, nearest block first. So a row goes to
        a group once, not to each of its queries, and what a task has found tightens the bounds of what follows."""
        penalty, n_q = self.penalty, queries.count()
        n = max(1, math.ceil(n_q / max(FEW, min(GROUP, HELD // held, math.ceil(n_q / (PER_CORE * self.spark.sparkContext.defaultParallelism))))))
        q = written(queries.select("blk", "loc", "x", "c", "t").repartitionByRange(n, "blk", "loc").withColumn("grp", F.spark_partition_id()), "knngroups")
        every = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        if self.levels:
            leaves = None
            for level in self.levels:
                some = level.where("w > 0").select(F.col("name").alias("blk"), "x", "c", "lo", "hi")
                leaves = some if leaves is None else leaves.unionByName(some)
            wanted = written(_grouped(q, leaves.withColumn("grp", every).withColumn("ord", F.lit(0.0)), n, self.id_type, lambda g: _Needed(g, penalty),
                                      T.StructType.fromDDL("grp int, blk string, ord double")), "knnwanted")
            many = rows.join(wanted, "blk")
        else:
            many = rows.withColumn("grp", every).withColumn("ord", F.lit(0.0))
        return written(_grouped(q, many, n, self.id_type, make, schema), "knnfound")

    def _result(self, out: DataFrame) -> DataFrame:
        """``out`` without the rows that count the pairs."""
        self.pairs += out.agg(F.sum("met")).first()[0] or 0
        return out.where("met is null").drop("met")

    def nearest(self, queries: DataFrame, need: int, own: DataFrame | None = None) -> DataFrame:
        """(l_loc, r_loc, dist): for each query (loc, w, x, c) the locations nearer than the distance at
        which the weights add up to ``need``, ties at that distance kept. ``own`` (loc, blk) gives the queries' blocks if they are known."""
        penalty = self.penalty
        q = self._own(queries.select("loc", F.lit(None).cast("long").alias("w"), "x", "c", F.lit(float("inf")).alias("t")), own)
        q = written(q, "knnown")

        def bound(d, w, _):
            order = np.argsort(d, axis=1)
            cum = np.cumsum(w[order], axis=1)
            at = np.minimum((cum < need).sum(axis=1), d.shape[1] - 1)
            i = np.arange(len(d))
            return np.where(cum[:, -1] >= need, d[i, order[i, at]], np.inf)
        t = self._first(q, bound, "double").withColumnRenamed("v", "t")
        schema = T.StructType([T.StructField("l_loc", self.id_type), T.StructField("r_loc", self.id_type), T.StructField("dist", T.DoubleType()),
                               T.StructField("met", T.LongType())])
        return self._result(self._scan(q.drop("t").join(t, "loc"), self.rows, lambda g: _Nearest(g, penalty, need), schema, need))

    def at_least(self, queries: DataFrame, eps: float, enough: int, rows: DataFrame | None = None) -> DataFrame:
        """(loc) of the queries (loc, x, c; indexed locations) that have a weight of ``enough`` within ``eps``, of all locations or of
        those in ``rows`` (blk, loc, w, x, c). A query stops where it has enough, and a block that lies within ``eps`` altogether
        counts with its weight, so no list of pairs comes up."""
        penalty = self.penalty
        q = queries.select("loc", F.lit(None).cast("long").alias("w"), "x", "c", F.lit(float(eps)).alias("t"))
        q = written(self._own(q, self.rows), "knnown")
        schema = T.StructType([T.StructField("loc", self.id_type), T.StructField("met", T.LongType())])
        done = None
        if rows is None:
            # most have enough in their own block
            first = written(self._first(q, lambda d, w, t: ((d <= t[:, None]) * w).sum(axis=1), "long"), "knnfirst")
            self.pairs += q.join(self.sizes, "blk").agg(F.sum("n")).first()[0] or 0
            done = first.where(F.col("v") >= enough).select("loc")
            q = written(q.join(done, "loc", "left_anti"), "knnopen")
        found = self._result(self._scan(q, self.rows if rows is None else rows, lambda g: _Enough(g, penalty, enough), schema, 1))
        return found if done is None else found.unionByName(done)


def _grouped(queries: DataFrame, many: DataFrame, n: int, id_type: T.DataType, make: Callable, schema: T.StructType) -> DataFrame:
    """For each group ``grp`` (0 to ``n`` - 1) one ``make(queries)`` in one task, which meets the rows of ``many`` (grp, ord, blk and what it has of
    loc, w, x, c, lo, hi) in the order of ``ord``, those of a block together, and says its rows at the end."""
    kinds = {"loc": id_type.simpleString(), "w": "long", "lo": "double", "hi": "double", "t": "double"}
    cols = ["grp", "kind", "ord", "blk", "loc", "w", "x", "c", "lo", "hi", "t"]
    side = lambda df: df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in cols])
    both = side(queries.withColumns({"kind": F.lit(0), "ord": F.lit(0.0)})).unionByName(side(many.withColumn("kind", F.lit(1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, task = None, [], None

        def arrays(b: pa.RecordBatch) -> dict:
            num = lambda c: b.column(cols.index(c)).to_numpy(zero_copy_only=False)
            return {"blk": b.column(3), "loc": b.column(4), "w": num("w"), "x": _matrix(b.column(6), float), "c": _matrix(b.column(7), np.int64),
                    "lo": num("lo"), "hi": num("hi"), "t": num("t")}

        def ready():
            t = pa.Table.from_batches(own).combine_chunks().to_batches()[0]
            return make(arrays(t) | {"grp": now})

        def said(task):
            for out in task.end():
                yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, type=f) for v, f in zip(out, arrow)], names=names)
        for b in batches:
            if not b.num_rows:
                continue
            grp, kind, blk = b.column(0).to_numpy(), b.column(1).to_numpy(), np.array(b.column(3).to_pylist(), object)
            cut = np.flatnonzero(np.concatenate([[True], (grp[1:] != grp[:-1]) | (kind[1:] != kind[:-1]) | (blk[1:] != blk[:-1]), [True]]))
            if by_batch:
                cut = np.flatnonzero(np.concatenate([[True], (grp[1:] != grp[:-1]) | (kind[1:] != kind[:-1]), [True]]))
            for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if grp[s] != now:
                    if own and task is None:
                        task = ready()
                    if task is not None:
                        yield from said(task)
                    now, own, task = int(grp[s]), [], None
                if kind[s] == 0:
                    own.append(b.slice(s, e - s))
                elif own:
                    task = ready() if task is None else task
                    task.meet(arrays(b.slice(s, e - s)))
        if own and task is None:
            task = ready()
        if task is not None:
            yield from said(task)

    from pyspark.sql.pandas.types import to_arrow_type
    arrow, names = [to_arrow_type(f.dataType) for f in schema.fields], schema.names
    by_batch = "lo" in many.columns  # pivots, of which one stands for its block
    return both.repartitionById(n, "grp").sortWithinPartitions("grp", "kind", "ord", "blk").mapInArrow(run, schema)


class _Group:
    """The queries that a task holds (arrays loc, x, c, t) and what it knows of them."""

    def __init__(self, q: dict, penalty: float):
        self.q, self.penalty, self.met = q, penalty, 0
        self.t = q["t"].copy()
        x = q["x"]
        finite = np.isfinite(x).all(axis=1)
        self.mid = x[finite].mean(axis=0) if finite.any() else np.zeros(x.shape[1])
        self.left, self.sq = self._factors(x, -2.0)

    def _factors(self, x: np.ndarray, by: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose products are squared distances over the columns of doubles, up to rounding, and the squares."""
        with np.errstate(invalid="ignore", over="ignore"):
            z = x - self.mid
            sq = (z * z).sum(axis=1)
            one = np.ones(len(z))
            return np.column_stack([by * z, one, sq] if by < 0 else [z, sq, one]), sq

    def _close(self, r: dict) -> tuple[np.ndarray, np.ndarray, float]:
        """Distances of all queries to a point amid the rows, which queries may have one within ``t``, and the rows' radius about it."""
        with np.errstate(invalid="ignore", over="ignore"):
            x, c = r["x"].mean(axis=0)[None], r["c"][:1]
            radius = distances(x, c, r["x"], r["c"], self.penalty).max() * (1 + SLACK) + 1e-12
            d = distances(self.q["x"], self.q["c"], x, c, self.penalty)[:, 0]
            return d, ~(d * (1 - SLACK) - radius > self.t), radius

    def _within(self, r: dict, some: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, row, distance) within ``t`` for ``some`` of the queries: one product of matrices leaves a few pairs,
        whose distances are taken as :func:`distances` takes them."""
        right, sq = self._factors(r["x"], 1.0)
        chunk = max(1, CACHED // len(sq))
        for i in range(0, len(some), chunk):
            a = some[i:i + chunk]
            self.met += len(a) * len(sq)
            with np.errstate(invalid="ignore", over="ignore"):
                cut = self.t[a] ** 2 * (1 + SLACK) + 1e-11 * (self.sq[a] + sq.max())
                q, j = np.divmod(np.flatnonzero(~(self.left[a] @ right.T > cut[:, None])), len(sq))
                q = a[q]
                d2 = np.zeros(len(q))
                for k in range(r["x"].shape[1]):
                    v = self.q["x"][q, k] - r["x"][j, k]
                    d2 += v * v
                for k in range(r["c"].shape[1]):
                    d2 += self.penalty * (self.q["c"][q, k] != r["c"][j, k])
                d = np.sqrt(d2)
                keep = d <= self.t[q]
            yield q[keep], j[keep], d[keep]


class _Needed(_Group):
    """The blocks (of pivot x, c and least and largest distance lo, hi) that may come within ``t`` of a query."""

    def __init__(self, q: dict, penalty: float):
        super().__init__(q, penalty)
        self.out = []

    def meet(self, r: dict) -> None:
        right, sq = self._factors(r["x"], 1.0)
        least, need = np.full(len(sq), np.inf), np.zeros(len(sq), bool)
        chunk = max(1, CACHED // len(sq))
        for i in range(0, len(self.t), chunk):
            with np.errstate(invalid="ignore", over="ignore"):
                d2 = self.left[i:i + chunk] @ right.T
                for k in range(r["c"].shape[1]):
                    d2 += self.penalty * (self.q["c"][i:i + chunk, k, None] != r["c"][None, :, k])
                off = np.sqrt(1e-11 * (self.sq[i:i + chunk, None] + sq))
                d = np.sqrt(np.maximum(d2, 0))
                lb = np.maximum(d - r["hi"], r["lo"] - d) * (1 - SLACK) - off - 1e-12
                need |= (~(lb > self.t[i:i + chunk, None])).any(axis=0)
                least = np.fmin(least, np.fmin.reduce(lb, axis=0))
        at = np.flatnonzero(need)
        self.out.append((np.full(len(at), self.q["grp"], np.int32), r["blk"].take(pa.array(at)), np.maximum(least[at], 0.0)))

    def end(self):
        yield from self.out


class _Nearest(_Group):
    """The nearest locations up to a weight of ``need``, and those that tie."""

    def __init__(self, q: dict, penalty: float, need: int):
        super().__init__(q, penalty)
        self.need, self.found, self.new = need, [], 0
        self.got, self.far = np.zeros(len(self.t), np.int64), np.zeros(len(self.t))  # of queries without a bound yet

    def meet(self, r: dict) -> None:
        some = np.flatnonzero(self._close(r)[1])
        if not len(some):
            return
        w = r["w"].astype(np.int64)
        for q, j, d in self._within(r, some):
            if len(q):
                self.found.append((q, d, w[j], r["loc"].take(pa.array(j))))
                self.new += len(q)
                free = np.isinf(self.t[q])
                if free.any():
                    np.add.at(self.got, q[free], w[j[free]])
                    np.maximum.at(self.far, q[free], d[free])
                    self.t[q[free]] = np.where(self.got[q[free]] >= self.need, self.far[q[free]], np.inf)
            if self.new > self.need * len(self.t):
                self._best()

    def _best(self) -> None:
        if not self.found:
            return
        q, d, w = (np.concatenate([f[i] for f in self.found]) for i in range(3))
        loc = pa.concat_arrays([f[3] for f in self.found])
        order = np.lexsort((d, q))
        q, d, w = q[order], d[order], w[order]
        cum = np.cumsum(w)
        head = np.concatenate([[True], q[1:] != q[:-1]])
        cum -= np.repeat((cum - w)[head], np.diff(np.append(np.flatnonzero(head), len(q))))
        tie = np.flatnonzero(head | np.concatenate([[True], d[1:] != d[:-1]]))
        before = np.repeat((cum - w)[tie], np.diff(np.append(tie, len(q))))
        keep = before < self.need
        q, d, w, cum, order = q[keep], d[keep], w[keep], cum[keep], order[keep]
        last = np.concatenate([q[1:] != q[:-1], [True]])
        full = last & (cum >= self.need)
        self.t[q[full]] = np.minimum(self.t[q[full]], d[full])
        self.found, self.new = [(q, d, w, loc.take(pa.array(order)))], 0

    def end(self):
        self._best()
        for q, d, _, loc in self.found:
            for i in range(0, len(q), ROWS_OUT):
                z = slice(i, i + ROWS_OUT)
                yield self.q["loc"].take(pa.array(q[z])), loc[i:i + ROWS_OUT], d[z], pa.nulls(len(q[z]), pa.int64())
        yield pa.nulls(1, self.q["loc"].type), pa.nulls(1, self.q["loc"].type), [None], [self.met]


class _Enough(_Group):
    """The queries that have a weight of ``enough`` within ``t``."""

    def __init__(self, q: dict, penalty: float, enough: int):
        super().__init__(q, penalty)
        self.enough, self.n = enough, np.zeros(len(self.t), np.int64)

    def meet(self, r: dict) -> None:
        d, near, radius = self._close(r)
        near &= self.n < self.enough
        if not near.any():
            return
        w = r["w"].astype(np.int64)
        whole = near & (d * (1 + SLACK) + radius <= self.t)
        self.n[whole] += w.sum()
        for q, j, _ in self._within(r, np.flatnonzero(near & ~whole)):
            np.add.at(self.n, q, w[j])

    def end(self):
        at = np.flatnonzero(self.n >= self.enough)
        yield self.q["loc"].take(pa.array(at)), pa.nulls(len(at), pa.int64())
        yield pa.nulls(1, self.q["loc"].type), [self.met]


def known(df: DataFrame, cols) -> DataFrame:
    """Rows whose ``cols`` are neither null nor NaN: the others have no distance to anything."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.where(cond)


def keyed(df: DataFrame, cols, payload, id_col: str) -> tuple[DataFrame, list[str]]:
    """(id, key columns under names of their own), and those names."""
    names = [f"__k{i}" for i in range(len(cols) + len(payload))]
    return df.select(F.col(id_col).alias("__id"), *[F.col(c).cast("double").alias(n) for c, n in zip(cols, names)],
                     *[F.col(c).alias(n) for c, n in zip(payload, names[len(cols):])]), names


def locations(rows: DataFrame, names: list[str], n_cols: int) -> DataFrame:
    """Distinct keys of :func:`keyed` rows with ``loc`` (the least id), ``w`` (how many share it), ``x`` and
    ``c`` (codes of the payload; a null is a code of its own)."""
    codes = [F.xxhash64(F.col(n).isNull(), F.col(n)) for n in names[n_cols:]]
    return written(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("w"), F.min("__id").alias("loc"))
                   .withColumn("x", F.array(*names[:n_cols]))
                   .withColumn("c", F.array(*codes) if codes else F.array().cast("array<bigint>")), "knnlocations")


def knn_join(left: DataFrame, right: DataFrame, cols, k: int, id_col: str = "id", exclude_self: bool = True,
             payload=(), penalty: float = 0.0, leaf: int | None = None, stats: dict | None = None) -> DataFrame:
    """Rows (left_id, right_id, dist, rank) with the k nearest right rows of every left row: Euclidean
    over ``cols``, plus ``penalty`` on the squared distance for each ``payload`` column that differs; ties
    by id. Rows with a null or NaN coordinate have no neighbours and are none.

    Identical rows (same ``cols`` and ``payload``) are one location with a weight on each side, so a
    hot group of equal rows costs O(rows x k), not O(rows^2): the index finds near locations, then
    each left row takes from them the k + 1 smallest ids per location (a bounded list) and keeps its
    k best by (distance, id), excluding itself. ``stats`` receives the number of pairs compared."""
    cols, payload = list(cols), list(payload)
    need, same = k + (1 if exclude_self else 0), left is right
    (left, names), (right, _) = (keyed(known(df, cols), cols, payload, id_col) for df in (left, right))
    rl = locations(right, names, len(cols))
    ll = rl if same else locations(left, names, len(cols))
    index = PivotIndex(rl, penalty, leaf or max(LEAF, 2 * need))
    near = index.nearest(ll, need, index.rows if same else None)
    if stats is not None:
        stats["pairs"], stats["blocks"] = index.pairs, index.sizes.count()
    # k + 1 smallest ids of every right location (partial limit before the shuffle)
    by_id = Window.partitionBy("r_loc").orderBy("__id")
    rid = null_safe_join(right, rl.select(F.col("loc").alias("r_loc"), *names), names)
    top_ids = rid.withColumn("__r", F.row_number().over(by_id)).where(F.col("__r") <= k + 1).select("r_loc", F.col("__id").alias("right_id"))
    lp = null_safe_join(left, ll.select(F.col("loc").alias("l_loc"), *names), names).select(F.col("__id").alias("left_id"), "l_loc")
    cand = lp.join(near, "l_loc").join(top_ids, "r_loc")
    if exclude_self:
        cand = cand.where(F.col("left_id") != F.col("right_id"))
    w = Window.partitionBy("left_id").orderBy("dist", "right_id")
    # the neighbour lists feed several joins downstream: written once
    return written(cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                   .select("left_id", "right_id", "dist", "rank"), "knn")
