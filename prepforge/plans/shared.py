"""Shared-scan fitting: many models learn from one pass over the rows.

A search over settings, folds or feature masks fits the same rows over and over. Here every
model of the search is a row of one matrix, and a pass over the data adds up the loss, gradient
and Hessian of all of them (:func:`scan_sums`: one partial sum a task, added up in a tree). The
driver holds weights and sums, models x features^2 numbers, never rows.

:func:`fit_logistic` is Newton's method on those sums, with coordinate descent and
solves for the features in use on the quadratic model where the penalty is absolute. :func:`score_logistic` counts the held-out scores of all models in one more pass.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepforge.operators.evaluate import COST, N_THRESHOLDS, REVENUE, STEP
from prepforge.plans.knn import known
from prepforge.plans.prefix import written

#: Rows that a step of a pass takes; partial sums, and numbers in all of them, that reach the driver unmerged.
CHUNK, MERGE_ABOVE, DIRECT = 2048, 64, 1 << 17
#: Numbers of one piece of all partial sums, which one task adds up.
PIECES = 1 << 21
THRESHOLDS = np.array([i * STEP for i in range(N_THRESHOLDS)])


def training_rows(df: DataFrame, cols, label_col: str, fold_col: str | None = None, id_col: str | None = None) -> DataFrame:
    """(x: array of doubles, y, fold[, id]) of the rows with a label and all of ``cols``; written, since
    every pass reads it. Without folds, or where it is null, ``fold`` is -1."""
    fold = F.coalesce(F.col(fold_col).cast("int"), F.lit(-1)) if fold_col else F.lit(-1)
    return written(known(df, cols).where(F.col(label_col).isNotNull()).select(
        F.array(*[F.col(c).cast("double") for c in cols]).alias("x"), F.col(label_col).cast("double").alias("y"), fold.alias("fold"),
        *([F.col(id_col).alias("id")] if id_col else [])), "shared")


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` for many passes: a small written table comes in a few files, and each pass would keep the other cores
    idle, so it is dealt over all of them and written once more."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else written(rows.repartition(cores), "spread")


def matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def scan_sums(data: DataFrame, step: Callable, size: int, add_up=np.add, start: float = 0.0, tasks: int | None = None, chunk: int = CHUNK) -> np.ndarray:
    """The sum (or what ``add_up`` makes, from ``start``) over all rows of ``step(batch)``, an array of ``size`` doubles for an Arrow batch of at
    most ``chunk`` rows of ``data``. Each task adds up its rows. Above ``MERGE_ABOVE`` tasks or ``DIRECT`` numbers of all of
    them, the tasks' sums are cut into pieces and added up piece by piece in a shuffle, so that one sum
    reaches the driver. ``tasks``: their number, where the caller knows it (asking plans ``data`` once more)."""
    tasks = data.rdd.getNumPartitions() if tasks is None else tasks
    most = 2 * data.sparkSession.sparkContext.defaultParallelism
    if tasks > most:
        data, tasks = data.coalesce(most), most
    merge = tasks > 1 and (tasks > MERGE_ABOVE or tasks * size > DIRECT)
    piece = max(512, PIECES // tasks) if merge else max(size, 1)
    pieces = math.ceil(size / piece) or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = np.full(size, start)
        for b in batches:
            for i in range(0, b.num_rows, chunk):
                total = add_up(total, step(b.slice(i, chunk)))
        for i in range(pieces):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([total[i * piece:(i + 1) * piece].tobytes()], pa.binary())], names=["piece", "part", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                                 names=["piece", "part", "data"])
        for b in batches:
            for i, d in zip(b.column(0).to_pylist(), b.column(2)):
                if i != now:
                    if now is not None:
                        yield row()
                    now, total = i, np.full(min(piece, size - i * piece), start)
                total = add_up(total, np.frombuffer(d.as_buffer()))
        if now is not None:
            yield row()

    rows = data.mapInArrow(run, "piece int, part int, data binary")
    if merge:
        rows = rows.repartitionById(pieces, F.col("piece")).sortWithinPartitions("piece", "part").mapInArrow(add, "piece int, part int, data binary")
    total = np.full(size, start)
    for r in sorted(rows.collect(), key=lambda r: (r["piece"], r["part"])):
        own = slice(r["piece"] * piece, (r["piece"] + 1) * piece)
        total[own] = add_up(total[own], np.frombuffer(r["data"]))
    return total


@dataclass(frozen=True)
class Logistic:
    """A logistic regression: sum of losses + (|w|_1 or |w|^2 / 2) / C, the intercept free.

    ``held``: the fold that it does not learn from; ``only``: the one it learns from alone (a prepared
    training set of its own); ``mask``: the features it may use (all if None)."""
    C: float = 1.0
    penalty: str = "l2"
    max_iter: int = 100
    held: int | None = None
    only: int | tuple[int, int] | None = None
    mask: tuple[int, ...] | None = None


def learns(specs, fold: np.ndarray) -> np.ndarray:
    """[row, spec]: whether the spec learns from the row. ``only`` may be a range (from, below) of folds."""
    held = np.array([-2 if s.held is None else s.held for s in specs])
    span = np.array([(-1 << 31, 1 << 31) if s.only is None else s.only if isinstance(s.only, tuple) else (s.only, s.only + 1) for s in specs]).reshape(-1, 2)
    return (fold[:, None] != held[None, :]) & (fold[:, None] >= span[None, :, 0]) & (fold[:, None] < span[None, :, 1])


def _loss_sums(data: DataFrame, w: np.ndarray, specs: list[Logistic]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian of each row of ``w`` (features, then intercept) over the rows it learns from."""
    m, k = w.shape
    at = np.triu_indices(k)

    groups: dict = {}  # the models that learn from the same folds alone meet no other rows
    for i, s in enumerate(specs):
        groups.setdefault(s.only, []).append(i)
    groups = [([specs[i] for i in own], np.array(own)) for own in groups.values()]

    def step(b: pa.RecordBatch) -> np.ndarray:
        whole = matrix(b.column(0))
        whole = np.column_stack([whole, np.ones(len(whole))])
        labels, folds = b.column(1).to_numpy(), b.column(2).to_numpy()
        losses, grads, hess = np.zeros(m), np.zeros((m, k)), np.zeros((m, len(at[0])))
        for some, own in groups:
            on = learns(some, folds)
            rows = np.flatnonzero(on.any(axis=1))
            if not len(rows):
                continue
            x, y, on = whole[rows], labels[rows], on[rows]
            z = x @ w[own].T
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            # log(1 + e^z) - y z
            losses[own] = ((np.logaddexp(0, z) - y[:, None] * z) * on).sum(axis=0)
            grads[own] = ((p - y[:, None]) * on).T @ x
            hess[own] = (p * (1 - p) * on).T @ (x[:, at[0]] * x[:, at[1]])
        return np.concatenate([losses, grads.ravel(), hess.ravel()])

    total = scan_sums(data, step, m + m * k + m * len(at[0]))
    h = np.zeros((m, k, k))
    h[:, at[0], at[1]] = h[:, at[1], at[0]] = total[m + m * k:].reshape(m, -1)
    return total[:m], total[m:m + m * k].reshape(m, k), h


def _l1_step(w: np.ndarray, g: np.ndarray, h: np.ndarray, alpha: np.ndarray, free: np.ndarray) -> np.ndarray:
    """For each model the step to the minimum of its quadratic model plus alpha |w|_1.

    A sweep of coordinate descent finds the features that enter or leave; then the features in use are solved for
    together, their signs held, up to the first that reaches zero, until none does. Sweeps alone take thousands where
    columns are sums of others. A model is left where no other feature would enter or a sweep gains nothing."""
    out, k = w.copy(), w.shape[1]
    some, start = np.arange(len(w)), w
    u, cost = w.copy(), np.repeat(alpha[:, None], k, axis=1)
    cost[:, -1] = 0.0
    hd, best, sweep = np.zeros_like(w), np.full(len(w), np.inf), np.ones(len(w), bool)
    for _ in range(2000):
        if not len(some):
            break
        if sweep.any():
            v, e, gs, hs, cs, fs = u[sweep], hd[sweep], g[sweep], h[sweep], cost[sweep], free[sweep]
            for j in range(k):
                a = np.maximum(hs[:, j, j], 1e-12)
                z = v[:, j] - (gs[:, j] + e[:, j]) / a
                d = np.where(fs[:, j], np.sign(z) * np.maximum(np.abs(z) - cs[:, j] / a, 0) - v[:, j], 0.0)
                v[:, j] += d
                e += hs[:, j] * d[:, None]
            u[sweep] = v
        used = free & ((u != 0) | (cost == 0))
        sign = np.sign(u) * (cost > 0)
        # the other features stay: rows and columns of the identity
        a = np.where(used[:, :, None] & used[:, None, :], h, 0.0) + np.eye(k)[None] * ~used[:, :, None]
        unit = 1 / np.sqrt(np.maximum(np.einsum("ijj->ij", a), 1e-12))
        slope = np.where(used, g + (h @ (u - start)[:, :, None])[:, :, 0] + cost * sign, 0.0)
        d = -unit * np.linalg.solve(a * unit[:, :, None] * unit[:, None, :], (slope * unit)[:, :, None])[:, :, 0]
        over = (sign != 0) & ((u + d) * sign <= 0)
        reach = np.where(over, u / np.where(over, -d, 1.0), 1.0)
        step = reach.min(axis=1)
        u = np.where(over & (reach <= step[:, None]), 0.0, u + step[:, None] * d)
        hd = (h @ (u - start)[:, :, None])[:, :, 0]
        sweep = ~over.any(axis=1)
        value = ((u - start) * (g + hd / 2)).sum(axis=1) + (cost * np.abs(u)).sum(axis=1)
        enters = (free & ~used & (np.abs(g + hd) > cost * (1 + 1e-9))).any(axis=1)
        done = sweep & (~enters | (best - value <= 1e-13 * np.maximum(np.abs(value), 1.0)))
        best = np.where(sweep, value, best)
        out[some] = u
        some, start, u, hd, g, h, cost, free, best, sweep = (x[~done] for x in (some, start, u, hd, g, h, cost, free, best, sweep))
    return out - w


def fit_logistic(data: DataFrame, specs: list[Logistic], n_features: int, tol: float = 1e-12) -> np.ndarray:
    """Weights (features, then intercept) of every spec, all fitted together on ``data`` (:func:`training_rows`).

    Newton steps, halved while the objective rises; a model leaves the passes once a step lowers its
    objective by no more than ``tol`` of it (of 1 where it is less, as on separable rows), or after ``max_iter`` steps."""
    k = n_features + 1
    data = spread(data)
    out, w = np.zeros((len(specs), k)), np.zeros((len(specs), k))
    alpha, l1 = np.array([1.0 / s.C for s in specs]), np.array([s.penalty == "l1" for s in specs])
    free = np.array([[*(s.mask or [1] * n_features), 1] for s in specs], bool).reshape(len(specs), k)
    best, steps, delta = np.full(len(specs), np.inf), np.zeros(len(specs), int), np.zeros((len(specs), k))
    live = np.arange(len(specs))
    while len(live):
        loss, g, h = _loss_sums(data, w[live], [specs[i] for i in live])
        feat = w[live][:, :-1]
        value = loss + alpha[live] * np.where(l1[live], np.abs(feat).sum(axis=1), (feat ** 2).sum(axis=1) / 2)
        worse = (value > best[live] * (1 + 1e-14)) & (np.abs(delta[live]).max(axis=1) > 1e-13)
        done = ~worse & (best[live] - value <= tol * np.maximum(np.abs(value), 1.0)) | (steps[live] >= [specs[i].max_iter for i in live]) & ~worse
        for i in live[worse]:  # back half way
            delta[i] /= 2
            w[i] = out[i] + delta[i]
        ok = ~worse
        out[live[ok]], best[live[ok]] = w[live[ok]], value[ok]
        go = ok & ~done
        i = live[go]
        if len(i):
            gi, hi = np.where(free[i], g[go], 0), h[go] * free[i][:, :, None] * free[i][:, None, :]
            # each feature by its own scale: a share of the trace would hold the small ones back beside a large one
            hi = hi + np.eye(k)[None] * np.where(free[i], 1e-10 * (1 + np.einsum("ijj->ij", hi)), 1.0)[:, :, None]
            d = np.zeros((len(i), k))
            sq = ~l1[i]
            if sq.any():
                reg = alpha[i][sq][:, None] * free[i][sq] * np.append(np.ones(k - 1), 0)
                a = hi[sq] + np.eye(k)[None] * reg[:, :, None]
                unit = 1 / np.sqrt(np.einsum("ijj->ij", a))
                d[sq] = -unit * np.linalg.solve(a * unit[:, :, None] * unit[:, None, :], ((gi[sq] + reg * w[i][sq]) * unit)[:, :, None])[:, :, 0]
            if l1[i].any():
                d[l1[i]] = _l1_step(w[i][l1[i]], gi[l1[i]], hi[l1[i]], alpha[i][l1[i]], free[i][l1[i]])
            delta[i] = d
            w[i] = out[i] + d
            steps[i] += 1
        live = live[~done]
    return out


def score_logistic(data: DataFrame, specs: list[Logistic], weights: np.ndarray) -> np.ndarray:
    """counts[model, bin, label] of the rows of each model's held fold (all rows if it has none), where
    bin is how many of the profit thresholds the score reaches."""
    held = [s.held for s in specs]

    def step(b: pa.RecordBatch) -> np.ndarray:
        x = matrix(b.column(0))
        y, fold = (b.column(1).to_numpy() == 1).astype(int), b.column(2).to_numpy()
        out = np.zeros((len(held), N_THRESHOLDS + 1, 2))
        for f in set(held):
            rows = np.ones(len(x), bool) if f is None else fold == f
            own = [i for i, v in enumerate(held) if v == f]
            if not rows.any():
                continue
            z = x[rows] @ weights[own, :-1].T + weights[own, -1]
            p = np.searchsorted(THRESHOLDS, 1 / (1 + np.exp(-np.clip(z, -500, 500))), side="right")
            for j, i in enumerate(own):
                out[i] += np.bincount(2 * p[:, j] + y[rows], minlength=2 * N_THRESHOLDS + 2).reshape(-1, 2)
        return out.ravel()

    return scan_sums(data, step, len(held) * (N_THRESHOLDS + 1) * 2).reshape(len(held), N_THRESHOLDS + 1, 2)


def confusions(counts: np.ndarray, cut: float = 0.5) -> np.ndarray:
    """[..., (tn, fp, fn, tp)] of hard predictions at ``cut``, one of the thresholds."""
    i = int(np.searchsorted(THRESHOLDS, cut, side="right"))
    low, high = counts[..., :i, :].sum(axis=-2), counts[..., i:, :].sum(axis=-2)
    return np.stack([low[..., 0], high[..., 0], low[..., 1], high[..., 1]], axis=-1)


def best_profit_ratio(counts: np.ndarray) -> np.ndarray:
    """Best profit ratio over the thresholds, by model."""
    reach = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1][:, 1:]  # rows that reach each threshold, by label
    profit = (REVENUE * reach[:, :, 1] - COST * reach.sum(axis=2)).max(axis=1)
    pos = counts[:, :, 1].sum(axis=1)
    return np.divide(profit, pos * (REVENUE - COST), out=np.zeros_like(profit), where=pos > 0)


def hard_profit_ratio(counts: np.ndarray) -> np.ndarray:
    """The tuning metric: best profit ratio of hard 0/1 predictions, by model."""
    tn, fp, fn, tp = np.moveaxis(confusions(counts), -1, 0)
    named = np.maximum(REVENUE * tp - COST * (tp + fp), REVENUE * (tp + fn) - COST * (tp + fn + fp + tn))
    return np.divide(named, (tp + fn) * (REVENUE - COST), out=np.zeros_like(named), where=tp + fn > 0)


def f1(counts: np.ndarray) -> np.ndarray:
    _, fp, fn, tp = np.moveaxis(confusions(counts), -1, 0)
    return np.divide(2 * tp, 2 * tp + fp + fn, out=np.zeros_like(tp), where=2 * tp + fp + fn > 0)


def logistic_scores(df: DataFrame, w: np.ndarray, keep=("id",)) -> DataFrame:
    """``keep``, ``score`` (probability) and ``prediction`` of rows with ``x``."""
    z = F.aggregate(F.zip_with("x", F.array(*[F.lit(float(v)) for v in w[:-1]]), lambda a, b: a * b), F.lit(float(w[-1])), lambda a, b: a + b)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return df.select(*keep, p.alias("score"), (p > 0.5).cast("double").alias("prediction"))


# ---------------------------------------------------------------- networks
@dataclass(frozen=True)
class Network:
    """A network of tanh layers and one logistic output: sum of losses + ``decay`` |weights|^2 / 2. ``held`` and
    ``only`` as in :class:`Logistic`."""
    hidden: tuple[int, ...] = (10,)
    decay: float = 1e-2
    max_iter: int = 100
    held: int | None = None
    only: int | None = None
    seed: int = 0


def _shapes(s: Network, n_features: int) -> list[tuple[int, int]]:
    sizes = [n_features, *s.hidden, 1]
    return list(zip(sizes[:-1], sizes[1:]))


def _layers(flat: np.ndarray, shapes) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in shapes:
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def _forward(x: np.ndarray, layers) -> list[np.ndarray]:
    acts = [x]
    for i, (w, b) in enumerate(layers):
        z = acts[-1] @ w + b
        acts.append(np.tanh(z) if i + 1 < len(layers) else z)
    return acts


def _network_sums(data: DataFrame, flats: list[np.ndarray], specs: list[Network], n_features: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Loss and gradient of each network over the rows it learns from, the decay not included."""
    shapes = [_shapes(s, n_features) for s in specs]
    sizes = [len(f) for f in flats]
    at = np.concatenate([[0], np.cumsum(sizes)]) + len(specs)

    def step(b: pa.RecordBatch) -> np.ndarray:
        x, y = matrix(b.column(0)), b.column(1).to_numpy()
        on = learns(specs, b.column(2).to_numpy())
        out = np.zeros(int(at[-1]))
        for i, (flat, shape) in enumerate(zip(flats, shapes)):
            rows = np.flatnonzero(on[:, i])
            layers = _layers(flat, shape)
            acts = _forward(x[rows], layers)
            z = acts[-1][:, 0]
            out[i] = (np.logaddexp(0, z) - y[rows] * z).sum()
            back = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y[rows])[:, None]
            grads = []
            for (w, _), a in zip(layers[::-1], acts[-2::-1]):
                grads.append(np.concatenate([(a.T @ back).ravel(), back.sum(axis=0)]))
                back = (back @ w.T) * (1 - a * a)
            out[at[i]:at[i + 1]] = np.concatenate(grads[::-1])
        return out

    total = scan_sums(data, step, int(at[-1]))
    return total[:len(specs)], [total[a:b] for a, b in zip(at, at[1:])]


def fit_networks(data: DataFrame, specs: list[Network], n_features: int, memory: int = 10, tol: float = 1e-6) -> list[np.ndarray]:
    """The weights of all networks, by L-BFGS in step: each pass evaluates every network that has not settled
    at its next point; a point that does not lower the objective enough is tried again half way."""
    data, flat, pens = spread(data), [], []
    for s in specs:
        rng = np.random.default_rng(s.seed)
        parts = [np.concatenate([rng.uniform(-1, 1, a * b) * np.sqrt(6 / (a + b)), np.zeros(b)]) for a, b in _shapes(s, n_features)]
        flat.append(np.concatenate(parts))
        pens.append(np.concatenate([np.repeat([s.decay, 0.0], [a * b, b]) for a, b in _shapes(s, n_features)]))
    live = list(range(len(specs)))
    now = [None] * len(specs)  # (value, gradient) at the accepted point
    point, step, seen = list(flat), [None] * len(specs), [[] for _ in specs]
    done = [0] * len(specs)
    while live:
        loss, grads = _network_sums(data, [point[i] for i in live], [specs[i] for i in live], n_features)
        left = []
        for i, v, g in zip(live, loss, grads):
            value, g = v + (pens[i] * point[i] ** 2).sum() / 2, g + pens[i] * point[i]
            if now[i] is not None:
                old, g0 = now[i]
                if value > old + 1e-4 * float(g0 @ step[i]):
                    step[i] = step[i] / 2
                    if np.abs(step[i]).max() > 1e-10:
                        point[i] = flat[i] + step[i]
                        left.append(i)
                    continue
                dy = g - g0
                if float(dy @ step[i]) > 1e-12:
                    seen[i] = [*seen[i][1 - memory:], (step[i], dy)]
                flat[i], done[i] = point[i], done[i] + 1
                if old - value <= tol * abs(value) or done[i] >= specs[i].max_iter:
                    continue
            now[i] = (value, g)
            d, hist = -g, []
            for a, b in reversed(seen[i]):
                c = float(a @ d) / float(a @ b)
                hist.append(c)
                d = d - c * b
            d = d * (float(seen[i][-1][0] @ seen[i][-1][1]) / float(seen[i][-1][1] @ seen[i][-1][1]) if seen[i] else 1 / max(np.abs(g).sum(), 1e-12))
            for (a, b), c in zip(seen[i], reversed(hist)):
                d = d + (c - float(b @ d) / float(a @ b)) * a
            step[i] = d if float(d @ g) < 0 else -g / max(np.abs(g).sum(), 1e-12)
            point[i] = flat[i] + step[i]
            left.append(i)
        live = left
    return flat


def score_networks(data: DataFrame, specs: list[Network], flats: list[np.ndarray], n_features: int) -> np.ndarray:
    """counts[model, bin, label] as :func:`score_logistic`."""
    layers = [_layers(f, _shapes(s, n_features)) for s, f in zip(specs, flats)]

    def step(b: pa.RecordBatch) -> np.ndarray:
        x, y, fold = matrix(b.column(0)), (b.column(1).to_numpy() == 1).astype(int), b.column(2).to_numpy()
        out = np.zeros((len(specs), N_THRESHOLDS + 1, 2))
        for i, (s, own) in enumerate(zip(specs, layers)):
            rows = np.ones(len(y), bool) if s.held is None else fold == s.held
            p = 1 / (1 + np.exp(-np.clip(_forward(x[rows], own)[-1][:, 0], -500, 500)))
            out[i] = np.bincount(2 * np.searchsorted(THRESHOLDS, p, side="right") + y[rows], minlength=2 * N_THRESHOLDS + 2).reshape(-1, 2)
        return out.ravel()

    return scan_sums(data, step, len(specs) * (N_THRESHOLDS + 1) * 2).reshape(len(specs), N_THRESHOLDS + 1, 2)


def network_scores(df: DataFrame, spec: Network, flat: np.ndarray, keep=("id",)) -> DataFrame:
    """``keep`` and ``score`` of rows with ``x``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(b.schema.get_field_index("x")))
            z = _forward(x, _layers(flat, _shapes(spec, x.shape[1])))[-1][:, 0]
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in keep], pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))],
                                             names=[*keep, "score"])
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("score", T.DoubleType())])
    return df.select(*dict.fromkeys([*keep, "x"])).mapInArrow(run, schema)
