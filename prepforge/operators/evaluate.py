"""Evaluation: confusion counts, profit curve, ROC points, exact AUROC, class report.

Everything is an aggregation over (label, score) rows.  The profit curve is
one pass with two ``count_if`` per threshold; ROC and AUROC group rows by
distinct score first (a hot score value collapses to one row) and then use
the bucketed running sum of :mod:`prepforge.plans.prefix`, so no step puts
all rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepforge.plans.prefix import running_sums

# Fixed values of the reference's profit model: revenue per accepted offer,
# cost per contact, and the threshold grid 0, 0.025, ..., 0.975.
REVENUE = 11
COST = 3
N_THRESHOLDS = 40
STEP = 0.025


def thresholds(n: int = N_THRESHOLDS, step: float = STEP) -> list[float]:
    return [i * step for i in range(n)]


def confusion(df: DataFrame, label_col: str, score_col: str, t: float) -> DataFrame:
    """tn, fp, fn, tp with ``score >= t`` predicted positive (always four counts)."""
    pos = F.col(score_col) >= F.lit(t)
    y = F.col(label_col) == 1
    return df.agg(F.count_if(~pos & ~y).alias("tn"), F.count_if(pos & ~y).alias("fp"),
                  F.count_if(~pos & y).alias("fn"), F.count_if(pos & y).alias("tp"))


def profit_curve(df: DataFrame, label_col: str, score_col: str, revenue: int = REVENUE,
                 cost: int = COST, n: int = N_THRESHOLDS, step: float = STEP) -> DataFrame:
    """Per threshold: tp, fp and profit = revenue*tp - cost*(tp + fp), from one pass."""
    ts = thresholds(n, step)
    y = F.col(label_col) == 1
    s = F.col(score_col)
    aggs = []
    for i, t in enumerate(ts):
        aggs += [F.count_if((s >= F.lit(t)) & y).alias(f"tp{i}"),
                 F.count_if((s >= F.lit(t)) & ~y).alias(f"fp{i}")]
    wide = df.agg(*aggs, F.count_if(y).alias("n_pos"))
    stack = ", ".join(f"{i}, tp{i}, fp{i}" for i in range(n))
    long = wide.selectExpr(f"stack({n}, {stack}) AS (i, tp, fp)", "n_pos")
    return long.select(
        (F.col("i").cast("double") * F.lit(step)).alias("threshold"),
        F.col("tp"), F.col("fp"), F.col("n_pos"),
        (F.lit(revenue) * F.col("tp") - F.lit(cost) * (F.col("tp") + F.col("fp"))).alias("profit"))


def best_profit(curve: DataFrame, revenue: int = REVENUE, cost: int = COST) -> DataFrame:
    """First threshold with maximal profit; ratio = profit / (positives * (revenue - cost))."""
    top = curve.orderBy(F.col("profit").desc(), F.col("threshold")).limit(1)
    return top.select(F.col("threshold").alias("best_threshold"),
                      F.col("profit").alias("best_profit"),
                      F.try_divide(F.col("profit").cast("double"),
                                   (F.col("n_pos") * (revenue - cost)).cast("double"))
                      .alias("best_profit_ratio"))


def profit_score(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """The reference's tuning metric: best profit ratio of hard 0/1 predictions."""
    return best_profit(profit_curve(df, label_col, pred_col)).select("best_profit_ratio")


def _score_counts(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    y = F.col(label_col) == 1
    return df.groupBy(score_col).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))


def roc_points(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    """(score, tp, fp, tpr, fpr) for each distinct score, taking ``score >= s`` as positive."""
    g = _score_counts(df, label_col, score_col)
    t = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()  # two numbers
    P, N = float(t["P"] or 0), float(t["N"] or 0)
    cum = running_sums(g, score_col, ["pos", "neg"], descending=True)
    return cum.select(score_col, F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"),
                      F.try_divide(F.col("pos_cum").cast("double"), F.lit(P)).alias("tpr"),
                      F.try_divide(F.col("neg_cum").cast("double"), F.lit(N)).alias("fpr"))


def auroc(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    """Exact area under the ROC curve with ties counted half (Mann-Whitney)."""
    g = _score_counts(df, label_col, score_col)
    cum = running_sums(g, score_col, ["neg"], inclusive=False,
                       suffix="_below")
    return cum.agg(
        F.try_divide(F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") * 0.5)),
                     F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auroc"))


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def class_report(df: DataFrame, label_col: str, score_col: str, t: float) -> DataFrame:
    """Precision, recall, F1 and support per class plus micro, macro and
    weighted averages, flattened to one row; empty denominators give 0."""
    cm = confusion(df, label_col, score_col, t)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    m = {
        "c1_precision": _div(tp, tp + fp), "c1_recall": _div(tp, tp + fn),
        "c0_precision": _div(tn, tn + fn), "c0_recall": _div(tn, tn + fp),
        "c1_support": tp + fn, "c0_support": tn + fp,
    }
    out = cm.withColumns(m)
    f1 = {f"c{k}_f1": _div(2 * F.col(f"c{k}_precision") * F.col(f"c{k}_recall"),
                           F.col(f"c{k}_precision") + F.col(f"c{k}_recall")) for k in (0, 1)}
    out = out.withColumns(f1)
    acc = _div(tp + tn, n)
    avg = {"micro_precision": acc, "micro_recall": acc, "micro_f1": acc, "micro_support": n}
    for stat in ("precision", "recall", "f1"):
        a, b = F.col(f"c0_{stat}"), F.col(f"c1_{stat}")
        avg[f"macro_{stat}"] = (a + b) / 2
        avg[f"weighted_{stat}"] = _div(a * F.col("c0_support") + b * F.col("c1_support"), n)
    avg["macro_support"] = n
    avg["weighted_support"] = n
    return out.withColumns(avg).drop("tn", "fp", "fn", "tp")


def grouped_metrics(scored: DataFrame, keys, label_col: str = "y", score_col: str = "s", revenue: int = REVENUE, cost: int = COST,
                    n: int = N_THRESHOLDS, step: float = STEP) -> list[dict]:
    """For each group of ``keys`` what profit curve, class report at the best threshold and AUROC say, in two
    passes for all groups. One row a group reaches the driver."""
    keys, y, s = list(keys), F.col(label_col) == 1, F.col(score_col)
    aggs = [F.count_if((s >= F.lit(t)) & c).alias(f"{k}{i}") for i, t in enumerate(thresholds(n, step)) for k, c in (("tp", y), ("fp", ~y))]
    wide = scored.groupBy(*keys).agg(*aggs, F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")).collect()
    cells = scored.groupBy(*keys, score_col).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    cum = running_sums(cells, score_col, ["neg"], group_cols=keys, inclusive=False, suffix="_below")
    area = {tuple(r[k] for k in keys): r["auroc"] for r in cum.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") * 0.5)),
                     F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auroc")).collect()}
    share = lambda a, b: a / b if b else 0.0
    out = []
    for r in wide:
        profit = [revenue * r[f"tp{i}"] - cost * (r[f"tp{i}"] + r[f"fp{i}"]) for i in range(n)]
        i = profit.index(max(profit))
        tp, fp = r[f"tp{i}"], r[f"fp{i}"]
        p, c = share(tp, tp + fp), share(tp, r["pos"])
        out.append({**{k: r[k] for k in keys}, "auroc": area[tuple(r[k] for k in keys)], "best_threshold": i * step, "best_profit": float(profit[i]),
                    "best_profit_ratio": share(profit[i], r["pos"] * (revenue - cost)) if r["pos"] else None,
                    "precision": p, "recall": c, "f1_score": share(2 * p * c, p + c)})
    return out
