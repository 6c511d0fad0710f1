"""Cleaning: projections, block lists, missing rows, encoders, deduplication.

A fitted one-hot encoder holds its level lists and applies as column
expressions; label codes are a table that is joined.  Deduplication never gathers a group's ids into one row: groups
are aggregated with bounded outputs (count, min id) and joined back, which
AQE splits when one group is hot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepforge.functions.exprs import col
from prepforge.plans.prefix import null_safe_join, range_rank

# Categories the reference treats as data errors.
UNUSUAL_CLASSES = {"marital_status": ["YOLO", "Absurd", "Alone"]}
# Metadata columns kept only for profit bookkeeping.
METADATA_COLUMNS = ["z_cost_contact", "z_revenue"]
# The reference's hand-set strict bounds (column: (op, value)).
THRESHOLDS = {
    "year_birth": (">", 1920),
    "income": ("<", 153920),
    "mnt_meat": ("<", 1500),
    "mnt_sweet": ("<", 250),
    "mnt_gold": ("<", 290),
    "num_deals": ("<", 14),
    "num_web": ("<", 23),
    "num_catalog": ("<", 21),
    "num_web_visits": ("<", 13),
}


def drop_columns(df: DataFrame, cols=METADATA_COLUMNS) -> DataFrame:
    return df.drop(*cols)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def parse_day(c):
    """``YYYY-MM-DD`` (dashes stripped as in the reference) -> date."""
    return F.to_date(F.regexp_replace(col(c), "-", ""), "yyyyMMdd")


def days_since(df: DataFrame, c: str, ref_date: str, out: str | None = None) -> DataFrame:
    """Whole days from the date in ``c`` to ``ref_date`` (replaces ``c`` unless ``out``)."""
    return df.withColumn(out or c, F.datediff(F.lit(ref_date).cast("date"), parse_day(c)))


def distinct_years(df: DataFrame, c: str) -> DataFrame:
    return df.select(F.year(parse_day(c)).alias("year")).distinct()


def cast_category(df: DataFrame, cols) -> DataFrame:
    """Declare 0/1 flag columns categorical: integer typed."""
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


def drop_unusual_classes(df: DataFrame, block=UNUSUAL_CLASSES) -> DataFrame:
    """Drop rows whose category is blocked; a null category is kept (pandas ``~isin``)."""
    cond = F.lit(True)
    for c, values in block.items():
        cond = cond & ~F.coalesce(F.col(c).isin(list(values)), F.lit(False))
    return df.filter(cond)


def drop_missing(df: DataFrame, subset=None) -> DataFrame:
    return df.na.drop("any", subset=subset)


def threshold_filter(df: DataFrame, bounds=THRESHOLDS) -> DataFrame:
    ops = {">": lambda c, v: c > v, "<": lambda c, v: c < v,
           ">=": lambda c, v: c >= v, "<=": lambda c, v: c <= v}
    cond = F.lit(True)
    for c, (op, v) in bounds.items():
        cond = cond & ops[op](F.col(c), F.lit(v))
    return df.filter(cond)


def key_anti_filter(df: DataFrame, keys: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose key is not in ``keys`` (AQE broadcasts ``keys`` when it is measured small)."""
    return df.join(keys.select(id_col).distinct(), on=id_col, how="left_anti")


def key_semi_filter(df: DataFrame, keys: DataFrame, id_col: str = "id") -> DataFrame:
    return df.join(keys.select(id_col).distinct(), on=id_col, how="left_semi")


def attach_key(rows: DataFrame, other: DataFrame, id_col: str = "id") -> DataFrame:
    return rows.join(other, on=id_col, how="inner")


def align_columns(left: DataFrame, right: DataFrame, id_col: str = "id",
                  how: str = "full_outer") -> DataFrame:
    return left.join(right, on=id_col, how=how)


# ------------------------------------------------------------- encoders
@dataclass
class OneHotModel:
    levels: dict[str, list[str]]
    drop_last: bool = True

    def transform(self, df: DataFrame, keep_source: bool = False) -> DataFrame:
        new = {}
        for c, lv in self.levels.items():
            use = lv[:-1] if self.drop_last else lv
            for v in use:
                new[f"{c}_{v}"] = F.when(F.col(c) == F.lit(v), 1).otherwise(0)
        out = df.withColumns(new)
        return out if keep_source else out.drop(*self.levels)

    def output_columns(self) -> list[str]:
        return [f"{c}_{v}" for c, lv in self.levels.items()
                for v in (lv[:-1] if self.drop_last else lv)]


def fit_one_hot(df: DataFrame, cols, drop_last: bool = True) -> OneHotModel:
    """Sorted levels per column; apply gives one 0/1 column per level but the
    last; an unseen level or null gives all zeros.  The levels become column
    names, so they are known to the driver: one per output column."""
    levels = {c: [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c).collect()]
              for c in cols}
    return OneHotModel(levels, drop_last)


@dataclass
class LabelCodes:
    """Per column a code table (value, code), joined on: any number of levels."""
    codes: dict[str, DataFrame]

    def _mapped(self, df: DataFrame, src: str, dst: str) -> DataFrame:
        out = df
        for c, t in self.codes.items():
            key, val = f"__{c}_k", f"__{c}_v"
            t = t.select(F.col(src).alias(key), F.col(dst).alias(val))
            out = out.join(t, out[c] == t[key], "left").withColumn(c, F.col(val)).drop(key, val)
        return out.select(*df.columns)

    def encode(self, df: DataFrame) -> DataFrame:
        return self._mapped(df, "value", "code")

    def decode(self, df: DataFrame) -> DataFrame:
        return self._mapped(df, "code", "value")


def fit_label_codes(df: DataFrame, cols, id_col: str = "id") -> LabelCodes:
    """Code = order of first appearance, where appearance order is the key order
    (ties by value); a distributed rank, so a column may have any number of levels."""
    codes = {}
    for c in cols:
        first = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.min(id_col).alias("first"))
        codes[c] = range_rank(first, ["first", "value"], out="code").select("value", F.col("code").cast("int"))
    return LabelCodes(codes)


# --------------------------------------------------------- deduplication
def dedupe_exact(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows equal on all non-key columns collapse to one, keeping the smallest key.

    Null equals null (Spark grouping is null-safe); partial aggregation folds a
    hot duplicate group on the map side.
    """
    rest = [c for c in df.columns if c != id_col]
    return df.groupBy(*rest).agg(F.min(id_col).alias(id_col)).select(*df.columns)


def dedupe_check(df: DataFrame, id_col: str = "id") -> DataFrame:
    """One row: row count, distinct non-key row count, and whether they agree."""
    rest = [c for c in df.columns if c != id_col]
    g = df.groupBy(*rest).agg(F.count(F.lit(1)).alias("k"))
    return g.agg(F.coalesce(F.sum("k"), F.lit(0)).cast("long").alias("n_rows"),
                 F.count(F.lit(1)).cast("long").alias("n_distinct")) \
        .withColumn("is_unique", F.col("n_rows") == F.col("n_distinct"))


def duplicate_groups(df: DataFrame, cols, id_col: str = "id") -> DataFrame:
    """One row per distinct value tuple of ``cols``: size, first and last key."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"),
                                 F.min(id_col).alias("first_id"),
                                 F.max(id_col).alias("last_id"))


def group_membership(df: DataFrame, cols, id_col: str = "id") -> DataFrame:
    """Long form of the groups: (id, group_id = smallest key in the group, group_size)."""
    g = df.groupBy(*cols).agg(F.min(id_col).alias("group_id"),
                              F.count(F.lit(1)).alias("group_size"))
    return null_safe_join(df.select(id_col, *cols), g, list(cols)).select(
        id_col, "group_id", "group_size")


def group_intersect(df: DataFrame, cols_a, cols_b, id_col: str = "id") -> DataFrame:
    """Keys whose group under ``cols_a`` is the same id set as under ``cols_b``.

    Two groups are equal iff their overlap has the size of both, so only
    bounded aggregates are needed: (group_a, group_b) pair counts and sizes.
    """
    a = group_membership(df, cols_a, id_col).withColumnsRenamed(
        {"group_id": "ga", "group_size": "na"})
    b = group_membership(df, cols_b, id_col).withColumnsRenamed(
        {"group_id": "gb", "group_size": "nb"})
    m = a.join(b, id_col)
    pair = m.groupBy("ga", "gb").agg(F.count(F.lit(1)).alias("nab"))
    m = m.join(pair, ["ga", "gb"])
    return m.where((F.col("nab") == F.col("na")) & (F.col("nab") == F.col("nb"))) \
        .select(id_col, F.col("ga").alias("group_id"))


def drop_label_conflicts(df: DataFrame, label_col: str, id_col: str = "id") -> DataFrame:
    """Keep rows whose duplicate group (all columns but key and label) agrees on
    the label; a null label counts as its own value (the reference fills -1)."""
    feats = [c for c in df.columns if c not in (id_col, label_col)]
    lab = F.coalesce(F.col(label_col).cast("long"), F.lit(-1))
    ok = (df.groupBy(*feats).agg(F.min(lab).alias("lo"), F.max(lab).alias("hi"))
          .where(F.col("lo") == F.col("hi")).drop("lo", "hi"))
    return null_safe_join(df, ok, feats, how="left_semi")
