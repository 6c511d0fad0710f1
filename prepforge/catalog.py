"""Registry of named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver tables through the ``c360`` customer view (or
straight from ``lineitem``) and runs the library operator on all rows.  The
frames below are the stages of the reference's load/prepare path:

    base      c360 as loaded
    cleaned   metadata dropped, blocked classes dropped, rows with a null
              dropped, ``dt_customer`` turned into ``num_days_customer``
    featured  cleaned + business features
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepforge.functions.exprs import is_numeric, minmax_expr, safe_ratio
from prepforge.operators import clean as C
from prepforge.operators import features as FE
from prepforge.operators import profile as P
from prepforge.operators import scale as S
from prepforge.plans.prefix import written
from prepforge.session import ensure_checkpoint_dir
from prepforge.sources import io as IO
from prepforge.sources.tables import (C360_FLAGS, COUNT_COLS, REF_DATE, SPEND_COLS, c360,
                                      c360_materialized,
                                      read_table)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

REF_YEAR = int(REF_DATE[:4])
LABEL = "response"
NUMERIC = ["year_birth", "income", "kidhome", "teenhome", "num_days_customer", "recency",
           *SPEND_COLS, *COUNT_COLS]
FEATURED_NUMERIC = NUMERIC + [c for c in FE.BUSINESS_FEATURES]
DUP_COLS = ["education", "marital_status", "kidhome", "teenhome"]


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


# ------------------------------------------------------------------ stages
def base(spark, sf) -> DataFrame:
    return c360_materialized(spark, sf)


def cleaned(spark, sf) -> DataFrame:
    df = C.drop_columns(base(spark, sf))
    df = C.drop_unusual_classes(df)
    df = C.drop_missing(df)
    df = C.days_since(df, "dt_customer", REF_DATE)
    return C.rename_column(df, "dt_customer", "num_days_customer")


def featured(spark, sf) -> DataFrame:
    return FE.business_features(cleaned(spark, sf), REF_YEAR)


def scratch_path(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


# ------------------------------------------------------- 2.1 scans / sinks
@query("c360")
def q_c360(spark, sf):
    return c360(spark, sf)


@query("scan_table")
def q_scan_table(spark, sf):
    return IO.scan_table(spark, f"{sf.rstrip('/')}/customer.parquet", IO.CUSTOMER_SCHEMA,
                         key=("c_custkey", "id"))


@query("sink_csv")
def q_sink_csv(spark, sf):
    df = cleaned(spark, sf)
    path = scratch_path(spark, "prepared")
    IO.sink_csv(df, path)
    return IO.scan_csv(spark, path, df.schema)


@query("scan_csv")
def q_scan_csv(spark, sf):
    df = featured(spark, sf).select("id", "response", *FE.BUSINESS_FEATURES)
    path = scratch_path(spark, "train")
    IO.sink_csv(df, path)
    return IO.scan_csv(spark, path, df.schema)


# ------------------------------------------------- 2.2 projections / scalars
@query("drop_columns")
def q_drop_columns(spark, sf):
    return C.drop_columns(base(spark, sf))


@query("rename_column")
def q_rename_column(spark, sf):
    return C.rename_column(base(spark, sf).select("id", "dt_customer"), "dt_customer",
                           "customer_since")


@query("days_since")
def q_days_since(spark, sf):
    return C.days_since(base(spark, sf).select("id", "dt_customer"), "dt_customer", REF_DATE,
                        out="num_days_customer")


@query("distinct_years")
def q_distinct_years(spark, sf):
    return C.distinct_years(base(spark, sf), "dt_customer")


@query("cast_category")
def q_cast_category(spark, sf):
    return C.cast_category(base(spark, sf).select("id", *C360_FLAGS, LABEL), C360_FLAGS + [LABEL])


@query("one_hot")
def q_one_hot(spark, sf):
    df = cleaned(spark, sf)
    m = C.fit_one_hot(df, ["education", "marital_status"])
    return m.transform(df.select("id", "education", "marital_status"))


@query("label_encode")
def q_label_encode(spark, sf):
    df = base(spark, sf).select("id", "education", "marital_status")
    return C.fit_label_codes(df, ["education", "marital_status"]).encode(df)


@query("label_decode")
def q_label_decode(spark, sf):
    df = base(spark, sf).select("id", "education", "marital_status")
    codes = C.fit_label_codes(df, ["education", "marital_status"])
    return codes.decode(codes.encode(df))


@query("safe_ratio")
def q_safe_ratio(spark, sf):
    df = base(spark, sf)
    return df.select("id", safe_ratio("num_web", "num_web_visits").alias("web_per_visit"),
                     safe_ratio("mnt_wines", "income").alias("wines_per_income"),
                     safe_ratio("num_deals", "num_store").alias("deals_per_store"))


@query("business_features")
def q_business_features(spark, sf):
    return featured(spark, sf)


@query("fill_nonfinite")
def q_fill_nonfinite(spark, sf):
    df = base(spark, sf).select("id", "income", *SPEND_COLS, *COUNT_COLS, "recency")
    df = df.withColumn("wines_per_income", F.try_divide("mnt_wines", "income"))
    return FE.fill_nonfinite(df)


@query("power_features")
def q_power_features(spark, sf):
    df = cleaned(spark, sf)
    scaled = S.fit_minmax(df, NUMERIC).transform(df.select("id", *NUMERIC))
    return FE.power_features(scaled, NUMERIC).drop(*NUMERIC)


# ------------------------------------------------------------- 2.3 filters
@query("drop_unusual_classes")
def q_drop_unusual_classes(spark, sf):
    return C.drop_unusual_classes(base(spark, sf).select("id", "marital_status"))


@query("drop_missing")
def q_drop_missing(spark, sf):
    return C.drop_missing(base(spark, sf))


# c360 spend is a sum of extended prices: its spend bounds are the reference's
# times this many units.
SPEND_UNIT = 4000
C360_THRESHOLDS = {k: (op, v * SPEND_UNIT if k.startswith("mnt_") else v) for k, (op, v) in C.THRESHOLDS.items()}


@query("threshold_filter")
def q_threshold_filter(spark, sf):
    return C.threshold_filter(cleaned(spark, sf), C360_THRESHOLDS).select("id", *C360_THRESHOLDS)


# ------------------------------------------------------ 2.4 / 2.5 joins, dedupe
def _dup_frame(spark, sf, label=False):
    return base(spark, sf).select("id", *DUP_COLS, *([LABEL] if label else []))


@query("attach_key")
def q_attach_key(spark, sf):
    kept = C.dedupe_exact(_dup_frame(spark, sf))
    return C.attach_key(kept.select("id"), base(spark, sf).select("id", "income", "recency"))


@query("align_columns")
def q_align_columns(spark, sf):
    df = cleaned(spark, sf)
    dummies = C.fit_one_hot(df, ["education"]).transform(df.select("id", "education"))
    return C.align_columns(dummies, base(spark, sf).select("id", "income"))


@query("dedupe_exact")
def q_dedupe_exact(spark, sf):
    return C.dedupe_exact(_dup_frame(spark, sf))


@query("dedupe_check")
def q_dedupe_check(spark, sf):
    return C.dedupe_check(_dup_frame(spark, sf))


@query("duplicate_groups")
def q_duplicate_groups(spark, sf):
    return C.duplicate_groups(_dup_frame(spark, sf), DUP_COLS)


@query("group_membership")
def q_group_membership(spark, sf):
    """The duplicate groups as rows (id, group_id, group_size)."""
    return C.group_membership(_dup_frame(spark, sf), DUP_COLS)


@query("drop_label_conflicts")
def q_drop_label_conflicts(spark, sf):
    return C.drop_label_conflicts(_dup_frame(spark, sf, label=True), LABEL)


@query("group_intersect")
def q_group_intersect(spark, sf):
    df = _dup_frame(spark, sf, label=True)
    return C.group_intersect(df, DUP_COLS + [LABEL], DUP_COLS)


# -------------------------------------------------------------- 2.6 profile
PROFILE_COLS = ["income", "recency", "year_birth", *SPEND_COLS, *COUNT_COLS]


@query("describe_numeric")
def q_describe_numeric(spark, sf):
    return P.describe_numeric(base(spark, sf), PROFILE_COLS)


@query("describe_by_group")
def q_describe_by_group(spark, sf):
    return P.describe_by_group(base(spark, sf), PROFILE_COLS, "education")


@query("describe_by_marital")
def q_describe_by_marital(spark, sf):
    """A group column with nulls: null is a group."""
    return P.describe_by_group(base(spark, sf), PROFILE_COLS, "marital_status")


@query("missing_report")
def q_missing_report(spark, sf):
    return P.missing_report(base(spark, sf))


@query("value_counts")
def q_value_counts(spark, sf):
    return P.value_counts(base(spark, sf), "marital_status")


@query("response_rate")
def q_response_rate(spark, sf):
    return P.response_rate(base(spark, sf), LABEL)


@query("five_number_by_label")
def q_five_number_by_label(spark, sf):
    return P.five_number_by_label(cleaned(spark, sf), NUMERIC, LABEL)


@query("crosstab_shares")
def q_crosstab_shares(spark, sf):
    return P.crosstab_shares(cleaned(spark, sf), "education", LABEL)


@query("group_average")
def q_group_average(spark, sf):
    return P.group_average(featured(spark, sf), "education",
                           ["total_money_spent", "effort_rate", "age", "income_per_person"])


@query("corr_with_label")
def q_corr_with_label(spark, sf):
    return P.corr_with_label(featured(spark, sf), FEATURED_NUMERIC, LABEL)


@query("corr_matrix")
def q_corr_matrix(spark, sf):
    return P.corr_matrix(cleaned(spark, sf), NUMERIC)


@query("top_k")
def q_top_k(spark, sf):
    df = cleaned(spark, sf)
    m = S.fit_minmax(df, ["income"])
    side = df.select("id", "income", minmax_expr("income", *m.bounds["income"]).alias("income_scaled"))
    return P.top_k(side, "income", 300, extra=["income_scaled"])


# --------------------------------------------------------- the minimum slice
@query("minimum_slice")
def q_minimum_slice(spark, sf):
    df = featured(spark, sf)
    return S.fit_minmax(df, FEATURED_NUMERIC).transform(df)


# ------------------------------------------- numeric operators over lineitem
LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lines(spark, sf) -> DataFrame:
    """All rows of lineitem: id, the four numeric columns, returned (0/1), shipment year."""
    return read_table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), *LINE_COLS,
        (F.col("l_returnflag") == "R").cast("int").alias(LABEL), F.year("l_shipdate").alias("year"))


@query("describe_lines")
def q_describe_lines(spark, sf):
    return P.describe_numeric(lines(spark, sf), LINE_COLS, digits=4)


@query("five_number_lines")
def q_five_number_lines(spark, sf):
    return P.five_number_by_label(lines(spark, sf), LINE_COLS, "year")


# ------------------------------------------------------------ 2.15 evaluation
from prepforge.operators import evaluate as EV  # noqa: E402


def scored(spark, sf) -> DataFrame:
    """cleaned rows with a ranking score: recency min-max scaled, 3 digits (ties on purpose)."""
    df = cleaned(spark, sf)
    m = S.fit_minmax(df, ["recency"])
    return df.select("id", LABEL, F.round(minmax_expr("recency", *m.bounds["recency"]), 3)
                     .alias("score"))


def _best_threshold(df) -> float:
    return float(EV.best_profit(EV.profit_curve(df, LABEL, "score")).first()["best_threshold"])


@query("confusion")
def q_confusion(spark, sf):
    return EV.confusion(scored(spark, sf), LABEL, "score", 0.5)


@query("profit_curve")
def q_profit_curve(spark, sf):
    return EV.profit_curve(scored(spark, sf), LABEL, "score")


@query("best_profit")
def q_best_profit(spark, sf):
    return EV.best_profit(EV.profit_curve(scored(spark, sf), LABEL, "score"))


@query("profit_score")
def q_profit_score(spark, sf):
    df = scored(spark, sf).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    return EV.profit_score(df, LABEL, "pred")


@query("roc_points")
def q_roc_points(spark, sf):
    return EV.roc_points(scored(spark, sf), LABEL, "score")


@query("auroc")
def q_auroc(spark, sf):
    return EV.auroc(scored(spark, sf), LABEL, "score")


@query("class_report")
def q_class_report(spark, sf):
    df = scored(spark, sf)
    return EV.class_report(df, LABEL, "score", _best_threshold(df))


@query("auroc_lines")
def q_auroc_lines(spark, sf):
    return EV.auroc(lines(spark, sf), LABEL, "l_extendedprice")


@query("roc_lines")
def q_roc_lines(spark, sf):
    return EV.roc_points(lines(spark, sf), LABEL, "l_quantity")


# ------------------------------------------------- 2.7 / 2.9 outliers, votes
from prepforge.operators import outliers as O  # noqa: E402

VOTE_THRESHOLD = 0.5


def _num(spark, sf):
    return cleaned(spark, sf).select("id", *NUMERIC)


@query("outlier_std_null")
def q_outlier_std_null(spark, sf):
    return O.outlier_std_null(_num(spark, sf), NUMERIC)


@query("outlier_zscore")
def q_outlier_zscore(spark, sf):
    return O.outlier_zscore(_num(spark, sf), NUMERIC, 3.0).withColumn("score", F.round("score", 6))


@query("outlier_boxplot")
def q_outlier_boxplot(spark, sf):
    return O.outlier_boxplot(_num(spark, sf), NUMERIC)


@query("outlier_boxplot_all")
def q_outlier_boxplot_all(spark, sf):
    return O.outlier_boxplot_all(_num(spark, sf), NUMERIC).withColumn("dist", F.round("dist", 6))


@query("outlier_robust_z")
def q_outlier_robust_z(spark, sf):
    return O.outlier_robust_z(_num(spark, sf), NUMERIC, 5.0)


@query("boxplot_lines")
def q_boxplot_lines(spark, sf):
    """All flags: the columns are nearly even and symmetric, so a top share would cut through
    ties of either side. No value lies beyond 1.5 ranges, so 0.4."""
    out = O.outlier_boxplot_all(lines(spark, sf), LINE_COLS, 0.4)
    return out.select("id", "var", F.round("dist", 4).alias("dist"))


@query("robust_z_lines")
def q_robust_z_lines(spark, sf):
    return O.outlier_robust_z(lines(spark, sf), LINE_COLS, 1.5)


@query("outlier_iqr_scores")
def q_outlier_iqr_scores(spark, sf):
    return O.outlier_iqr_scores(featured(spark, sf), "total_money_spent")


def _votable(spark, sf):
    """:func:`_num` written once: the detectors and the smoothing scan it some twenty times, and the view's checkpoint
    holds whole rows, which every scan would read and clean again."""
    return written(_num(spark, sf), "votable")


def vote_flags(df):
    """The detectors' flags, written once: votes, thresholds and smoothing read them again."""
    return written(O.per_column_flags("zscore", O.outlier_zscore(df, NUMERIC, 3.0))
            .unionByName(O.per_column_flags("robust_z", O.outlier_robust_z(df, NUMERIC, 5.0)))
            .unionByName(O.whole_row_flags("boxplot", O.outlier_boxplot(df, NUMERIC))), "flags")


@query("outlier_votes")
def q_outlier_votes(spark, sf):
    return O.outlier_votes(vote_flags(_votable(spark, sf))).withColumn("score", F.round("score", 6))


@query("outlier_info")
def q_outlier_info(spark, sf):
    return O.outlier_info(vote_flags(_votable(spark, sf)))


@query("outlier_vote_drop")
def q_outlier_vote_drop(spark, sf):
    df = _votable(spark, sf)
    return O.outlier_vote_drop(df, O.outlier_votes(vote_flags(df)), VOTE_THRESHOLD)


@query("outlier_vote_info")
def q_outlier_vote_info(spark, sf):
    df = _votable(spark, sf)
    flags = vote_flags(df)
    return O.outlier_vote_info(flags, O.outlier_votes(flags), VOTE_THRESHOLD)


@query("outlier_smooth")
def q_outlier_smooth(spark, sf):
    df = _votable(spark, sf)
    flags = vote_flags(df)
    out = O.outlier_smooth(df, flags, O.outlier_votes(flags), VOTE_THRESHOLD, NUMERIC)
    return out.select("id", *[F.round(c, 6).alias(c) for c in NUMERIC])


# ---------------------------------------------------- 2.10 impute and scale
IMPUTE_COLS = ["income", *SPEND_COLS]  # the nullable numeric columns


@query("impute_numeric")
def q_impute_numeric(spark, sf):
    df = base(spark, sf).select("id", *IMPUTE_COLS)
    return S.fit_impute_numeric(df, IMPUTE_COLS, "auto").transform(df)


@query("impute_mean")
def q_impute_mean(spark, sf):
    df = base(spark, sf).select("id", *IMPUTE_COLS)
    out = S.fit_impute_numeric(df, IMPUTE_COLS, "mean").transform(df)
    return out.select("id", *[F.round(c, 6).alias(c) for c in IMPUTE_COLS])


@query("impute_median")
def q_impute_median(spark, sf):
    df = base(spark, sf).select("id", *IMPUTE_COLS)
    return S.fit_impute_numeric(df, IMPUTE_COLS, "median").transform(df)


@query("impute_mode")
def q_impute_mode(spark, sf):
    df = base(spark, sf).select("id", "marital_status", "response")
    return S.fit_impute_mode(df, ["marital_status", "response"]).transform(df)


@query("minmax_scale")
def q_minmax_scale(spark, sf):
    df = _num(spark, sf)
    return S.fit_minmax(df, NUMERIC).transform(df)


@query("standard_scale_subset")
def q_standard_scale_subset(spark, sf):
    df = cleaned(spark, sf).select("id", *NUMERIC, *C360_FLAGS)
    out = S.fit_standard(df, NUMERIC + C360_FLAGS, exclude=C360_FLAGS).transform(df)
    return out.select("id", *C360_FLAGS, *[F.round(c, 6).alias(c) for c in NUMERIC])


@query("yeo_johnson")
def q_yeo_johnson(spark, sf):
    df = _num(spark, sf)
    return S.fit_yeo_johnson(df, NUMERIC).transform(df)


@query("bin_uniform")
def q_bin_uniform(spark, sf):
    df = _num(spark, sf)
    return FE.fit_uniform_bins(df, NUMERIC).transform(df).select(
        "id", *[f"{c}_bin" for c in NUMERIC])


# ------------------------------------------------- 2.11 / 2.12 selection
from prepforge.operators import select as SEL  # noqa: E402


def _feat(spark, sf):
    return featured(spark, sf)


@query("select_constant")
def q_select_constant(spark, sf):
    return SEL.select_constant(_feat(spark, sf), FEATURED_NUMERIC)


@query("rank_chi2")
def q_rank_chi2(spark, sf):
    return SEL.rank_chi2(_feat(spark, sf), FEATURED_NUMERIC, C360_FLAGS, LABEL)


@query("chi2_pvalues")
def q_chi2_pvalues(spark, sf):
    return SEL.chi2_pvalues(SEL.rank_chi2(_feat(spark, sf), FEATURED_NUMERIC, C360_FLAGS, LABEL))


@query("rank_linear")
def q_rank_linear(spark, sf):
    return SEL.rank_linear(_feat(spark, sf), FEATURED_NUMERIC, LABEL)


@query("rank_linear_pvalues")
def q_rank_linear_pvalues(spark, sf):
    return SEL.rank_linear(_feat(spark, sf), FEATURED_NUMERIC, LABEL, with_p=True)


@query("rank_fisher")
def q_rank_fisher(spark, sf):
    return SEL.rank_fisher(_feat(spark, sf), FEATURED_NUMERIC, LABEL)


@query("rank_anova_f")
def q_rank_anova_f(spark, sf):
    return SEL.rank_anova_f(_feat(spark, sf), FEATURED_NUMERIC, LABEL)


@query("rank_anova_f_pvalues")
def q_rank_anova_f_pvalues(spark, sf):
    return SEL.rank_anova_f(_feat(spark, sf), FEATURED_NUMERIC, LABEL, with_p=True)


@query("info_gain_splits")
def q_info_gain_splits(spark, sf):
    return SEL.info_gain_splits(_feat(spark, sf), "recency", LABEL)


@query("rank_info_gain")
def q_rank_info_gain(spark, sf):
    return SEL.rank_info_gain(_feat(spark, sf), FEATURED_NUMERIC, LABEL)


@query("chi2_lines")
def q_chi2_lines(spark, sf):
    return SEL.rank_chi2(lines(spark, sf), LINE_COLS, ["year"], LABEL)


@query("info_gain_lines")
def q_info_gain_lines(spark, sf):
    return SEL.rank_info_gain(lines(spark, sf), LINE_COLS, LABEL)


def _selector_picks(df, n=10):
    chi = SEL.rank_chi2(df, FEATURED_NUMERIC, C360_FLAGS, LABEL)
    return (SEL.top_n(chi, "chi2", n, "chi2")
            .unionByName(SEL.top_n(SEL.rank_fisher(df, FEATURED_NUMERIC, LABEL), "fisher", n, "fisher"))
            .unionByName(SEL.top_n(SEL.rank_anova_f(df, FEATURED_NUMERIC, LABEL), "f", n, "anova"))
            .unionByName(SEL.top_n(P.corr_with_label(df, FEATURED_NUMERIC, LABEL), "abs_corr", n, "corr")))


@query("select_by_votes")
def q_select_by_votes(spark, sf):
    return SEL.select_by_votes(_selector_picks(_feat(spark, sf)), 4, 0.5)


@query("select_uncorrelated")
def q_select_uncorrelated(spark, sf):
    df = _feat(spark, sf)
    return SEL.select_uncorrelated(P.corr_with_label(df, FEATURED_NUMERIC, LABEL),
                                   P.corr_matrix(df, FEATURED_NUMERIC))


@query("best_power_transform")
def q_best_power_transform(spark, sf):
    df = cleaned(spark, sf)
    model, scores = FE.fit_best_power(df, NUMERIC, LABEL)
    return spark.createDataFrame([(c, t) for c, t in model.best.items()],
                                 "feature string, transform string")


@query("best_power_apply")
def q_best_power_apply(spark, sf):
    df = cleaned(spark, sf)
    model, _ = FE.fit_best_power(df, NUMERIC, LABEL)
    return model.transform(df.select("id", *NUMERIC))


# ------------------------------------------------- 2.13 / 2.14 splits, models
from prepforge.operators import models as M  # noqa: E402
from prepforge.operators import runner as RUN  # noqa: E402
from prepforge.operators import sample as SA  # noqa: E402
from prepforge.operators import tuning as TU  # noqa: E402
from prepforge.plans import boost as BO  # noqa: E402
from prepforge.plans import prepare as PR  # noqa: E402
from prepforge.plans import shared as SH  # noqa: E402
from prepforge.plans import trees as TR  # noqa: E402

MODEL_COLS = NUMERIC + C360_FLAGS
SEED = 0


_MEMO: dict = {}


def memo(spark, sf, name, build):
    """Per application and folder, build once and keep the checkpointed result."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"), name)
    if key not in _MEMO:
        ensure_checkpoint_dir(spark)
        _MEMO[key] = build()
    return _MEMO[key]


def model_data(spark, sf, seed: int = SEED):
    """cleaned rows, stratified 80/20 split, min-max fitted on train, assembled."""
    def build():
        df = SA.split_stratified(cleaned(spark, sf), LABEL, 0.2, seed)
        train = df.where(F.col("split") == "train")
        mm = S.fit_minmax(train, NUMERIC)
        out = M.assemble(mm.transform(df), MODEL_COLS, LABEL, keep=["id", "split"]).checkpoint()
        return (out.where(F.col("split") == "train").drop("split"),
                out.where(F.col("split") == "test").drop("split"))
    return memo(spark, sf, f"model_data{seed}", build)


def _scores(model, test, prob=True):
    out = model.transform(test)
    s = M.positive_prob() if prob else vector_to_array_raw(out)
    return out.select("id", F.col(M.LABEL).alias("response"), s.alias("score"), "prediction")


def vector_to_array_raw(out):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col("rawPrediction")).getItem(1)


@query("split_stratified")
def q_split_stratified(spark, sf):
    return SA.split_stratified(cleaned(spark, sf).select("id", LABEL), LABEL, 0.2, SEED)


@query("split_random")
def q_split_random(spark, sf):
    return SA.split_random(cleaned(spark, sf).select("id", LABEL), 0.2, SEED)


@query("kfold_stratified")
def q_kfold_stratified(spark, sf):
    return SA.kfold_stratified(cleaned(spark, sf).select("id", LABEL), LABEL, 5, SEED)


@query("split_counts")
def q_split_counts(spark, sf):
    """Rows of each label in either part of the stratified split."""
    s = SA.split_stratified(cleaned(spark, sf).select("id", LABEL), LABEL, 0.2, SEED)
    return s.groupBy(LABEL).agg(F.count_if(F.col("split") == "test").alias("test"),
                                F.count_if(F.col("split") == "train").alias("train"))


@query("fold_counts")
def q_fold_counts(spark, sf):
    """Rows of each label in each fold."""
    return SA.kfold_stratified(cleaned(spark, sf).select("id", LABEL), LABEL, 5, SEED).groupBy(LABEL, "fold").agg(
        F.count(F.lit(1)).alias("n"))


def _n(train):
    return train.count()


def shared_rows(spark, sf):
    """(training rows with folds, test rows) as arrays, the columns and bounds of :func:`model_data`."""
    def build():
        df = SA.split_stratified(cleaned(spark, sf), LABEL, 0.2, SEED)
        train, test = (df.where(F.col("split") == v).drop("split") for v in ("train", "test"))
        mm = S.fit_minmax(train, NUMERIC)
        return (TU.folded(mm.transform(train), MODEL_COLS, LABEL, 5, SEED),
                SH.training_rows(mm.transform(test), MODEL_COLS, LABEL, id_col="id"))
    return memo(spark, sf, "shared_rows", build)


def _tuned(spark, sf, what):
    """The reference's grid of one kind of model on the training rows, searched once per application."""
    return memo(spark, sf, f"tuned_{what.__name__}", lambda: what(shared_rows(spark, sf)[0], len(MODEL_COLS)))


def _array_scores(test, trees, edges):
    out = TR.forest_scores(test, trees, edges, keep=["id", "y"])
    return out.select("id", F.col("y").alias("response"), "score", (F.col("score") > 0.5).cast("double").alias("prediction"))


@query("fit_logistic")
def q_fit_logistic(spark, sf):
    _, w = _tuned(spark, sf, TU.tune_logistic)
    return SH.logistic_scores(shared_rows(spark, sf)[1], w, ["id", F.col("y").alias("response")])


@query("fit_tree")
def q_fit_tree(spark, sf):
    _, tree, edges = _tuned(spark, sf, TU.tune_tree)
    return _array_scores(shared_rows(spark, sf)[1], [tree], edges)


@query("tune_tree")
def q_tune_tree(spark, sf):
    return TU.report(spark, _tuned(spark, sf, TU.tune_tree)[0])


@query("tune_extra_trees")
def q_tune_extra_trees(spark, sf):
    return TU.report(spark, _tuned(spark, sf, TU.tune_extra_trees)[0])


@query("fit_complement_nb")
def q_fit_complement_nb(spark, sf):
    train, test = model_data(spark, sf)
    return _scores(M.complement_nb(1.0).fit(M.clip_features(train)), M.clip_features(test))


@query("fit_random_trees")
def q_fit_random_trees(spark, sf):
    _, trees, edges = _tuned(spark, sf, TU.tune_extra_trees)
    return _array_scores(shared_rows(spark, sf)[1], trees, edges)


@query("fit_gbt")
def q_fit_gbt(spark, sf):
    train, test = model_data(spark, sf)
    return _scores(M.gbt(2, 0.1, 50).fit(train), test)


@query("tune_boosted")
def q_tune_boosted(spark, sf):
    """All 12 settings of the reference's second-order boosted trees."""
    return TU.report(spark, _tuned(spark, sf, TU.tune_boosted)[0])


@query("fit_boosted")
def q_fit_boosted(spark, sf):
    _, spec, trees, edges = _tuned(spark, sf, TU.tune_boosted)
    out = BO.boosted_scores(shared_rows(spark, sf)[1], spec, trees, edges, ["id", "y"])
    return out.select("id", F.col("y").alias("response"), "score", (F.col("score") > 0.5).cast("double").alias("prediction"))


@query("fit_mlp")
def q_fit_mlp(spark, sf):
    _, spec, w = _tuned(spark, sf, TU.tune_network)
    out = SH.network_scores(shared_rows(spark, sf)[1], spec, w, ["id", "y"])
    return out.select("id", F.col("y").alias("response"), "score", (F.col("score") > 0.5).cast("double").alias("prediction"))


@query("tune_network")
def q_tune_network(spark, sf):
    return TU.report(spark, _tuned(spark, sf, TU.tune_network)[0])


@query("fit_linear_svc")
def q_fit_linear_svc(spark, sf):
    train, test = model_data(spark, sf)
    return _scores(M.linear_svc(0.01).fit(train), test, prob=False)


@query("fit_adaboost")
def q_fit_adaboost(spark, sf):
    train, test = model_data(spark, sf)
    ada = M.fit_adaboost(train, rounds=50)
    return ada.transform(test, keep=["id", F.col(M.LABEL).alias("response")])


def _folded(train, k=5):
    return SA.kfold(train, k, SEED, "id", M.LABEL)


@query("tune_grid")
def q_tune_grid(spark, sf):
    """All 80 settings of the reference's logistic regression."""
    return TU.report(spark, _tuned(spark, sf, TU.tune_logistic)[0])


@query("tune_random")
def q_tune_random(spark, sf):
    """50 draws inside the bounds and 100 around the best, the whole preparation refitted per fold."""
    found = TU.tune_random(prepare_raw(spark, sf), LABEL, lambda: run_preparation(SEED), {"C": (1e-4, 1e4), "max_iter": (100, 300)}, seed=SEED)
    return TU.report(spark, found)


@query("vote_soft")
def q_vote_soft(spark, sf):
    train, test = model_data(spark, sf)
    best, _ = _tuned(spark, sf, TU.tune_logistic)
    models = [M.logistic(best[0][0]["C"], best[0][0]["penalty"], _n(train), best[0][0]["max_iter"]).fit(train),
              M.gbt(3, 0.1, 50).fit(train), M.mlp(len(MODEL_COLS), (6,), 100).fit(train)]
    return M.vote_soft(models, test, keep=["id", F.col(M.LABEL).alias("response")])


def _kmeans_costs(spark, sf):
    train, _ = model_data(spark, sf)
    return memo(spark, sf, "kmeans_costs", lambda: M.kmeans_costs(train, range(1, 15), SEED))


def _cluster_model(spark, sf):
    train, test = shared_rows(spark, sf)
    return memo(spark, sf, "cluster_model", lambda: M.cluster_then_model(train, test, len(MODEL_COLS), seed=SEED, costs=_kmeans_costs(spark, sf)))


@query("cluster_then_model")
def q_cluster_then_model(spark, sf):
    chosen = _cluster_model(spark, sf).chosen
    return spark.createDataFrame([(c, kind, ", ".join(f"{k}={v}" for k, v in sorted(g.items())), float(r)) for c, (kind, g, r, _) in enumerate(chosen)],
                                 "cluster int, model string, params string, best_profit_ratio double")


@query("cluster_scores")
def q_cluster_scores(spark, sf):
    """The test rows, each scored by its cluster's model."""
    return _cluster_model(spark, sf).transform(shared_rows(spark, sf)[1], ["id", "y"]).withColumnRenamed("y", "response")


@query("kmeans_elbow")
def q_kmeans_elbow(spark, sf):
    costs = _kmeans_costs(spark, sf)
    return spark.createDataFrame([(k, c) for k, c in costs], "k int, cost double")


@query("predict_new")
def q_predict_new(spark, sf):
    """The whole preparation fitted on the labelled part, the final model, new rows scored."""
    # every step of the preparation reads the split
    df = written(SA.split_stratified(prepare_raw(spark, sf), LABEL, 0.2, SEED), "split")
    prepared = run_preparation(1).fit(df.where(F.col("split") == "train").drop("split"))
    cols = [c for c, t in prepared.train.dtypes if c not in ("id", LABEL) and is_numeric(t)]
    model = M.fit_final(prepared.train, cols, LABEL)
    new = prepared.transform(df.where(F.col("split") == "test").drop("split", LABEL))
    return model.transform(new).select("id", M.positive_prob().alias("score"), "prediction")


@query("coef_rank")
def q_coef_rank(spark, sf):
    train, _ = model_data(spark, sf)
    return M.coef_rank(M.logistic(1e4, "l2", _n(train)).fit(train), MODEL_COLS, spark)


def prepare_raw(spark, sf) -> DataFrame:
    """c360 with the day count and known labels, before any fitted step."""
    df = C.days_since(C.drop_unusual_classes(C.drop_columns(base(spark, sf))), "dt_customer", REF_DATE)
    return C.rename_column(df, "dt_customer", "num_days_customer").where(F.col(LABEL).isNotNull())


def run_preparation(seed: int) -> PR.Preparation:
    """The steps of the recorded run 0."""
    return PR.Preparation(
        [PR.drop_missing(), PR.boxplot_outliers(NUMERIC), PR.normalize(NUMERIC)],
        [PR.business(REF_YEAR), PR.smote_nc([*C360_FLAGS, "education", "marital_status"], LABEL, seed)])


def _cv(spark, sf):
    def build():
        log, steps = RUN.cv_report(prepare_raw(spark, sf), LABEL, run_preparation)
        return log.checkpoint(), steps
    return memo(spark, sf, "cv", build)


@query("cv_report")
def q_cv_report(spark, sf):
    return RUN.averages(_cv(spark, sf)[0])


@query("sink_run_log")
def q_sink_run_log(spark, sf):
    path = scratch_path(spark, "runlog")
    IO.sink_run_log(_cv(spark, sf)[0], path)
    return spark.read.parquet(path).where(F.col("run") == 0)


@query("sink_pipeline_json")
def q_sink_pipeline_json(spark, sf):
    """The steps that the cross-validated run fitted."""
    return IO.sink_steps_json(spark, _cv(spark, sf)[1], scratch_path(spark, "steps"))


@query("rank_tree_importance")
def q_rank_tree_importance(spark, sf):
    df = featured(spark, sf)
    return SEL.rank_tree_importance(df, FEATURED_NUMERIC + C360_FLAGS, LABEL, n=20)


@query("select_rfe")
def q_select_rfe(spark, sf):
    df = cleaned(spark, sf)
    mm = S.fit_minmax(df, NUMERIC).transform(df)
    return SEL.select_rfe(mm, NUMERIC, LABEL, n=8)


@query("select_forward_tree")
def q_select_forward_tree(spark, sf):
    df = cleaned(spark, sf)
    return SEL.select_forward_tree(df, NUMERIC, LABEL, n_select=8, folds=10)


@query("select_genetic")
def q_select_genetic(spark, sf):
    df = cleaned(spark, sf)
    mm = S.fit_minmax(df, NUMERIC).transform(df)
    return SEL.select_genetic(mm, NUMERIC, LABEL, n_pop=50, n_gen=4)


# ------------------------------------------- 2.8 / 2.13 neighbour operators
from prepforge.operators import neighbors as NB  # noqa: E402

def scaled(spark, sf) -> DataFrame:
    """cleaned rows, every numeric column min-max scaled (fitted on all rows), the categorical ones as they are."""
    df = cleaned(spark, sf)
    return S.fit_minmax(df, NUMERIC).transform(df.select("id", LABEL, "education", "marital_status", *NUMERIC, *C360_FLAGS))


@query("local_outlier_factor")
def q_local_outlier_factor(spark, sf):
    out = NB.local_outlier_factor(scaled(spark, sf), NUMERIC, k=20, contamination=0.05)
    return out.select("id", F.round("lof", 6).alias("lof"), "flagged")


@query("dbscan_noise")
def q_dbscan_noise(spark, sf):
    return NB.dbscan_noise(scaled(spark, sf), NUMERIC, eps=0.8, min_pts=5)


@query("smote")
def q_smote(spark, sf):
    return NB.smote(scaled(spark, sf), NUMERIC, LABEL, k=5, seed=SEED)


@query("smote_nc")
def q_smote_nc(spark, sf):
    return NB.smote_nc(scaled(spark, sf), NUMERIC, ["education", "marital_status", *C360_FLAGS], LABEL, k=5, seed=SEED)


@query("adasyn")
def q_adasyn(spark, sf):
    return NB.adasyn(scaled(spark, sf), NUMERIC, LABEL, k=5, seed=SEED)


# ------------------------------------------- 2.8 / 2.11 matrix methods, forests
from prepforge.operators import multivariate as MV  # noqa: E402

MV_COLS = NUMERIC


def _mv(spark, sf):
    df = cleaned(spark, sf)
    return S.fit_minmax(df, MV_COLS).transform(df.select("id", LABEL, *MV_COLS, *C360_FLAGS))


@query("mahalanobis")
def q_mahalanobis(spark, sf):
    return MV.mahalanobis(_mv(spark, sf), MV_COLS)


@query("mahalanobis_scores")
def q_mahalanobis_scores(spark, sf):
    return MV.mahalanobis_scores(_mv(spark, sf), MV_COLS).withColumn("md", F.round("md", 6))


@query("cooks_distance")
def q_cooks_distance(spark, sf):
    return MV.cooks_outliers(_mv(spark, sf), "income", [c for c in MV_COLS if c != "income"])


@query("elliptic_envelope")
def q_elliptic_envelope(spark, sf):
    return MV.elliptic_envelope(_mv(spark, sf), MV_COLS, contamination=0.1).where("flagged").select("id")


@query("isolation_forest")
def q_isolation_forest(spark, sf):
    return MV.isolation_forest(_mv(spark, sf), MV_COLS, contamination=0.1, n_trees=100, sample=100)


@query("extended_isolation_forest")
def q_extended_isolation_forest(spark, sf):
    return MV.extended_isolation_forest(_mv(spark, sf), MV_COLS, n_trees=100, sample=256, ext=2)


@query("kmeans_loo_gain")
def q_kmeans_loo_gain(spark, sf):
    return MV.kmeans_loo_gain(_mv(spark, sf), MV_COLS, [2, 3, 4])


def _split_mv(spark, sf):
    df = SA.split_stratified(cleaned(spark, sf).select("id", LABEL, *MV_COLS, *C360_FLAGS),
                             LABEL, 0.2, SEED)
    tr = df.where(F.col("split") == "train")
    mm = S.fit_minmax(tr, MV_COLS)
    return mm.transform(tr), mm.transform(df.where(F.col("split") == "test"))


@query("pca_80")
def q_pca_80(spark, sf):
    tr, un = _split_mv(spark, sf)
    mu, comps, _ = MV.fit_pca(tr, MV_COLS, 0.8)
    ptr = MV.pca_project(tr, MV_COLS, mu, comps, keep=["id", LABEL])
    pun = MV.pca_project(un, MV_COLS, mu, comps, keep=["id", LABEL])
    cc = [c for c in ptr.columns if c.startswith("c_")]
    mm = S.fit_minmax(ptr, cc)
    return mm.transform(ptr).withColumn("part", F.lit("train")).unionByName(
        mm.transform(pun).withColumn("part", F.lit("unseen")))


@query("explained_variance")
def q_explained_variance(spark, sf):
    tr, _ = _split_mv(spark, sf)
    return MV.explained_variance(tr, MV_COLS)


@query("lda")
def q_lda(spark, sf):
    df = _mv(spark, sf)
    mu, dirs, ratio = MV.fit_lda(df, MV_COLS, LABEL)
    return df.select("id", LABEL, *[MV.lin_form(MV_COLS, mu, dirs[:, j]).alias(f"ld_{j}")
                                    for j in range(dirs.shape[1])],
                     F.lit(float(ratio[0])).alias("explained_ratio"))


@query("factor_analysis")
def q_factor_analysis(spark, sf):
    df = _mv(spark, sf)
    mu, W, psi, beta = MV.fit_factor_analysis(df, MV_COLS, n_components=3)
    return df.select("id", *[MV.lin_form(MV_COLS, mu, beta[j]).alias(f"f_{j}")
                             for j in range(beta.shape[0])])


@query("fast_ica")
def q_fast_ica(spark, sf):
    df = _mv(spark, sf)
    mu, unmix = MV.fit_fast_ica(df, MV_COLS, n_components=4)
    return df.select("id", *[MV.lin_form(MV_COLS, mu, unmix[j]).alias(f"s_{j}")
                             for j in range(unmix.shape[0])])


@query("multi_factor")
def q_multi_factor(spark, sf):
    df = _mv(spark, sf)
    cols, mu, comps, ratio = MV.fit_multi_factor(df, {"numerical": MV_COLS, "categorical": C360_FLAGS})
    return df.select("id", *[MV.lin_form(cols, mu, comps[:, j]).alias(f"c_{j}")
                             for j in range(comps.shape[1])])


MV2 = ["income", "recency"]


@query("mahalanobis_2d")
def q_mahalanobis_2d(spark, sf):
    df = _mv(spark, sf)
    return MV.mahalanobis_scores(df, MV2).withColumn("md", F.round("md", 6))


@query("cooks_distance_2reg")
def q_cooks_distance_2reg(spark, sf):
    d = MV.cooks_distance(_mv(spark, sf), "income", ["recency", "mnt_wines"])
    return d.withColumn("cooks_d", F.round("cooks_d", 6))


# ------------------------------------------------------ 2.3 key set filters
@query("key_anti_filter")
def q_key_anti_filter(spark, sf):
    """The prepare step: drop the box-plot outlier keys from the rows."""
    df = _num(spark, sf)
    return C.key_anti_filter(df, O.outlier_boxplot(df, NUMERIC))


@query("key_semi_filter")
def q_key_semi_filter(spark, sf):
    """Keep rows whose duplicate group agrees on the label (group sets equal
    with and without the label)."""
    df = _dup_frame(spark, sf, label=True)
    keys = C.group_intersect(df, DUP_COLS + [LABEL], DUP_COLS)
    return C.key_semi_filter(base(spark, sf).select("id", "income", "recency", LABEL), keys)
