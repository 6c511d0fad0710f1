"""DuckDB oracle SQL for the registered queries.

Each entry is plain ANSI SQL over the driver views.  ``C360_CTE`` states the
customer view once; oracles that read it start with ``WITH {C360_CTE} ...``.
The SQL is written independently of the Spark code path (no shared helpers),
so that agreement is a real check.
"""

from __future__ import annotations

_SPEND = [("mnt_wines", "ECONOMY"), ("mnt_fruits", "LARGE"), ("mnt_meat", "MEDIUM"),
          ("mnt_fish", "PROMO"), ("mnt_sweet", "SMALL"), ("mnt_gold", "STANDARD")]
_MARITAL = ["Married", "Together", "Single", "Divorced", "Widow", "Alone", "Absurd", "YOLO"]

_spend_sums = ",\n    ".join(
    f"sum(CASE WHEN p_kind = '{t}' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS {c}"
    for c, t in _SPEND)
_spend_cust = ",\n    ".join(f"sum({c}) AS {c}" for c, _ in _SPEND)
_spend_out = ",\n    ".join(f"CAST({c} AS DOUBLE) AS {c}" for c, _ in _SPEND)
_camp = ",\n    ".join(
    f"max(CASE WHEN year(o_orderdate) = 1996 AND month(o_orderdate) = {m} THEN 1 ELSE 0 END)"
    f" AS accepted_cmp{m}" for m in range(1, 6))
_camp_out = ",\n    ".join(f"CAST(accepted_cmp{m} AS INTEGER) AS accepted_cmp{m}" for m in range(1, 6))
_marital = " ".join(f"WHEN c_nationkey % 9 = {i} THEN '{v}'" for i, v in enumerate(_MARITAL))

C360_CTE = f"""
per_order AS (
  SELECT l_orderkey,
    {_spend_sums},
    count(*) AS n_items,
    count(*) FILTER (WHERE l_discount >= 0.08) AS n_deals,
    count(*) FILTER (WHERE l_returnflag = 'R') AS n_returns
  FROM lineitem
  LEFT JOIN (SELECT p_partkey, split_part(p_type, ' ', 1) AS p_kind FROM part) pt
    ON l_partkey = pt.p_partkey
  GROUP BY l_orderkey),
per_cust AS (
  SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
    {_spend_cust},
    coalesce(sum(n_deals), 0) AS num_deals,
    count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS num_web,
    count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS num_catalog,
    count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS num_store,
    {_camp},
    sum(n_items) AS n_items, sum(n_returns) AS n_returns
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey
  GROUP BY o_custkey),
ev AS (
  SELECT user_id,
    count(*) FILTER (WHERE event_type = 'view') AS num_web_visits,
    max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS complain
  FROM events GROUP BY user_id),
c360 AS (
  SELECT c_custkey AS id,
    CAST(1940 + (c_custkey * 7) % 60 AS INTEGER) AS year_birth,
    c_mktsegment AS education,
    CASE {_marital} ELSE NULL END AS marital_status,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS income,
    CAST(c_custkey % 3 AS INTEGER) AS kidhome,
    CAST((c_custkey // 3) % 3 AS INTEGER) AS teenhome,
    strftime(first_order, '%Y-%m-%d') AS dt_customer,
    CAST(date_diff('day', CAST(last_order AS DATE), DATE '2001-08-02') AS INTEGER) AS recency,
    {_spend_out},
    CAST(num_deals AS BIGINT) AS num_deals,
    CAST(num_web AS BIGINT) AS num_web,
    CAST(num_catalog AS BIGINT) AS num_catalog,
    CAST(num_store AS BIGINT) AS num_store,
    CAST(coalesce(num_web_visits, 0) AS BIGINT) AS num_web_visits,
    {_camp_out},
    CAST(coalesce(complain, 0) AS INTEGER) AS complain,
    CAST(3 AS INTEGER) AS z_cost_contact,
    CAST(11 AS INTEGER) AS z_revenue,
    CASE WHEN n_items > 0 THEN CAST(n_returns * 5 > n_items * 2 AS INTEGER) END AS response
  FROM customer
  LEFT JOIN per_cust ON c_custkey = o_custkey
  LEFT JOIN ev ON c_custkey = user_id)"""


def with_c360(body: str, *extra_ctes: str) -> str:
    ctes = ",\n".join((C360_CTE,) + extra_ctes)
    return f"WITH {ctes}\n{body}"


ORACLES: dict[str, str] = {}


def oracle(key: str, sql: str) -> None:
    ORACLES[key] = sql.strip()


oracle("c360", with_c360("SELECT * FROM c360"))

# ---------------------------------------------------------------- stages
C360_COLS = (["id", "year_birth", "education", "marital_status", "income", "kidhome",
              "teenhome", "dt_customer", "recency"] + [c for c, _ in _SPEND]
             + ["num_deals", "num_web", "num_catalog", "num_store", "num_web_visits"]
             + [f"accepted_cmp{m}" for m in range(1, 6)]
             + ["complain", "z_cost_contact", "z_revenue", "response"])
SPEND = [c for c, _ in _SPEND]
COUNTS = ["num_deals", "num_web", "num_catalog", "num_store", "num_web_visits"]
FLAGS = [f"accepted_cmp{m}" for m in range(1, 6)] + ["complain"]
NUMERIC = ["year_birth", "income", "kidhome", "teenhome", "num_days_customer", "recency",
           *SPEND, *COUNTS]
BUSINESS = ["web_purchases_per_visit", "total_purchases", "ratio_web_purchases",
            "ratio_catalog_purchases", "ratio_store_purchases", "age",
            "total_accepted_campaigns", "total_money_spent", "ratio_wines", "ratio_fruits",
            "ratio_meat", "ratio_fish", "ratio_sweet", "ratio_gold", "money_per_purchase",
            "income_2years", "effort_rate", "total_kids", "count_household", "income_per_person"]
FEATURED_NUMERIC = NUMERIC + BUSINESS
DAYS = ("CAST(date_diff('day', CAST(strptime(replace({c}, '-', ''), '%Y%m%d') AS DATE), "
        "DATE '2001-08-02') AS INTEGER)")


def sr(a: str, b: str) -> str:
    """safe ratio"""
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0)"


_clean_cols = [c for c in C360_COLS if c not in ("z_cost_contact", "z_revenue")]
CLEANED_CTE = ("cleaned AS (SELECT "
               + ", ".join(DAYS.format(c=c) + " AS num_days_customer" if c == "dt_customer" else c
                           for c in _clean_cols)
               + " FROM c360 WHERE NOT coalesce(marital_status IN ('YOLO', 'Absurd', 'Alone'), false) AND "
               + " AND ".join(f"{c} IS NOT NULL" for c in _clean_cols) + ")")
_ratios = ", ".join(f"{sr(s, 'total_money_spent')} AS {n}" for s, n in zip(
    SPEND, ["ratio_wines", "ratio_fruits", "ratio_meat", "ratio_fish", "ratio_sweet", "ratio_gold"]))
FEATURED_CTE = f"""f1 AS (SELECT *,
    {sr('num_web', 'num_web_visits')} AS web_purchases_per_visit,
    num_web + num_catalog + num_store AS total_purchases,
    CAST(2001 - year_birth AS INTEGER) AS age,
    accepted_cmp1 + accepted_cmp2 + accepted_cmp3 + accepted_cmp4 + accepted_cmp5 AS total_accepted_campaigns,
    mnt_wines + mnt_fruits + mnt_meat + mnt_fish + mnt_sweet + mnt_gold AS total_money_spent,
    income * 2 AS income_2years,
    kidhome + teenhome AS total_kids
  FROM cleaned),
f2 AS (SELECT *,
    {sr('num_web', 'total_purchases')} AS ratio_web_purchases,
    {sr('num_catalog', 'total_purchases')} AS ratio_catalog_purchases,
    {sr('num_store', 'total_purchases')} AS ratio_store_purchases,
    {_ratios},
    {sr('total_money_spent', 'total_purchases')} AS money_per_purchase,
    {sr('total_money_spent', 'income_2years')} AS effort_rate,
    CAST(CASE WHEN coalesce(marital_status IN ('Together', 'Married'), false) THEN 2 ELSE 1 END
         + total_kids AS INTEGER) AS count_household
  FROM f1),
featured AS (SELECT *, {sr('income_2years', 'count_household')} AS income_per_person FROM f2)"""


def staged(body: str, *extra: str, featured: bool = False) -> str:
    ctes = [CLEANED_CTE] + ([FEATURED_CTE] if featured else []) + list(extra)
    return with_c360(body, *ctes)


def minmax_cols(cols, src: str, keep: list[str]) -> str:
    st = ", ".join(f"CAST(min({c}) AS DOUBLE) AS lo_{c}, CAST(max({c}) AS DOUBLE) AS hi_{c}"
                   for c in cols)
    sel = ", ".join(
        f"CASE WHEN hi_{c} - lo_{c} <> 0 THEN (CAST({c} AS DOUBLE) - lo_{c}) / (hi_{c} - lo_{c}) "
        f"ELSE CAST({c} AS DOUBLE) - lo_{c} END AS {c}" for c in cols)
    k = ", ".join(keep)
    return f"SELECT {k}{', ' if k else ''}{sel} FROM {src} CROSS JOIN (SELECT {st} FROM {src}) st"


def power_sql(s: str, name: str) -> list[str]:
    return [f"round({s}, 4) AS {name}__x",
            f"CASE WHEN {s} > 0 THEN round(ln({s}), 4) ELSE -50.0 END AS {name}__log",
            f"CASE WHEN {s} >= 0 THEN round(sqrt({s}), 4) END AS {name}__sqrt",
            f"round(exp({s}), 4) AS {name}__exp",
            f"CASE WHEN {s} >= 0 THEN round(pow({s}, 0.25), 4) END AS {name}__p025",
            f"round(pow({s}, 2), 4) AS {name}__p2",
            f"round(pow({s}, 4), 4) AS {name}__p4"]


# ------------------------------------------------------- 2.1 scans / sinks
oracle("scan_table", "SELECT c_custkey AS id, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
oracle("sink_csv", staged("SELECT * FROM cleaned"))
oracle("scan_csv", staged("SELECT id, response, " + ", ".join(BUSINESS) + " FROM featured",
                          featured=True))

# ------------------------------------------------- 2.2 projections / scalars
oracle("drop_columns", with_c360("SELECT * EXCLUDE (z_cost_contact, z_revenue) FROM c360"))
oracle("rename_column", with_c360("SELECT id, dt_customer AS customer_since FROM c360"))
oracle("days_since", with_c360(f"SELECT id, dt_customer, {DAYS.format(c='dt_customer')} AS num_days_customer FROM c360"))
oracle("distinct_years", with_c360(
    "SELECT DISTINCT CAST(year(strptime(replace(dt_customer, '-', ''), '%Y%m%d')) AS INTEGER) AS year FROM c360"))
oracle("cast_category", with_c360("SELECT id, " + ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in FLAGS)
                                  + ", CAST(response AS INTEGER) AS response FROM c360"))
_EDU = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_MAR_CLEAN = ["Divorced", "Married", "Single", "Together", "Widow"]
_onehot_edu = ", ".join(f"CASE WHEN education = '{v}' THEN 1 ELSE 0 END AS education_{v}" for v in _EDU[:-1])
_onehot_mar = ", ".join(f"CASE WHEN marital_status = '{v}' THEN 1 ELSE 0 END AS marital_status_{v}"
                        for v in _MAR_CLEAN[:-1])
oracle("one_hot", staged(f"SELECT id, {_onehot_edu}, {_onehot_mar} FROM cleaned"))
_codes = """codes_e AS (SELECT education AS v, CAST(row_number() OVER (ORDER BY min(id)) - 1 AS INTEGER) AS code
                 FROM c360 WHERE education IS NOT NULL GROUP BY education),
codes_m AS (SELECT marital_status AS v, CAST(row_number() OVER (ORDER BY min(id)) - 1 AS INTEGER) AS code
                 FROM c360 WHERE marital_status IS NOT NULL GROUP BY marital_status)"""
oracle("label_encode", with_c360(
    "SELECT c360.id, ce.code AS education, cm.code AS marital_status FROM c360 "
    "LEFT JOIN codes_e ce ON c360.education = ce.v LEFT JOIN codes_m cm ON c360.marital_status = cm.v",
    _codes))
oracle("label_decode", with_c360("SELECT id, education, marital_status FROM c360"))
oracle("safe_ratio", with_c360(
    f"SELECT id, {sr('num_web', 'num_web_visits')} AS web_per_visit, "
    f"{sr('mnt_wines', 'income')} AS wines_per_income, {sr('num_deals', 'num_store')} AS deals_per_store FROM c360"))
oracle("business_features", staged("SELECT * FROM featured", featured=True))
_fill_cols = ["income", *SPEND, *COUNTS, "recency"]
oracle("fill_nonfinite", with_c360(
    "SELECT id, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _fill_cols)
    + f", {sr('mnt_wines', 'income')} AS wines_per_income FROM c360"))
_pw = NUMERIC
oracle("power_features", staged(
    "SELECT id, " + ", ".join(x for c in _pw for x in power_sql(c, c)) + " FROM scaled",
    "scaled AS (" + minmax_cols(_pw, "cleaned", ["id"]) + ")"))

# ------------------------------------------------------------- 2.3 filters
oracle("drop_unusual_classes", with_c360(
    "SELECT id, marital_status FROM c360 WHERE NOT coalesce(marital_status IN ('YOLO', 'Absurd', 'Alone'), false)"))
oracle("drop_missing", with_c360("SELECT * FROM c360 WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in C360_COLS)))
_TH = [("year_birth", ">", 1920), ("income", "<", 153920), ("mnt_meat", "<", 1500 * 4000), ("mnt_sweet", "<", 250 * 4000),
       ("mnt_gold", "<", 290 * 4000), ("num_deals", "<", 14), ("num_web", "<", 23), ("num_catalog", "<", 21),
       ("num_web_visits", "<", 13)]
oracle("threshold_filter", staged(
    "SELECT id, " + ", ".join(c for c, _, _ in _TH) + " FROM cleaned WHERE "
    + " AND ".join(f"{c} {op} {v}" for c, op, v in _TH)))

# ------------------------------------------------------ 2.4 / 2.5 joins, dedupe
_DUP = "education, marital_status, kidhome, teenhome"
oracle("attach_key", with_c360(
    f"SELECT k.id, c360.income, c360.recency FROM (SELECT min(id) AS id FROM c360 GROUP BY {_DUP}) k "
    "JOIN c360 ON k.id = c360.id"))
oracle("align_columns", staged(
    "SELECT id, " + ", ".join(f"education_{v}" for v in _EDU[:-1]) + ", income FROM "
    f"(SELECT id, {_onehot_edu} FROM cleaned) d FULL OUTER JOIN (SELECT id, income FROM c360) b USING (id)"))
oracle("dedupe_exact", with_c360(f"SELECT min(id) AS id, {_DUP} FROM c360 GROUP BY {_DUP}"))
oracle("dedupe_check", with_c360(
    f"SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT {_DUP} FROM c360)) AS n_distinct, "
    f"count(*) = (SELECT count(*) FROM (SELECT DISTINCT {_DUP} FROM c360)) AS is_unique FROM c360"))
oracle("duplicate_groups", with_c360(
    f"SELECT {_DUP}, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM c360 GROUP BY {_DUP}"))
oracle("drop_label_conflicts", with_c360(
    f"SELECT id, {_DUP}, response FROM (SELECT *, "
    f"min(coalesce(response, -1)) OVER (PARTITION BY {_DUP}) AS lo, "
    f"max(coalesce(response, -1)) OVER (PARTITION BY {_DUP}) AS hi FROM c360) WHERE lo = hi"))
oracle("group_intersect", with_c360(
    f"SELECT id, group_id FROM (SELECT id, min(id) OVER (PARTITION BY {_DUP}, response) AS group_id, "
    f"count(*) OVER (PARTITION BY {_DUP}, response) AS na, count(*) OVER (PARTITION BY {_DUP}) AS nb "
    "FROM c360) WHERE na = nb"))


# -------------------------------------------------------------- 2.6 profile
def _describe(cols, src, group=None):
    g = f", {group}" if group else ""
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS var{g}, count({x}) AS count, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, "
            f"round(quantile_cont({x}, 0.25), 6) AS p25, round(quantile_cont({x}, 0.5), 6) AS p50, "
            f"round(quantile_cont({x}, 0.75), 6) AS p75, round(max({x}), 6) AS max FROM {src}"
            + (f" GROUP BY {group}" if group else ""))
    return " UNION ALL ".join(parts)


oracle("describe_numeric", with_c360(_describe(["income", "recency", "year_birth", *SPEND, *COUNTS], "c360")))
_PROFILE = ["income", "recency", "year_birth", *SPEND, *COUNTS]
oracle("describe_by_group", with_c360(_describe(_PROFILE, "c360", "education")))
oracle("describe_by_marital", with_c360(_describe(_PROFILE, "c360", "marital_status")))
oracle("group_membership", with_c360(
    f"SELECT id, min(id) OVER (PARTITION BY {_DUP}) AS group_id, count(*) OVER (PARTITION BY {_DUP}) AS group_size FROM c360"))
oracle("missing_report", with_c360(" UNION ALL ".join(
    f"SELECT '{c}' AS var, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS p_missing FROM c360 "
    f"HAVING count(*) FILTER (WHERE {c} IS NULL) > 0" for c in C360_COLS)))
oracle("value_counts", with_c360("SELECT marital_status, count(*) AS n FROM c360 GROUP BY marital_status"))
oracle("response_rate", with_c360(
    "SELECT round(100 * avg(response), 2) AS response_pct, count(*) FILTER (WHERE response = 1) AS n_pos, "
    "count(*) FILTER (WHERE response = 0) AS n_neg FROM c360"))
oracle("five_number_by_label", staged(" UNION ALL ".join(
    f"SELECT '{c}' AS var, response, round(min(CAST({c} AS DOUBLE)), 6) AS min, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q1, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q3, round(max(CAST({c} AS DOUBLE)), 6) AS max "
    f"FROM cleaned GROUP BY response" for c in NUMERIC)))
oracle("crosstab_shares", staged(
    "SELECT education, n0, n1, total, round(n1 / total, 6) AS share1, "
    "round((n1 / total) / (SELECT n1 / total FROM g WHERE education = '__all__'), 6) AS share_vs_mean FROM g",
    "g AS (SELECT CAST(education AS VARCHAR) AS education, count(*) FILTER (WHERE response = 0) AS n0, "
    "count(*) FILTER (WHERE response = 1) AS n1, count(*) AS total FROM cleaned GROUP BY education "
    "UNION ALL SELECT '__all__', count(*) FILTER (WHERE response = 0), count(*) FILTER (WHERE response = 1), "
    "count(*) FROM cleaned)"))
oracle("group_average", staged(
    "SELECT education, " + ", ".join(f"round(avg({m}), 6) AS {m}" for m in
                                     ["total_money_spent", "effort_rate", "age", "income_per_person"])
    + " FROM featured GROUP BY education", featured=True))
oracle("corr_with_label", staged(" UNION ALL ".join(
    f"SELECT '{c}' AS var, round(abs(corr(CAST({c} AS DOUBLE), CAST(response AS DOUBLE))), 6) AS abs_corr "
    "FROM featured" for c in FEATURED_NUMERIC), featured=True))
oracle("corr_matrix", staged(" UNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, round(abs(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))), 6) AS abs_corr "
    "FROM cleaned" for i, a in enumerate(NUMERIC) for b in NUMERIC[i:])))
oracle("top_k", staged(
    "SELECT id, income, income_scaled FROM (" + minmax_cols(["income"], "cleaned", ["id", "income AS income_raw"])
    .replace("AS income FROM", "AS income_scaled FROM") + ") s JOIN cleaned USING (id) "
    "ORDER BY income DESC, id LIMIT 300"))
oracle("minimum_slice", staged(
    minmax_cols(FEATURED_NUMERIC, "featured",
                [c for c in ["id", "education", "marital_status", *FLAGS, "response"]]),
    featured=True))


# ------------------------------------------------------------ 2.15 evaluation
SCORED = ("scored AS (SELECT id, response, round(CASE WHEN hi - lo <> 0 THEN (CAST(recency AS DOUBLE) - lo) / (hi - lo) "
          "ELSE CAST(recency AS DOUBLE) - lo END, 3) AS score FROM cleaned CROSS JOIN "
          "(SELECT CAST(min(recency) AS DOUBLE) AS lo, CAST(max(recency) AS DOUBLE) AS hi FROM cleaned) st)")
CURVE = ("grid AS (SELECT i, CAST(i AS DOUBLE) * CAST(0.025 AS DOUBLE) AS threshold FROM range(40) t(i)), "
         "curve AS (SELECT threshold, count(*) FILTER (WHERE score >= threshold AND response = 1) AS tp, "
         "count(*) FILTER (WHERE score >= threshold AND response <> 1) AS fp, "
         "(SELECT count(*) FILTER (WHERE response = 1) FROM scored) AS n_pos "
         "FROM grid LEFT JOIN scored ON true GROUP BY threshold)")
BEST = ("best AS (SELECT threshold AS best_threshold, 11 * tp - 3 * (tp + fp) AS best_profit, "
        "CAST(11 * tp - 3 * (tp + fp) AS DOUBLE) / CAST(n_pos * 8 AS DOUBLE) AS best_profit_ratio "
        "FROM curve ORDER BY 11 * tp - 3 * (tp + fp) DESC, threshold LIMIT 1)")


def scored_sql(body, *extra):
    return staged(body, SCORED, *extra)


oracle("confusion", scored_sql(
    "SELECT count(*) FILTER (WHERE score < 0.5 AND response <> 1) AS tn, count(*) FILTER (WHERE score >= 0.5 AND response <> 1) AS fp, "
    "count(*) FILTER (WHERE score < 0.5 AND response = 1) AS fn, count(*) FILTER (WHERE score >= 0.5 AND response = 1) AS tp FROM scored"))
oracle("profit_curve", scored_sql(
    "SELECT threshold, tp, fp, n_pos, 11 * tp - 3 * (tp + fp) AS profit FROM curve", CURVE))
oracle("best_profit", scored_sql("SELECT * FROM best", CURVE, BEST))
oracle("profit_score", staged(
    "SELECT best_profit_ratio FROM best", SCORED.replace("AS score FROM", "AS score0 FROM").replace(
        "scored AS (", "scored0 AS ("),
    "scored AS (SELECT id, response, CAST(score0 >= 0.5 AS INTEGER) AS score FROM scored0)", CURVE, BEST))
_G = ("g AS (SELECT score, count(*) FILTER (WHERE response = 1) AS pos, "
      "count(*) FILTER (WHERE response <> 1) AS neg FROM scored GROUP BY score)")
oracle("roc_points", scored_sql(
    "SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, "
    "CAST(sum(pos) OVER (ORDER BY score DESC) AS DOUBLE) / (SELECT sum(pos) FROM g) AS tpr, "
    "CAST(sum(neg) OVER (ORDER BY score DESC) AS DOUBLE) / (SELECT sum(neg) FROM g) AS fpr FROM g", _G))
oracle("auroc", scored_sql(
    "SELECT sum(pos * (coalesce(neg_below, 0) + neg * 0.5)) / CAST(sum(pos) * sum(neg) AS DOUBLE) AS auroc FROM "
    "(SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS neg_below FROM g) c",
    _G))
_div = "coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0)"
_CR = ("cm AS (SELECT count(*) FILTER (WHERE score < t AND response <> 1) AS tn, count(*) FILTER (WHERE score >= t AND response <> 1) AS fp, "
       "count(*) FILTER (WHERE score < t AND response = 1) AS fn, count(*) FILTER (WHERE score >= t AND response = 1) AS tp "
       "FROM scored CROSS JOIN (SELECT best_threshold AS t FROM best) bt), "
       "m AS (SELECT *, " + _div.format(a="tp", b="tp + fp") + " AS c1_precision, " + _div.format(a="tp", b="tp + fn")
       + " AS c1_recall, " + _div.format(a="tn", b="tn + fn") + " AS c0_precision, " + _div.format(a="tn", b="tn + fp")
       + " AS c0_recall, tp + fn AS c1_support, tn + fp AS c0_support, tn + fp + fn + tp AS n FROM cm), "
       "m2 AS (SELECT *, " + _div.format(a="2 * c0_precision * c0_recall", b="c0_precision + c0_recall") + " AS c0_f1, "
       + _div.format(a="2 * c1_precision * c1_recall", b="c1_precision + c1_recall") + " AS c1_f1, "
       + _div.format(a="tp + tn", b="n") + " AS acc FROM m)")
oracle("class_report", scored_sql(
    "SELECT c1_precision, c1_recall, c0_precision, c0_recall, c1_support, c0_support, c0_f1, c1_f1, "
    "acc AS micro_precision, acc AS micro_recall, acc AS micro_f1, n AS micro_support, "
    + ", ".join(f"(c0_{s} + c1_{s}) / 2 AS macro_{s}, "
                + _div.format(a=f"c0_{s} * c0_support + c1_{s} * c1_support", b="n") + f" AS weighted_{s}"
                for s in ("precision", "recall", "f1"))
    + ", n AS macro_support, n AS weighted_support FROM m2", CURVE, BEST, _CR))


# ------------------------------------------------- 2.7 / 2.9 outliers, votes
NUM_SEL = "num AS (SELECT id, " + ", ".join(NUMERIC) + " FROM cleaned)"
_ZST = ("zst AS (SELECT " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}"
                                      for c in NUMERIC) + " FROM num)")
_ZL = ("zl AS (" + " UNION ALL ".join(
    f"SELECT id, '{c}' AS var, (CAST({c} AS DOUBLE) - m_{c}) / s_{c} AS score FROM num, zst WHERE s_{c} <> 0"
    for c in NUMERIC) + ")")
_ZW = ("zw AS (SELECT id, " + ", ".join(f"CASE WHEN s_{c} <> 0 THEN (CAST({c} AS DOUBLE) - m_{c}) / s_{c} END AS {c}"
                                        for c in NUMERIC) + " FROM num, zst)")
_ZQ = ("zq AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}"
                                    for c in NUMERIC) + " FROM zw)")
_BOX = ("box AS (" + " UNION ALL ".join(
    f"SELECT id, '{c}' AS var, CASE WHEN {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c}) THEN {c} - (q3_{c} + 1.5 * (q3_{c} - q1_{c})) "
    f"WHEN {c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) THEN (q1_{c} - 1.5 * (q3_{c} - q1_{c})) - {c} END AS dist "
    f"FROM zw, zq WHERE {c} IS NOT NULL" for c in NUMERIC) + ")")
_BOXIDS = ("boxids AS (SELECT DISTINCT id FROM (SELECT id, row_number() OVER (ORDER BY dist DESC, id, var) AS rn "
           "FROM box WHERE dist IS NOT NULL) WHERE rn <= (SELECT CAST(floor(CAST(count(*) AS DOUBLE) * CAST(0.03 AS DOUBLE)) AS BIGINT) FROM num))")
_MED = "med AS (SELECT " + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS md_{c}" for c in NUMERIC) + " FROM num)"
_MAD = ("mad AS (SELECT " + ", ".join(f"quantile_cont(abs(CAST({c} AS DOUBLE) - md_{c}), 0.5) AS mad_{c}" for c in NUMERIC)
        + " FROM num, med)")
_ROB = ("rob AS (" + " UNION ALL ".join(
    f"SELECT id, '{c}' AS var FROM num, med, mad WHERE CASE WHEN mad_{c} = 0 THEN CAST({c} AS DOUBLE) - md_{c} <> 0 "
    f"ELSE abs(0.6745 * (CAST({c} AS DOUBLE) - md_{c}) / mad_{c}) > 5 END" for c in NUMERIC) + ")")
_OUT_CTES = [NUM_SEL, _ZST, _ZL, _ZW, _ZQ, _BOX, _BOXIDS, _MED, _MAD, _ROB]
_FLAGS = ("flags AS (SELECT 'zscore' AS detector, id, var FROM zl WHERE abs(score) > 3 "
          "UNION ALL SELECT 'robust_z', id, var FROM rob UNION ALL SELECT 'boxplot', id, 'multi/unknown' FROM boxids)")
_VOTES = ("v0 AS (SELECT id, count(*) AS votes FROM flags GROUP BY id), "
          "votes AS (SELECT id, votes, CASE WHEN hi > lo THEN CAST(votes - lo AS DOUBLE) / CAST(hi - lo AS DOUBLE) ELSE 0.0 END AS score "
          "FROM v0, (SELECT min(votes) AS lo, max(votes) AS hi FROM v0) mm)")
_INFO = "array_to_string(list_sort(list_distinct(list(var))), ',') AS vars"


def out_sql(body, *extra):
    return staged(body, *_OUT_CTES, *extra)


oracle("outlier_std_null", staged(
    "SELECT id, " + ", ".join(
        f"CASE WHEN {c} < m_{c} - 3.0 * s_{c} OR {c} > m_{c} + 3.0 * s_{c} THEN NULL ELSE {c} END AS {c}"
        for c in NUMERIC) + " FROM num, st",
    NUM_SEL, "st AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in NUMERIC) + " FROM num)"))
oracle("outlier_zscore", out_sql("SELECT id, var, round(score, 6) AS score FROM zl WHERE abs(score) > 3"))
oracle("outlier_boxplot", out_sql("SELECT id FROM boxids"))
oracle("outlier_boxplot_all", out_sql("SELECT id, var, round(dist, 6) AS dist FROM box WHERE dist IS NOT NULL"))
oracle("outlier_robust_z", out_sql("SELECT id, var FROM rob"))
oracle("outlier_iqr_scores", staged(
    "SELECT id FROM featured, (SELECT quantile_cont(total_money_spent, 0.25) AS q1, quantile_cont(total_money_spent, 0.75) AS q3 FROM featured) q "
    "WHERE total_money_spent > q3 + 1.5 * (q3 - q1) OR total_money_spent < q1 - 1.5 * (q3 - q1)", featured=True))
oracle("outlier_votes", out_sql("SELECT id, votes, round(score, 6) AS score FROM votes", _FLAGS, _VOTES))
oracle("outlier_info", out_sql(f"SELECT id, {_INFO} FROM flags GROUP BY id", _FLAGS))
oracle("outlier_vote_drop", out_sql("SELECT * FROM num WHERE id NOT IN (SELECT id FROM votes WHERE score > 0.5)",
                                    _FLAGS, _VOTES))
oracle("outlier_vote_info", out_sql(
    f"SELECT id, {_INFO} FROM flags WHERE id IN (SELECT id FROM votes WHERE score > 0.5) GROUP BY id", _FLAGS, _VOTES))
_SM_ST = "sst AS (SELECT " + ", ".join(
    f"avg({c}) AS mean_{c}, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS a_{c}, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS b_{c}"
    for c in NUMERIC) + " FROM num)"
_SM_FL = ("sfl AS (SELECT id, " + ", ".join(f"max(CASE WHEN var = '{c}' THEN 1 ELSE 0 END) AS f_{c}" for c in NUMERIC)
          + " FROM flags WHERE id IN (SELECT id FROM votes WHERE score > 0.5) GROUP BY id)")
oracle("outlier_smooth", out_sql(
    "SELECT num.id, " + ", ".join(
        f"round(CASE WHEN coalesce(f_{c}, 0) > 0 THEN CASE WHEN {c} > mean_{c} THEN b_{c} + 1.5 * (b_{c} - a_{c}) "
        f"ELSE a_{c} - 1.5 * (b_{c} - a_{c}) END ELSE CAST({c} AS DOUBLE) END, 6) AS {c}" for c in NUMERIC)
    + " FROM num CROSS JOIN sst LEFT JOIN sfl ON num.id = sfl.id WHERE num.id NOT IN "
      "(SELECT id FROM flags WHERE var = 'multi/unknown' AND id IN (SELECT id FROM votes WHERE score > 0.5))",
    _FLAGS, _VOTES, _SM_ST, _SM_FL))

# ---------------------------------------------------- 2.10 impute and scale
_IMP = ["income", *SPEND]
oracle("impute_mean", with_c360("SELECT id, " + ", ".join(
    f"round(coalesce({c}, (SELECT avg({c}) FROM c360)), 6) AS {c}" for c in _IMP) + " FROM c360"))
oracle("impute_median", with_c360("SELECT id, " + ", ".join(
    f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM c360)) AS {c}" for c in _IMP) + " FROM c360"))
oracle("impute_mode", with_c360(
    "SELECT id, coalesce(marital_status, (SELECT marital_status FROM c360 WHERE marital_status IS NOT NULL "
    "GROUP BY marital_status ORDER BY count(*) DESC, marital_status LIMIT 1)) AS marital_status, "
    "coalesce(response, (SELECT response FROM c360 WHERE response IS NOT NULL GROUP BY response "
    "ORDER BY count(*) DESC, response LIMIT 1)) AS response FROM c360"))
oracle("minmax_scale", staged(minmax_cols(NUMERIC, "num", ["id"]), NUM_SEL))
oracle("standard_scale_subset", staged(
    "SELECT id, " + ", ".join(FLAGS) + ", " + ", ".join(
        f"round((CAST({c} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} <> 0 THEN s_{c} ELSE 1.0 END, 6) AS {c}" for c in NUMERIC)
    + " FROM cleaned, (SELECT " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}"
                                            for c in NUMERIC) + " FROM cleaned) st"))
oracle("bin_uniform", staged(
    "SELECT id, " + ", ".join(
        f"CAST(CASE WHEN hi_{c} = lo_{c} THEN 0 ELSE least(greatest(floor((CAST({c} AS DOUBLE) - lo_{c}) * 10.0 / (hi_{c} - lo_{c})), 0), 9) END AS INTEGER) AS {c}_bin"
        for c in NUMERIC) + " FROM num, (SELECT " + ", ".join(
        f"CAST(min({c}) AS DOUBLE) AS lo_{c}, CAST(max({c}) AS DOUBLE) AS hi_{c}" for c in NUMERIC) + " FROM num) st",
    NUM_SEL))


# ------------------------------------------------- 2.11 / 2.12 selection
def feat_sql(body, *extra):
    return staged(body, *extra, featured=True)


oracle("select_constant", feat_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS var, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS sd, "
    f"coalesce(stddev_samp(CAST({c} AS DOUBLE)) < 0.01, true) AS dropped FROM featured" for c in FEATURED_NUMERIC)))
_BIN = ("CASE WHEN hi_{c} = lo_{c} THEN 0 ELSE least(greatest(floor((CAST({c} AS DOUBLE) - lo_{c}) * 10.0 / "
        "(hi_{c} - lo_{c})), 0), 9) END")
_CHI_LONG = ("chl AS (" + " UNION ALL ".join(
    [f"SELECT '{c}' AS var, CAST({_BIN.format(c=c)} AS DOUBLE) AS v, response FROM featured, "
     f"(SELECT CAST(min({c}) AS DOUBLE) AS lo_{c}, CAST(max({c}) AS DOUBLE) AS hi_{c} FROM featured) b"
     for c in FEATURED_NUMERIC]
    + [f"SELECT '{c}' AS var, CAST({c} AS DOUBLE) AS v, response FROM featured" for c in FLAGS]) + ")")


def chi2_ctes(src: str) -> list[str]:
    return [f"cells AS (SELECT var, v, count(*) FILTER (WHERE response = 1) AS o1, "
            f"count(*) FILTER (WHERE response = 0) AS o0 FROM {src} GROUP BY var, v)",
            "tot AS (SELECT var, sum(o1) AS t1, sum(o0) AS t0, count(*) AS nv FROM cells GROUP BY var)",
            "cj AS (SELECT c.var, o1, o0, t1, t0, (nv - 1) * (CAST(t1 > 0 AS INTEGER) + CAST(t0 > 0 AS INTEGER) - 1) AS dof, "
            "(o1 + o0) * t1 / (t1 + t0) AS e1, (o1 + o0) * t0 / (t1 + t0) AS e0 FROM cells c JOIN tot USING (var))",
            "cd AS (SELECT var, dof, e1, e0, CASE WHEN dof = 1 THEN greatest(abs(o1 - e1) - least(0.5, abs(o1 - e1)), 0.0) "
            "ELSE abs(o1 - e1) END AS d1, CASE WHEN dof = 1 THEN greatest(abs(o0 - e0) - least(0.5, abs(o0 - e0)), 0.0) "
            "ELSE abs(o0 - e0) END AS d0 FROM cj)",
            "chi AS (SELECT var, sum(CASE WHEN e1 > 0 THEN d1 * d1 / e1 ELSE 0.0 END + CASE WHEN e0 > 0 THEN d0 * d0 / e0 ELSE 0.0 END) AS chi2, "
            "first(dof) AS dof FROM cd GROUP BY var)"]


oracle("rank_chi2", feat_sql(
    "SELECT var, chi2, CAST(dof AS BIGINT) AS dof, CAST(row_number() OVER (ORDER BY chi2 DESC, var) AS INTEGER) AS rank "
    "FROM (SELECT var, round(chi2, 6) AS chi2, dof FROM chi)", _CHI_LONG, *chi2_ctes("chl")))
_LIN = ", ".join(f"sum(CAST({c} AS DOUBLE) * CAST(response AS DOUBLE)) AS sxy_{i}, "
                 f"sum(CAST({c} AS DOUBLE) * CAST({c} AS DOUBLE)) AS sxx_{i}" for i, c in enumerate(FEATURED_NUMERIC))
oracle("rank_linear", feat_sql(
    "SELECT var, round(coef, 6) AS coef, round(sqrt(rss / ((n - 1) * sxx)), 6) AS std_err, "
    "round(1 - n / (n - 1) * (rss / syy), 6) AS adj_r2 FROM "
    "(SELECT *, syy - coef * sxy AS rss FROM (SELECT *, sxy / nullif(sxx, 0) AS coef FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS var, sxy_{i} AS sxy, sxx_{i} AS sxx, n, syy FROM w"
                         for i, c in enumerate(FEATURED_NUMERIC)) + ")))",
    f"w AS (SELECT count(*) AS n, sum(CAST(response AS DOUBLE) * CAST(response AS DOUBLE)) AS syy, {_LIN} FROM featured)"))
_MOM = ("lg AS (" + " UNION ALL ".join(f"SELECT '{c}' AS var, response, CAST({c} AS DOUBLE) AS x FROM featured"
                                       for c in FEATURED_NUMERIC) + "), "
        "per AS (SELECT var, response, count(x) AS nc, avg(x) AS mc, var_samp(x) AS vc FROM lg GROUP BY var, response), "
        "allm AS (SELECT var, avg(x) AS mu, count(x) AS n, count(DISTINCT response) AS k FROM lg GROUP BY var), "
        "mj AS (SELECT * FROM per JOIN allm USING (var))")
oracle("rank_fisher", feat_sql(
    "SELECT var, round(sum(nc * pow(mc - mu, 2)) / nullif(sum(nc * vc), 0), 6) AS fisher FROM mj GROUP BY var", _MOM))
_ANOVA = ("anova AS (SELECT var, round((sum(nc * pow(mc - mu, 2)) / (first(k) - 1)) / "
          "nullif(sum((nc - 1) * coalesce(vc, 0.0)) / (first(n) - first(k)), 0), 6) AS f FROM mj GROUP BY var)")
oracle("rank_anova_f", feat_sql("SELECT var, f FROM anova", _MOM, _ANOVA))


def _h(p):
    return f"CASE WHEN ({p}) <= 0 OR ({p}) >= 1 THEN 0.0 ELSE -({p}) * log2({p}) - (1 - ({p})) * log2(1 - ({p})) END"


def _gain_sql(cols):
    return ("gl AS (" + " UNION ALL ".join(f"SELECT '{c}' AS var, CAST({c} AS DOUBLE) AS value, response FROM featured"
                                           for c in cols) + "), "
            "gg AS (SELECT var, value, count(*) AS cnt, count(*) FILTER (WHERE response = 1) AS pos FROM gl GROUP BY var, value), "
            "gc AS (SELECT var, value, sum(cnt) OVER (PARTITION BY var ORDER BY value) AS nl, "
            "sum(pos) OVER (PARTITION BY var ORDER BY value) AS pl, sum(cnt) OVER (PARTITION BY var) AS nn, "
            "sum(pos) OVER (PARTITION BY var) AS pp, max(value) OVER (PARTITION BY var) AS vmax FROM gg), "
            "gains AS (SELECT var, value, " + _h("CAST(pp AS DOUBLE) / nn") + " - ((nn - nl) / nn * "
            + _h("CAST(pp - pl AS DOUBLE) / nullif(nn - nl, 0)") + " + nl / nn * " + _h("CAST(pl AS DOUBLE) / nl")
            + ") AS gain FROM gc WHERE value < vmax)")


oracle("info_gain_splits", feat_sql("SELECT value, round(gain, 6) AS gain FROM gains", _gain_sql(["recency"])))
oracle("rank_info_gain", feat_sql(
    "SELECT var, value AS best_value, round(gain, 6) AS gain FROM (SELECT *, row_number() OVER "
    "(PARTITION BY var ORDER BY gain DESC, value) AS rn FROM gains) WHERE rn = 1", _gain_sql(FEATURED_NUMERIC)))
_CORR = ("corr AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS var, round(abs(corr(CAST({c} AS DOUBLE), CAST(response AS DOUBLE))), 6) AS abs_corr FROM featured"
    for c in FEATURED_NUMERIC) + ")")
_PICKS = ("picks AS (SELECT var FROM (SELECT var, row_number() OVER (ORDER BY chi2 DESC NULLS LAST, var) AS r FROM "
          "(SELECT var, round(chi2, 6) AS chi2 FROM chi)) WHERE r <= 10 "
          "UNION ALL SELECT var FROM (SELECT var, row_number() OVER (ORDER BY fisher DESC NULLS LAST, var) AS r FROM "
          "(SELECT var, round(sum(nc * pow(mc - mu, 2)) / nullif(sum(nc * vc), 0), 6) AS fisher FROM mj GROUP BY var)) WHERE r <= 10 "
          "UNION ALL SELECT var FROM (SELECT var, row_number() OVER (ORDER BY f DESC NULLS LAST, var) AS r FROM anova) WHERE r <= 10 "
          "UNION ALL SELECT var FROM (SELECT var, row_number() OVER (ORDER BY abs_corr DESC NULLS LAST, var) AS r FROM corr) WHERE r <= 10)")
oracle("select_by_votes", feat_sql(
    "SELECT var, count(*) AS n_votes, round(count(*) / 4.0, 6) AS share FROM picks GROUP BY var HAVING round(count(*) / 4.0, 6) > 0.5",
    _CHI_LONG, *chi2_ctes("chl"), _MOM, _ANOVA, _CORR, _PICKS))
_T_ORDER = [("x", "x"), ("log", "log"), ("sqrt", "sqrt"), ("exp", "exp"), ("p025", "**1/4"), ("p2", "**2"), ("p4", "**4")]
_PW_ALL = ("ptr AS (SELECT response, " + ", ".join(x for c in NUMERIC for x in power_sql(c, c)) + " FROM pscaled), "
           "plong AS (UNPIVOT ptr ON COLUMNS(* EXCLUDE (response)) INTO NAME var VALUE x), "
           "pb AS (SELECT var, min(x) AS lo, max(x) AS hi FROM plong GROUP BY var), "
           "pbin AS (SELECT var, CASE WHEN hi - lo = 0 THEN 0 ELSE least(floor((x - lo) * 10 / (hi - lo)), 9) END AS v, response "
           "FROM plong JOIN pb USING (var))")
oracle("best_power_transform", staged(
    "SELECT feature, transform FROM (SELECT regexp_extract(var, '^(.*)__[^_]+$', 1) AS feature, t.transform, "
    "row_number() OVER (PARTITION BY regexp_extract(var, '^(.*)__[^_]+$', 1) ORDER BY round(chi2, 9) DESC, t.ord) AS rn "
    "FROM chi JOIN (VALUES " + ", ".join(f"('{sfx}', '{name}', {i})" for i, (sfx, name) in enumerate(_T_ORDER))
    + ") t(sfx, transform, ord) ON regexp_extract(var, '__([^_]+)$', 1) = t.sfx) WHERE rn = 1",
    "pscaled AS (" + minmax_cols(NUMERIC, "cleaned", ["response"]) + ")", _PW_ALL, *chi2_ctes("pbin")))


# ------------------------------------------- 2.8 neighbour operators (brute force)
_SCALED_CTE = "scaled AS (" + minmax_cols(NUMERIC, "cleaned", ["id"]) + ")"
_DIST = "sqrt(" + " + ".join(f"pow(a.{c} - b.{c}, 2)" for c in NUMERIC) + ")"
oracle("local_outlier_factor", staged(
    "SELECT id, round(lof, 6) AS lof, lof > (SELECT quantile_cont(lof, 0.95) FROM lofs) AS flagged FROM lofs",
    _SCALED_CTE,
    f"d AS (SELECT a.id AS lid, b.id AS rid, {_DIST} AS dist FROM scaled a JOIN scaled b ON a.id <> b.id)",
    "nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lid ORDER BY dist, rid) AS rk FROM d) WHERE rk <= 20)",
    "kd AS (SELECT lid AS id, max(dist) AS kdist FROM nn GROUP BY lid)",
    "lrd AS (SELECT nn.lid AS id, 1.0 / avg(greatest(kd.kdist, nn.dist)) AS lrd FROM nn JOIN kd ON nn.rid = kd.id GROUP BY nn.lid)",
    "lofs AS (SELECT nn.lid AS id, avg(o.lrd) / p.lrd AS lof FROM nn JOIN lrd o ON nn.rid = o.id "
    "JOIN lrd p ON nn.lid = p.id GROUP BY nn.lid, p.lrd)"))
oracle("dbscan_noise", staged(
    "SELECT id FROM scaled WHERE id NOT IN (SELECT p.lid FROM pairs p JOIN core c ON p.rid = c.id)",
    _SCALED_CTE,
    f"pairs AS (SELECT a.id AS lid, b.id AS rid FROM scaled a JOIN scaled b ON {_DIST} <= 0.8)",
    "core AS (SELECT lid AS id FROM pairs GROUP BY lid HAVING count(*) >= 5)"))


# ------------------------------------------- two-dimensional matrix cases
_MV_COLS = ["income", "recency", "mnt_wines", "mnt_meat", "num_deals", "num_web", "num_store",
            "num_days_customer"]
_MV_CTE = "mv AS (" + minmax_cols(_MV_COLS, "cleaned", ["id"]) + ")"
oracle("mahalanobis_2d", staged(
    "SELECT id, round(sqrt(greatest((s_bb * da * da - 2 * s_ab * da * db + s_aa * db * db) / (s_aa * s_bb - s_ab * s_ab), 0)), 6) AS md "
    "FROM (SELECT id, income - ma AS da, recency - mb AS db, s_aa, s_ab, s_bb FROM mv, "
    "(SELECT avg(income) AS ma, avg(recency) AS mb, covar_samp(income, income) AS s_aa, "
    "covar_samp(income, recency) AS s_ab, covar_samp(recency, recency) AS s_bb FROM mv) st)", _MV_CTE))
oracle("cooks_distance_2reg", staged(
    "SELECT id, round(e * e / (2 * s2) * h / ((1 - h) * (1 - h)), 6) AS cooks_d FROM ("
    "SELECT id, e, h, (SELECT sum(e2) FROM r2) / (count(*) OVER () - 2) AS s2 FROM r2)",
    _MV_CTE,
    "xx AS (SELECT sum(recency * recency) AS a, sum(recency * mnt_wines) AS b, sum(mnt_wines * mnt_wines) AS c, "
    "sum(recency * income) AS py, sum(mnt_wines * income) AS qy FROM mv)",
    "inv AS (SELECT c / (a * c - b * b) AS i11, -b / (a * c - b * b) AS i12, a / (a * c - b * b) AS i22, py, qy FROM xx)",
    "coef AS (SELECT i11 * py + i12 * qy AS b1, i12 * py + i22 * qy AS b2, i11, i12, i22 FROM inv)",
    "r2 AS (SELECT id, income - (b1 * recency + b2 * mnt_wines) AS e, (income - (b1 * recency + b2 * mnt_wines)) * "
    "(income - (b1 * recency + b2 * mnt_wines)) AS e2, i11 * recency * recency + 2 * i12 * recency * mnt_wines + "
    "i22 * mnt_wines * mnt_wines AS h FROM mv, coef)"))


# ------------------------------------------------------ 2.3 key set filters
oracle("key_anti_filter", out_sql("SELECT * FROM num WHERE id NOT IN (SELECT id FROM boxids)"))
oracle("key_semi_filter", with_c360(
    f"SELECT id, income, recency, response FROM c360 WHERE id IN (SELECT id FROM (SELECT id, "
    f"count(*) OVER (PARTITION BY {_DUP}, response) AS na, count(*) OVER (PARTITION BY {_DUP}) AS nb "
    "FROM c360) WHERE na = nb)"))


# ------------------------------------------- numeric operators over lineitem
LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINES = ("WITH lines AS (SELECT l_orderkey * 8 + l_linenumber AS id, " + ", ".join(LINE)
         + ", CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS response, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem)")


def lines_sql(body: str, *ctes: str) -> str:
    return ", ".join([LINES, *ctes]) + " " + body


oracle("describe_lines", lines_sql(_describe(LINE, "lines").replace(", 6)", ", 4)")))
oracle("five_number_lines", lines_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS var, year, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q1, "
    f"round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3, round(max({c}), 6) AS max "
    f"FROM lines GROUP BY year" for c in LINE)))


def _line_counts(c):
    return (f"g AS (SELECT {c} AS score, count(*) FILTER (WHERE response = 1) AS pos, count(*) FILTER (WHERE response <> 1) AS neg "
            f"FROM lines GROUP BY {c})")


oracle("auroc_lines", lines_sql(
    "SELECT sum(pos * (coalesce(neg_below, 0) + neg * 0.5)) / CAST(sum(pos) * sum(neg) AS DOUBLE) AS auroc FROM "
    "(SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS neg_below FROM g) c",
    _line_counts("l_extendedprice")))
oracle("roc_lines", lines_sql(
    "SELECT score AS l_quantity, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, "
    "CAST(sum(pos) OVER (ORDER BY score DESC) AS DOUBLE) / (SELECT sum(pos) FROM g) AS tpr, "
    "CAST(sum(neg) OVER (ORDER BY score DESC) AS DOUBLE) / (SELECT sum(neg) FROM g) AS fpr FROM g", _line_counts("l_quantity")))
oracle("robust_z_lines", lines_sql(
    " UNION ALL ".join(
        f"SELECT id, '{c}' AS var FROM lines, med, mad WHERE CASE WHEN mad_{c} = 0 THEN {c} - md_{c} <> 0 "
        f"ELSE abs(0.6745 * ({c} - md_{c}) / mad_{c}) > 1.5 END" for c in LINE),
    "med AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS md_{c}" for c in LINE) + " FROM lines)",
    "mad AS (SELECT " + ", ".join(f"quantile_cont(abs({c} - md_{c}), 0.5) AS mad_{c}" for c in LINE) + " FROM lines, med)"))
_LZ = ("lz AS (SELECT id, " + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in LINE) + " FROM lines, (SELECT "
       + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in LINE) + " FROM lines) st)")
_LQ = "lq AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in LINE) + " FROM lz)"
oracle("boxplot_lines", lines_sql(
    "SELECT id, var, round(dist, 4) AS dist FROM box WHERE dist IS NOT NULL",
    _LZ, _LQ, "box AS (" + " UNION ALL ".join(
        f"SELECT id, '{c}' AS var, CASE WHEN {c} > b_{c} + 0.4 * (b_{c} - a_{c}) THEN {c} - (b_{c} + 0.4 * (b_{c} - a_{c})) "
        f"WHEN {c} < a_{c} - 0.4 * (b_{c} - a_{c}) THEN (a_{c} - 0.4 * (b_{c} - a_{c})) - {c} END AS dist FROM lz, lq" for c in LINE) + ")"))
oracle("chi2_lines", lines_sql(
    "SELECT var, chi2, CAST(dof AS BIGINT) AS dof, CAST(row_number() OVER (ORDER BY chi2 DESC, var) AS INTEGER) AS rank "
    "FROM (SELECT var, round(chi2, 6) AS chi2, dof FROM chi)",
    "chl AS (" + " UNION ALL ".join(
        [f"SELECT '{c}' AS var, CAST({_BIN.format(c=c)} AS DOUBLE) AS v, response FROM lines, "
         f"(SELECT min({c}) AS lo_{c}, max({c}) AS hi_{c} FROM lines) b" for c in LINE]
        + ["SELECT 'year' AS var, CAST(year AS DOUBLE) AS v, response FROM lines"]) + ")", *chi2_ctes("chl")))
oracle("info_gain_lines", lines_sql(
    "SELECT var, value AS best_value, round(gain, 6) AS gain FROM (SELECT *, row_number() OVER "
    "(PARTITION BY var ORDER BY gain DESC, value) AS rn FROM gains) WHERE rn = 1", _gain_sql(LINE).replace("FROM featured", "FROM lines")))

# ------------------------------------------------------ splits and folds, counted
oracle("split_counts", staged(
    "SELECT response, CAST(floor(n * 0.2 + 0.5) AS BIGINT) AS test, n - CAST(floor(n * 0.2 + 0.5) AS BIGINT) AS train FROM "
    "(SELECT response, count(*) AS n FROM cleaned GROUP BY response)"))
oracle("fold_counts", staged(
    "SELECT response, CAST(k AS INTEGER) AS fold, n // 5 + CASE WHEN k < n % 5 THEN 1 ELSE 0 END AS n FROM "
    "(SELECT response, count(*) AS n FROM cleaned GROUP BY response), (SELECT unnest(range(5)) AS k) f"))
