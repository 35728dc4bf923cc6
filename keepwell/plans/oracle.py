"""Independent brute-force SQL (DuckDB dialect) for every exactly checkable query.

These statements restate each rule in the most direct relational form –
``row_number`` dedup, per-cutoff joins, ``lag``, unpartitioned windows – with
none of the scale machinery of the Spark plans, so agreement is a real check.
Literals are cast to DOUBLE so arithmetic is binary floating point, as in Spark.
"""

from __future__ import annotations

from keepwell.config import EconomicScenario, ORDERS_PARAMS, ORDERS_SCENARIO, EVENTS_PARAMS, ModelParams, _ts
from keepwell.functions.columns import EUROPE_COUNTRIES
from keepwell.sources.tables import EVENT_COUNTRIES

P = ORDERS_PARAMS
S = ORDERS_SCENARIO
FRACTION = ModelParams().budget_fraction
TS_FMT = "%Y-%m-%d %H:%M:%S.%f"
DAY_US = "CAST(86400000000 AS DOUBLE)"


def d(x) -> str:
    """A double literal that round-trips exactly."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def final(inner: str, dbl=(), ts=(), order: str = "") -> str:
    rep = [f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in dbl] + [f"strftime({c}, '{TS_FMT}') AS {c}" for c in ts]
    head = f"SELECT * REPLACE ({', '.join(rep)})" if rep else "SELECT *"
    return f"{head} FROM ({inner}) {order}"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


ORDERS_TX = r"""
tx AS (
  SELECT
    CASE WHEN l.l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(o.o_orderkey AS VARCHAR) AS invoice_no,
    CAST(l.l_partkey AS VARCHAR) AS stock_code,
    p.p_name AS description,
    CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS DOUBLE) AS quantity,
    o.o_orderdate AS invoice_date,
    CAST(p.p_retailprice AS DOUBLE) AS unit_price,
    regexp_replace(CAST(o.o_custkey AS VARCHAR), '\.0$', '') AS customer_id,
    cn.n_name AS country
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN (SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) cn
    ON o.o_custkey = cn.c_custkey
)"""

EVENTS_TX = r"""
tx AS (
  SELECT
    CASE WHEN event_type = 'error' THEN 'C' ELSE '' END || CAST(event_id AS VARCHAR) AS invoice_no,
    json_extract_string(props, '$.k') AS stock_code,
    CAST(NULL AS VARCHAR) AS description,
    CASE WHEN event_type = 'error' THEN CAST(-1.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS quantity,
    ts AS invoice_date,
    CAST(value AS DOUBLE) AS unit_price,
    regexp_replace(CAST(user_id AS VARCHAR), '\.0$', '') AS customer_id,
    ({EVENT_COUNTRIES}::VARCHAR[])[(user_id % {N})::INT + 1] AS country
  FROM events WHERE event_type IN ('purchase', 'error')
)"""

EVENTS_TX = EVENTS_TX.replace("{EVENT_COUNTRIES}", str(list(EVENT_COUNTRIES))).replace("{N}", str(len(EVENT_COUNTRIES)))

NTX = r"""
ntx AS (
  SELECT *,
    (coalesce(starts_with(upper(invoice_no), 'C'), false) OR coalesce(quantity < 0, false)) AS is_cancellation,
    quantity * unit_price AS line_value,
    md5(concat_ws(chr(31), coalesce(invoice_no, chr(0)), coalesce(stock_code, chr(0)),
        coalesce(CAST(epoch_us(invoice_date) AS VARCHAR), chr(0)), coalesce(customer_id, chr(0)))) AS event_id
  FROM tx
)"""

NTX_COLS = ["invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price", "customer_id",
            "country", "is_cancellation", "line_value", "event_id"]


def cut_cte(params) -> str:
    rows = ", ".join(f"('{s}', TIMESTAMP '{c.isoformat(sep=' ')}')" for s, c in params.cutoffs())
    return f"cut AS (SELECT * FROM (VALUES {rows}) v(split, cutoff_date))"


def segment_sql(col: str) -> str:
    europe = ", ".join(f"'{c}'" for c in EUROPE_COUNTRIES)
    return (f"CASE WHEN {col} = 'United Kingdom' THEN 'United Kingdom' WHEN {col} IN ({europe}) "
            f"THEN 'Europe' ELSE 'Rest of world' END")


def snapshot_ctes(params, tx_cte: str = ORDERS_TX) -> list[str]:
    h, hz, r = params.history_days, params.horizon_days, params.recent_window_days
    if tx_cte is ORDERS_TX:
        seg = ("coalesce((SELECT r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey "
               "WHERE n.n_name = latest.country), 'Rest of world')")
    else:
        seg = segment_sql('latest.country')
    return [tx_cte, NTX, cut_cte(params),
            "bnd AS (SELECT min(invoice_date) AS lo, max(invoice_date) AS hi FROM ntx)",
            """lines AS (SELECT *, (NOT is_cancellation AND coalesce(quantity > 0, false)
                 AND coalesce(unit_price >= 0, false)) AS pos FROM ntx WHERE customer_id IS NOT NULL)""",
            """dedup AS (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY
                 quantity NULLS FIRST, unit_price NULLS FIRST, description NULLS FIRST, country NULLS FIRST,
                 invoice_no NULLS FIRST, stock_code NULLS FIRST, invoice_date NULLS FIRST) = 1)""",
            f"""hist AS (SELECT c.split, c.cutoff_date, x.* FROM dedup x JOIN cut c
                 ON x.invoice_date > c.cutoff_date - INTERVAL {h} DAY AND x.invoice_date <= c.cutoff_date)""",
            "posh AS (SELECT *, quantity * unit_price AS pv FROM hist WHERE pos)",
            f"""base AS (SELECT split, cutoff_date, customer_id, sum(pv) AS mon, sum(quantity) AS qty,
                 count(DISTINCT invoice_no) AS n_inv, count(DISTINCT stock_code) AS n_prod,
                 min(invoice_date) AS first_d, max(invoice_date) AS last_d, count(DISTINCT event_id) AS n_ev,
                 sum(pv) FILTER (WHERE invoice_date > cutoff_date - INTERVAL {r} DAY) AS rec_v,
                 count(DISTINCT invoice_no) FILTER (WHERE invoice_date > cutoff_date - INTERVAL {r} DAY) AS rec_n,
                 sum(pv) FILTER (WHERE invoice_date > cutoff_date - INTERVAL {2 * r} DAY
                                 AND invoice_date <= cutoff_date - INTERVAL {r} DAY) AS his_v,
                 count(DISTINCT invoice_no) FILTER (WHERE invoice_date > cutoff_date - INTERVAL {2 * r} DAY
                                 AND invoice_date <= cutoff_date - INTERVAL {r} DAY) AS his_n
               FROM posh GROUP BY split, cutoff_date, customer_id)""",
            """canc AS (SELECT split, cutoff_date, customer_id,
                 CAST(count_if(is_cancellation) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS cancellation_rate
               FROM hist GROUP BY split, cutoff_date, customer_id)""",
            """latest AS (SELECT split, cutoff_date, customer_id, country FROM hist QUALIFY row_number() OVER
                 (PARTITION BY split, cutoff_date, customer_id ORDER BY invoice_date DESC, country DESC) = 1)""",
            """inv AS (SELECT split, cutoff_date, customer_id, invoice_no, min(invoice_date) AS idate
               FROM posh GROUP BY split, cutoff_date, customer_id, invoice_no)""",
            "ud AS (SELECT DISTINCT split, cutoff_date, customer_id, idate FROM inv)",
            f"""gp AS (SELECT split, cutoff_date, customer_id, CAST(epoch_us(idate) - epoch_us(lag(idate) OVER
                 (PARTITION BY split, cutoff_date, customer_id ORDER BY idate)) AS DOUBLE) / {DAY_US} AS g FROM ud)""",
            """reg AS (SELECT split, cutoff_date, customer_id,
                 CASE WHEN count(g) >= 2 THEN stddev_pop(g) END AS purchase_regularity_days
               FROM gp GROUP BY split, cutoff_date, customer_id)""",
            f"""feat AS (
              SELECT b.split, b.cutoff_date, b.customer_id,
                CAST(epoch_us(b.cutoff_date) - epoch_us(b.last_d) AS DOUBLE) / {DAY_US} AS recency_days,
                CAST(epoch_us(b.cutoff_date) - epoch_us(b.first_d) AS DOUBLE) / {DAY_US} AS customer_tenure_days,
                CAST(b.mon AS DOUBLE) AS monetary_value,
                CAST(b.mon AS DOUBLE) / CAST(b.n_inv AS DOUBLE) AS average_order_value,
                CAST(b.n_inv AS BIGINT) AS number_of_invoices,
                CAST(b.n_prod AS BIGINT) AS number_of_unique_products,
                reg.purchase_regularity_days,
                canc.cancellation_rate,
                CAST(b.qty AS DOUBLE) AS quantity_purchased,
                coalesce(CAST(b.rec_v AS DOUBLE), {d(0)}) AS recent_spend,
                coalesce(CAST(b.his_v AS DOUBLE), {d(0)}) AS historical_spend,
                CAST(coalesce(b.rec_n, 0) AS BIGINT) AS recent_invoice_count,
                CAST(coalesce(b.his_n, 0) AS BIGINT) AS historical_invoice_count,
                {seg} AS geographic_segment,
                b.first_d AS first_purchase_date, b.last_d AS last_purchase_date,
                b.last_d AS feature_max_event_date, CAST(b.n_ev AS BIGINT) AS feature_event_count
              FROM base b
              LEFT JOIN reg USING (split, cutoff_date, customer_id)
              LEFT JOIN canc USING (split, cutoff_date, customer_id)
              LEFT JOIN latest USING (split, cutoff_date, customer_id))""",
            f"""feat2 AS (SELECT *,
                CAST(number_of_invoices AS DOUBLE) / greatest(customer_tenure_days / {d(30)}, {d(1)}) AS purchase_frequency,
                (recent_spend - historical_spend) / (abs(historical_spend) + {d(1)}) AS recent_purchasing_trend,
                (recent_spend + {d(1)}) / (historical_spend + {d(1)}) AS spend_change_ratio,
                (CAST(recent_invoice_count AS DOUBLE) + {d(1)}) / (CAST(historical_invoice_count AS DOUBLE) + {d(1)})
                  AS frequency_change_ratio
              FROM feat)""",
            f"""fut AS (SELECT c.split, c.cutoff_date, l.customer_id, l.invoice_date, l.event_id FROM lines l JOIN cut c
                 ON l.invoice_date > c.cutoff_date AND l.invoice_date <= c.cutoff_date + INTERVAL {hz} DAY WHERE l.pos)""",
            """lab AS (SELECT split, cutoff_date, customer_id, min(invoice_date) AS label_min_event_date,
                 max(invoice_date) AS label_max_event_date, count(DISTINCT event_id) AS label_n
               FROM fut GROUP BY split, cutoff_date, customer_id)""",
            f"""cand0 AS (
              SELECT f.*, lab.label_min_event_date, lab.label_max_event_date,
                CAST(coalesce(lab.label_n, 0) AS BIGINT) AS label_event_count,
                CAST(CASE WHEN lab.label_n IS NULL THEN 1 ELSE 0 END AS BIGINT) AS churn,
                f.cutoff_date - INTERVAL {h} DAY AS feature_window_start,
                f.cutoff_date + INTERVAL 1 MICROSECOND AS label_window_start,
                f.cutoff_date + INTERVAL {hz} DAY AS label_window_end,
                (SELECT lo FROM bnd) <= f.cutoff_date - INTERVAL {h} DAY AS observation_history_complete,
                NOT ((SELECT lo FROM bnd) <= f.cutoff_date - INTERVAL {h} DAY) AS f1,
                NOT (f.cutoff_date + INTERVAL {hz} DAY <= (SELECT hi FROM bnd)) AS f2,
                coalesce(f.recency_days > {params.max_recency_days}, false) AS f3,
                coalesce(f.number_of_invoices < {params.minimum_invoices}, false) AS f4
              FROM feat2 f LEFT JOIN lab USING (split, cutoff_date, customer_id))""",
            """cand AS (SELECT *, NOT (f1 OR f2 OR f3 OR f4) AS is_eligible,
                CASE WHEN f1 OR f2 OR f3 OR f4 THEN concat_ws(';',
                  CASE WHEN f1 THEN 'incomplete_observation_history' END,
                  CASE WHEN f2 THEN 'incomplete_future_label_horizon' END,
                  CASE WHEN f3 THEN 'recency_above_maximum' END,
                  CASE WHEN f4 THEN 'insufficient_invoices' END) ELSE 'eligible' END AS eligibility_reason,
                CASE WHEN f1 THEN 'incomplete_observation_history' WHEN f2 THEN 'incomplete_future_label_horizon'
                  WHEN f3 THEN 'recency_above_maximum' WHEN f4 THEN 'insufficient_invoices' ELSE 'eligible' END
                  AS primary_exclusion_reason
              FROM cand0)""",
            "snap AS (SELECT * FROM cand WHERE is_eligible)"]


def pct(col: str, desc: bool = False) -> str:
    o = f"{col} DESC" if desc else col
    return (f"((CAST(rank() OVER (ORDER BY {o}) - 1 AS DOUBLE) + CAST(count(*) OVER (PARTITION BY {col}) + 1 AS DOUBLE)"
            f" / {d(2)}) / CAST(count(*) OVER () AS DOUBLE))")


def scored_ctes(split: str, name: str, src: str = "snap") -> list[str]:
    return [
        f"""{name}0 AS (SELECT *, {pct('recency_days')} AS r1, {pct('recent_purchasing_trend', True)} AS r2
              FROM {src} WHERE split = '{split}')""",
        f"""{name} AS (SELECT *, least(greatest({d(0.7)} * r1 + {d(0.3)} * r2, {d(0.001)}), {d(0.999)})
              AS churn_probability FROM {name}0)""",
    ]


def cohort_ctes(split: str = "test") -> list[str]:
    return snapshot_ctes(P) + scored_ctes(split, "coh")


FEATURE_COLUMNS = [
    "recency_days", "purchase_frequency", "monetary_value", "average_order_value", "customer_tenure_days",
    "number_of_invoices", "number_of_unique_products", "recent_purchasing_trend", "cancellation_rate",
    "quantity_purchased", "recent_spend", "historical_spend", "spend_change_ratio", "recent_invoice_count",
    "historical_invoice_count", "frequency_change_ratio", "first_purchase_date", "last_purchase_date",
    "feature_event_count",
]
FEATURE_DOUBLES = ["recency_days", "purchase_frequency", "monetary_value", "average_order_value",
                   "customer_tenure_days", "recent_purchasing_trend", "cancellation_rate", "quantity_purchased",
                   "recent_spend", "historical_spend", "spend_change_ratio", "frequency_change_ratio"]
KEYS = "split, cutoff_date, customer_id"


def _economics_select(src: str = "coh", S: EconomicScenario = S) -> str:
    annual = S.economic_horizon_days / P.history_days
    unit = S.expected_contact_cost()
    return f"""econ AS (SELECT *, p_ * {d(S.incremental_retention_effect)} * m_ - {d(unit)} AS expected_net_value,
                 p_ * m_ AS value_at_risk, m_ AS estimated_margin_at_risk
               FROM (SELECT *, churn_probability AS p_, CASE WHEN monetary_value IS NOT NULL THEN
                 greatest(monetary_value * {d(S.gross_margin_rate)} * {d(annual)}, {d(S.minimum_customer_margin)}) END AS m_
               FROM {src}))"""


def _capacity_ctes(policy: str, S: EconomicScenario = S) -> list[str]:
    unit = S.expected_contact_cost()
    econ_cap = "least(n, greatest(0, e))" if policy == "expected_value" else "n"
    bind_value = "CASE WHEN k = e_cap THEN 'positive_expected_value' END" if policy == "expected_value" else "NULL"
    return [
        f"""capc AS (SELECT n, e, {"n" if unit == 0 else f"least(n, CAST(floor({d(S.total_budget)} / {d(unit)}) AS BIGINT))"} AS b_cap,
              least(n, CAST(floor(CAST(n AS DOUBLE) * {d(S.max_contact_fraction)}) AS BIGINT)) AS o_cap,
              {econ_cap} AS e_cap
            FROM (SELECT count(*) AS n, count_if(expected_net_value > 0) AS e FROM econ))""",
        f"""cap AS (SELECT *, CASE WHEN len(lst) = 1 THEN lst[1] ELSE 'joint:' || array_to_string(lst, '+') END AS binding
            FROM (SELECT *, list_filter([CASE WHEN k = b_cap THEN 'financial_budget' END,
                    CASE WHEN k = o_cap THEN 'operational_capacity' END, {bind_value}], lambda x: x IS NOT NULL) AS lst
                  FROM (SELECT *, greatest(0, least(n, b_cap, o_cap, e_cap)) AS k FROM capc)))""",
    ]


def _ranked_cte(policy: str, S: EconomicScenario = S) -> str:
    score = "expected_net_value" if policy == "expected_value" else "churn_probability"
    sel = ("expected_net_value > 0 AND policy_rank <= k" if policy == "expected_value" else "policy_rank <= k")
    if policy == "expected_value":
        reason = ("CASE WHEN sel THEN 'Highest positive expected net value within portfolio constraints' "
                  "WHEN coalesce(expected_net_value <= 0, false) THEN 'Non-positive expected net value' "
                  "ELSE 'Below the rank allowed by ' || binding END")
    else:
        reason = ("CASE WHEN sel THEN 'Highest churn probability within portfolio constraints' "
                  "ELSE 'Below the rank allowed by ' || binding END")
    return f"""ranked AS (SELECT *, CASE WHEN sel THEN 'contact' ELSE 'do_not_contact' END AS recommended_action,
                 {reason} AS selection_reason, '{S.scenario_name}' AS economic_scenario,
                 coalesce(expected_net_value > 0, false) AS economic_eligibility
               FROM (SELECT *, {sel} AS sel FROM (SELECT e.*, cap.k, cap.binding, cap.b_cap, cap.o_cap, CAST(row_number() OVER
                 (ORDER BY {score} DESC NULLS LAST, customer_id) AS BIGINT) AS policy_rank FROM econ e, cap)))"""


def policy_ctes(policy: str, S: EconomicScenario = S) -> list[str]:
    return cohort_ctes() + [_economics_select(S=S)] + _capacity_ctes(policy, S) + [_ranked_cte(policy, S)]


def summary_select(policy: str, S: EconomicScenario = S) -> str:
    unit = S.expected_contact_cost()
    eff = S.incremental_retention_effect
    return f"""SELECT '{policy}' AS policy, CAST(count(*) AS BIGINT) AS customers,
        CAST(max(k) AS BIGINT) AS contact_capacity, CAST(max(b_cap) AS BIGINT) AS budget_based_contact_capacity,
        CAST(max(o_cap) AS BIGINT) AS operations_based_contact_capacity,
        CAST(count_if(expected_net_value > 0) AS BIGINT) AS economically_eligible_customers,
        max(binding) AS binding_constraint,
        CAST(count_if(sel) AS BIGINT) AS customers_contacted,
        CAST(count_if(sel) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS contact_rate,
        coalesce(sum(expected_net_value) FILTER (WHERE sel), {d(0)}) AS expected_net_value,
        CASE WHEN count_if(sel) > 0 THEN sum(expected_net_value) FILTER (WHERE sel) / CAST(count_if(sel) AS DOUBLE)
          ELSE {d(0)} END AS expected_net_value_per_contact,
        coalesce(sum(value_at_risk) FILTER (WHERE sel), {d(0)}) AS estimated_value_at_risk,
        coalesce(avg(churn_probability) FILTER (WHERE sel), {d(0)}) AS average_churn_probability,
        coalesce(avg(estimated_margin_at_risk) FILTER (WHERE sel), {d(0)}) AS average_estimated_margin_at_risk,
        CAST(count_if(sel) AS DOUBLE) * {d(unit)} AS expected_campaign_cost,
        {d(S.total_budget)} - CAST(count_if(sel) AS DOUBLE) * {d(unit)} AS remaining_budget,
        CAST(count_if(sel) AS DOUBLE) * {d(unit)} / {d(S.total_budget)} * {d(100)} AS budget_utilization_percentage,
        CAST(count_if(sel AND churn = 1) AS BIGINT) AS observed_churners_contacted,
        CAST(count_if(churn = 1) AS BIGINT) AS observed_churners,
        CASE WHEN count_if(churn = 1) > 0 THEN CAST(count_if(sel AND churn = 1) AS DOUBLE) / CAST(count_if(churn = 1) AS DOUBLE)
          ELSE {d(0)} END AS recall_at_budget,
        CASE WHEN count_if(sel) > 0 THEN CAST(count_if(sel AND churn = 1) AS DOUBLE) / CAST(count_if(sel) AS DOUBLE)
          ELSE {d(0)} END AS precision_at_budget,
        CASE WHEN count_if(churn = 1) > 0 AND count_if(sel) > 0 THEN
          (CAST(count_if(sel AND churn = 1) AS DOUBLE) / CAST(count_if(sel) AS DOUBLE)) /
          (CAST(count_if(churn = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE)) ELSE {d(0)} END AS lift_at_budget,
        coalesce(sum(churn * {d(eff)} * estimated_margin_at_risk - {d(unit)}) FILTER (WHERE sel), {d(0)})
          AS scenario_realized_net_value
      FROM ranked"""


SUMMARY_DOUBLES = ["contact_rate", "expected_net_value", "expected_net_value_per_contact", "estimated_value_at_risk",
                   "average_churn_probability", "average_estimated_margin_at_risk", "expected_campaign_cost",
                   "remaining_budget", "budget_utilization_percentage", "recall_at_budget", "precision_at_budget",
                   "lift_at_budget", "scenario_realized_net_value"]


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    snap = snapshot_ctes(P)
    q["normalize_transactions"] = final(with_(ORDERS_TX, NTX) + "SELECT * FROM ntx",
                                        dbl=["quantity", "unit_price", "line_value"], ts=["invoice_date"])
    q["event_transactions"] = final(with_(EVENTS_TX, NTX) + "SELECT * FROM ntx",
                                    dbl=["quantity", "unit_price", "line_value"], ts=["invoice_date"])
    # the stream keeps one line per event id; event ids are unique in the events table
    q["stream_transactions"] = q["event_transactions"]
    number = "CAST(replace(invoice_no, 'C', '') AS BIGINT)"
    copies = f"count(*) + count_if({number} % 7 = 0) + count_if({number} % 11 = 0) - count(DISTINCT event_id)"
    q["stream_accounting"] = with_(EVENTS_TX, NTX) + " UNION ALL ".join(
        f"SELECT customer_id, '{fate}' AS fate, CAST({n} AS BIGINT) AS lines FROM ntx GROUP BY customer_id HAVING {n} > 0"
        for fate, n in (("kept", "count(DISTINCT event_id)"), ("repeated", copies), ("late", f"count_if({number} % 13 = 0)")))
    usable = "customer_id IS NOT NULL AND customer_id <> ''"
    iso = ("CASE WHEN strftime({c}, '%f') = '000000' THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') "
           "ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END")
    vs = f"""SELECT CAST(count(*) AS BIGINT) AS all_rows, CAST(count_if({usable}) AS BIGINT) AS rows,
        CAST(count(DISTINCT customer_id) FILTER (WHERE {usable}) AS BIGINT) AS customers,
        {iso.format(c=f"min(invoice_date) FILTER (WHERE {usable})")} AS minimum_date,
        {iso.format(c=f"max(invoice_date) FILTER (WHERE {usable})")} AS maximum_date,
        CAST(count_if(NOT ({usable})) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS missing_customer_rate,
        CAST(count_if({usable}) - count(DISTINCT event_id) FILTER (WHERE {usable}) AS DOUBLE)
          / CAST(count_if({usable}) AS DOUBLE) AS duplicate_event_rate,
        CAST(count_if({usable} AND is_cancellation) AS DOUBLE) / CAST(count_if({usable}) AS DOUBLE) AS cancellation_rate,
        CAST(count_if(coalesce(unit_price < 0, false)) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS negative_price_rate
      FROM ntx"""
    vs_d = ["missing_customer_rate", "duplicate_event_rate", "cancellation_rate", "negative_price_rate"]
    q["validation_summary"] = final(with_(ORDERS_TX, NTX) + vs, dbl=vs_d)
    q["duplicate_event_rate"] = final(with_(ORDERS_TX, NTX) + f"SELECT rows, duplicate_event_rate FROM ({vs})",
                                      dbl=["duplicate_event_rate"])
    q["transaction_eda"] = final(with_(ORDERS_TX, NTX) + """SELECT CAST(count(*) AS BIGINT) AS rows,
        CAST(count(DISTINCT customer_id) AS BIGINT) AS customers, min(invoice_date) AS start, max(invoice_date) AS "end",
        avg(CASE WHEN is_cancellation THEN 1.0 ELSE 0.0 END) AS cancellation_rate FROM ntx""",
                                 dbl=["cancellation_rate"], ts=["start", '"end"'])

    q["recency_threshold"] = threshold_sql(P, ORDERS_TX)
    q["event_recency_threshold"] = threshold_sql(EVENTS_PARAMS, EVENTS_TX)

    feat_cols = ", ".join(FEATURE_COLUMNS)
    q["customer_features"] = final(with_(*snap) + f"SELECT {KEYS}, {feat_cols} FROM cand", dbl=FEATURE_DOUBLES,
                                   ts=["cutoff_date", "first_purchase_date", "last_purchase_date"])
    q["purchase_regularity"] = final(with_(*snap) + f"SELECT {KEYS}, purchase_regularity_days FROM cand",
                                     dbl=["purchase_regularity_days"], ts=["cutoff_date"])
    q["latest_segment"] = final(with_(*snap) + f"SELECT {KEYS}, geographic_segment FROM cand", ts=["cutoff_date"])
    q["future_label"] = final(with_(*snap) + f"""SELECT {KEYS}, label_min_event_date, label_max_event_date,
        CAST(label_n AS BIGINT) AS label_event_count FROM lab""",
                              ts=["cutoff_date", "label_min_event_date", "label_max_event_date"])
    q["snapshots"] = final(with_(*snap) + f"""SELECT {KEYS}, {feat_cols}, purchase_regularity_days, geographic_segment,
        label_min_event_date, label_max_event_date, label_event_count, churn, feature_window_start, label_window_start,
        label_window_end FROM snap""", dbl=FEATURE_DOUBLES + ["purchase_regularity_days"],
                           ts=["cutoff_date", "first_purchase_date", "last_purchase_date", "label_min_event_date",
                               "label_max_event_date", "feature_window_start", "label_window_start",
                               "label_window_end"])
    ev_snap = snapshot_ctes(EVENTS_PARAMS, EVENTS_TX)
    q["bucketed_snapshots"] = q["snapshots"]
    q["event_snapshots"] = final(with_(*ev_snap) + f"""SELECT {KEYS}, recency_days, number_of_invoices, monetary_value,
        purchase_regularity_days, geographic_segment, label_event_count, churn, is_eligible, eligibility_reason
      FROM cand""",
                                 dbl=["recency_days", "monetary_value", "purchase_regularity_days"], ts=["cutoff_date"])
    q["eligibility_reasons"] = final(with_(*snap) + f"""SELECT {KEYS}, observation_history_complete, is_eligible,
        eligibility_reason, primary_exclusion_reason FROM cand""", ts=["cutoff_date"])
    crit = ["incomplete_observation_history", "incomplete_future_label_horizon", "recency_above_maximum",
            "insufficient_invoices"]
    fails = ", ".join(f"CAST(count_if(contains(eligibility_reason, '{k}')) AS BIGINT) AS fails_{k}" for k in crit)
    prim = ", ".join(f"CAST(count_if(primary_exclusion_reason = '{k}') AS BIGINT) AS primary_{k}" for k in crit)
    es = f"""SELECT split, cutoff_date, CAST(count(*) AS BIGINT) AS total_customers_before_eligibility,
        CAST(count_if(is_eligible) AS BIGINT) AS eligible_customers, CAST(count_if(NOT is_eligible) AS BIGINT) AS excluded_customers,
        CAST(count_if(is_eligible AND churn = 1) AS BIGINT) AS eligible_churners, {fails}, {prim},
        CAST(count_if(is_eligible AND churn = 1) AS DOUBLE) / CAST(count_if(is_eligible) AS DOUBLE) AS eligible_churn_prevalence
      FROM cand GROUP BY split, cutoff_date"""
    q["eligibility_summary"] = final(with_(*snap) + es, dbl=["eligible_churn_prevalence"], ts=["cutoff_date"])
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in
                     ["total_customers_before_eligibility", "eligible_customers", "excluded_customers",
                      "eligible_churners"] + [f"fails_{k}" for k in crit] + [f"primary_{k}" for k in crit])
    q["eligibility_rollup"] = final(with_(*snap) + f"""SELECT CAST(count(*) AS BIGINT) AS cutoffs, {sums},
        CAST(sum(eligible_churners) AS DOUBLE) / CAST(sum(eligible_customers) AS DOUBLE) AS eligible_churn_prevalence
      FROM ({es})""", dbl=["eligible_churn_prevalence"])
    h, hz = P.history_days, P.horizon_days
    q["leakage_violations"] = final(with_(*snap) + f"""SELECT
        (SELECT CAST(count_if(feature_max_event_date > cutoff_date) AS BIGINT) FROM snap) AS feature_after_cutoff,
        (SELECT CAST(count_if(label_min_event_date <= cutoff_date) AS BIGINT) FROM snap) AS label_at_or_before_cutoff,
        (SELECT CAST(count_if(label_min_event_date < label_window_start) AS BIGINT) FROM snap) AS label_before_window,
        (SELECT CAST(count(*) AS BIGINT) FROM (
           SELECT DISTINCT c.cutoff_date, t.event_id FROM ntx t JOIN cut c
             ON t.invoice_date > c.cutoff_date - INTERVAL {h} DAY AND t.invoice_date <= c.cutoff_date
           INTERSECT
           SELECT DISTINCT c.cutoff_date, t.event_id FROM ntx t JOIN cut c
             ON t.invoice_date > c.cutoff_date AND t.invoice_date <= c.cutoff_date + INTERVAL {hz} DAY)) AS overlapping_events,
        (SELECT CAST(count(*) AS BIGINT) FROM (SELECT split, min(cutoff_date) AS s, max(label_window_end) AS e,
            CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END AS o FROM snap GROUP BY split) a
          JOIN (SELECT split, min(cutoff_date) AS s, max(label_window_end) AS e,
            CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END AS o FROM snap GROUP BY split) b
          ON a.o < b.o WHERE a.e >= b.s) AS split_order_violations""")
    q["split_bounds"] = final(with_(*snap) + """SELECT split, min(cutoff_date) AS first_cutoff,
        max(label_window_end) AS last_label_end FROM snap GROUP BY split""", ts=["first_cutoff", "last_label_end"])
    q["snapshot_eda"] = final(with_(*snap) + """SELECT split, cutoff_date, CAST(count(*) AS BIGINT) AS customers,
        avg(CAST(churn AS DOUBLE)) AS churn_rate, quantile_cont(recency_days, 0.5) AS median_recency_days,
        quantile_cont(monetary_value, 0.5) AS median_monetary_value FROM snap GROUP BY split, cutoff_date""",
                              dbl=["churn_rate", "median_recency_days", "median_monetary_value"], ts=["cutoff_date"])

    coh = cohort_ctes()
    q["pct_rank_heuristic"] = final(with_(*coh) + f"""SELECT {KEYS}, recency_days, recent_purchasing_trend,
        churn_probability FROM coh""", dbl=["recency_days", "recent_purchasing_trend", "churn_probability"],
                                    ts=["cutoff_date"])
    bsel = coh + [f"""bs AS (SELECT *, CAST(row_number() OVER (ORDER BY churn_probability DESC, cutoff_date, customer_id)
                  AS BIGINT) AS budget_rank, greatest(1, CAST(floor(CAST(count(*) OVER () AS DOUBLE) * {d(FRACTION)}) AS BIGINT)) AS k
                  FROM coh)""",
                  "bsel AS (SELECT *, budget_rank <= k AS selected FROM bs)"]
    q["budget_topk"] = final(with_(*bsel) + f"""SELECT {KEYS}, churn_probability, budget_rank, churn FROM bsel
        WHERE selected""", dbl=["churn_probability"], ts=["cutoff_date"])
    cm = """SELECT CAST(count(*) AS BIGINT) AS customers, CAST(count_if(selected) AS BIGINT) AS contacted,
        CAST(count_if(churn = 1) AS BIGINT) AS observed_churners,
        CAST(count_if(churn = 0 AND NOT selected) AS BIGINT) AS tn, CAST(count_if(churn = 0 AND selected) AS BIGINT) AS fp,
        CAST(count_if(churn = 1 AND NOT selected) AS BIGINT) AS fn, CAST(count_if(churn = 1 AND selected) AS BIGINT) AS tp
      FROM bsel"""
    zero = d(0)
    q["budget_metrics"] = final(with_(*bsel, f"cmx AS ({cm})") + f"""SELECT customers, contacted, observed_churners,
        CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE {zero} END AS precision,
        CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE {zero} END AS recall,
        CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * CAST(tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) ELSE {zero} END AS f1,
        CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE {zero} END AS recall_at_budget,
        CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE {zero} END AS precision_at_budget,
        CASE WHEN observed_churners > 0 AND tp + fp > 0 THEN (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE)) /
          (CAST(observed_churners AS DOUBLE) / CAST(customers AS DOUBLE)) ELSE {zero} END AS lift_at_budget,
        {d(FRACTION)} AS budget_fraction FROM cmx""",
                                dbl=["precision", "recall", "f1", "recall_at_budget", "precision_at_budget",
                                     "lift_at_budget", "budget_fraction"])
    q["confusion_matrix"] = final(with_(*bsel) + f"SELECT tn, fp, fn, tp FROM ({cm})")
    st = coh + ["""st AS (SELECT churn_probability, count_if(churn = 1) AS pos, count_if(churn = 0) AS neg
                 FROM coh GROUP BY churn_probability)""",
                """stc AS (SELECT *, sum(pos) OVER (ORDER BY churn_probability DESC) AS tp,
                 sum(neg) OVER (ORDER BY churn_probability DESC) AS fp, sum(pos) OVER () AS ptot,
                 sum(neg) OVER () AS ntot FROM st)"""]
    q["roc_auc"] = final(with_(*st) + """SELECT CAST(sum(CAST(neg AS DECIMAL(38,0)) * CAST(2 * (tp - pos) + pos AS DECIMAL(38,0)))
        AS DOUBLE) / (CAST(2.0 AS DOUBLE) * CAST(max(ptot) AS DOUBLE) * CAST(max(ntot) AS DOUBLE)) AS roc_auc FROM stc""",
                         dbl=["roc_auc"])
    q["average_precision"] = final(with_(*st) + """SELECT sum((CAST(pos AS DOUBLE) / CAST(ptot AS DOUBLE)) *
        (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE))) AS average_precision FROM stc""", dbl=["average_precision"])
    q["brier"] = final(with_(*coh) + "SELECT avg(pow(churn_probability - churn, 2)) AS brier_score FROM coh",
                       dbl=["brier_score"])
    edges = ", ".join(f"quantile_cont(churn_probability, {d(i / 8)}) AS e{i}" for i in range(1, 8))
    binx = " + ".join(f"CASE WHEN e{i} < churn_probability THEN 1 ELSE 0 END" for i in range(1, 8))
    q["calibration_table"] = final(with_(*coh, f"edg AS (SELECT {edges} FROM coh)") + f"""SELECT CAST(bin AS BIGINT) AS bin,
        CAST(count(*) AS BIGINT) AS customers, avg(churn_probability) AS mean_predicted,
        avg(CAST(churn AS DOUBLE)) AS observed_rate FROM (SELECT coh.*, {binx} AS bin FROM coh, edg) GROUP BY bin""",
                                   dbl=["mean_predicted", "observed_rate"])
    q["pr_curve"] = final(with_(*st) + """SELECT churn_probability AS threshold, CAST(tp AS BIGINT) AS tp,
        CAST(fp AS BIGINT) AS fp, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
        CASE WHEN ptot > 0 THEN CAST(tp AS DOUBLE) / CAST(ptot AS DOUBLE) END AS recall FROM stc""",
                          dbl=["threshold", "precision", "recall"])
    q["gains_table"] = final(with_(*coh) + """SELECT position, captured,
        CAST(position AS DOUBLE) / CAST(n AS DOUBLE) AS population_fraction,
        CAST(captured AS DOUBLE) / CAST(greatest(p, 1) AS DOUBLE) AS gain
      FROM (SELECT CAST(row_number() OVER w AS BIGINT) AS position, CAST(sum(churn) OVER w AS BIGINT) AS captured,
              count(*) OVER () AS n, sum(churn) OVER () AS p FROM coh
            WINDOW w AS (ORDER BY churn_probability DESC, cutoff_date, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
                             dbl=["population_fraction", "gain"])

    econ = coh + [_economics_select()]
    q["margin_and_value"] = final(with_(*econ) + """SELECT customer_id, churn_probability, monetary_value,
        estimated_margin_at_risk, value_at_risk, expected_net_value,
        coalesce(expected_net_value > 0, false) AS economic_eligibility FROM econ""",
                                  dbl=["churn_probability", "monetary_value", "estimated_margin_at_risk",
                                       "value_at_risk", "expected_net_value"])
    pv = policy_ctes("expected_value")
    q["campaign_capacity"] = final(with_(*pv) + """SELECT CAST(n AS BIGINT) AS customers,
        CAST(b_cap AS BIGINT) AS budget_based_contact_capacity, CAST(o_cap AS BIGINT) AS operations_based_contact_capacity,
        CAST(e AS BIGINT) AS economically_eligible_customers, CAST(k AS BIGINT) AS contact_capacity,
        binding AS binding_constraint FROM cap""")
    pol_cols = """SELECT customer_id, churn_probability, expected_net_value, policy_rank, recommended_action,
        selection_reason FROM ranked"""
    q["policy_value"] = final(with_(*pv) + pol_cols, dbl=["churn_probability", "expected_net_value"])
    pc = policy_ctes("churn_probability")
    q["policy_churn"] = final(with_(*pc) + pol_cols, dbl=["churn_probability", "expected_net_value"])
    q["policy_summary"] = final(
        f"SELECT * FROM ({with_(*pc)}{summary_select('churn_probability')}) UNION ALL "
        f"SELECT * FROM ({with_(*pv)}{summary_select('expected_value')})", dbl=SUMMARY_DOUBLES)
    q["policy_decomposition"] = final(
        f"SELECT policy, average_churn_probability, average_estimated_margin_at_risk, expected_net_value_per_contact "
        f"FROM (SELECT * FROM ({with_(*pc)}{summary_select('churn_probability')}) UNION ALL "
        f"SELECT * FROM ({with_(*pv)}{summary_select('expected_value')}))",
        dbl=["average_churn_probability", "average_estimated_margin_at_risk", "expected_net_value_per_contact"])
    q.update(policy_sql(pc, pv, econ))
    q["hashed_queue"] = final(with_(*pv) + """SELECT substr(sha256('customer:' || customer_id), 1, 16) AS customer_id,
        churn_probability, value_at_risk, expected_net_value, economic_eligibility, recommended_action, selection_reason,
        policy_rank, economic_scenario FROM ranked""", dbl=["churn_probability", "value_at_risk", "expected_net_value"])

    from keepwell.operators.decisioning import sensitivity_grid
    grid = sensitivity_grid(S)
    gvals = ", ".join(
        f"({i}, {d(effect)}, {d(g.offer_acceptance_probability)}, {d(mult)}, {d(g.gross_margin_rate)}, "
        f"{d(g.expected_contact_cost())})" for i, (effect, mult, g) in enumerate(grid))
    annual = S.economic_horizon_days / P.history_days
    unit_cap = (f"CASE WHEN unit = 0 THEN n ELSE least(n, CAST(floor({d(S.total_budget)} / unit) AS BIGINT)) END")
    q["sensitivity_grid"] = final(with_(*coh,
        f"grid AS (SELECT * FROM (VALUES {gvals}) g(grid_id, effect, acceptance, mult, rate, unit))",
        f"""gx AS (SELECT grid.*, c.customer_id, c.churn_probability * grid.effect * (CASE WHEN c.monetary_value IS NOT NULL
              THEN greatest(c.monetary_value * grid.rate * {d(annual)}, {d(S.minimum_customer_margin)}) END) - grid.unit
              AS env FROM coh c, grid)""",
        f"""gc AS (SELECT grid_id, n, e, {unit_cap} AS b_cap,
              least(n, CAST(floor(CAST(n AS DOUBLE) * {d(S.max_contact_fraction)}) AS BIGINT)) AS o_cap, least(n, e) AS e_cap
            FROM (SELECT grid_id, max(unit) AS unit, count(*) AS n, count_if(env > 0) AS e FROM gx GROUP BY grid_id))""",
        """gk AS (SELECT *, CASE WHEN len(lst) = 1 THEN lst[1] ELSE 'joint:' || array_to_string(lst, '+') END AS binding
            FROM (SELECT *, list_filter([CASE WHEN k = b_cap THEN 'financial_budget' END,
                 CASE WHEN k = o_cap THEN 'operational_capacity' END,
                 CASE WHEN k = e_cap THEN 'positive_expected_value' END], lambda x: x IS NOT NULL) AS lst
               FROM (SELECT *, greatest(0, least(n, b_cap, o_cap, e_cap)) AS k FROM gc)))""",
        """gr AS (SELECT gx.*, gk.k, gk.binding, row_number() OVER (PARTITION BY gx.grid_id
              ORDER BY env DESC NULLS LAST, customer_id) AS r FROM gx JOIN gk USING (grid_id))""")
        + """SELECT DISTINCT effect AS incremental_retention_effect, acceptance AS offer_acceptance_probability,
            mult AS margin_multiplier, customers_contacted, expected_net_value, expected_campaign_cost, binding_constraint
          FROM (SELECT grid_id, max(effect) AS effect, max(acceptance) AS acceptance, max(mult) AS mult,
              CAST(count_if(env > 0 AND r <= k) AS BIGINT) AS customers_contacted,
              coalesce(sum(env) FILTER (WHERE env > 0 AND r <= k), CAST(0 AS DOUBLE)) AS expected_net_value,
              CAST(count_if(env > 0 AND r <= k) AS DOUBLE) * max(unit) AS expected_campaign_cost,
              max(binding) AS binding_constraint FROM gr GROUP BY grid_id)""",
        dbl=["incremental_retention_effect", "offer_acceptance_probability", "margin_multiplier",
             "expected_net_value", "expected_campaign_cost"])

    sens = q["sensitivity_grid"]
    q["sensitivity_range"] = final(f"""SELECT min(expected_net_value) AS minimum_value,
        max(expected_net_value) AS maximum_value, CAST(count(*) AS BIGINT) AS configurations FROM ({sens})""",
                                   dbl=["minimum_value", "maximum_value"])
    q["snapshot_facts"] = final(with_(*snap) + """SELECT CAST(count(*) AS BIGINT) AS rows,
        CAST(count(DISTINCT customer_id) AS BIGINT) AS customers, min(cutoff_date) AS first_cutoff,
        max(cutoff_date) AS last_cutoff, avg(CAST(churn AS DOUBLE)) AS churn_rate FROM snap""",
                                dbl=["churn_rate"], ts=["first_cutoff", "last_cutoff"])
    q["policy_lift_comparison"] = final(
        f"""SELECT c.lift_at_budget AS churn_policy_lift, c.expected_net_value AS churn_policy_value,
              v.lift_at_budget AS value_policy_lift, v.expected_net_value AS value_policy_value
            FROM ({with_(*pc)}{summary_select('churn_probability')}) c,
                 ({with_(*pv)}{summary_select('expected_value')}) v""",
        dbl=["churn_policy_lift", "churn_policy_value", "value_policy_lift", "value_policy_value"])

    rate = ["average_churn_probability", "observed_churn_rate", "recall_at_budget", "precision_at_budget",
            "lift_at_budget"]

    def fmt(c):
        return f"format('{{:.3f}}', {c}) AS {c}" if c in rate else f"format('{{:,.2f}}', {c}) AS {c}"
    cols = ["average_churn_probability", "average_estimated_margin_at_risk", "expected_net_value_per_contact",
            "observed_churn_rate", "recall_at_budget", "precision_at_budget", "lift_at_budget", "expected_net_value",
            "expected_campaign_cost"]
    q["policy_table"] = final(f"""SELECT policy, customers_contacted, {", ".join(fmt(c) for c in cols)},
        binding_constraint, {fmt("scenario_realized_net_value")}
      FROM (SELECT *, precision_at_budget AS observed_churn_rate FROM ({q["compare_policies"]}))""")

    import numpy as np
    fr = [float(v) for v in np.linspace(0.05, 0.50, 10)]
    frv = ", ".join(f"({d(f)})" for f in fr)
    q["value_by_budget"] = final(with_(*econ, f"""vb AS (SELECT CAST(row_number() OVER w AS BIGINT) AS r,
        sum(greatest(expected_net_value, {d(0)})) OVER w AS cum, count(*) OVER () AS n FROM econ
        WINDOW w AS (ORDER BY expected_net_value DESC NULLS LAST, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
        + f"""SELECT f.fr AS max_contact_fraction, vb.r AS contacts, vb.cum AS expected_net_value
      FROM (VALUES {frv}) f(fr) JOIN vb ON vb.r = greatest(1, CAST(trunc(CAST(vb.n AS DOUBLE) * f.fr) AS BIGINT))""",
                                 dbl=["max_contact_fraction", "expected_net_value"])
    q["matured_performance"] = final(
        f"""SELECT roc_auc, average_precision, brier_score, recall_at_budget, precision_at_budget, lift_at_budget
            FROM ({q["roc_auc"]}), ({q["average_precision"]}), ({q["brier"]}), ({q["budget_metrics"]})""",
        dbl=["roc_auc", "average_precision", "brier_score", "recall_at_budget", "precision_at_budget", "lift_at_budget"])
    q["csv_round_trip"] = q["normalize_transactions"].replace(
        "p.p_name AS description", "'SET \"' || p.p_name || '\", LARGE' || chr(10) || 'second line, \"' || cn.n_name || '\"' AS description")
    q.update(model_step_sql())
    q.update(drift_sql())
    q.update(portfolio_sql())
    return q


def policy_sql(pc: list[str], pv: list[str], econ: list[str]) -> dict[str, str]:
    """Random draws, the three policies together, and scenarios in which each limit binds."""
    from keepwell.plans.catalog import BRANCHES

    q: dict[str, str] = {}
    unit, eff = S.expected_contact_cost(), S.incremental_retention_effect
    k = f"least(n, CAST(floor({d(S.total_budget)} / {d(unit)}) AS BIGINT), CAST(floor(CAST(n AS DOUBLE) * {d(S.max_contact_fraction)}) AS BIGINT))"
    draws = econ + [
        "tot AS (SELECT count(*) AS n, count_if(churn = 1) AS churners, count_if(expected_net_value > 0) AS worth FROM econ)",
        f"""drawn AS (SELECT e.*, r.draw, CAST(CAST('0x' || substr(md5(CAST({S.random_seed} + r.draw AS VARCHAR) || ':' || customer_id), 1, 13)
              AS BIGINT) AS DOUBLE) / {d(16 ** 13)} AS u FROM econ e, range(200) r(draw))""",
        """placed AS (SELECT *, row_number() OVER (PARTITION BY draw ORDER BY u DESC, customer_id) AS nth FROM drawn)""",
        f"""per AS (SELECT draw, CAST(count(*) AS DOUBLE) AS c, sum(expected_net_value) AS env, sum(value_at_risk) AS var_,
              avg(churn_probability) AS p, avg(estimated_margin_at_risk) AS m, CAST(count_if(churn = 1) AS DOUBLE) AS hit,
              sum(churn * {d(eff)} * estimated_margin_at_risk - {d(unit)}) AS realized
            FROM placed, tot WHERE nth <= {k} GROUP BY draw)""",
        f"""rnd AS (SELECT 'random' AS policy, max(n) AS customers, max({k}) AS contact_capacity,
              max(least(n, CAST(floor({d(S.total_budget)} / {d(unit)}) AS BIGINT))) AS budget_based_contact_capacity,
              max(CAST(floor(CAST(n AS DOUBLE) * {d(S.max_contact_fraction)}) AS BIGINT)) AS operations_based_contact_capacity,
              max(worth) AS economically_eligible_customers, CAST(max(c) AS BIGINT) AS customers_contacted,
              max(c) / max(n) AS contact_rate, avg(env) AS expected_net_value, avg(env / c) AS expected_net_value_per_contact,
              avg(var_) AS estimated_value_at_risk, avg(p) AS average_churn_probability, avg(m) AS average_estimated_margin_at_risk,
              avg(c * {d(unit)}) AS expected_campaign_cost, avg({d(S.total_budget)} - c * {d(unit)}) AS remaining_budget,
              avg(c * {d(unit)} / {d(S.total_budget)} * 100) AS budget_utilization_percentage,
              avg(hit) AS observed_churners_contacted, max(churners) AS observed_churners,
              avg(hit / churners) AS recall_at_budget, avg(hit / c) AS precision_at_budget,
              avg((hit / c) / (CAST(churners AS DOUBLE) / n)) AS lift_at_budget, avg(realized) AS scenario_realized_net_value
            FROM per, tot)""",
        """rnd2 AS (SELECT *, CASE WHEN contact_capacity = budget_based_contact_capacity
              AND contact_capacity = operations_based_contact_capacity THEN 'joint:financial_budget+operational_capacity'
              WHEN contact_capacity = budget_based_contact_capacity THEN 'financial_budget' ELSE 'operational_capacity' END
              AS binding_constraint FROM rnd)"""]
    rnd = with_(*draws) + "SELECT * FROM rnd2"
    q["policy_random"] = final(f"""SELECT *, customers_contacted AS actual_selected_customers, precision_at_budget AS observed_churn_rate,
        CAST(200 AS BIGINT) AS benchmark_repetitions FROM ({rnd})""",
                               dbl=[*SUMMARY_DOUBLES, "observed_churners_contacted", "observed_churn_rate"])
    both = [f"SELECT * FROM ({with_(*c)}{summary_select(name)})" for c, name in ((pc, "churn_probability"), (pv, "expected_value"))]
    q["compare_policies"] = final(" UNION ALL BY NAME ".join([f"SELECT * FROM ({rnd})", *both]),
                                  dbl=[*SUMMARY_DOUBLES, "observed_churners_contacted"])
    ctes = {b.scenario_name: (policy_ctes("expected_value", b), b) for b in BRANCHES}
    q["policy_branches"] = " UNION ALL ".join(
        f"SELECT economic_scenario, customer_id, policy_rank, recommended_action, selection_reason FROM ({with_(*c)}SELECT * FROM ranked)"
        for c, _ in ctes.values())
    q["capacity_branches"] = final(" UNION ALL ".join(
        f"SELECT '{name}' AS economic_scenario, * FROM ({with_(*c)}{summary_select('expected_value', b)})"
        for name, (c, b) in ctes.items()), dbl=SUMMARY_DOUBLES)
    return q


def model_step_sql() -> dict[str, str]:
    from keepwell.plans.catalog import PLATT
    from keepwell.schemas import NUMERIC_FEATURES

    snap = snapshot_ctes(P) + ["tr AS (SELECT * FROM snap WHERE split = 'train')"]
    q = {"train_medians": final(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median FROM ({with_(*snap)}SELECT * FROM tr)"
        for c in NUMERIC_FEATURES), dbl=["median"])}
    q["segment_mode"] = with_(*snap) + """SELECT geographic_segment AS segment FROM tr WHERE geographic_segment IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1"""
    q["class_weights"] = final(with_(*snap) + """SELECT CAST(churn AS BIGINT) AS churn,
        CAST((SELECT count(*) FROM tr) AS DOUBLE) / (2 * count(*)) AS weight, CAST(count(*) AS BIGINT) AS rows FROM tr GROUP BY churn""",
                               dbl=["weight"])
    a, b = PLATT
    p = f"least(greatest(churn_probability, {d(1e-6)}), {d(1 - 1e-6)})"
    q["platt_apply"] = final(with_(*cohort_ctes()) + f"""SELECT {KEYS}, 1 / (1 + exp(-({d(a)} * ln({p} / (1 - {p})) + {d(b)})))
        AS calibrated FROM coh""", dbl=["calibrated"], ts=["cutoff_date"])
    return q


def portfolio_sql() -> dict[str, str]:
    from keepwell.operators.portfolio import CONTRACT_RANGES, CONTRACT_TEXT, WARN_RECENCY, WARN_REGULARITY, WARN_SEGMENT
    q: dict[str, str] = {}
    from keepwell.plans.catalog import STRAIN

    plain = snapshot_ctes(P) + scored_ctes("test", "port", "cand")
    m = f"CAST(customer_id AS BIGINT) % {STRAIN}"
    changed = [f"CASE {m} WHEN {i} THEN {hi + 1} WHEN {20 + i} THEN NULL WHEN {40 + i} THEN {lo - 1} ELSE {name} END AS {name}"
               for i, (name, lo, hi, _) in enumerate(CONTRACT_RANGES)]
    changed.append(f"CASE {m} WHEN 57 THEN '' WHEN 58 THEN NULL WHEN 59 THEN repeat('x', 65) ELSE geographic_segment END AS geographic_segment")
    port = plain[:-1] + [plain[-1].replace("port AS (", "port_ AS (", 1), f"port AS (SELECT * REPLACE ({', '.join(changed)}) FROM port_)"]
    checks = []
    for name, lo, hi, nullable in CONTRACT_RANGES:
        x = f"CAST({name} AS DOUBLE)"
        bad = f"({x} < {d(lo)} OR {x} > {d(hi)} OR isnan({x}))"
        if nullable:
            checks.append(f"CASE WHEN {x} IS NOT NULL AND {bad} THEN '{name} outside [{lo}, {hi}]' END")
        else:
            checks.append(f"CASE WHEN {x} IS NULL THEN '{name} is required' WHEN {bad} THEN '{name} outside [{lo}, {hi}]' END")
    for name, lo, hi in CONTRACT_TEXT:
        checks.append(f"CASE WHEN {name} IS NULL OR length({name}) < {lo} OR length({name}) > {hi} "
                      f"THEN '{name} length outside [{lo}, {hi}]' END")
    lst = f"list_filter([{', '.join(checks)}], lambda x: x IS NOT NULL)"
    q["contract_violations"] = final(with_(*port) + f"""SELECT customer_id, array_to_string({lst}, ',') AS violations,
        len({lst}) = 0 AS is_valid FROM port""")
    q["quarantined_rows"] = f"SELECT customer_id, violations FROM ({q['contract_violations']}) WHERE NOT is_valid"
    known = "(SELECT list(DISTINCT r_name) || ['Rest of world'] FROM region)"
    wl = (f"list_filter([CASE WHEN purchase_regularity_days IS NULL THEN '{WARN_REGULARITY}' END, "
          f"CASE WHEN recency_days > customer_tenure_days THEN '{WARN_RECENCY}' END, "
          f"CASE WHEN NOT coalesce(list_contains({known}, geographic_segment), false) THEN '{WARN_SEGMENT}' END], "
          f"lambda x: x IS NOT NULL)")
    q["row_warnings"] = final(with_(*port) + f"""SELECT customer_id, CAST(len({wl}) AS BIGINT) AS warning_count,
        array_to_string({wl}, ' | ') AS warnings FROM port""")
    ops = (f"list_filter([CASE WHEN NOT coalesce(observation_history_complete, true) THEN 'incomplete_observation_history' END, "
           f"CASE WHEN recency_days > {P.max_recency_days} THEN 'recency_above_maximum' END, "
           f"CASE WHEN number_of_invoices < {P.minimum_invoices} THEN 'insufficient_invoices' END], lambda x: x IS NOT NULL)")
    econ_port = plain + [f"pops AS (SELECT *, {ops} AS ops FROM port)", _economics_select("pops")]
    q["decision_reasons"] = final(with_(*econ_port) + f"""SELECT customer_id, churn_probability,
        estimated_margin_at_risk AS margin_at_risk, expected_net_value,
        len(ops) = 0 AND coalesce(expected_net_value > 0, false) AS economic_eligibility,
        CASE WHEN len(ops) > 0 THEN 'Operational eligibility failed: ' || array_to_string(ops, ', ')
             WHEN coalesce(expected_net_value <= 0, false) THEN 'Expected net value is not positive under the configured scenario'
             ELSE 'Positive expected net value; portfolio ranking is still required' END AS reason FROM econ""",
        dbl=["churn_probability", "margin_at_risk", "expected_net_value"])
    from keepwell.plans.catalog import PLATT, SCORECARD, SCORECARD_INTERCEPT, SCORECARD_MEDIANS, SCORECARD_SEGMENTS

    terms = [f"(coalesce(CAST({c} AS DOUBLE), {d(SCORECARD_MEDIANS.get(c, 0))}) - {d(mean)}) / {d(std)} * {d(weight)}"
             for c, (mean, std, weight) in SCORECARD.items()]
    terms.append("CASE WHEN geographic_segment IN (SELECT geographic_segment FROM snap WHERE split = 'train') THEN "
                 f"CASE geographic_segment {' '.join(f'WHEN {s!r} THEN {d(w)}' for s, w in SCORECARD_SEGMENTS.items())} ELSE 0 END ELSE 0 END")
    clipped = f"least(greatest(1 / (1 + exp(-z)), {d(1e-6)}), {d(1 - 1e-6)})"
    streamed = snapshot_ctes(P) + [
        f"""scores AS (SELECT *, {ops} AS ops, array_to_string({wl}, ' | ') AS warnings, {d(SCORECARD_INTERCEPT)} + {' + '.join(terms)} AS z
            FROM cand WHERE split = 'test' AND len({lst}) = 0)""",
        f"calibrated AS (SELECT *, 1 / (1 + exp(-({d(PLATT[0])} * ln({clipped} / (1 - {clipped})) + {d(PLATT[1])}))) AS churn_probability FROM scores)",
        _economics_select("calibrated")]
    q["stream_scoring_given"] = final(with_(*streamed) + """SELECT customer_id, churn_probability, 'given' AS model_version, warnings,
        estimated_margin_at_risk AS margin_at_risk, expected_net_value,
        len(ops) = 0 AND coalesce(expected_net_value > 0, false) AS economic_eligibility,
        CASE WHEN len(ops) > 0 THEN 'Operational eligibility failed: ' || array_to_string(ops, ', ')
             WHEN coalesce(expected_net_value <= 0, false) THEN 'Expected net value is not positive under the configured scenario'
             ELSE 'Positive expected net value; portfolio ranking is still required' END AS reason FROM econ""",
        dbl=["churn_probability", "margin_at_risk", "expected_net_value"])
    batch = port + [f"pops AS (SELECT *, {ops} AS ops FROM port WHERE len({lst}) = 0)",
                    "allecon AS (SELECT * FROM pops)",
                    _economics_select("(SELECT * FROM pops WHERE len(ops) = 0)")] + \
        _capacity_ctes("expected_value") + [_ranked_cte("expected_value"),
        _economics_select("(SELECT * FROM pops WHERE len(ops) > 0)").replace("econ AS", "inecon AS", 1)]
    q["batch_decisions"] = final(with_(*batch) + """SELECT customer_id, churn_probability,
          estimated_margin_at_risk AS margin_at_risk, expected_net_value, economic_eligibility, recommended_action,
          policy_rank, selection_reason AS reason FROM ranked
        UNION ALL SELECT customer_id, churn_probability, estimated_margin_at_risk, expected_net_value, false,
          'do_not_contact', CAST(row_number() OVER (ORDER BY customer_id) + (SELECT count(*) FROM ranked) AS BIGINT),
          'Operational eligibility failed: ' || array_to_string(ops, ',') FROM inecon""",
        dbl=["churn_probability", "margin_at_risk", "expected_net_value"])
    return q


MONITORED = ["recency_days", "purchase_frequency", "monetary_value", "average_order_value", "customer_tenure_days",
             "number_of_invoices", "number_of_unique_products", "purchase_regularity_days", "recent_purchasing_trend",
             "cancellation_rate", "quantity_purchased", "recent_spend", "historical_spend", "spend_change_ratio",
             "recent_invoice_count", "historical_invoice_count", "frequency_change_ratio"]
NUMERIC_MON = MONITORED + ["churn_probability"]
ORDER_OF = {c: i for i, c in enumerate(MONITORED + ["geographic_segment", "churn_probability"])}


def _long(src: str, name: str, without: str = "", unread: str = "") -> str:
    """``without``: a column that is gone; ``unread``: quantities are text where this holds."""
    value = lambda c: f"CASE WHEN {unread} THEN NULL ELSE {c} END" if unread and c == "quantity_purchased" else c
    parts = [f"SELECT '{c}' AS column_name, CAST({value(c)} AS DOUBLE) AS value, {c} IS NOT NULL AS present FROM {src}"
             for c in NUMERIC_MON if c != without]
    return f"{name} AS ({' UNION ALL '.join(parts)})"


def drift_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    levels = "CAST([" + ", ".join(repr(i / 10) for i in range(11)) + "] AS DOUBLE[])"
    base = snapshot_ctes(P) + scored_ctes("train", "ref") + scored_ctes("test", "cur0") + [
        """cur AS (SELECT * REPLACE (monetary_value * 3 AS monetary_value,
              CASE WHEN right(customer_id, 1) IN ('1', '3', '5', '7', '9') THEN purchase_regularity_days END AS purchase_regularity_days,
              CASE WHEN geographic_segment = 'ASIA' THEN 'OCEANIA' ELSE geographic_segment END AS geographic_segment) FROM cur0)""",
        _long("ref", "lref"), _long("cur", "lcur", "spend_change_ratio", "right(customer_id, 1) = '7'")]
    one, zero = d(1), d(0)
    kind = "CASE WHEN column_name = 'churn_probability' THEN 'probability' ELSE 'numeric' END"
    bstats = f"""SELECT column_name, {kind} AS kind, CAST(count(*) AS BIGINT) AS rows,
          avg(CASE WHEN present THEN {zero} ELSE {one} END) AS missing_rate,
          CASE WHEN column_name = 'churn_probability' THEN {zero} ELSE min(value) END AS minimum,
          CASE WHEN column_name = 'churn_probability' THEN {one} ELSE max(value) END AS maximum,
          CAST(NULL AS BIGINT) AS n_categories FROM lref GROUP BY column_name
        UNION ALL SELECT 'geographic_segment', 'categorical', CAST(count(*) AS BIGINT),
          avg(CASE WHEN geographic_segment IS NULL THEN {one} ELSE {zero} END), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
          CAST(count(DISTINCT geographic_segment) AS BIGINT) FROM ref"""
    q["baseline_stats"] = final(with_(*base) + bstats, dbl=["missing_rate", "minimum", "maximum"])
    q["baseline_categories"] = with_(*base) + """SELECT 'geographic_segment' AS column_name, geographic_segment AS category,
        CAST(count(*) AS BIGINT) AS n FROM ref GROUP BY geographic_segment"""
    numeric_only = "column_name <> 'churn_probability'"
    q["baseline_quantiles"] = final(with_(*base) + f"""SELECT column_name, unnest(range(11)) AS q_index,
        unnest({levels}) AS q, unnest(quantile_cont(value, {levels})) AS quantile
        FROM lref WHERE value IS NOT NULL AND {numeric_only} GROUP BY column_name""", dbl=["q", "quantile"])
    ctes = base + [
        f"""edges AS (SELECT column_name, list_sort(list_distinct(quantile_cont(value, {levels}))) AS ed
             FROM lref WHERE value IS NOT NULL GROUP BY column_name)""",
        """both_ AS (SELECT column_name, value, true AS is_ref FROM lref
             WHERE value IS NOT NULL AND column_name IN (SELECT DISTINCT column_name FROM lcur)
             UNION ALL SELECT column_name, value, false FROM lcur WHERE value IS NOT NULL)""",
        """binned AS (SELECT b.*, len(list_filter(list_slice(e.ed, 2, len(e.ed) - 1), lambda x: x <= b.value)) AS bin,
             len(e.ed) AS ne FROM both_ b JOIN edges e USING (column_name))""",
        """sizes AS (SELECT column_name, count_if(is_ref) AS n_ref, count_if(NOT is_ref) AS n_cur,
             avg(value) FILTER (WHERE is_ref) AS mr, avg(value) FILTER (WHERE NOT is_ref) AS mc, max(ne) AS ne
             FROM binned GROUP BY column_name)""",
        """pb AS (SELECT column_name, bin, count_if(is_ref) AS r, count_if(NOT is_ref) AS c FROM binned GROUP BY column_name, bin)""",
        f"""ps AS (SELECT column_name, sum((cs - rs) * ln(cs / rs)) AS s FROM (SELECT pb.column_name,
             greatest(CAST(c AS DOUBLE) / CAST(n_cur AS DOUBLE), {d(1e-6)}) AS cs,
             greatest(CAST(r AS DOUBLE) / CAST(n_ref AS DOUBLE), {d(1e-6)}) AS rs FROM pb JOIN sizes USING (column_name))
             GROUP BY column_name)""",
        f"""psi AS (SELECT column_name, CASE WHEN n_ref = 0 OR n_cur = 0 THEN CAST(NULL AS DOUBLE) WHEN ne < 3 THEN
             CASE WHEN abs(mr - mc) <= {d(1e-8)} + {d(1e-5)} * abs(mc) THEN {zero} ELSE {one} END ELSE s END AS psi
             FROM sizes LEFT JOIN ps USING (column_name))""",
        """kc AS (SELECT column_name, value, count_if(is_ref) AS r, count_if(NOT is_ref) AS c FROM both_ GROUP BY column_name, value)""",
        """kw AS (SELECT column_name, sum(r) OVER w AS cr, sum(c) OVER w AS cc, sum(r) OVER (PARTITION BY column_name) AS nr,
             sum(c) OVER (PARTITION BY column_name) AS nc FROM kc
             WINDOW w AS (PARTITION BY column_name ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
        """ks AS (SELECT column_name, CASE WHEN max(nr) > 0 AND max(nc) > 0 THEN
             max(abs(CAST(cr AS DOUBLE) / CAST(nr AS DOUBLE) - CAST(cc AS DOUBLE) / CAST(nc AS DOUBLE))) END AS ks_statistic
             FROM kw GROUP BY column_name)""",
        f"bs AS ({bstats})",
        f"""rm AS (SELECT l.column_name, avg(CASE WHEN l.present THEN {zero} ELSE {one} END) AS missing_rate,
             avg(CASE WHEN l.present AND l.value IS NULL THEN {one} ELSE {zero} END) AS type_error_rate,
             avg(CASE WHEN coalesce(l.value < bs.minimum OR l.value > bs.maximum, false) THEN {one} ELSE {zero} END)
               AS outside_reference_range_rate
             FROM lcur l JOIN bs USING (column_name) GROUP BY l.column_name
           UNION ALL SELECT 'geographic_segment', avg(CASE WHEN geographic_segment IS NULL THEN {one} ELSE {zero} END),
             CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM cur)""",
        """nc_ AS (SELECT 'geographic_segment' AS column_name, category FROM (
             SELECT DISTINCT geographic_segment AS category FROM cur WHERE geographic_segment IS NOT NULL
             EXCEPT SELECT DISTINCT geographic_segment FROM ref WHERE geographic_segment IS NOT NULL))""",
    ]
    q["psi"] = final(with_(*ctes) + "SELECT column_name, psi FROM psi", dbl=["psi"])
    q["ks"] = final(with_(*ctes) + "SELECT column_name, ks_statistic FROM ks", dbl=["ks_statistic"])
    q["range_and_missing"] = final(with_(*ctes) + "SELECT * FROM rm",
                                   dbl=["missing_rate", "type_error_rate", "outside_reference_range_rate"])
    q["new_categories"] = final(with_(*ctes) + "SELECT * FROM nc_")
    order_case = "CASE column_name " + " ".join(f"WHEN '{c}' THEN {i}" for c, i in ORDER_OF.items()) + " END"
    t_missing, t_out, t_psi, t_ks = 0.05, 0.01, 0.20, 0.15
    met = f"""met AS (SELECT bs.column_name, bs.kind, bs.missing_rate AS bmr, rm.missing_rate AS mr, rm.type_error_rate AS ter,
        rm.outside_reference_range_rate AS orr, psi.psi, ks.ks_statistic AS ks,
        {order_case} AS co
      FROM bs JOIN rm USING (column_name) LEFT JOIN psi USING (column_name) LEFT JOIN ks USING (column_name))"""
    fin = "NOT isnan({c}) AND NOT isinf({c})"
    alerts = f"""
      SELECT (co + 1) * 100 + 0 AS alert_order, 'warning' AS severity, column_name, 'missing_rate_increase' AS issue,
        mr AS value, CAST(NULL AS VARCHAR) AS detail FROM met WHERE mr - bmr > {d(t_missing)}
      UNION ALL SELECT (co + 1) * 100 + 1, 'blocking', column_name, 'invalid_numeric_type', ter, NULL FROM met
        WHERE kind <> 'categorical' AND ter > 0
      UNION ALL SELECT (co + 1) * 100 + 2, 'warning', column_name, 'values_outside_reference_range', orr, NULL FROM met
        WHERE kind <> 'categorical' AND orr > {d(t_out)}
      UNION ALL SELECT (co + 1) * 100 + 3, 'warning', column_name, 'psi_drift', psi, NULL FROM met
        WHERE kind <> 'categorical' AND psi IS NOT NULL AND {fin.format(c='psi')} AND psi >= {d(t_psi)}
      UNION ALL SELECT (co + 1) * 100 + 4, 'warning', column_name, 'ks_drift', ks, NULL FROM met
        WHERE kind <> 'categorical' AND ks IS NOT NULL AND {fin.format(c='ks')} AND ks >= {d(t_ks)}
      UNION ALL SELECT ({ORDER_OF['geographic_segment']} + 1) * 100 + 5, 'warning', column_name, 'new_categories', CAST(NULL AS DOUBLE),
        category FROM nc_
      UNION ALL SELECT 0, 'blocking', column_name, 'missing_column', CAST(NULL AS DOUBLE), NULL FROM bs
        WHERE column_name = 'spend_change_ratio'"""
    q["drift_alerts"] = final(with_(*ctes, met) + f"SELECT CAST(alert_order AS BIGINT) AS alert_order, severity, column_name,"
                              f" issue, value, detail FROM ({alerts})", dbl=["value"])
    q["stream_drift"] = f"SELECT *, CAST(0 AS BIGINT) AS batch_id FROM ({q['drift_alerts']})"
    q["drift_record"] = with_(*ctes, met) + f"""SELECT (SELECT CAST(count(*) AS BIGINT) FROM ref) AS reference_rows,
        (SELECT CAST(count(*) AS BIGINT) FROM cur) AS current_rows, CAST(count(*) AS BIGINT) AS alerts,
        CAST(count_if(severity = 'blocking') AS BIGINT) AS blocking, 'spend_change_ratio' AS missing_columns, 'blocking' AS status
      FROM ({alerts})"""
    return q

def threshold_sql(params, tx_cte) -> str:
    tc = _ts(params.threshold_cutoff)
    thr = [tx_cte, NTX,
           """tl AS (SELECT *, (NOT is_cancellation AND coalesce(quantity > 0, false) AND coalesce(unit_price >= 0, false)) AS pos
                FROM ntx WHERE customer_id IS NOT NULL)""",
           f"""tpos AS (SELECT * FROM tl WHERE pos AND invoice_date <= TIMESTAMP '{tc.isoformat(sep=' ')}'
                QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY quantity, unit_price, description, country) = 1)""",
           "tinv AS (SELECT customer_id, invoice_no, min(invoice_date) AS dt FROM tpos GROUP BY customer_id, invoice_no)",
           f"""tgap AS (SELECT CAST(epoch_us(dt) - epoch_us(lag(dt) OVER (PARTITION BY customer_id ORDER BY dt, invoice_no))
                AS DOUBLE) / {DAY_US} AS g FROM tinv)"""]
    return final(with_(*thr) + f"""SELECT '{tc.date().isoformat()}' AS training_cutoff,
        {d(params.recency_quantile)} AS quantile, qv AS observed_interval_days, CAST(ceil(qv) AS BIGINT) AS max_recency_days,
        CAST((SELECT count(g) FROM tgap) AS BIGINT) AS repeat_intervals,
        CAST((SELECT count(DISTINCT customer_id) FROM tinv) AS BIGINT) AS training_customers,
        CAST((SELECT count(*) FROM (SELECT customer_id FROM tinv GROUP BY customer_id HAVING count(*) >= 2)) AS BIGINT)
          AS repeat_customers
        FROM (SELECT quantile_cont(g, {d(params.recency_quantile)}) AS qv FROM tgap)""",
                 dbl=["quantile", "observed_interval_days"])
