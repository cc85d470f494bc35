"""DuckDB SQL that each registered query must agree with, written from the definitions."""

from __future__ import annotations

from orderlens.config import FEATURES as FEATURE_NAMES
from orderlens.registry import boosting


def _cents(expression: str) -> str:
    return f"CAST(floor(({expression}) * 100 + 0.5) AS BIGINT)"


def _pct(part: str, whole: str) -> str:
    """Percent in exact decimals, rounded half up."""
    return f"CAST(round(CAST(({part}) * 100 AS DECIMAL(28, 8)) / nullif({whole}, 0), 2) AS DOUBLE)"


def _round(expression: str, digits: int) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"(floor(({expression}) * {scale} + 0.5) / {scale})"


def _count(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


# The eight order tables, the clean tables, Silver, and Silver with a score.
PRELUDE = f"""
WITH first_ship AS (
    SELECT o_orderkey, min(l_shipdate) AS shipped
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate
    GROUP BY o_orderkey
), m_orders AS (
    SELECT o.o_orderkey AS n, CAST(o.o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           CASE WHEN o_orderstatus = 'P' THEN 'shipped' ELSE 'delivered' END AS order_status,
           o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) AS bought,
           shipped + to_hours(CAST(o.o_orderkey % 7 AS INTEGER)) AS delivered,
           o_orderdate + INTERVAL 180 DAY AS promised
    FROM orders o LEFT JOIN first_ship f ON f.o_orderkey = o.o_orderkey
), m_items AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
           CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
           l_extendedprice AS price, l_extendedprice * l_tax AS freight_value
    FROM lineitem
), m_payments AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
           l_linenumber AS payment_installments, l_extendedprice * (1 - l_discount) AS payment_value
    FROM lineitem
), m_reviews AS (
    SELECT CAST(event_id AS VARCHAR) AS review_id,
           CAST(event_id - CASE WHEN event_id % 5 = 4 THEN 1 ELSE 0 END AS VARCHAR) AS order_id,
           CAST(floor(value) AS BIGINT) % 7 AS review_score, ts AS answered
    FROM events
), m_customers AS (
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, n_name AS customer_state, n_name AS customer_city
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
), m_sellers AS (
    SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, n_name AS seller_state, n_name AS seller_city
    FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
), m_products AS (
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category_name,
           CAST(p_size * 100 AS DOUBLE) AS product_weight_g, CAST(p_size % 7 AS INTEGER) AS product_photos_qty
    FROM part
), m_translation(product_category_name, product_category_name_english) AS (
    VALUES ('LARGE', 'large_goods'), ('STANDARD', 'standard_goods'), ('SMALL', 'small_goods'),
           ('MEDIUM', 'medium_goods'), ('ECONOMY', 'economy_goods')
), dated AS (
    SELECT *, CAST(date_diff('day', CAST(bought AS DATE), CAST(delivered AS DATE)) AS INTEGER) AS delivery_days,
           CAST(date_diff('day', CAST(promised AS DATE), CAST(delivered AS DATE)) AS INTEGER) AS delay_days
    FROM m_orders
    WHERE order_status = 'delivered' AND bought IS NOT NULL AND delivered IS NOT NULL AND promised IS NOT NULL
), c_orders AS (
    SELECT *, delay_days > 0 AS is_late, CAST(year(bought) AS INTEGER) AS purchase_year,
           CAST(month(bought) AS INTEGER) AS purchase_month, CAST(dayofweek(bought) + 1 AS INTEGER) AS purchase_weekday,
           CAST(hour(bought) AS INTEGER) AS purchase_hour
    FROM dated WHERE delivery_days BETWEEN 0 AND 200
), c_items AS (
    SELECT * FROM m_items WHERE price > 0 AND price <= 90000 AND freight_value >= 0
      AND seller_id IS NOT NULL AND product_id IS NOT NULL
), i_first AS (
    SELECT order_id, seller_id AS main_seller_id, product_id AS main_product_id FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_item_id, seller_id, product_id) AS place
        FROM c_items) WHERE place = 1
), i_sums AS (
    SELECT order_id, count(*) AS nb_items, CAST(sum({_cents("price")}) AS BIGINT) AS price_cents,
           CAST(sum({_cents("freight_value")}) AS BIGINT) AS freight_cents, count(DISTINCT seller_id) AS nb_sellers
    FROM c_items GROUP BY order_id
), a_items AS (
    SELECT i_sums.*, main_seller_id, main_product_id FROM i_sums JOIN i_first USING (order_id)
), p_first AS (
    SELECT order_id, payment_type FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY payment_sequential, payment_type) AS place
        FROM m_payments WHERE payment_type IS NOT NULL AND payment_value IS NOT NULL) WHERE place = 1
), a_payments AS (
    SELECT order_id, CAST(sum({_cents("payment_value")}) AS BIGINT) AS paid_cents,
           max(payment_installments) AS max_installments, any_value(f.payment_type) AS payment_type
    FROM m_payments p JOIN p_first f USING (order_id) GROUP BY order_id
), a_reviews AS (
    SELECT order_id, CAST(review_score AS INTEGER) AS review_score FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY answered DESC, review_id DESC) AS place
        FROM m_reviews WHERE review_score BETWEEN 1 AND 5) WHERE place = 1
), silver AS (
    SELECT o.n, o.order_id, o.customer_id, i.main_seller_id, i.main_product_id, is_late, delay_days, delivery_days,
           review_score, bought, purchase_year, purchase_month, purchase_weekday, purchase_hour, customer_state,
           customer_city, seller_state, seller_city, coalesce(customer_state <> seller_state, false) AS cross_state_delivery,
           nb_items, nb_sellers, price_cents, freight_cents, paid_cents, payment_type, max_installments,
           product_category_name_english, round(product_weight_g / 1000, 2) AS estimated_weight_kg, product_photos_qty
    FROM c_orders o JOIN a_items i ON i.order_id = o.order_id
    LEFT JOIN a_payments p ON p.order_id = o.order_id
    LEFT JOIN a_reviews r ON r.order_id = o.order_id
    LEFT JOIN m_customers c ON c.customer_id = o.customer_id
    LEFT JOIN m_sellers s ON s.seller_id = i.main_seller_id
    LEFT JOIN m_products d ON d.product_id = i.main_product_id
    LEFT JOIN m_translation t ON t.product_category_name = d.product_category_name
), scored AS (
    SELECT *, CAST((n * 7919 % 10000) * (n * 7919 % 10000) AS DOUBLE) / 1e8 AS probability,
           CAST(is_late AS INTEGER) AS label FROM silver
)
"""

SILVER = """
    SELECT order_id, customer_id, main_seller_id, is_late, delay_days, delivery_days, review_score,
           bought AS order_purchase_timestamp, purchase_year, purchase_month, purchase_weekday, purchase_hour,
           customer_state, customer_city, seller_state, seller_city, cross_state_delivery, nb_items, nb_sellers,
           price_cents / 100.0::DOUBLE AS total_price, freight_cents / 100.0::DOUBLE AS total_freight,
           paid_cents / 100.0::DOUBLE AS total_payment_value, payment_type, max_installments,
           product_category_name_english, estimated_weight_kg, product_photos_qty
    FROM silver"""

_DAYS = "CAST(sum(delivery_days) AS DOUBLE) / count(delivery_days) AS avg_delivery_days"
_SCORE = "CAST(sum(review_score) AS DOUBLE) / nullif(count(review_score), 0) AS avg_review_score"


def _value(name: str) -> str:
    return f"sum(price_cents) / 100.0::DOUBLE / count(*) AS {name}"


def _kpi(keys: str, *averages: str, having: str = "") -> str:
    shown = ", ".join([f"{_count('true')} AS total_orders", f"{_count('is_late')} AS late_orders", *averages])
    rate = _pct("count(*) FILTER (WHERE is_late)", "count(*)")
    return f"SELECT {keys}, {shown}, {rate} AS late_rate_pct FROM silver GROUP BY {keys} {having}"


BY_STATE = _kpi("customer_state", _DAYS, _SCORE)
BY_CATEGORY = _kpi("product_category_name_english", _value("avg_price"), _SCORE, having="HAVING count(*) >= 30")
BY_SELLER = _kpi("main_seller_id, seller_state", _DAYS, _SCORE, _value("avg_order_value"))
BY_CROSSING = _kpi("cross_state_delivery", _DAYS, _SCORE)
BY_MONTH = _kpi("purchase_year, purchase_month", _value("avg_order_value"), _SCORE)
BY_WEEKDAY = _kpi("purchase_weekday", _DAYS)
BY_LATENESS = f"""
    SELECT is_late, count(*) AS total_orders, CAST(sum(review_score) AS DOUBLE) / count(*) AS avg_review_score,
           {_count("review_score <= 2")} AS bad_reviews,
           {_pct("count(*) FILTER (WHERE review_score <= 2)", "count(*)")} AS bad_review_rate_pct
    FROM silver WHERE review_score IS NOT NULL GROUP BY is_late"""
TOP_SELLERS = f"""
    SELECT * FROM (SELECT *, CAST(rank() OVER (ORDER BY total_orders DESC) AS INTEGER) AS seller_rank
                   FROM ({BY_SELLER})) WHERE seller_rank <= 50"""
DASHBOARD = f"""
    SELECT CAST(sum(total_orders) AS BIGINT) AS total_orders, CAST(sum(late_orders) AS BIGINT) AS total_late_orders,
           round(avg(avg_review_score), 6) AS avg_review_score, round(avg(avg_order_value), 6) AS avg_order_value,
           {_pct("sum(late_orders)", "sum(total_orders)")} AS global_late_rate_pct
    FROM ({BY_MONTH})"""
TOP_STATES = f"""
    SELECT customer_state, total_orders, late_rate_pct, avg_review_score FROM ({BY_STATE})
    ORDER BY late_rate_pct DESC, customer_state LIMIT 10"""


def _reliable(sellers: str) -> str:
    return f"""
    SELECT main_seller_id, seller_state, total_orders, late_rate_pct, avg_review_score FROM ({sellers})
    WHERE total_orders >= 20 ORDER BY late_rate_pct, main_seller_id LIMIT 10"""


def _contract(source: str, **columns: str) -> str:
    """Text as it is, null keys named, numbers rounded half up to the declared digits in exact decimals."""
    out = []
    for name, kind in columns.items():
        if kind.startswith("text"):
            out.append(f"coalesce({name}, 'unknown') AS {name}" if kind.endswith("!") else name)
        elif kind.startswith("dec"):
            digits = int(kind[3:].split("_")[1])
            out.append(f"CAST(round(CAST({name} AS DECIMAL(28, 10)), {digits}) AS DOUBLE) AS {name}")
        elif kind == "bool":
            out.append(name)
        else:
            out.append(f"CAST({name} AS {'BIGINT' if kind == 'count' else 'INTEGER'}) AS {name}")
    return f"SELECT {', '.join(out)} FROM ({source})"


_COUNTS = {"total_orders": "count", "late_orders": "count"}

PAYLOADS = f"""
    SELECT o.order_id, CAST(w.nb_items AS INTEGER) AS nb_items, CAST(w.nb_sellers AS INTEGER) AS nb_sellers,
           w.price_cents / 100.0::DOUBLE AS total_price, w.freight_cents / 100.0::DOUBLE AS total_freight,
           coalesce(customer_state <> seller_state, false) AS cross_state_delivery,
           CAST(dayofweek(bought) + 1 AS INTEGER) AS purchase_weekday, CAST(hour(bought) AS INTEGER) AS purchase_hour,
           coalesce(w.estimated_weight_kg, 0) AS estimated_weight_kg, coalesce(max_installments, 1) AS max_installments,
           customer_state AS state
    FROM m_orders o JOIN weighed w ON w.order_id = o.order_id
    LEFT JOIN (SELECT order_id, max(payment_installments) AS max_installments FROM m_payments GROUP BY order_id) p
        ON p.order_id = o.order_id
    LEFT JOIN m_customers c ON c.customer_id = o.customer_id
    LEFT JOIN m_sellers s ON s.seller_id = w.main_seller_id"""
WEIGHED = f"""
, weighed AS (
    SELECT order_id, count(order_item_id) AS nb_items, count(DISTINCT seller_id) AS nb_sellers,
           CAST(sum({_cents("price")}) AS BIGINT) AS price_cents,
           CAST(sum({_cents("freight_value")}) AS BIGINT) AS freight_cents,
           round(CAST(coalesce(sum(product_weight_g), 0) AS DOUBLE) / 1000, 2) AS estimated_weight_kg,
           arg_min(seller_id, (order_item_id, seller_id)) AS main_seller_id
    FROM m_items LEFT JOIN m_products USING (product_id) GROUP BY order_id
)
"""

FEATURES = """
    SELECT order_id, CAST(nb_items AS INTEGER) AS nb_items, CAST(nb_sellers AS INTEGER) AS nb_sellers,
           price_cents / 100.0::DOUBLE AS total_price, freight_cents / 100.0::DOUBLE AS total_freight,
           CAST(cross_state_delivery AS INTEGER) AS cross_state_delivery, purchase_weekday, purchase_hour,
           coalesce(estimated_weight_kg, 1.0) AS estimated_weight_kg, coalesce(max_installments, 1) AS max_installments"""

SPLIT = """
    SELECT order_id, CAST(is_late AS INTEGER) AS label,
           row_number() OVER (PARTITION BY is_late ORDER BY md5(order_id || ':42'))
               <= floor(count(*) OVER (PARTITION BY is_late) * 80 / 100.0) AS is_train
    FROM silver"""


def _level(value: str, high: str = "0.2", medium: str = "0.1") -> dict[str, str]:
    def pick(h: str, m: str, low: str) -> str:
        return f"CASE WHEN {value} >= {high} THEN '{h}' WHEN {value} >= {medium} THEN '{m}' ELSE '{low}' END"

    return {
        "level": pick("high", "medium", "low"),
        "label": pick("Risque eleve", "Risque modere", "Risque faible"),
        "color": pick("red", "orange", "green"),
        "action": pick(
            "Relancer le vendeur immediatement + prevenir le client",
            "Surveiller l''expedition",
            "Aucune action requise",
        ),
        "text": pick("Risque elevé", "Risque modéré", "Risque faible"),
        "badge": pick("danger", "warning", "success"),
    }


_BY_P = _level("probability")
_BY_PCT = _level("risk_pct", "20", "10")
RISK = f"""
    SELECT order_id, {_round("probability", 4)} AS risk_proba, {_round("probability * 100", 1)} AS risk_pct,
           {_BY_P["level"]} AS level, {_BY_P["label"]} AS label, {_BY_P["color"]} AS color, {_BY_P["action"]} AS action
    FROM scored"""


def _metrics(source: str, positive: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    tail = f"GROUP BY {by}" if by else ""
    counts = {
        "tp": f"{positive} AND label = 1",
        "fp": f"{positive} AND label = 0",
        "fn": f"NOT ({positive}) AND label = 1",
        "tn": f"NOT ({positive}) AND label = 0",
    }
    columns = ", ".join(f"{_count(c)} AS {n}" for n, c in counts.items())
    return f"""
    SELECT {keys}n_rows, tp, fp, fn, tn,
           coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
           coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
           coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1_score
    FROM (SELECT {keys}count(*) AS n_rows, {columns} FROM {source} {tail})"""


_PERIOD = "CASE WHEN purchase_year BETWEEN 1995 AND 1997 THEN 'reference' WHEN purchase_year BETWEEN 1998 AND 2001 THEN 'current' END"
PERIODS = f"""
, periods AS (
    SELECT *, {_PERIOD} AS period FROM scored WHERE purchase_year BETWEEN 1995 AND 2001
), watched AS (
    SELECT period, unnest([
        {{'column_name': 'nb_items', 'value': CAST(nb_items AS DOUBLE)}},
        {{'column_name': 'total_price', 'value': price_cents / 100.0::DOUBLE}},
        {{'column_name': 'total_freight', 'value': freight_cents / 100.0::DOUBLE}},
        {{'column_name': 'cross_state_delivery', 'value': CAST(CAST(cross_state_delivery AS INTEGER) AS DOUBLE)}},
        {{'column_name': 'purchase_weekday', 'value': CAST(purchase_weekday AS DOUBLE)}},
        {{'column_name': 'purchase_hour', 'value': CAST(purchase_hour AS DOUBLE)}},
        {{'column_name': 'estimated_weight_kg', 'value': CAST(estimated_weight_kg AS DOUBLE)}}
    ], recursive := true)
    FROM periods
), counted AS (
    SELECT column_name, value, {_count("period = 'reference'")} AS n_ref, {_count("period = 'current'")} AS n_cur
    FROM watched WHERE value IS NOT NULL GROUP BY column_name, value
), totals AS (
    SELECT column_name, count(*) AS n_values, CAST(sum(n_ref) AS BIGINT) AS total_ref,
           CAST(sum(n_cur) AS BIGINT) AS total_cur, min(value) AS lowest, max(value) AS highest,
           greatest(sqrt(greatest(CAST(sum(n_ref * value * value) AS DOUBLE) / sum(n_ref)
               - power(CAST(sum(n_ref * value) AS DOUBLE) / sum(n_ref), 2), 0)), 0.001) AS norm
    FROM counted GROUP BY column_name
), curves AS (
    SELECT c.*, t.* EXCLUDE (column_name),
           abs(CAST(sum(n_ref) OVER w AS DOUBLE) / total_ref - CAST(sum(n_cur) OVER w AS DOUBLE) / total_cur) AS gap,
           coalesce(lead(value) OVER w - value, 0) AS width,
           CAST(n_ref AS DOUBLE) / total_ref AS p, CAST(n_cur AS DOUBLE) / total_cur AS q
    FROM counted c JOIN totals t USING (column_name)
    WINDOW w AS (PARTITION BY c.column_name ORDER BY value)
), bands AS (
    SELECT column_name, greatest(sum(p), 0) AS p, greatest(sum(q), 0) AS q
    FROM curves GROUP BY column_name, least(floor((value - lowest) * 10 / nullif(highest - lowest, 0)), 9)
), stability AS (
    SELECT column_name, sum((CASE WHEN q > 0 THEN q ELSE 0.0001 END - CASE WHEN p > 0 THEN p ELSE 0.0001 END)
        * ln(CASE WHEN q > 0 THEN q ELSE 0.0001 END / CASE WHEN p > 0 THEN p ELSE 0.0001 END)) AS psi
    FROM bands GROUP BY column_name
), measured AS (
    SELECT column_name, any_value(n_values) AS n_values, any_value(total_ref) AS total_ref,
           any_value(total_cur) AS total_cur,
           {_round("sum(gap * width) / any_value(norm)", 6)} AS wasserstein, {_round("max(gap)", 6)} AS ks,
           {_round('''sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END
               + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2, 0))''', 6)} AS jensen_shannon
    FROM curves GROUP BY column_name
), judged AS (
    SELECT m.*, {_round("greatest(psi, 0)", 6)} AS psi,
           CASE WHEN n_values <= 5 THEN 'jensen_shannon' ELSE 'wasserstein' END AS method,
           CASE WHEN n_values <= 5 THEN jensen_shannon ELSE wasserstein END AS score,
           CASE WHEN n_values <= 5 THEN jensen_shannon ELSE wasserstein END >= 0.1 AS drifted
    FROM measured m JOIN stability USING (column_name)
), dataset AS (
    SELECT count(*) AS n_columns, {_count("drifted")} AS n_drifted,
           CAST(count(*) FILTER (WHERE drifted) AS DOUBLE) / count(*) AS share_drifted,
           CAST(count(*) FILTER (WHERE drifted) AS DOUBLE) / count(*) >= 0.5 AS drift_detected
    FROM judged
)
"""
BY_PERIOD = _metrics("periods", "probability >= 0.5", "period")

def _reward(relief: str, cost: str) -> str:
    return f"risk * {relief}::DOUBLE * value * 2 - {cost}::DOUBLE"


_REWARDS = f"""
    SELECT order_id, risk, value, urgency, {_reward("0.0", "0.0")} AS reward_0, {_reward("0.3", "0.05")} AS reward_1,
           {_reward("0.7", "0.15")}
               + CASE WHEN urgency < 0.2 AND risk > 0.15 THEN 0.3::DOUBLE ELSE 0::DOUBLE END AS reward_2
    FROM (SELECT order_id, probability AS risk, least(price_cents / 100.0::DOUBLE / 90000, 1.0::DOUBLE) AS value,
                 least(delivery_days / 30.0::DOUBLE, 1.0::DOUBLE) AS urgency FROM scored)"""


def _sizes(tables: dict[str, str]) -> str:
    parts = [f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {source}" for name, source in tables.items()]
    union = " UNION ALL ".join(parts)
    return f"SELECT * FROM ({union}) UNION ALL SELECT 'total', CAST(sum(n_rows) AS BIGINT) FROM ({union})"


# Queries over the tables above.
VECTORS = f"""
        SELECT order_id, CAST(nb_items AS DOUBLE) AS f0, CAST(nb_sellers AS DOUBLE) AS f1, total_price AS f2,
               total_freight AS f3, CAST(cross_state_delivery AS DOUBLE) AS f4, CAST(purchase_weekday AS DOUBLE) AS f5,
               CAST(purchase_hour AS DOUBLE) AS f6, estimated_weight_kg AS f7, CAST(max_installments AS DOUBLE) AS f8
        FROM ({FEATURES} FROM silver)"""
# Models of three trees with one split each: trained on the training side, on everything, and on each pair of folds.
EXAMPLES = f"""
, examples AS (SELECT v.*, s.label, s.is_train FROM ({VECTORS}) v JOIN ({SPLIT}) s USING (order_id))
"""


def _weight(rows: str) -> str:
    """Late orders weigh as much as the punctual ones of ``rows``."""
    return f"CASE WHEN label = 1 THEN (SELECT CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) / count(*) FILTER (WHERE label = 1) FROM {rows}) ELSE 1.0::DOUBLE END AS weight"


ROUNDS = 3
RATE = "0.5::DOUBLE AS rate"
LEARNERS = "(SELECT * FROM examples WHERE is_train)"
JUDGED_MODEL = EXAMPLES + ", " + boosting.boosted(
    f"SELECT 0 AS cell, {RATE}, *, is_train AS fit, {_weight(LEARNERS)} FROM examples", ROUNDS
) + ", unseen AS (SELECT * FROM state_3 WHERE NOT is_train)\n"
# With validation rows the class weight is that of all rows.
ONE_MODEL = EXAMPLES + ", " + boosting.boosted(
    f"SELECT 0 AS cell, {RATE}, *, is_train AS fit, {_weight('examples')} FROM examples", ROUNDS
) + "\n"
WHOLE_MODEL = EXAMPLES + ", " + boosting.boosted(
    f"SELECT 0 AS cell, {RATE}, *, true AS fit, {_weight('examples')} FROM examples", ROUNDS
) + ", won AS (" + " UNION ALL ".join(f"SELECT feature, gained FROM split_{n + 1}" for n in range(ROUNDS)) + ")\n"
FOLD_MODELS = EXAMPLES + ", " + boosting.boosted(
    f"""SELECT fold * 10 + step AS cell, rates[step] AS rate, *, CAST(order_id AS BIGINT) % 3 <> fold AS fit, {_weight(LEARNERS)}
    FROM {LEARNERS}, (SELECT unnest([0, 1, 2]) AS fold), (SELECT unnest([1, 2, 3]) AS step, [0.03, 0.05, 0.5]::DOUBLE[] AS rates)""",
    ROUNDS,
) + "\n"


def _losses(state: str) -> str:
    return f"""count(*) AS n_rows, {_round(f"avg({boosting.LOSS})", 6)} AS logloss,
        {_round("CAST(count(*) FILTER (WHERE (margin >= 0) <> (label = 1)) AS DOUBLE) / count(*)", 6)} AS error
        FROM {state} GROUP BY is_train"""


# Training stops at the first round that takes less than a hundredth off the loss of the validation rows.
KEPT = ", ".join(
    ["validation AS (SELECT " + ", ".join(
        f"(SELECT sum(weight * 2.0 * ln(1.0 + exp(-2.0 * y * margin))) / sum(weight) FROM state_{n} WHERE NOT is_train) AS e{n}"
        for n in range(1, ROUNDS + 1)
    ) + ")",
    "kept AS (SELECT CASE WHEN e1 - e2 < 0.01 * greatest(e2, 0.01) THEN 1 WHEN e2 - e3 < 0.01 * greatest(e3, 0.01) THEN 2 ELSE 3 END AS rounds FROM validation)"]
)

BANDS = f"""
    , placed AS (SELECT probability AS p, label, rank() OVER (ORDER BY probability) - 1 AS below, count(*) OVER () AS total FROM scored),
    banded AS (
        SELECT CAST(below * 10 // total AS INTEGER) AS band, count(*) AS n_rows, min(p) AS lowest, max(p) AS highest,
               {_round("avg(p)", 6)} AS mean_predicted, {_round("avg(label)", 6)} AS observed_rate,
               {_round("abs(avg(p) - avg(label))", 6)} AS gap
        FROM placed GROUP BY 1)
    """

_WITH_PRELUDE: dict[str, str] = {
    "s01_s14_csv_round_trip": "SELECT * FROM m_payments",
    "s04_ingest_all": _sizes(
        {
            "orders": "m_orders",
            "order_items": "m_items",
            "payments": "m_payments",
            "reviews": "m_reviews",
            "customers": "m_customers",
            "sellers": "m_sellers",
            "products": "m_products",
            "category_translation": "m_translation",
        }
    ),
    "s05_s06_bronze_round_trip": "SELECT strftime(bought, '%Y-%m') AS purchase_ym, count(*) AS n_orders FROM m_orders GROUP BY 1",
    "s07_s08_silver_round_trip": SILVER,
    "s09_gold_round_trip": BY_MONTH,
    "s11_contract_late_rate_by_state": _contract(
        BY_STATE, customer_state="text2!", **_COUNTS, avg_delivery_days="dec6_2", avg_review_score="dec3_2", late_rate_pct="dec5_2"
    ),
    "s11_contract_late_rate_by_category": _contract(
        BY_CATEGORY, product_category_name_english="text50!", **_COUNTS, avg_price="dec8_2", avg_review_score="dec3_2", late_rate_pct="dec5_2"
    ),
    "s11_contract_seller_performance": _contract(
        TOP_SELLERS, main_seller_id="text64!", seller_state="text2", **_COUNTS, avg_delivery_days="dec6_2",
        avg_review_score="dec3_2", avg_order_value="dec8_2", late_rate_pct="dec5_2", seller_rank="int",
    ),
    "s11_contract_cross_state_impact": _contract(
        BY_CROSSING, cross_state_delivery="bool", **_COUNTS, avg_delivery_days="dec6_2", avg_review_score="dec3_2", late_rate_pct="dec5_2"
    ),
    "s11_contract_delay_review_impact": _contract(
        BY_LATENESS, is_late="bool", total_orders="count", avg_review_score="dec3_2", bad_reviews="count", bad_review_rate_pct="dec5_2"
    ),
    "s11_contract_monthly_trend": _contract(
        BY_MONTH, purchase_year="int", purchase_month="int", **_COUNTS, avg_order_value="dec8_2", avg_review_score="dec3_2", late_rate_pct="dec5_2"
    ),
    "s11_contract_weekday_pattern": _contract(
        BY_WEEKDAY, purchase_weekday="int", **_COUNTS, avg_delivery_days="dec6_2", late_rate_pct="dec5_2"
    ),
    "s12_ingest_incremental": """
        SELECT order_id, strftime(day, '%Y-%m') AS purchase_ym, count(*) AS n_rows
        FROM (SELECT DISTINCT CASE WHEN n % 97 <> 0 THEN order_id END AS order_id, order_status,
                     CASE WHEN n % 13 <> 0 THEN bought END AS day FROM m_orders)
        GROUP BY 1, 2""",
    "s04_quarantine": f"""
        SELECT payment_type, CAST(order_id AS BIGINT) % 50 <> 0 AS good, count(*) AS n_rows,
               (SELECT {_count("CAST(order_id AS BIGINT) % 50 <> 0")} FROM m_payments) AS all_good,
               (SELECT {_count("CAST(order_id AS BIGINT) % 50 = 0")} FROM m_payments) AS all_refused
        FROM m_payments GROUP BY 1, 2""",
    "s11_contract_refused": f"""
        SELECT customer_state, CASE WHEN length(customer_state) > 8
            THEN 'late_rate_by_state.customer_state does not fit varchar(8): ' || customer_state END AS reason
        FROM ({BY_STATE})""",
    "l07_preview": """
        SELECT purchase_year, purchase_month, count(*) AS total_orders FROM silver
        GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 5""",
    "s13_full_refresh": "SELECT payment_type, count(*) AS n_rows FROM m_payments GROUP BY payment_type",
    "s16_parse_order_json": WEIGHED + PAYLOADS,
    "p01_filter_delivered": "SELECT order_id, order_status FROM m_orders WHERE order_status = 'delivered'",
    "p02_drop_incomplete": "SELECT order_id FROM m_orders WHERE bought IS NOT NULL AND delivered IS NOT NULL AND promised IS NOT NULL",
    "p03_p09_clean_orders": """SELECT order_id, delivery_days, delay_days, is_late, purchase_year, purchase_month,
        purchase_weekday, purchase_hour FROM c_orders""",
    "p03_delivery_days": "SELECT order_id, delivery_days FROM dated",
    "p04_delay_days": "SELECT order_id, delay_days FROM dated",
    "p05_is_late_day": "SELECT order_id, CAST(delivered AS DATE) > CAST(promised AS DATE) AS is_late FROM dated",
    "p06_is_late_instant": "SELECT order_id, delivered > promised AS is_late FROM dated",
    "p07_calendar_parts": """SELECT order_id, CAST(year(bought) AS INTEGER) AS purchase_year,
        CAST(month(bought) AS INTEGER) AS purchase_month, CAST(dayofweek(bought) + 1 AS INTEGER) AS purchase_weekday,
        CAST(hour(bought) AS INTEGER) AS purchase_hour FROM m_orders""",
    "p08_weekday_monday0": "SELECT order_id, CAST(isodow(bought) - 1 AS INTEGER) AS purchase_weekday FROM m_orders",
    "p09_filter_delivery_range": "SELECT order_id, delivery_days FROM dated WHERE delivery_days >= 0 AND delivery_days <= 200",
    "p10_filter_price": """SELECT order_id, order_item_id, product_id, seller_id, price FROM m_items
        WHERE price > 0 AND price <= 90000 AND freight_value >= 0""",
    "p11_filter_score": "SELECT review_id, CAST(review_score AS INTEGER) AS review_score FROM m_reviews WHERE review_score IN (1, 2, 3, 4, 5)",
    "p13_cross_state_flag": """SELECT order_id, customer_state, seller_state,
        CASE WHEN customer_state <> seller_state THEN true ELSE false END AS cross_state_delivery FROM silver""",
    "p14_weight_kg": "SELECT product_id, round(product_weight_g / 1000, 2) AS weight_kg FROM m_products",
    "p16_bad_review_flag": "SELECT order_id, CASE WHEN review_score <= 2 THEN 1 ELSE 0 END AS bad_review FROM silver",
    "p17_reviewed_only": "SELECT order_id, review_score FROM silver WHERE review_score IS NOT NULL",
    "p18_min_support": "SELECT main_seller_id, count(*) AS total_orders FROM silver GROUP BY main_seller_id, seller_state HAVING count(*) >= 30",
    "p19_feature_defaults": FEATURES + " FROM silver",
    "p21_p22_risk_to_action": RISK,
    "p23_short_id": """SELECT review_id, review_id || '-' || order_id || '-' || review_id AS long_id,
        left(review_id || '-' || order_id || '-' || review_id, 10) AS short_id FROM m_reviews""",
    "p24_label_case": """SELECT CASE WHEN is_late THEN 'En retard' ELSE 'A l''heure' END AS statut,
        CASE WHEN cross_state_delivery THEN 'Inter-etats' ELSE 'Meme etat' END AS type_livraison, count(*) AS n_orders
        FROM silver GROUP BY 1, 2""",
    "p25_risk_badge": f"SELECT order_id, {_BY_PCT['text']} AS text, {_BY_PCT['badge']} AS color FROM ({RISK})",
    "p26_year_month_key": "SELECT order_id, strftime(bought, '%Y-%m') AS purchase_ym FROM m_orders",
    "p27_period_split": PERIODS + "SELECT order_id, purchase_year, period FROM periods",
    "p28_payload_projection": WEIGHED + PAYLOADS,
    "j01_orders_items_inner": """SELECT order_id, nb_items, main_seller_id, main_product_id
        FROM c_orders JOIN a_items USING (order_id)""",
    "j02_left_payments": f"""
        SELECT o.order_id, total_cents / 100.0::DOUBLE AS total_payment_value, max_installments, payment_type
        FROM c_orders o LEFT JOIN (
            SELECT order_id, sum({_cents("payment_value")}) AS total_cents, max(payment_installments) AS max_installments,
                   arg_min(payment_type, (payment_sequential, payment_type)) AS payment_type
            FROM m_payments WHERE payment_type IS NOT NULL AND payment_value IS NOT NULL GROUP BY order_id) p ON p.order_id = o.order_id""",
    "j03_left_reviews": "SELECT o.order_id, is_late, review_score FROM c_orders o LEFT JOIN a_reviews r ON r.order_id = o.order_id",
    "j04_left_customers": """SELECT order_id, o.customer_id, customer_state, customer_city
        FROM c_orders o LEFT JOIN m_customers c ON c.customer_id = o.customer_id""",
    "j05_left_sellers": """SELECT order_id, main_seller_id, seller_state, seller_city
        FROM c_orders JOIN a_items USING (order_id) LEFT JOIN m_sellers ON seller_id = main_seller_id""",
    "j06_left_products": """SELECT order_id, main_product_id, product_category_name, product_weight_g, product_photos_qty
        FROM c_orders JOIN a_items USING (order_id) LEFT JOIN m_products ON product_id = main_product_id""",
    "j07_left_category": """SELECT product_id, p.product_category_name, product_category_name_english
        FROM m_products p LEFT JOIN m_translation t ON t.product_category_name = p.product_category_name""",
    "j08_items_products_left": """SELECT order_id, order_item_id, i.product_id, price, product_weight_g FROM m_items i
        LEFT JOIN m_products p ON p.product_id = i.product_id""",
    "j09_semi_has_items": "SELECT order_id, customer_id FROM m_orders WHERE order_id IN (SELECT order_id FROM m_items)",
    "j10_scores_to_orders": WEIGHED + f"""
        SELECT s.order_id, coalesce(state, '—') AS state, coalesce(total_price, 0) AS total_price, risk_pct
        FROM ({RISK}) s LEFT JOIN ({PAYLOADS}) o ON o.order_id = s.order_id""",
    "j11_silver_build": SILVER,
    "a01_items_by_order": """SELECT order_id, nb_items, price_cents / 100.0::DOUBLE AS total_price,
        freight_cents / 100.0::DOUBLE AS total_freight, nb_sellers, main_seller_id, main_product_id FROM a_items""",
    "a02_main_by_order": "SELECT order_id, main_seller_id, main_product_id FROM i_first",
    "a03_payments_by_order": """SELECT order_id, paid_cents / 100.0::DOUBLE AS total_payment_value, max_installments,
        payment_type FROM a_payments""",
    "a04_dedup_reviews": "SELECT order_id, review_score FROM a_reviews",
    "a05_items_weight_by_order": WEIGHED + """
        SELECT order_id, nb_items, nb_sellers, price_cents / 100.0::DOUBLE AS total_price,
               freight_cents / 100.0::DOUBLE AS total_freight, main_seller_id, estimated_weight_kg FROM weighed""",
    "a06_late_rate_by_state": BY_STATE,
    "a07_late_rate_by_category": BY_CATEGORY,
    "a08_seller_performance": TOP_SELLERS,
    "a09_cross_state_impact": BY_CROSSING,
    "a10_delay_review_impact": BY_LATENESS,
    "a11_monthly_trend": BY_MONTH,
    "a12_weekday_pattern": BY_WEEKDAY,
    "a06_a12_gold_one_pass": " UNION ALL ".join(
        f"SELECT '{kpi}' AS kpi, {key} AS key, total_orders, {rate} AS rate_pct FROM ({source})"
        for kpi, source, key, rate in (
            ("late_rate_by_state", BY_STATE, "customer_state", "late_rate_pct"),
            ("late_rate_by_category", BY_CATEGORY, "coalesce(product_category_name_english, '?')", "late_rate_pct"),
            ("seller_performance", TOP_SELLERS, "main_seller_id || '/' || seller_state", "late_rate_pct"),
            ("cross_state_impact", BY_CROSSING, "CAST(cross_state_delivery AS VARCHAR)", "late_rate_pct"),
            ("delay_review_impact", BY_LATENESS, "CAST(is_late AS VARCHAR)", "bad_review_rate_pct"),
            ("monthly_trend", BY_MONTH, "purchase_year || '/' || purchase_month", "late_rate_pct"),
            ("weekday_pattern", BY_WEEKDAY, "CAST(purchase_weekday AS VARCHAR)", "late_rate_pct"),
        )
    ),
    "a13_executive_dashboard": DASHBOARD,
    "a14_quality_report": f"""
        SELECT count(*) AS total_orders, {_round("CAST(count(*) FILTER (WHERE is_late) AS DOUBLE) / count(*)", 4)} AS late_share,
               {_round("CAST(count(*) FILTER (WHERE review_score IS NULL) AS DOUBLE) / count(*)", 4)} AS missing_review_share
        FROM silver""",
    "a15_late_rate_by_year": f"""
        SELECT CAST(year(bought) AS INTEGER) AS purchase_year, count(*) AS total_orders,
               {_count("delivered > promised")} AS late_orders,
               {_pct("count(*) FILTER (WHERE delivered > promised)", "count(*)")} AS late_rate_pct
        FROM m_orders WHERE order_status = 'delivered' AND delivered IS NOT NULL GROUP BY 1""",
    "a16_late_rate_shift": """
        SELECT r * 100 AS reference_rate_pct, c * 100 AS current_rate_pct, c * 100 - r * 100 AS shift_points,
               ((c * 100) / (r * 100) - 1) * 100 AS relative_change_pct
        FROM (SELECT CAST(count(*) FILTER (WHERE y <= 1997 AND late) AS DOUBLE) / count(*) FILTER (WHERE y <= 1997) AS r,
                     CAST(count(*) FILTER (WHERE y >= 1998 AND late) AS DOUBLE) / count(*) FILTER (WHERE y >= 1998) AS c
              FROM (SELECT year(bought) AS y, delivered > promised AS late FROM m_orders
                    WHERE order_status = 'delivered' AND delivered IS NOT NULL))""",
    "a17_risk_level_counts": f"""SELECT count(*) AS n_orders, {_count("probability >= 0.2")} AS n_high,
        {_count("probability >= 0.1 AND probability < 0.2")} AS n_medium, {_count("probability < 0.1")} AS n_low FROM scored""",
    "w01_rank_topn": """
        SELECT * FROM (SELECT main_seller_id, count(*) AS total_orders,
                              CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS seller_rank
                       FROM silver GROUP BY main_seller_id) WHERE seller_rank <= 50""",
    "w02_monthly_change": f"""
        SELECT purchase_year, purchase_month, late_rate_pct, lag(late_rate_pct) OVER w AS previous_rate_pct,
               round(late_rate_pct - lag(late_rate_pct) OVER w, 2) AS change_points
        FROM ({BY_MONTH}) WINDOW w AS (ORDER BY purchase_year, purchase_month)""",
    "l01_sort_rate_desc": f"SELECT * FROM ({BY_STATE}) ORDER BY late_rate_pct DESC, customer_state",
    "l02_sort_keys": f"SELECT * FROM ({BY_MONTH}) ORDER BY purchase_year, purchase_month",
    "l03_top_risk_states": TOP_STATES,
    "l04_reliable_sellers": _reliable(BY_SELLER),
    "l05_recent_orders": """SELECT order_id, customer_id, order_status, bought AS order_purchase_timestamp FROM m_orders
        WHERE order_id IN (SELECT order_id FROM m_items) ORDER BY bought DESC, order_id LIMIT 40""",
    "l06_priority_queue": f"""
        SELECT s.order_id, customer_state AS state, price_cents / 100.0::DOUBLE AS total_price, risk_pct
        FROM ({RISK}) s JOIN silver USING (order_id) ORDER BY risk_pct DESC, s.order_id LIMIT 15""",
    "q1_global_late_rate": """
        SELECT CAST(round(CAST(count(*) FILTER (WHERE is_late) * 100 AS DECIMAL(28, 8)) / count(*), 2) AS DOUBLE) AS global_late_rate_pct,
               count(*) FILTER (WHERE NOT is_late) AS punctual FROM silver""",
    "q2_review_by_lateness": f"""SELECT CASE WHEN is_late THEN 'En retard' ELSE 'A l''heure' END AS statut, total_orders,
        avg_review_score, bad_review_rate_pct FROM ({BY_LATENESS})""",
    "q3_top_risk_states": """
        SELECT customer_state, CAST(round(100 * avg(CAST(is_late AS INTEGER)), 2) AS DOUBLE) AS late_rate_pct
        FROM silver GROUP BY customer_state ORDER BY late_rate_pct DESC, customer_state LIMIT 5""",
    "q4_cross_vs_same_state": f"""SELECT CASE WHEN cross_state_delivery THEN 'Inter-etats' ELSE 'Meme etat' END AS type_livraison,
        total_orders, late_rate_pct, avg_delivery_days FROM ({BY_CROSSING})""",
    "q5_reliable_sellers": _reliable(TOP_SELLERS),
    "m01_feature_vector": VECTORS,
    "m02_training_set": f"{FEATURES}, CAST(is_late AS INTEGER) AS label FROM silver",
    "m02_training_set_of_orders": WEIGHED + f"""
        SELECT p.order_id, nb_items, nb_sellers, total_price, total_freight,
               CAST(cross_state_delivery AS INTEGER) AS cross_state_delivery, purchase_weekday, purchase_hour,
               estimated_weight_kg, max_installments, CAST(coalesce(delivered > promised, false) AS INTEGER) AS label
        FROM ({PAYLOADS}) p JOIN m_orders o ON o.order_id = p.order_id
        WHERE order_status = 'delivered' AND delivered IS NOT NULL""",
    "m03_stratified_split": SPLIT,
    "m03_split_shares": f"SELECT is_train, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_late FROM ({SPLIT}) GROUP BY is_train",
    "m04_class_weight": f"""SELECT {_count("is_late")} AS positives, {_count("NOT is_late")} AS negatives,
        CAST(count(*) FILTER (WHERE NOT is_late) AS DOUBLE) / nullif(count(*) FILTER (WHERE is_late), 0) AS positive_weight
        FROM silver""",
    "m09_classification_metrics": _metrics("scored", "probability >= 0.2"),
    "m10_roc_auc": """
        , ranked AS (SELECT label, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS place
                     FROM (SELECT label, probability AS s FROM scored))
        SELECT n_late, n_punctual,
               (CAST(places AS DOUBLE) - n_late * (n_late + 1) / 2.0::DOUBLE) / (n_late * n_punctual) AS roc_auc
        FROM (SELECT count(*) FILTER (WHERE label = 1) AS n_late, count(*) FILTER (WHERE label = 0) AS n_punctual,
                     sum(place) FILTER (WHERE label = 1) AS places FROM ranked)""",
    "m11_confusion_matrix": """SELECT label, CAST(probability >= 0.5 AS INTEGER) AS prediction, count(*) AS n_rows
        FROM scored GROUP BY 1, 2""",
    "m12_calibration_check": f"""
        SELECT coalesce(band, 'all') AS band, count(*) AS n_rows,
               {_round("avg(p)", 6)} AS mean_predicted,
               {_round("CAST(sum(label) AS DOUBLE) / count(*)", 6)} AS observed_rate
        FROM (SELECT CAST(CAST(least(floor(probability * 10), 9) AS INTEGER) AS VARCHAR) AS band,
                     probability AS p, label FROM scored)
        GROUP BY ROLLUP (band)""",
    "m12_calibration_bands": BANDS + "SELECT * FROM banded",
    "m12_expected_calibration_error": BANDS + f"""
        SELECT {_round("sum(gap * n_rows) / sum(n_rows)", 6)} AS expected_error, max(gap) AS largest_gap FROM banded""",
    "m14_promotion_gate": f"""SELECT precision, recall, CASE WHEN precision >= 0.60 AND recall >= 0.65 THEN 'deploy_model'
        ELSE 'alert_low_metrics' END AS decision FROM ({_metrics("scored", "probability >= 0.2")})""",
    "m16_priority_policy": f"""
        SELECT *, greatest(reward_0, reward_1, reward_2) AS best_reward,
               CASE WHEN reward_0 >= reward_1 AND reward_0 >= reward_2 THEN 0 WHEN reward_1 >= reward_2 THEN 1 ELSE 2 END AS priority
        FROM ({_REWARDS})""",
    "d01_value_counts": PERIODS + "SELECT column_name, value, n_ref, n_cur FROM counted",
    "d01_column_drift": PERIODS + """SELECT column_name, n_values, total_ref, total_cur, wasserstein, ks, jensen_shannon,
        psi, method, score, drifted FROM judged""",
    "d01_sketched_drift": PERIODS + "SELECT column_name, total_ref, total_cur, true AS ks_near, method, drifted FROM judged",
    "d02_dataset_drift": PERIODS + "SELECT * FROM dataset",
    "d03_classification_by_period": PERIODS + BY_PERIOD,
    "d04_drift_tests": PERIODS + """
        SELECT 'number_of_drifted_columns' AS test, n_drifted < 3 AS passed FROM dataset
        UNION ALL SELECT 'share_of_drifted_columns', share_drifted < 0.3 FROM dataset
        UNION ALL SELECT 'all', n_drifted < 3 AND share_drifted < 0.3 FROM dataset""",
    "d05_monitoring_summary": PERIODS + f"""
        SELECT '1995-1997' AS reference_period, '1998-2001' AS current_period, drift_detected,
               {_round("share_drifted", 3)} AS share_drifted,
               CASE WHEN drift_detected THEN 'DERIVE DETECTEE' ELSE 'Stable' END AS drift_status,
               {_round("precision", 3)} AS precision, {_round("recall", 3)} AS recall,
               CASE WHEN recall < 0.65 THEN 'DEGRADATION' ELSE 'Acceptable' END AS performance_status,
               n_drifted < 3 AND share_drifted < 0.3 AS all_passed,
               CASE WHEN n_drifted < 3 AND share_drifted < 0.3 THEN 'OK' ELSE 'TESTS ECHOUES' END AS tests_status,
               drift_detected OR recall < 0.65 OR NOT (n_drifted < 3 AND share_drifted < 0.3) AS action_required
        FROM dataset, (SELECT * FROM ({BY_PERIOD}) WHERE period = 'current')""",
    "d06_run_monitoring": PERIODS + """
        SELECT period AS report, CAST(count(*) AS DOUBLE) AS value FROM periods WHERE period IS NOT NULL GROUP BY period
        UNION ALL SELECT 'drifted columns', CAST(n_drifted AS DOUBLE) FROM dataset WHERE n_drifted > 0
        UNION ALL SELECT 'tests passed', CAST((n_drifted < 3)::INT + (share_drifted < 0.3)::INT
            + (n_drifted < 3 AND share_drifted < 0.3)::INT AS DOUBLE) FROM dataset""",
    "d06_monthly_job": PERIODS + f"""
        SELECT period, count(*) AS n_rows, CAST(sum(p.label) AS BIGINT) AS n_late, 7 AS gold_tables
        FROM periods p JOIN ({SPLIT}) s ON s.order_id = p.order_id WHERE NOT is_train AND period IS NOT NULL GROUP BY period""",
    "m05_train_boosted_trees": JUDGED_MODEL + _metrics("unseen", f"margin >= 0"),
    "m06_train_with_validation": ONE_MODEL + ", " + KEPT + " UNION ALL ".join(
        f" SELECT is_train, {n} AS rounds, {_losses(f'(SELECT s.* FROM state_{n} s, kept WHERE rounds = {n})')}"
        for n in range(1, ROUNDS + 1)
    ),
    "m06_losses_by_round": JUDGED_MODEL + " UNION ALL ".join(
        f" SELECT is_train, {n} AS round, {_losses(f'state_{n}')}" for n in range(1, ROUNDS + 1)
    ),
    "m07_grid_search_cv": FOLD_MODELS + f"""
        SELECT trees AS "maxIter", 1.0::DOUBLE AS "maxDepth", rate AS "stepSize", {_round("avg(recall)", 6)} AS avg_recall
        FROM (""" + " UNION ALL ".join(f"""
            SELECT {n}::DOUBLE AS trees, rate, cell,
                   coalesce(CAST(count(*) FILTER (WHERE margin >= 0 AND label = 1) AS DOUBLE)
                       / nullif(count(*) FILTER (WHERE label = 1), 0), 0) AS recall
            FROM state_{n} WHERE NOT fit GROUP BY rate, cell""" for n in (1, 2, 3)) + """)
        GROUP BY trees, rate""",
    "m08_score_batch": WHOLE_MODEL + f"""
        SELECT order_id, {_round(boosting.PROBABILITY, 4)} AS risk_proba, {_round(f"{boosting.PROBABILITY} * 100", 1)} AS risk_pct,
               {_level(boosting.PROBABILITY)["level"]} AS level FROM state_3""",
    "m08_order_queue": """SELECT least(count(*), 15) AS n_rows, least(count(*), 15) AS n_orders, least(count(*), 15) AS n_recent
        FROM (SELECT order_id FROM m_orders WHERE order_id IN (SELECT order_id FROM m_items) LIMIT 40)""",
    "m13_feature_importance": WHOLE_MODEL + f"""
        SELECT name AS feature, {_round("coalesce(sum(gained), 0) / (SELECT sum(gained) FROM won)", 6)} AS importance
        FROM (SELECT unnest({list(FEATURE_NAMES)}) AS name, unnest(range({len(FEATURE_NAMES)})) AS feature)
        LEFT JOIN won USING (feature) GROUP BY name""",
    "m15_training_report": JUDGED_MODEL + f"""
        , judged_once AS ({_metrics("unseen", f"margin >= 0")}),
        ranks AS (SELECT label, rank() OVER (ORDER BY margin) + (count(*) OVER (PARTITION BY margin) - 1) / 2.0 AS place FROM unseen),
        area AS (
            SELECT (sum(place) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
                / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)) AS auc FROM ranks)
        SELECT {_count("is_train")} AS n_train, {_count("NOT is_train")} AS n_test,
               {_round("avg(label) FILTER (WHERE is_train)", 4)} AS base_rate,
               {_round("any_value(j.precision)", 4)} AS precision, {_round("any_value(j.recall)", 4)} AS recall,
               {_round("any_value(j.f1_score)", 4)} AS f1_score, {_round("any_value(auc)", 4)} AS roc_auc,
               CASE WHEN any_value(j.precision) >= 0.6 AND any_value(j.recall) >= 0.65 THEN 'deploy_model' ELSE 'alert_low_metrics' END
                   AS decision
        FROM state_3, judged_once j, area""",
    "s18_save_load_model": WHOLE_MODEL + f"SELECT order_id, {_round(boosting.PROBABILITY, 6)} AS probability, true AS same FROM state_3",
    "t02_stream_score": WEIGHED + f"""
        SELECT {_count("n % 10 <> 0")} AS n_scored, {_count("n % 10 <> 0")} AS n_orders, {_count("n % 10 <> 0")} AS n_as_batch,
               {_count("n % 10 = 0")} AS n_rejected FROM (SELECT CAST(order_id AS BIGINT) AS n FROM ({PAYLOADS}))""",
    "t01_stream_ingest": """SELECT 'orders' AS source_table, order_status, count(*) AS n_orders, count(*) AS n_ids
        FROM m_orders GROUP BY order_status""",
}
_WITH_PRELUDE["s02_read_csv_inferred"] = """
    SELECT DISTINCT p.product_category_name, product_category_name_english, product_photos_qty
    FROM m_products p LEFT JOIN m_translation t ON t.product_category_name = p.product_category_name"""
_WITH_PRELUDE["s10_export_warehouse"] = _WITH_PRELUDE["s11_contract_weekday_pattern"]
_WITH_PRELUDE["s17_write_json_artifacts"] = _WITH_PRELUDE["a14_quality_report"]
_WITH_PRELUDE["a06_a12_gold_by_months"] = _WITH_PRELUDE["a06_a12_gold_one_pass"]
_WITH_PRELUDE["j05_left_sellers_salted"] = _WITH_PRELUDE["j05_left_sellers"]

# Queries over the raw tables.
_ALONE: dict[str, str] = {
    "s03_add_lineage": """SELECT o_orderkey, 'orders' AS source_table, 'orders.parquet' AS source_file,
        true AS has_ingested_at FROM orders""",
    "s15_read_pruned": "SELECT o_orderkey, o_orderstatus FROM orders",
    "a18_ingest_counts": _sizes({n: n for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")}),
}


def oracle_sql() -> dict[str, str]:
    return {**{name: PRELUDE + sql for name, sql in _WITH_PRELUDE.items()}, **_ALONE}
