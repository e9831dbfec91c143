"""SQL fragments: canonical tables, shared steps and the final SELECT of each query."""

EXCLUDED = "('3','7','11','19','23','29','31','37','41','43','47','53','59')"
DAY = "DATE '2024-01-04'"


def _crm(as_of: str) -> str:
    return f"""
  SELECT CAST(p.user_id AS VARCHAR) AS user_id, p.ltv AS lifetime_purchases_usd,
         p.last_amount AS last_purchase_amount_usd, p.last_ts AS last_purchase_at,
         p.n AS total_purchases,
         CAST(date_diff('day', CAST(p.last_ts AS DATE), DATE '{as_of}') AS INTEGER)
           AS days_since_last_purchase,
         CAST(date_diff('day', CAST(s.last_ts AS DATE), DATE '{as_of}') AS INTEGER)
           AS days_since_last_session,
         CASE WHEN p.n >= 10 THEN 'loyal' ELSE 'active' END AS lifecycle_state,
         n_name AS country, c_mktsegment AS favorite_box_category
  FROM (SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS ltv,
               count(*) AS n, max(ts) AS last_ts,
               arg_max(CAST(value AS DECIMAL(18,2)), (ts, event_id)) AS last_amount
        FROM events WHERE event_type = 'purchase' AND ts < TIMESTAMP '{as_of} 00:00:00'
        GROUP BY user_id) p
  LEFT JOIN (SELECT user_id, max(ts) AS last_ts FROM keyed
             WHERE event_type = 'signup' AND k < 10 AND ts < TIMESTAMP '{as_of} 00:00:00'
             GROUP BY user_id) s ON s.user_id = p.user_id
  LEFT JOIN customer ON c_custkey = p.user_id
  LEFT JOIN nation ON n_nationkey = c_nationkey"""


CANONICAL = f"""
keyed AS (
  SELECT event_id, user_id, CAST(user_id AS VARCHAR) AS uid, ts, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
logins AS (
  SELECT uid AS user_id, ts AS event_timestamp FROM keyed WHERE event_type = 'view'),
purchases AS (
  SELECT event_id, uid AS user_id, ts AS event_timestamp,
         CAST(value AS DECIMAL(18,2)) AS amount_usd,
         CASE k % 6 WHEN 0 THEN '5k-coins-shop-item' WHEN 1 THEN 'starter-pack-shop-item'
           WHEN 2 THEN 'coin-pack-small-shop-item' WHEN 3 THEN 'coin-pack-large-shop-item'
           WHEN 4 THEN 'season-bundle' END AS product_slug,
         CASE WHEN k % 3 = 0 THEN 'SAVE' || k END AS coupon_code
  FROM keyed WHERE event_type = 'purchase'),
box_events AS (
  SELECT uid AS user_id, ts AS event_timestamp, 'Box ' || (k % 12) AS box_display_name,
         (k % 12) * 8 + CASE WHEN k >= 96 THEN 5 ELSE 0 END AS box_volatility,
         event_id % 6 AS boxes_opened_count,
         CAST(value AS DECIMAL(18,2)) AS total_coins_spent
  FROM keyed WHERE event_type IN ('click', 'error')),
vendor_pricing AS (
  SELECT l_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
         l_shipdate AS event_timestamp, l_linenumber, l_partkey, l_suppkey,
         CAST(l_quantity AS DECIMAL(18,2)) AS vendor_price,
         CASE WHEN l_returnflag <> 'R' THEN CAST(l_tax * 10 AS DECIMAL(18,2)) END AS vendor_fee
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 10 <> 0),
internal_users AS (SELECT DISTINCT uid AS user_id FROM keyed WHERE user_id % 13 = 0),
day_purchases AS (
  SELECT * FROM purchases
  WHERE CAST(event_timestamp AS DATE) = {DAY} AND user_id NOT IN {EXCLUDED}),
day_boxes AS (
  SELECT * FROM box_events
  WHERE CAST(event_timestamp AS DATE) = {DAY}
    AND user_id IN (SELECT user_id FROM day_purchases))"""


def _money(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"


def _mean(units: str, n: str, scale: int = 2) -> str:
    """``units * 10 ** -scale / n`` in two digits, half up once; whole numbers, nothing over nothing."""
    cent = f"(CAST(nullif({n}, 0) AS HUGEINT) * {10 ** (scale - 2)})"
    units = f"CAST({units} AS HUGEINT)"
    return f"(sign({units}) * ((2 * abs({units}) + {cent}) // (2 * {cent})) / 100.0::DOUBLE)"


def _pct(part: str, whole: str) -> str:
    """Whole percent, half to even; 0 over nothing."""
    return (
        f"CAST(CASE WHEN coalesce({whole}, 0) = 0 THEN 0 ELSE "
        f"round_even(coalesce(CAST({part} AS DOUBLE), 0) / CAST({whole} AS DOUBLE) * 100, 0) END "
        "AS BIGINT)"
    )


def _round1(x: str) -> str:
    """One digit on the exact binary value, ties to even; x is a column, not an expression."""
    p = (
        f"(CASE WHEN {x} < 1 THEN 288230376151711744 WHEN {x} < 16 THEN 4503599627370496 "
        f"WHEN {x} < 2048 THEN 281474976710656 ELSE 1099511627776 END)"
    )
    n = f"(CAST({x} * {p} AS BIGINT) * 10)"
    return (
        f"(({n} // {p}) + CASE WHEN 2 * CAST({n} % {p} AS HUGEINT) > {p} "
        f"OR (2 * CAST({n} % {p} AS HUGEINT) = {p} AND ({n} // {p}) % 2 = 1) "
        "THEN 1 ELSE 0 END) / 10.0::DOUBLE"
    )


def _usd(x: str) -> str:
    return f"format('{{:,.2f}}', CAST({x} AS DOUBLE))"


def _n(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def _crossing(as_of: str) -> str:
    def over(tier: int) -> str:
        return (
            f"(lifetime_purchases_usd >= {tier} "
            f"AND lifetime_purchases_usd - last_purchase_amount_usd < {tier})"
        )

    return f"""
  SELECT user_id, CAST(lifetime_purchases_usd AS DOUBLE) AS ltv_usd,
         CASE WHEN {over(1000)} THEN 'GOAT' WHEN {over(250)} THEN 'Gold'
              WHEN {over(100)} THEN 'VIP' END AS tier_crossed
  FROM ({_crm(as_of)}) crm
  WHERE last_purchase_at >= TIMESTAMP '{as_of} 00:00:00' - INTERVAL 24 HOURS
    AND last_purchase_at <= TIMESTAMP '{as_of} 00:00:00'
    AND NOT EXISTS (SELECT 1 FROM internal_users i WHERE i.user_id = crm.user_id)
    AND ({over(1000)} OR {over(250)} OR {over(100)})"""


def _priced(crossed: str) -> str:
    return f"""
  SELECT c.user_id, ltv_usd,
         {_money("ltv_usd - coalesce(total_vendor_cost, 0)")} AS net_spend_usd,
         v.user_id IS NULL AS no_vendor_pricing, tier_crossed
  FROM {crossed} c LEFT JOIN vendor_costs v ON v.user_id = c.user_id"""


def _newest(crossed: str, as_of: str) -> str:
    return f"""
  SELECT user_id, event_timestamp, CAST(amount_usd AS DOUBLE) AS amount_usd, product_slug,
         row_number() OVER (PARTITION BY user_id
                            ORDER BY event_timestamp DESC, event_id DESC) AS rn
  FROM purchases
  WHERE event_timestamp < TIMESTAMP '{as_of} 00:00:00'
    AND user_id IN (SELECT user_id FROM {crossed})
  QUALIFY rn <= 2"""


# A kept cell of customer k in the sheet that was exported; changes are put around it.
_CELLS = {
    "first_name": "'Customer'",
    "last_name": "split_part(c_name, '#', 2)",
    "email": "'u' || k || '@example.com'",
    "preferred_channel": "'email'",
    "relationship_stage": "CASE k % 4 WHEN 0 THEN 'new' WHEN 1 THEN 'engaged' WHEN 3 THEN ' new ' END",
    "last_contacted_at": "NULL",
    "conversation_note_1": "CASE WHEN k % 5 = 0 THEN c_mktsegment END",
    "conversation_note_2": "CASE WHEN k % 5 = 1 THEN '   ' END",
    "conversation_note_3": "NULL",
    "manager_notes": "NULL",
}


def _cells(where: str, **changes: str) -> str:
    """Long form of one side: a row per user and kept cell; a cell that reads as zero is blank."""
    long = " UNION ALL ".join(
        f"SELECT CAST(k AS VARCHAR) AS user_id, '{name}' AS field, coalesce({changes.get(name, cell)}, '') AS v "
        f"FROM numbered_customer WHERE {where}"
        for name, cell in _CELLS.items()
    )
    zero = r"\s*[+-]?(0+\.?0*|\.0+)\s*"
    return f"SELECT user_id, field, CASE WHEN regexp_full_match(v, '{zero}') THEN '' ELSE v END AS v FROM ({long})"


# Coins per opened box in whole units of the twelfth digit.
_BOX_PRICE = (
    "CASE WHEN boxes_opened_count > 0 THEN (2 * CAST(total_coins_spent * 100 AS HUGEINT) * 10000000000 "
    "+ boxes_opened_count) // (2 * boxes_opened_count) END"
)

# name -> (steps it reads, SELECT)
STEPS: dict[str, tuple[list[str], str]] = {
    "d_active": ([], f"""
  SELECT count(DISTINCT user_id) AS daily_active_users FROM logins
  WHERE CAST(event_timestamp AS DATE) = {DAY} AND user_id NOT IN {EXCLUDED}"""),
    "d_summary": ([], f"""
  SELECT count(DISTINCT user_id) AS total_payers, count(*) AS total_transactions,
         {_money("sum(amount_usd)")} AS total_revenue_usd,
         {_mean("sum(CAST(amount_usd * 100 AS BIGINT))", "count(amount_usd)")} AS avg_transaction_usd,
         CAST(count(*) FILTER (coupon_code IS NOT NULL) AS BIGINT) AS transactions_with_coupon
  FROM day_purchases"""),
    "d_products": ([], f"""
  SELECT product_slug,
         list_aggregate(list_transform(
           regexp_extract_all(replace(replace(product_slug, '-shop-item', ''), '-', ' '),
                              '[A-Za-z]+|[^A-Za-z]+'),
           lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '') AS product_label,
         count(DISTINCT user_id) AS payers, count(*) AS transactions,
         {_money("sum(amount_usd)")} AS revenue_usd, {_mean("sum(CAST(amount_usd * 100 AS BIGINT))", "count(amount_usd)")} AS avg_usd
  FROM day_purchases GROUP BY product_slug"""),
    "d_boxes": ([], f"""
  SELECT box_display_name, box_volatility, CAST(sum(boxes_opened_count) AS BIGINT) AS total_opens,
         count(DISTINCT user_id) AS unique_openers,
         {_mean(f"sum({_BOX_PRICE})", f"count({_BOX_PRICE})", 12)} AS box_price_coins
  FROM day_boxes GROUP BY box_display_name, box_volatility
  ORDER BY total_opens DESC NULLS LAST, box_display_name, box_volatility LIMIT 10"""),
    "d_openers": ([], """
  SELECT user_id, CAST(sum(boxes_opened_count) AS BIGINT) AS total_boxes_opened,
         count(DISTINCT box_display_name) AS distinct_boxes,
         CAST(round(sum(total_coins_spent), 0) AS DOUBLE) AS total_coins_spent
  FROM day_boxes GROUP BY user_id
  ORDER BY total_boxes_opened DESC NULLS LAST, user_id LIMIT 5"""),
    "d_spenders": ([], f"""
  SELECT user_id, count(*) AS transactions, {_money("sum(amount_usd)")} AS total_spend_usd,
         string_agg(product_slug, ', ' ORDER BY event_timestamp, event_id) AS products_bought
  FROM day_purchases GROUP BY user_id
  ORDER BY total_spend_usd DESC NULLS LAST, user_id LIMIT 5"""),
    "d_cohort": ([], f"""
  SELECT user_id, CASE WHEN prior = 0 THEN 'new' ELSE 'return' END AS payer_type,
         lifetime_purchases, lifetime_value_usd, today_revenue_usd,
         CAST(last_prior AS DATE) AS last_prior_purchase_date,
         CAST({DAY} - CAST(last_prior AS DATE) AS BIGINT) AS days_since_last_purchase
  FROM (SELECT user_id,
               max(CASE WHEN CAST(event_timestamp AS DATE) < {DAY} THEN event_timestamp END)
                 AS last_prior,
               count(*) FILTER (CAST(event_timestamp AS DATE) < {DAY}) AS prior,
               count(*) AS lifetime_purchases,
               {_money("sum(amount_usd)")} AS lifetime_value_usd,
               {_money(f"sum(CASE WHEN CAST(event_timestamp AS DATE) = {DAY} THEN amount_usd ELSE 0 END)")}
                 AS today_revenue_usd
        FROM purchases
        WHERE CAST(event_timestamp AS DATE) <= {DAY}
          AND user_id IN (SELECT user_id FROM day_purchases)
        GROUP BY user_id)"""),
    "d_top_openers": (["d_boxes"], f"""
  SELECT box_display_name, user_id, CAST(sum(boxes_opened_count) AS BIGINT) AS opens,
         {_money("sum(total_coins_spent)")} AS coins_spent
  FROM day_boxes
  WHERE box_display_name = (SELECT box_display_name FROM d_boxes
                            ORDER BY total_opens DESC NULLS LAST, box_display_name, box_volatility
                            LIMIT 1)
  GROUP BY box_display_name, user_id"""),
    "d_kpis": (["d_active", "d_summary", "d_cohort"], f"""
  SELECT dau, total_payers, total_transactions, total_revenue_usd, avg_transaction_usd,
         transactions_with_coupon, new_count, ret_count, pct_new, 100 - pct_new AS pct_ret,
         new_rev, ret_rev,
         CASE WHEN new_count = 0 THEN 0 ELSE new_rev / new_count END AS new_avg,
         CASE WHEN ret_count = 0 THEN 0 ELSE ret_rev / ret_count END AS ret_avg,
         {_pct("new_rev", "total_revenue_usd")} AS new_rev_pct,
         {_pct("ret_rev", "total_revenue_usd")} AS ret_rev_pct,
         CASE WHEN total_payers = 0 THEN 0 ELSE total_revenue_usd / total_payers END AS arppu
  FROM (SELECT (SELECT daily_active_users FROM d_active) AS dau, s.total_payers,
               s.total_transactions, coalesce(s.total_revenue_usd, 0) AS total_revenue_usd,
               coalesce(s.avg_transaction_usd, 0) AS avg_transaction_usd,
               s.transactions_with_coupon, c.new_count, c.ret_count, c.new_rev, c.ret_rev,
               {_pct("c.new_count", "s.total_payers")} AS pct_new
        FROM d_summary s, (
          SELECT CAST(count(*) FILTER (payer_type = 'new') AS BIGINT) AS new_count,
                 CAST(count(*) FILTER (payer_type = 'return') AS BIGINT) AS ret_count,
                 coalesce(CAST(sum(CAST(today_revenue_usd AS DECIMAL(18,2)))
                   FILTER (payer_type = 'new') AS DOUBLE), 0) AS new_rev,
                 coalesce(CAST(sum(CAST(today_revenue_usd AS DECIMAL(18,2)))
                   FILTER (payer_type = 'return') AS DOUBLE), 0) AS ret_rev
          FROM d_cohort) c)"""),
    "d_mix": (["d_boxes", "d_top_openers"], f"""
  SELECT CAST(total AS BIGINT) AS total_opens_all, CAST(top_box AS BIGINT) AS top_box_opens,
         {_pct("top_box", "total")} AS top_box_pct,
         CAST(top_user AS BIGINT) AS top_user_opens,
         {_pct("top_user", "top_box")} AS top_user_pct,
         CASE WHEN total = 0 THEN 0 ELSE CAST(vol_opens AS DOUBLE) / total END AS weighted_vol,
         CAST(high AS BIGINT) AS high_vol_opens, {_pct("high", "total")} AS high_vol_pct
  FROM (SELECT coalesce(sum(total_opens), 0) AS total,
               coalesce(max(total_opens), 0) AS top_box,
               coalesce(sum(box_volatility * total_opens), 0) AS vol_opens,
               coalesce(sum(total_opens) FILTER (box_volatility >= 70), 0) AS high,
               coalesce((SELECT max(opens) FROM d_top_openers), 0) AS top_user
        FROM d_boxes)"""),
    "d_figures": (["d_products", "d_boxes", "d_spenders", "d_cohort", "d_top_openers", "d_kpis",
                   "d_mix"], f"""
  SELECT k.*, m.*, p.*, b.*, s.*, r.*, g.*,
         (SELECT count(*) FROM d_top_openers) > 0 AS has_openers,
         CASE WHEN dau > 0 THEN CAST(total_payers AS DOUBLE) / dau * 100 END AS conv
  FROM d_kpis k CROSS JOIN d_mix m
  LEFT JOIN (SELECT coalesce(product_label, 'No product') AS product, revenue_usd AS product_rev,
                    transactions AS product_tx
             FROM d_products ORDER BY revenue_usd DESC NULLS LAST, product_slug NULLS FIRST
             LIMIT 1) p ON true
  LEFT JOIN (SELECT box_display_name AS box, unique_openers AS box_users
             FROM d_boxes
             ORDER BY total_opens DESC NULLS LAST, box_display_name, box_volatility LIMIT 1) b
    ON true
  LEFT JOIN (SELECT user_id AS spender, transactions AS spender_tx, total_spend_usd AS spend
             FROM d_spenders ORDER BY total_spend_usd DESC NULLS LAST, user_id LIMIT 1) s ON true
  LEFT JOIN (SELECT user_id AS repeater, transactions AS repeater_tx,
                    count(*) OVER () AS repeaters
             FROM d_spenders WHERE transactions >= 3
             ORDER BY total_spend_usd DESC NULLS LAST, user_id LIMIT 1) r ON true
  LEFT JOIN (SELECT user_id AS gap_user, days_since_last_purchase AS gap,
                    lifetime_value_usd AS gap_ltv, lifetime_purchases AS gap_n
             FROM d_cohort WHERE payer_type = 'return' AND days_since_last_purchase > 0
             ORDER BY gap DESC, gap_ltv DESC NULLS LAST, user_id LIMIT 1) g ON true"""),
    "d_shares": (["d_figures"], f"""
  SELECT *, {_pct("spend", "total_revenue_usd")} AS spend_pct,
         {_pct("transactions_with_coupon", "total_transactions")} AS coupon_pct,
         {_pct("product_rev", "total_revenue_usd")} AS product_pct,
         {_round1("conv")} AS conversion,
         CAST(round_even(weighted_vol, 0) AS BIGINT) AS vol
  FROM d_figures"""),
    "d_candidates": (["d_shares"], f"""
  SELECT 10 AS priority, 0 AS rule, 'No payers today' AS label,
         'Zero purchase transactions were recorded for 2024-01-04.' AS detail
  FROM d_shares WHERE total_payers = 0
  UNION ALL
  SELECT CASE WHEN new_count = total_payers OR ret_count = total_payers THEN 10
              WHEN pct_new >= 70 OR pct_new <= 30 THEN 9 ELSE 6 END, 1,
         CASE WHEN new_count = total_payers THEN 'All new payers'
              WHEN ret_count = total_payers THEN 'All return payers'
              WHEN pct_new >= 70 THEN 'Heavy new payer skew'
              WHEN pct_new <= 30 THEN 'Return payer dominated' ELSE 'Balanced cohort' END,
         CASE WHEN new_count = total_payers
              THEN 'Every payer today was a first-time buyer. ' || new_count
                || ' new users generated $' || {_usd("new_rev")} || ' at $' || {_usd("new_avg")}
                || ' avg.'
              WHEN ret_count = total_payers
              THEN 'No new buyers today. ' || ret_count || ' returning users generated $'
                || {_usd("ret_rev")} || ' at $' || {_usd("ret_avg")} || ' avg.'
              WHEN pct_new >= 70
              THEN new_count || ' of ' || total_payers || ' payers (' || pct_new
                || '%) were new, contributing $' || {_usd("new_rev")} || ' vs $'
                || {_usd("ret_rev")} || ' from ' || ret_count || ' returning users.'
              WHEN pct_new <= 30
              THEN ret_count || ' of ' || total_payers || ' payers (' || (100 - pct_new)
                || '%) were returning, driving $' || {_usd("ret_rev")} || ' (' || ret_rev_pct
                || '% of revenue).'
              ELSE new_count || ' new payers ($' || {_usd("new_avg")} || ' avg) vs ' || ret_count
                || ' returning ($' || {_usd("ret_avg")} || ' avg) — '
                || CASE WHEN ret_avg > new_avg THEN 'returners' ELSE 'new users' END
                || ' spent more per head.' END
  FROM d_shares WHERE total_payers > 0
  UNION ALL
  SELECT CASE WHEN gap >= 14 THEN 9 ELSE 7 END, 2,
         CASE WHEN gap >= 14 THEN 'Long re-engagement' ELSE 'Re-engagement gap' END,
         CASE WHEN gap >= 14
              THEN 'User ' || gap_user || ' returned after ' || gap || ' days away with $'
                || {_usd("gap_ltv")} || ' LTV across ' || gap_n || ' lifetime purchases.'
              ELSE 'Top returning user came back after ' || gap || ' days ($'
                || {_usd("gap_ltv")} || ' LTV).' END
  FROM d_shares WHERE total_payers > 0 AND gap >= 5
  UNION ALL
  SELECT CASE WHEN spend_pct >= 40 THEN 8 ELSE 6 END, 3,
         CASE WHEN spend_pct >= 40 THEN 'Spend concentration'
              ELSE 'Top spender drove ' || spend_pct || '% of revenue' END,
         CASE WHEN spend_pct >= 40
              THEN 'Top spender (user ' || spender || ') accounted for $' || {_usd("spend")}
                || ' (' || spend_pct || '% of total revenue) across ' || spender_tx
                || ' transactions.'
              ELSE '$' || {_usd("spend")} || ' from user ' || spender || '.' END
  FROM d_shares WHERE total_payers > 0 AND total_revenue_usd > 0 AND spend_pct >= 25
  UNION ALL
  SELECT CASE WHEN top_user_pct >= 80 THEN 8 ELSE 7 END, 4,
         box || CASE WHEN top_user_pct >= 80 THEN ' monopolised' ELSE ' dominates opens' END,
         CASE WHEN top_user_pct >= 80
              THEN 'One user opened ' || {_n("top_user_opens")} || ' of ' || {_n("top_box_opens")}
                || ' ' || box || ' boxes (' || top_user_pct || '%).'
              ELSE {_n("top_box_opens")} || ' opens (' || top_box_pct || '% of all '
                || {_n("total_opens_all")} || ') across ' || box_users || ' users.' END
  FROM d_shares
  WHERE total_payers > 0 AND has_openers AND (top_user_pct >= 80 OR top_box_pct >= 50)
  UNION ALL
  SELECT CASE WHEN coupon_pct >= 40 THEN 7 ELSE 5 END, 5,
         CASE WHEN coupon_pct >= 40 THEN 'High coupon usage' ELSE 'No coupons today' END,
         CASE WHEN coupon_pct >= 40
              THEN transactions_with_coupon || ' of ' || total_transactions || ' transactions ('
                || coupon_pct
                || '%) used a coupon code, suggesting active discount-driven purchasing.'
              ELSE 'All ' || total_transactions || ' transactions were full price.' END
  FROM d_shares
  WHERE total_payers > 0 AND (coupon_pct >= 40 OR (coupon_pct = 0 AND total_transactions >= 5))
  UNION ALL
  SELECT 6, 6,
         CASE WHEN high_vol_pct >= 60 THEN 'Risk appetite high'
              ELSE 'Conservative box preference' END,
         CASE WHEN high_vol_pct >= 60
              THEN high_vol_pct || '% of box opens were on high-volatility boxes (vol >= 70), '
                || 'weighted avg volatility ' || vol || '.'
              ELSE 'Only ' || high_vol_pct || '% of opens on high-volatility boxes, '
                || 'weighted avg volatility ' || vol || '.' END
  FROM d_shares
  WHERE total_payers > 0 AND total_opens_all > 0 AND (high_vol_pct >= 60 OR high_vol_pct <= 20)
  UNION ALL
  SELECT 7, 7, 'Repeat buyers',
         repeaters || CASE WHEN repeaters > 1 THEN ' users' ELSE ' user' END
         || ' made 3+ transactions today, led by user ' || repeater || ' with ' || repeater_tx
         || ' purchases.'
  FROM d_shares WHERE total_payers > 0 AND repeaters > 0
  UNION ALL
  SELECT 6, 8, product || ' drove ' || product_pct || '% of revenue',
         '$' || {_usd("product_rev")} || ' from ' || product_tx || ' transactions.'
  FROM d_shares WHERE total_payers > 0 AND total_revenue_usd > 0 AND product_pct >= 60
  UNION ALL
  SELECT CASE WHEN conversion >= 10 THEN 7 ELSE 5 END, 9,
         CASE WHEN conversion >= 10 THEN 'Strong conversion' ELSE 'Low conversion' END,
         CASE WHEN conversion >= 10
              THEN total_payers || ' of ' || dau || ' active users paid today ('
                || format('{{:.1f}}', conversion) || '% payer conversion rate).'
              ELSE 'Only ' || format('{{:.1f}}', conversion) || '% of ' || dau
                || ' active users made a purchase today.' END
  FROM d_shares WHERE total_payers > 0 AND (conversion >= 10 OR conversion <= 2)"""),
    "range_days": ([], """
  SELECT CAST(d AS DATE) AS report_date
  FROM generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) g(d)"""),
    "range_purchases": ([], f"""
  SELECT *, CAST(event_timestamp AS DATE) AS report_date FROM purchases
  WHERE CAST(event_timestamp AS DATE) <= DATE '2024-01-31' AND user_id NOT IN {EXCLUDED}"""),
    "r_active": (["range_days"], f"""
  SELECT report_date, count(DISTINCT user_id) AS daily_active_users
  FROM range_days LEFT JOIN (SELECT * FROM logins WHERE user_id NOT IN {EXCLUDED}) l
    ON CAST(event_timestamp AS DATE) = report_date GROUP BY report_date"""),
    "r_summary": (["range_days", "range_purchases"], f"""
  SELECT d.report_date, count(DISTINCT user_id) AS total_payers, count(event_id) AS total_transactions,
         {_money("sum(amount_usd)")} AS total_revenue_usd,
         {_mean("sum(CAST(amount_usd * 100 AS BIGINT))", "count(amount_usd)")} AS avg_transaction_usd,
         count(coupon_code) AS transactions_with_coupon
  FROM range_days d LEFT JOIN range_purchases p ON p.report_date = d.report_date GROUP BY d.report_date"""),
    "r_cohort": (["range_days", "range_purchases"], f"""
  SELECT report_date, user_id, CASE WHEN last_prior IS NULL THEN 'new' ELSE 'return' END AS payer_type,
         lifetime_purchases, lifetime_value_usd, today_revenue_usd,
         last_prior AS last_prior_purchase_date, CAST(report_date - last_prior AS BIGINT) AS days_since_last_purchase
  FROM (SELECT d.report_date, p.user_id,
               max(CASE WHEN p.report_date < d.report_date THEN p.report_date END) AS last_prior,
               count(*) AS lifetime_purchases, {_money("sum(amount_usd)")} AS lifetime_value_usd,
               {_money("sum(CASE WHEN p.report_date = d.report_date THEN amount_usd ELSE 0 END)")} AS today_revenue_usd
        FROM range_days d JOIN range_purchases p ON p.report_date <= d.report_date
        GROUP BY d.report_date, p.user_id HAVING count(*) FILTER (p.report_date = d.report_date) > 0)"""),
    "r_boxes": (["range_purchases"], f"""
  SELECT b.*, CAST(b.event_timestamp AS DATE) AS report_date FROM box_events b
  WHERE (CAST(b.event_timestamp AS DATE), user_id) IN
        (SELECT report_date, user_id FROM range_purchases WHERE report_date >= DATE '2024-01-02')"""),
    "vendor_costs": ([], f"""
  SELECT user_id, {_money("sum(vendor_price + vendor_fee)")} AS total_vendor_cost
  FROM vendor_pricing GROUP BY user_id"""),
    "crossed_early": ([], _crossing("2024-01-05")),
    "crossed_late": ([], _crossing("2024-01-31")),
    "priced_early": (["vendor_costs", "crossed_early"], _priced("crossed_early")),
    "newest_early": (["crossed_early"], _newest("crossed_early", "2024-01-05")),
    "latest_pricing": ([], """
  SELECT order_id, vendor_price, vendor_fee FROM vendor_pricing
  QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY event_timestamp DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1"""),
    "procurement": (["latest_pricing"], """
  SELECT CAST(o.o_custkey AS VARCHAR) AS user_id,
         CAST(sum(coalesce(vendor_price, 0) + coalesce(vendor_fee, 0)) AS DOUBLE)
           AS total_procurement_cost
  FROM orders o LEFT JOIN latest_pricing v ON v.order_id = o.o_orderkey
  GROUP BY o.o_custkey"""),
    "roster": (["procurement"], f"""
  SELECT crm.user_id,
         CASE WHEN lifetime_purchases_usd >= 1000 THEN 'GOAT'
              WHEN lifetime_purchases_usd >= 250 THEN 'Gold' ELSE 'VIP' END AS tier,
         CAST(lifetime_purchases_usd AS DOUBLE) AS ltv_usd,
         CAST(lifetime_purchases_usd AS DOUBLE) - coalesce(total_procurement_cost, 0)
           AS net_spend_usd,
         CAST(last_purchase_at AS DATE) AS last_purchase_date,
         days_since_last_purchase, days_since_last_session, lifecycle_state, total_purchases,
         {_mean("lifetime_purchases_usd * 100", "total_purchases")} AS avg_transaction_usd,
         country, favorite_box_category
  FROM ({_crm("2024-01-31")}) crm LEFT JOIN procurement c ON c.user_id = crm.user_id
  WHERE lifetime_purchases_usd >= 100
    AND NOT EXISTS (SELECT 1 FROM internal_users i WHERE i.user_id = crm.user_id)"""),
    "merged": (["roster"], """
  SELECT r.*,
         CASE WHEN c_custkey IS NULL THEN '' ELSE 'Customer' END AS first_name,
         coalesce(split_part(c_name, '#', 2), '') AS last_name,
         CASE WHEN c_custkey IS NULL THEN '' ELSE 'u' || c_custkey || '@example.com' END AS email,
         CASE WHEN c_custkey IS NULL THEN '' ELSE 'email' END AS preferred_channel,
         CASE WHEN c_custkey IS NULL THEN 'new' WHEN c_custkey % 4 = 0 THEN 'new'
              WHEN c_custkey % 4 = 1 THEN 'engaged' WHEN c_custkey % 4 = 3 THEN ' new '
              ELSE '' END AS relationship_stage,
         '' AS last_contacted_at,
         CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment ELSE '' END AS conversation_note_1,
         CASE WHEN c_custkey % 5 = 1 THEN '   ' ELSE '' END AS conversation_note_2,
         '' AS conversation_note_3, '' AS manager_notes, c_custkey IS NULL AS is_new
  FROM roster r
  LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0)
    ON CAST(c_custkey AS VARCHAR) = r.user_id"""),
    "numbered_customer": ([], "SELECT c_custkey AS k, c_name, c_mktsegment FROM customer"),
    "base_cells": (["numbered_customer"], _cells("k % 3 <> 0")),
    "sheet_cells": (["numbered_customer"], _cells(
        "k % 3 <> 0 AND k % 7 <> 6 OR k % 12 = 0",
        manager_notes="CASE WHEN k % 11 = 0 THEN 'sheet ' || k END",
        relationship_stage=f"CASE WHEN k % 8 = 1 THEN 'won' ELSE {_CELLS['relationship_stage']} END",
        conversation_note_1="CASE WHEN k % 10 <> 0 AND k % 5 = 0 THEN c_mktsegment END",
        preferred_channel="CASE WHEN k % 13 = 0 THEN 'phone' ELSE 'email' END")),
    "now_cells": (["numbered_customer"], _cells(
        "k % 3 <> 0 AND k % 9 <> 8 OR k % 6 = 3",
        manager_notes="CASE WHEN k % 22 = 0 THEN 'other ' || k WHEN k % 55 = 0 THEN 'sheet ' || k END",
        relationship_stage=f"CASE WHEN k % 16 = 1 THEN 'lost' ELSE {_CELLS['relationship_stage']} END",
        preferred_channel="CASE WHEN k % 26 = 0 THEN 'phone' WHEN k % 17 = 0 THEN '0' ELSE 'email' END")),
    "sheet_merge": (["base_cells", "sheet_cells", "now_cells"], """
  SELECT user_id, field, base, sheet, current, sheet <> base AND current <> base AND sheet <> current AS clash,
         CASE WHEN sheet <> base THEN sheet ELSE current END AS taken
  FROM (SELECT k.user_id, k.field, coalesce(b.v, '') AS base, coalesce(s.v, b.v, '') AS sheet,
               coalesce(n.v, b.v, '') AS current
        FROM (SELECT user_id, field FROM base_cells UNION SELECT user_id, field FROM sheet_cells
              UNION SELECT user_id, field FROM now_cells) k
        LEFT JOIN base_cells b USING (user_id, field)
        LEFT JOIN sheet_cells s USING (user_id, field)
        LEFT JOIN now_cells n USING (user_id, field))"""),
    "halves": (["merged"], """
  SELECT *, CASE WHEN trim(conversation_note_1) <> '' OR trim(conversation_note_2) <> ''
                   OR trim(conversation_note_3) <> '' THEN 70 ELSE 50 END AS context_score,
         CASE WHEN days_since_last_session IS NULL THEN 0.0::DOUBLE
              ELSE round(greatest(0.0::DOUBLE, 100.0::DOUBLE
                - (CAST(days_since_last_session AS DOUBLE) / 30.0::DOUBLE) * 100.0::DOUBLE), 1)
              END AS recency_score
  FROM merged"""),
    "means": (["halves"], """
  SELECT *, recency_score * 0.5::DOUBLE + context_score * 0.5::DOUBLE AS mean_score FROM halves"""),
    "scored": (["means"], f"""
  SELECT * EXCLUDE (mean_score, is_new),
         CASE WHEN hot_cold_score >= 70 THEN 'Hot' WHEN hot_cold_score >= 40 THEN 'Warm'
              WHEN hot_cold_score >= 15 THEN 'Cold' ELSE 'Inactive' END AS hot_cold_label,
         DATE '2024-01-31' AS score_updated
  FROM (SELECT *, {_round1("mean_score")} AS hot_cold_score FROM means)"""),
}

FINAL: dict[str, tuple[list[str], str]] = {
    "daily_active_users": (["d_active"], "SELECT * FROM d_active"),
    "purchase_summary": (["d_summary"], "SELECT * FROM d_summary"),
    "revenue_by_product": (["d_products"], "SELECT * FROM d_products"),
    "top_boxes": (["d_boxes"], "SELECT * FROM d_boxes"),
    "top_openers": (["d_openers"], "SELECT * FROM d_openers"),
    "top_spenders": (["d_spenders"], "SELECT * FROM d_spenders"),
    "payer_cohort": (["d_cohort"], "SELECT * FROM d_cohort"),
    "top_box_openers": (["d_top_openers"], "SELECT * FROM d_top_openers"),
    "cohort_kpis": (["d_kpis"], "SELECT * FROM d_kpis"),
    "returning_payers": (["d_cohort"], """
SELECT user_id, lifetime_value_usd, lifetime_purchases, days_since_last_purchase
FROM d_cohort WHERE payer_type = 'return'"""),
    "box_mix": (["d_mix"], "SELECT * FROM d_mix"),
    "observations": (["d_candidates"], """
SELECT row_number() OVER (ORDER BY priority DESC, rule) AS rank,
       CAST(priority AS BIGINT) AS priority, CAST(rule AS BIGINT) AS rule, label, detail
FROM d_candidates QUALIFY rank <= 3"""),
    "payer_cohort_from_state": (["d_cohort"], "SELECT * FROM d_cohort"),
    "daily_active_users_range": (["r_active"], "SELECT * FROM r_active"),
    "purchase_summary_range": (["r_summary"], "SELECT * FROM r_summary"),
    "revenue_by_product_range": (["range_purchases"], f"""
SELECT report_date, product_slug,
       list_aggregate(list_transform(
         regexp_extract_all(replace(replace(product_slug, '-shop-item', ''), '-', ' '), '[A-Za-z]+|[^A-Za-z]+'),
         lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '') AS product_label,
       count(DISTINCT user_id) AS payers, count(*) AS transactions, {_money("sum(amount_usd)")} AS revenue_usd,
       {_mean("sum(CAST(amount_usd * 100 AS BIGINT))", "count(amount_usd)")} AS avg_usd
FROM range_purchases WHERE report_date >= DATE '2024-01-02' GROUP BY report_date, product_slug"""),
    "payer_cohort_range": (["r_cohort"], "SELECT * FROM r_cohort"),
    "cohort_kpis_range": (["r_active", "r_summary", "r_cohort"], f"""
SELECT report_date, dau, total_payers, total_transactions, total_revenue_usd, avg_transaction_usd,
       transactions_with_coupon, new_count, ret_count, pct_new, 100 - pct_new AS pct_ret, new_rev, ret_rev,
       CASE WHEN new_count = 0 THEN 0 ELSE new_rev / new_count END AS new_avg,
       CASE WHEN ret_count = 0 THEN 0 ELSE ret_rev / ret_count END AS ret_avg,
       {_pct("new_rev", "total_revenue_usd")} AS new_rev_pct, {_pct("ret_rev", "total_revenue_usd")} AS ret_rev_pct,
       CASE WHEN total_payers = 0 THEN 0 ELSE total_revenue_usd / total_payers END AS arppu
FROM (SELECT a.report_date, daily_active_users AS dau, total_payers, total_transactions,
             coalesce(total_revenue_usd, 0) AS total_revenue_usd,
             coalesce(avg_transaction_usd, 0) AS avg_transaction_usd, transactions_with_coupon,
             coalesce(new_count, 0) AS new_count, coalesce(ret_count, 0) AS ret_count,
             coalesce(new_rev, 0) AS new_rev, coalesce(ret_rev, 0) AS ret_rev,
             {_pct("coalesce(new_count, 0)", "total_payers")} AS pct_new
      FROM r_active a JOIN r_summary s ON s.report_date = a.report_date
      LEFT JOIN (SELECT report_date, CAST(count(*) FILTER (payer_type = 'new') AS BIGINT) AS new_count,
                        CAST(count(*) FILTER (payer_type = 'return') AS BIGINT) AS ret_count,
                        CAST(sum(CAST(today_revenue_usd AS DECIMAL(18,2))) FILTER (payer_type = 'new') AS DOUBLE) AS new_rev,
                        CAST(sum(CAST(today_revenue_usd AS DECIMAL(18,2))) FILTER (payer_type = 'return') AS DOUBLE) AS ret_rev
                 FROM r_cohort GROUP BY report_date) c ON c.report_date = a.report_date)"""),
    "top_boxes_range": (["r_boxes"], f"""
SELECT * FROM (
  SELECT report_date, box_display_name, box_volatility, CAST(sum(boxes_opened_count) AS BIGINT) AS total_opens,
         count(DISTINCT user_id) AS unique_openers,
         {_mean(f"sum({_BOX_PRICE})", f"count({_BOX_PRICE})", 12)} AS box_price_coins
  FROM r_boxes GROUP BY report_date, box_display_name, box_volatility)
QUALIFY row_number() OVER (PARTITION BY report_date
  ORDER BY total_opens DESC NULLS LAST, box_display_name, box_volatility) <= 10"""),
    "top_openers_range": (["r_boxes"], """
SELECT * FROM (
  SELECT report_date, user_id, CAST(sum(boxes_opened_count) AS BIGINT) AS total_boxes_opened,
         count(DISTINCT box_display_name) AS distinct_boxes,
         CAST(round(sum(total_coins_spent), 0) AS DOUBLE) AS total_coins_spent
  FROM r_boxes GROUP BY report_date, user_id)
QUALIFY row_number() OVER (PARTITION BY report_date ORDER BY total_boxes_opened DESC NULLS LAST, user_id) <= 5"""),
    "weekly_active_users": ([], """
SELECT CAST(date_trunc('week', event_timestamp) AS DATE) AS week, count(DISTINCT user_id) AS active_users
FROM logins GROUP BY ALL"""),
    "monthly_payers": ([], """
SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS month, product_slug, count(DISTINCT user_id) AS payers,
       false AS all_products
FROM purchases GROUP BY ALL
UNION ALL
SELECT CAST(date_trunc('month', event_timestamp) AS DATE), NULL, count(DISTINCT user_id), true FROM purchases GROUP BY ALL"""),
    "vendor_cost_by_user": (["vendor_costs"], "SELECT * FROM vendor_costs"),
    "tier_crossings": (["priced_early"], "SELECT * FROM priced_early"),
    "tier_crossings_month_end": (["vendor_costs", "crossed_late"], _priced("crossed_late")),
    "entrant_last_purchases": (["newest_early"], "SELECT * FROM newest_early"),
    "entrant_last_purchases_month_end": (["crossed_late"], _newest("crossed_late", "2024-01-31")),
    "entrant_feed": (["priced_early", "newest_early"], """
SELECT c.user_id, ltv_usd, net_spend_usd, no_vendor_pricing, tier_crossed,
       coalesce(n, 0) AS purchase_count, purchase_text
FROM priced_early c
LEFT JOIN (SELECT user_id, count(*) AS n,
                  string_agg(rn || ' | '
                    || strftime(event_timestamp + INTERVAL 3 HOURS, '%a %b %-d, %-I:%M %p')
                    || ' | ' || format('{:.2f}', amount_usd) || ' | '
                    || coalesce(product_slug, '—'), '; ' ORDER BY rn) AS purchase_text
           FROM newest_early GROUP BY user_id) p ON p.user_id = c.user_id"""),
    "latest_vendor_pricing": (["latest_pricing"], """
SELECT order_id, vendor_price, vendor_fee FROM latest_pricing"""),
    "procurement_cost_by_user": (["procurement"], "SELECT * FROM procurement"),
    "vip_roster": (["roster"], "SELECT * FROM roster"),
    "merge_roster": (["merged"], "SELECT * FROM merged"),
    "merge_sheet": (["sheet_merge"], "SELECT user_id, "
        + ", ".join(f"max(taken) FILTER (field = '{name}') AS {name}" for name in _CELLS)
        + ", count(*) FILTER (clash) AS n_conflicts FROM sheet_merge GROUP BY user_id"),
    "last_notes": (["base_cells", "sheet_cells", "now_cells"], "SELECT user_id, "
        + ", ".join(f"coalesce(arg_max(v, version) FILTER (field = '{name}' AND v <> ''), '') AS {name}" for name in _CELLS)
        + " FROM (SELECT *, 1 AS version FROM base_cells UNION ALL SELECT *, 2 FROM now_cells "
        "UNION ALL SELECT *, 3 FROM sheet_cells) GROUP BY user_id"),
    "procurement_cost_stored": (["procurement"], "SELECT * FROM procurement"),
    "sheet_conflicts": (["sheet_merge"], """
SELECT user_id, field, base, sheet, current, taken FROM sheet_merge WHERE clash"""),
    "heat_scores": (["scored"], "SELECT * FROM scored"),
    "write_roster_snapshot": (["scored"], "SELECT * FROM scored"),
    "heat_summary": (["scored"], """
SELECT label, (SELECT count(*) FROM scored s WHERE s.hot_cold_label = l.label) AS users,
       (SELECT count(*) FROM scored) AS total
FROM (VALUES ('Hot'), ('Warm'), ('Cold'), ('Inactive')) l(label)"""),
    "needs_attention": (["scored"], """
SELECT user_id, tier, ltv_usd, days_since_last_session, hot_cold_score FROM scored
WHERE hot_cold_label IN ('Cold', 'Inactive') AND trim(relationship_stage) = 'new'
ORDER BY hot_cold_score, ltv_usd DESC, user_id LIMIT 5"""),
    "hot_list": (["scored"], """
SELECT user_id, tier, ltv_usd, hot_cold_score FROM scored WHERE hot_cold_label = 'Hot'"""),
}
