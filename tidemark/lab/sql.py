"""The views of ``views.py`` as SQL text, for checking results in another engine."""

from __future__ import annotations

LINES = """
lines AS (
  SELECT l_suppkey AS campaign_id, CAST(l_shipdate AS DATE) AS report_date,
    CASE l_returnflag WHEN 'R' THEN 'playlist' WHEN 'A' THEN 'catalog' ELSE 'other' END
      AS engagement_context,
    l_partkey AS track_id, CAST(floor(sqrt(l_partkey % 400)) AS BIGINT) AS isrc,
    CAST(l_quantity AS BIGINT) AS streams,
    CASE WHEN l_shipdate >= DATE '1997-03-10' AND l_shipdate < DATE '1999-02-21'
      THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END AS spend_total,
    n_name AS country_code,
    CASE WHEN o_orderstatus = 'F' THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN p_size <= 45 THEN p_size END AS playlist_position, p_name AS track_name,
    l_orderkey AS order_key, l_linenumber AS line_number, l_extendedprice, l_discount,
    l_linestatus
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""

WINDOWS = """
windows AS (
  SELECT campaign_id, MIN(report_date) AS first_day, MAX(report_date) AS last_day
  FROM lines WHERE spend_total > 0 GROUP BY campaign_id
)"""

SPEND = """
spend AS (
  SELECT campaign_id, SUM(spend_total) AS spend_usd FROM lines GROUP BY campaign_id
)"""

STATEMENT = """
statement AS (
  SELECT isrc, CAST(date_trunc('month', report_date) AS DATE) AS month, country_code,
    CASE WHEN (isrc + month(report_date)) % 10 = 0 THEN 0 ELSE streams END AS streams,
    l_extendedprice * (1 - l_discount) AS revenue, currency
  FROM lines WHERE l_linestatus = 'F'
)"""

DISTRIBUTOR = """
distributor AS (
  SELECT isrc, month, CAST(SUM(streams) AS BIGINT) AS distributor_streams
  FROM statement GROUP BY isrc, month
)"""

RATE = """
rate AS (
  SELECT isrc, month,
    SUM(revenue) / NULLIF(SUM(streams), 0)
      AS revenue_per_stream
  FROM statement WHERE currency = 'USD' GROUP BY isrc, month
)"""

PLAYLIST_MONTHLY = """
monthly AS (
  SELECT e.campaign_id, isrc, CAST(date_trunc('month', report_date) AS DATE) AS month,
    CAST(SUM(streams) AS BIGINT) AS campaign_streams
  FROM lines e JOIN windows w USING (campaign_id)
  WHERE engagement_context = 'playlist' AND report_date BETWEEN first_day AND last_day
  GROUP BY ALL
)"""

TARGETS = """
codes AS (
  SELECT campaign_id, MAX(isrc) AS target_isrc FROM lines
  WHERE engagement_context = 'catalog' GROUP BY campaign_id
),
targets AS (
  SELECT l.campaign_id, target_isrc, MIN(track_id) AS target_track
  FROM lines l JOIN codes c ON l.campaign_id = c.campaign_id AND l.isrc = c.target_isrc
  WHERE engagement_context = 'catalog' GROUP BY ALL
),
split AS (
  SELECT l.*, first_day, last_day,
    CASE WHEN track_id = target_track OR isrc = target_isrc THEN 'promoted'
      ELSE 'other_releases' END AS bucket
  FROM lines l JOIN targets t ON l.campaign_id = t.campaign_id
  JOIN windows w ON l.campaign_id = w.campaign_id
  WHERE l.campaign_id % 2 = 1 AND engagement_context = 'catalog'
    AND report_date BETWEEN first_day AND last_day
)"""

SPLIT_MONTHLY = """
monthly AS (
  SELECT campaign_id, bucket, isrc, CAST(date_trunc('month', report_date) AS DATE) AS month,
    CAST(SUM(streams) AS BIGINT) AS campaign_streams
  FROM split GROUP BY ALL
)"""

ENTITIES = """
entities AS (
  SELECT o_orderkey AS entity_id, CAST(o_orderdate AS DATE) AS created_date FROM orders
)"""

RESULTS = """
results AS (
  SELECT CAST(ts AS DATE) AS run_day,
    CAST(floor((hour(ts) * 60 + minute(ts)) / 15) AS BIGINT) AS run_slot,
    CAST(floor(user_id / 50) AS BIGINT) AS batch, user_id AS entity_id,
    CAST(floor(((hour(ts) * 60 + minute(ts)) % 15) / 5) AS BIGINT) AS window_start,
    CASE WHEN event_type IN ('click', 'signup') THEN 'breakdown'
      WHEN event_type = 'view' THEN 'engagement' WHEN event_type = 'purchase' THEN 'retention'
      WHEN event_id % 4 <= 1 THEN 'retention' WHEN event_id % 4 = 2 THEN 'breakdown'
      ELSE 'engagement' END AS kind,
    event_type <> 'error' AS ok, CAST(floor(value) AS BIGINT) AS row_count,
    CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 3 = 0 THEN 403 ELSE 500 END AS status,
    CASE WHEN event_type <> 'error' THEN NULL
      WHEN event_id % 4 > 1 THEN 'hard'
      WHEN event_id % 3 = 0 THEN 'skip' ELSE 'soft' END AS severity
  FROM events
)"""

COHORTS = """
days AS (
  SELECT user_id, CAST(ts AS DATE) AS day,
    SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS streams,
    MIN(CASE WHEN event_type = 'signup' THEN CAST(ts AS DATE) END) AS joined
  FROM events GROUP BY ALL
),
members AS (
  SELECT user_id, MIN(joined) AS cohort_date FROM days GROUP BY user_id
  HAVING MIN(joined) IS NOT NULL
),
firsts AS (
  SELECT user_id, cohort_date, MIN(date_diff('day', cohort_date, day)) AS first_return
  FROM members LEFT JOIN (SELECT user_id AS u, day FROM days) d
    ON u = user_id AND day > cohort_date AND day <= cohort_date + INTERVAL 7 DAY
  GROUP BY ALL
),
cohorts AS (SELECT cohort_date, COUNT(*) AS cohort_size FROM members GROUP BY cohort_date),
long AS (
  SELECT cohort_date, cohort_size, CAST(n AS INTEGER) AS day_number,
    (SELECT COUNT(*) FROM firsts f WHERE f.cohort_date = c.cohort_date AND first_return = n)
      AS returned,
    (SELECT COUNT(*) FROM firsts f WHERE f.cohort_date = c.cohort_date AND first_return <= n)
      AS returned_so_far,
    (SELECT CAST(COALESCE(SUM(streams), 0) AS BIGINT) FROM days d JOIN members m USING (user_id)
      WHERE m.cohort_date = c.cohort_date AND date_diff('day', m.cohort_date, d.day) = n)
      AS streams,
    date_diff('day', cohort_date, DATE '2024-01-08') > n AS passed
  FROM cohorts c, generate_series(1, 7) g(n)
)"""


def with_views(*views: str) -> str:
    return "WITH " + ",".join(views)


def rounded(expression: str, digits: int = 0) -> str:
    """Half away from zero on the binary double."""
    value, scale = f"({expression})", float(10**digits)
    return f"sign({value}) * floor(abs({value}) * {scale} + 0.5) / {scale}"


def quotient(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0)"
