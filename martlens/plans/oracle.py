"""Independent DuckDB SQL for every registered query (the correctness oracle).

The driver registers the base tables as views; the shop views of FIXTURES.md are rebuilt here as
CTEs, written from the derivation rules (not from the Spark code). Engine spellings differ:
``strftime`` for ``date_format``, ``epoch_us(ts) // 1000`` for Spark's truncating
``unix_millis``, ``//`` for ``div``, explicit DOUBLE casts where DuckDB would use DECIMAL.
"""

from __future__ import annotations

from martlens.params import PageFlow, SampleParams, SessionEdges, VisitFilter

# ---------------------------------------------------------------- fixture views
_EV = """
ev AS (
  SELECT event_id, ts, user_id, event_type,
         TRY_CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k
  FROM events
)"""

_LISTS = """
  concat_ws(',', CAST(k % 20 + 1 AS VARCHAR),
            CASE WHEN event_id % 3 >= 1 THEN CAST((k + 7) % 20 + 1 AS VARCHAR) END,
            CASE WHEN event_id % 3 = 2 THEN CAST((k + 13) % 20 + 1 AS VARCHAR) END) AS cat_list,
  concat_ws(',', CAST(k AS VARCHAR),
            CASE WHEN event_id % 3 >= 1 THEN CAST((k + 31) % 100 AS VARCHAR) END,
            CASE WHEN event_id % 3 = 2 THEN CAST((k + 57) % 100 AS VARCHAR) END) AS prod_list"""

_UVA = f"""
uva_src AS (
  SELECT *, {_LISTS}
  FROM ev
),
user_visit_action AS (
  SELECT event_id AS action_id,
         strftime(ts, '%Y-%m-%d') AS date,
         user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
         k % 10 + 1 AS page_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 6 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'purchase' THEN cat_list END AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN prod_list END AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN cat_list END AS pay_category_ids,
         CASE WHEN event_type = 'signup' THEN prod_list END AS pay_product_ids,
         (user_id + k) % 25 AS city_id
  FROM uva_src
)"""

_DIMS = """
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(10 + c_custkey % 50 AS INTEGER) AS age, c_mktsegment AS professional,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM customer
),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS extend_info FROM part
),
city_info AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_ADS = """
ad_lines AS (
  SELECT e.event_id,
         CAST(epoch_us(e.ts) // 1000 AS VARCHAR) || ' ' || replace(c.area, ' ', '_') || ' ' || c.city_name
           || ' ' || CAST(e.user_id AS VARCHAR) || ' ' || CAST(e.k % 6 + 1 AS VARCHAR) AS value
  FROM ev e JOIN city_info c ON (e.user_id + e.k) % 25 = c.city_id
),
ad_parts AS (
  SELECT event_id, value, string_split(value, ' ') AS p FROM ad_lines
),
ad_decoded AS (
  SELECT event_id, value, len(p) AS n_fields,
         TRY_CAST(p[1] AS BIGINT) AS millis, p[2] AS area, p[3] AS city,
         TRY_CAST(p[4] AS BIGINT) AS user_id, TRY_CAST(p[5] AS BIGINT) AS ad_id
  FROM ad_parts
),
ad_checked AS (
  SELECT *,
         CASE WHEN value IS NULL THEN 'null_line'
              WHEN n_fields <> 5 THEN 'field_count'
              WHEN millis IS NULL OR millis < 0 OR millis > 253402300799999 THEN 'bad_millis'
              WHEN user_id IS NULL THEN 'bad_user_id'
              WHEN ad_id IS NULL THEN 'bad_ad_id' END AS reject_reason
  FROM ad_decoded
),
ad_clicks AS (
  SELECT event_id, epoch_ms(millis) AS ts, area, city, user_id, ad_id
  FROM ad_checked WHERE reject_reason IS NULL
),
clicks_d AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM ad_clicks)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


SHOP = _with(_EV, _UVA, _DIMS)
ADS = _with(_EV, _DIMS, _ADS)


# ---------------------------------------------------------------- helpers
def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def visit_filter_sql(f: VisitFilter) -> str:
    """``visits_filtered`` CTE body for a filter (DuckDB)."""
    conds = ["TRUE"]
    if f.start_date:
        conds.append(f"v.date >= {_lit(f.start_date)}")
    if f.end_date:
        conds.append(f"v.date <= {_lit(f.end_date)}")
    if f.start_age is not None:
        conds.append(f"u.age >= {int(f.start_age)}")
    if f.end_age is not None:
        conds.append(f"u.age <= {int(f.end_age)}")
    if f.professionals:
        conds.append("u.professional IN (" + ", ".join(_lit(p) for p in f.professionals) + ")")
    return (
        "SELECT v.* FROM user_visit_action v JOIN user_info u ON v.user_id = u.user_id WHERE "
        + " AND ".join(conds)
    )


def pct_ratio_first(c: str, n: str) -> str:
    return f"floor(CAST({c} AS DOUBLE) / NULLIF({n}, 0) * 1000.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE"


def pct_scaled_first(c: str, n: str) -> str:
    return (f"COALESCE(floor(1000.0::DOUBLE * {c} / NULLIF({n}, 0) + 0.5::DOUBLE) / 10.0::DOUBLE, "
            "0.0::DOUBLE)")


# ---------------------------------------------------------------- R6
def area_product_clicks(keep_no_click: bool = False, other_label: str = "其他") -> str:
    where = "" if keep_no_click else "WHERE v.click_product_id <> -1"
    return f"""
per_city AS (
  SELECT c.area, v.click_product_id AS product_id, c.city_name, count(*) AS city_clicks
  FROM user_visit_action v JOIN city_info c ON v.city_id = c.city_id {where}
  GROUP BY 1, 2, 3
),
rated AS (
  SELECT *,
         sum(city_clicks) OVER (PARTITION BY area, product_id) AS total,
         count(*) OVER (PARTITION BY area, product_id) AS n_cities
  FROM per_city
),
rated2 AS (
  SELECT *, {pct_ratio_first('city_clicks', 'total')} AS rate FROM rated
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY area, product_id ORDER BY rate DESC, city_name) AS pos
  FROM rated2
),
area_product_clicks AS (
  SELECT area, product_id, CAST(max(total) AS BIGINT) AS click_count,
         string_agg(city_name || ':' || printf('%.1f', rate) || '%', ',' ORDER BY pos)
           FILTER (WHERE pos <= 2)
         || CASE WHEN max(n_cities) > 2 THEN
              ',{other_label}:' || printf('%.1f',
                 floor((100.0::DOUBLE - max(rate) FILTER (WHERE pos = 1) - max(rate) FILTER (WHERE pos = 2))
                       * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE) || '%'
            ELSE '' END AS city_remark
  FROM ordered GROUP BY area, product_id
)"""


def area_product_top(top: int = 3, keep_no_click: bool = False) -> str:
    return f"""{SHOP}, {area_product_clicks(keep_no_click)},
ranked AS (
  SELECT *, rank() OVER (PARTITION BY area ORDER BY click_count DESC) AS rk FROM area_product_clicks
)
SELECT r.area, r.product_id, p.product_name, r.click_count, r.city_remark, CAST(r.rk AS INTEGER) AS rk
FROM ranked r JOIN product_info p ON r.product_id = p.product_id
WHERE r.rk <= {top}"""


# ---------------------------------------------------------------- visits and sessions
def _visits(f: VisitFilter) -> str:
    return f"{SHOP}, vf AS ({visit_filter_sql(f)})"


_MS = "epoch_ms(strptime({}, '%Y-%m-%d %H:%M:%S'))"

_STATS = f"""
stats AS (
  SELECT session_id, min(action_time) AS start_time, max(action_time) AS end_time,
         count(*) AS step_length,
         {_MS.format('max(action_time)')} - {_MS.format('min(action_time)')} AS visit_length_ms
  FROM vf GROUP BY session_id
)"""

_ACTS = """
acts AS (
  SELECT session_id, action_time, action_id,
         CASE WHEN search_keyword IS NOT NULL THEN 'search'
              WHEN click_product_id <> -1 THEN 'click'
              WHEN order_product_ids IS NOT NULL THEN 'order' ELSE 'pay' END AS kind,
         CASE WHEN search_keyword IS NOT NULL THEN search_keyword
              WHEN click_product_id <> -1 THEN CAST(click_product_id AS VARCHAR)
              WHEN order_product_ids IS NOT NULL THEN order_product_ids ELSE pay_product_ids END AS item
  FROM {src}
)"""


def _summary(src: str) -> str:
    lists = ",\n".join(
        f"COALESCE(string_agg(item, ',' ORDER BY action_time, action_id) "
        f"FILTER (WHERE kind = '{k}' AND item IS NOT NULL), '') AS {col}"
        for k, col in (("search", "search_keywords"), ("click", "click_product_ids"),
                       ("order", "order_product_ids"), ("pay", "pay_product_ids"))
    )
    return _ACTS.format(src=src) + f""",
summary AS (
  SELECT session_id, min(action_time) AS start_time, max(action_time) AS end_time,
         count(*) AS step_length,
         {_MS.format('max(action_time)')} - {_MS.format('min(action_time)')} AS visit_length_ms,
         {lists}
  FROM acts GROUP BY session_id
)"""


def visits_filtered(f: VisitFilter) -> str:
    return f"{_visits(f)} SELECT * FROM vf"


def session_summary(f: VisitFilter) -> str:
    return f"{_visits(f)}, {_summary('vf')} SELECT * FROM summary"


def session_stage_ratio(f: VisitFilter, e: SessionEdges = SessionEdges()) -> str:
    pcts = ", ".join(
        f"{pct_scaled_first(b + '_count', 'session_count')} AS {b}_pct"
        for b in ("short_visit", "long_visit", "short_step", "long_step")
    )
    return f"""{_visits(f)}, {_STATS},
c AS (
  SELECT count(*) AS session_count,
         count(*) FILTER (WHERE visit_length_ms <= {e.visit_ms}) AS short_visit_count,
         count(*) FILTER (WHERE visit_length_ms > {e.visit_ms}) AS long_visit_count,
         count(*) FILTER (WHERE step_length <= {e.steps}) AS short_step_count,
         count(*) FILTER (WHERE step_length > {e.steps}) AS long_step_count
  FROM stats
)
SELECT *, {pcts} FROM c"""


def _quota(s: SampleParams) -> str:
    return f"""
hours AS (
  SELECT substr(start_time, 1, 13) AS day_hour, count(*) AS sessions FROM stats GROUP BY 1
),
quota AS (
  SELECT day_hour, sessions, ({int(s.size)} * sessions) // (SELECT count(*) FROM stats) AS quota FROM hours
)"""


def session_hour_quota(f: VisitFilter, s: SampleParams = SampleParams()) -> str:
    return f"{_visits(f)}, {_STATS}, {_quota(s)} SELECT * FROM quota"


def session_sample(f: VisitFilter, s: SampleParams = SampleParams()) -> str:
    return f"""{_visits(f)}, {_STATS}, {_quota(s)}, {_summary('vf')},
ranked AS (
  SELECT substr(start_time, 1, 13) AS day_hour,
         CAST(row_number() OVER (PARTITION BY substr(start_time, 1, 13)
                                 ORDER BY md5(session_id || ':' || {_lit(s.seed)}), session_id) AS INTEGER)
           AS sample_rank,
         *
  FROM summary
)
SELECT r.* EXCLUDE (sample_rank) FROM ranked r JOIN quota q ON r.day_hour = q.day_hour
WHERE r.sample_rank <= q.quota"""


# ---------------------------------------------------------------- categories
_CAT = """
cat_acts AS (
  SELECT CASE WHEN click_category_id <> -1 THEN 'click'
              WHEN order_category_ids IS NOT NULL AND length(order_category_ids) > 0 THEN 'order'
              WHEN pay_category_ids IS NOT NULL AND length(pay_category_ids) > 0 THEN 'pay' END AS kind,
         CASE WHEN click_category_id <> -1 THEN [CAST(click_category_id AS VARCHAR)]
              WHEN order_category_ids IS NOT NULL AND length(order_category_ids) > 0
                THEN string_split(order_category_ids, ',')
              WHEN pay_category_ids IS NOT NULL AND length(pay_category_ids) > 0
                THEN string_split(pay_category_ids, ',') END AS ids
  FROM vf
),
cat_ex AS (SELECT kind, unnest(ids) AS category_id FROM cat_acts),
cat_counts AS (
  SELECT category_id,
         count(*) FILTER (WHERE kind = 'click') AS click_count,
         count(*) FILTER (WHERE kind = 'order') AS order_count,
         count(*) FILTER (WHERE kind = 'pay') AS pay_count
  FROM cat_ex WHERE category_id <> '' GROUP BY category_id
)"""


def _cat_top(top: int) -> str:
    return f"""{_CAT},
cat_ranked AS (
  SELECT *, CAST(row_number() OVER (ORDER BY click_count DESC, order_count DESC, pay_count DESC,
                                           category_id) AS INTEGER) AS rk
  FROM cat_counts
),
cat_top AS (SELECT * FROM cat_ranked WHERE rk <= {int(top)})"""


def category_counts(f: VisitFilter) -> str:
    return f"{_visits(f)}, {_CAT} SELECT * FROM cat_counts"


def category_top(f: VisitFilter, top: int = 10) -> str:
    return f"{_visits(f)}, {_cat_top(top)} SELECT * FROM cat_top"


def category_session_top(f: VisitFilter, top_categories: int = 10, top: int = 10) -> str:
    return f"""{_visits(f)}, {_cat_top(top_categories)},
cs AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, session_id, count(*) AS click_count
  FROM vf
  WHERE click_category_id <> -1 AND CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM cat_top)
  GROUP BY 1, 2
),
cs_ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id)
                 AS INTEGER) AS rk
  FROM cs
)
SELECT * FROM cs_ranked WHERE rk <= {int(top)}"""


# ---------------------------------------------------------------- pages
def _pair_pred(flow: PageFlow) -> str:
    return "(" + " OR ".join(f"(from_page = {a} AND to_page = {b})" for a, b in flow.pairs) + ")"


def _pages(flow: PageFlow) -> str:
    src = ", ".join(str(p) for p in flow.sources)
    return f"""
pv AS (SELECT page_id, count(*) AS visits FROM vf WHERE page_id IN ({src}) GROUP BY page_id),
steps AS (
  SELECT page_id AS from_page,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_id) AS to_page,
         lead(1) OVER (PARTITION BY session_id ORDER BY action_time, action_id) AS has_next
  FROM vf
),
pt AS (
  SELECT from_page, to_page, count(*) AS transitions FROM steps
  WHERE has_next IS NOT NULL AND {_pair_pred(flow)} GROUP BY 1, 2
)"""


def page_visits(f: VisitFilter, flow: PageFlow) -> str:
    return f"{_visits(f)}, {_pages(flow)} SELECT * FROM pv"


def page_transitions(f: VisitFilter, flow: PageFlow) -> str:
    return f"{_visits(f)}, {_pages(flow)} SELECT * FROM pt"


def page_conversion(f: VisitFilter, flow: PageFlow) -> str:
    values = ", ".join(f"({a}, {b})" for a, b in flow.pairs)
    return f"""{_visits(f)}, {_pages(flow)},
pairs AS (
  SELECT CAST(a AS BIGINT) AS from_page, CAST(b AS BIGINT) AS to_page FROM (VALUES {values}) t(a, b)
)
SELECT p.from_page, p.to_page, CAST(p.from_page AS VARCHAR) || '-' || CAST(p.to_page AS VARCHAR) AS page_jump,
       COALESCE(t.transitions, 0) AS transitions,
       COALESCE(v.visits, 0) AS from_visits,
       {pct_ratio_first('COALESCE(t.transitions, 0)', 'COALESCE(v.visits, 0)')} AS conversion_pct
FROM pairs p
LEFT JOIN pt t ON p.from_page = t.from_page AND p.to_page = t.to_page
LEFT JOIN pv v ON p.from_page = v.page_id"""


# ---------------------------------------------------------------- ads
def ad_clicks() -> str:
    return f"{ADS} SELECT * FROM ad_clicks"


def ad_clicks_rejected() -> str:
    return f"{ADS} SELECT event_id, value, reject_reason FROM ad_checked WHERE reject_reason IS NOT NULL"


def ad_user_counts() -> str:
    return f"{ADS} SELECT day, user_id, ad_id, count(*) AS clicks FROM clicks_d GROUP BY 1, 2, 3"


def _blacklist(threshold: int) -> str:
    return f"""
nth AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, day ORDER BY ts, event_id) AS nth FROM clicks_d
),
trip AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first_trip
  FROM nth WHERE nth = {int(threshold) + 1}
),
blacklist AS (
  SELECT user_id, ts AS blacklisted_at, event_id AS blacklisted_event_id, ad_id, day
  FROM trip WHERE first_trip = 1
)"""


def ad_blacklist(threshold: int) -> str:
    return f"{ADS}, {_blacklist(threshold)} SELECT * FROM blacklist"


def ad_clicks_clean(threshold: int) -> str:
    return f"""{ADS}, {_blacklist(threshold)}
SELECT c.* FROM ad_clicks c LEFT JOIN blacklist b ON c.user_id = b.user_id
WHERE b.user_id IS NULL OR c.ts < b.blacklisted_at
   OR (c.ts = b.blacklisted_at AND c.event_id <= b.blacklisted_event_id)"""


_CITY_COUNTS = """
city_counts AS (
  SELECT day, area, city, ad_id, count(*) AS clicks FROM clicks_d GROUP BY 1, 2, 3, 4
)"""


def ad_daily_city_counts() -> str:
    return f"{ADS}, {_CITY_COUNTS} SELECT * FROM city_counts"


def _area_top(top: int) -> str:
    return f"""{_CITY_COUNTS},
area_counts AS (
  SELECT day, area, ad_id, CAST(sum(clicks) AS BIGINT) AS clicks FROM city_counts GROUP BY 1, 2, 3
),
area_top AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY day, area ORDER BY clicks DESC, ad_id) AS INTEGER) AS rk
    FROM area_counts) WHERE rk <= {int(top)}
)"""


def ad_daily_area_top(top: int = 3) -> str:
    return f"{ADS}, {_area_top(top)} SELECT * FROM area_top"


def ad_daily_area_top_by_cities(top: int = 3) -> str:
    return f"""{ADS}, {_CITY_COUNTS},
per_ad AS (SELECT day, area, ad_id, count(*) AS cities FROM city_counts GROUP BY 1, 2, 3)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY day, area ORDER BY cities DESC, ad_id) AS INTEGER) AS rk
  FROM per_ad) WHERE rk <= {int(top)}"""


def ad_daily_area_top_json(top: int = 3) -> str:
    return f"""{ADS}, {_area_top(top)}
SELECT day, area,
       '[' || string_agg('{{"' || CAST(ad_id AS VARCHAR) || '":' || CAST(clicks AS VARCHAR) || '}}', ','
                         ORDER BY rk) || ']' AS ads_json
FROM area_top GROUP BY day, area"""


def _trend(window: str) -> str:
    return f"""
trend AS (
  SELECT ad_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute, count(*) AS clicks
  FROM ad_clicks WHERE ts > (SELECT max(ts) FROM ad_clicks) - INTERVAL '{window}'
  GROUP BY 1, 2
)"""


def ad_minute_trend(window: str = "1 hour") -> str:
    return f"{ADS}, {_trend(window)} SELECT * FROM trend"


def ad_minute_trend_json(window: str = "1 hour") -> str:
    return f"""{ADS}, {_trend(window)}
SELECT ad_id,
       '[' || string_agg('{{"' || minute || '":' || CAST(clicks AS VARCHAR) || '}}', ',' ORDER BY minute)
           || ']' AS minutes_json
FROM trend GROUP BY ad_id"""


def ad_sliding_counts(window_ms: int = 300_000, slide_ms: int = 10_000) -> str:
    n = window_ms // slide_ms
    return f"""{ADS},
ms AS (SELECT ad_id, epoch_ms(ts) AS m FROM ad_clicks),
starts AS (
  SELECT ad_id, (m // {slide_ms}) * {slide_ms} - i * {slide_ms} AS s FROM ms, range({n}) t(i)
)
SELECT ad_id, epoch_ms(s) AS window_start, epoch_ms(s + {window_ms}) AS window_end, count(*) AS clicks
FROM starts GROUP BY ad_id, s"""


def ad_blacklist_users(threshold: int) -> str:
    return f"{ADS}, {_blacklist(threshold)} SELECT user_id FROM blacklist"


def ad_minute_counts() -> str:
    return f"""{ADS}
SELECT ad_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute, count(*) AS clicks FROM ad_clicks GROUP BY 1, 2"""


def ad_blacklist_moments(threshold: int) -> str:
    return f"{ADS}, {_blacklist(threshold)} SELECT user_id, blacklisted_at, ad_id, day FROM blacklist"


def ad_clicks_clean_fields(threshold: int) -> str:
    return f"""{ADS}, {_blacklist(threshold)}
SELECT c.ts, c.area, c.city, c.user_id, c.ad_id FROM ad_clicks c LEFT JOIN blacklist b ON c.user_id = b.user_id
WHERE b.user_id IS NULL OR c.ts < b.blacklisted_at
   OR (c.ts = b.blacklisted_at AND c.event_id <= b.blacklisted_event_id)"""


def ad_minute_trend_by_minutes_json(window: str = "1 hour") -> str:
    """The stream's view: whole minutes within ``window`` of the newest minute, as JSON per ad."""
    return f"""{ADS},
per_min AS (
  SELECT ad_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute, count(*) AS clicks FROM ad_clicks GROUP BY 1, 2
),
recent AS (
  SELECT * FROM per_min
  WHERE strptime(minute, '%Y-%m-%d %H:%M')
        > (SELECT max(strptime(minute, '%Y-%m-%d %H:%M')) FROM per_min) - INTERVAL '{window}'
)
SELECT ad_id,
       '[' || string_agg('{{"' || minute || '":' || CAST(clicks AS VARCHAR) || '}}', ',' ORDER BY minute)
           || ']' AS minutes_json
FROM recent GROUP BY ad_id"""
