"""Reference SQL (DuckDB dialect) for the warehouse layers, used as an
independent oracle for the Spark plans.  It starts from the same driver
tables and re-derives every layer in plain SQL; nothing is shared with the
Spark code but the fixed values and run parameters."""

from __future__ import annotations

from .. import fixed
from ..config import DEFAULT, RunConfig


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def parse_ts_sql(x: str) -> str:
    s = f"upper(regexp_replace({x}, '(\\d)\\s+(\\d)', '\\1 \\2', 'g'))"
    day = r"(\d{1,2}| [1-9])"
    tm = r"\d{1,2}:\d{1,2}:\d{1,2}"
    iso = f"regexp_replace({s}, '^(\\d{{4}}-\\d{{1,2}}-) ', '\\1')"
    dot = f"regexp_replace({s}, '^ ?(\\d{{1,2}})\\.(\\d{{1,2}})\\.(\\d{{4}})', '\\3-\\2-\\1')"
    shapes = [
        (rf"^\d{{4}}-\d{{1,2}}-{day}T{tm}$", iso, "%Y-%m-%dT%H:%M:%S"),
        (rf"^\d{{4}}-\d{{1,2}}-{day} {tm}$", iso, "%Y-%m-%d %H:%M:%S"),
        (rf"^\d{{4}}-\d{{1,2}}-{day}$", iso, "%Y-%m-%d"),
        (rf"^{day}\.\d{{1,2}}\.\d{{4}} {tm}$", dot, "%Y-%m-%d %H:%M:%S"),
        (rf"^{day}\.\d{{1,2}}\.\d{{4}}$", dot, "%Y-%m-%d"),
    ]
    parts = [f"CASE WHEN regexp_matches({s}, '{rx}') THEN try_strptime({norm}, '{fmt}') END"
             for rx, norm, fmt in shapes]
    parts.append(f"try_strptime(NULLIF(regexp_extract({x}, '(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), ''),"
                 " '%Y-%m-%d')")
    return "CAST(COALESCE(" + ", ".join(parts) + ") AS TIMESTAMP)"


def avg2(sum_expr: str, n_expr: str) -> str:
    """Exact ROUND(sum/n, 2) half-up for non-negative sums, as DOUBLE."""
    return (f"(CAST((2 * CAST(({sum_expr}) * 100 AS HUGEINT) + ({n_expr})) // "
            f"NULLIF(2 * ({n_expr}), 0) AS DOUBLE) / 100)")


def pct2(part: str, whole: str) -> str:
    """Exact ROUND(part*100/whole, 2) half-up for non-negative values, as DOUBLE."""
    return (f"(CAST((2 * CAST({part} AS HUGEINT) * 10000 + ({whole})) // "
            f"NULLIF(2 * ({whole}), 0) AS DOUBLE) / 100)")


def _values(rows, cols):
    body = ", ".join("(" + ", ".join(sql_str(v) if isinstance(v, str) else str(v)
                                     for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) t({', '.join(cols)}))"


def base_ctes(cfg: RunConfig = DEFAULT) -> str:
    missing = ", ".join(str(n) for n in cfg.fixture_missing_airport_nations)
    hh = "lpad(CAST(l_linenumber AS VARCHAR), 2, '0')"
    iso = "strftime(l_shipdate, '%Y-%m-%d')"
    ru = "strftime(l_shipdate, '%d.%m.%Y')"
    batch = f"TIMESTAMP '{cfg.batch_ts}'"
    prev = f"TIMESTAMP '{cfg.prev_batch_ts}'"
    ftype = _values(fixed.FLIGHT_TYPES,
                    ["flight_type_id", "transfers_count", "type_category", "description"])
    return f"""
sn AS (SELECT s_suppkey, n_name AS origin FROM supplier JOIN nation ON s_nationkey = n_nationkey),
cn AS (SELECT c_custkey, n_name AS destination FROM customer JOIN nation ON c_nationkey = n_nationkey),
ods AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS ticket_id,
         sn.origin, cn.destination,
         CASE l_orderkey % 8
           WHEN 0 THEN {iso} || 'T' || {hh} || ':30:00'
           WHEN 1 THEN {iso} || ' ' || {hh} || ':30:00'
           WHEN 2 THEN {iso}
           WHEN 3 THEN {ru} || ' ' || {hh} || ':30:00'
           WHEN 4 THEN {ru}
           WHEN 5 THEN {iso} || 'T' || {hh} || ':30:00+03:00'
           WHEN 6 THEN strftime(l_shipdate, '%Y-%-m-%-d')
           ELSE strftime(l_shipdate, '%d/%m/%Y') END AS departure_at,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         p_brand AS airline,
         'FL' || CAST(l_partkey AS VARCHAR) AS flight_number,
         CAST(l_linenumber - 1 AS INTEGER) AS transfers,
         CAST(l_quantity AS INTEGER) * 10 AS duration,
         CASE WHEN l_linenumber - 1 = 0 THEN 1 ELSE 0 END AS is_direct,
         CASE WHEN CAST(l_extendedprice AS DECIMAL(18,2)) < {fixed.CHEAP_PRICE_BELOW}
              THEN 'cheap' ELSE 'normal' END AS price_category,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS extracted_at,
         '{cfg.batch_ts.replace(' ', 'T')}' AS processed_at,
         sn.origin || '-' || cn.destination AS route
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN sn ON l_suppkey = s_suppkey JOIN cn ON o_custkey = c_custkey),
airport AS (
  SELECT CAST(n_nationkey + 1 AS INTEGER) AS airport_id, n_name AS airport_code,
         r_name AS city, r_name AS country
  FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey NOT IN ({missing})),
ftype AS {ftype},
cal AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS full_date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
         dayname(d) AS day_name, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT CAST(g AS DATE) AS d FROM generate_series(DATE '{cfg.calendar_start}',
        DATE '{cfg.calendar_end}', INTERVAL 1 DAY) t(g))),
pairs AS (SELECT DISTINCT origin, destination FROM ods
          WHERE origin IS NOT NULL AND destination IS NOT NULL),
route AS (
  SELECT CAST(row_number() OVER (ORDER BY p.origin, p.destination) AS INTEGER) AS route_id,
         o.airport_id AS origin_airport_id, d.airport_id AS destination_airport_id,
         CAST(NULL AS INTEGER) AS distance_km, CAST(NULL AS VARCHAR) AS popularity_category
  FROM pairs p JOIN airport o ON p.origin = o.airport_code
               JOIN airport d ON p.destination = d.airport_code),
route_codes AS (
  SELECT o.airport_code AS origin, d.airport_code AS destination, r.route_id
  FROM route r JOIN airport o ON r.origin_airport_id = o.airport_id
               JOIN airport d ON r.destination_airport_id = d.airport_id),
brands AS (SELECT DISTINCT p_brand, CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) AS n
           FROM part),
lk_prev AS (SELECT p_brand AS code, 'Airline ' || CAST(n AS VARCHAR) AS name,
                   'C' || CAST(n % 5 AS VARCHAR) AS country
            FROM brands WHERE n <= {cfg.fixture_prev_known_brands}),
lk_cur AS (SELECT p_brand AS code, 'Airline ' || CAST(n AS VARCHAR) AS name,
                  'C' || CAST(n % 4 AS VARCHAR) AS country
           FROM brands WHERE n <= {cfg.fixture_known_brands}),
codes AS (SELECT DISTINCT airline AS airline_bk FROM ods WHERE airline IS NOT NULL),
src_prev AS (SELECT c.airline_bk, COALESCE(l.name, c.airline_bk) AS airline_name,
                    COALESCE(l.country, 'Unknown') AS country
             FROM codes c LEFT JOIN lk_prev l ON c.airline_bk = l.code),
src_cur AS (SELECT c.airline_bk, COALESCE(l.name, c.airline_bk) AS airline_name,
                   COALESCE(l.country, 'Unknown') AS country
            FROM codes c LEFT JOIN lk_cur l ON c.airline_bk = l.code),
dim_v1 AS (
  SELECT CAST(row_number() OVER (ORDER BY airline_bk) AS BIGINT) AS airline_sk, airline_bk,
         airline_name, country, {prev} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
         1 AS is_current
  FROM src_prev),
chg AS (
  SELECT s.*, c.airline_sk AS cur_sk,
         CASE WHEN c.airline_sk IS NULL THEN 'new'
              WHEN s.airline_name IS NOT DISTINCT FROM c.airline_name
               AND s.country IS NOT DISTINCT FROM c.country THEN 'unchanged'
              ELSE 'updated' END AS status
  FROM src_cur s LEFT JOIN (SELECT * FROM dim_v1 WHERE is_current = 1) c
       ON s.airline_bk = c.airline_bk),
dim_airline AS (
  SELECT d.airline_sk, d.airline_bk, d.airline_name, d.country, d.valid_from,
         CASE WHEN u.cur_sk IS NOT NULL THEN {batch} ELSE d.valid_to END AS valid_to,
         CASE WHEN u.cur_sk IS NOT NULL THEN 0 ELSE d.is_current END AS is_current
  FROM dim_v1 d LEFT JOIN (SELECT cur_sk FROM chg WHERE status = 'updated') u
       ON d.airline_sk = u.cur_sk
  UNION ALL
  SELECT CAST((SELECT COALESCE(MAX(airline_sk), 0) FROM dim_v1)
              + row_number() OVER (ORDER BY airline_bk) AS BIGINT),
         airline_bk, airline_name, country, {batch}, CAST(NULL AS TIMESTAMP), 1
  FROM chg WHERE status <> 'unchanged'),
complete AS (
  SELECT *, {parse_ts_sql('departure_at')} AS dep, {parse_ts_sql('extracted_at')} AS ext
  FROM ods WHERE origin IS NOT NULL AND destination IS NOT NULL AND departure_at IS NOT NULL
             AND price IS NOT NULL AND airline IS NOT NULL),
staged AS (
  SELECT t.ticket_id AS flight_id, t.origin, t.destination, t.airline, t.price,
         CAST(t.duration AS INTEGER) AS duration,
         CASE WHEN t.transfers = 0 THEN 1 WHEN t.transfers = 1 THEN 2 ELSE 3 END AS flight_type_id,
         t.dep AS departure_ts, COALESCE(t.ext, {batch}) AS extracted_at,
         CAST(strftime(t.dep, '%Y%m%d') AS INTEGER) AS date_id,
         rc.route_id, a.airline_sk, c.date_id AS cal_id,
         CASE WHEN t.dep IS NULL THEN 'bad_departure_date'
              WHEN rc.route_id IS NULL THEN 'unknown_route'
              WHEN a.airline_sk IS NULL THEN 'unknown_airline'
              WHEN t.duration IS NULL THEN 'null_duration'
              WHEN c.date_id IS NULL THEN 'date_outside_calendar'
              WHEN t.ticket_id IS NULL THEN 'null_flight_id' END AS reject_reason
  FROM complete t
  LEFT JOIN route_codes rc ON t.origin = rc.origin AND t.destination = rc.destination
  LEFT JOIN (SELECT airline_bk, airline_sk FROM dim_airline WHERE is_current = 1) a
       ON t.airline = a.airline_bk
  LEFT JOIN cal c ON c.date_id = CAST(strftime(t.dep, '%Y%m%d') AS INTEGER)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY extracted_at, departure_ts,
         price, duration, route_id, airline_sk, flight_type_id, date_id) AS rn
  FROM staged WHERE reject_reason IS NULL),
fact AS (SELECT flight_id, route_id, airline_sk, date_id, flight_type_id, price, duration,
                extracted_at FROM ranked WHERE rn = 1)"""
