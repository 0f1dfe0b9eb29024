"""Oracle SQL for the landing feeds: the rows the JSON was made from, with
the parser's default / quarantine rules written directly in SQL."""

from __future__ import annotations

from ..config import DEFAULT, RunConfig
from ..sources.feeds import POLL_SALTS


def feed_ctes(cfg: RunConfig = DEFAULT) -> str:
    stamp = cfg.batch_ts.replace(" ", "T")
    hh = "lpad(CAST(l_linenumber AS VARCHAR), 2, '0')"
    salts = POLL_SALTS
    salt = f"(l_orderkey % {salts})"
    order = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, price, o, d, origin, destination, day, airline, "
             "flight_number, transfers, duration, departure_at, return_at, expires_at")
    airline = "CASE WHEN duration = 60 THEN '' ELSE airline END"
    fno = "CASE WHEN duration = 60 THEN '' ELSE CAST(flight_number AS VARCHAR) END"
    pkind = ("CASE duration WHEN 10 THEN 'missing' WHEN 20 THEN 'null' WHEN 30 THEN 'text' "
             "WHEN 40 THEN 'text' WHEN 110 THEN 'text' ELSE 'number' END")
    pval = ("CASE duration WHEN 10 THEN 0.0 WHEN 20 THEN NULL WHEN 30 THEN NULL "
            "WHEN 100 THEN 1e20::DOUBLE WHEN 110 THEN NULL "
            "ELSE CAST(price AS DOUBLE) END")
    tkind = "CASE duration WHEN 50 THEN 'text' WHEN 70 THEN 'missing' WHEN 90 THEN 'text' ELSE 'number' END"
    tval = "CAST(CASE duration WHEN 70 THEN 0 WHEN 90 THEN NULL WHEN 120 THEN 1099511627776 ELSE transfers END AS BIGINT)"
    direct = ("CASE WHEN duration = 70 THEN true WHEN duration IN (50, 90, 120) THEN false "
              "ELSE transfers = 0 END")
    reason2 = ("CASE WHEN duration = 20 THEN 'null_price' WHEN duration IN (30, 110) THEN 'bad_price' "
               "WHEN duration = 100 THEN 'range_price' WHEN duration = 90 THEN 'bad_transfers' "
               "WHEN duration = 120 THEN 'range_transfers' END")
    reason3 = reason2.replace(" END", " WHEN duration = 130 THEN 'range_duration' END")
    route_ok = "NOT (o = d OR o + d IN (5, 7, 9, 11))"
    route_fault = ("CASE WHEN o = d THEN 'not_success' WHEN o + d = 5 THEN 'no_data' "
                   "WHEN o + d = 7 THEN 'data_not_object' WHEN o + d = 9 THEN 'empty_body' "
                   "WHEN o + d = 11 THEN 'broken_json' END")
    dir_fault = ("CASE WHEN o = 7 THEN 'not_success' WHEN o = 5 THEN 'no_data' "
                 "WHEN o = 13 THEN 'data_not_object' WHEN o = 9 THEN 'empty_body' "
                 "WHEN o = 11 THEN 'broken_json' END")
    return f"""
fl AS (
  SELECT s.s_nationkey AS o, c.c_nationkey AS d, ns.n_name AS origin, nc.n_name AS destination,
         CAST(l_shipdate AS DATE) AS day, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         p_brand AS airline, l_partkey AS flight_number,
         CAST(l_linenumber - 1 AS INTEGER) AS transfers, CAST(l_quantity AS INTEGER) * 10 AS duration,
         strftime(l_shipdate, '%Y-%m-%d') || 'T' || {hh} || ':30:00' AS departure_at,
         strftime(CAST(l_shipdate AS DATE) + INTERVAL 7 DAY, '%Y-%m-%d') || 'T18:00:00' AS return_at,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS expires_at,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier s ON l_suppkey = s.s_suppkey JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  JOIN customer c ON o_custkey = c.c_custkey JOIN nation nc ON c.c_nationkey = nc.n_nationkey),
polled AS (
  SELECT *, CAST({salt} + {salts} * (row_number() OVER (PARTITION BY o, d, origin, destination, day, {salt}
      ORDER BY {order}) - 1) AS INTEGER) AS poll FROM fl),
g_ext AS (
  SELECT {airline} || '_' || {fno} || '_' || destination AS ticket_id, origin, destination,
         departure_at, {pkind} AS price_kind, {pval} AS price, 'rub' AS currency,
         {airline} AS airline, {fno} AS flight_number, {tkind} AS transfers_kind,
         {tval} AS transfers,
         CASE duration WHEN 80 THEN 'missing' ELSE 'number' END AS duration_kind,
         CAST(CASE duration WHEN 80 THEN 0 WHEN 130 THEN 99999999999 ELSE duration END AS BIGINT) AS duration,
         origin AS origin_airport, destination AS destination_airport,
         '/search/' || origin || destination AS link, '{stamp}' AS extracted_at,
         origin || '-' || destination AS route, strftime(day, '%Y-%m-%d') AS departure_date,
         'grouped_prices_api' AS data_source, {direct} AS is_direct, {reason3} AS reject_reason,
         strftime(day, '%Y-%m') AS month, poll, origin AS request_origin
  FROM polled WHERE {route_ok}),
c_ext AS (
  SELECT {airline} || '_' || {fno} || '_' || origin || '_' || destination || '_'
           || strftime(day, '%Y-%m-%d') AS ticket_id,
         origin, destination, departure_at, return_at, {pkind} AS price_kind, {pval} AS price,
         {airline} AS airline, {fno} AS flight_number, {tkind} AS transfers_kind,
         {tval} AS transfers, expires_at, '{stamp}' AS extracted_at,
         origin || '-' || destination AS route, strftime(day, '%Y-%m-%d') AS date,
         'price_calendar_api' AS data_source, {direct} AS is_direct,
         {reason2} AS reject_reason, strftime(day, '%Y-%m') AS month, poll
  FROM polled WHERE {route_ok}),
d_ext AS (
  SELECT origin, destination, {pkind} AS price_kind, {pval} AS price, {airline} AS airline,
         {fno} AS flight_number, departure_at, return_at, expires_at, {tkind} AS transfers_kind,
         {tval} AS transfers, '{stamp}' AS extracted_at,
         'city_directions_api' AS data_source, {direct} AS is_direct,
         {reason2} AS reject_reason, strftime(day, '%Y-%m-%d') AS month, poll
  FROM polled WHERE o NOT IN (5, 7, 9, 11, 13)),
g_norm AS (
  SELECT ticket_id, origin, destination, departure_at, price, airline, flight_number,
         CAST(transfers AS INTEGER) AS transfers, CAST(duration AS INTEGER) AS duration, is_direct,
         CASE WHEN price < 10000 THEN 'cheap' ELSE 'normal' END AS price_category, extracted_at,
         '{stamp}' AS processed_at, route
  FROM g_ext WHERE reject_reason IS NULL),
d_norm AS (
  SELECT origin, destination, price, airline, flight_number, departure_at, return_at, expires_at,
         CAST(transfers AS INTEGER) AS transfers, is_direct,
         CASE WHEN price < 15000 THEN 'popular' ELSE 'normal' END AS popularity_category,
         extracted_at, '{stamp}' AS processed_at
  FROM d_ext WHERE reject_reason IS NULL),
c_norm AS (
  SELECT ticket_id, origin, destination, departure_at, return_at, price, airline, flight_number,
         CAST(transfers AS INTEGER) AS transfers, is_direct, expires_at,
         CASE WHEN price < 10000 THEN 'cheap' ELSE 'normal' END AS trend_category,
         '{stamp}' AS processed_at, route
  FROM c_ext WHERE reject_reason IS NULL),
d_store AS (
  SELECT NULLIF(origin, '') AS origin, NULLIF(destination, '') AS destination, CAST(price AS DECIMAL(18,2)) AS price,
         NULLIF(airline, '') AS airline, NULLIF(flight_number, '') AS flight_number, departure_at, return_at, expires_at,
         transfers, CAST(is_direct AS INTEGER) AS is_direct, popularity_category, extracted_at, processed_at
  FROM d_norm),
c_store AS (
  SELECT ticket_id, NULLIF(origin, '') AS origin, NULLIF(destination, '') AS destination, departure_at, return_at,
         CAST(price AS DECIMAL(18,2)) AS price, NULLIF(airline, '') AS airline, NULLIF(flight_number, '') AS flight_number,
         transfers, CAST(is_direct AS INTEGER) AS is_direct, expires_at, trend_category, processed_at, route
  FROM c_norm),
quarantine AS (
  SELECT feed, origin, destination, month, poll, CAST(NULL AS VARCHAR) AS entry_key, {route_fault} AS reason
  FROM (SELECT DISTINCT o, d, origin, destination, strftime(day, '%Y-%m') AS month, poll FROM polled) r,
       (VALUES ('grouped_prices'), ('calendar')) f(feed)
  WHERE NOT ({route_ok})
  UNION ALL
  SELECT 'directions', origin, NULL, day, poll, NULL, {dir_fault}
  FROM (SELECT DISTINCT o, origin, strftime(day, '%Y-%m-%d') AS day, poll FROM polled) r
  WHERE o IN (5, 7, 9, 11, 13)
  UNION ALL
  SELECT 'grouped_prices', origin, destination, month, poll, departure_date, reject_reason
  FROM g_ext WHERE reject_reason IS NOT NULL
  UNION ALL
  SELECT 'calendar', origin, destination, month, poll, date, reject_reason
  FROM c_ext WHERE reject_reason IS NOT NULL
  UNION ALL
  SELECT 'directions', origin, destination, month, poll, destination, reject_reason
  FROM d_ext WHERE reject_reason IS NOT NULL)"""
