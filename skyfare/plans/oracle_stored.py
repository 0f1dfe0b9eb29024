"""Oracle SQL for the stored warehouse: both loads' tickets at once, each layer as a
full rebuild would give it (ids continue from the first load's)."""

from __future__ import annotations

from ..config import DEFAULT, RunConfig


def stored_ctes(cfg: RunConfig = DEFAULT) -> str:
    one, two = f"TIMESTAMP '{cfg.first_load_ts}'", f"TIMESTAMP '{cfg.second_load_ts}'"
    late = "CAST(substr(flight_number, 3) AS BIGINT) % 3 = 0"
    return f"""
s_seen AS (SELECT origin, destination, MIN(CASE WHEN {late} THEN 2 ELSE 1 END) AS load FROM ods
  WHERE origin IS NOT NULL AND destination IS NOT NULL GROUP BY origin, destination),
s_codes_route AS (SELECT p.origin, p.destination, o.airport_id AS oid, d.airport_id AS did,
  CAST(row_number() OVER (ORDER BY p.load, p.origin, p.destination) AS INTEGER) AS route_id
  FROM s_seen p JOIN airport o ON p.origin = o.airport_code JOIN airport d ON p.destination = d.airport_code),
s_route AS (SELECT route_id, oid AS origin_airport_id, did AS destination_airport_id,
  CAST(NULL AS INTEGER) AS distance_km, CAST(NULL AS VARCHAR) AS popularity_category FROM s_codes_route),
s_airlines AS (SELECT airline AS bk, MIN(CASE WHEN {late} THEN 2 ELSE 1 END) AS load FROM ods
  WHERE airline IS NOT NULL GROUP BY airline),
s_first AS (SELECT CAST(row_number() OVER (ORDER BY bk) AS BIGINT) AS sk, bk, COALESCE(l.name, bk) AS name,
  COALESCE(l.country, 'Unknown') AS country FROM s_airlines LEFT JOIN lk_prev l ON bk = l.code WHERE load = 1),
s_now AS (SELECT a.bk, COALESCE(l.name, a.bk) AS name, COALESCE(l.country, 'Unknown') AS country, f.sk AS old,
  f.sk IS NOT NULL AND f.name = COALESCE(l.name, a.bk) AND f.country = COALESCE(l.country, 'Unknown') AS same
  FROM s_airlines a LEFT JOIN lk_cur l ON a.bk = l.code LEFT JOIN s_first f ON f.bk = a.bk),
s_dim AS (
  SELECT f.sk AS airline_sk, f.bk AS airline_bk, f.name AS airline_name, f.country, {one} AS valid_from,
         CASE WHEN n.same THEN CAST(NULL AS TIMESTAMP) ELSE {two} END AS valid_to,
         CASE WHEN n.same THEN 1 ELSE 0 END AS is_current
  FROM s_first f JOIN s_now n ON n.old = f.sk
  UNION ALL
  SELECT CAST((SELECT COUNT(*) FROM s_first) + row_number() OVER (ORDER BY bk) AS BIGINT), bk, name, country, {two},
         CAST(NULL AS TIMESTAMP), 1 FROM s_now WHERE NOT same),
s_staged AS (
  SELECT t.ticket_id AS flight_id, t.airline, t.price, CAST(t.duration AS INTEGER) AS duration,
         CASE WHEN t.transfers = 0 THEN 1 WHEN t.transfers = 1 THEN 2 ELSE 3 END AS flight_type_id,
         t.dep AS departure_ts, COALESCE(t.ext, CASE WHEN {late} THEN {two} ELSE {one} END) AS extracted_at,
         CAST(strftime(t.dep, '%Y%m%d') AS INTEGER) AS date_id, rc.route_id, a.airline_sk,
         CASE WHEN t.dep IS NULL THEN 'bad_departure_date' WHEN rc.route_id IS NULL THEN 'unknown_route'
              WHEN a.airline_sk IS NULL THEN 'unknown_airline' WHEN t.duration IS NULL THEN 'null_duration'
              WHEN c.date_id IS NULL THEN 'date_outside_calendar'
              WHEN t.ticket_id IS NULL THEN 'null_flight_id' END AS reject_reason
  FROM complete t LEFT JOIN s_codes_route rc ON t.origin = rc.origin AND t.destination = rc.destination
  LEFT JOIN (SELECT * FROM s_dim WHERE is_current = 1) a ON t.airline = a.airline_bk
  LEFT JOIN cal c ON c.date_id = CAST(strftime(t.dep, '%Y%m%d') AS INTEGER)),
s_fact AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY extracted_at, departure_ts,
  price, duration, route_id, airline, flight_type_id, date_id) AS rn FROM s_staged WHERE reject_reason IS NULL) x WHERE rn = 1),
s_as_of AS (
  SELECT f.flight_id, f.route_id,
         (SELECT arg_max(v.airline_sk, CASE WHEN v.valid_from <= f.extracted_at THEN epoch(v.valid_from)
                                            ELSE -epoch(v.valid_from) - 1e12 END)
          FROM s_dim v WHERE v.airline_bk = f.airline) AS airline_sk,
         f.date_id, f.flight_type_id, f.price, f.duration, f.extracted_at
  FROM s_fact f)"""
