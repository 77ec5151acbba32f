"""Independent DuckDB SQL for every registered query (the correctness oracle).

The common prefix derives the same lines from the supplied tables and splits
them without look-ahead (DuckDB's regex engine has none): a comma is a
separator when an even number of quote-delimited segments follows it.
Column names and types match the Spark side (integers BIGINT; dates are
rendered as ``yyyy-MM-dd`` text on both sides, so the comparison does not depend
on how a client library represents DATE values).
"""

from __future__ import annotations

NUM = r"'[-+]?\d*\.?\d+'"

PREFIX = rf"""
WITH flights AS (
  SELECT p_brand AS carrier_raw, sn.n_name AS origin, cn.n_name AS dest,
         CAST(l_quantity AS INT) - 20 AS dep_i,
         CAST(l_quantity AS INT) - 23 + l_linenumber AS arr_i,
         CAST(l_shipdate AS DATE) AS flight_date,
         l_orderkey AS flight_num, l_linenumber AS ln, l_returnflag AS rf
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
),
lines5 AS (
  SELECT CASE WHEN ln = 6 AND rf = 'R' THEN concat_ws(',', carrier, origin, dest)
              ELSE concat_ws(',', carrier, origin, dest, dep, arr) END AS line
  FROM (
    SELECT CASE WHEN ln = 1 THEN concat('"', carrier_raw, ', Inc"') ELSE carrier_raw END AS carrier,
           origin, dest,
           CASE WHEN ln = 5 AND rf = 'A' THEN 'NA' ELSE concat(CAST(dep_i AS STRING), '.00') END AS dep,
           CASE WHEN ln = 7 THEN '' WHEN ln = 4 AND rf = 'N' THEN 'NA'
                ELSE concat(CAST(arr_i AS STRING), '.00') END AS arr, ln, rf
    FROM flights) g
),
lines7 AS (
  SELECT concat_ws(',', CASE WHEN ln = 2 AND rf = 'A' THEN '1999-02-31' ELSE CAST(flight_date AS STRING) END,
                   CAST(flight_num AS STRING), origin, dest,
                   CASE WHEN ln = 1 THEN concat('"', carrier_raw, ', Inc"') ELSE carrier_raw END,
                   concat(CAST(dep_i AS STRING), '.00'),
                   CASE WHEN ln = 7 THEN '' ELSE concat(CAST(arr_i AS STRING), '.00') END) AS line
  FROM flights
),
rec AS (
  SELECT line, list_transform(string_split(array_to_string(list_transform(seg, lambda e, i:
           CASE WHEN (len(seg) - i) % 2 = 0 THEN replace(e, ',', chr(31)) ELSE e END), '"'), chr(31)),
           lambda x: replace(replace(x, chr(30) || '1', chr(31)), chr(30) || '0', chr(30))) AS f
  FROM (SELECT line, string_split(regexp_replace(
          replace(replace(line, chr(30), chr(30) || '0'), chr(31), chr(30) || '1'), ',+$', ''), '"') AS seg FROM lines5) s
),
rec7 AS (
  SELECT line, list_transform(string_split(array_to_string(list_transform(seg, lambda e, i:
           CASE WHEN (len(seg) - i) % 2 = 0 THEN replace(e, ',', chr(31)) ELSE e END), '"'), chr(31)),
           lambda x: replace(replace(x, chr(30) || '1', chr(31)), chr(30) || '0', chr(30))) AS f
  FROM (SELECT line, string_split(regexp_replace(
          replace(replace(line, chr(30), chr(30) || '0'), chr(31), chr(30) || '1'), ',+$', ''), '"') AS seg FROM lines7) s
),
ontime AS (
  SELECT f[1] AS carrier, f[2] AS origin, f[3] AS dest,
         coalesce(regexp_full_match(f[4], {NUM}) AND try_cast(f[4] AS DOUBLE) < 15.0, false) AS dep_ok,
         coalesce(regexp_full_match(f[5], {NUM}) AND try_cast(f[5] AS DOUBLE) < 15.0, false) AS arr_ok
  FROM rec WHERE len(f) = 5
),
leg AS (
  SELECT CAST(try_strptime(f[1], '%Y-%m-%d') AS DATE) AS d, try_cast(f[2] AS BIGINT) AS flight,
         f[3] AS o, f[4] AS t, try_cast(f[7] AS DOUBLE) AS arr
  FROM rec7
  WHERE len(f) = 7 AND try_strptime(f[1], '%Y-%m-%d') IS NOT NULL AND f[3] <> '' AND f[4] <> ''
    AND regexp_full_match(f[2], '\d+') AND try_cast(f[2] AS BIGINT) IS NOT NULL
    AND regexp_full_match(f[7], {NUM})
),
jobs AS (
  SELECT line, f, job, CASE
      WHEN len(f) < 3 THEN 'short'
      WHEN job = 'airports' THEN 'ok'
      WHEN len(f) <> 5 THEN 'arity'
      WHEN job LIKE '%-by-airport' AND NOT coalesce(regexp_full_match(f[4], {NUM}), false) THEN 'bad_dep_delay'
      WHEN job IN ('carriers', 'carriers-by-route') AND NOT coalesce(regexp_full_match(f[5], {NUM}), false) THEN 'bad_arr_delay'
      WHEN job IN ('carriers-by-airport', 'carriers-by-route') AND f[1] = '' THEN 'blank_key'
      WHEN job = 'destinations-by-airport' AND f[3] = '' THEN 'blank_key'
      ELSE 'ok' END AS reason
  FROM rec, (SELECT unnest(['airports', 'carriers', 'carriers-by-airport', 'destinations-by-airport', 'carriers-by-route']) AS job) j
),
reason7 AS (
  SELECT line, f, CASE WHEN len(f) <> 7 THEN 'arity'
                       WHEN try_strptime(f[1], '%Y-%m-%d') IS NULL THEN 'bad_date'
                       WHEN NOT regexp_full_match(f[2], '\d+') OR try_cast(f[2] AS BIGINT) IS NULL THEN 'bad_flight'
                       WHEN f[3] = '' OR f[4] = '' THEN 'blank_airport'
                       WHEN NOT coalesce(regexp_full_match(f[7], {NUM}), false) THEN 'bad_arr_delay'
                       ELSE 'ok' END AS reason
  FROM rec7
),
o1 AS (
  SELECT id, count(*) AS popularity
  FROM (SELECT unnest([f[2], f[3]]) AS id FROM rec WHERE len(f) >= 3) u GROUP BY id
),
o2 AS (
  SELECT carrier AS id, count(*) AS popularity FROM ontime WHERE arr_ok GROUP BY carrier
),
o3 AS (
  SELECT airport, item, n, CAST(rank AS BIGINT) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY airport ORDER BY n DESC, item) AS rank FROM (
      SELECT origin AS airport, carrier AS item, count(*) AS n FROM ontime
      WHERE dep_ok AND carrier <> '' GROUP BY origin, carrier) a) b WHERE rank <= 10
),
o4 AS (
  SELECT airport, item, n, CAST(rank AS BIGINT) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY airport ORDER BY n DESC, item) AS rank FROM (
      SELECT origin AS airport, dest AS item, count(*) AS n FROM ontime
      WHERE dep_ok AND dest <> '' GROUP BY origin, dest) a) b WHERE rank <= 10
),
o5 AS (
  SELECT origin, dest, item, n, CAST(rank AS BIGINT) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY origin, dest ORDER BY n DESC, item) AS rank FROM (
      SELECT origin, dest, carrier AS item, count(*) AS n FROM ontime
      WHERE arr_ok AND carrier <> '' GROUP BY origin, dest, carrier) a) b WHERE rank <= 10
),
o6 AS (
  SELECT a.d AS flight_date, a.o AS x, a.t AS y, b.t AS z, count(*) AS n, min(a.arr + b.arr) AS best
  FROM leg a JOIN leg b ON a.t = b.o AND b.d = a.d + INTERVAL 2 DAY
  GROUP BY a.d, a.o, a.t, b.t
),
o7 AS (
  SELECT flight_date, x, y, z, flight1, flight2, delay1, delay2, total_delay FROM (
    SELECT a.d AS flight_date, a.o AS x, a.t AS y, b.t AS z, a.flight AS flight1, b.flight AS flight2,
           a.arr AS delay1, b.arr AS delay2, a.arr + b.arr AS total_delay,
           row_number() OVER (PARTITION BY a.d, a.o, a.t, b.t ORDER BY a.arr + b.arr, a.flight, b.flight) AS r
    FROM leg a JOIN leg b ON a.t = b.o AND b.d = a.d + INTERVAL 2 DAY) q WHERE r = 1
),
o8 AS (
  SELECT flight_date, x, y, z, CAST(r AS BIGINT) AS rank, flight1, flight2, delay1, delay2, total_delay FROM (
    SELECT a.d AS flight_date, a.o AS x, a.t AS y, b.t AS z, a.flight AS flight1, b.flight AS flight2,
           a.arr AS delay1, b.arr AS delay2, a.arr + b.arr AS total_delay,
           row_number() OVER (PARTITION BY a.d, a.o, a.t, b.t ORDER BY a.arr + b.arr, a.arr, a.flight, b.arr, b.flight) AS r
    FROM (SELECT DISTINCT * FROM leg) a JOIN (SELECT DISTINCT * FROM leg) b ON a.t = b.o AND b.d = a.d + INTERVAL 2 DAY) q
  WHERE r <= 10
)
"""

# The same prefix over lines with planted defects, one kind per remainder of the flight number.
DEFECT_LINES = r"""lines5 AS (
  SELECT CASE (flight_num * 7 + ln) % 23
      WHEN 0 THEN concat_ws(',', '', origin, dest, dep, arr)
      WHEN 1 THEN concat_ws(',', carrier_raw, '', dest, dep, arr)
      WHEN 2 THEN concat_ws(',', carrier_raw, origin, '', dep, 'NA')
      WHEN 3 THEN concat_ws(',', carrier_raw, origin)
      WHEN 4 THEN ''
      WHEN 5 THEN concat_ws(',', carrier_raw || '"', origin, dest, dep, arr)
      WHEN 6 THEN concat_ws(',', '"' || carrier_raw || chr(31) || chr(30) || '1' || ', Inc"', origin, dest, dep, arr)
      WHEN 7 THEN concat_ws(',', carrier_raw || chr(31) || chr(30) || '1', origin, dest, ' ' || dep, arr)
      WHEN 8 THEN concat_ws(',', carrier_raw, origin, dest, dep, '')
      WHEN 9 THEN concat_ws(',', carrier_raw, origin, dest, dep, arr, 'x')
      ELSE concat_ws(',', carrier, origin, dest, dep, arr) END AS line
  FROM (SELECT *, CASE WHEN ln = 1 THEN concat('"', carrier_raw, ', Inc"') ELSE carrier_raw END AS carrier,
               concat(CAST(dep_i AS STRING), '.00') AS dep, concat(CAST(arr_i AS STRING), '.00') AS arr FROM flights) g
),
lines7 AS (
  SELECT CASE (flight_num * 7 + ln) % 23
      WHEN 0 THEN concat_ws(',', d, n, '', dest, carrier_raw, dep, arr)
      WHEN 1 THEN concat_ws(',', d, n, origin, '', carrier_raw, dep, arr)
      WHEN 2 THEN concat_ws(',', d, 'AA' || n, origin, dest, carrier_raw, dep, arr)
      WHEN 3 THEN concat_ws(',', d, n, origin, dest, carrier_raw, dep, 'NA')
      WHEN 4 THEN concat_ws(',', '1999-02-31', n, origin, dest, carrier_raw, dep, arr)
      WHEN 5 THEN concat_ws(',', d, n, origin, dest, carrier_raw, dep)
      WHEN 6 THEN concat_ws(',', d, n, origin, dest, '"' || carrier_raw || chr(31) || ', "', dep, arr)
      WHEN 7 THEN concat_ws(',', d, n, origin, dest, '', dep, '')
      ELSE concat_ws(',', d, n, origin, dest, carrier, dep, arr) END AS line
  FROM (SELECT *, CAST(flight_date AS STRING) AS d, CAST(flight_num AS STRING) AS n,
               CASE WHEN ln = 1 THEN concat('"', carrier_raw, ', Inc"') ELSE carrier_raw END AS carrier,
               concat(CAST(dep_i AS STRING), '.00') AS dep, concat(CAST(arr_i AS STRING), '.00') AS arr FROM flights) g
),
"""
DEFECT_PREFIX = PREFIX[:PREFIX.index("lines5 AS (")] + DEFECT_LINES + PREFIX[PREFIX.index("rec AS ("):]

BODIES = {
    "split_fields": "SELECT CAST(len(f) AS BIGINT) AS n_fields, f[1] AS f0, f[2] AS f1, f[3] AS f2, "
                    "count(*) AS n FROM rec GROUP BY 1, 2, 3, 4",
    "arity_histogram": "SELECT CAST(len(f) AS BIGINT) AS n_fields, count(*) AS n FROM rec GROUP BY 1",
    "numeric_delays": f"""
        SELECT which, is_numeric, count(*) AS n FROM (
          SELECT 'dep' AS which, coalesce(regexp_full_match(f[4], {NUM}), false) AS is_numeric
          FROM rec WHERE len(f) = 5
          UNION ALL
          SELECT 'arr' AS which, coalesce(regexp_full_match(f[5], {NUM}), false) AS is_numeric
          FROM rec WHERE len(f) = 5) u
        GROUP BY 1, 2""",
    "on_time_flags": "SELECT dep_ok AS dep_on_time, arr_ok AS arr_on_time, count(*) AS n FROM ontime GROUP BY 1, 2",
    "airport_popularity": "SELECT id, popularity FROM o1",
    "airports_ranked": "SELECT CAST(row_number() OVER (ORDER BY popularity DESC, id) AS BIGINT) AS rank, "
                       "id, popularity FROM o1",
    "top10_airports": "SELECT id, popularity FROM o1 ORDER BY popularity DESC, id LIMIT 10",
    "bottom10_airports": "SELECT id, popularity FROM o1 ORDER BY popularity ASC, id LIMIT 10",
    "carrier_on_time_arrivals": "SELECT id, popularity FROM o2",
    "carriers_ranked": "SELECT CAST(row_number() OVER (ORDER BY popularity DESC, id) AS BIGINT) AS rank, "
                       "id, popularity FROM o2",
    "top10_carriers": "SELECT id, popularity FROM o2 ORDER BY popularity DESC, id LIMIT 10",
    "pair_counts": "SELECT origin, carrier, count(*) AS n FROM ontime WHERE dep_ok AND carrier <> '' "
                   "GROUP BY origin, carrier",
    "top10_carriers_by_airport": "SELECT airport, item, n, rank FROM o3",
    "top10_destinations_by_airport": "SELECT airport, item, n, rank FROM o4",
    "top10_carriers_by_route": "SELECT origin, dest, item, n, rank FROM o5",
    "packed_top10_carriers_by_airport":
        "SELECT airport, string_agg(item || ',' || CAST(n AS VARCHAR), '|' ORDER BY rank DESC) AS items "
        "FROM o3 GROUP BY airport",
    "packed_top10_destinations_by_airport":
        "SELECT airport, string_agg(item || ',' || CAST(n AS VARCHAR), '|' ORDER BY rank DESC) AS items "
        "FROM o4 GROUP BY airport",
    "packed_top10_carriers_by_route":
        "SELECT origin, dest, string_agg(item || ',' || CAST(n AS VARCHAR), '|' ORDER BY rank DESC) AS items "
        "FROM o5 GROUP BY origin, dest",
    "date_parse": "SELECT f[1] AS d_raw, strftime(CAST(try_strptime(f[1], '%Y-%m-%d') AS DATE), '%Y-%m-%d') AS d, "
                  "count(*) AS n FROM rec7 WHERE len(f) = 7 GROUP BY 1, 2",
    "date_shift": """
        SELECT strftime(d, '%Y-%m-%d') AS d, strftime(shifted, '%Y-%m-%d') AS shifted,
               strftime(shifted, '%Y-%m-%d') AS formatted, count(*) AS n FROM (
          SELECT CAST(try_strptime(f[1], '%Y-%m-%d') AS DATE) AS d,
                 CAST(CAST(try_strptime(f[1], '%Y-%m-%d') AS DATE) - INTERVAL 2 DAY AS DATE) AS shifted
          FROM rec7 WHERE len(f) = 7 AND try_strptime(f[1], '%Y-%m-%d') IS NOT NULL) s
        GROUP BY 1, 2, 3""",
    "leg_union": """
        SELECT strftime(d, '%Y-%m-%d') AS d, via, leg, count(*) AS n FROM (
          SELECT d, t AS via, CAST(1 AS BIGINT) AS leg FROM leg
          UNION ALL
          SELECT CAST(d - INTERVAL 2 DAY AS DATE) AS d, o AS via, CAST(2 AS BIGINT) AS leg FROM leg) u
        GROUP BY 1, 2, 3""",
    "itinerary_legs": "SELECT strftime(flight_date, '%Y-%m-%d') AS flight_date, x, y, z, n, best FROM o6",
    "itinerary_best": "SELECT strftime(flight_date, '%Y-%m-%d') AS flight_date, x, y, z, flight1, flight2, "
                      "delay1, delay2, total_delay FROM o7",
    "itinerary_top10": "SELECT strftime(flight_date, '%Y-%m-%d') AS flight_date, x, y, z, rank, flight1, flight2, "
                       "delay1, delay2, total_delay FROM o8",
    "itinerary_top10_layout": "SELECT concat_ws(',', strftime(flight_date, '%Y-%m-%d'), x, y, z) AS Id, "
                              "string_agg(concat(flight1, ',', delay1, '|', flight2, ',', delay2), '|' ORDER BY rank) "
                              "AS CarriersList FROM o8 GROUP BY 1",
    "itinerary_layout": "SELECT concat_ws(',', strftime(flight_date, '%Y-%m-%d'), x, y, z) AS Id, "
                        "concat(flight1, ',', delay1, '|', flight2, ',', delay2) AS CarriersList FROM o7",
}

# Lines with planted defects instead of the plain ones.
DEFECTS = {
    "defect_split_fields": "split_fields",
    "defect_airport_popularity": "airport_popularity",
    "defect_carrier_on_time_arrivals": "carrier_on_time_arrivals",
    "defect_top10_carriers_by_airport": "top10_carriers_by_airport",
    "defect_itinerary_best": "itinerary_best",
    "defect_itinerary_top10": "itinerary_top10",
}
DEFECT_BODIES = {
    "reject_summary": "SELECT job, reason, count(*) AS n FROM jobs GROUP BY job, reason",
    "leg_reject_summary": "SELECT reason, count(*) AS n FROM reason7 GROUP BY reason",
    "rejected_lines": "SELECT job, line, CAST(len(f) AS BIGINT) AS n_fields, reason FROM jobs WHERE reason <> 'ok'",
    "rejected_legs": "SELECT line, CAST(len(f) AS BIGINT) AS n_fields, reason FROM reason7 WHERE reason <> 'ok'",
    "stream_line_accounts": "SELECT reason, count(*) AS n FROM jobs WHERE job = 'carriers-by-route' GROUP BY reason",
    "stream_rejects": "SELECT line, CAST(len(f) AS BIGINT) AS n_fields, reason FROM jobs "
                      "WHERE reason <> 'ok' AND job = 'carriers-by-route'",
    "stream_leg_rejects": "SELECT line, CAST(len(f) AS BIGINT) AS n_fields, reason FROM reason7 WHERE reason <> 'ok'",
}

# Streaming replays and sinks must end equal to the batch answer.
SAME_AS = {
    "stream_airport_popularity": "airport_popularity",
    "stream_airports_ranked": "airports_ranked",
    "stream_top10_airports": "top10_airports",
    "stream_carrier_on_time": "carrier_on_time_arrivals",
    "stream_top10_carriers": "top10_carriers",
    "stream_top10_carriers_by_airport": "top10_carriers_by_airport",
    "stream_top10_destinations_by_airport": "top10_destinations_by_airport",
    "stream_top10_carriers_by_route": "top10_carriers_by_route",
    "stream_top10_carriers_by_route_update": "top10_carriers_by_route",
    "stream_airports_ranked_update": "airports_ranked",
    "stream_top10_carriers_by_airport_update": "top10_carriers_by_airport",
    "stream_top10_destinations_by_airport_update": "top10_destinations_by_airport",
    "stream_state_counts": "carrier_on_time_arrivals",
    "stream_carriers_compacted": "carrier_on_time_arrivals",
    "stream_itinerary": "itinerary_best",
    "stream_itinerary_update": "itinerary_best",
    "sink_upsert_counts": "airport_popularity",
    "sink_upsert_lists": "packed_top10_carriers_by_airport",
}


def oracle_sql() -> dict[str, str]:
    out = {name: PREFIX + body for name, body in BODIES.items()}
    for name, same in SAME_AS.items():
        out[name] = out[same]
    for name, body in (DEFECT_BODIES | {name: BODIES[same] for name, same in DEFECTS.items()}).items():
        out[name] = DEFECT_PREFIX + body
    return out
