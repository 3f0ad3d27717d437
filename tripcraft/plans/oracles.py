"""DuckDB SQL for every registered query, written independently of the Spark
code from the same view definitions (see ``sources/supplied.py``).

Conventions shared with the Spark side: KPI sums rounded to cents, the mean
rebuilt as ``round(avg * count, 2) / nullif(count, 0)``; every computed
column aliased to the Spark name.
"""

from __future__ import annotations

_EV = """ev AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         event_id % 10 AS d
  FROM events)"""

_PS = """ps AS (
  SELECT CAST(event_id // 2 AS VARCHAR) AS trip_id,
         CAST(user_id AS BIGINT) AS pickup_location_id,
         k AS dropoff_location_id,
         CAST(1 + user_id % 2 AS BIGINT) AS vendor_id,
         ts AS pickup_datetime,
         ts + INTERVAL 15 MINUTE AS estimated_dropoff_datetime,
         value / 3.0 AS estimated_fare_amount
  FROM ev WHERE event_id % 2 = 0)"""

_PE = """pe AS (
  SELECT CASE WHEN event_type <> 'error' THEN ts END AS dropoff_datetime,
         CASE WHEN k % 6 <> 5 THEN CAST(1 + k % 6 AS VARCHAR) END AS rate_code,
         CAST(k % 7 AS DOUBLE) AS passenger_count,
         value / 10.0 AS trip_distance,
         CASE WHEN event_type <> 'error' OR k % 2 = 1 THEN value END AS fare_amount,
         CAST(k % 4 AS DOUBLE) AS tip_amount,
         event_type AS payment_type,
         CAST(1 + user_id % 2 AS VARCHAR) AS trip_type,
         CAST(event_id // 2 AS VARCHAR) AS trip_id
  FROM ev WHERE event_id % 2 = 1)"""

_NS = """ns AS (
  SELECT trip_id, pickup_location_id, dropoff_location_id, vendor_id,
         CAST(pickup_datetime AS DATE) AS pickup_datetime,
         estimated_dropoff_datetime,
         round(estimated_fare_amount, 2) AS estimated_fare_amount,
         strftime(pickup_datetime, '%H:%M:%S') AS pickup_time
  FROM ps)"""

_NE = """ne AS (
  SELECT CAST(dropoff_datetime AS DATE) AS dropoff_datetime, rate_code,
         passenger_count, trip_distance, round(fare_amount, 2) AS fare_amount,
         tip_amount, payment_type, trip_type, trip_id,
         strftime(dropoff_datetime, '%H:%M:%S') AS dropoff_time
  FROM pe)"""

_J = """j AS (SELECT * FROM ns JOIN ne USING (trip_id))"""

_PAIRED = ",\n".join([_EV, _PS, _PE, _NS, _NE, _J])


def _kpis(fare: str = "fare_amount") -> str:
    return f"""round(sum({fare}), 2) AS total_fare,
       count({fare}) AS count_trips,
       round(avg({fare}) * count({fare}), 2) / nullif(count({fare}), 0) AS average_fare,
       max({fare}) AS max_fare,
       min({fare}) AS min_fare"""


# Interleaved events after V2 (invalid end values null) and V3.
_IEV = """iev0 AS (
  SELECT event_id AS seq,
         CASE WHEN st THEN 'start' ELSE 'end' END AS kind,
         CAST(event_id // 4 AS VARCHAR) AS trip_id,
         CASE WHEN st THEN CAST(user_id AS BIGINT) END AS pickup_location_id,
         CASE WHEN st THEN k END AS dropoff_location_id,
         CASE WHEN st THEN CAST(1 + user_id % 2 AS BIGINT) END AS vendor_id,
         CASE WHEN st THEN CAST(ts AS DATE) END AS pickup_datetime,
         CASE WHEN st THEN strftime(ts, '%H:%M:%S') END AS pickup_time,
         CASE WHEN st THEN ts + INTERVAL 15 MINUTE END AS estimated_dropoff_datetime,
         CASE WHEN st THEN strftime(ts + INTERVAL 15 MINUTE, '%H:%M:%S') END AS estimated_dropoff_time,
         CASE WHEN st THEN round(value / 3.0, 2) END AS estimated_fare_amount,
         CASE WHEN NOT st AND event_type <> 'error' THEN ts END AS dropoff_datetime,
         CASE WHEN NOT st AND k % 6 <> 5 THEN CAST(1 + k % 6 AS VARCHAR) END AS rate_code,
         CASE WHEN NOT st AND k % 7 <> 0 THEN CAST(k % 7 AS DOUBLE) END AS passenger_count,
         CASE WHEN NOT st AND value / 10.0 <> 0 THEN value / 10.0 END AS trip_distance,
         CASE WHEN NOT st AND (event_type <> 'error' OR k % 2 = 1) AND value <> 0 THEN value END AS fare_amount,
         CASE WHEN NOT st AND k % 4 <> 0 THEN CAST(k % 4 AS DOUBLE) END AS tip_amount,
         CASE WHEN NOT st AND trim(event_type) <> '' THEN event_type END AS payment_type,
         CASE WHEN NOT st THEN CAST(1 + user_id % 2 AS VARCHAR) END AS trip_type
  FROM (SELECT *, event_type IN ('signup', 'view') AS st FROM ev)),
iev AS (
  SELECT * FROM iev0
  WHERE kind = 'start' OR dropoff_datetime IS NOT NULL OR rate_code IS NOT NULL
     OR passenger_count IS NOT NULL OR trip_distance IS NOT NULL
     OR fare_amount IS NOT NULL OR tip_amount IS NOT NULL
     OR payment_type IS NOT NULL OR trip_type IS NOT NULL)"""

_START_FIELDS = [
    "pickup_location_id", "dropoff_location_id", "vendor_id", "pickup_datetime",
    "pickup_time", "estimated_dropoff_datetime", "estimated_dropoff_time",
    "estimated_fare_amount",
]
_END_FIELDS = [
    "dropoff_datetime", "rate_code", "passenger_count", "trip_distance",
    "fare_amount", "tip_amount", "payment_type", "trip_type",
]


def _state_cte(with_starts: bool = True, with_ends: bool = True, where: str = "") -> str:
    parts = ["trip_id"]
    if with_starts:
        parts.append("max(seq) FILTER (WHERE kind = 'start') AS s_seq")
        parts += [
            f"arg_max_null({f}, seq) FILTER (WHERE kind = 'start') AS {f}" for f in _START_FIELDS
        ]
    if with_ends:
        for f in _END_FIELDS:
            cond = f"kind = 'end' AND {f} IS NOT NULL"
            parts.append(f"max(seq) FILTER (WHERE {cond}) AS {f}_seq")
            parts.append(f"arg_max({f}, seq) FILTER (WHERE {cond}) AS {f}_v")
    body = ",\n         ".join(parts)
    return f"st AS (\n  SELECT {body}\n  FROM iev {where} GROUP BY trip_id)"


def _trips_sql(mode: str) -> str:
    cols = ["trip_id", *_START_FIELDS]
    for f in _END_FIELDS:
        if mode == "replay":
            cols.append(f"CASE WHEN s_seq IS NULL OR {f}_seq > s_seq THEN {f}_v END AS {f}")
        else:
            cols.append(f"{f}_v AS {f}")
    return f"WITH {_EV},\n{_IEV},\n{_state_cte()}\nSELECT {', '.join(cols)} FROM st"


_TRIPS_REPLAY = _trips_sql("replay")

# --- raw-line view: what survives each stage, straight from events ----------------------

_START_TEXT = """CAST(event_id // 2 AS VARCHAR) AS trip_id,
       CAST(user_id AS BIGINT) AS pickup_location_id,
       k AS dropoff_location_id,
       CAST(1 + user_id % 2 AS BIGINT) AS vendor_id,
       CASE d WHEN 4 THEN strftime(ts, '%Y-%m-%d')
              WHEN 6 THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS pickup_datetime,
       CASE WHEN d = 8 AND k % 5 = 0 THEN strftime(ts + INTERVAL 15 MINUTE, '%d/%m/%Y')
            ELSE strftime(ts + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') END AS estimated_dropoff_datetime,
       value / 3.0 AS estimated_fare_amount"""

_PARSE_START = f"""WITH {_EV}
SELECT {_START_TEXT}
FROM ev WHERE event_id % 2 = 0 AND d IN (4, 6, 8)"""

_START_EVENTS = f"""WITH {_EV}
SELECT CASE d WHEN 4 THEN strftime(ts, '%Y-%m-%d')
              WHEN 6 THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS key,
       {_START_TEXT}
FROM ev WHERE event_id % 2 = 0 AND d IN (4, 6, 8)"""

_PARSE_END = f"""WITH {_EV}
SELECT CASE WHEN d = 5 OR event_type = 'error' THEN ''
            WHEN d = 9 AND k % 5 = 0 THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS dropoff_datetime,
       CASE WHEN d = 5 OR k % 6 = 5 THEN '' ELSE CAST(1 + k % 6 AS VARCHAR) END AS rate_code,
       CASE WHEN d = 5 THEN '' ELSE CAST(CAST(k % 7 AS DOUBLE) AS VARCHAR) END AS passenger_count,
       CASE WHEN d = 5 THEN '' ELSE CAST(value / 10.0 AS VARCHAR) END AS trip_distance,
       CASE WHEN d = 5 THEN '' WHEN d = 7 THEN '0' WHEN event_type = 'error' AND k % 2 = 0 THEN ''
            ELSE CAST(value AS VARCHAR) END AS fare_amount,
       CASE WHEN d = 5 THEN '' ELSE CAST(CAST(k % 4 AS DOUBLE) AS VARCHAR) END AS tip_amount,
       CASE WHEN d = 5 THEN '' ELSE event_type END AS payment_type,
       CASE WHEN d = 5 THEN '' ELSE CAST(1 + user_id % 2 AS VARCHAR) END AS trip_type,
       CASE WHEN d = 3 THEN '' ELSE CAST(event_id // 2 AS VARCHAR) END AS trip_id
FROM ev WHERE event_id % 2 = 1 AND d IN (3, 5, 7, 9)"""

_NORMALIZE_START_EVENTS = f"""WITH {_EV}
SELECT CAST(event_id // 2 AS VARCHAR) AS trip_id,
       CAST(user_id AS BIGINT) AS pickup_location_id,
       k AS dropoff_location_id,
       CAST(1 + user_id % 2 AS BIGINT) AS vendor_id,
       CASE WHEN d IN (4, 8) THEN CAST(ts AS DATE) END AS pickup_datetime,
       CASE WHEN d = 8 THEN strftime(ts, '%H:%M:%S') END AS pickup_time,
       CASE WHEN NOT (d = 8 AND k % 5 = 0) THEN date_trunc('second', ts + INTERVAL 15 MINUTE) END
         AS estimated_dropoff_datetime,
       CASE WHEN d <> 6 AND NOT (d = 8 AND k % 5 = 0) THEN strftime(ts + INTERVAL 15 MINUTE, '%H:%M:%S') END
         AS estimated_dropoff_time,
       round(value / 3.0, 2) AS estimated_fare_amount
FROM ev WHERE event_id % 2 = 0 AND d IN (4, 6, 8)"""


def _end_fields_sql(strict: bool) -> str:
    def num(expr: str) -> str:
        return "CAST(NULL AS DOUBLE)" if strict else expr

    return f"""WITH {_EV}
SELECT CAST(event_id // 2 AS VARCHAR) AS trip_id,
       CASE WHEN event_type <> 'error' AND NOT (d = 9 AND k % 5 = 0) THEN date_trunc('second', ts) END
         AS dropoff_datetime,
       CASE WHEN k % 6 <> 5 THEN CAST(1 + k % 6 AS VARCHAR) END AS rate_code,
       {num("CASE WHEN k % 7 <> 0 THEN CAST(k % 7 AS DOUBLE) END")} AS passenger_count,
       {num("CASE WHEN value <> 0 THEN value / 10.0 END")} AS trip_distance,
       {num("CASE WHEN d = 9 AND (event_type <> 'error' OR k % 2 = 1) AND value <> 0 THEN value END")} AS fare_amount,
       {num("CASE WHEN k % 4 <> 0 THEN CAST(k % 4 AS DOUBLE) END")} AS tip_amount,
       event_type AS payment_type,
       CAST(1 + user_id % 2 AS VARCHAR) AS trip_type
FROM ev WHERE event_id % 2 = 1 AND d IN (7, 9)"""


_LINE_REJECTS = f"""WITH {_EV},
r AS (
  SELECT CASE d WHEN 0 THEN 'parse_start' WHEN 2 THEN 'parse_start'
                WHEN 6 THEN 'normalize_start' WHEN 1 THEN 'parse_end'
                WHEN 3 THEN 'require_key_end' WHEN 5 THEN 'require_any_end'
                WHEN 8 THEN CASE WHEN k % 5 = 0 THEN 'normalize_start' END
                WHEN 9 THEN CASE WHEN k % 5 = 0 AND event_type <> 'error' THEN 'require_any_end' END END AS stage,
         CASE d WHEN 0 THEN 'field_count' WHEN 2 THEN 'bad_number'
                WHEN 6 THEN 'malformed_pickup_datetime' WHEN 1 THEN 'field_count'
                WHEN 3 THEN 'missing_trip_id' WHEN 5 THEN 'no_valid_field'
                WHEN 8 THEN 'malformed_estimated_dropoff_datetime'
                WHEN 9 THEN 'malformed_dropoff_datetime' END AS reason
  FROM ev)
SELECT stage, reason, count(*) AS n FROM r WHERE stage IS NOT NULL GROUP BY stage, reason"""

_RUN_REPORT = f"""WITH {_EV},
s AS (SELECT d FROM ev WHERE event_id % 2 = 0),
e AS (SELECT d FROM ev WHERE event_id % 2 = 1)
SELECT 'parse_start' AS stage, 'processed' AS outcome, 'accepted' AS reason, count(*) AS n
  FROM s WHERE d IN (4, 6, 8)
UNION ALL SELECT 'parse_start', 'failed', 'field_count', count(*) FROM s WHERE d = 0
UNION ALL SELECT 'parse_start', 'failed', 'bad_number', count(*) FROM s WHERE d = 2
UNION ALL SELECT 'decode_start', 'processed', 'accepted', count(*) FROM s WHERE d IN (4, 6, 8)
UNION ALL SELECT 'require_key_start', 'processed', 'accepted', count(*) FROM s WHERE d IN (4, 6, 8)
UNION ALL SELECT 'normalize_start', 'processed', 'accepted', count(*) FROM s WHERE d IN (4, 6, 8)
UNION ALL SELECT 'parse_end', 'processed', 'accepted', count(*) FROM e WHERE d IN (3, 5, 7, 9)
UNION ALL SELECT 'parse_end', 'failed', 'field_count', count(*) FROM e WHERE d = 1
UNION ALL SELECT 'decode_end', 'processed', 'accepted', count(*) FROM e WHERE d IN (3, 5, 7, 9)
UNION ALL SELECT 'require_key_end', 'processed', 'accepted', count(*) FROM e WHERE d IN (5, 7, 9)
UNION ALL SELECT 'require_key_end', 'failed', 'missing_trip_id', count(*) FROM e WHERE d = 3
UNION ALL SELECT 'require_any_end', 'processed', 'accepted', count(*) FROM e WHERE d IN (7, 9)
UNION ALL SELECT 'require_any_end', 'failed', 'no_valid_field', count(*) FROM e WHERE d = 5"""

# --- received records: bodies built by concatenation, outcomes by the kind of damage ------------

_RECEIVED = f"""{_EV},
rv0 AS (
  SELECT *, event_id % 11 AS w, event_type IN ('signup', 'view') AS st,
         CAST(event_id // 4 AS VARCHAR) AS trip,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS picked, strftime(ts, '%Y/%m/%d %H:%M:%S') AS slashed,
         strftime(ts + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS est,
         CAST(round(value / 3.0, 2) AS VARCHAR) AS fare3,
         CASE WHEN event_type <> 'error' THEN true ELSE false END AS ok
  FROM ev),
rv1 AS (
  SELECT *, CAST(CAST(k % 7 AS DOUBLE) AS VARCHAR) AS pc, CAST(value / 10.0 AS VARCHAR) AS td,
         CASE WHEN w = 5 THEN '0' WHEN ok OR k % 2 = 1 THEN CAST(value AS VARCHAR) END AS fa,
         CAST(CAST(k % 4 AS DOUBLE) AS VARCHAR) AS ta,
         CASE WHEN w = 7 THEN ',"surge":[1,2]' ELSE '' END AS surge
  FROM rv0),
rv AS (
  SELECT *, CASE WHEN st THEN
    '{{"trip_id":"' || CASE WHEN w = 2 THEN '' ELSE trip END || '","pickup_location_id":'
    || CASE WHEN w = 3 THEN '1.5' ELSE '"' || CAST(user_id AS VARCHAR) || '"' END
    || ',"dropoff_location_id":"' || CAST(k AS VARCHAR) || '","vendor_id":"'
    || CASE WHEN w = 3 THEN 'abc' ELSE CAST(1 + user_id % 2 AS VARCHAR) END || '","pickup_datetime":"'
    || CASE WHEN w IN (4, 5) THEN slashed ELSE picked END || '","estimated_dropoff_datetime":"'
    || CASE WHEN w = 5 THEN 'soon' ELSE est END || '","estimated_fare_amount":'
    || CASE WHEN w = 6 THEN fare3 WHEN w = 4 THEN '"n/a"' ELSE '"' || fare3 || '"' END || surge || '}}'
  ELSE
    '{{' || CASE WHEN w = 2 THEN '' ELSE '"trip_id":"' || trip || '",' END || '"dropoff_datetime":"'
    || CASE WHEN w = 3 THEN '' WHEN w = 4 THEN slashed WHEN ok THEN picked ELSE '' END || '","rate_code":"'
    || CASE WHEN w = 3 OR k % 6 = 5 THEN '' ELSE CAST(1 + k % 6 AS VARCHAR) END || '"'
    || CASE WHEN w = 6 THEN ',"passenger_count":' || pc || ',"trip_distance":' || td
         || coalesce(',"fare_amount":' || fa, '') || ',"tip_amount":' || ta
       WHEN w = 3 THEN ',"passenger_count":" ","trip_distance":" ","fare_amount":" ","tip_amount":" "'
       ELSE ',"passenger_count":"' || pc || '","trip_distance":"' || td || '","fare_amount":"' || coalesce(fa, '')
         || '","tip_amount":"' || ta || '"' END
    || ',"payment_type":"' || CASE WHEN w = 3 THEN '' ELSE event_type END || '","trip_type":"'
    || CASE WHEN w = 3 THEN '' ELSE CAST(1 + user_id % 2 AS VARCHAR) END || '"' || surge || '}}'
  END AS body
  FROM rv1)"""

_QUARANTINE = f"""WITH {_RECEIVED},
o AS (
  SELECT *, CASE
    WHEN w IN (0, 1) THEN [CASE WHEN st THEN 'decode_start' ELSE 'decode_end' END || ':undecodable']
    WHEN w = 2 THEN [CASE WHEN st THEN 'require_key_start' ELSE 'require_key_end' END || ':missing_trip_id']
    WHEN st AND w = 3 THEN ['decode_start:bad_pickup_location_id', 'decode_start:bad_vendor_id']
    WHEN st AND w = 4 THEN ['normalize_start:bad_estimated_fare_amount', 'normalize_start:malformed_pickup_datetime']
    WHEN st AND w = 5 THEN ['normalize_start:malformed_pickup_datetime',
                            'normalize_start:malformed_estimated_dropoff_datetime']
    WHEN NOT st AND w = 3 THEN ['require_any_end:no_valid_field']
    WHEN NOT st AND w = 4 THEN ['require_any_end:malformed_dropoff_datetime'] END AS found
  FROM rv),
u AS (SELECT *, unnest(found) AS f FROM o WHERE found IS NOT NULL)
SELECT split_part(f, ':', 1) AS stage, split_part(f, ':', 2) AS reason,
       CASE WHEN w IN (0, 1) THEN NULL WHEN w = 2 THEN CASE WHEN st THEN '' END ELSE trip END AS trip_id,
       CASE WHEN w = 0 THEN '%' || CAST(event_id AS VARCHAR) WHEN w = 1 THEN substr(body, 1, 9) ELSE body END AS record
FROM u"""


def _consumer_report_sql() -> str:
    def stages(which: str, names: list[tuple[str, str, str]]) -> list[str]:
        out, gone = [], []
        for name, reason, when in names:
            out.append(f"SELECT '{name}' AS stage, 'failed' AS outcome, '{reason}' AS reason, count(*) AS n "
                       f"FROM rv WHERE {which} AND w IN ({when})")
            gone.append(when)
            out.append(f"SELECT '{name}', 'processed', 'accepted', count(*) "
                       f"FROM rv WHERE {which} AND w NOT IN ({', '.join(gone)})")
        return out

    parts = stages("st", [("decode_start", "undecodable", "0, 1"),
                                   ("require_key_start", "missing_trip_id", "2"),
                                   ("normalize_start", "bad_estimated_fare_amount", "4")])
    parts += stages("NOT st", [("decode_end", "undecodable", "0, 1"),
                                      ("require_key_end", "missing_trip_id", "2"),
                                      ("require_any_end", "no_valid_field", "3")])
    return f"WITH {_RECEIVED}\n" + "\nUNION ALL ".join(parts)


def _events_to_trips_sql() -> str:
    """Accepted received records in the layout of the interleaved events, then the keyed merge."""
    iev = f"""iev AS (
  SELECT event_id AS seq, CASE WHEN st THEN 'start' ELSE 'end' END AS kind, trip AS trip_id,
         CASE WHEN st AND w <> 3 THEN CAST(user_id AS BIGINT) END AS pickup_location_id,
         CASE WHEN st THEN k END AS dropoff_location_id,
         CASE WHEN st AND w <> 3 THEN CAST(1 + user_id % 2 AS BIGINT) END AS vendor_id,
         CASE WHEN st AND w <> 5 THEN CAST(ts AS DATE) END AS pickup_datetime,
         CASE WHEN st AND w <> 5 THEN strftime(ts, '%H:%M:%S') END AS pickup_time,
         CASE WHEN st AND w <> 5 THEN date_trunc('second', ts + INTERVAL 15 MINUTE) END AS estimated_dropoff_datetime,
         CASE WHEN st AND w <> 5 THEN strftime(ts + INTERVAL 15 MINUTE, '%H:%M:%S') END AS estimated_dropoff_time,
         CASE WHEN st THEN round(value / 3.0, 2) END AS estimated_fare_amount,
         CASE WHEN NOT st AND ok AND w <> 4 THEN date_trunc('second', ts) END AS dropoff_datetime,
         CASE WHEN NOT st AND k % 6 <> 5 THEN CAST(1 + k % 6 AS VARCHAR) END AS rate_code,
         CASE WHEN NOT st AND k % 7 <> 0 THEN CAST(k % 7 AS DOUBLE) END AS passenger_count,
         CASE WHEN NOT st AND value / 10.0 <> 0 THEN value / 10.0 END AS trip_distance,
         CASE WHEN NOT st AND w <> 5 AND (ok OR k % 2 = 1) AND value <> 0 THEN value END AS fare_amount,
         CASE WHEN NOT st AND k % 4 <> 0 THEN CAST(k % 4 AS DOUBLE) END AS tip_amount,
         CASE WHEN NOT st THEN event_type END AS payment_type,
         CASE WHEN NOT st THEN CAST(1 + user_id % 2 AS VARCHAR) END AS trip_type
  FROM rv WHERE CASE WHEN st THEN w NOT IN (0, 1, 2, 4) ELSE w NOT IN (0, 1, 2, 3) END)"""
    cols = ["trip_id", *_START_FIELDS]
    cols += [f"CASE WHEN s_seq IS NULL OR {f}_seq > s_seq THEN {f}_v END AS {f}" for f in _END_FIELDS]
    return f"WITH {_RECEIVED},\n{iev},\n{_state_cte()}\nSELECT {', '.join(cols)} FROM st"


def _write_outputs_sql() -> str:
    trips = _trips_sql("replay")
    return f"""WITH t AS ({trips})
SELECT 'trips_copy' AS dataset, count(*) AS n FROM t
UNION ALL SELECT 'completed_trips', count(*) FROM t WHERE dropoff_datetime IS NOT NULL
UNION ALL SELECT 'all_trips_daily_kpis', count(*) FROM (SELECT pickup_datetime FROM t GROUP BY 1)
UNION ALL SELECT 'completed_trips_daily_kpis', count(*) FROM (
  SELECT CAST(dropoff_datetime AS DATE) FROM t WHERE dropoff_datetime IS NOT NULL GROUP BY 1)"""


def _kpi_values_sql() -> str:
    return f"""WITH t AS ({_trips_sql("replay")})
SELECT 'all_trips_daily_kpis' AS dataset, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS day, {_kpis()}
FROM t GROUP BY pickup_datetime
UNION ALL SELECT 'completed_trips_daily_kpis', strftime(CAST(dropoff_datetime AS DATE), '%Y-%m-%d %H:%M:%S'), {_kpis()}
FROM t WHERE dropoff_datetime IS NOT NULL GROUP BY CAST(dropoff_datetime AS DATE)
UNION ALL SELECT 'raw_grain', strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S'), {_kpis()}
FROM t WHERE dropoff_datetime IS NOT NULL GROUP BY dropoff_datetime"""


_LARGE = """s AS (SELECT CAST(o_orderkey AS VARCHAR) AS trip_id,
                  CAST(o_orderdate AS DATE) AS pickup_datetime FROM orders),
e AS (SELECT CAST(l_orderkey AS VARCHAR) AS trip_id,
             CAST(l_shipdate AS DATE) AS dropoff_datetime,
             round(l_extendedprice, 2) AS fare_amount FROM lineitem)"""


_CSV_REJECTS = f"""WITH {_EV},
t AS (
  SELECT d, CAST(event_id // 2 AS VARCHAR) AS trip_id, CAST(user_id AS VARCHAR) AS loc,
         CASE WHEN d = 2 THEN 'abc' ELSE CAST(1 + user_id % 2 AS VARCHAR) END AS vendor,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS pickup, k,
         strftime(ts + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS est,
         CASE WHEN d = 0 THEN 'n/a' ELSE CAST(round(value / 3.0, 2) AS VARCHAR) END AS fare
  FROM ev WHERE event_id % 2 = 0 AND d IN (0, 2, 4)),
r AS (
  SELECT *, unnest(CASE d WHEN 0 THEN ['bad_estimated_fare_amount'] WHEN 2 THEN ['bad_vendor_id']
                          ELSE ['bad_pickup_location_id', 'bad_pickup_datetime'] END) AS reason FROM t)
SELECT 'read_csv' AS stage, reason, trip_id,
       '{{"trip_id":"' || trip_id || '","pickup_location_id":"' || CASE WHEN d = 4 THEN '1.5' ELSE loc END
       || '","dropoff_location_id":"' || CAST(k AS VARCHAR) || '","vendor_id":"' || vendor
       || '","pickup_datetime":"' || CASE WHEN d = 4 THEN 'some day' ELSE pickup END
       || '","estimated_dropoff_datetime":"' || est || '","estimated_fare_amount":"' || fare || '"}}' AS record
FROM r"""

_PUBLISHED = f"""WITH t AS ({_TRIPS_REPLAY})
SELECT 'all_trips_daily_kpis' AS dataset, strftime(pickup_datetime, '%Y-%m-%d') AS day, {_kpis()}
FROM t GROUP BY pickup_datetime
UNION ALL SELECT 'completed_trips_daily_kpis', strftime(CAST(dropoff_datetime AS DATE), '%Y-%m-%d'), {_kpis()}
FROM t WHERE dropoff_datetime IS NOT NULL GROUP BY CAST(dropoff_datetime AS DATE)"""


ORACLES: dict[str, str] = {
    "csv_rejects": _CSV_REJECTS,
    "event_log": f"""WITH {_EV}
SELECT CAST(row_number() OVER (ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S'), event_id // 2) - 1 AS BIGINT) AS seq, event_id // 2 AS trip_id
FROM ev WHERE event_id % 2 = 0""",
    "kpi_published_values": _PUBLISHED,
    "layout_rows": f"""SELECT count(*) AS n, true AS even, true AS ordered
FROM ({_TRIPS_REPLAY}) WHERE dropoff_datetime IS NOT NULL""",
    "csv_scan": f"WITH {_EV},\n{_PS}\nSELECT * FROM ps",
    "csv_scan_ends": f"WITH {_EV},\n{_PE}\nSELECT * FROM pe",
    "parse_start_lines": _PARSE_START,
    "parse_end_lines": _PARSE_END,
    "line_rejects": _LINE_REJECTS,
    "start_events": _START_EVENTS,
    "end_events": f"SELECT trip_id AS key, * FROM ({_PARSE_END})",
    "decoded_events": _PARSE_START,
    "read_trips": _TRIPS_REPLAY,
    "normalize_starts": f"WITH {_EV},\n{_PS},\n{_NS}\nSELECT * FROM ns",
    "normalize_ends": f"WITH {_EV},\n{_PE},\n{_NE}\nSELECT * FROM ne",
    "normalize_start_events": _NORMALIZE_START_EVENTS,
    "valid_end_fields": _end_fields_sql(strict=False),
    "strict_end_fields": _end_fields_sql(strict=True),
    "completed_trips": f"WITH {_PAIRED}\nSELECT * FROM j WHERE dropoff_datetime IS NOT NULL",
    "fully_described_trips": f"""WITH {_PAIRED}
SELECT * FROM j WHERE dropoff_datetime IS NOT NULL AND rate_code IS NOT NULL
  AND passenger_count IS NOT NULL AND payment_type IS NOT NULL AND trip_type IS NOT NULL""",
    "distinct_dropoff_days": f"""WITH {_EV},\n{_PS},\n{_PE},\n{_NS},\n{_NE}
SELECT DISTINCT dropoff_datetime FROM ne WHERE trip_id IN (SELECT trip_id FROM ns)""",
    "distinct_dropoff_times": f"WITH {_EV},\n{_PE}\nSELECT DISTINCT dropoff_datetime FROM pe",
    "joined_trips": f"WITH {_PAIRED}\nSELECT * FROM j",
    "trips_put_only": f"""WITH {_EV},
{_IEV},
{_state_cte(with_ends=False, where="WHERE kind = 'start'")}
SELECT trip_id, {', '.join(_START_FIELDS)} FROM st""",
    "trips_update_only": f"""WITH {_EV},
{_IEV},
{_state_cte(with_starts=False, where="WHERE kind = 'end'")}
SELECT trip_id, {', '.join(f + '_v AS ' + f for f in _END_FIELDS)} FROM st""",
    "trips_replay": _TRIPS_REPLAY,
    "trips_merge": _trips_sql("merge"),
    "trips_from_lines": f"""SELECT * FROM ({_NORMALIZE_START_EVENTS}) s
FULL JOIN ({_end_fields_sql(strict=False)}) e USING (trip_id)""",
    "trips_replay_stream": _TRIPS_REPLAY,
    "events_to_trips": _events_to_trips_sql(),
    "events_to_trips_stream": _events_to_trips_sql(),
    "quarantine_rows": _QUARANTINE,
    "quarantine_rows_stream": _QUARANTINE,
    "consumer_report": _consumer_report_sql(),
    "consumer_report_stream": _consumer_report_sql(),
    "daily_kpis_completed_by_pickup": f"""WITH {_PAIRED}
SELECT pickup_datetime, {_kpis()}
FROM j WHERE dropoff_datetime IS NOT NULL GROUP BY pickup_datetime""",
    "daily_kpis_all": f"""WITH {_PAIRED}
SELECT pickup_datetime, {_kpis()}
FROM j GROUP BY pickup_datetime""",
    "daily_kpis_completed_by_dropoff": f"""WITH {_PAIRED}
SELECT CAST(dropoff_datetime AS DATE) AS "DAY", {_kpis()}
FROM j WHERE dropoff_datetime IS NOT NULL GROUP BY 1""",
    "run_report": _RUN_REPORT,
    "write_outputs": _write_outputs_sql(),
    "kpi_job_values": _kpi_values_sql(),
    "kpis_large": f"""WITH {_LARGE}
SELECT s.pickup_datetime, {_kpis()}
FROM s JOIN e USING (trip_id) WHERE e.dropoff_datetime IS NOT NULL
GROUP BY s.pickup_datetime""",
    "kpis_large_by_dropoff": f"""WITH {_LARGE}
SELECT e.dropoff_datetime AS "DAY", {_kpis()}
FROM s JOIN e USING (trip_id) WHERE e.dropoff_datetime IS NOT NULL
GROUP BY e.dropoff_datetime""",
}
