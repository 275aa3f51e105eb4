"""Independent SQL for every named query, in the DuckDB dialect."""

from __future__ import annotations

from skyledger.plans.gaps import GAPS
from skyledger.plans.parameters import (
    CORRECTED_BEFORE, CORRECTED_MONTH, DATES, LOOKUP_AIRPORTS, LOOKUP_ROUTES, TRIP_DATES, YEARS,
)

_VIEW = """
WITH flights AS (
  SELECT CAST(l_shipdate AS DATE) AS flight_date,
         CAST(isodow(CAST(l_shipdate AS DATE)) AS INTEGER) AS day_of_week,
         p_brand AS carrier,
         CAST(l_orderkey % 10000 AS VARCHAR) AS flight_num,
         CASE WHEN l_partkey % 13 = 0 THEN NULL
              ELSE concat('N', CAST(l_partkey AS VARCHAR)) END AS tail_num,
         sn.n_name AS origin,
         cn.n_name AS dest,
         CAST(((l_partkey * 7 + l_linenumber * 131 + l_orderkey) % 24) * 100
              + ((l_partkey + l_orderkey) % 60) AS INT) AS dep_time,
         CAST(((l_partkey * 7 + l_linenumber * 131 + l_orderkey + 2) % 24) * 100
              + ((l_partkey + l_orderkey) % 60) AS INT) AS arr_time,
         l_quantity - 20 AS dep_delay,
         greatest(l_quantity - 20, 0) AS dep_delay_minutes,
         CAST(CASE WHEN l_quantity - 20 >= 15 THEN 1 ELSE 0 END AS DOUBLE) AS dep_del15,
         l_quantity - 20 + (l_partkey % 41) - 20 AS arr_delay,
         greatest(l_quantity - 20 + (l_partkey % 41) - 20, 0) AS arr_delay_minutes,
         CAST(CASE WHEN l_quantity - 20 + (l_partkey % 41) - 20 >= 15 THEN 1 ELSE 0 END
              AS DOUBLE) AS arr_del15,
         CAST(CASE WHEN l_partkey % 50 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS cancelled,
         CAST(CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS diverted
  FROM lineitem
  JOIN orders   ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey  = c_custkey
  JOIN supplier ON l_suppkey  = s_suppkey
  JOIN part     ON l_partkey  = p_partkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
),
clean AS (SELECT * FROM flights WHERE cancelled = 0 AND diverted = 0),
flown AS (SELECT * FROM flights WHERE cancelled = 0)
"""

_COLUMNS14 = """day_of_week, flight_date, carrier, flight_num, origin, dest, dep_time, dep_delay,
  dep_delay_minutes, dep_del15, arr_time, arr_delay, arr_delay_minutes, arr_del15"""

_COLUMNS13 = """flight_date, day_of_week, coalesce(tail_num, flight_num) AS tail_num, flight_num,
  dep_time, arr_time, carrier, origin, dest, dep_delay, arr_delay, dep_delay_minutes,
  arr_delay_minutes"""


def _counts(source: str) -> str:
    return f"""SELECT airport, count(*) AS flights FROM (
      SELECT origin AS airport FROM {source} UNION ALL SELECT dest FROM {source}) AS ends
      GROUP BY airport"""


def _ontime(keys: str, flag: str) -> str:
    return f"""SELECT {keys},
      CAST(count(*) FILTER (WHERE {flag} = 0) AS DOUBLE) * CAST(100 AS DOUBLE)
        / CAST(count({flag}) AS DOUBLE) AS ontime_pct,
      count(*) AS flights, count(*) FILTER (WHERE {flag} IS NULL) AS unknown
      FROM clean GROUP BY {keys}"""


def _group(function: str, measure: str, keys: str, alias: str) -> str:
    return f"SELECT {keys}, {function}({measure}) AS {alias} FROM clean GROUP BY {keys}"


def _flown(metric: str) -> str:
    """The same metric with diverted flights kept."""
    return metric.replace("FROM clean", "FROM flown")


def _top(metric: str, value: str, code: str, direction: str) -> str:
    return f"SELECT * FROM ({metric}) AS m ORDER BY {value} {direction}, {code} {direction} LIMIT 10"


def _top_per_group(metric: str, group: str, value: str, code: str, direction: str) -> str:
    return f"""SELECT * FROM (
      SELECT m.*, row_number() OVER (PARTITION BY {group}
        ORDER BY {value} {direction}, {code} {direction}) AS rank FROM ({metric}) AS m) AS r
      WHERE rank <= 10"""


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_HALF = "CASE WHEN dep_time < 1200 THEN 1 WHEN dep_time > 1200 THEN 2 END"
_LEGS = f"""SELECT origin, dest, flight_date, dep_time, arr_time,
  concat(carrier, ' ', flight_num) AS flight, coalesce(arr_delay_minutes, 0) AS delay,
  {_HALF} AS half FROM clean WHERE dep_time <> 1200"""
_BEST = f"""SELECT origin, dest, flight_date, dep_time, arr_time, flight, delay, half FROM (
  SELECT legs.*, row_number() OVER (PARTITION BY origin, dest, flight_date, half
    ORDER BY delay, flight, dep_time, arr_time) AS choice FROM ({_LEGS}) AS legs) AS c
  WHERE choice = 1"""


def _hhmm(column: str) -> str:
    return f"lpad(CAST({column} AS VARCHAR), 4, '0')"


def _trips(leg_query: str, extra: str = "") -> str:
    return f"""SELECT a.origin, b.dest AS destination, a.dest AS stopby, a.flight_date AS date,
      {_hhmm("a.dep_time")} AS xydeptime, {_hhmm("a.arr_time")} AS xyarrtime,
      a.flight AS xyflight, a.delay AS xydelay, b.flight_date AS yzdate,
      {_hhmm("b.dep_time")} AS yzdeptime, {_hhmm("b.arr_time")} AS yzarrtime,
      b.flight AS yzflight, b.delay AS yzdelay {extra}
      FROM ({leg_query}) AS a JOIN ({leg_query}) AS b
        ON a.dest = b.origin AND b.flight_date = CAST(a.flight_date + INTERVAL 2 DAY AS DATE)
      WHERE a.half = 1 AND b.half = 2"""


_COUNTED_LEGS = f"""SELECT origin, dest, flight_date, dep_time, arr_time, flight, delay, half,
  count(*) AS n FROM ({_LEGS}) AS legs GROUP BY ALL"""


def _fixed2(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) AS VARCHAR)"


_MESSAGE = f"""SELECT concat_ws(',', CAST(day_of_week AS VARCHAR), CAST(flight_date AS VARCHAR),
  carrier, flight_num, origin, dest, {_hhmm("dep_time")}, {_fixed2("dep_delay")},
  {_fixed2("dep_delay_minutes")}, {_fixed2("dep_del15")}, {_hhmm("arr_time")},
  {_fixed2("arr_delay")}, {_fixed2("arr_delay_minutes")}, {_fixed2("arr_del15")}) AS value
  FROM clean"""

_WORDS = """SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split(text, ' ')) AS word FROM documents) AS w
  WHERE word <> '' GROUP BY word"""

_CARRIER_ONTIME = _ontime("carrier", "arr_del15")
_AIRPORT_CARRIER_ONTIME = _ontime("origin, carrier", "dep_del15")
_AIRPORT_DEST_ONTIME = _ontime("origin, dest", "dep_del15")
_CARRIER_MEAN = _group("avg", "dep_delay_minutes", "carrier", "mean_delay")
_CARRIER_TOTAL = _group("sum", "arr_delay", "carrier", "total_delay")
_AIRPORT_CARRIER_MEAN = _group("avg", "dep_delay_minutes", "origin, carrier", "mean_delay")
_AIRPORT_DEST_MEAN = _group("avg", "dep_delay_minutes", "origin, dest", "mean_delay")
_AIRPORT_CARRIER_TOTAL = _group("sum", "arr_delay_minutes", "origin, carrier", "total_delay")
_AIRPORT_DEST_TOTAL = _group("sum", "dep_delay", "origin, dest", "total_delay")
_ROUTE_MEAN = _group("avg", "arr_delay_minutes", "origin, dest", "mean_delay")
_ROUTE_SIGNED = _group("avg", "arr_delay", "origin, dest", "mean_delay")

_CARRIER_TABLE = f"""SELECT origin AS airport, carrier, ontime_pct
  FROM ({_AIRPORT_CARRIER_ONTIME}) AS m"""
_DEST_TABLE = f"""SELECT origin, dest AS destination, ontime_pct
  FROM ({_AIRPORT_DEST_ONTIME}) AS m"""
_ROUTE_TABLE = f"""SELECT origin, dest AS destination, mean_delay
  FROM ({_ROUTE_MEAN}) AS m"""

_CARRIER_DELAY_TABLE = f"""SELECT origin AS airport, carrier, mean_delay AS delay
  FROM ({_AIRPORT_CARRIER_MEAN}) AS m"""
_DEST_DELAY_TABLE = f"""SELECT origin, dest AS destination, mean_delay AS delay
  FROM ({_AIRPORT_DEST_MEAN}) AS m"""

_ROUTE_PAIRS = " OR ".join(
    f"(origin = '{o}' AND destination = '{d}')" for o, d in LOOKUP_ROUTES
)

_FLIGHT_QUERIES = {
    "clean_flights": f"SELECT {_COLUMNS14} FROM clean",
    "not_cancelled_flights": f"SELECT {_COLUMNS14} FROM flown",
    "extract13": f"SELECT {_COLUMNS13} FROM clean",
    "tail_default": """SELECT coalesce(tail_num, flight_num) AS tail_num, count(*) AS flights
        FROM clean GROUP BY ALL""",
    "extract_audit": """SELECT count(*) FILTER (WHERE cancelled = 0 AND diverted = 0) AS good_lines,
        count(*) FILTER (WHERE cancelled IS NULL OR diverted IS NULL) AS unknown_lines,
        count(*) AS all_lines FROM flights""",
    "flights_by_year": """SELECT CAST(year(flight_date) AS INTEGER) AS year, count(*) AS flights
        FROM clean GROUP BY ALL""",
    "flights_year_range": f"""SELECT {_COLUMNS13}, CAST(year(flight_date) AS INTEGER) AS year
        FROM clean WHERE year(flight_date) IN ({", ".join(map(str, YEARS))})""",
    "flights_on_dates": f"""SELECT {_COLUMNS14} FROM clean
        WHERE flight_date IN ({", ".join(f"DATE '{d}'" for d in DATES)})""",
    "airport_counts": _counts("clean"),
    "top_airports": _top(_counts("clean"), "flights", "airport", "DESC"),
    "top_airports_not_cancelled": _top(_counts("flown"), "flights", "airport", "DESC"),
    "airport_popularity": f"""SELECT airport, flights,
        rank() OVER (ORDER BY flights DESC, airport DESC) AS rank FROM ({_counts("clean")}) AS c""",
    "airport_popularity_not_cancelled": f"""SELECT airport, flights,
        rank() OVER (ORDER BY flights DESC, airport DESC) AS rank FROM ({_counts("flown")}) AS c""",
    "carrier_mean_delay": _CARRIER_MEAN,
    "carrier_total_delay": _CARRIER_TOTAL,
    "carrier_ontime_pct": _CARRIER_ONTIME,
    "top_carriers_mean_delay": _top(_CARRIER_MEAN, "mean_delay", "carrier", "ASC"),
    "top_carriers_total_delay": _top(_CARRIER_TOTAL, "total_delay", "carrier", "ASC"),
    "top_carriers_ontime": _top(_CARRIER_ONTIME, "ontime_pct", "carrier", "DESC"),
    "airport_carrier_ontime_pct": _AIRPORT_CARRIER_ONTIME,
    "airport_dest_ontime_pct": _AIRPORT_DEST_ONTIME,
    "airport_carrier_mean_delay": _AIRPORT_CARRIER_MEAN,
    "airport_dest_mean_delay": _AIRPORT_DEST_MEAN,
    "airport_carrier_total_delay": _AIRPORT_CARRIER_TOTAL,
    "airport_dest_total_delay": _AIRPORT_DEST_TOTAL,
    "carrier_total_delay_not_cancelled": _flown(_CARRIER_TOTAL),
    "top_carriers_total_delay_not_cancelled": _top(
        _flown(_CARRIER_TOTAL), "total_delay", "carrier", "ASC"
    ),
    "airport_dest_total_delay_not_cancelled": _flown(_AIRPORT_DEST_TOTAL),
    "top_dests_by_airport_total_delay_not_cancelled": _top_per_group(
        _flown(_AIRPORT_DEST_TOTAL), "origin", "total_delay", "dest", "ASC"
    ),
    "route_mean_signed_delay_not_cancelled": _flown(_ROUTE_SIGNED),
    "top_carriers_by_airport_delay": _top_per_group(
        _AIRPORT_CARRIER_MEAN, "origin", "mean_delay", "carrier", "ASC"
    ),
    "top_dests_by_airport_delay": _top_per_group(
        _AIRPORT_DEST_MEAN, "origin", "mean_delay", "dest", "ASC"
    ),
    "top_carriers_by_airport_total_delay": _top_per_group(
        _AIRPORT_CARRIER_TOTAL, "origin", "total_delay", "carrier", "ASC"
    ),
    "top_dests_by_airport_total_delay": _top_per_group(
        _AIRPORT_DEST_TOTAL, "origin", "total_delay", "dest", "ASC"
    ),
    "top_carriers_by_airport_ontime": _top_per_group(
        _AIRPORT_CARRIER_ONTIME, "origin", "ontime_pct", "carrier", "DESC"
    ),
    "top_dests_by_airport_ontime": _top_per_group(
        _AIRPORT_DEST_ONTIME, "origin", "ontime_pct", "dest", "DESC"
    ),
    "route_mean_delay": _ROUTE_MEAN,
    "route_mean_signed_delay": _ROUTE_SIGNED,
    "trip_first_legs": f"""SELECT origin, dest, flight_date, delay, flight, dep_time, arr_time
        FROM ({_LEGS}) AS legs WHERE half = 1""",
    "trip_second_legs": f"""SELECT origin, dest, flight_date, delay, flight, dep_time, arr_time
        FROM ({_LEGS}) AS legs WHERE half = 2""",
    "best_leg_flights": _BEST,
    "best_trips": _trips(_BEST),
    "all_trips": _trips(_COUNTED_LEGS, ", a.n * b.n AS copies"),
    "best_trips_on_date": f"""SELECT * FROM ({_trips(_BEST)}) AS t
        WHERE date IN ({", ".join(f"DATE '{d}'" for d in TRIP_DATES)})""",
    "best_trips_in_years": f"""SELECT * FROM ({_trips(_BEST)}) AS t
        WHERE year(date) IN ({", ".join(map(str, YEARS))})""",
    "raw_round_trip": f"SELECT {_COLUMNS14} FROM clean",
    "headerless_round_trip": f"SELECT {_COLUMNS14} FROM clean",
    "lookup_carriers": _top_per_group(
        f"SELECT * FROM ({_CARRIER_TABLE}) AS t WHERE airport IN ({_in(LOOKUP_AIRPORTS)})",
        "airport", "ontime_pct", "carrier", "DESC",
    ),
    "lookup_destinations": _top_per_group(
        f"SELECT * FROM ({_DEST_TABLE}) AS t WHERE origin IN ({_in(LOOKUP_AIRPORTS)})",
        "origin", "ontime_pct", "destination", "DESC",
    ),
    "lookup_carriers_by_delay": _top_per_group(
        f"SELECT * FROM ({_CARRIER_DELAY_TABLE}) AS t WHERE airport IN ({_in(LOOKUP_AIRPORTS)})",
        "airport", "delay", "carrier", "ASC",
    ),
    "lookup_destinations_by_delay": _top_per_group(
        f"SELECT * FROM ({_DEST_DELAY_TABLE}) AS t WHERE origin IN ({_in(LOOKUP_AIRPORTS)})",
        "origin", "delay", "destination", "ASC",
    ),
    "lookup_route": f"SELECT * FROM ({_ROUTE_TABLE}) AS t WHERE {_ROUTE_PAIRS}",
    "publish_messages": _MESSAGE,
    "stream_top_airports": _top(_counts("clean"), "flights", "airport", "DESC"),
    "stream_top_carriers": _top(_CARRIER_ONTIME, "ontime_pct", "carrier", "DESC"),
    "stream_airport_carrier": _CARRIER_TABLE,
    "stream_airport_dest": _DEST_TABLE,
    "stream_route_mean_table": _ROUTE_TABLE,
    "stream_all_trips": _trips(_COUNTED_LEGS, ", a.n * b.n AS copies"),
    "stream_best_trips": _trips(_BEST),
}


_CORRECTED = f"""(SELECT * FROM clean WHERE NOT (year(flight_date) = {CORRECTED_MONTH[0]}
  AND month(flight_date) = {CORRECTED_MONTH[1]} AND dep_time < {CORRECTED_BEFORE})) AS corrected"""
_FLIGHT_QUERIES |= {
    f"partials_{name}": _FLIGHT_QUERIES[name].replace("FROM clean", f"FROM {_CORRECTED}")
    for name in (
        "airport_counts", "carrier_mean_delay", "carrier_total_delay", "carrier_ontime_pct",
        "airport_dest_ontime_pct", "route_mean_delay",
    )
}
_FLIGHT_QUERIES |= {
    "partials_airport_carrier_mean_delay": _AIRPORT_CARRIER_MEAN.replace("FROM clean", f"FROM {_CORRECTED}"),
    "best_trips_bucketed": _FLIGHT_QUERIES["best_trips"],
    "table_reset": _CARRIER_DELAY_TABLE,
    "ranked_text": f"""SELECT concat_ws(chr(9), CAST(rank AS VARCHAR), airport, CAST(flights AS VARCHAR)) AS value
        FROM ({_FLIGHT_QUERIES["airport_popularity"]}) AS r""",
    "lookup_route_interleaved": _FLIGHT_QUERIES["lookup_route"],
    "lookup_lines": f"""SELECT printf('%s - %s - %f', origin, destination, mean_delay) AS line
        FROM ({_FLIGHT_QUERIES["lookup_route"]}) AS r""",
    "stream_progress": f"""SELECT count(*) AS lines, CAST(sum(strlen(value)) AS BIGINT) AS bytes, CAST(0 AS BIGINT) AS over_cap
        FROM ({_MESSAGE}) AS m""",
    "stream_checked_lines": """SELECT CASE dep_time % 100 WHEN 7 THEN 'too many fields' WHEN 13 THEN 'unreadable day_of_week'
        WHEN 21 THEN 'empty line' ELSE 'good' END AS reason, count(*) AS lines FROM clean GROUP BY ALL""",
    "stream_state_airports": _FLIGHT_QUERIES["airport_counts"],
    "stream_state_carriers": _FLIGHT_QUERIES["carrier_ontime_pct"],
}


def _gap_view() -> str:
    """The view with columns blanked by times of day."""
    kept = [
        f"CASE WHEN {time} % {divisor} <> {remainder} THEN {name} END AS {name}"
        for name, (time, divisor, remainder) in GAPS.items()
    ]
    return _VIEW.replace("WITH flights AS (", "WITH whole AS (").replace(
        "clean AS (",
        f"flights AS (SELECT * EXCLUDE ({', '.join(GAPS)}), {', '.join(kept)} FROM whole),\nclean AS (",
    )


# Departure minutes of airport rankings: 0 if neither delay is known, else unknown without them.
_MINUTES = """CASE WHEN dep_delay_minutes IS NULL AND arr_delay_minutes IS NULL THEN 0
  ELSE dep_delay_minutes END"""


def _known_mean(measure: str, keys: str) -> str:
    present = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return f"""SELECT {keys}, avg(m) AS mean_delay FROM (SELECT *, {measure} AS m FROM clean) AS c
      WHERE m IS NOT NULL AND {present} GROUP BY {keys}"""


def _known_ontime(keys: str, flag: str) -> str:
    present = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return _ontime(keys, flag).replace("FROM clean", f"FROM clean WHERE {present}")


_KNOWN_LEGS = """origin IS NOT NULL AND dest IS NOT NULL AND flight_date IS NOT NULL"""
_GAP_QUERIES = {
    "gaps_audit": _FLIGHT_QUERIES["extract_audit"],
    "gaps_airport_counts": f"SELECT * FROM ({_counts('clean')}) AS c WHERE airport IS NOT NULL",
    "gaps_carrier_ontime_pct": _known_ontime("carrier", "arr_del15"),
    "gaps_airport_dest_ontime_pct": _known_ontime("origin, dest", "dep_del15"),
    "gaps_carrier_total_delay": """SELECT carrier, sum(arr_delay) AS total_delay FROM clean
        WHERE carrier IS NOT NULL AND arr_delay IS NOT NULL GROUP BY carrier""",
    "gaps_airport_carrier_mean_delay": _known_mean(_MINUTES, "origin, carrier"),
    "gaps_airport_dest_mean_delay": _known_mean(_MINUTES, "origin, dest"),
    "gaps_route_mean_delay": _known_mean("arr_delay_minutes", "origin, dest"),
    "gaps_best_trips": _trips(_BEST.replace("dep_time <> 1200", f"dep_time <> 1200 AND {_KNOWN_LEGS}")
        .replace("concat(carrier, ' ', flight_num)", "concat_ws(' ', carrier, flight_num)")),
    "extract_round_trip": f"SELECT {_COLUMNS13} FROM clean",
}


def oracle_sql() -> dict[str, str]:
    queries = {name: f"{_VIEW} {body}" for name, body in _FLIGHT_QUERIES.items()}
    queries |= {name: f"{_gap_view()} {body}" for name, body in _GAP_QUERIES.items()}
    queries["word_count"] = _WORDS
    queries["stream_word_count"] = _WORDS
    return queries
