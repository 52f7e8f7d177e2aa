"""DuckDB SQL that computes the same results as the registered queries."""

from __future__ import annotations

import re

from wheelpace.checks.standin import trips_sql
from wheelpace.config import DEFAULT, RUSH, SPEED, WEEKEND

_RAW = list(DEFAULT.required) + ["VendorID", "congestion_surcharge", "airport_fee"]
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in DEFAULT.critical)
_RUSH_HOURS = ", ".join(map(str, DEFAULT.rush_hours))

_TIMED = f"""
lasting AS (
  SELECT {', '.join(_RAW)},
    (epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 1000000.0::DOUBLE / 60.0::DOUBLE AS duration_min
  FROM trips WHERE {_COMPLETE}
), timed AS (
  SELECT *,
    CASE WHEN duration_min > 0 THEN trip_distance / (duration_min / 60.0::DOUBLE) END AS average_speed_mph,
    CAST(hour(tpep_pickup_datetime) AS SMALLINT) AS pickup_hour,
    CAST(isodow(tpep_pickup_datetime) - 1 AS SMALLINT) AS pickup_dayofweek,
    isodow(tpep_pickup_datetime) - 1 IN (5, 6) AS is_weekend,
    hour(tpep_pickup_datetime) IN ({_RUSH_HOURS}) AS is_rush_hour
  FROM lasting
)"""

_TESTS = [
    ("fare", "fare_amount BETWEEN 2.5 AND 500"),
    ("distance", "trip_distance BETWEEN 0.1 AND 100"),
    ("duration", "duration_min BETWEEN 1 AND 360"),
    ("speed", "average_speed_mph BETWEEN 1 AND 80"),
    ("passengers", "(passenger_count IS NULL OR passenger_count BETWEEN 1 AND 6)"),
    ("total", "total_amount > 0"),
]
_PLAUSIBLE = " AND ".join(t for _, t in _TESTS)

_CLEAN = f"""
target AS (
  SELECT date_trunc('month', tpep_pickup_datetime) AS month, count(*) AS n
  FROM timed GROUP BY 1 ORDER BY n DESC, month LIMIT 1
), in_month AS (
  SELECT t.* FROM timed t JOIN target ON date_trunc('month', t.tpep_pickup_datetime) = target.month
), cleaned AS (
  SELECT DISTINCT * FROM in_month WHERE {_PLAUSIBLE}
)"""

_MODEL = """
slow AS (SELECT quantile_cont(average_speed_mph, 0.25) AS threshold FROM cleaned),
marked AS (
  SELECT c.*, CAST(average_speed_mph <= threshold AS INT) AS slow_trip,
    CASE WHEN pickup_hour <= 5 THEN 'late_night' WHEN pickup_hour <= 9 THEN 'morning_rush'
         WHEN pickup_hour <= 15 THEN 'daytime' WHEN pickup_hour <= 19 THEN 'evening_rush' ELSE 'night' END
      AS pickup_time_group,
    coalesce(PULocationID, -1) || '_' || coalesce(DOLocationID, -1) AS route_id,
    CAST(pickup_dayofweek = 4 AS INT) AS is_friday, CAST(pickup_dayofweek = 0 AS INT) AS is_monday
  FROM cleaned c, slow
)"""


def _raw(body: str) -> str:
    return f"WITH {trips_sql()} {body}"


def _timed(body: str) -> str:
    return f"WITH {trips_sql()}, {_TIMED} {body}"


def _clean(body: str, *more: str) -> str:
    return f"WITH {', '.join([trips_sql(), _TIMED, _CLEAN, *more])} {body}"


def _model(body: str, *more: str) -> str:
    return _clean(body, _MODEL, *more)


def _rounded(digits: int = 6, skip: tuple[str, ...] = ()) -> str:
    """Select list of all stored columns with the doubles rounded."""
    doubles = {"passenger_count", "trip_distance", "RatecodeID", "fare_amount", "tip_amount", "tolls_amount",
               "total_amount", "congestion_surcharge", "airport_fee"}
    return ", ".join(f"round({c}, {digits}) AS {c}" if c in doubles else c for c in _RAW)


def _describe(table: str, columns: list[str], digits: int) -> str:
    """One row per column."""
    return " UNION ALL ".join(f"""
SELECT '{c}' AS metric, count({c}) AS count, round(avg({c}), {digits}) AS mean, round(stddev_samp({c}), {digits}) AS std,
  round(min({c}), {digits}) AS min, round(quantile_cont({c}, 0.25), {digits}) AS p25,
  round(quantile_cont({c}, 0.5), {digits}) AS p50, round(quantile_cont({c}, 0.75), {digits}) AS p75,
  round(max({c}), {digits}) AS max FROM {table}""" for c in columns)


def _group(table: str, key: str, value: str, digits: int) -> str:
    return f"""
SELECT {key}, count({value}) AS n, round(avg({value}), {digits}) AS mean, round(stddev_samp({value}), {digits}) AS std,
  round(median({value}), {digits}) AS median, round(min({value}), {digits}) AS min, round(max({value}), {digits}) AS max
FROM {table} WHERE {key} IS NOT NULL GROUP BY {key}"""


def _correlate(table: str, columns: list[str], digits: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS variable, '{b}' AS with_variable, round(corr({a}, {b}), {digits}) AS r FROM {table}"
        if a != b else f"SELECT '{a}' AS variable, '{b}' AS with_variable, 1.0::DOUBLE AS r FROM (SELECT count(*) FROM {table})"
        for a in columns for b in columns)


def _nulls(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_null FROM {table}" for c in columns)


_HOURLY = f"""
SELECT pickup_hour, count(*) AS n, round(avg({SPEED}), 3) AS mean_speed, round(median({SPEED}), 3) AS median_speed
FROM cleaned GROUP BY 1"""

_FUNNEL = ", ".join(
    f"count(*) FILTER (WHERE {' AND '.join(['TRUE'] + [t for _, t in _TESTS[:i]])}) AS r{i}" for i in range(7))


def _funnel_steps(first: int) -> str:
    return " UNION ALL ".join(
        f"SELECT {i + first} AS step, '{name}' AS name, r{i - 1} AS rows_before, r{i} AS rows_after, "
        f"r{i - 1} - r{i} AS rows_removed FROM funnel" for i, (name, _) in enumerate(_TESTS, 1))


_BOX = f"""
quart AS (
  SELECT is_rush_hour, count({SPEED}) AS n, quantile_cont({SPEED}, 0.25) AS q1, median({SPEED}) AS median,
         quantile_cont({SPEED}, 0.75) AS q3 FROM cleaned GROUP BY 1
)"""

_CELLS = f"""
cell_means AS (SELECT pickup_dayofweek, pickup_hour, avg({SPEED}) AS m FROM cleaned GROUP BY 1, 2),
cells AS (
  SELECT CAST(d.range AS SMALLINT) AS pickup_dayofweek, CAST(h.range AS SMALLINT) AS pickup_hour,
         round(m, 2) AS mean_speed
  FROM range(7) d CROSS JOIN range(24) h
  LEFT JOIN cell_means c ON c.pickup_dayofweek = d.range AND c.pickup_hour = h.range
)"""

_ROW_MEANS = """
row_means AS (
  SELECT pickup_hour, avg(CASE WHEN pickup_dayofweek < 5 THEN mean_speed END) AS weekday_mean,
         avg(CASE WHEN pickup_dayofweek >= 5 THEN mean_speed END) AS weekend_mean
  FROM cells GROUP BY 1
)"""


def _first_hour(table: str, mean: str, order: str = "") -> str:
    return f"(SELECT pickup_hour FROM {table} WHERE {mean} IS NOT NULL ORDER BY {mean} {order}, pickup_hour LIMIT 1)"


_BY_WEEKEND = f"""
by_weekend AS (
  SELECT pickup_hour, avg({SPEED}) AS mean, avg(CASE WHEN NOT is_weekend THEN {SPEED} END) AS weekday_mean_speed,
         avg(CASE WHEN is_weekend THEN {SPEED} END) AS weekend_mean_speed
  FROM cleaned GROUP BY 1
)"""

_CATEGORIES = "categories AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS category, "
    f"{'0.0' if c in ('pickup_time_group', 'route_id') else f'CAST({c} AS INT)'}::DOUBLE AS sort_key, count(*) AS n "
    f"FROM marked WHERE {c} IS NOT NULL GROUP BY ALL" for c in DEFAULT.categorical_features) + ")"

_TEST_ROWS = f"""
classes AS (SELECT slow_trip, count(*) AS n, sum(count(*)) OVER () AS total FROM marked GROUP BY 1),
sizes AS (SELECT *, ceil({DEFAULT.test_share}::DOUBLE * total) AS wanted FROM classes),
slow_rows AS (SELECT floor(wanted * n / total::DOUBLE + 0.5) AS slow_test FROM sizes WHERE slow_trip = 1),
test_rows AS (
  SELECT slow_trip, n, CAST(CASE slow_trip WHEN 1 THEN slow_test ELSE wanted - slow_test END AS BIGINT) AS n_test
  FROM sizes, slow_rows
)"""

_CONFUSION = """
confused AS (
  SELECT count(*) FILTER (WHERE slow_trip = 0 AND NOT is_rush_hour) AS tn,
         count(*) FILTER (WHERE slow_trip = 0 AND is_rush_hour) AS fp,
         count(*) FILTER (WHERE slow_trip = 1 AND NOT is_rush_hour) AS fn,
         count(*) FILTER (WHERE slow_trip = 1 AND is_rush_hour) AS tp
  FROM marked
), rates AS (
  SELECT *, (tp + tn) / (tn + fp + fn + tp)::DOUBLE AS accuracy,
    coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS p1, coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS r1,
    coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) AS p0, coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0) AS r0
  FROM confused
), scores AS (
  SELECT *, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0
  FROM rates
)"""

_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_SUBSET = f"""
sides AS (
  SELECT count({SPEED}) FILTER (WHERE is_rush_hour) AS n_rush, count({SPEED}) FILTER (WHERE NOT is_rush_hour) AS n_other,
    avg({SPEED}) FILTER (WHERE is_rush_hour) AS mean_rush, avg({SPEED}) FILTER (WHERE NOT is_rush_hour) AS mean_other,
    var_samp({SPEED}) FILTER (WHERE is_rush_hour) AS v_rush, var_samp({SPEED}) FILTER (WHERE NOT is_rush_hour) AS v_other
  FROM cleaned
), welch AS (
  SELECT *, (mean_rush - mean_other) / sqrt(v_rush / n_rush + v_other / n_other) AS t,
    power(v_rush / n_rush + v_other / n_other, 2)
      / (power(v_rush / n_rush, 2) / (n_rush - 1) + power(v_other / n_other, 2) / (n_other - 1)) AS dof
  FROM sides
)"""


_ZONE_TESTS = [f"""
zones AS (
  SELECT PULocationID, count({SPEED}) FILTER (WHERE is_rush_hour) AS n_rush, count({SPEED}) FILTER (WHERE NOT is_rush_hour) AS n_other,
    avg({SPEED}) FILTER (WHERE is_rush_hour) AS m1, avg({SPEED}) FILTER (WHERE NOT is_rush_hour) AS m2,
    var_samp({SPEED}) FILTER (WHERE is_rush_hour) AS v1, var_samp({SPEED}) FILTER (WHERE NOT is_rush_hour) AS v2
  FROM cleaned GROUP BY 1
), tests AS (
  SELECT *, (m1 - m2) / sqrt(v1 / n_rush + v2 / n_other) AS t,
    power(v1 / n_rush + v2 / n_other, 2) / (power(v1 / n_rush, 2) / (n_rush - 1) + power(v2 / n_other, 2) / (n_other - 1)) AS dof
  FROM zones
), sides AS (
  SELECT PULocationID, dof / (dof + t * t) AS x, CASE WHEN dof / (dof + t * t) <= (dof / 2 + 1) / (dof / 2 + 2.5) THEN 1 ELSE 0 END AS straight,
    exp(lgamma(dof / 2 + 0.5) - lgamma(dof / 2) - lgamma(0.5::DOUBLE) + dof / 2 * ln(dof / (dof + t * t))
        + 0.5 * ln(t * t / (dof + t * t))) AS front, dof / 2 AS half FROM tests WHERE t IS NOT NULL AND dof IS NOT NULL
), start AS (
  SELECT PULocationID, straight, front, CASE straight WHEN 1 THEN x ELSE 1 - x END AS x,
    CASE straight WHEN 1 THEN half ELSE 0.5::DOUBLE END AS a, CASE straight WHEN 1 THEN 0.5::DOUBLE ELSE half END AS b FROM sides
)""", """
fraction AS (
  SELECT PULocationID, straight, front, x, a, b, 1 AS i, 1::DOUBLE AS n, 1::DOUBLE AS o, 0::DOUBLE AS d FROM start
  UNION ALL
  SELECT PULocationID, straight, front, x, a, b, i + 1, (n + term * o) / (1 + term * d), n / (1 + term * d), 1 / (1 + term * d)
  FROM (SELECT *, i // 2 AS m, CASE WHEN i % 2 = 1 THEN -(a + i // 2) * (a + b + i // 2) * x / ((a + 2 * (i // 2)) * (a + 2 * (i // 2) + 1))
                 ELSE (i // 2) * (b - i // 2) * x / ((a + 2 * (i // 2) - 1) * (a + 2 * (i // 2))) END AS term FROM fraction WHERE i <= 400)
)"""]

_ZONE_P = """
SELECT t.PULocationID, n_rush, n_other, round(t, 6) AS t, round(dof, 6) AS dof,
       round(CASE straight WHEN 1 THEN front / n / a ELSE 1 - front / n / a END, 9) AS p
FROM tests t LEFT JOIN fraction f ON f.PULocationID = t.PULocationID AND i = 401"""

def _two_months() -> str:
    """Counts of the trips as they are and of the same trips 31 days later, each by its own dominant month."""
    def moved(sql: str) -> str:
        return re.sub(r"\b(trips|lasting|timed|target|in_month|cleaned)\b", r"\1_later", sql)

    later = """trips_later AS (
  SELECT * REPLACE (tpep_pickup_datetime + INTERVAL 31 DAY AS tpep_pickup_datetime,
                    tpep_dropoff_datetime + INTERVAL 31 DAY AS tpep_dropoff_datetime) FROM trips
)"""
    counts = (f"SELECT strftime((SELECT month FROM target), '%Y-%m') AS period, (SELECT count(*) FROM trips) AS n_rows, "
              f"(SELECT count(*) FROM timed) AS n_complete, (SELECT count(*) FROM in_month) AS n_month, "
              f"(SELECT count(*) FROM in_month WHERE {_PLAUSIBLE}) AS n_plausible, (SELECT count(*) FROM cleaned) AS n_cleaned")
    return _clean(f"{counts} UNION ALL {moved(counts)}", later, moved(_TIMED), moved(_CLEAN))


_HOURS = "(SELECT count(DISTINCT pickup_hour) FROM cleaned)"
#: Tables of a whole run with their rows.
_STORED = [
    ("cleaned", "cleaned", "(SELECT count(*) FROM cleaned)"), ("cleaned", "funnel", 10),
    ("profile", "describe", 7), ("profile", "null_split", "(SELECT CASE WHEN count(*) > count(passenger_count) THEN 1 ELSE 0 END FROM cleaned)"),
    ("profile", "remaining_duplicates", 1), ("profile", "hourly_speed", _HOURS), ("profile", "speed_by_weekend", 2),
    ("profile", "speed_by_rush", 2), ("profile", "extreme_hours", 1), ("profile", "speed_median", 1), ("profile", "shares", 1),
    ("profile", "shape", 1), ("charts", "hourly_speed", _HOURS), ("charts", "hourly_by_weekend", _HOURS),
    ("charts", "rush_boxplot", 2), ("charts", "day_hour_heatmap", 7), ("charts", "hourly_finding", 1),
    ("charts", "rush_finding", 1), ("charts", "heat_finding", 1), ("statistics", "descriptive_stats", 7),
    ("statistics", "correlation_matrix", 49), ("statistics", "rush_compare", 2), ("statistics", "weekend_compare", 2),
    ("statistics", "hourly_by_weekend", _HOURS), ("model", "metrics", 1), ("model", "report", 5),
]

_TREE_COLUMNS = ["pickup_hour", "pickup_dayofweek", "passenger_count", "payment_type"]


def _best_split(rows: str, sides: str) -> str:
    """The best split of each side of ``rows`` (side, k, v, g, h), by the gain of its two halves."""
    return f"""
  SELECT *, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain FROM (
    SELECT side, k, v, sum(g) OVER low AS gl, sum(h) OVER low AS hl, sum(n) OVER low AS nl,
           sum(g) OVER whole AS g, sum(h) OVER whole AS h, sum(n) OVER whole AS n
    FROM (SELECT side, k, v, sum(g) AS g, sum(h) AS h, count(*) AS n FROM {rows} GROUP BY ALL)
    WINDOW low AS (PARTITION BY side, k ORDER BY v), whole AS (PARTITION BY side, k)
  ) WHERE nl >= 50 AND n - nl >= 50
  ORDER BY round(gain, 6) DESC, {sides} k, v LIMIT 1"""


_SPLITS = [
    """
weighted AS (
  SELECT row_number() OVER () AS id, (0.5 - slow_trip) * w AS g, 0.25 * w AS h, """ + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), -1) AS c{i}" for i, c in enumerate(_TREE_COLUMNS)) + """
  FROM marked JOIN (SELECT slow_trip, (SELECT count(*) FROM marked) / (2.0::DOUBLE * count(*)) AS w FROM marked GROUP BY 1)
  USING (slow_trip)
), long AS (
  SELECT id, g, h, unnest([0, 1, 2, 3]) AS k, unnest([c0, c1, c2, c3]) AS v, 0 AS side FROM weighted
), cuts AS (
  SELECT k, v, (v + lead(v) OVER (PARTITION BY k ORDER BY v)) / 2 AS cut FROM (SELECT DISTINCT k, v FROM long)
)""",
    f"best1 AS ({_best_split('long', '')})",
    """
sided AS (
  SELECT l.id, l.g, l.h, l.k, l.v, CASE WHEN r.v <= (SELECT v FROM best1) THEN 1 ELSE 2 END AS side
  FROM long l JOIN long r ON l.id = r.id AND r.k = (SELECT k FROM best1)
)""",
    f"best2 AS ({_best_split('sided', 'side,')})",
    """
leaves AS (
  SELECT CASE WHEN a.side <> (SELECT side FROM best2) THEN a.side WHEN b.v <= (SELECT v FROM best2) THEN 3 ELSE 4 END AS node,
         count(*) AS n, -0.08 * sum(a.g) / (sum(a.h) + 1) AS value
  FROM (SELECT * FROM sided WHERE k = 0) a JOIN long b ON a.id = b.id AND b.k = (SELECT k FROM best2) GROUP BY 1
)""",
]

_TREE = f"""
SELECT CAST(node AS INT) AS node, NULL AS feature, NULL::DOUBLE AS cut, n, round(value, 6) AS value FROM leaves
UNION ALL
SELECT CAST(node AS INT), {_TREE_COLUMNS!r}[k + 1], round(cut, 6), CAST(n AS BIGINT), NULL FROM (
  SELECT 0 AS node, k, v, n FROM best1 UNION ALL SELECT side, k, v, n FROM best2) JOIN cuts USING (k, v)"""


def oracles() -> dict[str, str]:
    """The SQL of every query, each number first freed of summation noise and then rounded."""
    return {name: _without_noise(sql) for name, sql in _oracles().items()}


def _without_noise(sql: str) -> str:
    """Turn ``round(x, d)`` into ``round(round(x, d + 6), d)``."""
    out, at = [], 0
    for m in re.finditer(r"\bround\(", sql):
        if m.start() < at:
            continue
        end, depth = m.end(), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        value, digits = sql[m.end():end - 1].rsplit(",", 1)
        out += [sql[at:m.start()], f"round(round({value}, {int(digits) + 6}), {int(digits)})"]
        at = end
    return "".join(out) + sql[at:]


def _oracles() -> dict[str, str]:
    numeric = list(DEFAULT.numeric)
    order = {c: i for i, c in enumerate(_RAW, 1)}
    positions = " ".join(f"WHEN '{c}' THEN {i}" for c, i in order.items())
    first_month = f"""FROM trips WHERE {_COMPLETE}"""
    describe = _clean(_describe("cleaned", numeric, 3))
    return {
        "chosen_columns": _raw(
            f", counted AS ({_nulls('trips', _RAW)}) "
            f"SELECT CASE \"column\" {positions} END AS position, * FROM counted"),
        "trip_scan": _raw(f"SELECT {_rounded()} FROM trips"),
        "load_reconciliation": _raw(
            f", counted AS ({_nulls('trips', _RAW)}) SELECT \"column\", n_rows AS rows_left, n_null AS nulls_left, "
            "n_rows AS rows_right, n_null AS nulls_right, TRUE AS shape_match, TRUE AS nulls_match FROM counted"),
        "cleaned_sink": _clean(
            f"SELECT count(*) AS n_rows, {len(_RAW) + 6} AS n_columns, TRUE AS reload_verified FROM cleaned"),
        "mixed_files_prepared": _clean(
            "SELECT " + _rounded().replace(
                "round(airport_fee, 6)", "round(CASE WHEN payment_type % 3 <> 2 THEN airport_fee END, 6)")
            + ", CASE WHEN payment_type % 3 = 1 THEN 0.75::DOUBLE END AS cbd_congestion_fee, "
            f"round(duration_min, 6) AS duration_min, round({SPEED}, 6) AS {SPEED}, "
            "pickup_hour, pickup_dayofweek, is_weekend, is_rush_hour FROM cleaned"),
        "months_by_file": _two_months(),
        "csv_sink": describe,
        "json_sink": _clean(
            "SELECT n_rush AS n_rush_hour, n_other AS n_non_rush_hour, round(mean_rush, 3) AS mean_rush_hour, "
            "round(mean_other, 3) AS mean_non_rush_hour, round(t, 4) AS t_statistic, 0.05::DOUBLE AS alpha, "
            "abs(t) > 1.97 AS is_significant FROM welch", _SUBSET),

        "time_features": _timed(
            "SELECT tpep_pickup_datetime, tpep_dropoff_datetime, round(duration_min, 6) AS duration_min, "
            "round(average_speed_mph, 6) AS average_speed_mph, pickup_hour, pickup_dayofweek, is_weekend, is_rush_hour "
            "FROM timed"),
        "trip_months": _raw(
            "SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS month, count(*) AS n FROM trips GROUP BY 1"),
        "model_features": _model(
            "SELECT tpep_pickup_datetime, PULocationID, DOLocationID, pickup_time_group, route_id, is_friday, is_monday "
            "FROM marked"),
        "time_group_counts": _model(
            "SELECT pickup_time_group, count(*) AS n, min(pickup_hour) AS first_hour, max(pickup_hour) AS last_hour "
            "FROM marked GROUP BY 1"),
        "rush_labels": _clean(
            "SELECT CASE WHEN is_rush_hour THEN 'rush' ELSE 'non_rush' END AS label, count(*) AS n "
            "FROM cleaned GROUP BY 1"),

        "null_profile": _raw(
            f", counted AS ({_nulls('trips', _RAW)}) SELECT \"column\", n_null FROM counted WHERE n_null > 0"),
        "comissing_columns": _raw(
            f", counted AS ({_nulls('trips', _RAW)}) "
            "SELECT n_null, string_agg(\"column\", ',' ORDER BY \"column\") AS columns FROM counted "
            "WHERE n_null > 0 GROUP BY 1 HAVING count(*) >= 2"),
        "complete_trips": _raw(
            "SELECT tpep_pickup_datetime, tpep_dropoff_datetime, round(trip_distance, 6) AS trip_distance, "
            f"round(fare_amount, 6) AS fare_amount, PULocationID, DOLocationID FROM trips WHERE {_COMPLETE}"),
        "missing_audit": _raw(
            f", c AS (SELECT count(*) AS b, count(*) FILTER (WHERE {_COMPLETE}) AS a FROM trips) "
            "SELECT b AS rows_before, a AS rows_after, b - a AS rows_removed, round((b - a) / b::DOUBLE, 5) AS removed_ratio FROM c"),
        "retained_nulls": _timed(
            f", counted AS ({_nulls('timed', _RAW)}) SELECT \"column\", n_null FROM counted WHERE n_null > 0"),
        "dominant_month": _raw(
            f"SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS month, count(*) AS n {first_month} "
            "GROUP BY 1 ORDER BY n DESC, month LIMIT 1"),
        "dominant_month_rows": _clean("SELECT tpep_pickup_datetime, PULocationID, DOLocationID FROM in_month"),
        "stray_months": _clean(
            "SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS month, count(*) AS n FROM timed, target "
            "WHERE date_trunc('month', tpep_pickup_datetime) <> target.month GROUP BY 1 ORDER BY 1"),
        "outlier_funnel": _clean(f", funnel AS (SELECT {_FUNNEL} FROM in_month) {_funnel_steps(0)}"),
        "plausible_trips": _timed(
            "SELECT tpep_pickup_datetime, round(fare_amount, 6) AS fare_amount, round(trip_distance, 6) AS trip_distance, "
            "passenger_count, round(total_amount, 6) AS total_amount, round(duration_min, 6) AS duration_min, "
            f"round(average_speed_mph, 6) AS average_speed_mph FROM timed WHERE {_PLAUSIBLE}"),
        "distinct_trips": _raw(
            f", d AS (SELECT DISTINCT {', '.join(_RAW)} FROM trips) SELECT {_rounded()} FROM d"),
        "duplicate_audit": _raw(
            ", c AS (SELECT (SELECT count(*) FROM trips) AS b, (SELECT count(*) FROM (SELECT DISTINCT * FROM trips)) AS a) "
            "SELECT b AS rows_before, a AS rows_after, b - a AS duplicates_removed FROM c"),
        "duplicates_left": _clean("SELECT count(*) AS n_rows, 0::BIGINT AS n_duplicates FROM cleaned"),
        "null_split": _clean(
            f", counted AS ({_nulls('cleaned', numeric)}) SELECT \"column\", n_null, "
            "CASE WHEN \"column\" = 'passenger_count' THEN 'retained' ELSE 'unexpected' END AS status "
            "FROM counted WHERE n_null > 0"),
        "contract_check": _clean(
            f"SELECT 6 AS derived_columns, count(*) - count({SPEED}) AS null_speeds FROM cleaned"),
        "preparation_funnel": _clean(
            f""", funnel AS (SELECT {_FUNNEL} FROM in_month),
sizes AS (SELECT (SELECT count(*) FROM trips) AS n_raw, (SELECT count(*) FROM timed) AS n_full,
                 (SELECT count(*) FROM in_month) AS n_month, (SELECT r6 FROM funnel) AS n_plausible,
                 (SELECT count(*) FROM cleaned) AS n_clean),
steps AS (
  SELECT 1 AS position, 'missing' AS stage, n_raw AS rows_before, n_full AS rows_after FROM sizes
  UNION ALL SELECT 2, 'month', n_full, n_month FROM sizes
  UNION ALL SELECT step, name, rows_before, rows_after FROM ({_funnel_steps(2)})
  UNION ALL SELECT 9, 'duplicates', n_plausible, n_clean FROM sizes
  UNION ALL SELECT 10, 'all', n_raw, n_clean FROM sizes)
SELECT *, rows_before - rows_after AS rows_removed,
  round((rows_before - rows_after) / rows_before::DOUBLE, 5) AS removed_ratio FROM steps"""),
        "cleaned_trips": _clean(
            f"SELECT {_rounded()}, round(duration_min, 6) AS duration_min, round({SPEED}, 6) AS {SPEED}, "
            "pickup_hour, pickup_dayofweek, is_weekend, is_rush_hour FROM cleaned"),
        "rush_subset": _clean("SELECT n_rush, n_other FROM sides", _SUBSET),

        "describe_trips": describe,
        "describe_trips_large": describe,
        "hourly_profile": _clean(_HOURLY),
        "hourly_profile_large": _clean(_HOURLY),
        "speed_by_weekend": _clean(
            f"SELECT is_weekend, count(*) AS n, round(avg({SPEED}), 3) AS mean_speed FROM cleaned GROUP BY 1"),
        "speed_by_rush": _clean(
            f"SELECT is_rush_hour, count(*) AS n, round(avg({SPEED}), 3) AS mean_speed FROM cleaned GROUP BY 1"),
        "group_speed_rush": _clean(_group("cleaned", RUSH, SPEED, 3)),
        "group_speed_weekend": _clean(_group("cleaned", WEEKEND, SPEED, 3)),
        "group_speed_zone": _clean(_group("cleaned", "PULocationID", SPEED, 3)),
        "hourly_by_weekend": _clean(
            "SELECT pickup_hour, round(weekday_mean_speed, 3) AS weekday_mean_speed, "
            "round(weekend_mean_speed, 3) AS weekend_mean_speed FROM by_weekend", _BY_WEEKEND),
        "hourly_mean": _clean("SELECT pickup_hour, round(mean, 6) AS mean FROM by_weekend", _BY_WEEKEND),
        "day_hour_cells": _clean("SELECT * FROM cells", _CELLS),
        "day_hour_heatmap": _clean(
            "SELECT pickup_dayofweek, " + ", ".join(
                f"max(CASE WHEN pickup_hour = {h} THEN mean_speed END) AS h{h}" for h in range(24))
            + " FROM cells GROUP BY 1", _CELLS),
        "heatmap_row_means": _clean(
            "SELECT pickup_hour, round(weekday_mean, 6) AS weekday_mean, round(weekend_mean, 6) AS weekend_mean "
            "FROM row_means", _CELLS, _ROW_MEANS),
        "merged_histogram": _clean(
            f"SELECT pickup_hour, count(*) AS n_rows, count({SPEED}) AS n, round(avg({SPEED}), 6) AS mean, "
            f"round(stddev_pop({SPEED}), 6) AS std_pop, round(min({SPEED}), 6) AS min, round(max({SPEED}), 6) AS max "
            "FROM cleaned GROUP BY 1"),
        "extreme_hours_rounded": _clean(
            f"SELECT {_first_hour('hourly', 'mean_speed')} AS slowest_hour, min(mean_speed) AS slowest_speed, "
            f"{_first_hour('hourly', 'mean_speed', 'DESC')} AS fastest_hour, max(mean_speed) AS fastest_speed FROM hourly",
            f"hourly AS ({_HOURLY})"),
        "extreme_hours": _clean(
            f"SELECT {_first_hour('by_weekend', 'mean')} AS slowest_hour, round(min(mean), 6) AS slowest_speed, "
            f"{_first_hour('by_weekend', 'mean', 'DESC')} AS fastest_hour, round(max(mean), 6) AS fastest_speed "
            "FROM by_weekend", _BY_WEEKEND),
        "speed_median": _clean(f"SELECT round(median({SPEED}), 3) AS speed_median FROM cleaned"),
        "flag_shares": _clean(
            "SELECT round(avg(CAST(is_rush_hour AS INT)), 4) AS rush_share, "
            "round(avg(CAST(is_weekend AS INT)), 4) AS weekend_share FROM cleaned"),
        "correlation_matrix": _clean(_correlate("cleaned", numeric, 3)),
        "welch_test": _clean(
            "SELECT n_rush, n_other, round(mean_rush, 4) AS mean_rush, round(mean_other, 4) AS mean_other, "
            "round(t, 4) AS t, round(dof, 4) AS dof FROM welch", _SUBSET),
        "welch_by_zone": _clean(_ZONE_P, *_ZONE_TESTS).replace("WITH ", "WITH RECURSIVE ", 1),
        "rush_box_plot": _clean(
            f"SELECT CASE WHEN is_rush_hour THEN 'rush' ELSE 'non_rush' END AS label, any_value(n) AS n, "
            f"round(least(min({SPEED}), any_value(q1)), 6) AS whisker_low, round(any_value(q1), 6) AS q1, "
            f"round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3, "
            f"round(greatest(max({SPEED}), any_value(q3)), 6) AS whisker_high "
            f"FROM cleaned JOIN quart USING (is_rush_hour) "
            f"WHERE {SPEED} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY is_rush_hour", _BOX),
        "slow_threshold": _model("SELECT round(threshold, 6) AS threshold FROM slow"),
        "table_shape": _clean(f"SELECT count(*) AS n_rows, {len(_RAW) + 6} AS n_cols FROM cleaned"),

        "hourly_finding": _clean(
            "SELECT slowest_hour, round(slowest_speed, 6) AS slowest_speed, fastest_hour, "
            "round(fastest_speed, 6) AS fastest_speed, weekday_slowest, weekend_slowest, "
            "printf('The mean speed is lowest at %d:00 (%.2f mph) and highest at %d:00 (%.2f mph). On weekdays it is "
            "lowest at %d:00, on weekends at %d:00.', slowest_hour, slowest_speed, fastest_hour, fastest_speed, "
            "weekday_slowest, weekend_slowest) AS finding FROM found", _BY_WEEKEND,
            f"found AS (SELECT {_first_hour('by_weekend', 'mean')} AS slowest_hour, min(mean) AS slowest_speed, "
            f"{_first_hour('by_weekend', 'mean', 'DESC')} AS fastest_hour, max(mean) AS fastest_speed, "
            f"{_first_hour('by_weekend', 'weekday_mean_speed')} AS weekday_slowest, "
            f"{_first_hour('by_weekend', 'weekend_mean_speed')} AS weekend_slowest FROM by_weekend)"),
        "rush_finding": _clean(
            "SELECT round(r, 6) AS rush_median, round(o, 6) AS other_median, r < o AS rush_is_slower, "
            "printf('Rush hours are %s: their median is %.2f mph against %.2f mph.', "
            "CASE WHEN r < o THEN 'slower' ELSE 'not slower' END, r, o) AS finding FROM "
            "(SELECT max(median) FILTER (WHERE is_rush_hour) AS r, max(median) FILTER (WHERE NOT is_rush_hour) AS o FROM quart)",
            _BOX),
        "heat_finding": _clean(
            "SELECT a AS weekday_slow_hour, b AS weekend_slow_hour, "
            "printf('Traffic is slowest around %d:00 on weekdays and around %d:00 on weekends.', a, b) AS finding FROM "
            f"(SELECT {_first_hour('row_means', 'weekday_mean')} AS a, {_first_hour('row_means', 'weekend_mean')} AS b)",
            _CELLS, _ROW_MEANS),

        "slow_trip_target": _model(
            f"SELECT tpep_pickup_datetime, PULocationID, round({SPEED}, 6) AS {SPEED}, slow_trip FROM marked"),
        "class_shares": _model(
            "SELECT slow_trip, count(*) AS n, round(count(*) / (SELECT count(*) FROM marked)::DOUBLE, 6) AS share "
            "FROM marked GROUP BY 1"),
        "class_weights": _model(
            "SELECT slow_trip, count(*) AS n, round((SELECT count(*) FROM marked) / (2.0::DOUBLE * count(*)), 6) AS weight "
            "FROM marked GROUP BY 1"),
        "split_check": _model("SELECT slow_trip, n, n_test FROM test_rows", _TEST_ROWS),
        "leaf_boosted_trees": _model(_TREE, *_SPLITS),
        "whole_run": _clean(" UNION ALL ".join(
            f"SELECT '{stage}' AS stage, '{name}' AS name, CAST({n} AS BIGINT) AS n_rows" for stage, name, n in _STORED)),
        "boosted_trees_metrics": _model(
            "SELECT (SELECT round(threshold, 6) FROM slow) AS threshold, CAST(sum(n - n_test) AS BIGINT) AS train_rows, "
            "CAST(sum(n_test) AS BIGINT) AS test_rows, TRUE AS accuracy_adds_up, TRUE AS recall_adds_up, "
            "TRUE AS better_than_majority FROM test_rows", _TEST_ROWS),
        "boosted_trees_report": _model(
            "SELECT label, CAST(support AS BIGINT) AS support, TRUE AS figures_are_shares FROM ("
            "SELECT CAST(slow_trip AS VARCHAR) AS label, n_test AS support FROM test_rows UNION ALL "
            "SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), (SELECT sum(n_test) FROM test_rows))", _TEST_ROWS),
        "model_reload": _model(
            "SELECT CAST(sum(n_test) AS BIGINT) AS n_rows, 0::BIGINT AS n_changed FROM test_rows", _TEST_ROWS),
        "unseen_codes": _model(
            "SELECT route_id, coalesce(any_value(code), -1) AS code, count(*) AS n FROM marked "
            "LEFT JOIN learned USING (route_id) GROUP BY route_id",
            "learned AS (SELECT route_id, CAST(row_number() OVER (ORDER BY route_id) - 1 AS INT) AS code FROM "
            "(SELECT DISTINCT route_id FROM marked WHERE day(tpep_pickup_datetime) <= 24))"),
        "stored_stage": _clean(
            f"SELECT is_rush_hour, count(*) AS n, round(avg({SPEED}), 3) AS mean_speed FROM cleaned GROUP BY 1"),
        "tied_quantiles": "SELECT l_returnflag, count(l_quantity) AS n, " + ", ".join(
            f"quantile_cont(CAST(l_quantity AS DOUBLE), {p / 100}) AS p{p}" for p in (10, 30, 90, 99))
            + " FROM lineitem GROUP BY 1",
        "median_fills": _clean(" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(median({c}), 6) AS fill FROM cleaned"
            for c in ("passenger_count", "trip_distance", "tip_amount"))),
        "frequent_fills": _model(
            "SELECT \"column\", category AS fill FROM categories QUALIFY row_number() OVER "
            "(PARTITION BY \"column\" ORDER BY n DESC, sort_key, category) = 1", _CATEGORIES),
        "category_codes": _model(
            "SELECT \"column\", category, CAST(row_number() OVER "
            "(PARTITION BY \"column\" ORDER BY sort_key, category) - 1 AS INT) AS code FROM categories", _CATEGORIES),
        "rule_confusion": _model("SELECT tn, fp, fn, tp FROM confused", _CONFUSION),
        "rule_metrics": _model(
            "SELECT tn, fp, fn, tp, round(accuracy, 6) AS accuracy, round(p1, 6) AS precision, round(r1, 6) AS recall, "
            "round(f1, 6) AS f1_score FROM scores", _CONFUSION),
        "rule_report": _model(
            """SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score, support FROM (
  SELECT '0' AS label, p0 AS p, r0 AS r, f0 AS f, tn + fp AS support FROM scores
  UNION ALL SELECT '1', p1, r1, f1, fn + tp FROM scores
  UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, tn + fp + fn + tp FROM scores
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tn + fp + fn + tp FROM scores
  UNION ALL SELECT 'weighted avg', (p0 * (tn + fp) + p1 * (fn + tp)) / (tn + fp + fn + tp),
    (r0 * (tn + fp) + r1 * (fn + tp)) / (tn + fp + fn + tp), (f0 * (tn + fp) + f1 * (fn + tp)) / (tn + fp + fn + tp),
    tn + fp + fn + tp FROM scores)""", _CONFUSION),

        "describe_lineitem": _describe("lineitem", _LINE_NUMBERS, 4),
        "correlate_lineitem": _correlate("lineitem", _LINE_NUMBERS, 6),
        "price_by_flag": _group("lineitem", "l_returnflag", "l_extendedprice", 4),
        "value_by_event_type": _group("events", "event_type", "value", 4),
        "balance_by_segment": _group("customer", "c_mktsegment", "c_acctbal", 4),
        "orders_dominant_month":
            "SELECT o_orderkey, o_orderdate FROM orders WHERE strftime(o_orderdate, '%Y-%m') = (SELECT "
            "strftime(o_orderdate, '%Y-%m') AS m FROM orders GROUP BY 1 ORDER BY count(*) DESC, m LIMIT 1)",
        "orders_other_months":
            "WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1) "
            "SELECT * FROM m WHERE month <> (SELECT month FROM m ORDER BY n DESC, month LIMIT 1) ORDER BY month",
        "lineitem_duplicates":
            "SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM "
            "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey)",
        "customer_nulls": _nulls("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
    }
