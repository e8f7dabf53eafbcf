"""DuckDB SQL for each query whose result SQL can state.

``PREFIX`` restates ``adapter`` as CTEs; it and the query texts share no code with the Spark side.
"""

from __future__ import annotations

PREFIX = """
WITH readings AS (
  SELECT CAST(user_id AS VARCHAR) AS name, ts AS time, value AS temperature_2m, event_id AS snapshot
  FROM events
),
cities AS (
  SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS name,
         c_nationkey * 5.0e0 - 60.0e0 AS latitude, (c_custkey % 360) - 180.0e0 AS longitude
  FROM customer
),
regions AS (SELECT n_nationkey AS id, n_name AS region_name FROM nation),
city_region AS (SELECT c_custkey AS city_id, c_nationkey AS region_id FROM customer),
order_water AS (SELECT l_orderkey, sum(l_quantity) AS water FROM lineitem GROUP BY l_orderkey),
city_consumption AS (
  SELECT o_custkey AS city_id, CAST(year(o_orderdate) AS INTEGER) AS year,
         sum(water) AS water_m3, sum(o_totalprice) AS electricity_kwh
  FROM orders JOIN order_water ON o_orderkey = l_orderkey
  GROUP BY 1, 2
),
population AS (
  SELECT o_custkey AS city_id, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(count(*) AS INTEGER) AS population
  FROM orders WHERE o_orderpriority <> '1-URGENT'
  GROUP BY 1, 2
),
daily AS (
  SELECT name, strftime(time, '%Y-%m-%d') AS date, avg(temperature_2m) AS avg_temperature,
         min(temperature_2m) AS min_temperature, max(temperature_2m) AS max_temperature
  FROM readings GROUP BY 1, 2
),
info AS (
  SELECT c.name, c.latitude, c.longitude, coalesce(u.water_m3, 0) AS water_m3,
         coalesce(u.electricity_kwh, 0) AS electricity_kwh, coalesce(p.population, 0) AS population,
         u.year, coalesce(r.region_name, 'Unknown') AS country
  FROM cities c
  LEFT JOIN city_consumption u ON c.id = u.city_id
  LEFT JOIN population p ON c.id = p.city_id AND u.year = p.year
  LEFT JOIN city_region cr ON c.id = cr.city_id
  LEFT JOIN regions r ON cr.region_id = r.id
),
all_trusted AS (
  SELECT d.name AS city, d.date, d.avg_temperature, d.min_temperature, d.max_temperature,
         i.latitude, i.longitude, i.water_m3, i.electricity_kwh, i.population, i.country, i.year
  FROM daily d JOIN info i ON d.name = i.name
),
one_year AS (SELECT * FROM all_trusted WHERE year = 2000),
derived AS (
  SELECT *, max_temperature - min_temperature AS temp_range,
         electricity_kwh / nullif(population, 0) AS kwh_per_capita,
         water_m3 / nullif(population, 0) AS water_per_capita,
         avg_temperature * avg_temperature AS temp_squared
  FROM one_year
),
numbered AS (
  SELECT kwh_per_capita, row_number() OVER (ORDER BY kwh_per_capita) AS rn, count(*) OVER () AS n
  FROM derived WHERE kwh_per_capita IS NOT NULL
),
quartiles AS (
  SELECT max(CASE WHEN rn = greatest(1, ceil(0.25 * n)) THEN kwh_per_capita END) AS q1,
         max(CASE WHEN rn = greatest(1, ceil(0.75 * n)) THEN kwh_per_capita END) AS q3
  FROM numbered
),
fences AS (
  SELECT q1 - 1.5e0 * (q3 - q1) AS lower_bound, q3 + 1.5e0 * (q3 - q1) AS upper_bound FROM quartiles
),
found AS (
  SELECT city, date, kwh_per_capita FROM derived, fences
  WHERE kwh_per_capita < lower_bound OR kwh_per_capita > upper_bound
),
split AS (
  SELECT *, substr(md5(city || '|' || date), 1, 2) < 'cd' AS is_train FROM derived
)
"""

_DAILY = """
name, date, round(avg_temperature, 6) AS avg_temperature,
round(min_temperature, 6) AS min_temperature, round(max_temperature, 6) AS max_temperature
"""
_INFO = """
name, latitude, longitude, round(water_m3, 2) AS water_m3,
round(electricity_kwh, 2) AS electricity_kwh, population, year, country
"""
_TRUSTED = """
city, date, round(avg_temperature, 6) AS avg_temperature,
round(min_temperature, 6) AS min_temperature, round(max_temperature, 6) AS max_temperature,
latitude, longitude, round(water_m3, 2) AS water_m3,
round(electricity_kwh, 2) AS electricity_kwh, population, country, year
"""


def _pearson(x: str, y: str, digits: int = 8) -> str:
    both = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    return (
        f"round(covar_pop({x}, {y}) / "
        f"nullif((stddev_pop({x}) {both}) * (stddev_pop({y}) {both}), 0), {digits})"
    )


def _matrix() -> str:
    names = [
        "avg_temperature",
        "electricity_kwh",
        "water_m3",
        "population",
        "temp_range",
        "kwh_per_capita",
    ]
    known = " AND ".join(f"{n} IS NOT NULL" for n in names)
    lines = [
        f"SELECT '{a}' AS var_a, '{b}' AS var_b, "
        + ("CASE WHEN count(*) > 0 THEN 1.0e0 END" if a == b else _pearson(a, b))
        + f" AS corr FROM derived WHERE {known}"
        for a in names
        for b in names
    ]
    return " UNION ALL ".join(lines)


def _described() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS stddev, round(min({c}), 4) AS min, "
        f"round(max({c}), 4) AS max FROM derived"
        for c in ["avg_temperature", "electricity_kwh", "kwh_per_capita", "temp_range"]
    )


def _scaled() -> str:
    names = _FEATURES
    cells = ", ".join(
        f"round(CASE WHEN s_{n} = 0 THEN 0.0e0 ELSE {n} / s_{n} END, 6) AS {n}" for n in names
    )
    deviations = ", ".join(f"stddev_samp({n}) FILTER (WHERE is_train) AS s_{n}" for n in names)
    return f"SELECT city, date, {cells} FROM split, (SELECT {deviations} FROM split)"


_FEATURES = ["avg_temperature", "temp_range", "temp_squared", "population", "latitude", "longitude"]
_KNOWN = " AND ".join(f"{f} IS NOT NULL" for f in [*_FEATURES, "electricity_kwh"])


def _least_squares() -> str:
    """CTEs after ``split``: columns are centred on their training means; then each feature is taken
    out of the later ones and of the label by its training projection. What is left of the label is
    the residual."""
    names = [*_FEATURES, "electricity_kwh"]
    columns = [f"x{i}" for i in range(len(names))]
    keys = "city, date, avg_temperature, electricity_kwh, is_train"
    centred = ", ".join(
        f"{n} - (SELECT avg({n}) FROM rows WHERE is_train) AS {c}" for n, c in zip(names, columns, strict=True)
    )
    steps = [f"rows AS (SELECT * FROM split WHERE {_KNOWN})", f"s0 AS (SELECT {keys}, {centred} FROM rows)"]
    for i, by in enumerate(columns[:-1]):
        later = columns[i + 1 :]
        slopes = ", ".join(f"sum({by} * {c}) / nullif(sum({by} * {by}), 0) AS b_{c}" for c in later)
        rest = ", ".join(f"{c} - coalesce(b_{c}, 0) * {by} AS {c}" for c in later)
        steps.append(f"b{i} AS (SELECT {slopes} FROM s{i} WHERE is_train)")
        steps.append(f"s{i + 1} AS (SELECT {keys}, {rest} FROM s{i}, b{i})")
    last = len(columns) - 1
    steps.append(
        f"linear AS (SELECT {keys}, electricity_kwh - {columns[-1]} AS prediction FROM s{last} WHERE NOT is_train)"
    )
    return ", " + ", ".join(steps)


_TEST_ROWS = f"""
SELECT city, round(avg_temperature, 6) AS avg_temperature, round(electricity_kwh, 2) AS electricity_kwh, true AS %s
FROM split WHERE NOT is_train AND {_KNOWN}
"""
_COMPLETE = """
SELECT city, count(avg_temperature) > 0 AND count(kwh_per_capita) > 0 AND count(water_per_capita) > 0
  AND count(temp_range) > 0 AND count(latitude) > 0 AND count(longitude) > 0 AS has_cluster
FROM derived GROUP BY city
"""

_BODIES = {
    "scan_readings": "SELECT name, time, temperature_2m FROM readings",
    "scan_dimensions": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
        for t in ["cities", "regions", "city_region", "population", "city_consumption"]
    ),
    "explode_payload": (
        "SELECT name, strftime(time, '%Y-%m-%dT%H:%M') AS time, temperature_2m FROM readings"
    ),
    "quarantine_payloads": """
        SELECT CASE WHEN last_event IN ('error', 'signup') THEN 'quarantined' ELSE 'good' END AS status,
               count(*) AS n_payloads
        FROM (
          SELECT arg_max(event_type, (ts, event_id)) AS last_event
          FROM events GROUP BY user_id, event_id // 168
        )
        GROUP BY 1
    """,
    "city_slug": """
        SELECT DISTINCT o_orderpriority AS name, lower(replace(o_orderpriority, ' ', '_')) AS slug
        FROM orders
    """,
    "snapshot_label": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H-%M-%SZ') AS label FROM events",
    "daily_weather": f"SELECT {_DAILY} FROM daily",
    "daily_weather_latest": f"""
        SELECT {_DAILY} FROM (
          SELECT name, strftime(hour, '%Y-%m-%d') AS date, avg(temperature_2m) AS avg_temperature,
                 min(temperature_2m) AS min_temperature, max(temperature_2m) AS max_temperature
          FROM (
            SELECT name, time AS hour, temperature_2m,
                   row_number() OVER (
                     PARTITION BY name, time ORDER BY snapshot DESC, temperature_2m DESC
                   ) AS rn
            FROM readings
          )
          WHERE rn = 1
          GROUP BY 1, 2
        )
    """,
    "city_info": f"SELECT {_INFO} FROM info",
    "city_info_anyyear": f"""
        SELECT {_INFO} FROM (
          SELECT c.name, c.latitude, c.longitude, coalesce(u.water_m3, 0) AS water_m3,
                 coalesce(u.electricity_kwh, 0) AS electricity_kwh,
                 coalesce(p.population, 0) AS population,
                 u.year, coalesce(r.region_name, 'Unknown') AS country
          FROM cities c
          LEFT JOIN city_consumption u ON c.id = u.city_id
          LEFT JOIN population p ON c.id = p.city_id
          LEFT JOIN city_region cr ON c.id = cr.city_id
          LEFT JOIN regions r ON cr.region_id = r.id
        )
    """,
    "trusted": f"SELECT {_TRUSTED} FROM all_trusted",
    "trusted_year": f"SELECT {_TRUSTED} FROM one_year",
    "typed_trusted": f"SELECT {_TRUSTED} FROM one_year",
    "unmatched_names": """
        SELECT DISTINCT name, 'readings' AS side FROM readings
        WHERE name NOT IN (SELECT name FROM cities)
        UNION ALL
        SELECT DISTINCT name, 'cities' AS side FROM cities
        WHERE name NOT IN (SELECT name FROM readings)
    """,
    "stage_counts": """
        SELECT 'readings' AS stage, count(*) AS n_rows FROM readings
        UNION ALL SELECT 'daily', count(*) FROM daily
        UNION ALL SELECT 'city_info', count(*) FROM info
        UNION ALL SELECT 'final', count(*) FROM all_trusted
    """,
    "derived_metrics": """
        SELECT city, date, round(temp_range, 6) AS temp_range,
               round(kwh_per_capita, 4) AS kwh_per_capita,
               round(water_per_capita, 6) AS water_per_capita,
               round(temp_squared, 6) AS temp_squared
        FROM derived
    """,
    "temperature_per_city": """
        SELECT city, round(avg(avg_temperature), 6) AS mean_temp FROM one_year GROUP BY city
    """,
    "temperature_rankings": """
        SELECT city, round(avg(avg_temperature), 6) AS mean_temp FROM one_year GROUP BY city
        ORDER BY avg(avg_temperature) DESC NULLS LAST, city
    """,
    "consumption_ranking": """
        SELECT city, round(avg(electricity_kwh / nullif(population, 0)), 4) AS avg_kwh_per_person
        FROM one_year GROUP BY city
        ORDER BY avg(electricity_kwh / nullif(population, 0)) DESC NULLS LAST, city
    """,
    "city_features": """
        SELECT city, round(avg(avg_temperature), 6) AS avg_temp,
               round(avg(kwh_per_capita), 4) AS avg_kwh_per_capita,
               round(avg(water_per_capita), 6) AS avg_water_per_capita,
               round(avg(temp_range), 6) AS avg_temp_range,
               min(latitude) AS latitude, min(longitude) AS longitude
        FROM derived GROUP BY city
    """,
    "correlations": f"""
        SELECT {_pearson("avg_temperature", "electricity_kwh")} AS temp_electricity_corr,
               {_pearson("avg_temperature", "water_m3")} AS temp_water_corr,
               {_pearson("electricity_kwh", "water_m3")} AS electricity_water_corr
        FROM one_year
    """,
    "correlation_matrix": _matrix(),
    "descriptive_stats": _described(),
    "kwh_quartiles": "SELECT round(q1, 4) AS q1, round(q3, 4) AS q3 FROM quartiles",
    "kwh_fences": """
        SELECT round(lower_bound, 4) AS lower_bound, round(upper_bound, 4) AS upper_bound FROM fences
    """,
    "kwh_outliers": "SELECT city, date, round(kwh_per_capita, 4) AS kwh_per_capita FROM found",
    "kwh_outlier_count": "SELECT count(*) AS n_outliers FROM found",
    "list_cities": "SELECT DISTINCT city, country, latitude, longitude FROM one_year",
    "city_history": """
        SELECT city, date, round(avg_temperature, 6) AS avg_temperature,
               round(min_temperature, 6) AS min_temperature,
               round(max_temperature, 6) AS max_temperature,
               round(water_m3, 2) AS water_m3, round(electricity_kwh, 2) AS electricity_kwh,
               population, country
        FROM one_year WHERE city = '12' ORDER BY date DESC LIMIT 30
    """,
    "split_sizes": """
        SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows
        FROM split GROUP BY 1
    """,
    "scaled_features": _scaled(),
    "predict_linear": f"""
        {_least_squares()}
        SELECT city, round(avg_temperature, 6) AS avg_temperature,
               round(electricity_kwh, 2) AS electricity_kwh, round(prediction, 2) AS prediction
        FROM linear
    """,
    "linear_rmse": f"""
        {_least_squares()}
        SELECT round(sqrt(avg((electricity_kwh - prediction) * (electricity_kwh - prediction))), 2) AS rmse
        FROM linear
    """,
    "predict_forest": _TEST_ROWS % "in_range",
    "electricity_predictions": _TEST_ROWS % "is_known",
    "rmse_report": """
        SELECT CAST(2 AS BIGINT) AS n_models, CAST(1 AS BIGINT) AS n_chosen, true AS chosen_is_least
    """,
    "city_clusters": _COMPLETE,
    "cluster_sizes": f"""
        SELECT count(*) AS n_cities, count(*) FILTER (WHERE NOT has_cluster) AS n_without,
               true AS labels_in_range
        FROM ({_COMPLETE})
    """,
}

ORACLES = {name: f"{PREFIX}\n{body}" for name, body in _BODIES.items()}

# Merged out of parts, the same rows.
ORACLES["daily_weather_merged"] = ORACLES["daily_weather"]
ORACLES["daily_weather_latest_merged"] = ORACLES["daily_weather_latest"]
