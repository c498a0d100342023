"""Independent SQL oracles (DuckDB dialect) for the registered queries.

They are written the plain-SQL way on purpose — latest value with
``row_number()``, joins as joins, periods with the "hour minus row number"
island trick — so they check the Spark plans rather than restate them.
``arg_max`` is avoided: it skips NULL values, while "latest" must keep a
newer NULL.
"""

from __future__ import annotations

from shoreline.sources.weather import CITY_NAMES, SUNRISE_BASE_MIN, SUNSET_BASE_MIN

_CITY_CASE = "CASE user_id % 5 " + " ".join(
    f"WHEN {i} THEN '{name}'" for i, name in enumerate(CITY_NAMES)) + " END"

BASE_CTES = f"""
base AS (
  SELECT event_id AS off, user_id % 5 AS ci, {_CITY_CASE} AS local,
         date_trunc('hour', ts) AS hora, date_trunc('day', ts) AS dia,
         TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         event_type, value
  FROM events),
temperature AS (SELECT off, local, hora, 15 + value / 5.0 AS temperatura FROM base),
precipitation AS (
  SELECT off, local, hora, CAST(k AS DOUBLE) AS pp FROM base WHERE event_type <> 'signup'),
uv_index AS (
  SELECT off, local, hora,
         CASE WHEN off % 17 = 0 THEN NULL ELSE CAST(off * 37 % 110 AS DOUBLE) / 10.0 END AS uv_index
  FROM base WHERE event_type <> 'purchase'),
sunrise AS (
  SELECT off, local, dia + to_minutes(CAST({SUNRISE_BASE_MIN} + 5 * ci + off % 3 AS BIGINT)) AS hora
  FROM base),
sunset AS (
  SELECT off, local, dia + to_minutes(CAST({SUNSET_BASE_MIN} + 5 * ci + off % 3 AS BIGINT)) AS hora
  FROM base),
lt AS (SELECT local, hora, temperatura, off FROM (
  SELECT *, row_number() OVER (PARTITION BY local, hora ORDER BY off DESC) AS rn FROM temperature)
  WHERE rn = 1),
lp AS (SELECT local, hora, pp, off FROM (
  SELECT *, row_number() OVER (PARTITION BY local, hora ORDER BY off DESC) AS rn FROM precipitation)
  WHERE rn = 1),
lu AS (SELECT local, hora, uv_index, off FROM (
  SELECT *, row_number() OVER (PARTITION BY local, hora ORDER BY off DESC) AS rn FROM uv_index)
  WHERE rn = 1),
lr AS (SELECT local, dia, hora, off FROM (
  SELECT local, CAST(hora AS DATE) AS dia, hora, off,
         row_number() OVER (PARTITION BY local, CAST(hora AS DATE) ORDER BY off DESC) AS rn
  FROM sunrise) WHERE rn = 1),
ls AS (SELECT local, dia, hora, off FROM (
  SELECT local, CAST(hora AS DATE) AS dia, hora, off,
         row_number() OVER (PARTITION BY local, CAST(hora AS DATE) ORDER BY off DESC) AS rn
  FROM sunset) WHERE rn = 1),
sun_hour AS (
  SELECT lr.local, lr.dia, lr.hora AS sunrise, ls.hora AS sunset
  FROM lr JOIN ls ON lr.local = ls.local AND lr.dia = ls.dia),
joined AS (
  SELECT lt.local, lt.hora, lt.temperatura, lp.pp, lu.uv_index AS uv
  FROM lt JOIN lp ON lt.local = lp.local AND lt.hora = lp.hora
          JOIN lu ON lt.local = lu.local AND lt.hora = lu.hora),
filtered AS (
  SELECT * FROM joined
  WHERE local IS NOT NULL AND temperatura IS NOT NULL AND pp IS NOT NULL AND uv IS NOT NULL),
hour_sun AS (
  SELECT f.local, f.hora, f.temperatura, f.pp, f.uv, s.dia, s.sunrise, s.sunset
  FROM filtered f JOIN sun_hour s ON f.local = s.local AND CAST(f.hora AS DATE) = s.dia),
beach_hour AS (
  SELECT local, hora, temperatura, pp, uv,
         (hora > sunrise AND hora < sunset) AS isDay,
         (temperatura > 20 AND uv < 5 AND pp < 30) AS boaHora,
         dia
  FROM hour_sun),
good AS (SELECT * FROM beach_hour WHERE boaHora),
islands AS (
  SELECT local, dia, isDay, boaHora, hora,
         hora - to_hours(row_number() OVER (PARTITION BY local, dia, isDay, boaHora ORDER BY hora))
           AS grp,
         count(*) OVER (PARTITION BY local, dia, isDay, boaHora) AS gn,
         max(hora) OVER (PARTITION BY local, dia, isDay, boaHora) AS gmax
  FROM good),
periods AS (
  SELECT local, dia, isDay, boaHora, min(hora) AS inicio, max(hora) AS last,
         any_value(gn) AS gn, any_value(gmax) AS gmax
  FROM islands GROUP BY local, dia, isDay, boaHora, grp),
beach_day AS (
  SELECT local, dia, isDay, boaHora, inicio, last + INTERVAL 59 MINUTE AS fim FROM periods),
beach_day_compat AS (
  SELECT local, dia, isDay, boaHora, inicio, last + INTERVAL 59 MINUTE AS fim FROM periods
  WHERE NOT (gn > 1 AND inicio = last AND inicio = gmax)),
beach_day_view AS (
  SELECT local, isDay, boaHora, strftime(dia, '%Y-%m-%d') AS dia,
         strftime(inicio, '%Y-%m-%dT%H:%M') AS inicio, strftime(fim, '%Y-%m-%dT%H:59') AS fim
  FROM beach_day),
beach_hour_view AS (
  SELECT local, boaHora, isDay, CAST(temperatura AS VARCHAR) AS temperatura,
         CAST(pp AS VARCHAR) AS pp, CAST(uv AS VARCHAR) AS uv,
         strftime(hora, '%Y-%m-%dT%H:%M') AS hora
  FROM beach_hour)
"""


# The same CTEs with one "city" per user (the widened key space of scale runs).
WIDE_BASE_CTES = BASE_CTES.replace(
    f"{_CITY_CASE} AS local", f"concat_ws('#', {_CITY_CASE}, CAST(user_id AS VARCHAR)) AS local", 1)


def with_base(body: str, wide: bool = False) -> str:
    return "WITH " + (WIDE_BASE_CTES if wide else BASE_CTES).strip() + "\n" + body.strip()
