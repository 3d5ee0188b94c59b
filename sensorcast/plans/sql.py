"""Shared SQL fragments of the DuckDB oracle (the same stand-in mapping as
``sources.testdata``, written independently in SQL)."""


def readings_cte(series: str = "user_id % 3", name: str = "r", where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT event_id AS "ID", CAST({series} AS BIGINT) AS series_id, ts AS utc,
         CASE WHEN event_type = 'click' THEN value END AS ts,
         CASE WHEN event_type = 'view'  THEN value END AS hr,
         CASE WHEN event_type = 'error' THEN value END AS qfe
  FROM events WHERE {where})"""


def hourly_cte(src: str = "r", name: str = "h", unit: str = "hour") -> str:
    return f"""{name} AS (
  SELECT series_id, date_trunc('{unit}', utc) AS utc, avg(ts) AS ts, avg(hr) AS hr, avg(qfe) AS qfe
  FROM {src} GROUP BY series_id, date_trunc('{unit}', utc))"""


def grid_cte(src: str = "h", name: str = "g", step: str = "1 HOUR") -> str:
    return f"""{name}_b AS (SELECT series_id, min(utc) AS lo, max(utc) AS hi FROM {src} GROUP BY series_id),
{name}_t AS (SELECT series_id, unnest(generate_series(lo, hi, INTERVAL {step})) AS utc FROM {name}_b),
{name} AS (
  SELECT t.series_id, t.utc, row_number() OVER (PARTITION BY t.series_id ORDER BY t.utc) - 1 AS pos,
         {src}.ts, {src}.hr, {src}.qfe
  FROM {name}_t t LEFT JOIN {src} ON t.series_id = {src}.series_id AND t.utc = {src}.utc)"""


def interp_cte(src: str = "g", name: str = "i", values=("ts", "hr", "qfe")) -> str:
    parts = []
    for v in values:
        w = "PARTITION BY series_id ORDER BY pos"
        parts.append(f"""last_value({v} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {v}_pv,
         last_value(CASE WHEN {v} IS NOT NULL THEN pos END IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {v}_pp,
         first_value({v} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {v}_nv,
         first_value(CASE WHEN {v} IS NOT NULL THEN pos END IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {v}_np""")
    fills = []
    for v in values:
        fills.append(f"""CASE WHEN {v} IS NOT NULL THEN {v} WHEN {v}_pp IS NULL THEN NULL WHEN {v}_np IS NULL THEN {v}_pv
              ELSE {v}_pv + ({v}_nv - {v}_pv) * CAST(pos - {v}_pp AS DOUBLE) / CAST({v}_np - {v}_pp AS DOUBLE) END AS {v}""")
    return f"""{name}_w AS (SELECT series_id, utc, pos, {', '.join(values)},
         {','.join(parts)}
  FROM {src}),
{name} AS (SELECT series_id, utc, pos, {', '.join(fills)} FROM {name}_w)"""


def hourly_table_sql(series: str = "user_id % 3", p: str = "", where: str = "TRUE",
                     raw: str | None = None) -> str:
    """WITH-list of the regularised hourly table ``{p}i`` (readings ``{p}r``)."""
    parts = [] if raw else [readings_cte(series, f"{p}r", where)]
    src = raw or f"{p}r"
    return ",\n".join(parts + [hourly_cte(src, f"{p}h"), grid_cte(f"{p}h", f"{p}g"),
                                interp_cte(f"{p}g", f"{p}i")])


def r6(cols) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


def cols(prefix: str, names) -> str:
    return ", ".join(f"{prefix}.{n}" for n in names)
