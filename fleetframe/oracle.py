"""The views and queries of the registry in DuckDB SQL."""

from __future__ import annotations

CTES = {
    "tele": """
        SELECT CAST(9000000 + user_id AS VARCHAR) AS imo, event_type AS signal,
               date_trunc('day', ts) AS signal_timestamp,
               CASE WHEN value < 10 THEN NULL ELSE value END AS signal_value,
               strftime(ts, '%Y/%m/%d/%H/%M') AS loaddate, event_id
        FROM events""",
    "tele_hour": """
        SELECT CAST(9000000 + user_id AS VARCHAR) AS imo, event_type AS signal,
               date_trunc('hour', ts) AS signal_timestamp,
               CASE WHEN value < 10 THEN NULL ELSE value END AS signal_value,
               strftime(ts, '%Y/%m/%d/%H/%M') AS loaddate, event_id
        FROM events""",
    "tele_runs": """
        SELECT CAST(9000000 + user_id AS VARCHAR) AS imo, event_type AS signal,
               date_trunc('day', ts) AS signal_timestamp,
               CASE WHEN value < 10 THEN NULL ELSE value END AS signal_value,
               strftime(ts, '%Y/%m/%d/%H/%M') AS loaddate, event_id,
               CAST(ts AS DATE) AS run_date, date_trunc('hour', ts) AS run_ts
        FROM events""",
    "catalog": """
        SELECT DISTINCT CAST(9000000 + user_id AS VARCHAR) AS imo, event_type AS signal,
               CASE WHEN event_type = 'error' THEN NULL
                    WHEN user_id % 7 = 0 THEN upper(event_type) || ' (alt)'
                    ELSE upper(event_type) END AS friendly_name
        FROM events""",
    "tagged": """
        SELECT CAST(9000000 + user_id AS VARCHAR) AS imo, event_type AS signal,
               CASE WHEN event_type = 'error' THEN NULL
                    WHEN user_id % 7 = 0 THEN upper(event_type) || ' (alt)'
                    ELSE upper(event_type) END AS friendly_name,
               date_trunc('day', ts) AS signal_timestamp, value AS signal_value,
               strftime(ts, '%Y/%m/%d/%H/%M') AS loaddate, event_id, ts,
               CAST(event_id % 3 AS INTEGER) AS tag_rank,
               CASE event_id % 3 WHEN 0 THEN 'hist' WHEN 1 THEN 'today' ELSE 'new' END AS tag
        FROM events WHERE value >= 10""",
    "measured": "SELECT * FROM tele WHERE signal_value IS NOT NULL",
    "latest": """
        SELECT * FROM measured QUALIFY row_number() OVER (
            PARTITION BY imo, signal, signal_timestamp ORDER BY loaddate DESC, event_id DESC) = 1""",
    "cells": """
        SELECT * FROM tele_hour QUALIFY row_number() OVER (
            PARTITION BY imo, signal, signal_timestamp ORDER BY loaddate DESC, event_id DESC) = 1""",
    "payload_cells": """
        SELECT imo, signal, signal_timestamp, signal_value, substr(loaddate, 1, 10) || '/00/00' AS loaddate
        FROM cells""",
    "payload_keys": "SELECT DISTINCT imo, loaddate FROM payload_cells",
    "classified": """
        SELECT imo, loaddate, CASE substr(loaddate, 10, 1) WHEN '1' THEN 'error' WHEN '2' THEN 'empty'
               WHEN '3' THEN 'corrupt' ELSE 'ok' END AS status
        FROM payload_keys""",
    "winners": """
        SELECT * FROM tagged QUALIFY row_number() OVER (
            PARTITION BY imo, signal_timestamp, friendly_name ORDER BY tag_rank, ts, event_id) = 1""",
    "nulls": "SELECT * FROM tele WHERE signal_value IS NULL",
    "wide": """
        SELECT CAST(9000000 + l_suppkey % 10 AS VARCHAR) AS imo,
               'sig_' || CAST((l_partkey * 2 + r.reading) % 218 AS VARCHAR) AS signal,
               TIMESTAMP '2024-01-01' + CAST((l_orderkey % 1150) * 5 AS INTEGER) * INTERVAL 1 MINUTE AS signal_timestamp,
               CASE r.reading WHEN 0 THEN l_quantity ELSE l_extendedprice END AS signal_value,
               strftime(TIMESTAMP '2024-01-01' + l_linenumber * INTERVAL 1 HOUR, '%Y/%m/%d/%H/%M') AS loaddate,
               l_orderkey * 16 + l_linenumber * 2 + r.reading AS event_id
        FROM lineitem, (VALUES (0), (1)) AS r(reading)
        WHERE CASE r.reading WHEN 0 THEN l_quantity ELSE l_extendedprice END >= 5""",
    "wide_latest": """
        SELECT * FROM wide QUALIFY row_number() OVER (PARTITION BY imo, signal, signal_timestamp
            ORDER BY loaddate DESC, event_id DESC, signal_value DESC) = 1""",
    "ships": """
        SELECT CAST(9000000 + c_custkey AS VARCHAR) AS imo,
               CASE c_mktsegment WHEN 'MACHINERY' THEN true WHEN 'BUILDING' THEN false
                    ELSE c_acctbal >= 0 END AS is_active,
               CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'BUILDING') THEN c_acctbal >= 0 END AS active,
               c_custkey, c_name, c_mktsegment, c_acctbal, n_name, r_name, '2024/01/31/00/00' AS loaddate
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "signals": """
        SELECT imo, signal, friendly_name, CAST(NULL AS VARCHAR) AS unit, upper(substr(signal, 1, 3)) AS object_code,
               'N-' || signal AS name_code, 'events' AS group_name, signal || '-' || substr(imo, 7, 1) AS sub_group,
               '2024/01/31/00/00' AS loaddate
        FROM catalog""",
}

NEEDS = {
    "measured": ["tele"],
    "latest": ["measured"],
    "nulls": ["tele"],
    "cells": ["tele_hour"],
    "payload_cells": ["cells"],
    "payload_keys": ["payload_cells"],
    "classified": ["payload_keys"],
    "winners": ["tagged"],
    "signals": ["catalog"],
    "wide_latest": ["wide"],
}


def with_views(query: str, *names: str) -> str:
    """`query` with the named views (and those they need) in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return query.strip()
    ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered)
    extra = query.strip()
    if extra.upper().startswith("WITH "):
        return f"WITH {ctes},\n{extra[5:]}"
    return f"WITH {ctes}\n{extra}"


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
WIDE_SIGNALS = sorted(f"sig_{i}" for i in range(218))


def pivot_columns(signals: list[str]) -> str:
    return ", ".join(f"max(signal_value) FILTER (signal = '{s}') AS {s}" for s in signals)


def gaps(days: int, source: str = "nulls") -> str:
    """Gap intervals; the loaddate is that of the interval's last point."""
    return f"""
        WITH p AS (SELECT imo, signal, signal_timestamp AS t, max(loaddate) AS loaddate
                   FROM {source} GROUP BY ALL),
        f AS (SELECT *, CASE WHEN t - lag(t) OVER w > INTERVAL {days} DAY THEN 1 ELSE 0 END AS opens
              FROM p WINDOW w AS (PARTITION BY imo, signal ORDER BY t)),
        g AS (SELECT *, sum(opens) OVER (PARTITION BY imo, signal ORDER BY t) AS island FROM f)
        SELECT imo, signal, min(t) AS gap_start, max(t) AS gap_end, max_by(loaddate, t) AS loaddate
        FROM g GROUP BY imo, signal, island"""


def merge(target: str, source: str, keys: list[str], columns: list[str]) -> str:
    """Upsert of `source` into `target`."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    names = ", ".join(columns)
    return f"""
        SELECT {names} FROM ({target}) t WHERE NOT EXISTS (SELECT 1 FROM ({source}) s WHERE {on})
        UNION ALL SELECT {names} FROM ({source}) s"""
