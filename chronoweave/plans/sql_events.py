"""DuckDB oracle SQL for the events adapter (independent re-statement of the
Spark plans with ASOF JOINs and plain window functions)."""
from __future__ import annotations

from ..sources.driver_tables import (EVENT_STEP_US as STEP, EVENT_TAU_US as TAU,
                                     EVENT_TOL_US as TOL, HOLD_DEVICES, SYNC_EVENT)

DAY = "'day_' || strftime(ts, '%Y%m%d')"
ONE = "'events'"
_HOLD = ", ".join(f"'{d}'" for d in HOLD_DEVICES)
K = ["session_id", "device_id", "stream_id"]


def on(a, b, keys=K):
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def ctes(session=DAY, step=STEP, tol=TOL, device="event_type", pre="") -> str:
    """WITH-list: ev, payload, streams, meta, bounds, grid, gclock, al, sl, feat
    (names prefixed with ``pre`` so two versions can live in one query)."""
    body = _ctes(session, step, tol, device)
    if pre:
        names = ["ev", "payload", "streams", "meta", "bounds", "grid", "sync", "gclock", "sg",
                 "nb2", "nb", "al", "sl", "feat"]
        body = _prefix(body, names, pre)
    return body


def _prefix(body: str, names, pre: str) -> str:
    """Rename CTE definitions and their FROM/JOIN references."""
    import re
    for n in sorted(names, key=len, reverse=True):
        body = re.sub(rf"(?m)^{n} AS \(", f"{pre}{n} AS (", body)
        body = re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {pre}{n}", body)
    return body


def _ctes(session, step, tol, device) -> str:
    return f"""
ev AS (SELECT {session} AS session_id, {device} AS device_id, 'value' AS stream_id, event_id,
              epoch_us(ts) AS t_us,
              [value::FLOAT, json_extract_string(props, '$.k')::FLOAT] AS value
       FROM events),
payload AS (SELECT session_id, device_id, stream_id,
                   row_number() OVER (PARTITION BY session_id, device_id, stream_id
                                      ORDER BY t_us, event_id) - 1 AS "row", t_us, value
            FROM ev),
streams AS (SELECT DISTINCT session_id, device_id, stream_id, 'event_value' AS payload_kind,
                   'arb' AS units,
                   CASE WHEN device_id IN ({_HOLD}) THEN 'hold' ELSE 'continuous' END AS kernel,
                   [2] AS shape, 2 AS width, NULL::VARCHAR AS topology_ref,
                   NULL::VARCHAR AS topology_hash
            FROM ev),
meta AS (SELECT DISTINCT session_id, 'events_utc' AS reference_clock_id,
                1e6 / {step} AS grid_rate_hz, 0.0::DOUBLE AS sync_resid_us,
                NULL::VARCHAR AS sync_verdict, '1.0' AS schema_version FROM ev),
bounds AS (SELECT session_id, min(t_us) AS lo, max(t_us) AS hi FROM ev GROUP BY session_id),
grid AS (SELECT session_id, frame_index, lo + frame_index * {step} AS t_ref_us
         FROM (SELECT session_id, lo, unnest(range(0, (hi - lo) // {step} + 1)) AS frame_index
               FROM bounds)),
sync AS (SELECT session_id, t_us FROM ev WHERE device_id = '{SYNC_EVENT}'),
gclock AS (SELECT g.session_id, g.frame_index, g.t_ref_us,
                  coalesce(exp(-(least(g.t_ref_us - b.t_us, f.t_us - g.t_ref_us))::DOUBLE / {TAU}),
                           1.0) AS conf_clock
           FROM grid g
           ASOF LEFT JOIN sync b ON g.session_id = b.session_id AND g.t_ref_us >= b.t_us
           ASOF LEFT JOIN sync f ON g.session_id = f.session_id AND g.t_ref_us < f.t_us),
sg AS (SELECT c.*, s.device_id, s.stream_id, s.kernel FROM gclock c JOIN streams s USING (session_id)),
nb AS (SELECT sg.*, b."row" AS src_row, b.t_us AS src_t, f."row" AS nxt_row, f.t_us AS nxt_t
       FROM sg AS sg
       ASOF LEFT JOIN payload b ON {on('sg', 'b')} AND sg.t_ref_us >= b.t_us
       ASOF LEFT JOIN payload f ON {on('sg', 'f')} AND sg.t_ref_us < f.t_us),
nb2 AS (SELECT *, t_ref_us - src_t AS back,
               least(t_ref_us - src_t, coalesce(nxt_t - t_ref_us, t_ref_us - src_t)) AS gap
        FROM nb),
al AS (SELECT session_id, device_id, stream_id, frame_index, t_ref_us, kernel,
              coalesce(src_row, -1) AS source_index, coalesce(nxt_row, -1) AS next_index,
              CASE WHEN src_t IS NOT NULL AND nxt_t IS NOT NULL
                   THEN (back::DOUBLE / (nxt_t - src_t)::DOUBLE)::FLOAT ELSE 0::FLOAT END AS weight,
              (src_t IS NOT NULL AND gap <= {tol}) AS valid,
              1.0::DOUBLE AS conf_source, conf_clock,
              CASE WHEN src_t IS NOT NULL AND gap <= {tol}
                   THEN greatest(0.0, least(1.0, 1.0 - gap::DOUBLE / {tol}.0)) ELSE 0.0 END AS conf_interp
       FROM nb2),
sl AS (SELECT al.session_id, al.device_id, al.stream_id, al.frame_index, al.t_ref_us, al.kernel,
              CASE WHEN a.value IS NULL THEN list_transform(range(2), lambda x: 'NaN'::FLOAT)
                   WHEN al.kernel = 'continuous' AND b.value IS NOT NULL
                   THEN list_transform(range(1, len(a.value) + 1),
                        lambda i: (a.value[i] * (1::FLOAT - al.weight) + b.value[i] * al.weight)::FLOAT)
                   ELSE a.value END AS value,
              al.valid,
              greatest(0.0, least(1.0, al.conf_source * al.conf_clock * al.conf_interp)) AS confidence,
              al.conf_source, al.conf_clock, al.conf_interp
       FROM al AS al
       LEFT JOIN payload a ON {on('al', 'a')} AND a."row" = al.source_index
                           AND al.valid AND al.source_index >= 0
       LEFT JOIN payload b ON {on('al', 'b')} AND b."row" = al.next_index AND al.valid
                           AND al.source_index >= 0 AND al.kernel = 'continuous'
                           AND al.next_index >= 0),
feat AS (SELECT s.*, CASE WHEN count(*) OVER (PARTITION BY session_id, stream_id) = 1
                          THEN stream_id ELSE device_id || '.' || stream_id END AS feature
         FROM streams s)"""


def with_(body: str, session=DAY, **kw) -> str:
    return "WITH " + ctes(session, **kw) + "\n" + body


def with_more(extra_ctes: str, body: str, session=DAY, **kw) -> str:
    """Base CTEs, then ``extra_ctes`` (comma-separated, no leading comma)."""
    return "WITH " + ctes(session, **kw) + ",\n" + extra_ctes + "\n" + body
