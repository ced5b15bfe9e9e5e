"""Registered streaming queries, with SQL over all their rows at once."""

from __future__ import annotations

from rastrum.plans.registry import _RESOLVED, query_of
from rastrum.streaming import completion, ingest, markers, upsert

_MONTHS = "m AS (SELECT event_id, user_id, event_type, ts + to_months(CAST(event_id % 3 * (user_id % 2) AS INTEGER)) AS ts FROM events)"
query_of(f"WITH {_MONTHS} SELECT event_id, user_id, event_type, ts, strftime(ts, '%Y-%m') AS ym FROM m QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1", name="stream_upsert")(upsert.query)

query_of("SELECT event_type AS band, time_bucket(INTERVAL '15 minutes', ts) AS t, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ALL", name="stream_rates")(upsert.rates_query)

# Pixels are filled by the first scene that has them; a tile is complete at the last of these scenes, and told no more.
query_of(""", f AS (SELECT tile_id, pos, min(vec_id) FILTER (dn <> -9999) AS vec_id, arg_min(dn, vec_id) FILTER (dn <> -9999) AS dn FROM px GROUP BY ALL),
  s AS (SELECT tile_id, count(DISTINCT vec_id) AS parts, max(vec_id) AS last FROM px GROUP BY ALL),
  t AS (SELECT tile_id, count(*) FILTER (dn IS NULL) AS missing, max(vec_id) AS filled_by, sum(coalesce(dn, -9999) * (pos + 1)) AS digest FROM f GROUP BY ALL)
  SELECT tile_id, CASE WHEN missing = 0 THEN 'complete' ELSE 'abandoned' END AS status, CAST(CASE WHEN missing = 0 THEN (SELECT count(DISTINCT vec_id) FROM px WHERE px.tile_id = t.tile_id AND px.vec_id <= t.filled_by) ELSE parts END AS INTEGER) AS parts,
  CAST(missing AS INTEGER) AS missing, concat('scene_', CASE WHEN missing = 0 THEN filled_by ELSE last END % 5) AS last_scene, CAST(digest AS BIGINT) AS digest FROM t JOIN s USING (tile_id)""", "px", name="stream_completion")(completion.query)

query_of("""SELECT v.user_id, v.event_id AS step, v.ts, CASE WHEN min(m.ts) IS NULL THEN 'left over' ELSE 'released' END AS status, arg_min(m.event_id, (m.ts, m.event_id)) AS marker, min(m.ts) AS m_ts
  FROM events v LEFT JOIN events m ON m.event_type = 'signup' AND m.user_id = v.user_id AND m.ts >= v.ts AND m.ts <= v.ts + INTERVAL 12 HOUR
  WHERE v.event_type = 'view' GROUP BY ALL""", name="stream_markers")(markers.query)

query_of(f", {_RESOLVED} SELECT band, substr(date, 1, 7) AS month, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS bytes, max(fetched_at) AS newest FROM resolved GROUP BY ALL", "obs", name="stream_ingest")(ingest.query)
