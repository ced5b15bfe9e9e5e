"""Tile, pixel, scene and sensor views derived from the plain tables; one text for Spark and, with VARCHAR for STRING, for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OBS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS band,
  concat(substr(CAST(l_shipdate AS STRING), 1, 7), '-01') AS date,
  CAST(l_partkey % 4 AS BIGINT) AS x, CAST(l_suppkey % 5 AS BIGINT) AS y,
  concat('EPSG:', CAST(32635 + l_linenumber % 3 AS STRING)) AS crs, CAST(10.0 AS DOUBLE) AS res, 7 AS tile_px,
  CAST(-170 + 90 * (l_partkey % 4) AS DOUBLE) AS west,
  CAST(CASE WHEN l_partkey % 4 = 3 THEN -160 ELSE -70 + 90 * (l_partkey % 4) END AS DOUBLE) AS east,
  CAST(-50 + 20 * (l_suppkey % 5) AS DOUBLE) AS south, CAST(-25 + 20 * (l_suppkey % 5) AS DOUBLE) AS north,
  CASE WHEN l_tax = 0 THEN NULL ELSE CAST(round(l_discount * 100) AS DOUBLE) END AS cloud_pct,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE concat('scene_', CAST(l_orderkey % 7 AS STRING)) END AS scene_id,
  CAST(floor(l_extendedprice) AS BIGINT) AS size_bytes, CAST(l_orderkey % 1000 AS BIGINT) AS fetched_at,
  CASE WHEN l_linestatus = 'O' THEN concat('orbit_', CAST(l_suppkey % 2 AS STRING)) END AS acq,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS valid_px
FROM lineitem"""

SCENES = """SELECT o_orderkey, concat('MOD.A', substr(CAST(o_orderdate AS STRING), 1, 7), '.h', lpad(CAST(o_custkey % 6 AS STRING), 2, '0'), 'v', lpad(CAST(o_orderkey % 4 AS STRING), 2, '0'), '.061.', lpad(CAST(o_orderkey AS STRING), 10, '0')) AS id,
  CAST(o_custkey % 6 AS BIGINT) AS h, CAST(o_orderkey % 4 AS BIGINT) AS v,
  substr(CAST(o_orderdate AS STRING), 1, 10) AS start_date, substr(CAST(o_orderdate + INTERVAL '7' DAY AS STRING), 1, 10) AS end_date,
  CAST(o_orderkey % 101 AS DOUBLE) AS cloud_cover, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'prelim' END AS kind, o_orderpriority AS tier
FROM orders"""

SENSORS = """SELECT event_id, event_type AS band, CAST(user_id * 0.05 AS DOUBLE) AS lon, CAST((user_id % 37) * 0.1 AS DOUBLE) AS lat, ts, CAST(round(value * 100) AS BIGINT) AS cents FROM events"""

AOI = """SELECT c_custkey, CAST(c_custkey % 3600 AS DOUBLE) / 10 - 180 AS lon, CAST(c_custkey % 1600 AS DOUBLE) / 10 - 80 AS lat FROM customer"""

_PX = """SELECT vec_id, CAST(floor(vec_id / 5.0) AS BIGINT) AS tile_id, concat('scene_', CAST(vec_id % 5 AS STRING)) AS scene_id, CAST(pos AS INTEGER) AS pos,
  CASE WHEN floor(CAST(v AS DOUBLE) * 100) < -10 THEN -9999 ELSE CAST(floor(CAST(v AS DOUBLE) * 100) AS INTEGER) END AS dn
FROM {source}"""
PX_SPARK = _PX.format(source="embeddings LATERAL VIEW posexplode(embedding) e AS pos, v")
PX_DUCK = _PX.format(source="(SELECT vec_id, i - 1 AS pos, embedding[i] AS v FROM embeddings, range(1, 65) r(i))").replace("STRING", "VARCHAR")

_TABLES = {"obs": ("lineitem", OBS), "scenes": ("orders", SCENES), "sensors": ("events", SENSORS), "aoi_pts": ("customer", AOI), "px": ("embeddings", PX_SPARK)}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, sql = _TABLES[name]
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/{base}.parquet")
    return spark.sql(sql.replace(f"FROM {base}", "FROM {base}"), base=table)


def duck(*names: str) -> str:
    """CTEs of these views for DuckDB, without the closing query."""
    return "WITH " + ", ".join(f"{n} AS ({PX_DUCK if n == 'px' else _TABLES[n][1].replace('STRING', 'VARCHAR')})" for n in names)
