"""Registered queries against their SQL on tables whose keys go beyond those of the small ones."""

import os

import duckdb
import pytest

from rastrum.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture
def con():
    return duckdb.connect()


def plain(rows):
    return sorted(repr([None if v is None else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r]) for r in rows)


def both(spark, con, folder, name):
    """Rows of the query and of its SQL."""
    for f in os.listdir(folder):
        con.execute(f"CREATE OR REPLACE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{f}'")
    df = registry.queries()[name](spark, str(folder))
    return plain(df.collect()), plain(con.sql(f"SELECT {', '.join(df.columns)} FROM ({registry.oracle_sql()[name]})").fetchall())


def test_composition_beyond_the_pole(spark, con, tmp_path):
    # Tiles so far north that the lattice comes down on the other side, where cells have negative degrees.
    con.execute(f"COPY (SELECT vec_id + 6000 + 50 * k AS vec_id, embedding FROM '{SF}/embeddings.parquet', range(0, 40) r(k) WHERE vec_id < 50) TO '{tmp_path}/embeddings.parquet'")
    got, want = both(spark, con, tmp_path, "compose_by_owner")
    assert got == want and 0 < len(want) < 400


@pytest.mark.parametrize("n", [52, 53, 58])
def test_masks_of_a_last_tile_that_lacks_a_part(spark, con, tmp_path, n):
    con.execute(f"COPY (FROM '{SF}/embeddings.parquet' WHERE vec_id < {n}) TO '{tmp_path}/embeddings.parquet'")
    got, want = both(spark, con, tmp_path, "two_waves")
    assert got == want and len(want) == 80


def test_equal_requests_are_decided_once(spark, con, tmp_path, monkeypatch):
    from rastrum.operators import choice

    con.execute(f"COPY (FROM '{SF}/embeddings.parquet') TO '{tmp_path}/embeddings.parquet'")
    con.execute(f"COPY (SELECT c_custkey % 7 + 143 * c_custkey AS c_custkey FROM '{SF}/customer.parquet') TO '{tmp_path}/customer.parquet'")
    seen, decided = [], choice.decided
    monkeypatch.setattr(choice, "decided", lambda requests, *a: seen.append(requests.count()) or decided(requests, *a))
    got, want = both(spark, con, tmp_path, "mosaic_decisions")
    assert got == want and seen == [7] and len(got) > 100


def test_a_turn_of_many_files_is_one_micro_batch(spark, tmp_path):
    from rastrum.streaming import completion

    parts = spark.range(20).selectExpr("id % 4 AS tile_id", "'a' AS scene_id", "timestamp'2024-06-01' AS at", "array(1, 2) AS px")
    parts.repartition(5).write.parquet(f"{tmp_path}/in")
    told = completion.run(spark, f"{tmp_path}/in", f"{tmp_path}/run", parts.schema)
    assert told.count() == 4 and len([f for f in os.listdir(f"{tmp_path}/run/checkpoint/commits") if f.isdigit()]) <= 2


def test_polygons_are_drawn_once_for_both_rules(spark, con, tmp_path):
    for t in ("customer", "embeddings"):
        con.execute(f"COPY (FROM '{SF}/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
    got, want = both(spark, con, tmp_path, "clip_by_polygons")
    plan = registry.queries()["clip_by_polygons"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    # Drawing and cutting, no task for each polygon and row of tiles.
    assert got == want and len(got) > 100 and plan.count("MapInArrow") == 2 and "FlatMapGroupsInArrow" not in plan


def test_a_month_in_one_place_is_split_over_tasks(spark):
    from rastrum.sources import store

    tiles = spark.range(300_000).selectExpr("'2024-06-01' AS date", "10.0 AS res", "'B' AS band", "0L AS x", "0L AS y", "sha2(string(id), 512) AS data").repartition(8)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "4MB")
    try:
        assert store.sorted_rows(tiles).rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset(size)
