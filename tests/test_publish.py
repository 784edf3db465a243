"""Publish: versioned replace, rerun-safe snapshots, audit, CSV scan."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from lienlake.sinks.publish import Lake
from lienlake.sources import files

D = dt.date


def test_replace_makes_new_version_current(spark, scratch):
    lake = Lake(spark, scratch)
    lake.publish_replace(spark.createDataFrame([(1,)], "x int"), "gold", "t")
    first = lake.current_path("gold", "t")
    # the new version may be computed from the current one (self-read is safe)
    lake.publish_replace(lake.read("gold", "t").selectExpr("x + 1 AS x"), "gold", "t")
    assert lake.current_path("gold", "t") != first
    assert [r["x"] for r in lake.read("gold", "t").collect()] == [2]
    assert [r["x"] for r in spark.read.parquet(first).collect()] == [1]
    with pytest.raises(FileExistsError):
        lake.publish_create(spark.createDataFrame([(1,)], "x int"), "gold", "t")


def test_snapshot_rerun_and_other_as_of_untouched(spark, scratch):
    lake = Lake(spark, scratch)
    day1 = spark.createDataFrame([(1, D(2024, 1, 4)), (2, D(2024, 1, 4))], "id int, as_of_date date")
    day2 = spark.createDataFrame([(1, D(2024, 1, 5))], "id int, as_of_date date")
    lake.publish_snapshot(day1, "gold", "f")
    lake.publish_snapshot(day2, "gold", "f")
    lake.publish_snapshot(day2, "gold", "f")     # rerun of the same as_of
    rows = sorted((r["id"], str(r["as_of_date"])) for r in lake.read_snapshot("gold", "f").collect())
    assert rows == [(1, "2024-01-04"), (1, "2024-01-05"), (2, "2024-01-04")]
    assert lake.read_snapshot("gold", "f", D(2024, 1, 5)).count() == 1
    audit = lake.audit().collect()
    assert len(audit) == 3 and {r["row_count"] for r in audit} == {1, 2}


def test_csv_round_trip_keeps_leading_zeros(spark, scratch):
    df = spark.createDataFrame([("012345", 1.5), ("000001", 2.0)], "pincode string, v double")
    files.write_csv(df, f"{scratch}/c")
    schema = T.StructType([T.StructField("pincode", T.StringType()), T.StructField("v", T.DoubleType())])
    back = sorted(tuple(r) for r in files.read_csv(spark, f"{scratch}/c", schema).collect())
    assert back == [("000001", 2.0), ("012345", 1.5)]


def test_csv_permissive_keeps_corrupt_rows(spark, scratch):
    import os
    from lienlake.session import local_path
    d = local_path(f"{scratch}/bad")
    os.makedirs(d)
    with open(f"{d}/x.csv", "w") as f:
        f.write("id,v\n1,2.5\n2,notanumber\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.DoubleType())])
    rows = files.read_csv(spark, f"{scratch}/bad", schema, mode="PERMISSIVE", keep_corrupt=True).collect()
    bad = [r for r in rows if r[files.CORRUPT_COL] is not None]
    assert len(rows) == 2 and len(bad) == 1 and bad[0]["v"] is None
    with pytest.raises(Exception):
        files.read_csv(spark, f"{scratch}/bad", schema, mode="FAILFAST").collect()


def test_catalog_table_is_repointed(spark, scratch):
    lake = Lake(spark, scratch, use_catalog=True)
    name = "t_" + scratch.rsplit("/", 2)[-2][:8]
    lake.publish_replace(spark.createDataFrame([(1,)], "x int"), "gold", name)
    lake.publish_replace(spark.createDataFrame([(2,), (3,)], "x int"), "gold", name)
    assert lake.exists("gold", name)
    assert sorted(r["x"] for r in spark.table(f"gold.{name}").collect()) == [2, 3]


def test_seed_files_land_as_concurrent_jobs(spark, local_dir, scratch):
    import threading

    from lienlake.sources import seeds
    for name in seeds.SEEDS:
        with open(f"{local_dir}/{name}.csv", "w") as f:
            f.write(",".join(seeds.columns_of(name)) + "\n" + "x" * 3 + "," * (len(seeds.columns_of(name)) - 1) + "\n")
    threads = set()

    class Watched(Lake):
        def publish_replace(self, *args, **kwargs):
            threads.add(threading.get_ident())
            return super().publish_replace(*args, **kwargs)

    lake = Watched(spark, scratch, autoflush=False)
    seeds.land_seeds(spark, local_dir, lake)
    assert len(threads) > 1
    assert {name: lake.read("bronze", name).count() for name in seeds.SEEDS} == dict.fromkeys(seeds.SEEDS, 1)


def test_published_tables_are_zstd_files(spark, scratch):
    from lienlake.session import local_path
    import glob
    import pyarrow.parquet as pq

    path = Lake(spark, scratch).publish_replace(spark.range(1000), "silver", "t")
    files = glob.glob(f"{local_path(path)}/*.parquet")
    assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files if pq.ParquetFile(f).metadata.num_rows)


def test_seed_files_and_staged_lines_are_compressed(spark, scratch, monkeypatch):
    """Parts of a seed file are compressed and of bounded length, staged lines have the published tables' codec; rows land as written."""
    import glob
    import pyarrow.parquet as pq

    from lienlake.plans import seed_queries
    from lienlake.session import local_path
    from lienlake.sources import seeds

    monkeypatch.setattr(seed_queries, "PART_LINES", 10)
    staged = []
    monkeypatch.setattr(seeds, "remove_dir", lambda spark, path: staged.append(path))
    ids = spark.range(25).coalesce(1).selectExpr("concat('00', id) AS first")
    rest = lambda name: [f"CAST(NULL AS string) AS {c}" for c in seeds.columns_of(name)[1:]]
    frames = {name: ids.selectExpr(f"first AS {seeds.columns_of(name)[0]}", *rest(name)) for name in seeds.SEEDS}
    frames["loans"] = frames["loans"].selectExpr("* EXCEPT (outstanding)", "if(loan_id = '007', 'n/a', '1.5') AS outstanding").select(*seeds.columns_of("loans"))
    seed_queries.write_seeds(frames, f"{scratch}/seeds")
    for name in seeds.SEEDS:
        parts = glob.glob(f"{local_path(scratch)}/seeds/{name}.csv/part-*")
        assert len(parts) == 3 and all(p.endswith(".csv.gz") for p in parts)
    lake = Lake(spark, f"{scratch}/lake", autoflush=False)
    seeds.land_seeds(spark, f"{scratch}/seeds", lake)
    files = [f for s in staged for f in glob.glob(f"{local_path(s)}/*.parquet")]
    assert len(staged) == len(seeds.SEEDS) and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)
    assert {name: lake.read("bronze", name).count() for name in seeds.SEEDS} == dict.fromkeys(seeds.SEEDS, 25) | {"loans": 24}
    assert [r["line"][:4] for r in lake.read("bronze", "loans_rejected").collect()] == ["007,"]
    assert sorted(r[0] for r in lake.read("bronze", "schemes").select("scheme_code").collect()) == sorted(f"00{i}" for i in range(25))
