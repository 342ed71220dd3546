import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderspark.functions import geo
from cinderspark.functions import scalar as S
from cinderspark.operators import grid, regional, stats, weather
from cinderspark.sources import readers, sinks
from cinderspark.sources.catalog import Catalog, Dataset
from cinderspark.streaming import incremental


def test_catalog(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", geo.box(0, 0, 1, 1)), ("b", None)], "name string, geometry binary").write.parquet(path)
    cat = Catalog([Dataset("Places", path), Dataset("two", path, version="v9"), Dataset("two", path, version="v10"), Dataset("grid", path, "pixels")])
    assert cat.get("places", case_sensitive=False).name == "Places" and len(list(cat)) == 4 and "Places" in repr(cat)
    assert cat.get("two", latest=True).version == "v10" and cat.get("two", version="v9").version == "v9"
    with pytest.raises(ValueError):
        cat.get("two")
    for wrong in ({"name": "none"}, {"name": "two", "version": "v1"}):
        with pytest.raises(KeyError):
            cat.get(**wrong)
    assert cat.get("Places").query(spark, "SELECT count(*) AS n FROM {source}").first()["n"] == 2
    assert {r["geometry_wkt"] for r in cat.get("Places").features(spark).collect()} == {None, "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"}
    with pytest.raises(ValueError):
        cat.get("grid").query(spark)
    with pytest.raises(ValueError):
        cat.get("Places").pixels(spark)
    with pytest.raises(ValueError):
        Dataset("x", "y", "zip")


def test_readers(spark, tmp_path):
    (tmp_path / "codes.csv").write_text("AL,01,001,Autauga\nCA,06,037,Los Angeles\n")
    rows = readers.headerless_csv(spark, str(tmp_path / "codes.csv"), ["state", "s", "c", "county"]).collect()
    assert [(r["s"], r["c"]) for r in rows] == [("01", "001"), ("06", "037")]
    (tmp_path / "points.csv").write_text("X,Y,n\n1.5,2.5,7\n")
    assert geo.to_wkt(bytes(readers.csv_points(spark, str(tmp_path / "points.csv")).first()["geometry"])) == "POINT (1.5 2.5)"
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, None)], "a double, b double")
    assert sorted(map(tuple, readers.nan_to_null(df).collect()), key=str) == [(2.0, None), (None, 1.0)]
    sizes = readers.folder_sizes(spark, str(tmp_path)).first()
    assert sizes["files"] == 2 and sizes["bytes"] > 40


def test_partitions_keep_leading_zeros(spark, tmp_path):
    path = str(tmp_path / "hive")
    df = regional.partition_keys(spark.createDataFrame([("06037000001", 1.0), ("01001000002", 2.0)], "GEOID string, v double"))
    sinks.write_partitioned(df, path, ["state_fips", "county_fips"])
    back = readers.hive_partitions(spark, path).where("state_fips = '06' and county_fips = '037'")
    assert [(r["GEOID"], r["state_fips"]) for r in back.collect()] == [("06037000001", "06")]
    assert "PartitionFilters: [isnotnull(state_fips" in back._jdf.queryExecution().toString()
    sinks.write_common_metadata(df, path, ["state_fips", "county_fips"], {"license": "CC0"})
    import pyarrow.parquet as pq

    meta = pq.read_schema(f"{path}/_common_metadata")
    assert meta.names == ["GEOID", "v"] and meta.metadata[b"license"] == b"CC0"


def test_text_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, [1, 2], geo.from_wkt("POINT (1 2)")), ("b", None, [], None)], "GEOID string, v double, h array<int>, geometry binary").coalesce(1)
    assert sinks.write_geojson(df, str(tmp_path / "x.geojson"), {"source": "test"}) == 2
    doc = json.loads((tmp_path / "x.geojson").read_text())
    assert doc["metadata"] == {"source": "test"} and doc["features"][0]["geometry"]["coordinates"] == [1.0, 2.0]
    assert doc["features"][1]["properties"] == {"GEOID": "b", "v": None, "h": []} and doc["features"][1]["geometry"] is None
    assert sinks.write_csv(df, str(tmp_path / "x.csv"), {"license": "CC0"}) == 2
    assert (tmp_path / "x.csv").read_text().splitlines() == ["# license: CC0", "GEOID,v,h", 'a,1.0,"[1,2]"', "b,,[]"]
    sinks.write_ndjson(df, str(tmp_path / "nd"))
    assert sorted(json.loads(r["value"])["properties"]["GEOID"] for r in spark.read.text(str(tmp_path / "nd")).collect()) == ["a", "b"]
    sinks.write_consolidated(sinks.with_covering(df), str(tmp_path / "one"), 1)
    assert spark.read.parquet(str(tmp_path / "one")).where("bbox.xmin = 1").count() == 1


def test_regions_are_written_once(spark, tmp_path):
    table, ledger = str(tmp_path / "t"), str(tmp_path / "l")
    assert sinks.processed(spark, ledger).count() == 0
    df = spark.createDataFrame([("y0_x1", 1), ("y0_x2", 2)], "region_id string, v int")
    for _ in range(2):
        assert sinks.write_regions(df, table, ledger) == ["y0_x1", "y0_x2"]
    sinks.write_regions(df.where("v = 1").withColumn("v", F.lit(9)), table, ledger)
    assert sorted((r["region_id"], r["v"]) for r in spark.read.parquet(table).collect()) == [("y0_x1", 9), ("y0_x2", 2)]
    assert sinks.processed(spark, ledger).count() == 2


def test_stream_of_regions(spark, tmp_path):
    inbox, table, ledger, check = (str(tmp_path / x) for x in ("in", "t", "l", "c"))
    schema = "region_id string, v int"
    spark.createDataFrame([("y0_x1", 1)], schema).write.mode("append").parquet(inbox)
    incremental.region_stream(spark, schema, inbox, table, ledger, check).awaitTermination()
    spark.createDataFrame([("y0_x2", 2)], schema).write.mode("append").parquet(inbox)
    incremental.region_stream(spark, schema, inbox, table, ledger, check).awaitTermination()
    assert spark.read.parquet(table).count() == 2 and sinks.processed(spark, ledger).count() == 2


def test_stream_of_hours(spark, tmp_path):
    rows = [(1, "2024-01-01 01:00:00", 10.0), (1, "2024-01-01 02:00:00", 95.0), (1, "2024-01-03 02:00:00", 95.0)]
    df = spark.createDataFrame(rows, "pixel int, t string, degrees double").select("pixel", F.to_timestamp("t").alias("ts"), "degrees")
    df.write.parquet(str(tmp_path / "in"))
    stream = incremental.hourly_direction_counts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r["day"].day, r["n_n"], r["n_e"]) for r in spark.table("hours").collect())
    want = sorted((r["day"].day, r["n_n"], r["n_e"]) for r in incremental.hourly_direction_counts(df).collect())
    assert got == want == [(1, 1, 1), (3, 0, 1)]


GRID = grid.Grid(ny=40, nx=58, cy=6, cx=5, lat0=24.0, lon0=-125.0, dlat=0.1, dlon=0.1)


def test_grid(spark):
    assert GRID.shape == (7, 12) and grid.regions(spark, GRID).count() == 84
    assert GRID.chunk_slice(6, 11) == (range(36, 40), range(55, 58))
    with pytest.raises(ValueError, match="Invalid chunk ID"):
        GRID.chunk_slice(7, 0)
    assert GRID.corner(0, 0) == pytest.approx((-125.05, 23.95))
    ids = grid.regions(spark, GRID).select("region_id", *[c.alias(n) for c, n in zip(S.parse_region_id("region_id"), ("py", "px"), strict=True)], "iy", "ix")
    assert ids.where("py = iy and px = ix").count() == 84


def test_region_selection(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "region_id string")
    status = grid.region_status(ids("a", "b", "c"), ids("a", "b"), ids("b"))
    assert grid.select_regions(status) == ["a"]
    done = grid.region_status(ids("b", "z"), ids("a", "b"), ids("b"))
    with pytest.raises(ValueError, match="'z'.*'b'"):
        grid.select_regions(done)
    assert grid.select_regions(done, allow_all_processed=True) == []


def test_select_box_errors(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "lon double, lat double")
    for wrong in ({}, {"bbox": (0, 0, 1, 1), "point": (0, 0)}):
        with pytest.raises(ValueError):
            grid.select_box(df, **wrong)
    assert grid.select_box(df, point=(5.0, 5.0), tolerance=1.0).count() == 0


def slow_tau(x, y):
    n = len(x)
    s = sum(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i in range(n) for j in range(i))
    m = min(len(set(x)), len(set(y)))
    return 2 * s / (n * n * (m - 1) / m), s


@pytest.mark.parametrize("seed", range(5))
def test_tau_c(seed):
    rng = np.random.default_rng(seed)
    x, y = rng.integers(0, 6, 70).astype(float), rng.integers(0, 9, 70).astype(float)
    tau, s = stats.tau_c(x, y)
    want, want_s = slow_tau(x, y)
    assert s == want_s and tau == pytest.approx(want)
    assert 0 <= stats.tau_c_p_value(x, y, s) <= 1
    assert np.isnan(stats.tau_c(np.ones(5), y[:5])[0])


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 200, 1000])
def test_inversions(n):
    y = np.random.default_rng(n).integers(0, 20, n).astype(float)
    assert stats._inversions(y) == sum(int((y[:j] > y[j]).sum()) for j in range(n))


def test_negative_probability(spark):
    good = regional.validate_probabilities(spark.createDataFrame([([0.5, 0.5],), ([0.5, 0.2],)], "p array<double>"), "p")
    assert sorted(r["sums_to_one"] for r in good.collect()) == [False, True]
    with pytest.raises(Exception, match="negative probability"):
        regional.validate_probabilities(spark.createDataFrame([([-0.5, 1.5],)], "p array<double>"), "p").collect()


def test_score_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.01,), (0.02,), (100.0,), (200.0,)], "v float")
    right = [r[0] for r in df.select(S.risk_score("v")).collect()]
    left = [r[0] for r in df.select(S.risk_score("v", "left")).collect()]
    assert right == [0, 1, 2, 10, None] and left == [0, 2, 3, 10, 10]
    assert df.select(S.score_histogram("v").alias("h")).first()["h"] == [1, 1, 1, 0, 0, 0, 0, 0, 0, 0, 1]
    assert spark.range(1).select(S.resize(F.array(F.lit(1)), 3, F.lit(0)).alias("a")).first()["a"] == [1, 0, 0]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "GEOID string, v float")
    assert regional.regional_statistics(none, "GEOID", ["v"], ["v"]).count() == 0
    hours = spark.createDataFrame([], "pixel int, degrees double, ffwi double")
    assert weather.fire_weather_distribution(hours, ["pixel"], "degrees", "ffwi").count() == 0
