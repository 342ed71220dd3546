import csv
import json

import numpy as np
from pyspark.sql import functions as F

from cinderspark import cli
from cinderspark.plans import risk
from cinderspark.sources import sinks


def inputs(spark, tmp_path):
    rng = np.random.default_rng(42)
    rows = []
    for y in range(24):
        for x in range(30):
            bp = 0.0 if rng.random() < 0.2 else 0.001 + 0.01 * float(np.exp(-((y - 12) ** 2 + (x - 15) ** 2) / 100))
            rows.append((y, x, bp, bp * 1.2, 0.1, 5.0, [0.125] * 8))
    df = spark.createDataFrame(rows, "iy int, ix int, bp_2011_riley double, bp_2047_riley double, rps_scott double, crps_scott double, distribution array<double>")
    df.drop("distribution").write.parquet(str(tmp_path / "pixels"))
    df.select("iy", "ix", "distribution").write.parquet(str(tmp_path / "wind"))
    step = 0.001
    homes = [(f"0{1 + i % 3}00{1 + i % 2}{100000 + i % 5}{1000 + i}", -120 + float(rng.uniform(0, 29)) * step, 35 + float(rng.uniform(0, 23)) * step) for i in range(200)]
    spark.createDataFrame(homes, "GEOID string, lon double, lat double").write.parquet(str(tmp_path / "homes"))
    return risk.Settings(str(tmp_path / "pixels"), str(tmp_path / "wind"), str(tmp_path / "homes"), str(tmp_path / "out"), step, 35.0, -120.0, 24, 30, 10, 16, 9)


def test_whole_run(spark, tmp_path):
    s = inputs(spark, tmp_path)
    done = risk.run_all(spark, s, str(tmp_path / "files"), pyramid=True)
    assert len(done) == 9 and risk.process_regions(spark, s) == []
    homes = spark.read.parquet(s.path("regions"))
    assert homes.count() == 200 and set(risk.VARIABLES) <= set(homes.columns)
    odd = homes.where(F.abs(F.col("rps_2011") - F.col("bp_2011") * F.col("crps_scott")) > 1e-7)
    assert odd.count() == 0
    nation = json.loads((tmp_path / "files" / "nation.geojson").read_text())
    assert nation["features"][0]["properties"]["building_count"] == 200
    assert sum(nation["features"][0]["properties"]["rps_2011_score_hist"]) == 200
    assert (tmp_path / "files" / "state.csv").read_text().startswith("# license: \n# level: state\nGEOID,")
    assert spark.read.parquet(s.path("buildings")).select("state_fips").distinct().count() == 3
    assert spark.read.parquet(s.path("pyramid")).where("level = 0").count() == 720
    assert sinks.processed(spark, s.path("ledger")).count() == 9


def test_one_region_reads_its_pixels_only(spark, tmp_path):
    """Pixels beyond the region's reach do not matter, and a filter on them reaches the scan."""
    from dataclasses import replace

    s = replace(inputs(spark, tmp_path), window=3)
    whole = replace(s, output=str(tmp_path / "whole"))
    risk.process_regions(spark, whole)
    margin = risk.raster.reach(s.cell_degrees, s.window)
    near = risk.near_regions(s, ["y0_x0"], margin)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = spark.read.parquet(s.pixels).where(near)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [" in plan and f"LessThanOrEqual(ix,{9 + margin})" in plan
    spoilt = spark.read.parquet(s.pixels).withColumn("bp_2011_riley", F.when(near, F.col("bp_2011_riley")).otherwise(1e6))
    assert spoilt.where("bp_2011_riley = 1e6").count() > 0
    spoilt.write.parquet(str(tmp_path / "spoilt"))
    one = replace(s, pixels=str(tmp_path / "spoilt"), output=str(tmp_path / "one"))
    assert risk.process_regions(spark, one, ["y0_x0"]) == ["y0_x0"]
    rows = lambda x: sorted((r["GEOID"], round(r["rps_2011"], 9)) for r in spark.read.parquet(x.path("regions")).where("region_id = 'y0_x0'").collect())
    assert rows(one) == rows(whole) and len(rows(one)) > 5
    assert spark.read.parquet(one.path("regions")).where("region_id <> 'y0_x0'").count() == 0


def test_boxes_of_regions(spark):
    s = risk.Settings(chunk=10)
    condition = str(risk.near_regions(s, ["y0_x0", "y0_x1", "y1_x0", "y1_x1", "y2_x5", "y2_x7"], 2))
    assert condition.count("iy") == 6  # three boxes, two bounds each


def test_statistics_by_polygon(spark, tmp_path):
    from dataclasses import replace

    from cinderspark.functions import geo

    s = replace(inputs(spark, tmp_path), polygons=str(tmp_path / "areas"), join_degrees=0.01)
    west, east, all_ = geo.box(-121, 34, -119.9855, 36), geo.box(-119.9855, 34, -119, 36), geo.box(-121, 34, -119, 36)
    rows = [("nation", "US", "Everything", None, all_), ("state", "01", "West", "WE", west), ("state", "02", "East", "EA", east), ("state", "03", "Nowhere", "NO", geo.box(0, 0, 1, 1))]
    spark.createDataFrame(rows, "level string, GEOID string, NAME string, STUSPS string, geometry binary").write.parquet(s.polygons)
    risk.process_regions(spark, s)
    risk.aggregate(spark, s)
    risk.write_analysis(spark, s, str(tmp_path / "files"), levels=("nation", "state"))
    states = json.loads((tmp_path / "files" / "state.geojson").read_text())["features"]
    assert [f["properties"]["NAME"] for f in states] == ["West", "East"] and {f["geometry"]["type"] for f in states} == {"Polygon"}
    assert sum(f["properties"]["building_count"] for f in states) == 200
    homes = spark.read.parquet(s.path("regions")).where("lon < -119.9855")
    assert states[0]["properties"]["building_count"] == homes.count() and states[0]["properties"]["STUSPS"] == "WE"
    row = next(csv.DictReader((tmp_path / "files" / "nation.csv").read_text().splitlines()[2:]))
    assert row["NAME"] == "Everything" and float(row["longitude"]) == -120 and row["building_count"] == "200"


def test_command_line(monkeypatch):
    monkeypatch.setenv("CINDERSPARK_NY", "12")
    monkeypatch.setenv("CINDERSPARK_OUTPUT", "/somewhere/")
    s = risk.Settings.from_environment()
    assert s.ny == 12 and s.path("x") == "/somewhere/x" and s.grid().ny == 12
    assert cli.parser().parse_args(["process-regions", "y0_x1", "--overwrite"]).regions == ["y0_x1"]
