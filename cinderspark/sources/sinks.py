"""Writers: partitioned tables, features as JSON, CSV with a header comment, and a ledger."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.functions import geo


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite") -> None:
    """Hive layout, zstd; only the partitions at hand are replaced. Hot keys are split by AQE's rebalance."""
    df.hint("rebalance", *keys).write.mode(mode).option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_consolidated(df: DataFrame, path: str, files: int | None = None) -> None:
    """One table from many inputs; as many files as asked for, else as AQE sees fit."""
    out = df.repartition(files) if files else df.hint("rebalance")
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)


def with_covering(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """The covering ``bbox`` struct beside the WKB, for row-group pruning by nested field."""
    return df.withColumn("bbox", geo.bbox_udf(F.col(geometry)))


def features(df: DataFrame, geometry: str = "geometry", properties: Sequence[str] | None = None) -> DataFrame:
    """One text column: a GeoJSON feature for each row; null properties are kept."""
    names = list(properties) if properties is not None else [c for c in df.columns if c != geometry]
    inner = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    shape = F.coalesce(geo.geojson_udf(F.col(geometry)), F.lit("null"))
    return df.select(F.concat(F.lit('{"type":"Feature","properties":'), inner, F.lit(',"geometry":'), shape, F.lit("}")).alias("value"))


def write_ndjson(df: DataFrame, path: str, geometry: str = "geometry", properties: Sequence[str] | None = None) -> None:
    """Newline-delimited features, the input of tile makers, written by all executors."""
    features(df, geometry, properties).write.mode("overwrite").text(path)


def write_geojson(df: DataFrame, path: str, metadata: Mapping[str, object] | None = None, geometry: str = "geometry") -> int:
    """One FeatureCollection in a local file, row by row: for the small aggregated tables."""
    n = 0
    with open(path, "w", encoding="utf-8") as out:
        out.write('{"type":"FeatureCollection","metadata":' + json.dumps(dict(metadata or {})) + ',"features":[')
        for row in features(df, geometry).toLocalIterator():
            out.write(("," if n else "") + row["value"])
            n += 1
        out.write("]}")
    return n


def write_csv(df: DataFrame, path: str, metadata: Mapping[str, object] | None = None, drop: Sequence[str] = ("geometry", "longitude", "latitude")) -> int:
    """``# key: value`` lines, then CSV: for the small aggregated tables. Arrays are JSON text."""
    import csv

    kinds = dict(df.dtypes)
    names = [c for c in df.columns if c not in drop]
    flat = df.select(*[F.to_json(c).alias(c) if kinds[c].startswith(("array", "struct", "map")) else F.col(c) for c in names])
    n = 0
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.writelines(f"# {k}: {v}\n" for k, v in (metadata or {}).items())
        writer = csv.writer(out)
        writer.writerow(names)
        for row in flat.toLocalIterator():
            writer.writerow(row)
            n += 1
    return n


def write_common_metadata(df: DataFrame, path: str, without: Sequence[str], extra: Mapping[str, str] | None = None) -> None:
    """A ``_common_metadata`` sidecar in a local table folder: the schema less the partition keys."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(df.drop(*without).schema).with_metadata({k: str(v) for k, v in (extra or {}).items()})
    pq.write_metadata(schema, f"{path}/_common_metadata")


def geo_metadata(geometry: str = "geometry", crs: object = None, bbox: bool = True) -> dict[str, object]:
    """The ``geo`` entry of a Parquet footer (version 1.1.0); without a crs, longitude and latitude are meant."""
    column: dict[str, object] = {"encoding": "WKB", "geometry_types": []}
    if crs is not None:
        column["crs"] = crs
    if bbox:
        column["covering"] = {"bbox": {c: ["bbox", c] for c in ("xmin", "ymin", "xmax", "ymax")}}
    return {"version": "1.1.0", "primary_column": geometry, "columns": {geometry: column}}


def write_region_files(df: DataFrame, folder: str, region: str = "region_id", geometry: str = "geometry", crs: object = None) -> DataFrame:
    """One GeoParquet file for each region (``<region>.parquet``: zstd, WKB, covering box, ``geo`` footer); region, path, n.

    Rows come sorted by region and are written batch by batch, so a region of any size is never held in
    memory. A file is moved into place when it is whole: repeated tasks leave the same files.
    Null regions are an error.
    """
    import uuid
    from collections.abc import Iterator

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import to_arrow_schema

    from cinderspark.sources.files import open_fs

    whole = (df if "bbox" in df.columns else with_covering(df, geometry)).withColumn(region, F.coalesce(F.col(region).cast("string"), F.raise_error(F.lit("a row has no region"))))
    schema = to_arrow_schema(whole.schema)
    schema = schema.with_metadata({"geo": json.dumps(geo_metadata(geometry, crs))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        fs.create_dir(base)
        name, part, writer, n = None, "", None, 0

        def close() -> pa.RecordBatch:
            writer.close()
            path = f"{base}/{name}.parquet"
            fs.move(part, path)
            return pa.RecordBatch.from_pydict({"region": [name], "path": [path], "n": [n]})

        for batch in batches:
            table = pa.Table.from_batches([batch]).cast(schema)
            names = table.column(region).to_pylist()
            start = 0
            for k in range(1, len(names) + 1):
                if k < len(names) and names[k] == names[start]:
                    continue
                if names[start] != name:
                    if writer is not None:
                        yield close()
                    name, part, n = names[start], f"{base}/.{names[start]}-{uuid.uuid4().hex}", 0
                    writer = pq.ParquetWriter(part, schema, filesystem=fs, compression="zstd")
                writer.write_table(table.slice(start, k - start))
                n, start = n + k - start, k
        if writer is not None:
            yield close()

    dealt = whole.repartition(region).sortWithinPartitions(region)
    return dealt.mapInArrow(run, "region string, path string, n long").withColumnRenamed("region", region)


# ------------------------------------------------------------------------ ledger


def record(spark: SparkSession, ledger: str, regions: Sequence[str]) -> None:
    """Appends the regions that were written."""
    rows = spark.createDataFrame([(r, f"wrote region_id ({r})") for r in regions], "region_id string, message string")
    rows.withColumn("at", F.current_timestamp()).write.mode("append").parquet(ledger)


def processed(spark: SparkSession, ledger: str) -> DataFrame:
    """Distinct region ids of the ledger; none if there is no ledger yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(ledger).select("region_id").distinct()
    except AnalysisException:
        return spark.createDataFrame([], "region_id string")


def write_regions(df: DataFrame, path: str, ledger: str) -> list[str]:
    """Replaces the regions at hand (idempotent: a repeated write leaves the same), then notes them."""
    write_partitioned(df, path, ["region_id"])
    written = sorted(r["region_id"] for r in df.select("region_id").distinct().collect())  # the grid's ids: a few hundred
    record(df.sparkSession, ledger, written)
    return written
