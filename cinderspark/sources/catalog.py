"""Named datasets and queries over them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.functions import geo

FORMATS = ("geoparquet", "parquet", "pixels", "csv")


@dataclass(frozen=True)
class Dataset:
    """Where a table is and what it holds. ``pixels`` are rasters kept as (iy, ix, variables)."""

    name: str
    path: str
    data_format: str = "geoparquet"
    version: str = "v1"
    description: str = ""
    license: str = ""

    def __post_init__(self):
        if self.data_format not in FORMATS:
            raise ValueError(f"unknown format {self.data_format!r}")

    def read(self, spark: SparkSession) -> DataFrame:
        if self.data_format == "csv":
            return spark.read.csv(self.path, header=True)
        return spark.read.option("recursiveFileLookup", "false").parquet(self.path)

    def pixels(self, spark: SparkSession) -> DataFrame:
        if self.data_format != "pixels":
            raise ValueError(f"{self.name} is not a raster")
        return self.read(spark)

    def query(self, spark: SparkSession, sql: str = "SELECT * FROM {source}") -> DataFrame:
        """SQL with ``{source}`` for the table; Spark binds it, so no text is pasted together."""
        if self.data_format not in ("geoparquet", "parquet"):
            raise ValueError(f"{self.name} is not a table of features")
        return spark.sql(sql, source=self.read(spark))

    def features(
        self, spark: SparkSession, sql: str = "SELECT * FROM {source}", geometry: str = "geometry", crs: int = 4326, target_crs: int | None = None
    ) -> DataFrame:
        """The query's rows with the WKB column as text besides, moved from ``crs`` to ``target_crs`` (EPSG codes) if one is given."""
        found = self.query(spark, sql)
        if geometry not in found.columns:
            raise ValueError(f"the query returns no {geometry}")
        if target_crs is not None and target_crs != crs:
            found = found.withColumn(geometry, geo.reproject_udf(crs, target_crs)(F.col(geometry)))
        return found.withColumn(f"{geometry}_wkt", geo.wkt_udf(F.col(geometry)))


def _order(version: str) -> tuple:
    """Versions by their numbers, so that v10 comes after v9."""
    digits = [int(x) for x in "".join(c if c.isdigit() else " " for c in version).split()]
    return (digits, version)


@dataclass
class Catalog:
    """Datasets by name and version."""

    datasets: list[Dataset] = field(default_factory=list)

    def get(self, name: str, version: str | None = None, case_sensitive: bool = True, latest: bool = False) -> Dataset:
        same = (lambda a: a == name) if case_sensitive else (lambda a: a.lower() == name.lower())
        found = [d for d in self.datasets if same(d.name)]
        if not found:
            raise KeyError(f"no dataset {name!r}")
        if version is not None:
            found = [d for d in found if d.version == version]
            if not found:
                raise KeyError(f"no version {version!r} of {name!r}")
        elif len(found) > 1:
            if not latest:
                raise ValueError(f"{name!r} has versions {sorted(d.version for d in found)}: name one, or ask for the latest")
            found = [max(found, key=lambda d: _order(d.version))]
        return found[0]

    def __iter__(self) -> Iterator[Dataset]:
        return iter(self.datasets)

    def __len__(self) -> int:
        return len(self.datasets)

    def __repr__(self) -> str:
        lines = [f"{d.name:30} {d.version:8} {d.data_format:12} {d.path}" for d in self.datasets]
        return "\n".join([f"{'name':30} {'version':8} {'format':12} path", *lines])
