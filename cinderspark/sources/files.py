"""Files beside the tables: copies, removal, checked downloads, versions in paths, settings of object stores."""

from __future__ import annotations

import fnmatch
import hashlib
import os
import shutil
import urllib.request
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.functions import scalar as S


def open_fs(where: str):
    """pyarrow's file system of a URI or an absolute path, and the path in it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri("file://" + where.removeprefix("file:") if where.startswith("file:/") and not where.startswith("file://") else where)


def _hadoop(spark: SparkSession, where: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def copy(source: str, target: str, overwrite: bool = True, chunk_bytes: int = 16 << 20) -> str:
    """One file to another place, within a store or between stores; a target that is a folder or ends in ``/`` takes the source's name."""
    from pyarrow.fs import FileType, copy_files

    from_fs, from_path = open_fs(source)
    to_fs, to_path = open_fs(target)
    if target.endswith("/") or to_fs.get_file_info(to_path).type == FileType.Directory:
        to_path = f"{to_path.rstrip('/')}/{os.path.basename(from_path)}"
    if not overwrite and to_fs.get_file_info(to_path).type != FileType.NotFound:
        raise FileExistsError(to_path)
    to_fs.create_dir(os.path.dirname(to_path))
    copy_files(from_path, to_path, source_filesystem=from_fs, destination_filesystem=to_fs, chunk_size=chunk_bytes)
    return to_path


def copy_folder(spark: SparkSession, folder: str, target: str, pattern: str = "*", overwrite: bool = True) -> DataFrame:
    """path, target of every file below ``folder`` whose name fits ``pattern``, copied by the executors.

    The plan is lazy: files are copied when its rows are asked for, and again (to the same end) if a task repeats.
    """
    base, fs = _hadoop(spark, folder)
    root = fs.makeQualified(base).toString().rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = [p for p in batch["path"] if fnmatch.fnmatch(os.path.basename(p), pattern)]
            inner = [p.removeprefix("file:").lstrip("/").removeprefix(root.removeprefix("file:").lstrip("/")).lstrip("/") for p in kept]
            yield pd.DataFrame({"path": kept, "target": [copy(p, f"{target.rstrip('/')}/{i}", overwrite) for p, i in zip(kept, inner, strict=True)]}, dtype=object)

    return found.mapInPandas(run, "path string, target string")


def remove(spark: SparkSession, where: str, below: str) -> bool:
    """Deletes a file or folder strictly inside ``below``; False if there is none."""
    path, fs = _hadoop(spark, where)
    outer = fs.makeQualified(_hadoop(spark, below)[0]).toString().rstrip("/") + "/"
    if not fs.makeQualified(path).toString().startswith(outer) or "/../" in f"{where}/":
        raise ValueError(f"{where} is not inside {below}")
    return bool(fs.exists(path)) and bool(fs.delete(path, True))


def _digest(path: str, kind: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, kind).hexdigest()


def retrieve(url: str, folder: str, known_hash: str | None = None, name: str | None = None, unpack: bool = False) -> str | list[str]:
    """A file from the net kept in a local folder, checked against ``algorithm:hex``; its members if it is a zip to unpack.

    A kept file with the right hash is not loaded again. A file with a wrong hash is never left behind.
    """
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name or os.path.basename(url.split("?")[0]))
    kind, _, expected = (known_hash or "").rpartition(":")
    right = lambda p: not expected or _digest(p, kind or "sha256") == expected.lower()
    if not (os.path.exists(path) and right(path)):
        part = f"{path}.part"
        with urllib.request.urlopen(url) as source, open(part, "wb") as out:
            shutil.copyfileobj(source, out, 1 << 20)
        if not right(part):
            os.remove(part)
            raise ValueError(f"{url} does not have the hash {known_hash}")
        os.replace(part, path)
    if not unpack:
        return path
    with zipfile.ZipFile(path) as z:
        z.extractall(f"{path}.unpacked")  # zipfile keeps names inside the folder
        return sorted(os.path.join(f"{path}.unpacked", n) for n in z.namelist() if not n.endswith("/"))


def versioned(path: Column | str, version: str, environment: str | None = None) -> Column:
    """The environment and ``v<version>`` put before the last part of a path, unless it names the version already."""
    path, inner = S.col(path), f"{environment}/v{version}/" if environment else f"v{version}/"
    return F.when(F.contains(path, F.lit(f"v{version}")), path).otherwise(F.regexp_replace(path, "^(.*/)?([^/]*)$", f"$1{inner}$2"))


def object_store(bucket: str, region: str = "us-west-2", endpoint: str | None = None, anonymous: bool = False) -> dict[str, str]:
    """Settings of a session for one bucket; credentials come from the provider chain and are never part of them."""
    prefix = f"spark.hadoop.fs.s3a.bucket.{bucket}"
    out = {f"{prefix}.endpoint.region": region}
    if endpoint:
        out |= {f"{prefix}.endpoint": endpoint, f"{prefix}.path.style.access": "true"}
    if anonymous:
        out[f"{prefix}.aws.credentials.provider"] = "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"
    return out
