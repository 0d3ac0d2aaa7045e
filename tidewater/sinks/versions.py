"""Versioned tables: immutable data folders and numbered manifests.

A write puts its rows into a new folder below ``<path>/data`` and then
publishes ``<path>/_versions/N.json``, which names the folders and the schema
of version N. Renaming that one small file into place is the only step that
readers can see: a crash before it leaves the table as it was, and nothing is
moved or replaced. A reader holds the folders of the version that it opened,
so it goes on reading them while newer versions are written, even by a job
that overwrites its own input. ``vacuum`` removes what no kept version names.

One writer per table is assumed; a second one that publishes the same number
is refused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import paths

VERSIONS = "_versions"
DATA = "data"


def _name(version: int) -> str:
    return f"{version:020d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The published versions, oldest first."""
    return sorted(int(n[:-5]) for n in paths.list_names(spark, f"{path}/{VERSIONS}")
                  if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The manifest of a version (default: the newest), or None for a new table."""
    if version is None:
        known = versions(spark, path)
        if not known:
            return None
        version = known[-1]
    file = f"{path}/{VERSIONS}/{_name(version)}"
    if not paths.exists(spark, file):
        raise FileNotFoundError(f"{path} has no version {version}")
    return json.loads(paths.read_text(spark, file)) | {"version": version}


def publish(spark: SparkSession, path: str, content: dict, after: int) -> int:
    """Make ``content`` the version after ``after`` (-1 for the first)."""
    version = after + 1
    file = f"{path}/{VERSIONS}/{_name(version)}"
    if paths.exists(spark, file):
        raise RuntimeError(f"another writer has published version {version} of {path}")
    tmp = f"{path}/{VERSIONS}/.{uuid.uuid4().hex}.tmp"
    paths.write_text(spark, tmp, json.dumps({k: v for k, v in content.items() if k != "version"}))
    paths.rename(spark, tmp, file)
    return version


def new_folder(path: str) -> str:
    """The name, below ``path``, of a data folder that is used once."""
    return f"{DATA}/{uuid.uuid4().hex}"


def overwrite(df: DataFrame, path: str) -> int:
    """Replace the table at ``path`` by ``df``, which may read any version of it.
    Returns the new version."""
    spark = df.sparkSession
    known = versions(spark, path)
    folder = new_folder(path)
    df.write.mode("errorifexists").parquet(f"{path}/{folder}")
    return publish(spark, path, {"folders": [folder], "schema": df.schema.json()}, known[-1] if known else -1)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version (default: the newest). The frame stays with that version."""
    m = manifest(spark, path, version)
    if m is None:
        raise FileNotFoundError(f"{path} has no version")
    schema = T.StructType.fromJson(json.loads(m["schema"]))
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in m["folders"]])


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Keep the newest ``keep`` versions; remove older manifests and the data folders
    that no kept version names (also those of writes that never got published).
    Not to be run beside a writer, nor while older versions are being read."""
    known = versions(spark, path)
    if keep < 1:
        raise ValueError("keep at least one version")
    if not known:
        return 0
    used = {f.split("/")[1] for v in known[-keep:] for f in manifest(spark, path, v)["folders"]}
    for v in known[:-keep]:
        paths.delete(spark, f"{path}/{VERSIONS}/{_name(v)}")
    gone = [n for n in paths.list_names(spark, f"{path}/{DATA}") if n not in used]
    for n in gone:
        paths.delete(spark, f"{path}/{DATA}/{n}")
    return len(gone)
