"""Marts published together, checked before readers see them.

A root folder holds the marts' versions and numbered manifests:

    <root>/data/<mart>-<unique>/...      Parquet, never changed once written
    <root>/manifests/00000007.json       which folder each mart has in version 7

A publication writes beside what is there, reads it back, compares contents and
runs the caller's checks; then one rename puts the next manifest in its place.
Readers take the highest manifest, so they see all marts of a version or none,
and a run that fails at any point leaves the old version as it is. Marts that a
publication doesn't name keep their folders. A rename onto a manifest that
exists fails, so of two publications at one time one is told so (on file systems
whose rename is atomic; object stores need a committer that refuses overwrites).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from lakemart.operators.quality import DIVERGENT, write_and_verify
from lakemart.session import delete_path


class PublishError(RuntimeError):
    """Nothing was published; readers see the version they saw before."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path
    return hpath, hpath(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions that are still there, in order."""
    hpath, fs = _fs(spark, f"{root}/manifests")
    if not fs.exists(hpath(f"{root}/manifests")):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(hpath(f"{root}/manifests"))]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(root: str, version: int) -> str:
    return f"{root}/manifests/{version:08d}.json"


def folders(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Folder of each mart in a version (the newest by default; none: empty)."""
    root = root.rstrip("/")
    if version is None:
        version = max(versions(spark, root), default=0)
        if not version:
            return {}
    (line,) = spark.read.option("wholetext", "true").text(_manifest(root, version)).collect()
    return {name: f"{root}/data/{folder}" for name, folder in json.loads(line.value)["marts"].items()}


def read_published(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The marts of one version, all of the same one."""
    return {name: spark.read.parquet(path) for name, path in folders(spark, root, version).items()}


def register_published(spark: SparkSession, root: str, version: int | None = None) -> list[str]:
    """Temp views named after the marts of one version."""
    for name, df in (marts := read_published(spark, root, version)).items():
        df.createOrReplaceTempView(name)
    return list(marts)


def publish(spark: SparkSession, marts: Mapping[str, DataFrame], root: str,
            checks: Mapping[str, Callable[[DataFrame], bool]] | None = None) -> int:
    """Publish ``marts`` as the next version and return its number.

    Every mart is written to a new folder and read back: checksums per column and
    row that were observed on the write must be those of the read, and
    ``checks[name](df)``, where given, must hold for what was read. Otherwise, and
    whenever a job fails, the new folders are deleted and the error goes on as
    :class:`PublishError` (or as itself). Other marts stay as they are.
    """
    root = root.rstrip("/")
    before = max(versions(spark, root), default=0)
    current = {name: path.rsplit("/", 1)[1] for name, path in folders(spark, root, before).items()} if before else {}
    run = uuid.uuid4().hex[:12]
    new = {name: f"{name}-{run}" for name in marts}
    try:
        report = write_and_verify(spark, {new[name]: df for name, df in marts.items()}, f"{root}/data")
        wrong = [(r.table_name, r.column_name) for r in report.filter(f"status = '{DIVERGENT}'").collect()]
        if wrong:
            raise PublishError(f"read back other contents than were written: {wrong}")
        for name, check in (checks or {}).items():
            if not check(spark.read.parquet(f"{root}/data/{new[name]}")):
                raise PublishError(f"check of {name} failed")
        _switch(spark, root, before + 1, {**current, **new})
    except BaseException:
        for folder in new.values():
            delete_path(spark, f"{root}/data/{folder}")
        raise
    return before + 1


def _switch(spark: SparkSession, root: str, version: int, marts: Mapping[str, str]) -> None:
    hpath, fs = _fs(spark, root)
    fs.mkdirs(hpath(f"{root}/manifests"))
    draft, target = hpath(f"{root}/manifests/.draft-{uuid.uuid4().hex}"), hpath(_manifest(root, version))
    out = fs.create(draft)
    out.write(bytearray(json.dumps({"version": version, "marts": dict(marts)}, ensure_ascii=False).encode()))
    out.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(
        spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    never[0] = getattr(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    try:
        context.rename(draft, target, never)     # an error if the target is there
    except Exception as e:
        fs.delete(draft, False)
        raise PublishError(f"version {version} was published by another run") from e


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` versions and the folders that only those
    had; returns the folders. Readers of older versions must have ended, and no
    publication may be under way: its folders, which no version names, go too."""
    if keep < 1:
        raise ValueError("at least one version stays")
    root = root.rstrip("/")
    old = versions(spark, root)[:-keep]
    stay = {path for v in versions(spark, root)[-keep:] for path in folders(spark, root, v).values()}
    hpath, fs = _fs(spark, root)
    for v in old:            # manifests first: no version may name a folder that is gone
        delete_path(spark, _manifest(root, v))
    there = [f.getPath().getName() for f in fs.listStatus(hpath(f"{root}/data"))] if fs.exists(hpath(f"{root}/data")) else []
    gone = [f"{root}/data/{n}" for n in there if f"{root}/data/{n}" not in stay]
    for path in gone:
        delete_path(spark, path)
    return gone
