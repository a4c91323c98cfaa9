"""Versions of a stored table: data folders that never change, and numbered manifests that name the live ones.

A table's folder holds ``data/_version=<number>-<id>/<partition folder>``, the same below ``summary``, and
``manifest/<number>.json``.  A publication writes new folders and then one manifest; until that file is complete,
readers see the version before.  Plain partition folders, as other programs land them, are adopted by the first
publication: manifests name them until they are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class PublicationConflict(RuntimeError):
    """Another publication of the table was finished first; nothing was changed."""


@dataclass(frozen=True)
class Manifest:
    """Partition folder name (``year=2024``; empty for an unpartitioned table) -> folder below the table's path."""

    number: int = 0
    data: dict[str, str] = field(default_factory=dict)
    summary: dict[str, str] = field(default_factory=dict)

    def following(self, number: int, data: dict[str, str], summary: dict[str, str], gone: Iterable[str]) -> Manifest:
        """The manifest after a publication: its folders take the place of those of the same partitions."""
        gone = set(gone) | set(data)
        keep = lambda old: {k: v for k, v in old.items() if k not in gone}
        return Manifest(number, {**keep(self.data), **data}, {**keep(self.summary), **summary})


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, on whatever file system it lives; none where it does not exist."""
    files, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in names(spark, f"{path}/manifest")
            if n.endswith(".json") and n.removesuffix(".json").isdigit()]


def _read(spark: SparkSession, path: str, number: int) -> Manifest | None:
    files, where = _at(spark, f"{path}/manifest/{number:012d}.json")
    stream = files.open(where)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return Manifest(**json.loads(text))
    except ValueError:          # its writer died before the end: never finished
        return None


def manifests(spark: SparkSession, path: str, newest: int = 1) -> list[Manifest]:
    """The newest finished manifests, newest first."""
    out: list[Manifest] = []
    for number in sorted(_numbers(spark, path), reverse=True):
        found = _read(spark, path, number)
        if found is not None:
            out.append(found)
        if len(out) == newest:
            break
    return out


def latest(spark: SparkSession, path: str) -> Manifest | None:
    found = manifests(spark, path)
    return found[0] if found else None


def next_number(spark: SparkSession, path: str) -> int:
    return max(_numbers(spark, path), default=0) + 1


def commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Write the manifest, the only step that changes what readers see.

    The file must not exist: of two publications that started from the same version, the second is refused.
    """
    files, where = _at(spark, f"{path}/manifest/{manifest.number:012d}.json")
    try:
        out = files.create(where, False)
    except Py4JJavaError as error:
        raise PublicationConflict(f"version {manifest.number} of {path} exists already") from error
    try:
        out.write(bytearray(json.dumps(manifest.__dict__, sort_keys=True).encode()))
    finally:
        out.close()


def landed(spark: SparkSession, path: str, partition: str | None) -> Manifest | None:
    """Plain folders or files without a manifest; None where there are none."""
    found = names(spark, path)
    if partition:
        folders = {n: n for n in found if n.startswith(f"{partition}=")}
        return Manifest(0, folders) if folders else None
    return Manifest(0, {"": ""}) if any(n.endswith(".parquet") for n in found) else None


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete folders that none of the newest ``keep`` manifests names, and older manifests; returns what went.

    Folders of a publication under way have a higher number and stay.  Readers of older versions lose their files, so
    keep as many versions as the longest reader may see published.
    """
    kept = manifests(spark, path, keep)
    if not kept:
        return []
    live = {folder.split("/")[1] for m in kept for part in (m.data, m.summary) for folder in part.values()
            if "/" in folder}
    gone = []
    for part in ("data", "summary"):
        for name in names(spark, f"{path}/{part}"):
            number = name.removeprefix("_version=").split("-")[0]
            if name not in live and number.isdigit() and int(number) <= kept[0].number:
                gone.append(f"{part}/{name}")
    gone += [f"manifest/{n:012d}.json" for n in _numbers(spark, path) if n < kept[-1].number]
    for folder in gone:
        delete(spark, f"{path}/{folder}")
    return gone
