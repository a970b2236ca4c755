"""Releases: outputs that become visible together, or not at all.

A release folder holds run folders, which are written once and never changed, and under
``_releases`` one small manifest for each release.  A run is written first; its manifest,
which names the run and its tables, comes last and is numbered.  Readers take the manifest
with the highest number and read that run's folder only: they never see half a run, nor
tables of two runs, whatever a writer is doing or where it died.  Nothing relies on the
marker files that Spark may leave (``_SUCCESS``).

A manifest appears whole and under a free number in one step of the file system: a hard
link where the files are local, a rename elsewhere (Hadoop file systems refuse to rename a
file onto another one).  Of two writers of the same number one wins; the other one takes
the next number, or fails if it asked for the first.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_MANIFESTS = "_releases"
_MANIFEST_NAME = re.compile(r"^(\d{12})\.json$")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in its terms."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


@dataclass(frozen=True)
class Release:
    """One published run: its number, folder, and the tables in it by label."""

    number: int
    folder: str
    tables: Mapping[str, str]
    facts: Mapping[str, object]

    def path(self, label: str) -> str:
        return f"{self.folder}/{self.tables[label]}"


def stage_run(root: str) -> str:
    """A new run folder under ``root``; nothing is written yet."""
    return f"{root.rstrip('/')}/run-{uuid.uuid4().hex}"


def discard_run(spark: SparkSession, folder: str) -> None:
    """Delete a run folder that was not published."""
    fs, at = file_system(spark, folder)
    fs.delete(at, True)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, at = file_system(spark, f"{root.rstrip('/')}/{_MANIFESTS}")
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(m.group(1)) for m in map(_MANIFEST_NAME.match, names) if m)


def _read(spark: SparkSession, root: str, number: int) -> Release:
    fs, at = file_system(spark, f"{root.rstrip('/')}/{_MANIFESTS}/{number:012d}.json")
    stream = fs.open(at)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    told = json.loads(text)
    return Release(number, f"{root.rstrip('/')}/{told['run']}", told["tables"], told["facts"])


def all_releases(spark: SparkSession, root: str) -> list[Release]:
    """All releases, oldest first."""
    return [_read(spark, root, n) for n in _numbers(spark, root)]


def latest_release(spark: SparkSession, root: str) -> Release | None:
    """The newest release under ``root``; ``None`` when there is none yet."""
    numbers = _numbers(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else None


def _appears(spark: SparkSession, written: str, final: str) -> bool:
    """Give a file its final name in one step; False if that name is taken."""
    fs, from_ = file_system(spark, written)
    _, to = file_system(spark, final)
    if fs.getScheme() != "file":
        return not fs.exists(to) and fs.rename(from_, to)
    jvm = spark.sparkContext._jvm
    link, existing = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (to, from_))
    try:
        jvm.java.nio.file.Files.createLink(link, existing)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    fs.delete(from_, False)
    return True


def publish_run(
    spark: SparkSession,
    folder: str,
    tables: Mapping[str, str],
    facts: Mapping[str, object] | None = None,
    first_only: bool = False,
) -> Release:
    """Publish a staged run: ``tables`` maps labels to folders within ``folder``, ``facts``
    are small values kept with them.

    With ``first_only`` the run must be the first release of its root; that it is not
    is a ``ValueError``, also when another writer was first by a moment.
    """
    root, run = folder.rsplit("/", 1)
    facts = dict(facts or {})
    fs, aside = file_system(spark, f"{root}/{_MANIFESTS}/.{uuid.uuid4().hex}")
    text = json.dumps({"run": run, "tables": dict(tables), "facts": facts})
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    while True:
        numbers = _numbers(spark, root)
        if first_only and numbers:
            fs.delete(aside, False)
            raise ValueError(f"publish_run: {root} already holds a release")
        number = numbers[-1] + 1 if numbers else 1
        if _appears(spark, aside.toString(), f"{root}/{_MANIFESTS}/{number:012d}.json"):
            return Release(number, folder, dict(tables), facts)
