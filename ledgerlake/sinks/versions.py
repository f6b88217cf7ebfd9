"""Layers that change in one step.

``replace_folder`` swaps a whole layer: the new content is written aside and takes the layer's place by a rename, so
a job that dies while it writes leaves the old layer as it was; one that dies between the two renames leaves the old
layer under its side name, where readers (``settled``) and the next writer find it.

A versioned layer is a folder with a log of small manifests, ``_versions/<number>.json``. The newest names the data
folders that make up the layer. A manifest appears by one rename that fails if the number is taken, so of two
writers one gets a ``ConflictError``; a reader takes the folders of one manifest and sees nothing of a later commit.
Manifests and folders of the last ``KEEP`` versions stay for readers that are still at it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from ..session import file_system, path_exists, remove_path

MANIFESTS = "_versions"
KEEP = 3


class ConflictError(RuntimeError):
    """Another writer has committed the version this one was about to commit."""


@dataclass(frozen=True)
class Version:
    number: int = 0  # 0: nothing committed yet
    content: dict = field(default_factory=dict)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replacing one of that name."""
    fs, p = file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = _children(spark, f"{path}/{MANIFESTS}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def is_versioned(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{MANIFESTS}")


def current(spark: SparkSession, path: str) -> Version:
    """The newest committed version."""
    numbers = _numbers(spark, path)
    return Version(numbers[-1], json.loads(_read_text(spark, f"{path}/{MANIFESTS}/{numbers[-1]:020d}.json"))) if numbers else Version()


def commit(spark: SparkSession, path: str, content: dict, after: Version) -> Version:
    """Make ``content`` the version that follows ``after``."""
    number = after.number + 1
    target, aside = f"{path}/{MANIFESTS}/{number:020d}.json", f"{path}/{MANIFESTS}/.{number:020d}.next"
    write_text(spark, aside, json.dumps(content))
    jvm = spark.sparkContext._jvm
    fs, source = file_system(spark, aside)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE  # fails if the target is there
    try:
        files.rename(fs.makeQualified(source), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(target)), how)
    except Exception as e:
        if _numbers(spark, path)[-1:] >= [number]:
            raise ConflictError(f"{path}: version {number} was committed by another writer") from e
        raise
    return Version(number, content)


def prune(spark: SparkSession, path: str, folders: Callable[[dict], list[str]], below: list[str]) -> None:
    """Remove manifests older than the last ``KEEP`` and the folders in ``below`` (relative to ``path``) that none of
    the kept ones names. A folder's name begins with the number of the version it was written for: one
    written for a version that is not committed yet stays."""
    numbers = _numbers(spark, path)
    kept = set()
    for n in numbers[-KEEP:]:
        kept.update(folders(json.loads(_read_text(spark, f"{path}/{MANIFESTS}/{n:020d}.json"))))
    for n in numbers[:-KEEP]:
        remove_path(spark, f"{path}/{MANIFESTS}/{n:020d}.json")
    for parent in below:
        for name in _children(spark, f"{path}/{parent}"):
            if f"{parent}/{name}" not in kept and int(name.split("-")[0]) <= numbers[-1]:
                remove_path(spark, f"{path}/{parent}/{name}")


def _beside(path: str, what: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{what}"


def settled(spark: SparkSession, path: str) -> str:
    """Where a whole layer is: its own folder, or the side name if a swap was interrupted between its renames."""
    old = _beside(path, "old")
    return old if "*" not in path and not path_exists(spark, path) and path_exists(spark, old) else path


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = file_system(spark, source)
    if not fs.rename(p, file_system(spark, target)[1]):
        raise RuntimeError(f"cannot move {source} to {target}")


def replace_folders(spark: SparkSession, paths: list[str], write: Callable[[str, str], int]) -> dict[str, int]:
    """Replace whole layers: ``write(path, folder)`` writes each one's new content to ``folder`` and returns its rows.

    All are written before the first is swapped. One writer at a time.
    """
    rows = {}
    for path in paths:
        if settled(spark, path) != path:  # finish what an interrupted swap left
            _move(spark, _beside(path, "old"), path)
        remove_path(spark, _beside(path, "new"))
        rows[path] = write(path, _beside(path, "new"))
    for path in paths:
        old = _beside(path, "old")
        remove_path(spark, old)
        if path_exists(spark, path):
            _move(spark, path, old)
        _move(spark, _beside(path, "new"), path)
        remove_path(spark, old)
    return rows


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], int]) -> int:
    return replace_folders(spark, [path], lambda _, folder: write(folder))[path]
