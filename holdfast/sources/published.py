"""Sets of files that change in one step.

A set is a folder with numbered manifests. Data goes into new folders first, where no
reader looks; then one small file with the next number names the folders that make up
the set, and from then on readers see all of the new parts or, if anything failed
before, all of the old ones. A manifest is put in place by a rename that must not
replace anything, so of two writers with the same number one starts again from the
other's set. What older manifests name stays until ``clean`` removes it, so a reader who
has begun is not disturbed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from holdfast.sources.files import MissingInput

MANIFESTS, DATA = "_manifests", "data"
#: Times that a writer starts again because another was faster.
TRIES = 20

#: Part names to the folders, relative to the set's, that hold a part's rows or files.
Parts = dict[str, list[str]]


class Contended(RuntimeError):
    """Other writers were faster each time."""


def _files(spark: SparkSession, folder: str):
    """Hadoop's Path class, and its file system and context for a folder."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    place, conf = fs.Path(folder), spark.sparkContext._jsc.hadoopConfiguration()
    files = place.getFileSystem(conf)
    return fs.Path, files, fs.FileContext.getFileContext(files.makeQualified(place).toUri(), conf)


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the manifests, ascending."""
    path, files, _ = _files(spark, folder)
    where = path(f"{folder}/{MANIFESTS}")
    if not files.exists(where):
        return []
    names = [status.getPath().getName() for status in files.listStatus(where)]
    return sorted(int(name) for name in names if name.isdigit())


def _read(spark: SparkSession, folder: str, version: int) -> Parts:
    path, files, _ = _files(spark, folder)
    stream = files.open(path(f"{folder}/{MANIFESTS}/{version:020d}"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def current(spark: SparkSession, folder: str) -> Parts:
    """The parts of the newest set; empty before the first."""
    known = versions(spark, folder)
    return _read(spark, folder, known[-1]) if known else {}


def _commit(spark: SparkSession, folder: str, version: int, parts: Parts) -> bool:
    """Put a manifest in place; False if its number is taken."""
    path, files, context = _files(spark, folder)
    made, final = path(f"{folder}/{MANIFESTS}/.{uuid4().hex}"), path(f"{folder}/{MANIFESTS}/{version:020d}")
    stream = files.create(made, False)
    try:
        stream.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
    finally:
        stream.close()
    rename = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(made, final, options)
    except Py4JJavaError as error:
        files.delete(made, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def publish(
    spark: SparkSession, folder: str, write: Mapping[str, Callable[[str], None]], append: bool = False,
    check: Callable[[dict[str, str]], None] = lambda made: None,
) -> int:
    """Write parts into new folders, each by a function of its folder, and make them the set's in one step.

    Named parts replace those of the same name, or with ``append`` come in addition; all others stay.
    ``check`` gets the folders written and may raise. Gives the number of the new set. If a part
    or the check fails, the set stays as it was.
    """
    made = {name: f"{DATA}/{uuid4().hex}/{name}" for name in write}
    try:
        for name, function in write.items():
            function(f"{folder}/{made[name]}")
        check({name: f"{folder}/{place}" for name, place in made.items()})
    except BaseException:
        _remove(spark, folder, made.values())
        raise
    for _ in range(TRIES):
        known = versions(spark, folder)
        parts = _read(spark, folder, known[-1]) if known else {}
        for name, place in made.items():
            parts[name] = [*(parts.get(name, []) if append else []), place]
        if _commit(spark, folder, version := (known[-1] + 1 if known else 1), parts):
            return version
    _remove(spark, folder, made.values())
    raise Contended(f"{folder}: {TRIES} other sets were published meanwhile")


def publish_rows(spark: SparkSession, folder: str, tables: Mapping[str, DataFrame], append: bool = False) -> int:
    """Tables as Parquet, all of them or none."""
    return publish(spark, folder, {name: table.write.parquet for name, table in tables.items()}, append)


def places(spark: SparkSession, folder: str, name: str, made_by: str, version: int | None = None) -> list[str]:
    """The folders of one part, oldest first; a missing one names its maker."""
    parts = current(spark, folder) if version is None else _read(spark, folder, version)
    if name not in parts:
        raise MissingInput(f"{name} not found in {folder}; run {made_by} first")
    return [f"{folder}/{place}" for place in parts[name]]


def read_rows(spark: SparkSession, folder: str, name: str, made_by: str, version: int | None = None) -> DataFrame:
    """One table of the newest set, or of a stated one that has not been cleaned away."""
    return spark.read.parquet(*places(spark, folder, name, made_by, version))


def _remove(spark: SparkSession, folder: str, made) -> None:
    path, files, _ = _files(spark, folder)
    for place in made:
        files.delete(path(f"{folder}/{place}").getParent(), True)


def clean(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Remove manifests but the last ``keep`` sets, and data that only they name. Gives the number of folders removed.

    Data of a set that is being written is not named by any manifest yet and stays, too.
    """
    path, files, _ = _files(spark, folder)
    known = versions(spark, folder)
    old, kept = known[:-keep], known[-keep:]
    needed = {place for version in kept for places_ in _read(spark, folder, version).values() for place in places_}
    gone = {place for version in old for places_ in _read(spark, folder, version).values() for place in places_} - needed
    _remove(spark, folder, gone)
    for version in old:
        files.delete(path(f"{folder}/{MANIFESTS}/{version:020d}"), False)
    return len(gone)
