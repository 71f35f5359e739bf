"""Versioned publication of stored tables: a version is a folder, and the newest manifest names the one that readers see.

A publisher writes a whole version, then adds one small manifest file under the next number. A manifest is written beside and renamed into
place without overwriting, so that it is there whole or not at all, and of two publishers at once the second takes the next number. A
refresh that fails adds no manifest: readers keep the version they had. No catalog service is needed.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from goldpan.sources.writers import COLUMNAR

_NAME = re.compile(r"(\d{12})\.json")
_VERSIONS, _MANIFESTS = "versions", "manifests"


@dataclass(frozen=True)
class Publication:
    """One published version: its number, its name, the format and the paths and schemas of its tables."""

    number: int
    version: str
    fmt: str
    tables: dict[str, dict[str, str]]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """A table of this version, read with the schema it was published with."""
        table = self.tables[name]
        return spark.read.schema(StructType.fromJson(json.loads(table["schema"]))).format(self.fmt).load(table["path"])


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def version_folder(root: str, version: str | None = None) -> str:
    """The folder of a new version below ``root``."""
    return f"{root.rstrip('/')}/{_VERSIONS}/{version or uuid.uuid4().hex}"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder = f"{root.rstrip('/')}/{_MANIFESTS}"
    files = _files(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    names = (status.getPath().getName() for status in files.listStatus(_path(spark, folder)))
    return sorted((int(m.group(1)) for m in map(_NAME.fullmatch, names) if m), reverse=True)


def _manifest(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{_MANIFESTS}/{number:012d}.json"


def _load(spark: SparkSession, root: str, number: int) -> Publication:
    path = _manifest(root, number)
    stream = _files(spark, path).open(_path(spark, path))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    return Publication(number, found["version"], found["format"], found["tables"])


def history(spark: SparkSession, root: str) -> list[Publication]:
    """Every published version, the current one first."""
    return [_load(spark, root, n) for n in _numbers(spark, root)]


def current(spark: SparkSession, root: str) -> Publication | None:
    """The version that readers see, or None before the first publication."""
    numbers = _numbers(spark, root)
    return _load(spark, root, numbers[0]) if numbers else None


def publish_version(spark: SparkSession, root: str, folder: str, tables: dict[str, DataFrame], fmt: str = COLUMNAR) -> Publication:
    """Make the ``tables`` stored in ``folder``, each under its name, the version that readers see."""
    listed = {name: {"path": f"{folder}/{name}", "schema": frame.schema.json()} for name, frame in tables.items()}
    text = json.dumps({"version": folder.rstrip("/").rsplit("/", 1)[-1], "format": fmt, "tables": listed}, indent=1)
    beside = f"{root.rstrip('/')}/{_MANIFESTS}/.{uuid.uuid4().hex}"
    files = _files(spark, beside)
    stream = files.create(_path(spark, beside), False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    plain = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    while True:
        number = max(_numbers(spark, root), default=0) + 1
        try:
            context.rename(_path(spark, beside), _path(spark, _manifest(root, number)), plain)
            return _load(spark, root, number)
        except Py4JJavaError:
            if number not in _numbers(spark, root):  # not taken by another publisher: a failure of the storage
                raise


def published(spark: SparkSession, root: str, name: str) -> tuple[DataFrame | None, bool, str | None]:
    """(rows, whether they are of the current version, why not), from the newest version in which ``name`` has rows that can be read."""
    reason = "missing"
    for place, version in enumerate(history(spark, root)):
        found, why = readable(lambda version=version: version.read(spark, name))
        if found is not None:
            return found, place == 0, None if place == 0 else reason
        if place == 0:
            reason = why
    return None, False, reason


def readable(read) -> tuple[DataFrame | None, str | None]:
    """The rows that ``read`` gives, or None and the reason: missing, empty or unreadable. One row is read at most."""
    try:
        frame = read()
        if frame is None:
            return None, "missing"
        return (None, "empty") if frame.isEmpty() else (frame, None)
    except KeyError:
        return None, "missing"
    except (PySparkException, Py4JError) as error:
        return None, "missing" if "PATH_NOT_FOUND" in str(error) else "unreadable"


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` newest versions, manifests first, and return the names of those deleted."""
    if keep < 1:
        raise ValueError("the current version stays")
    old = history(spark, root)[keep:]
    for version in old:
        path = _manifest(root, version.number)
        _files(spark, path).delete(_path(spark, path), False)
    for version in old:
        path = version_folder(root, version.version)
        _files(spark, path).delete(_path(spark, path), True)
    return [version.version for version in old]
