"""Small operations on the folders of a store, through the file system that Spark uses for it: they move names, not data."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    """A file or folder, by its name within the folder that was listed."""

    name: str
    path: str
    is_folder: bool
    length: int


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def plain_path(path: str) -> str:
    """A path without scheme, repeated slashes and slash at the end, for comparing paths of one store."""
    return re.sub(r"/+", "/", re.sub(r"^[a-z0-9+.-]+:(//[^/]*(?=/))?", "", path)).rstrip("/")


def lies_in(path: str, folder: str) -> bool:
    return f"{plain_path(path)}/".startswith(f"{plain_path(folder)}/")


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def entries(spark: SparkSession, folder: str) -> list[Entry]:
    """What is in a folder, by name; nothing where there is no such folder."""
    files, place = _at(spark, folder)
    if not files.exists(place):
        return []
    found = files.listStatus(place)
    return sorted((Entry(s.getPath().getName(), s.getPath().toString(), s.isDirectory(), s.getLen()) for s in found), key=lambda e: e.name)


def data_files(spark: SparkSession, folder: str, below: str = "") -> list[str]:
    """Paths of the data files under a folder, relative to it; names with a leading ``_`` or ``.`` are not data."""
    found = []
    for entry in entries(spark, f"{folder.rstrip('/')}/{below}"):
        if not entry.name.startswith(("_", ".")):
            inner = f"{below}{entry.name}"
            found += data_files(spark, folder, f"{inner}/") if entry.is_folder else [inner]
    return found


def make_folder(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.mkdirs(place)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the folder that ``target`` lies in is made, a target that exists is an error."""
    files, place = _at(spark, target)
    if files.exists(place):
        raise FileExistsError(target)
    files.mkdirs(place.getParent())
    if not files.rename(_at(spark, source)[1], place):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file, there as a whole or not at all: until then it has a name that is not data."""
    folder, _, name = path.rpartition("/")
    written = f"{folder}/_{name}-{uuid.uuid4().hex}"
    files, place = _at(spark, written)
    out = files.create(place, True)
    out.write(text.encode())
    out.close()
    move(spark, written, path)


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _at(spark, path)
    source = files.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()
