"""Files on shared storage, from inside tasks."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def default_storage(spark: SparkSession) -> str:
    """Where paths without a scheme lie: ``fs.defaultFS``."""
    return spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly below ``folder``, in order; none if it is not there. No file is opened."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(path) if s.isDirectory())


def exists(spark: SparkSession, place: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def is_folder(spark: SparkSession, place: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(path) and system.getFileStatus(path).isDirectory()


def qualified(spark: SparkSession, place: str) -> str:
    """``place`` with its scheme, as Spark's file sources name it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def make_folder(spark: SparkSession, place: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


def resolver(default: str) -> Callable[[str], tuple[Any, str]]:
    """A function from a path or URI to ``(file system, place in it)``; ``default`` holds paths without a scheme.

    It is made anew by each caller and so travels to the tasks with the caller's own code.
    """
    systems: dict[str, Any] = {}

    def resolve(uri: str) -> tuple[Any, str]:
        import os
        import re

        from pyarrow import fs

        split = re.compile(r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(.*)$", re.S)
        scheme, rest = split.match(uri).groups()
        if scheme is None:
            if default.startswith("file:"):
                return fs.LocalFileSystem(), os.path.abspath(rest)
            scheme, authority = split.match(default).groups()
            rest = f"{authority.rstrip('/')}/{rest.lstrip('/')}"
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        authority, _, inner = rest.removeprefix("//").partition("/")
        scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        at = f"{scheme}://{authority}/"
        if at not in systems:
            systems[at] = fs.FileSystem.from_uri(at)
        system, base = systems[at]
        return system, f"{base.rstrip('/')}/{inner}"

    return resolve


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files directly below ``folder``, in order; none if it is not there."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(path) if s.isFile())


def read_text(spark: SparkSession, place: str) -> str:
    """A small file."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(place)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, place: str, text: str) -> bool:
    """Writes a small file that nobody has written yet; False if it is there already. Readers see all of it or nothing.

    It is written beside its place and then renamed without overwriting (on the local file system: linked), which
    is atomic wherever renaming is.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(place)
    system = path.getFileSystem(conf)
    path = system.makeQualified(path)
    beside = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{uuid.uuid4().hex}.tmp")
    system.mkdirs(path.getParent())
    if path.toUri().getScheme() == "file":
        here, there = beside.toUri().getPath(), path.toUri().getPath()
        with open(here, "x", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(here, there)
            return True
        except FileExistsError:
            return False
        finally:
            os.remove(here)
    stream = system.create(beside, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    never = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(never, 1)
    options[0] = never.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf).rename(beside, path, options)
        return True
    except Py4JJavaError:
        system.delete(beside, False)
        if system.exists(path):
            return False
        raise
