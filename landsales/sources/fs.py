"""Small driver-side file operations: list a folder, read or create a pointer file.

They go through Hadoop's file systems with the session's own configuration, so every
path that Spark's readers open (HDFS, object stores, ``viewfs``, local disk) works here
too. Only folder listings and small files pass through the driver; data always moves
through Spark readers and writers.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    is_dir: bool
    size: int = 0
    modified: int = 0


def _open(uri: str):
    """Hadoop file system and path of a URI; a path without a scheme is the default file system's."""
    sc = SparkContext._active_spark_context
    if sc is None:
        raise RuntimeError("no active Spark session")
    path = sc._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()), path, sc


def _missing(error: Py4JJavaError) -> bool:
    return error.java_exception.getClass().getName() == "java.io.FileNotFoundException"


def _join(uri: str, name: str) -> str:
    return uri.rstrip("/") + "/" + name


def list_dir(uri: str) -> list[Entry]:
    fs, path, _ = _open(uri)
    try:
        found = fs.listStatus(path)
    except Py4JJavaError as error:
        if _missing(error):
            return []
        raise
    return sorted((Entry(s.getPath().getName(), _join(uri, s.getPath().getName()), s.isDirectory(), s.getLen(),
                         s.getModificationTime()) for s in found), key=lambda e: e.name)


def files_below(uri: str) -> list[Entry]:
    """The files of a folder and all folders in it, or the file itself."""
    fs, path, _ = _open(uri)
    out = []
    try:
        found = fs.listFiles(path, True)
        while found.hasNext():
            s = found.next()
            out.append(Entry(s.getPath().getName(), s.getPath().toString(), False, s.getLen(), s.getModificationTime()))
    except Py4JJavaError as error:
        if not _missing(error):
            raise
    return sorted(out, key=lambda e: e.path)


def data_files(uri: str) -> list[Entry]:
    """The files of a folder that hold data (names with '_' or '.' first are bookkeeping)."""
    return [e for e in files_below(uri) if not e.name.startswith(("_", "."))]


def base_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def part_name(path: str) -> str:
    """Manifest name of a file: its own, with its folder's if it is a part of a ``*.txt`` folder."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{base_name(folder)}/{name}" if folder.endswith(".txt") else name


def exists(uri: str) -> bool:
    fs, path, _ = _open(uri)
    return fs.exists(path)


def read_text(uri: str) -> str | None:
    fs, path, sc = _open(uri)
    try:
        stream = fs.open(path)
    except Py4JJavaError as error:
        if _missing(error):
            return None
        raise
    try:
        return sc._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_aside(uri: str, text: str):
    """The text in a new file beside ``uri``, complete and closed."""
    fs, path, sc = _open(uri)
    fs.mkdirs(path.getParent())
    aside = sc._jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return fs, aside, path, sc


def _rename(sc, aside, path, overwrite: bool) -> None:
    options = sc._jvm.org.apache.hadoop.fs.Options.Rename
    chosen = sc._gateway.new_array(options, 1)
    chosen[0] = options.OVERWRITE if overwrite else options.NONE
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), sc._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(aside), context.makeQualified(path), chosen)


def write_text_atomic(uri: str, text: str) -> None:
    """Replace a small file in one visible step: written beside it, then renamed over it."""
    _, aside, path, sc = _write_aside(uri, text)
    _rename(sc, aside, path, True)


def create_text(uri: str, text: str) -> bool:
    """Create a small file whole, unless it exists: of several writers one gets True.

    HDFS and the like rename without overwriting, which fails if the target exists. Local
    disk, where Hadoop only looks before it renames, links the finished file under its
    name, which the operating system refuses for a taken name.
    """
    fs, aside, path, sc = _write_aside(uri, text)
    try:
        if fs.getUri().getScheme() == "file":
            os.link(aside.toUri().getPath(), path.toUri().getPath())
        else:
            _rename(sc, aside, path, False)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
            return False
        raise
    finally:
        fs.delete(aside, False)


def first_line(uri: str) -> str | None:
    """First line of a file (a compressed one is read as Spark reads it), or of the first data file of a folder (files
    starting with '_' or '.' are bookkeeping and skipped)."""
    fs, path, sc = _open(uri)
    if not fs.exists(path):
        return None
    if fs.getFileStatus(path).isDirectory():
        data = [e.path for e in data_files(uri)]
        if not data:
            return None
        uri, path = data[0], sc._jvm.org.apache.hadoop.fs.Path(data[0])
    stream = fs.open(path)
    if not uri.endswith(".txt"):       # compressed or not by the file's name, as Spark's readers tell
        codec = sc._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(sc._jsc.hadoopConfiguration()).getCodec(path)
        if codec is not None:
            stream = codec.createInputStream(stream)
    reader = sc._jvm.java.io.BufferedReader(sc._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return "" if line is None else line.removeprefix("﻿")


def delete_tree(uri: str) -> None:
    """Remove a folder this package created for its own scratch data."""
    fs, path, _ = _open(uri)
    fs.delete(path, True)
