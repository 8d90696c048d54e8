"""Where a path lives, for code that opens files itself.

Spark resolves paths through Hadoop: a path without a scheme belongs to
``fs.defaultFS``.  Python code inside tasks has no Hadoop client, so the
driver turns every path into a full URI first (:func:`qualified`) and tasks
open it with the matching pyarrow filesystem (:func:`open_filesystem`).
A scheme without one is an error, never a local folder.
"""

from __future__ import annotations

import re

_SCHEME = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):")
#: Hadoop scheme -> the URI scheme that pyarrow knows it by.
_SAME_STORE = {"s3a": "s3", "s3n": "s3", "s3": "s3", "hdfs": "hdfs", "gs": "gs", "abfss": "abfss", "abfs": "abfs"}


def scheme_of(path: str) -> str | None:
    found = _SCHEME.match(path)
    return found.group(1).lower() if found else None


def default_fs(spark) -> str:
    """``fs.defaultFS`` of the session (``file:///`` where there is no Hadoop context)."""
    try:
        return spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    except Exception:  # sessions without a driver-side context (Spark Connect)
        return "file:///"


def qualify(path: str, fs: str = "file:///") -> str:
    """``path`` as a full URI; one without a scheme belongs to ``fs``."""
    if scheme_of(path):
        return path
    if not path.startswith("/"):
        if scheme_of(fs) not in (None, "file"):
            raise ValueError(f"a relative path has no place on {fs}: {path}")
        import os
        path = os.path.abspath(path)
    return (fs.rstrip("/") if scheme_of(fs) not in (None, "file") else "file://") + path


def qualified(spark, path: str) -> str:
    return qualify(path, default_fs(spark))


def pyarrow_uri(uri: str) -> str:
    """The URI by which pyarrow opens what Hadoop calls ``uri``."""
    scheme = scheme_of(uri)
    if scheme is None:
        raise ValueError(f"not a full URI (see storage.qualified): {uri}")
    rest = uri[len(scheme) + 1:]
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    if scheme == "dbfs":  # mounted on every node of such a cluster
        return "file:///dbfs/" + rest.lstrip("/")
    if scheme in _SAME_STORE and rest.startswith("//"):
        return f"{_SAME_STORE[scheme]}:{rest}"
    raise ValueError(f"no file access from tasks for {scheme}: paths ({uri}); "
                     f"use one of file, dbfs, {', '.join(sorted(_SAME_STORE))}")


def open_filesystem(uri: str):
    """(pyarrow filesystem, path on it)."""
    from pyarrow import fs

    target = pyarrow_uri(uri)
    if target.startswith("file://"):
        return fs.LocalFileSystem(), target[len("file://"):]
    return fs.FileSystem.from_uri(target)


def make_dir(spark, path: str) -> None:
    """Create a folder through Hadoop, wherever Spark itself would look for it."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).mkdirs(target)


def remove_dir(spark, path: str) -> bool:
    """Remove a folder and all in it, through Hadoop; False where there was none."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(conf).delete(target, True))
