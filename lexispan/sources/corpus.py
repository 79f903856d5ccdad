"""Corpus sources (S1-S4): file trees or tables -> (file_path, text).

Listing keeps names that start with ``_`` or ``.`` (``__init__.py``):
Spark's file sources hide those, so files are listed with
``os.scandir`` and read by Python tasks as bytes. The driver opens only as many folders
as it takes to give every task some; what lies below is walked by
executor tasks, and the paths are dealt out evenly before reading (a
shared POSIX mount is assumed, e.g. NFS or a FUSE-mounted object store). Decoding is native
and strict: one malformed file fails the job (``mode='strict'``), or is
set aside with ``mode='quarantine'``.

A corpus that is already a table (``path``, ``content``/``text``) skips
the listing: ``documents_from_table``.
"""

from __future__ import annotations

import itertools
import os
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.functions.text import is_supported_path, normalize_newlines

LIST_SCHEMA = "path string, is_file boolean"
# File contents a task holds before it hands them on.
READ_BYTES = 4 << 20
# Paths of a folder held at a time.
LISTED = 10_000


def _files(top: str) -> Iterator[tuple[str, bool]]:
    """(path, whether it is a file) of what is no folder below ``top``, as
    ``os.walk`` goes: links to folders are not followed, folders that
    cannot be read are passed over."""
    folders = [top]
    while folders:
        try:
            with os.scandir(folders.pop()) as entries:
                for entry in entries:
                    if not entry.is_dir():
                        yield entry.path, entry.is_file()
                    elif not entry.is_symlink():
                        folders.append(entry.path)
        except OSError:
            continue


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for top in pdf["path"]:
            found = iter([(top, True)]) if os.path.isfile(top) else _files(top)
            while rows := list(itertools.islice(found, LISTED)):
                yield pd.DataFrame(rows, columns=["path", "is_file"])


def _tops(root: str, wanted: int) -> list[str]:
    """Entries below ``root`` that tasks can walk on their own: folders
    are opened, shallow ones first, until there are ``wanted``. A folder
    of more than LISTED entries is left to one task, which lists it in
    parts."""
    folders, tops = deque([root]), []
    while folders and len(folders) + len(tops) < wanted:
        folder = folders.popleft()
        with os.scandir(folder) as found:
            entries = sorted(itertools.islice(found, LISTED + 1), key=lambda e: e.name)
        if len(entries) > LISTED:
            tops.append(folder)
            continue
        for entry in entries:
            (folders if entry.is_dir(follow_symlinks=False) else tops).append(entry.path)
    return [*folders, *tops]


def scan_corpus(spark: SparkSession, root: str) -> DataFrame:
    """S1 + S3: every supported regular file under ``root`` -> (path).

    The paths are dealt out evenly, so that reading and chunking spread
    however the folders are laid out. Raises FileNotFoundError /
    NotADirectoryError for a bad root.
    """
    if not os.path.exists(root):
        raise FileNotFoundError(f"no such corpus directory: {root}")
    if not os.path.isdir(root):
        raise NotADirectoryError(f"the corpus is not a directory: {root}")
    slots = spark.sparkContext.defaultParallelism
    tops = _tops(root, slots * 8)
    if not tops:
        return spark.createDataFrame([], "path string")
    entries = spark.createDataFrame([(t,) for t in tops], "path string")
    listed = entries.repartition(min(len(tops), slots * 4)).mapInPandas(_walk, LIST_SCHEMA)
    return listed.where(F.col("is_file") & is_supported_path("path")).select("path").repartition(slots * 4)


def _read_bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows, held = [], 0
        for p in pdf["path"]:
            with open(p, "rb") as fh:
                rows.append((p, fh.read()))
            held += len(rows[-1][1])
            if held >= READ_BYTES:
                yield pd.DataFrame(rows, columns=["path", "content"])
                rows, held = [], 0
        yield pd.DataFrame(rows, columns=["path", "content"])


def read_files(paths: DataFrame) -> DataFrame:
    """(path) -> (path, content BINARY), read by executor tasks."""
    return paths.mapInPandas(_read_bytes, "path string, content binary")


def relative_path(path: Column | str, root: str) -> Column:
    """POSIX path relative to ``root``; a path outside it is an error."""
    path = F.col(path) if isinstance(path, str) else path
    prefix = root.rstrip("/") + "/"
    return F.when(path.startswith(prefix), path.substr(len(prefix) + 1, 1 << 30)).otherwise(
        F.raise_error(F.concat(F.lit("path is outside the project: "), path)).cast("string"))


def decode_documents(files: DataFrame, root: str, mode: str = "strict") -> DataFrame:
    """(path, content) -> (file_path, text).

    ``strict``: invalid UTF-8 anywhere fails the job. ``quarantine``:
    such files are dropped here; see ``invalid_files``.
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError("mode must be 'strict' or 'quarantine'")
    if mode == "quarantine":
        files = files.where(F.is_valid_utf8(F.col("content").cast("string")))
    text = F.decode(F.col("content"), "UTF-8")
    return files.select(relative_path("path", root).alias("file_path"),
                        normalize_newlines(text).alias("text"))


def invalid_files(files: DataFrame) -> DataFrame:
    """Files whose bytes are not valid UTF-8 (the quarantine table)."""
    return files.where(~F.is_valid_utf8(F.col("content").cast("string"))).select("path")


def load_documents(spark: SparkSession, corpus_dir: str, project_root: str | None = None,
                   mode: str = "strict") -> DataFrame:
    """A corpus directory -> documents (file_path, text).

    ``file_path`` is relative to ``project_root`` (default: the current
    directory, like the reference's project-relative paths).
    """
    root = os.path.abspath(project_root or os.getcwd())
    paths = scan_corpus(spark, os.path.abspath(corpus_dir))
    return decode_documents(read_files(paths), root, mode)


def documents_from_table(df: DataFrame, path_col: str = "file_path", text_col: str = "text") -> DataFrame:
    """A table corpus -> documents (file_path, text), newlines normalised;
    unsupported suffixes are dropped like the directory scan does."""
    return df.select(F.col(path_col).alias("file_path"),
                     normalize_newlines(F.col(text_col)).alias("text"))\
        .where(is_supported_path("file_path"))
