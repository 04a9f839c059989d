"""Versions of a collection: what one run writes is published as a whole, and older versions stay readable until they are pruned.

A version is a folder below the collection's root that holds any number of tables (shards, routing, documents). It counts as
published once it holds an empty file named `_published`, which is created last. Creating one object is atomic on file
systems and object stores alike, so readers see all of a version or nothing of it; no folder is ever renamed or overwritten.
A run that dies leaves a draft without that file, which no reader looks at. Of two runs at the same time the one that began
later is the newest; they never share a folder.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

PUBLISHED = "_published"
_FOLDER = re.compile(r"v-(\d{9})-[0-9a-f]{32}")


def _file_system(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path


def _folders(spark: SparkSession, root: str) -> list[tuple[str, bool]]:
    """Names of all versions, oldest first, and whether each is published."""
    fs, path = _file_system(spark, root)
    if not fs.exists(path(root)):
        return []
    names = sorted(n for n in (x.getPath().getName() for x in fs.listStatus(path(root))) if _FOLDER.fullmatch(n))
    return [(n, fs.exists(path(f"{root}/{n}/{PUBLISHED}"))) for n in names]


def published(spark: SparkSession, root: str) -> list[str]:
    """Names of the published versions, oldest first."""
    return [n for n, done in _folders(spark, root) if done]


@contextmanager
def draft(spark: SparkSession, root: str) -> Iterator[str]:
    """The folder of a new version, for any writers; it is published when the block ends, and never if the block fails."""
    taken = _folders(spark, root)
    number = int(_FOLDER.fullmatch(taken[-1][0])[1]) + 1 if taken else 1
    at = f"{root}/v-{number:09d}-{uuid.uuid4().hex}"
    fs, path = _file_system(spark, root)
    fs.mkdirs(path(at))
    yield at
    fs.create(path(f"{at}/{PUBLISHED}"), False).close()


def read(spark: SparkSession, root: str, table: str, version: str | None = None) -> DataFrame:
    """A table of the newest published version, or of the named one. A name that isn't published, or a root without versions, is an error."""
    names = published(spark, root)
    if not names or version not in (None, *names):
        raise LookupError(f"no published version {version or ''} below {root}")
    return spark.read.parquet(f"{root}/{version or names[-1]}/{table}")


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the newest `keep` published versions, and drafts begun before them; returns the names deleted.

    Drafts begun later may still be written, so they stay.
    """
    if keep < 1:
        raise ValueError("at least one version is kept")
    names = published(spark, root)
    oldest = names[-keep:][0] if names else ""
    fs, path = _file_system(spark, root)
    gone = [n for n, _ in _folders(spark, root) if n < oldest]
    for n in gone:
        # the mark goes first, so that no reader takes a half-deleted version for a whole one
        fs.delete(path(f"{root}/{n}/{PUBLISHED}"), False)
        fs.delete(path(f"{root}/{n}"), True)
    return gone
