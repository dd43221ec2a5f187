"""Folder operations through the Hadoop file system the session already uses."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and host of its file system."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly inside a folder; empty if it is missing."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove_older(spark: SparkSession, path: str, seconds: float) -> bool:
    """Delete a folder last changed more than ``seconds`` ago; True if it was deleted."""
    fs, p = _fs(spark, path)
    changed = fs.getFileStatus(p).getModificationTime() / 1000
    return time.time() - changed > seconds and bool(fs.delete(p, True))


def under(base: str, path: str) -> str:
    """``path`` inside ``base``: leading and trailing slashes go, ``..`` is refused."""
    parts = [p for p in path.split("/") if p]
    if ".." in parts or not parts:
        raise ValueError(f"not a folder below the base: {path!r}")
    return "/".join([base.rstrip("/"), *parts])


def replace_dir(df: DataFrame, target: str, fmt: str, keep: str | None = None, **options: str) -> None:
    """Write beside the target and swap; the old target goes only once the new one is in place.

    A stop between the two renames leaves the folder under a name beside the target;
    ``repair_dir``, which every call runs first, puts it back. With ``keep``, a result without
    rows leaves the old target and raises a ValueError with that text; the written files are
    counted, so ``df`` is evaluated once.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    repair_dir(spark, target)
    fresh, before = f"{target}{NEW}{run}", f"{target}{OLD}{run}"
    fs, new = _fs(spark, fresh)
    try:
        df.write.format(fmt).options(**options).mode("error").save(fresh)
        if keep is not None and not spark.read.format(fmt).schema(df.schema).load(fresh).count():
            raise ValueError(keep)
    except Exception:
        fs.delete(new, True)
        raise
    _, old = _fs(spark, target)
    _, kept = _fs(spark, before)
    replaced = fs.exists(old)
    if replaced and not fs.rename(old, kept):
        raise OSError(f"could not move {target} aside")
    if not fs.rename(new, old):
        if replaced:
            fs.rename(kept, old)
        raise OSError(f"could not rename {fresh} to {target}")
    if replaced:
        fs.delete(kept, True)


NEW, OLD = "__new-", "__old-"


def repair_dir(spark: SparkSession, target: str) -> None:
    """Undo what a stopped ``replace_dir`` left: put an old target back if there is none, and
    delete the remains. One writer per target at a time is assumed."""
    parent, name = target.rsplit("/", 1)
    found = children(spark, parent)
    olds = [n for n in found if n.startswith(name + OLD)]
    fs, place = _fs(spark, target)
    if olds and not fs.exists(place):
        if not fs.rename(_fs(spark, f"{parent}/{olds[0]}")[1], place):
            raise OSError(f"could not put {target} back")
        olds = olds[1:]
    for n in [*olds, *[n for n in found if n.startswith(name + NEW)]]:
        fs.delete(_fs(spark, f"{parent}/{n}")[1], True)
