"""File-level helpers on the cluster file system (driver-side metadata calls only)."""
from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Partition values that one task writes side by side; rows of further ones are sorted, as by default.
OPEN_FILES = 32
_LOCK, _INSIDE = threading.Lock(), {}


@contextmanager
def unsorted_writes(spark: SparkSession):
    """Partitioned writes inside keep a file open per partition value instead of sorting all rows of
    a task by partition first, so a task holds and spills no rows, whatever their number. The
    session's own setting is back afterwards, also when writes of several threads overlap."""
    with _LOCK:
        depth, before = _INSIDE.get(id(spark), (0, None))
        if not depth:
            before = spark.conf.get(_WRITERS, None)
            spark.conf.set(_WRITERS, str(OPEN_FILES))
        _INSIDE[id(spark)] = (depth + 1, before)
    try:
        yield
    finally:
        with _LOCK:
            depth, before = _INSIDE.pop(id(spark))
            if depth > 1:
                _INSIDE[id(spark)] = (depth - 1, before)
            elif before is None:
                spark.conf.unset(_WRITERS)
            else:
                spark.conf.set(_WRITERS, before)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def publish_single_files(spark: SparkSession, staging: str, pattern: str,
                         target_of) -> list[str]:
    """Move each data file matching ``staging/pattern`` to ``target_of(path)``.

    Used after a write that produced exactly one file per output partition directory,
    to give the files stable names (as landed source files have). Only file names
    move through the driver; renames are metadata operations.
    """
    fs, Path = _fs(spark, staging)
    moved = []
    statuses = fs.globStatus(Path(staging.rstrip("/") + "/" + pattern)) or []
    for st in statuses:
        src = st.getPath()
        dst = Path(target_of(src.toString()))
        fs.mkdirs(dst.getParent())
        if not fs.rename(src, dst):
            raise OSError(f"rename failed: {src} -> {dst}")
        moved.append(dst.toString())
    return sorted(moved)


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    fs, Path = _fs(spark, pattern)
    return sorted(st.getPath().toString() for st in (fs.globStatus(Path(pattern)) or [])
                  if st.isFile())


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    fs, Path = _fs(spark, pattern)
    return sorted(st.getPath().toString() for st in (fs.globStatus(Path(pattern)) or []) if st.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    fs, Path = _fs(spark, path)
    return bool(fs.exists(Path(path)))


def delete(spark: SparkSession, path: str) -> bool:
    """Recursive delete of a table/partition directory on the cluster file system."""
    fs, Path = _fs(spark, path)
    return bool(fs.delete(Path(path), True))


SWAP, ASIDE = "_swap-", "_aside-"


def _join(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def replace_folder(spark: SparkSession, source: str, target: str, keep: str | None = None, between=lambda step: None) -> None:
    """Put folder ``source`` in the place of folder ``target`` (renames; no data is read).

    The old folder is moved aside, the new one moved in, the old one removed, or moved to
    ``keep`` where that is given. An intent
    record beside the target, written first and removed last, names both, so a load that
    stops in between is finished or undone by ``recover_swaps``: old or new rows, never
    none. A missing source leaves the target's place empty. ``between`` is called with the
    number of each finished step (tests stop there).
    """
    fs, Path = _fs(spark, target)
    parent, name = target.rstrip("/").rsplit("/", 1)
    intent, aside = _join(parent, SWAP + name), _join(parent, ASIDE + name)
    if fs.exists(Path(intent)):
        recover_swaps(spark, parent)
    fs.mkdirs(Path(parent))
    moves_in = fs.exists(Path(source))
    out = fs.create(Path(intent), True)
    out.write(bytearray(f"{'move' if moves_in else 'empty'}\n{source}\n{keep or ''}\n".encode()))
    out.close()
    between(1)
    if fs.exists(Path(target)):
        _rename(fs, Path, target, aside)
    between(2)
    if moves_in:
        _rename(fs, Path, source, target)
    between(3)
    _put_away(fs, Path, aside, keep)
    between(4)
    fs.delete(Path(intent), True)


def _put_away(fs, Path, aside: str, keep: str | None) -> None:
    if keep and fs.exists(Path(aside)):
        fs.mkdirs(Path(keep).getParent())
        _rename(fs, Path, aside, keep)
    fs.delete(Path(aside), True)


def _rename(fs, Path, source: str, target: str) -> None:
    if not fs.rename(Path(source), Path(target)):
        raise OSError(f"rename failed: {source} -> {target}")


def recover_swaps(spark: SparkSession, parent: str) -> dict[str, str]:
    """Finish or undo the swaps that a stopped load left under ``parent``: name -> what was done.

    A swap whose old folder still stands is undone (nothing had moved); one whose old folder
    lies aside is finished, or undone if the new folder is gone.
    """
    fs, Path = _fs(spark, parent)
    done = {}
    for record in list_files(spark, _join(parent, SWAP + "*")):
        name = record.rsplit("/", 1)[1][len(SWAP):]
        target, aside = _join(parent, name), _join(parent, ASIDE + name)
        stream = fs.open(Path(record))
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        kind, source, keep = (text.split("\n") + ["", "", ""])[:3]
        if text.count("\n") < 3 or kind not in ("move", "empty"):
            done[name] = "undone"                           # the record itself was not finished: nothing had moved
        elif kind == "empty":
            done[name] = "finished"
            if not fs.exists(Path(aside)):
                fs.delete(Path(target), True)
        elif fs.exists(Path(target)) and fs.exists(Path(source)):
            done[name] = "undone"
        elif fs.exists(Path(target)):
            done[name] = "finished"
        elif fs.exists(Path(source)):
            _rename(fs, Path, source, target)
            done[name] = "finished"
        elif fs.exists(Path(aside)):
            _rename(fs, Path, aside, target)
            done[name] = "undone"
        else:
            done[name] = "undone"
        _put_away(fs, Path, aside, keep if done[name] == "finished" else None)
        fs.delete(Path(record), True)
    return done


def hidden_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files that Spark's readers pass over because their name begins with '_' (metadata only)."""
    return [p for p in list_files(spark, pattern) if p.rsplit("/", 1)[-1].startswith("_")]


def list_data_files(spark: SparkSession, patterns: str | list[str], with_time: bool = False) -> list[tuple]:
    """(path, name, size), with ``with_time`` the modification time too, of the data files
    matched by glob patterns; like Spark's own listing, names starting with '.' or '_' are
    hidden. Metadata only."""
    out = []
    for pattern in [patterns] if isinstance(patterns, str) else patterns:
        fs, Path = _fs(spark, pattern)
        for st in fs.globStatus(Path(pattern)) or []:
            sts = [st] if st.isFile() else list(fs.listStatus(st.getPath()) or [])
            for f in sts:
                name = f.getPath().getName()
                if f.isFile() and not name.startswith((".", "_")):
                    row = (f.getPath().toString(), name, int(f.getLen()))
                    out.append((*row, int(f.getModificationTime())) if with_time else row)
    return sorted(set(out))
