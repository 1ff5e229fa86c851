"""Several outputs that replace their old ones together.

Each output is first written to a hidden folder beside it. Only when all of
them are complete is a list of the moves stored, the journal; then the moves
are made. A run that fails before that leaves the old outputs as they were. A
run that is cut off between the moves leaves the journal, and `finish` makes
the moves that are left.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from hashlib import sha256
from typing import Any

from pyspark.sql import SparkSession

from sift.sources.scratch import drop_path


def plain(path: str) -> str:
    """A path for comparing: a local one with or without its scheme is the same."""
    if path.startswith("file:"):
        path = path[len("file:") :]
    return "/" + path.strip("/") + "/"


def overlapping(paths: Sequence[str]) -> list[str]:
    """Paths that are the same folder as an earlier one."""
    seen = [plain(path) for path in paths]
    return [path for at, path in enumerate(paths) if seen[at] in seen[:at]]


class Publication:
    """One run's new outputs, for the places in `paths`."""

    def __init__(self, spark: SparkSession, paths: Sequence[str]) -> None:
        self.spark = spark
        self.journal = journal_path(paths)
        run = uuid.uuid4().hex
        # an output inside another one goes last, and is written beside the
        # outer one, which will be replaced as a whole
        self.moves = {
            path: hidden_beside(outermost(path, paths), f"{run}-{at}")
            for at, path in enumerate(sorted(paths, key=lambda p: len(plain(p))))
        }

    def place(self, path: str) -> str:
        """Where to write what shall be at `path`."""
        return self.moves[path]

    def commit(self) -> None:
        """Put all outputs in their places."""
        moves = [[hidden, path] for path, hidden in self.moves.items()]
        write_text(self.spark, self.journal, json.dumps(moves))
        finish(self.spark, self.journal)

    def abandon(self) -> None:
        """Delete what was written, unless the moves have begun."""
        if not _files(self.spark, self.journal).exists(_path(self.spark, self.journal)):
            for hidden in self.moves.values():
                drop_path(self.spark, hidden)


def outermost(path: str, paths: Sequence[str]) -> str:
    """The shortest of `paths` that holds `path`, or is it."""
    return min((p for p in paths if plain(path).startswith(plain(p))), key=lambda p: len(plain(p)))


def hidden_beside(path: str, name: str) -> str:
    """A sibling that Spark's readers pass over."""
    parent, _, last = path.rstrip("/").rpartition("/")
    return f"{parent}/.{last}-{name}"


def journal_path(paths: Sequence[str]) -> str:
    """The journal of all runs that write these outputs, beside the last one."""
    name = sha256("\n".join(map(plain, paths)).encode()).hexdigest()[:16]
    return hidden_beside(outermost(paths[-1], paths), f"moves-{name}")


def finish(spark: SparkSession, journal: str) -> bool:
    """Make the moves that a journal still lists; whether there was one.

    A move whose hidden folder is gone was made. The old output is deleted
    right before its move, so there is no moment without the new one stored.
    """
    files = _files(spark, journal)
    if not files.exists(_path(spark, journal)):
        return False
    for hidden, path in json.loads(read_text(spark, journal)):
        move(spark, hidden, path)
    drop_path(spark, journal)
    return True


def move(spark: SparkSession, hidden: str, path: str) -> None:
    files = _files(spark, path)
    if not files.exists(_path(spark, hidden)):
        return
    target = _path(spark, path)
    files.delete(target, True)
    files.mkdirs(target.getParent())
    if not files.rename(_path(spark, hidden), target):
        raise OSError(f"{hidden} could not be renamed to {path}; the next run tries again")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or not there at all."""
    files, draft = _files(spark, path), f"{path}.{uuid.uuid4().hex}"
    files.mkdirs(_path(spark, path).getParent())
    stream = files.create(_path(spark, draft), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files.delete(_path(spark, path), True)
    if not files.rename(_path(spark, draft), _path(spark, path)):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    stream = _files(spark, path).open(_path(spark, path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _path(spark: SparkSession, path: str) -> Any:
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str) -> Any:
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
