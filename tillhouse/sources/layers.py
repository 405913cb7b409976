"""Layered tables on a file system, published by version."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tillhouse.schema import SCHEMAS

# Older manifest entries than this many are removed; readers only ever need the last one.
KEPT_ENTRIES = 100


class ConflictError(RuntimeError):
    """Someone else published a table that this load was replacing."""


@dataclass(frozen=True)
class Version:
    """What a table consists of: its number counts the publishes, its folders hold the rows."""

    number: int = 0
    folders: tuple[str, ...] = ()


Versions = dict[tuple[str, str], Version]

# Folders whose rows no later load changes have names that begin so.
CLOSED = "closed-"


def closed_folders(version: Version) -> tuple[str, ...]:
    return tuple(f for f in version.folders if f.startswith(CLOSED))


@dataclass(frozen=True)
class Written:
    """Folders on disk that were written on top of the version `seen`, not visible yet.

    They follow whatever the table holds (`append`), or only those of its folders that are `kept`.
    """

    layer: str
    name: str
    folders: tuple[str, ...]
    seen: Version
    append: bool
    frame: DataFrame
    kept: tuple[str, ...] = ()


class Layers:
    """Tables under `<root>/<layer>/<name>/version=<unique id>`.

    A load writes folders of its own and then creates the next entry of the manifest, which is
    what makes them visible, all together. A plan may therefore read a table that it replaces,
    and a load that dies half way leaves readers on the old versions.

    Entries are numbered and each lists the folders of all tables. Creating one fails where its
    number is taken, and the publish is then put on top of the newer entry: appended folders are
    added to whatever the table is by now, and a replacement of a table that has changed since
    it was read is refused with `ConflictError`. The file system must create files exclusively.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_manifest/{name}")

    def _fs(self):
        return self._path(".").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        fs, folder = self._fs(), self._path(".")
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _entry(self, number: int) -> dict | None:
        """An entry, or None while it is being written or when its writer died."""
        stream = self._fs().open(self._path(f"{number:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except json.JSONDecodeError:
            return None
        finally:
            stream.close()

    def _state(self) -> tuple[int, int, Versions]:
        """(highest number, number of the last whole entry, its tables); one entry is read."""
        numbers = self._numbers()
        for number in reversed(numbers):
            if (entry := self._entry(number)) is not None:
                tables = {tuple(k.split("/", 1)): Version(v["number"], tuple(v["folders"])) for k, v in entry["tables"].items()}
                return numbers[-1], number, tables
        return (numbers[-1] if numbers else 0), 0, {}

    def versions(self) -> Versions:
        """The published version of each table."""
        return self._state()[2]

    def path(self, layer: str, name: str, folder: str) -> str:
        return f"{self.root}/{layer}/{name}/version={folder}"

    def paths(self, layer: str, name: str) -> list[str]:
        """The folders of a published table."""
        return [self.path(layer, name, f) for f in self.versions()[layer, name].folders]

    def _read(self, layer: str, name: str, folders: tuple[str, ...]) -> DataFrame:
        schema = SCHEMAS.get(layer, {}).get(name)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        paths = [self.path(layer, name, f) for f in folders]
        if len(paths) == 1 and "/" not in folders[0]:
            return reader.parquet(paths[0])
        return reader.option("basePath", f"{self.root}/{layer}/{name}").parquet(*paths).drop("version")

    def tables(self, *names: tuple[str, str]) -> list[DataFrame]:
        """Published tables, all as of the same look at the manifest."""
        known = self.versions()
        lost = [f"{layer}.{name}" for layer, name in names if (layer, name) not in known]
        if lost:
            raise LookupError(f"not loaded: {', '.join(lost)}")
        return [self._read(layer, name, known[layer, name].folders) for layer, name in names]

    def table(self, layer: str, name: str) -> DataFrame:
        return self.tables((layer, name))[0]

    def write(
        self,
        layer: str,
        name: str,
        df: DataFrame,
        known: Versions,
        append: bool = False,
        partition_by: list[str] | None = None,
        kept: tuple[str, ...] = (),
    ) -> Written:
        """Write the rows that follow the version in `known`, or take its place but for the folders `kept`."""
        seen = known.get((layer, name), Version())
        folder = uuid.uuid4().hex
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(layer, name, folder))
        folders = (*seen.folders, folder) if append else (*kept, folder)
        return Written(layer, name, (folder,), seen, append, self._read(layer, name, folders), kept)

    def partitions(self, layer: str, name: str, folders: tuple[str, ...]) -> list[str]:
        """The partitions of a table's folders, as folders of their own that a later write may keep."""
        found = []
        for folder in folders:
            if "/" in folder:
                found.append(folder)
                continue
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(layer, name, folder))
            names = [status.getPath().getName() for status in self._fs().listStatus(path) if status.isDirectory()]
            found += [f"{folder}/{n}" for n in sorted(names) if "=" in n]
        return found

    def folder_frame(self, layer: str, name: str, folders: tuple[str, ...]) -> DataFrame:
        """The rows of some folders of a table, one at least."""
        return self._read(layer, name, folders)

    def write_split(
        self, layer: str, name: str, closed: DataFrame, open_: DataFrame, known: Versions
    ) -> Written:
        """Write rows that are final and rows that are not into folders of their own.

        Folders of final rows that the table has already are kept as they are; the rest is replaced.
        """
        seen = known.get((layer, name), Version())
        final, other = CLOSED + uuid.uuid4().hex, uuid.uuid4().hex
        for folder, df in ((final, closed), (other, open_)):
            df.write.mode("errorifexists").parquet(self.path(layer, name, folder))
        kept = closed_folders(seen)
        frame = self._read(layer, name, (*kept, final, other))
        return Written(layer, name, (final, other), seen, False, frame, kept)

    def _create(self, number: int, entry: dict) -> bool:
        """Whether this call created the entry; False where its number is taken."""
        try:
            out = self._fs().create(self._path(f"{number:012d}.json"), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName() or "already exists" in str(error.java_exception):
                return False
            raise
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        return True

    def _followed(self, number: int) -> bool:
        """Whether every later entry was made on top of this one or of one that was."""
        chain = {number}
        for later in [n for n in self._numbers() if n > number]:
            entry = self._entry(later)
            if entry is not None and entry["after"] not in chain:
                return False
            chain.add(later)
        return True

    def publish(self, written: list[Written]) -> None:
        """Make all of `written` visible at once, on top of what others published meanwhile."""
        while True:
            highest, last, tables = self._state()
            for w in written:
                now = tables.get((w.layer, w.name), Version())
                if not w.append and now.number != w.seen.number:
                    raise ConflictError(f"{w.layer}.{w.name} was published by another load")
                before = now.folders if w.append else w.kept
                tables[w.layer, w.name] = Version(now.number + 1, (*before, *w.folders))
            entry = {
                "after": last,
                "at": datetime.now(timezone.utc).isoformat(),
                "tables": {"/".join(k): {"number": v.number, "folders": list(v.folders)} for k, v in tables.items()},
            }
            # One that overtook this entry while it was being written did not see it: publish again.
            if self._create(highest + 1, entry) and self._followed(highest + 1):
                for old in self._numbers()[:-KEPT_ENTRIES]:
                    self._fs().delete(self._path(f"{old:012d}.json"), False)
                return

    def replace(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Write and publish one table."""
        written = self.write(layer, name, df, self.versions())
        self.publish([written])
        return written.frame

    def append(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Add rows to a table and publish it; nothing is visible if the write dies."""
        written = self.write(layer, name, df, self.versions(), append=True)
        self.publish([written])
        return self.table(layer, name)

    def compact(self, layer: str, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """Rewrite an appended table as one folder; refused if rows are added meanwhile."""
        known = self.versions()
        rows = self._read(layer, name, known[layer, name].folders)
        written = self.write(layer, name, rows, known, partition_by=partition_by)
        self.publish([written])
        return written.frame
