"""Versioned snapshots of a group of tables.

A load writes its tables to a new folder, checks them, and then makes them
visible together by creating one small manifest file. Readers take the highest
manifest, so they see all of a load or nothing of it. Creating a manifest that
exists fails; of two loads that started from the same version only one wins.

A table may be kept in parts, one folder or more for each value of a part column
that is not stored itself. A load then replaces or adds folders of the parts it
touches; the others carry over by path and are not read.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from moorage.session import together


class PublishConflict(Exception):
    """Another load published first."""


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        hadoop = spark._jvm.org.apache.hadoop
        self._path = hadoop.fs.Path
        self._files = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._context = hadoop.fs.FileContext.getFileContext(self._path(root).toUri(), spark._jsc.hadoopConfiguration())
        self._files.mkdirs(self._path(f"{root}/manifests"))

    def version(self) -> int:
        """The published version, 0 before the first load."""
        found = self._files.listStatus(self._path(f"{self.root}/manifests"))
        names = [status.getPath().getName() for status in found]
        return max((int(name[:-5]) for name in names if name.endswith(".json")), default=0)

    def _tables(self, version: int) -> dict[str, dict]:
        if version == 0:
            return {}
        stream = self._files.open(self._path(f"{self.root}/manifests/{version:09d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> dict[str, DataFrame]:
        """Every table as of one version, all from the same one, but for those with two underscores that loads keep for themselves."""
        entries = self._tables(self.version() if version is None else version)
        return {name: self._read(entry) for name, entry in entries.items() if "__" not in name}

    def _read(self, entry: dict) -> DataFrame:
        return self._rows(entry["schema"], _folders(entry))

    def _rows(self, schema: str, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def paths(self, name: str, version: int | None = None) -> list[str]:
        """The folders that hold a table's rows as of one version, oldest first."""
        return _folders(self._tables(self.version() if version is None else version)[name])

    def parts(self, name: str, version: int | None = None) -> dict[str, list[str]]:
        """The folders of each part of a table that is kept in parts."""
        return self._tables(self.version() if version is None else version)[name]["parts"]

    def draft(self) -> Draft:
        """The next version, to be filled table by table."""
        return Draft(self, self.version())

    def publish(
        self,
        tables: dict[str, DataFrame],
        base: int,
        check: Callable[[dict[str, DataFrame]], None] | None = None,
    ) -> int:
        """Write ``tables``, run ``check`` on what was written, then make it version ``base + 1``.

        Tables that are not given carry over from ``base``. Anything that
        raises before the last step leaves the published state as it was.
        """
        draft = Draft(self, base)
        written = {name: draft.put(name, rows) for name, rows in tables.items()}
        if check is not None:
            check(written)
        return draft.publish()

    def sweep(self, keep: int = 1, grace: float = 86_400.0) -> list[str]:
        """Remove versions, drafts and staging folders that nobody needs; returns what went, below the root.

        The newest ``keep`` versions stay, and so does everything younger than ``grace`` seconds: a manifest that old may still
        be read, a folder or draft that old may still be written. Manifests go first, so that a version is never
        offered without its files. Folders that a staying manifest names stay, however old.
        """
        latest, oldest = self.version(), time.time() - grace
        gone, needed = [], set()
        for status in list(self._files.listStatus(self._path(f"{self.root}/manifests"))):
            name = status.getPath().getName()
            young = status.getModificationTime() / 1000 > oldest
            if name.endswith(".json") and (int(name[:-5]) > latest - keep or young):
                needed |= {path for entry in self._tables(int(name[:-5])).values() for path in _folders(entry)}
            elif not young:
                gone.append(f"manifests/{name}")
        for group in ("data", "stage"):
            top = self._path(f"{self.root}/{group}")
            for status in list(self._files.listStatus(top)) if self._files.exists(top) else []:
                place = f"{group}/{status.getPath().getName()}"
                if not any(f"{path}/".startswith(f"{self.root}/{place}/") for path in needed) and self._newest(status) < oldest:
                    gone.append(place)
        for place in gone:
            self._files.delete(self._path(f"{self.root}/{place}"), True)
        return sorted(gone)

    def _newest(self, status) -> float:
        """When anything in a folder was last written."""
        newest, files = status.getModificationTime(), self._files.listFiles(status.getPath(), True)
        while files.hasNext():
            newest = max(newest, files.next().getModificationTime())
        return newest / 1000

    def _create_manifest(self, version: int, text: str) -> None:
        draft = self._path(f"{self.root}/manifests/{uuid.uuid4().hex}.draft")
        out = self._files.create(draft, False)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        final = self._path(f"{self.root}/manifests/{version:09d}.json")
        no_overwrite = self.spark.sparkContext._gateway.new_array(
            self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0
        )
        try:
            self._context.rename(draft, final, no_overwrite)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                raise PublishConflict(f"version {version} was published by another load") from error
            raise


def _folders(entry: dict) -> list[str]:
    if "parts" in entry:
        return [path for part in sorted(entry["parts"]) for path in entry["parts"][part]]
    return entry["paths"]


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema)


class Draft:
    """A version in the making. Its tables can be read back at once but are not visible to others."""

    def __init__(self, store: SnapshotStore, base: int):
        self._store, self.base = store, base
        self._entries = store._tables(base)
        self._folder = f"{store.root}/data/{uuid.uuid4().hex}"

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        """Write one table and return it as written."""
        path = f"{self._folder}/{name}"
        rows.write.parquet(path, compression="zstd")
        self._entries[name] = {"paths": [path], "schema": _schema(rows)}
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def append(self, name: str, rows: DataFrame, top_key: int | None = None) -> DataFrame:
        """Add rows to a table of the base version, whose files stay as they are; no rows leave it unchanged.

        ``top_key`` is the highest key in use with them, for the next load.
        """
        if name not in self._entries or self.in_parts(name):
            found = self.put(name, rows)
            self._entries[name] |= {"top_key": top_key}
            return found
        entry = self._entries[name]
        path = f"{self._folder}/{name}-{uuid.uuid4().hex}"
        rows.write.parquet(path, compression="zstd")
        if not rows.sparkSession.read.schema(rows.schema).parquet(path).isEmpty():
            self._entries[name] = {"paths": [*entry["paths"], path], "schema": entry["schema"], "top_key": top_key}
        return self._store._read(self._entries[name])

    def read(self, name: str, parts: Iterable[str] | None = None) -> DataFrame | None:
        """A table as it is in this draft, or only some of its parts; None if there is no such table."""
        entry = self._entries.get(name)
        if entry is None:
            return None
        if parts is None:
            return self._store._read(entry)
        return self._store._rows(entry["schema"], [path for part in sorted(parts) for path in entry["parts"].get(part, [])])

    def top_key(self, name: str) -> int | None:
        """The highest key in use in a table, if a load has noted it."""
        return self._entries.get(name, {}).get("top_key")

    def write_parts(self, rows: DataFrame, part: str, label: str, dealt: bool = False) -> dict[str, str]:
        """Write rows to one folder for each value of ``part``, which is left out; large values go to several tasks.

        Rows that are ``dealt`` by part already are written as they lie.
        """
        path = f"{self._folder}/{label}-{uuid.uuid4().hex}"
        (rows if dealt else rows.hint("rebalance", part)).write.partitionBy(part).parquet(path, compression="zstd")
        store = self._store
        found = [status.getPath().getName() for status in store._files.listStatus(store._path(path)) if status.isDirectory()]
        return {name.partition("=")[2]: f"{path}/{name}" for name in found if name.startswith(f"{part}=")}

    def put_parts(self, name: str, schema: str, replaced: dict[str, str | None], added: dict[str, str], top_key: int) -> None:
        """Replace the folders of some parts by one or none, then add one to some; other parts stay as they are."""
        parts = dict(self._entries.get(name, {}).get("parts", {}))
        for part, path in replaced.items():
            parts[part] = [path] if path else []
        for part, path in added.items():
            parts[part] = [*parts.get(part, []), path]
        parts = {part: paths for part, paths in parts.items() if paths}
        self._entries[name] = {"parts": parts, "schema": schema, "top_key": top_key}

    def in_parts(self, name: str) -> bool:
        return "parts" in self._entries.get(name, {})

    def put_all(self, loads: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        """Load independent tables at the same time, each straight into the draft."""
        return together({name: lambda name=name, load=load: self.put(name, load()) for name, load in loads.items()})

    def append_all(self, loads: dict[str, Callable[[], tuple[DataFrame, int | None]]]) -> dict[str, DataFrame]:
        """Add to independent tables at the same time; each load gives its rows and the highest key in use with them."""
        return together({name: lambda name=name, load=load: self.append(name, *load()) for name, load in loads.items()})

    def publish(self) -> int:
        """Make every table visible together; tables not put carry over from the base version."""
        self._store._create_manifest(self.base + 1, json.dumps(self._entries))
        return self.base + 1
