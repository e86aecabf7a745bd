"""Tables that change together: each change is a new snapshot, and one manifest names its tables.

The tables of a change are written to a folder of their own, where nobody reads. Then the manifest of
the next version is put in its place by one rename that fails if there is one already. So a reader sees
all tables of a version or none of them, a writer that dies leaves the version before, and of two
writers that started from one version the second is told so.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

DIGITS = 20


class Conflict(RuntimeError):
    """Another writer has published the version meanwhile."""


class Snapshots:
    """Versions of a set of tables below ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        conf = spark._jsc.hadoopConfiguration()
        self._folder = hadoop.FileSystem.get(hadoop.Path(self.root).toUri(), conf)
        self._files = hadoop.FileContext.getFileContext(self._folder.getUri(), conf)
        self._rename = hadoop.Options.Rename

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        folder = self._path(f"{self.root}/manifests")
        if not self._folder.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._folder.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n[:1].isdigit() and n.endswith(".json"))

    def version(self) -> int:
        """The last version; 0 if nothing is published yet."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """``version``, ``tables`` (name -> folder below the root) and ``load`` of a version."""
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "tables": {}, "load": None}
        stream = self._folder.open(self._path(self._manifest(version)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def read(self, version: int | None = None) -> dict[str, DataFrame]:
        """All tables of one version (default: the last), whatever is published meanwhile."""
        tables = self.manifest(version)["tables"]
        return {name: self.spark.read.parquet(f"{self.root}/{at}") for name, at in tables.items()}

    def publish(
        self, tables: dict[str, DataFrame | Callable[[dict[str, DataFrame]], DataFrame]], base: int,
        load: str | None = None,
    ) -> int:
        """Write ``tables`` and make them version ``base`` + 1; tables not named stay as they are.

        Tables are written in turn. One that is a function gets those written before it, so that it
        can build on what stands there. A ``load`` that is published already is not loaded again: its
        version is returned, so a job that died after its change may simply run once more.
        """
        done = self._loaded(load)
        if done:
            return done
        folder = f"data/{uuid.uuid4().hex}"
        fresh: dict[str, DataFrame] = {}
        for name, table in tables.items():
            path = f"{self.root}/{folder}/{name}"
            (table if isinstance(table, DataFrame) else table(fresh)).write.parquet(path)
            fresh[name] = self.spark.read.parquet(path)
        kept = self.manifest(base)["tables"]
        manifest = {
            "version": base + 1, "load": load,
            "tables": {**kept, **{name: f"{folder}/{name}" for name in tables}},
        }
        self._put(manifest)
        return base + 1

    def _loaded(self, load: str | None) -> int | None:
        found = (v for v in reversed(self.versions()) if load and self.manifest(v)["load"] == load)
        return next(found, None)

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifests/{version:0{DIGITS}d}.json"

    def _put(self, manifest: dict) -> None:
        """The whole manifest under another name first; then it appears by one rename."""
        draft = self._path(f"{self.root}/manifests/.{uuid.uuid4().hex}")
        stream = self._folder.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        place = self._path(self._manifest(manifest["version"]))
        options = self.spark.sparkContext._gateway.new_array(self._rename, 1)
        options[0] = self._rename.NONE  # an existing manifest is not replaced
        try:
            self._files.rename(draft, place, options)
        except Exception as refused:
            self._folder.delete(draft, False)
            if self._folder.exists(place):
                raise Conflict(f"version {manifest['version']} of {self.root} is published already") from refused
            raise

    def expire(self, keep: int = 2) -> list[int]:
        """Take back versions but the last ``keep``, with the tables that no kept version names.

        Folders of writers that died, or are still at work, are left alone: no manifest names them.
        """
        versions = self.versions()
        old, kept = versions[:-keep] if keep else [], versions[-keep:]
        used = {at for v in kept for at in self.manifest(v)["tables"].values()}
        for v in old:
            unused = set(self.manifest(v)["tables"].values()) - used
            self._folder.delete(self._path(self._manifest(v)), False)
            for at in unused:
                self._folder.delete(self._path(f"{self.root}/{at}"), True)
        return old
