"""Stages whose outputs last: a run that was stopped goes on where it stopped.

Each stage has a folder below the root. Its outputs are tables there, and a manifest names the one that holds and what it was
made from: a fingerprint of the stage's inputs (files by name, size and time; other stages by their output), its parameters
and its version. The manifest is written, in one rename, when the table is complete; so a stage that was killed has none,
and is done again. A stage whose fingerprint is that of its manifest is read, not run. Only tables in a stage's own folder
that its manifest doesn't name are ever deleted, and only by a later run of that stage.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession


class Stages:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.ran: list[str] = []
        self.skipped: list[str] = []

    # -- files, in whatever store the root names

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self, name: str):
        return self._path(name).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read(self, name: str) -> dict[str, Any] | None:
        if not self._fs(name).exists(self._path(name)):
            return None
        return json.loads("\n".join(r["value"] for r in self.spark.read.text(name, wholetext=True).collect()))

    def _write(self, name: str, what: Mapping[str, Any]) -> None:
        fs, before = self._fs(name), f"{name}.{uuid.uuid4().hex}"
        out = fs.create(self._path(before))
        out.write(bytearray(json.dumps(what, sort_keys=True).encode()))
        out.close()
        fs.delete(self._path(name), False)
        if not fs.rename(self._path(before), self._path(name)):
            raise OSError(f"can't write {name}")

    def _files(self, path: str) -> list[tuple[str, int, int]]:
        """Name, size and time of each file below a path (or a pattern)."""
        fs, out = self._fs(path), []
        found = list(fs.globStatus(self._path(path)) or [])
        if not found:
            raise FileNotFoundError(path)
        for top in found:
            if top.isFile():
                out.append((top.getPath().toString(), top.getLen(), top.getModificationTime()))
                continue
            files = fs.listFiles(top.getPath(), True)
            while files.hasNext():
                f = files.next()
                out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return sorted(out)

    # -- stages

    def run(self, name: str, make: Callable[[], DataFrame], inputs: Sequence[str | DataFrame] = (), params: Mapping[str, Any] | None = None, version: str = "1", force: bool = False) -> DataFrame:
        """The stage's table: read if it holds, else made by ``make`` and written.

        ``inputs`` are paths, or tables that other stages gave. Whatever else the result depends on belongs in ``params``
        (anything that JSON takes) or, as code does, in ``version``.
        """
        if not name or "/" in name:
            raise ValueError(f"not a stage's name: {name!r}")
        said = [("stage", x._stage_output) if isinstance(x, DataFrame) else ("files", self._files(x)) for x in inputs]
        print_ = hashlib.sha256(json.dumps([said, params or {}, version], sort_keys=True).encode()).hexdigest()
        folder, manifest = f"{self.root}/{name}", f"{self.root}/{name}/manifest.json"
        held = self._read(manifest)
        if held and held["fingerprint"] == print_ and not force and self._fs(folder).exists(self._path(f"{folder}/{held['table']}/_SUCCESS")):
            self.skipped.append(name)
            return self._table(folder, held)
        self._clean(folder, held)
        table = f"table-{uuid.uuid4().hex}"
        df = make()
        df.write.parquet(f"{folder}/{table}")
        held = {"fingerprint": print_, "table": table, "schema": df.schema.jsonValue(), "params": params or {}, "version": version}
        self._write(manifest, held)
        self._clean(folder, held)
        self.ran.append(name)
        return self._table(folder, held)

    def _table(self, folder: str, held: Mapping[str, Any]) -> DataFrame:
        from pyspark.sql.types import StructType

        out = self.spark.read.schema(StructType.fromJson(held["schema"])).parquet(f"{folder}/{held['table']}")
        out._stage_output = f"{folder}/{held['table']}"
        return out

    def _clean(self, folder: str, held: Mapping[str, Any] | None) -> None:
        fs = self._fs(folder)
        if fs.exists(self._path(folder)):
            for x in fs.listStatus(self._path(folder)):
                own = x.getPath().getName()
                if own.startswith("table-") and own != (held or {}).get("table"):
                    fs.delete(x.getPath(), True)
