"""Versioned snapshots behind a manifest (K1).

A writer writes to a folder that no one else knows, then publishes it by creating
the next numbered entry of the manifest, a small file that names the folder. An
entry is created only if its number is free, so of two writers at once one gets it
and the other sees that it came second; no folder is ever renamed, and a reader
resolves the newest entry and never sees a table half written. Versions that the
newest entries don't name are dropped, together with what writers left that never
published.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .readers import _fs
from .sinks import write_parquet

_ENTRY = re.compile(r"\d{8}\.json")
#: Published versions that stay: the newest, and the one before, which a reader may have resolved already.
KEEP = 2
#: Tries, 0.2 seconds apart, before a writer stops waiting for an entry that another has begun.
PATIENCE = 50
#: Seconds after which a folder without an entry counts as left behind by a writer.
ABANDONED = 24 * 3600


def _names(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with their times of change; empty if there is no folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p)}


def _read(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one; whether it was created."""
    fs, p = _fs(spark, path)
    try:
        stream = fs.create(p, False)
    except Exception as e:   # the store's own exception for a file that exists
        if fs.exists(p):
            return False
        raise e
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


class Snapshots:
    """The versions of one table or file set under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def entries(self) -> list[str]:
        """Names of the manifest's entries, oldest first."""
        return sorted(n for n in _names(self.spark, f"{self.root}/manifest") if _ENTRY.fullmatch(n))

    def newest(self) -> dict | None:
        """The newest entry that is whole (its writer may be about to fill it), or None."""
        for name in reversed(self.entries()):
            text = _read(self.spark, f"{self.root}/manifest/{name}")
            if text.endswith("}"):
                return json.loads(text) | {"entry": name}
        return None

    def path(self, entry: dict) -> str:
        return f"{self.root}/{entry['folder']}"

    def publish(self, inputs: str, write: Callable[[str], str | None]) -> dict:
        """Write a version to a folder of its own and publish it; ``write`` returns what readers need to know.

        If another writer has published the same ``inputs`` meanwhile, its version stands and this one is dropped.
        """
        folder = f"v-{uuid.uuid4().hex}"
        note = write(f"{self.root}/{folder}")
        for _ in range(PATIENCE):
            names, now = self.entries(), self.newest()
            if names and (now is None or now["entry"] != names[-1]):
                time.sleep(0.2)   # another writer has taken the last number and is about to fill its entry
                continue
            if now is not None and now["inputs"] == inputs:
                self._drop(folder)
                return now
            if self._enter(names, folder, inputs, note):
                break
        else:   # that writer died at its entry: the next number is free
            self._enter(self.entries(), folder, inputs, note)
        self.vacuum()
        return {"folder": folder, "inputs": inputs, "note": note}

    def _enter(self, names: list[str], folder: str, inputs: str, note: str | None) -> bool:
        number = int(names[-1].split(".")[0]) + 1 if names else 1
        return _create(self.spark, f"{self.root}/manifest/{number:08d}.json", json.dumps({"folder": folder, "inputs": inputs, "note": note}))

    def _drop(self, folder: str) -> None:
        fs, p = _fs(self.spark, f"{self.root}/{folder}")
        fs.delete(p, True)

    def vacuum(self, keep: int = KEEP, abandoned: int = ABANDONED) -> None:
        """Drop versions that are older than the ``keep`` newest entries, and folders that were left without an entry."""
        names = self.entries()
        stay = {json.loads(t)["folder"] for n in names[-keep:] if (t := _read(self.spark, f"{self.root}/manifest/{n}")).endswith("}")}
        dropped = set()
        for n in names[:-keep]:
            text = _read(self.spark, f"{self.root}/manifest/{n}")
            if text.endswith("}"):
                dropped.add(json.loads(text)["folder"])
        old = 1000 * (time.time() - abandoned)
        for folder, changed in _names(self.spark, self.root).items():
            if folder.startswith("v-") and folder not in stay and (folder in dropped or changed < old):
                self._drop(folder)
        for n in names[:-keep]:
            fs, p = _fs(self.spark, f"{self.root}/manifest/{n}")
            fs.delete(p, False)


def folder(spark: SparkSession, root: str, write: Callable[[str], None], inputs: str = "") -> str:
    """The folder of the version of ``inputs``, written by ``write`` if there is none yet."""
    s = Snapshots(spark, root)
    entry = s.newest()
    if entry is None or entry["inputs"] != inputs:
        entry = s.publish(inputs, write)
    return s.path(entry)


def table(spark: SparkSession, root: str, build: Callable[[], DataFrame], inputs: str, partition_by: str | None = None) -> DataFrame:
    """The table of ``inputs``, built and published if the newest version is of others; read with the schema it was built with."""
    def write(path: str) -> str:
        df = build()
        write_parquet(df, path, partition_by)
        return df.schema.json()
    s = Snapshots(spark, root)
    entry = s.newest()
    if entry is None or entry["inputs"] != inputs:
        entry = s.publish(inputs, write)
    schema = T.StructType.fromJson(json.loads(entry["note"]))
    return spark.read.schema(schema).parquet(s.path(entry))
