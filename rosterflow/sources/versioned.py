"""Tables whose content is named by a manifest file.

A table is a folder of data folders, which are written once and never changed,
and of numbered manifests.  A manifest lists the data folders of each part of
the table.  A change writes a new data folder first and the next manifest last,
by one rename, so a reader finds either the old content or the new one; a
killed write leaves only a folder that no manifest names.  Such folders, and
those of manifests before the previous one, are removed by the next change.  A
part that does not change keeps its folders and is neither read nor written.

One writer at a time; any number of readers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Parts = dict[str, list[str]]
KEPT = 2  # manifests whose data stays, so that a reader of the previous one can finish


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        root = self._hadoop(self.path)
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, folder: str) -> list[str]:
        at = self._hadoop(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _load(self, name: str) -> dict:
        stream = self._fs.open(self._hadoop(f"{self.path}/_manifests/{name}"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names(f"{self.path}/_manifests") if n.endswith(".json") and n[:-5].isdigit()]

    def manifest(self, version: int | None = None) -> dict | None:
        """``version``, ``parts``, ``schema`` and ``note`` of the newest (or the named) version; None before the first."""
        have = self.versions()
        if not have:
            return None
        return self._load(f"{max(have) if version is None else version:012d}.json")

    def write(self, df: DataFrame) -> str:
        """Write a data folder and return its name; no reader sees it until a manifest lists it."""
        name = f"data-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        return name

    def folders(self, names: list[str], schema: T.StructType) -> DataFrame:
        """The rows of data folders, which may be none."""
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{n}" for n in names])

    def commit(self, parts: Parts, schema: T.StructType, note: dict | None = None) -> int:
        """Make ``parts`` the content of the table, and remove what no kept manifest lists."""
        before = self.versions()
        version = max(before, default=-1) + 1
        text = json.dumps({"version": version, "parts": parts, "schema": schema.jsonValue(), "note": note or {}})
        final = self._hadoop(f"{self.path}/_manifests/{version:012d}.json")
        draft = self._hadoop(f"{self.path}/_manifests/.{version:012d}-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise RuntimeError(f"{self.path}: another writer made version {version}")
        self._vacuum([*before, version][-KEPT:])
        return version

    def _vacuum(self, kept: list[int]) -> None:
        listed = {f for v in kept for names in self.manifest(v)["parts"].values() for f in names}
        for name in self._names(self.path):
            if name.startswith("data-") and name not in listed:
                self._fs.delete(self._hadoop(f"{self.path}/{name}"), True)
        for name in self._names(f"{self.path}/_manifests"):
            if not (name.endswith(".json") and int(name[:-5]) in kept):
                self._fs.delete(self._hadoop(f"{self.path}/_manifests/{name}"), False)

    # -- what jobs use -----------------------------------------------------
    def read(self, parts: list[str] | None = None) -> DataFrame | None:
        """The table, or some parts of it; None before the first version."""
        m = self.manifest()
        if m is None:
            return None
        names = [f for part, folders in m["parts"].items() if parts is None or part in parts for f in folders]
        return self.folders(names, T.StructType.fromJson(m["schema"]))

    def replace(self, df: DataFrame, part: str = "", note: dict | None = None) -> int:
        """Make ``df`` the whole content of one part; the other parts stay as they are."""
        m = self.manifest()
        parts = dict(m["parts"]) if m else {}
        parts[part] = [self.write(df)]
        return self.commit(parts, df.schema, note)

    def put_batch(self, df: DataFrame, batch_id: int, stream: str, *,
                  merge: Callable[[DataFrame], DataFrame] | None = None, most: int = 16) -> int:
        """Add the rows of a micro-batch of ``stream``, once however often the batch is run.

        Another stream's rows go: a stream that lost its checkpoint begins with
        an empty table at its first batch, and readers see the old rows until
        then.  From ``most`` batches on, ``merge`` makes one folder of the
        earlier ones, so their number stays bounded and a merged row is written
        again only every ``most`` batches.
        """
        parts = self.parts_before(batch_id, stream)
        earlier = [f for names in parts.values() for f in names]
        if merge is not None and len(earlier) >= most:
            parts = {"merged": [self.write(merge(self.folders(earlier, df.schema)))]}
        parts[str(batch_id)] = [self.write(df)]
        return self.commit(parts, df.schema, {"stream": stream, "batch": batch_id})

    def parts_before(self, batch_id: int, stream: str) -> Parts:
        """The parts that earlier batches of ``stream`` have made."""
        m = self.manifest()
        if m is None or m["note"].get("stream") != stream:
            return {}
        return {p: names for p, names in m["parts"].items() if p == "merged" or int(p) < batch_id}

    def before_batch(self, batch_id: int, stream: str, schema: T.StructType) -> DataFrame:
        return self.folders([f for names in self.parts_before(batch_id, stream).values() for f in names], schema)
