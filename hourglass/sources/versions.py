"""A versioned parquet table: an upsert snapshot with an atomic pointer.

Layout under one folder:

* ``base-*``   a compacted snapshot: one row per key;
* ``delta-*``  the rows of one batch, reduced to one row per key;
* ``commits/<version>.json``  which base and deltas make up a version, the
  last batch in it, and the caller's own values (a watermark, say).

Data folders are written first, under names of their own.  A commit renames
a finished file to the next version's name and fails if that exists, so a
reader sees a version whole or not at all, a crash before the rename leaves
folders that nothing refers to, and of two writers one has to start again.
A batch that the last commit holds already is a no-op.

After ``max_deltas`` batches the deltas are merged into a new base, so a read
costs the snapshot and fewer than ``max_deltas`` batches, however many came.
What only older versions refer to is deleted then, but for the version before,
which readers may still be at.
"""

from __future__ import annotations

import json
import uuid
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedup import keep_latest

BATCH = "_batch"


class Conflict(RuntimeError):
    """Another writer has committed the next version."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, max_deltas: int = 8):
        self.spark, self.path, self.max_deltas = spark, path.rstrip("/"), max_deltas
        jvm = spark.sparkContext._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(self.path).getFileSystem(self._conf)

    # --- commits ----------------------------------------------------------

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def _names(self, folder: str = "") -> list[str]:
        at = self._at(folder) if folder else self._hadoop.Path(self.path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("commits") if n.endswith(".json") and not n.startswith((".", "_"))]

    def commit_of(self, version: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/commits/{version:012d}.json", wholetext=True).first()[0])

    def current(self) -> dict | None:
        """The last commit: version, batch, base, deltas, schema, extra."""
        v = self.versions()
        return self.commit_of(v[-1]) if v else None

    def _commit(self, state: dict) -> None:
        target = self._at(f"commits/{state['version']:012d}.json")
        temporary = self._at(f"commits/_{uuid.uuid4().hex}")
        out = self._fs.create(temporary, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        gateway = self.spark.sparkContext._gateway
        nothing = gateway.new_array(self._hadoop.Options.Rename, 0)  # without OVERWRITE
        context = self._hadoop.FileContext.getFileContext(target.toUri(), self._conf)
        try:
            context.rename(temporary, target, nothing)
        except Exception as e:
            self._fs.delete(temporary, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"version {state['version']} of {self.path} exists") from e
            raise

    # --- reading ----------------------------------------------------------

    def _parts(self, state: dict) -> DataFrame:
        schema = StructType.fromJson(state["schema"])
        folders = [f"{self.path}/{n}" for n in [*filter(None, [state["base"]]), *state["deltas"]]]
        return self.spark.read.schema(schema).parquet(*folders)

    def read(self, key_cols: Sequence[str], seq_cols: Sequence[str], version: int | None = None) -> DataFrame | None:
        """The rows of a version (the last one by default): per key the greatest ``seq_cols``, then the latest batch."""
        state = self.current() if version is None else self.commit_of(version)
        if state is None:
            return None
        parts = self._parts(state)
        one = parts if not state["deltas"] else newest(parts, key_cols, [*seq_cols, BATCH])
        return one.drop(BATCH)

    # --- writing ----------------------------------------------------------

    def merge(self, batch: DataFrame, batch_id: int, key_cols: Sequence[str], seq_cols: Sequence[str], extra: dict | None = None) -> bool:
        """Upsert a batch; returns whether it was new.  New columns widen the schema, older rows have nulls there."""
        state = self.current()
        if state and state["batch"] >= batch_id:
            return False
        one = keep_latest(batch, key_cols, seq_cols).withColumn(BATCH, F.lit(batch_id).cast("long"))
        schema = widened(StructType.fromJson(state["schema"]), one.schema) if state else one.schema
        name = f"delta-{batch_id}-{uuid.uuid4().hex[:8]}"
        one.write.parquet(f"{self.path}/{name}")
        new = {"version": state["version"] + 1 if state else 0, "batch": batch_id, "base": state["base"] if state else None,
               "deltas": [*(state["deltas"] if state else []), name], "schema": schema.jsonValue(), "extra": extra or {}}
        if len(new["deltas"]) >= self.max_deltas:
            base = f"base-{new['version']}-{uuid.uuid4().hex[:8]}"
            newest(self._parts(new), key_cols, [*seq_cols, BATCH]).write.parquet(f"{self.path}/{base}")
            new.update(base=base, deltas=[])
        self._commit(new)
        if not new["deltas"]:
            self.vacuum()
        return True

    def replace(self, batch_id: int, make: Callable[[DataFrame | None, dict], DataFrame], extra: dict | None = None) -> bool:
        """Commit ``make(rows so far, extra so far)`` as the whole next version."""
        state = self.current()
        if state and state["batch"] >= batch_id:
            return False
        rows = make(self._parts(state) if state else None, state["extra"] if state else {})
        base = f"base-{batch_id}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.path}/{base}")
        self._commit({"version": state["version"] + 1 if state else 0, "batch": batch_id, "base": base, "deltas": [],
                      "schema": rows.schema.jsonValue(), "extra": extra or {}})
        self.vacuum()
        return True

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the folders that none of the last ``keep`` versions refers to, and older commits; returns their names.

        Not while another writer is at work: its folders aren't committed yet."""
        held = self.versions()
        states = [self.commit_of(v) for v in held[-keep:]]
        used = {n for s in states for n in [s["base"], *s["deltas"]]}
        gone = [n for n in self._names() if n.startswith(("base-", "delta-")) and n not in used]
        gone += [f"commits/{v:012d}.json" for v in held[:-keep]]
        for n in gone:
            self._fs.delete(self._at(n), True)
        return gone


def newest(parts: DataFrame, key_cols: Sequence[str], seq_cols: Sequence[str]) -> DataFrame:
    """Per key the row with the greatest ``seq_cols``, of folders that hold a key once each.

    A key then has a row a folder at most, so nothing is gained by reducing
    before the exchange, and no key makes a large window."""
    later = Window.partitionBy(*key_cols).orderBy(*[F.col(c).asc_nulls_first() for c in seq_cols])
    last = parts.withColumn("_hg_later", F.lead(F.lit(True)).over(later))
    return last.where(F.col("_hg_later").isNull()).drop("_hg_later")


def widened(old: StructType, new: StructType) -> StructType:
    """The old fields, then the fields that only ``new`` has."""
    return StructType([*old.fields, *(f for f in new.fields if f.name not in old.fieldNames())])
