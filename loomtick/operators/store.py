"""A table of partitions that are replaced as a whole, with one atomic commit per batch."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAME = re.compile(r"(?P<batch>\d{6})-(?P<group>[0-9a-f]{16})-(?P<slice>\d+)")


def group_code(*group: Column | str) -> Column:
    """Sixteen hex digits for a group's values: they name folders, so the values themselves, whatever they hold, never do."""
    return F.lower(F.lpad(F.hex(F.xxhash64(*group)), 16, "0"))


def part_name(batch: int, group: Sequence[Column | str], piece: Column | str) -> Column:
    """The name of a partition: number of its batch, code of its group, slice."""
    piece = F.col(piece) if isinstance(piece, str) else piece
    return F.concat_ws("-", F.lit(f"{batch:06d}"), group_code(*group), piece.cast("string"))


class PartitionStore:
    """Named partitions below one folder of the shared file system.

    A batch writes whole partitions under its own folder and publishes them by renaming one small manifest file, so
    readers see the state before or after the batch and never between. Batch ids are given by the caller and may be any
    string: a retry writes the same folder again instead of a second one, and a batch that was already published is not
    applied twice. Partitions are named by :func:`part_name` and nothing else; the manifest keeps each one's folder and
    its batch, group code and slice as fields. It lists partitions, not rows; a partition is meant to hold tens of
    megabytes or more.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = T.StructType([f for f in schema.fields if f.name != "parte"])
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        at = self._path(f"{self.root}/_manifest")
        if not self._fs.exists(at):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(at)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self) -> dict:
        """``parts``: name → ``folder``, ``batch``, ``group``, ``slice``; ``sizes``: partitions by folder; ``batches``: the ids applied so far."""
        versions = self._versions()
        if not versions:
            return {"parts": {}, "sizes": {}, "batches": []}
        stream = self._fs.open(self._path(f"{self.root}/_manifest/{versions[-1]:010d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _written(self, folder: str) -> list[str]:
        """The partitions whose folders lie below ``folder``."""
        at = self._path(folder)
        names = [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return [n[len("parte=") :] for n in names if n.startswith("parte=")]

    def applied(self, batch: str) -> bool:
        return batch in self.manifest()["batches"]

    def number(self, batch: str) -> int:
        """The batch's number: its place among those applied, or the next one. The same for every retry before publication."""
        done = self.manifest()["batches"]
        return done.index(batch) if batch in done else len(done)

    def parts_of(self, batch: str) -> list[str]:
        """The partitions that were new in a batch."""
        n = self.number(batch)
        return [p for p, x in self.manifest()["parts"].items() if x["batch"] == n]

    def in_groups(self, codes: Iterable[str]) -> list[str]:
        """The partitions of the groups of these codes."""
        wanted = set(codes)
        return [p for p, x in self.manifest()["parts"].items() if x["group"] in wanted]

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of the named partitions (None: all) with their ``parte``; unknown names are empty."""
        state = self.manifest()
        known = state["parts"]
        names = list(known) if parts is None else sorted(set(parts) & set(known))
        schema = T.StructType([*self.schema.fields, T.StructField("parte", T.StringType())])
        if not names:
            return self.spark.createDataFrame([], schema)
        by_folder: dict[str, list[str]] = {}
        for n in names:
            by_folder.setdefault(known[n]["folder"], []).append(n)
        df = None
        for folder, own in sorted(by_folder.items()):  # one scan per batch that still owns partitions; ``parte`` comes from the folder's name
            whole = len(own) == state["sizes"][folder]
            at = [folder] if whole else [f"{folder}/parte={n}" for n in own]
            part = self.spark.read.schema(schema).option("basePath", folder).parquet(*at).select(*schema.names)
            df = part if df is None else df.unionByName(part)
        return df

    def commit(self, batch: str, df: DataFrame) -> list[str]:
        """Replaces exactly the partitions that ``df`` (with ``parte``) holds. Returns their names."""
        before = self.manifest()
        if batch in before["batches"]:
            return []
        folder = f"{self.root}/data/lote={hashlib.sha256(batch.encode()).hexdigest()[:16]}"
        df.select(*self.schema.names, "parte").write.mode("overwrite").partitionBy("parte").parquet(folder)
        names, fields = self._written(folder), {}
        for n in names:
            own = _NAME.fullmatch(n)
            if not own:
                raise ValueError(f"{n!r} is no partition name of this store")
            fields[n] = {"folder": folder, "batch": int(own["batch"]), "group": own["group"], "slice": int(own["slice"])}
        after = {"parts": before["parts"] | fields, "sizes": before["sizes"] | {folder: len(names)}, "batches": [*before["batches"], batch]}
        version = (self._versions() or [0])[-1] + 1
        tmp, final = f"{self.root}/_manifest/.{version:010d}.tmp", f"{self.root}/_manifest/{version:010d}.json"
        out = self._fs.create(self._path(tmp), True)
        out.write(bytearray(json.dumps(after).encode()))
        out.close()
        if not self._fs.rename(self._path(tmp), self._path(final)):
            raise RuntimeError(f"another writer published version {version} of {self.root}")
        return names

    def vacuum(self) -> int:
        """Deletes folders of partitions that newer ones have replaced; returns how many. Readers of earlier states must be done."""
        state, gone = self.manifest(), 0
        live = {f"{x['folder']}/parte={n}" for n, x in state["parts"].items()}
        for folder in state["sizes"]:
            for name in self._written(folder):
                if f"{folder}/parte={name}" not in live:
                    gone += bool(self._fs.delete(self._path(f"{folder}/parte={name}"), True))
        return gone
