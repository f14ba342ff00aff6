"""Sharding by size-tiered compaction.

Arrivals are appended as small immutable Parquet shards. Shards whose sizes are in one tier (a power of ``tier``) and
at least ``run`` in number are merged to files of about ``target_bytes``; merging repeats until no tier has a run. What
counts as the data set is the manifest of the highest version, committed by a step that fails if the version exists
(a hard link on a local file system, else Hadoop's rename without overwriting, which is as atomic as the store makes it;
object stores without such a rename need a single writer), so readers see whole versions only and a job that dies leaves
the last version as it was.

The driver handles the manifest (a row a shard), never rows of the data. A merge is one job for up to 256
groups, without a shuffle; a group holds at most target_bytes, so no task grows with the data or with one hot source.

Rows are kept as they are, repeated ones, nulls and all columns included; an empty arrival adds no shard. Arrivals may
add columns, which are null in earlier rows; a column of another type than before is refused when it arrives.
"""

from __future__ import annotations

import json
import math
import os
import uuid
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

JOB = 256  # groups merged by one job


@dataclass(frozen=True)
class Shard:
    path: str
    size: int
    born: int  # the version that added it


class ShardedTable:
    def __init__(self, spark: SparkSession, folder: str, target_bytes: int = 128 << 20, run: int = 4, tier: int = 4):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.target_bytes, self.run, self.tier = target_bytes, run, tier
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.folder}/manifests"))

    # manifests

    def versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.folder}/manifests"))]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> list[Shard]:
        found = self.versions()
        if not found:
            return []
        version = found[-1] if version is None else version
        stream = self._fs.open(self._path(f"{self.folder}/manifests/v{version:08d}.json"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return [Shard(**s) for s in json.loads(text)["shards"]]

    def commit(self, shards: list[Shard], over: int) -> int:
        """Makes shards version over + 1; fails if another writer has done so."""
        new = over + 1
        place = self._path(f"{self.folder}/manifests/v{new:08d}.json")
        draft = self._path(f"{self.folder}/manifests/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps({"version": new, "shards": [s.__dict__ for s in shards]}).encode()))
        finally:
            out.close()
        try:
            self._publish(draft, place)
        except Exception as e:
            raise RuntimeError(f"version {new} has been committed by another writer") from e
        finally:
            self._fs.delete(draft, False)
        return new

    def _publish(self, draft, place) -> None:
        """Gives draft the name place, or fails if that is taken; of two writers at once, one fails."""
        if self._fs.getScheme() == "file":
            os.link(draft.toUri().getPath(), place.toUri().getPath())
            return
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        plain = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        plain[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context.rename(draft, place, plain)

    def _latest(self) -> int:
        found = self.versions()
        return found[-1] if found else 0

    # data

    def _files(self, folder: str, version: int) -> list[Shard]:
        found, line = [], [folder]
        while line:
            for s in self._fs.listStatus(self._path(line.pop())):
                name = s.getPath().getName()
                if s.isDirectory():
                    line.append(s.getPath().toString())
                elif name.endswith(".parquet"):
                    found.append(Shard(s.getPath().toString(), int(s.getLen()), version))
        return sorted(found, key=lambda s: s.path)

    def append(self, arrival: DataFrame) -> int:
        """Adds a shard for each partition of arrival that has rows, and commits."""
        version = self._latest()
        before = self.manifest()
        if before:
            kinds = {f.name: f.dataType for f in self.read().schema}
            if odd := [f.name for f in arrival.schema if kinds.get(f.name, f.dataType) != f.dataType]:
                raise ValueError(f"columns of another type than before: {odd}")
        folder = f"{self.folder}/data/{version + 1:08d}-{uuid.uuid4().hex[:8]}"
        arrival.write.parquet(folder)
        shards = self._files(folder, version + 1)
        if shards:  # one job names the files that have rows
            full = {r[0] for r in self.spark.read.parquet(folder).select(F.element_at(F.split("_metadata.file_path", "/"), -1)).distinct().collect()}
            shards = [s for s in shards if s.path.rpartition("/")[2] in full]
        return self.commit(before + shards, version)

    def plan(self) -> list[list[Shard]]:
        """Groups to merge: similar in size, at least run of them, target_bytes together at most."""
        tiers: dict[int, list[Shard]] = defaultdict(list)
        for s in self.manifest():
            if 2 * s.size <= self.target_bytes:
                tiers[int(math.log(max(s.size, 1), self.tier))].append(s)
        groups = []
        for shards in (tiers[k] for k in sorted(tiers)):
            if len(shards) < self.run:
                continue
            group, size = [], 0
            for s in sorted(shards, key=lambda s: (s.born, s.path)):
                if group and size + s.size > self.target_bytes:
                    groups.append(group)
                    group, size = [], 0
                group.append(s)
                size += s.size
            groups.append(group)
        return [g for g in groups if len(g) > 1]

    def compact(self) -> int:
        """Merges until no tier has a run; the number of rounds."""
        rounds = 0
        while groups := self.plan():
            version = self._latest()
            folder = f"{self.folder}/data/{version + 1:08d}-{uuid.uuid4().hex[:8]}"
            number = {s.path for g in groups for s in g}
            columns = self.read().columns
            merged = []
            for k in range(0, len(groups), JOB):
                # one task reads the shards of one group and writes one file: no shuffle
                parts = [self._read(g).coalesce(1) for g in groups[k : k + JOB]]
                reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).write.parquet(f"{folder}/{k:06d}")
                merged += self._files(f"{folder}/{k:06d}", version + 1)
            kept = [s for s in self.manifest() if s.path not in number]
            self.commit(kept + merged, version)
            rounds += 1
            if set(self.read().columns) != set(columns):
                raise RuntimeError("a merge has changed the columns")
        return rounds

    def vacuum(self) -> int:
        """Deletes data and manifests of versions before the last; their readers must have ended."""
        keep, gone = {s.path for s in self.manifest()}, 0
        root = self._path(f"{self.folder}/data")
        if not self._fs.exists(root):
            return 0
        for s in self._files(f"{self.folder}/data", 0):
            if s.path not in keep:
                gone += bool(self._fs.delete(self._path(s.path), False))
        for v in self.versions()[:-1]:
            self._fs.delete(self._path(f"{self.folder}/manifests/v{v:08d}.json"), False)
        return gone

    def read(self, version: int | None = None) -> DataFrame:
        shards = self.manifest(version)
        if not shards:
            raise ValueError("the table has no shards")
        return self._read(shards)

    def _read(self, shards: list[Shard]) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(*[s.path for s in shards])
