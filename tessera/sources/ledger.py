"""A table format with atomic commits, as a connector of the Python data source API.

A ledger is a folder of Parquet parts and numbered manifests. A part belongs to the table only if the last manifest lists it:

* every write task writes one part under a name of its own and reports name, rows and the least and greatest value of each column;
* the driver's commit writes the next manifest (all earlier parts and the new ones, or only the new ones on overwrite) beside the
  others and renames it, so a reader sees the table before or after a write, never between. A commit whose number
  is taken meanwhile fails and leaves the table as it was;
* a task that is lost or repeated leaves a part that no manifest lists; ``abort`` removes what tasks reported, :func:`vacuum` the rest.

Reading plans one partition for each part. Pushed comparisons with constants drop the parts whose ranges cannot match (they stay filters as well,
since a part that may match holds other rows too). Parts and manifests are reached by ``pyarrow.fs`` from the path, so any storage with
a pyarrow file system can be used by driver and executors alike. NULL and NaN are in no range; parts that hold them are kept for null tests.
"""

from __future__ import annotations

import json
import posixpath
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual, WriterCommitMessage)
from pyspark.sql.types import StructType

MANIFEST = "_manifest-"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def manifests(store: fs.FileSystem, folder: str) -> list[str]:
    """Paths of the manifests, oldest first."""
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found if posixpath.basename(f.path).startswith(MANIFEST) and f.path.endswith(".json"))


def last_manifest(path: str) -> dict:
    store, folder = open_folder(path)
    names = manifests(store, folder)
    if not names:
        return {"number": 0, "schema": None, "parts": []}
    with store.open_input_stream(names[-1]) as f:
        return json.loads(f.read())


@dataclass
class Part(WriterCommitMessage):
    """One written file: rows and value range of each column (JSON values)."""
    name: str
    rows: int
    ranges: dict[str, list]


@dataclass
class PartPartition(InputPartition):
    path: str


def ranges_of(low: dict, high: dict) -> dict[str, list]:
    """Ranges of the columns whose least and greatest value JSON can hold exactly."""
    return {c: [low[c], high[c]] for c in low if isinstance(low[c], (bool, int, float, str)) and low[c] == low[c] and high[c] == high[c]}


class LedgerWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema.json(), overwrite
        self.base = last_manifest(path)["number"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        """One part of the batches of this task; a task without rows writes none and its name is empty."""
        store, folder = open_folder(self.path)
        name, sink, rows, low, high = f"part-{uuid.uuid4().hex}.parquet", None, 0, {}, {}
        for batch in iterator:
            if not batch.num_rows:
                continue
            if sink is None:
                store.create_dir(folder, recursive=True)
                sink = pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=store)
            sink.write_batch(batch)
            rows += batch.num_rows
            for c, column in zip(batch.schema.names, batch.columns):
                if pa.types.is_floating(column.type):
                    column = pc.filter(column, pc.invert(pc.is_nan(column)))
                if pa.types.is_integer(column.type) or pa.types.is_floating(column.type) or pa.types.is_string(column.type):
                    m = pc.min_max(column)
                    for held, key, better in ((low, "min", min), (high, "max", max)):
                        v = m[key].as_py()
                        if v is not None:
                            held[c] = better(held[c], v) if c in held else v
        if sink is None:
            return Part("", 0, {})
        sink.close()
        return Part(name, rows, ranges_of(low, high))

    def commit(self, messages: list[Part | None]) -> None:
        store, folder = open_folder(self.path)
        store.create_dir(folder, recursive=True)
        now = last_manifest(self.path)
        if now["number"] != self.base:
            self.abort(messages)
            raise RuntimeError(f"{self.path} was written meanwhile: manifest {now['number']}, not {self.base}")
        parts = [] if self.overwrite else now["parts"]
        parts += [{"name": m.name, "rows": m.rows, "ranges": m.ranges} for m in messages if m and m.name]
        body = json.dumps({"number": self.base + 1, "schema": json.loads(self.schema), "parts": parts})
        tmp = f"{folder}/.{uuid.uuid4().hex}"
        with store.open_output_stream(tmp) as f:
            f.write(body.encode())
        store.move(tmp, f"{folder}/{MANIFEST}{self.base + 1:012d}.json")

    def abort(self, messages: list[Part | None]) -> None:
        store, folder = open_folder(self.path)
        for m in messages:
            if m and m.name:
                store.delete_file(f"{folder}/{m.name}")


def may_match(part: dict, tests: list[Filter]) -> bool:
    """Whether the ranges of a part leave room for rows that pass all tests."""
    for t in tests:
        name = ".".join(t.attribute)
        if name not in part["ranges"]:
            return False        # only NULL or NaN, which pass no comparison
        lo, hi = part["ranges"][name]
        ok = {EqualTo: lambda v: lo <= v <= hi, GreaterThan: lambda v: hi > v, GreaterThanOrEqual: lambda v: hi >= v,
              LessThan: lambda v: lo < v, LessThanOrEqual: lambda v: lo <= v,
              In: lambda vs: any(lo <= v <= hi for v in vs if v is not None)}[type(t)]
        if not ok(t.value):
            return False
    return True


class LedgerReader(DataSourceReader):
    RANGED = (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, In)

    def __init__(self, path: str):
        self.path, self.tests = path, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of numbers and text prune parts; every filter is left to Spark as well."""
        kinds = {f["name"]: f["type"] for f in (last_manifest(self.path)["schema"] or {"fields": []})["fields"]}
        ranged = {"byte", "short", "integer", "long", "string"}       # NaN is above all numbers in Spark: doubles are not pruned
        for f in filters:
            if isinstance(f, self.RANGED) and kinds.get(".".join(f.attribute)) in ranged:
                self.tests.append(f)
            yield f

    def partitions(self) -> list[PartPartition]:
        parts = [p for p in last_manifest(self.path)["parts"] if may_match(p, self.tests)]
        return [PartPartition(p["name"]) for p in parts]

    def read(self, partition: PartPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:       # a table without parts is planned as one empty partition
            return
        store, folder = open_folder(self.path)
        with pq.ParquetFile(store.open_input_file(f"{folder}/{partition.path}")) as f:
            yield from f.iter_batches()


class LedgerSource(DataSource):
    """``format("ledger")``: option ``path`` is the folder."""

    @classmethod
    def name(cls) -> str:
        return "ledger"

    def schema(self) -> StructType:
        found = last_manifest(self.options["path"])["schema"]
        if found is None:
            raise FileNotFoundError(f"no ledger at {self.options['path']}")
        return StructType.fromJson(found)

    def reader(self, schema: StructType) -> LedgerReader:
        return LedgerReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> LedgerWriter:
        return LedgerWriter(self.options["path"], schema, overwrite)


def register(spark: SparkSession) -> None:
    """Make ``format("ledger")`` known to the session, with filter pushdown. The connector travels by value, so Python
    workers need not find this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LedgerSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def vacuum(path: str) -> int:
    """Remove the parts that the last manifest does not list; the number of removed files."""
    store, folder = open_folder(path)
    listed = {p["name"] for p in last_manifest(path)["parts"]}
    stray = [f.path for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
             if posixpath.basename(f.path).startswith("part-") and posixpath.basename(f.path) not in listed]
    for name in stray:
        store.delete_file(name)
    return len(stray)
