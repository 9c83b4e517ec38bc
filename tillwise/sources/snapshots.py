"""Tables whose every change is one small file written last.

A store is a folder with data folders that are never changed and numbered manifests that say which of them make up
each table:

    store/data/snapshot=<id>/...           rows of one write, below it one folder per value of a partition column
    store/manifests/<number>.json          {"tables": {name: {part: [folder, ...]}}, "notes": {...}}

A writer fills a data folder first and then creates the next manifest, which fails if another writer was faster. A job
that dies at any step leaves the tables as they were: its folders are in no manifest, and a manifest cut short is no
JSON and is passed over. Nothing is renamed or deleted on the way, so an object store does as well as a file system.
One manifest may change several tables, which then change together. Readers pin the manifest they began with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.sources.scratch import open_files

_SNAPSHOT = "snapshot"
# The part of a table that is not partitioned, and how Spark names the folder of a null.
WHOLE = ""
NULL_PART = "__HIVE_DEFAULT_PARTITION__"

Parts = dict[str, list[str]]


class Conflict(RuntimeError):
    """Another writer has committed in between."""


@dataclass(frozen=True)
class Manifest:
    """State of a store: for each table its parts and the data folders that hold them; notes of the writers."""

    number: int = -1
    tables: dict[str, Parts] = field(default_factory=dict)
    notes: dict[str, object] = field(default_factory=dict)

    def with_table(self, name: str, parts: Parts | None) -> Manifest:
        """The same with a table replaced, or without it."""
        rest = {n: p for n, p in self.tables.items() if n != name}
        return Manifest(self.number, rest if parts is None else {**rest, name: parts}, self.notes)

    def with_note(self, name: str, value: object) -> Manifest:
        return Manifest(self.number, self.tables, {**self.notes, name: value})


def _file(spark: SparkSession, path: str):
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file, file.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, system = _file(spark, path)
    return [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []


def _manifests(root: str) -> str:
    return f"{root.rstrip('/')}/manifests"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = [n.removesuffix(".json") for n in _names(spark, _manifests(root))]
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def _load(spark: SparkSession, root: str, number: int) -> Manifest | None:
    file, system = _file(spark, f"{_manifests(root)}/{number}.json")
    stream = system.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return Manifest(number, found["tables"], found["notes"])


def current(spark: SparkSession, root: str) -> Manifest:
    """The newest whole manifest; an empty one where nothing was ever committed."""
    for number in _numbers(spark, root):
        found = _load(spark, root, number)
        if found:
            return found
    return Manifest()


def commit(spark: SparkSession, root: str, new: Manifest) -> Manifest:
    """Make ``new`` the state of the store. Fails if it is not based on the newest state."""
    numbers = _numbers(spark, root)
    if current(spark, root).number != new.number:
        raise Conflict(f"{root} was changed by another writer")
    number = max([new.number, *numbers]) + 1
    file, system = _file(spark, f"{_manifests(root)}/{number}.json")
    text = json.dumps({"tables": new.tables, "notes": new.notes}, sort_keys=True)
    try:
        stream = system.create(file, False)
    except Exception as error:
        if "AlreadyExists" in str(error):
            raise Conflict(f"{root} was changed by another writer") from error
        raise
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    return Manifest(number, new.tables, new.notes)


def change(spark: SparkSession, root: str, edit: Callable[[Manifest], Manifest]) -> Manifest:
    """Commit ``edit`` of the newest state, again from the newer one while others are faster.

    ``edit`` only puts folders in place that are written already, so doing it again costs nothing.
    """
    for _ in range(20):
        try:
            return commit(spark, root, edit(current(spark, root)))
        except Conflict:
            continue
    raise Conflict(f"{root}: others were faster twenty times")


def write_folder(df: DataFrame, root: str, partition: str | None = None, beside: Parts | None = None) -> Parts:
    """Write rows to a data folder of their own, in no table yet; its parts.

    With the parts of an earlier call in ``beside``, which must be in no table yet either, the rows join that folder.
    """
    known = next((own[0] for own in (beside or {}).values()), None)
    folder = "/".join(known.split("/")[:2]) if known else f"data/{_SNAPSHOT}={uuid.uuid4().hex}"
    path = f"{root.rstrip('/')}/{folder}"
    writer = df.write.mode("append" if known else "error").option("compression", "zstd")
    with open_files(df.sparkSession):
        (writer.partitionBy(partition) if partition else writer).parquet(path)
    if not partition:
        return {WHOLE: [folder]}
    values = [n.split("=", 1)[1] for n in _names(df.sparkSession, path) if n.startswith(f"{partition}=")]
    return {v: [f"{folder}/{partition}={v}"] for v in sorted(values)}


def added(old: Parts, new: Parts) -> Parts:
    """Parts with the folders of both."""
    return {v: [*old.get(v, []), *new.get(v, [])] for v in sorted({*old, *new})}


def read(spark: SparkSession, root: str, name: str, schema: T.StructType, manifest: Manifest | None = None) -> DataFrame:
    """The table as the manifest has it, by default the newest; without rows if it has none.

    ``schema`` includes the partition column, which prunes folders.
    """
    manifest = manifest or current(spark, root)
    return read_parts(spark, root, manifest.tables.get(name, {}), schema)


def read_parts(spark: SparkSession, root: str, parts: Parts, schema: T.StructType) -> DataFrame:
    """Rows of the given parts."""
    base = root.rstrip("/")
    folders = [f"{base}/{f}" for own in parts.values() for f in own]
    if not folders:
        return spark.createDataFrame([], schema)
    # the folder of the write is a partition column too, which nobody asked for
    found = T.StructType([*schema.fields, T.StructField(_SNAPSHOT, T.StringType())])
    rows = spark.read.schema(found).option("basePath", f"{base}/data").parquet(*folders)
    return rows.select(*[F.col(c) for c in schema.names])


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete data folders that none of the newest ``keep`` manifests has, and older manifests; what was deleted.

    Readers that pinned an older manifest lose their files, and so does a write under way that has not committed.
    """
    numbers = _numbers(spark, root)
    whole = [m for m in (_load(spark, root, n) for n in numbers) if m][:keep]
    if not whole:
        return []
    used = {f.split("/")[1] for m in whole for parts in m.tables.values() for own in parts.values() for f in own}
    base, oldest = root.rstrip("/"), whole[-1].number
    doomed = [f"{base}/data/{n}" for n in _names(spark, f"{base}/data") if n.startswith(_SNAPSHOT) and n not in used]
    doomed += [f"{_manifests(root)}/{n}.json" for n in numbers if n < oldest]
    for path in doomed:
        file, system = _file(spark, path)
        system.delete(file, True)
    return doomed
