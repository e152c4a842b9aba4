"""Tables whose contents are replaced as a whole, or not at all.

Two ways, both of which write the new rows beside the old ones first, so that a write that fails half way
changes nothing and a table can be replaced by rows that are read from itself:

* ``replace_version``: the table folder holds data folders of their own and numbered manifests.
  A new manifest is put in place by one rename that must not overwrite, after all its data is written;
  readers (``read_version``) follow the highest number. Of two writers at once both get a number, and
  the later one holds. The version before stays until the one after it is replaced, for readers that
  still use it.
* ``swap_folder``: for readers that open the folder itself. The old folder steps aside, the new one takes
  its name, then the old one goes; ``settle`` puts the old one back if a run ended in between.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFESTS = "_versions"
KEEP = 2


class Folder:
    """The few operations on a Hadoop path that the protocol needs."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self.fs = self._path(self.path).getFileSystem(self.conf)

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(path))) if self.exists(path) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self.fs.create(self._path(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> bool:
        """Give ``old`` the name ``new`` unless something has it already."""
        none = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.path).toUri(), self.conf)
        qualified = [self.fs.makeQualified(self._path(p)) for p in (old, new)]
        try:
            context.rename(*qualified, none)
        except Exception as e:
            if "already exist" in str(e) or "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


# --- manifests --------------------------------------------------------------------------------

def _versions(folder: Folder) -> list[tuple[int, str]]:
    return [(int(n), f"{folder.path}/{MANIFESTS}/{n}") for n in folder.names(f"{folder.path}/{MANIFESTS}") if n.isdigit()]


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(_versions(Folder(spark, path)))


def current(spark: SparkSession, path: str) -> dict | None:
    """The newest manifest ({"number", "data", "schema"}), or None."""
    folder = Folder(spark, path)
    known = _versions(folder)
    return json.loads(folder.read(known[-1][1])) | {"number": known[-1][0]} if known else None


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table at ``path`` as its newest manifest names it (or that of ``number``, while it is kept)."""
    folder = Folder(spark, path)
    known = dict(_versions(folder))
    if not known:
        raise FileNotFoundError(f"{path} has no version")
    about = json.loads(folder.read(known[max(known) if number is None else number]))
    schema = T.StructType.fromJson(about["schema"])
    return spark.read.schema(schema).parquet(f"{folder.path}/{about['data']}").select(*schema.fieldNames())


def replace_version(df: DataFrame, path: str, partition_by=None, keep: int = KEEP) -> int:
    """Replace the table at ``path`` by the rows of ``df``; returns the number of the new version."""
    spark = df.sparkSession
    folder = Folder(spark, path)
    data = f"data-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{folder.path}/{data}")
    draft = f"{folder.path}/{MANIFESTS}/draft-{data}"
    folder.write(draft, json.dumps({"data": data, "schema": json.loads(df.schema.json())}))
    number = max([n for n, _ in _versions(folder)], default=0) + 1
    while not folder.rename(draft, f"{folder.path}/{MANIFESTS}/{number:012d}"):
        number += 1  # another writer was faster
    for n, manifest in _versions(folder)[:-keep]:
        if n < number:
            old = json.loads(folder.read(manifest))["data"]
            folder.delete(manifest)
            folder.delete(f"{folder.path}/{old}")
    return number


def remove_unfinished(spark: SparkSession, path: str) -> list[str]:
    """Delete what failed writes left; only while nobody writes. Returns the names."""
    folder = Folder(spark, path)
    used = {json.loads(folder.read(m))["data"] for _, m in _versions(folder)}
    left = [n for n in folder.names(folder.path) if n.startswith("data-") and n not in used]
    drafts = [f"{MANIFESTS}/{n}" for n in folder.names(f"{folder.path}/{MANIFESTS}") if n.startswith("draft-")]
    for name in (*left, *drafts):
        folder.delete(f"{folder.path}/{name}")
    return [*left, *drafts]


# --- plain folders ----------------------------------------------------------------------------

def settle(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap that ended in between."""
    folder = Folder(spark, path)
    aside = f"{folder.path}._old"
    if folder.exists(aside):
        if folder.exists(folder.path):
            folder.delete(aside)
        else:
            folder.rename(aside, folder.path)


def swap_folder(df: DataFrame, path: str, partition_by=None) -> str:
    """Write ``df`` as Parquet beside ``path`` and let it take that name."""
    spark = df.sparkSession
    folder = Folder(spark, path)
    settle(spark, path)
    fresh, aside = f"{folder.path}._new-{uuid.uuid4().hex}", f"{folder.path}._old"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    try:
        writer.parquet(fresh)
    except Exception:
        folder.delete(fresh)
        raise
    if folder.exists(folder.path):
        folder.rename(folder.path, aside)
    folder.rename(fresh, folder.path)
    folder.delete(aside)
    return path
