"""Files that appear whole, and a store of numbered batches built on them.

A folder that Spark writes fills up file by file. Readers therefore look at
small marker files only, which name the folders that are complete, and a marker
appears in one step. Nothing that is read is ever overwritten.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from activity_lake.sources.tables import path_missing, remove_path


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def put_file(spark: SparkSession, path: str, text: str = "") -> None:
    """Create a small file that nobody sees before it is complete.

    The writer that finds it there already is refused, so two that number the
    same thing cannot both go on.
    """
    target, files = _file_system(spark, path)
    if files.exists(target):
        raise FileExistsError(path)
    part, _ = _file_system(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    out = files.create(part)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(part, target):
        files.delete(part, False)
        raise FileExistsError(path)


def get_file(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if there is none."""
    target, files = _file_system(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> dict[str, int]:
    """What a folder holds and when each was changed, in milliseconds; nothing if it is missing."""
    if path_missing(spark, path):
        return {}
    target, files = _file_system(spark, path)
    found = {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(target)}
    return {name: changed for name, changed in found.items() if not name.startswith((".", "_"))}


def _numbered(found: dict[str, int]) -> dict[int, str]:
    """Names that begin with a number and a dash; of several with one number the first."""
    out: dict[int, str] = {}
    for name in sorted(found, reverse=True):
        number = name.partition("-")[0]
        if number.isdigit():
            out[int(number)] = name
    return out


@dataclass(frozen=True)
class BatchStore:
    """Numbered batches, of which a snapshot covers the first ones.

    ``changes/<n>-<id>`` has the rows of batch n, ``commits/<n>-<id>`` marks them
    complete; ``snapshots/<n>-<id>`` covers all up to n and ``pointer/<n>-<id>``
    marks it. Only marked folders are read, and none behind a gap in the
    numbers, so a batch whose tasks are still moving their files into place is
    neither shown by half nor covered.
    """

    spark: SparkSession
    path: str

    def claim(self, kind: str, first: int = 0) -> None:
        """State at the first use what the batches are; another kind of writer is refused later on."""
        about = f"{self.path}/about.json"
        if get_file(self.spark, about) is None:
            put_file(self.spark, about, json.dumps({"kind": kind, "first": first}))
        found = json.loads(get_file(self.spark, about))
        if found["kind"] != kind:
            raise ValueError(f"{self.path} holds {found['kind']}, not {kind}")

    def first(self) -> int:
        about = get_file(self.spark, f"{self.path}/about.json")
        return json.loads(about)["first"] if about else 0

    def snapshot(self) -> tuple[int, str | None]:
        """Last batch in the current snapshot, and its folder; one below the first without any."""
        marked = _numbered(names(self.spark, f"{self.path}/pointer"))
        if not marked:
            return self.first() - 1, None
        return max(marked), f"{self.path}/snapshots/{marked[max(marked)]}"

    def committed(self, after: int) -> dict[int, str]:
        """Folders of the unbroken run of marked batches that follows."""
        marked = _numbered(names(self.spark, f"{self.path}/commits"))
        found: dict[int, str] = {}
        while (number := after + len(found) + 1) in marked:
            found[number] = f"{self.path}/changes/{marked[number]}"
        return found

    def last(self) -> int:
        upto, _ = self.snapshot()
        return upto + len(self.committed(upto))

    def add(self, df: DataFrame, number: int) -> bool:
        """Write a batch and mark it; a batch that is there already is left as it is.

        An attempt that fails leaves a folder without a marker, and the next
        one writes a folder of its own.
        """
        last = self.last()
        if number <= last:
            return False
        if number > last + 1:
            raise ValueError(f"batch {number} does not follow {last}")
        name = f"{number}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/changes/{name}")
        put_file(self.spark, f"{self.path}/commits/{name}")
        return True

    def read(self, schema: T.StructType) -> tuple[DataFrame, int]:
        """Snapshot and later batches together, and the last number among them."""
        upto, folder = self.snapshot()
        found = self.committed(upto)
        folders = [*([folder] if folder else []), *found.values()]
        reader = self.spark.read.schema(schema)
        return reader.parquet(*folders) if folders else self.spark.createDataFrame([], schema), upto + len(found)

    def point(self, df: DataFrame, number: int) -> None:
        """Write a snapshot of all up to ``number`` and then point to it."""
        name = f"{number}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/snapshots/{name}")
        put_file(self.spark, f"{self.path}/pointer/{name}")

    def prune(self, keep_hours: float = 24.0) -> int:
        """Remove folders that the pointer has superseded, with their markers; returns how many folders.

        Folders younger than ``keep_hours`` stay for readers that still use them.
        """
        upto, folder = self.snapshot()
        before, removed = (time.time() - 3600 * keep_hours) * 1000, 0
        for part, marks in (("changes", "commits"), ("snapshots", "pointer")) if folder else ():
            for name, changed in names(self.spark, f"{self.path}/{part}").items():
                number = name.partition("-")[0]
                covered = number.isdigit() and int(number) <= upto and not folder.endswith(f"/{part}/{name}")
                if covered and changed <= before:
                    remove_path(self.spark, f"{self.path}/{part}/{name}")
                    remove_path(self.spark, f"{self.path}/{marks}/{name}")
                    removed += 1
        return removed
