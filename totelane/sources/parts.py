"""Tables kept as parts by the hash of a key, and the small files that say which part is where.

A version of a table names a folder per part. A writer that changes few keys writes their
parts anew and takes the folders of all others from the version before, so the cost of a
change grows with the parts it touches and not with the table.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART = "part"


class TakenError(RuntimeError):
    """A file of that name is there already."""


def part_of(key: str | Column, parts: int) -> Column:
    """The part of a key; all nulls are in one."""
    text = F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(""))
    draw = F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("bigint")
    return F.pmod(draw, F.lit(parts)).cast("int")


def parts_of(keys: DataFrame, key: str, parts: int) -> list[int]:
    """The parts of some keys; at most ``parts`` numbers come to the driver."""
    found = keys.select(part_of(key, parts).alias(PART)).distinct().collect()
    return sorted(row[PART] for row in found)


class Files:
    """Small files and folder listings through the file system of ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _system(self, name: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        path = hadoop.Path(name if name.startswith(self.root) else f"{self.root}/{name}")
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return path, path.getFileSystem(conf), conf

    def names(self, folder: str) -> list[str]:
        """What is in a folder, in order; nothing where there is none."""
        path, files, _ = self._system(folder)
        if not files.exists(path):
            return []
        return sorted(entry.getPath().getName() for entry in files.listStatus(path))

    def read(self, name: str) -> dict:
        path, files, _ = self._system(name)
        source = files.open(path)
        try:
            return json.loads(bytes(source.readAllBytes()).decode())
        finally:
            source.close()

    def put_once(self, name: str, row: dict) -> None:
        """A file that must not be there yet, complete from the start."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        target, files, conf = self._system(name)
        written, _, _ = self._system(f"written/{uuid.uuid4().hex}")
        files.mkdirs(target.getParent())
        out = files.create(written, False)
        out.write(bytearray((json.dumps(row) + "\n").encode()))
        out.close()
        hadoop = jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(files.makeQualified(target).toUri(), conf)
        never_over = gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            context.rename(files.makeQualified(written), files.makeQualified(target), never_over)
        except Py4JJavaError as failed:
            files.delete(written, False)
            if "FileAlreadyExists" in failed.java_exception.getClass().getName():
                raise TakenError(f"{name} is taken") from failed
            raise

    def remove(self, folder: str) -> bool:
        path, files, _ = self._system(folder)
        return files.delete(path, True)

    def write_parts(self, rows: DataFrame, key: str, parts: int, folder: str) -> dict[int, str]:
        """Write ``rows`` by the part of their ``key`` column; the folder of each part that has
        rows. A part that is much larger than others, for one key with very many rows, is
        written by several tasks."""
        placed = rows.withColumn(PART, part_of(key, parts))
        placed.hint("rebalance", PART).write.partitionBy(PART).mode("error").parquet(f"{self.root}/{folder}")
        found = (re.fullmatch(rf"{PART}=(\d+)", name) for name in self.names(folder))
        return {int(one[1]): f"{folder}/{one[0]}" for one in found if one}

    def read_parts(self, folders: dict[int, str], schema, only: list[int] | None = None) -> DataFrame:
        """The rows of all parts, or of some; parts without rows have no folder."""
        chosen = folders if only is None else {n: folders[n] for n in only if n in folders}
        if not chosen:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{chosen[n]}" for n in sorted(chosen)]
        return self.spark.read.schema(schema).parquet(*paths)
