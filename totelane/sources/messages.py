"""Outboxes written for the conveyor, whole or not at all and once per run.

A Spark data source. Each task writes its messages to a file of its own; when all tasks are
done, one small file lists them and makes them count. A task that fails and is run again, or
a job that dies, leaves files that no list names; a run that is repeated finds its list and
changes nothing. So each message of a run is there once, under its run and sequence number.

    register(spark)
    outbox.write.format("conveyor").option("run", "run-17").save("/data/conveyor")
    spark.read.format("conveyor").load("/data/conveyor")
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource

from totelane.operators.dispatch import no_answers
from totelane.sources.parts import Files

FORMAT = "conveyor"
MESSAGES = "run string, seq bigint, payload string"
#: Messages that a task reads at a time.
BATCH_ROWS = 10_000


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(_conveyor())


def _list_of(run: str) -> str:
    """The name of the file that lists the messages of a run."""
    return f"{uuid.uuid5(uuid.NAMESPACE_OID, run).hex}.json"


def send(outbox: DataFrame, path: str, run: str) -> DataFrame:
    """Write the outbox of a run; answers come later, so there are none yet. A run whose list is
    there is not written again."""
    register(outbox.sparkSession)
    if _list_of(run) in Files(outbox.sparkSession, path).names("runs"):
        return no_answers(outbox)
    outbox.select("seq", "payload").write.format(FORMAT).mode("append").option("run", run).save(path)
    return no_answers(outbox)


def _conveyor() -> type[DataSource]:
    # Local classes travel whole to executors that do not have this package.
    import io
    import json
    import uuid
    from dataclasses import dataclass
    from itertools import islice

    from pyspark.sql.datasource import (
        DataSourceArrowWriter,
        DataSourceReader,
        InputPartition,
        WriterCommitMessage,
    )

    batch_rows = BATCH_ROWS

    def opened(path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")

    def names(files, folder: str) -> list[str]:
        from pyarrow import fs

        found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return sorted(x.base_name for x in found if x.type == fs.FileType.File)

    @dataclass
    class Written(WriterCommitMessage):
        file: str | None
        rows: int

    class Writer(DataSourceArrowWriter):
        def __init__(self, path: str, run: str, columns: list[str]):
            self.path, self.run, self.columns = path, run, columns

        def _list(self, root: str) -> str:
            return f"{root}/runs/{uuid.uuid5(uuid.NAMESPACE_OID, self.run).hex}.json"

        def write(self, iterator):
            files, root = opened(self.path)
            name, rows, out = f"{uuid.uuid4().hex}.jsonl", 0, None
            seq, payload = (self.columns.index(x) for x in ("seq", "payload"))
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    files.create_dir(f"{root}/messages")
                    out = files.open_output_stream(f"{root}/messages/{name}", compression=None)
                sent = zip(batch.column(seq).to_pylist(), batch.column(payload).to_pylist())
                lines = (json.dumps({"run": self.run, "seq": n, "payload": text}) for n, text in sent)
                out.write(("\n".join(lines) + "\n").encode())
                rows += batch.num_rows
            if out is not None:
                out.close()
            return Written(name if rows else None, rows)

        def commit(self, messages):
            files, root = opened(self.path)
            written = [x.file for x in messages if x is not None and x.file]
            target = self._list(root)
            files.create_dir(f"{root}/runs")
            if target.rsplit("/", 1)[1] in names(files, f"{root}/runs"):
                self._remove(files, root, written)
                return
            part = f"{root}/messages/{uuid.uuid4().hex}.list"
            with files.open_output_stream(part, compression=None) as out:
                out.write(json.dumps({"run": self.run, "files": written}).encode())
            files.move(part, target)

        def abort(self, messages):
            files, root = opened(self.path)
            self._remove(files, root, [x.file for x in messages if x is not None and x.file])

        def _remove(self, files, root: str, written: list[str]) -> None:
            for name in written:
                files.delete_file(f"{root}/messages/{name}")

    class Reader(DataSourceReader):
        def __init__(self, path: str):
            self.path = path

        def partitions(self):
            files, root = opened(self.path)
            found = []
            for name in names(files, f"{root}/runs"):
                with files.open_input_stream(f"{root}/runs/{name}", compression=None) as source:
                    found += json.loads(source.read())["files"]
            return [InputPartition(x) for x in found]

        def read(self, partition):
            if partition is None:  # nothing was written
                return
            import pyarrow as pa

            files, root = opened(self.path)
            columns = {"run": pa.string(), "seq": pa.int64(), "payload": pa.string()}
            with files.open_input_stream(f"{root}/messages/{partition.value}", compression=None) as source:
                lines = io.BufferedReader(source, 1 << 20)
                while some := list(islice(lines, batch_rows)):
                    rows = json.loads(b"[" + b",".join(some) + b"]")
                    yield pa.record_batch(
                        {name: pa.array([x[name] for x in rows], kind) for name, kind in columns.items()}
                    )

    class Conveyor(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def schema(self) -> str:
            return MESSAGES

        def writer(self, schema, overwrite):
            if overwrite:
                raise ValueError("messages that were sent cannot be replaced")
            return Writer(self.options["path"], self.options["run"], schema.fieldNames())

        def reader(self, schema):
            return Reader(self.options["path"])

    return Conveyor
