"""The outbox as a committed sink."""

from __future__ import annotations

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceArrowWriter

from tests.conftest import as_set
from totelane.sources import messages


@pytest.fixture
def conveyor(spark, folder):
    messages.register(spark)
    path = folder("conveyor")

    def send(run, rows, **options):
        frame = rows.write.format("conveyor").option("run", run).mode("append")
        frame.save(path)

    def sent():
        return as_set(spark.read.format("conveyor").load(path))

    return path, send, sent


def outbox(spark, numbers):
    rows = [(n, f'{{"tote":"T{n}"}}', "more") for n in numbers]
    return spark.createDataFrame(rows, "seq long, payload string, kind string").repartition(3)


def test_each_message_of_a_run_is_there_once(spark, conveyor):
    path, send, sent = conveyor
    send("a", outbox(spark, range(20)))
    want = {("a", n, f'{{"tote":"T{n}"}}') for n in range(20)}
    assert sent() == want
    # A repeated run, with other rows even, changes nothing and leaves no files.
    before = set(os.listdir(f"{path}/messages"))
    send("a", outbox(spark, range(5, 25)))
    assert sent() == want and set(os.listdir(f"{path}/messages")) == before
    send("b", outbox(spark, [1, 2]))
    assert sent() == want | {("b", n, f'{{"tote":"T{n}"}}') for n in (1, 2)}
    send("c", outbox(spark, []).limit(0))
    assert len(sent()) == 22


def test_a_task_that_fails_sends_nothing(spark, conveyor):
    path, send, sent = conveyor
    send("a", outbox(spark, [1]))
    broken = outbox(spark, range(2, 60)).withColumn(
        "payload", F.when(F.col("seq") == 59, F.raise_error(F.lit("gone"))).otherwise(F.col("payload"))
    )
    with pytest.raises(Exception, match="gone"):
        send("b", broken)
    assert {x[1] for x in sent()} == {1}
    send("b", outbox(spark, range(2, 60)))
    assert {x[1] for x in sent()} == set(range(1, 60))


def test_messages_go_and_come_back_in_batches(spark, folder):
    # The classes travel whole, so what they are is asked of the source itself.
    source = messages._conveyor()({"path": folder("conveyor"), "run": "a"})
    writer = source.writer(outbox(spark, [1]).schema, False)
    assert isinstance(writer, DataSourceArrowWriter)
    numbers = range(2 * messages.BATCH_ROWS + 7)
    texts = pa.array([f'{{"tote":"ß\n{n}"}}' if n % 5 else None for n in numbers])
    rows = pa.record_batch({"seq": pa.array(numbers), "payload": texts, "kind": texts})
    writer.commit([writer.write(iter([rows.slice(0, 0), rows.slice(0, 9), rows.slice(9)])), None])
    reader = source.reader(None)
    (part,) = reader.partitions()
    batches = list(reader.read(part))
    assert [x.num_rows for x in batches] == [messages.BATCH_ROWS, messages.BATCH_ROWS, 7]
    got = pa.Table.from_batches(batches)
    assert got["run"].unique().to_pylist() == ["a"]
    assert got["seq"].to_pylist() == list(numbers) and got["payload"].to_pylist() == texts.to_pylist()


def test_a_run_that_was_sent_is_not_worked_out_again(spark, folder):
    path, rows = folder("conveyor"), outbox(spark, [1, 2]).withColumns({"id": F.lit(1), "tote_id": F.lit("T")})
    messages.send(rows, path, "a")
    broken = rows.withColumn("payload", F.raise_error(F.lit("gone")).cast("string"))
    assert messages.send(broken, path, "a").isEmpty()
    assert spark.read.format(messages.FORMAT).load(path).count() == 2
