"""Answers of the conveyor as they come, joined with the messages they belong to.

Messages and answers are two streams. A message meets its answers where these come within a
time limit; when the watermark has passed the limit, a message without any is written as
unanswered. Routes whose answer is an acceptance are marked in the store with the batch that
brings it, not at the next run.

What came and may still meet something is kept in files, a piece per batch, and joined in bulk:
new messages with all answers, messages from before with new answers. So memory does not grow
with the messages that wait. The watermark is the lesser of the latest times of both streams,
less the delay; messages and answers that are not later than it count no more.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from totelane.functions import fixed
from totelane.functions.text import key
from totelane.operators.dispatch import answer_event
from totelane.plans.run import record_answers
from totelane.settings import RouterSettings
from totelane.sources.parts import Files, TakenError
from totelane.sources.state_store import StateStore

MESSAGES = "seq bigint, kind string, id bigint, tote_id string, sent_at timestamp"
ANSWERS = "id bigint, tote_id string, status int, answered_at timestamp"
OUTCOMES = (
    "seq bigint, kind string, id bigint, tote_id string, sent_at timestamp, status int, "
    "answered_at timestamp"
)
#: Pieces that are read by a batch; more are merged first.
PIECES = 32


def _message(tote: str) -> Column:
    """What a message and its answers have in common; last messages have no id."""
    return F.concat_ws("/", F.coalesce(F.col("id").cast("string"), F.lit("")), key(tote))


def _columns(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def _met(sent: DataFrame, told: DataFrame, limit: str, how: str) -> DataFrame:
    """Join messages with their answers within ``limit``."""
    sent = sent.withColumn("_message", _message("tote_id"))
    told = told.select(_message("tote_id").alias("_answer"), "status", "answered_at")
    after = F.col("sent_at") + F.expr(f"INTERVAL {limit}")
    timely = F.col("answered_at").between(F.col("sent_at"), after)
    joined = sent.join(told, (F.col("_message") == F.col("_answer")) & timely, how)
    return joined.drop("_message", "_answer")


def arrivals(messages: DataFrame, answers: DataFrame) -> DataFrame:
    """Both in one table; ``told`` says which of them a row is. Messages without a tote have
    no answers."""
    told = answers.filter(F.col("tote_id").isNotNull()).withColumn("told", F.lit(True))
    return messages.withColumn("told", F.lit(False)).unionByName(told, allowMissingColumns=True)


@dataclass(frozen=True)
class Known:
    """What is known after a batch: the latest times of both streams less the delay, and the
    ``watermark``, in milliseconds; the folders of the ``pieces`` that later batches read."""

    sent: int | None = None
    answered: int | None = None
    watermark: int = 0
    pieces: tuple[str, ...] = ()


class Waiting:
    """Messages and answers that may still meet, kept in ``root`` from batch to batch. A batch
    that is repeated does the same again: it starts from what was known before it."""

    def __init__(self, spark: SparkSession, root: str, limit: str, delay: str):
        self.spark, self.files, self._limit, self._delay = spark, Files(spark, root), limit, delay

    def _before(self, batch: int) -> Known:
        if batch == 0:
            return Known()
        name = f"{batch - 1:08d}.json"
        if name not in self.files.names("known"):
            raise ValueError(f"batch {batch - 1} is not known: the checkpoint is of another query")
        row = self.files.read(f"known/{name}")
        return Known(**row | {"pieces": tuple(row["pieces"])})

    def _forget(self, before: Known, batch: int) -> None:
        """Remove what no batch from this one on reads."""
        for kind in ("arrived", "merged"):
            unread = {f"{kind}/{x}" for x in self.files.names(kind)}.difference(before.pieces)
            for piece in unread:
                self.files.remove(piece)
        for name in self.files.names("known"):
            if name < f"{batch - 1:08d}":
                self.files.remove(f"known/{name}")

    def _write(self, rows: DataFrame, piece: str) -> str:
        rows.write.mode("overwrite").partitionBy("told").parquet(f"{self.files.root}/{piece}")
        return piece

    def _rows(self, pieces: tuple[str, ...], told: bool) -> DataFrame:
        """The answers of some pieces, or the messages."""
        side, schema = f"told={str(told).lower()}", ANSWERS if told else MESSAGES
        there = [f"{self.files.root}/{x}/{side}" for x in pieces if side in self.files.names(x)]
        if not there:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*there)

    def _open(self, moment: str, watermark: int) -> Column:
        """Whether the time limit that begins at ``moment`` is not over."""
        last = F.timestamp_millis(F.lit(watermark - 1)) - F.expr(f"INTERVAL {self._limit}")
        return F.col(moment) > last

    def _sides(self, pieces: tuple[str, ...], watermark: int) -> tuple[DataFrame, DataFrame]:
        """Messages whose time is not over, and the answers these can have."""
        sent = self._rows(pieces, told=False).filter(self._open("sent_at", watermark))
        return sent, self._rows(pieces, told=True).filter(self._open("answered_at", watermark))

    def _merged(self, before: Known, batch: int) -> tuple[str, ...]:
        """The pieces a batch starts from, as one where there are many."""
        if len(before.pieces) < PIECES:
            return before.pieces
        sent, told = self._sides(before.pieces, before.watermark)
        return (self._write(arrivals(sent, told), f"merged/{batch:08d}"),)

    def _latest(self, piece: str) -> tuple[int | None, int | None]:
        """The latest time of a message and of an answer, less the delay."""
        delay = F.expr(f"INTERVAL {self._delay}")
        sides = zip((False, True), ("sent_at", "answered_at"))
        found = (self._rows((piece,), told).agg(F.unix_millis(F.max(x) - delay)) for told, x in sides)
        return tuple(one.first()[0] for one in found)

    def add(self, arrived: DataFrame, batch: int, out: str) -> None:
        """Add a batch of ``arrivals`` and write to ``out``, as ``OUTCOMES``, each message with
        each of its answers as soon as both are there, and the messages whose time is over and
        that have none."""
        before = self._before(batch)
        self._forget(before, batch)
        pieces = self._merged(before, batch)
        moment = F.when(F.col("told"), F.col("answered_at")).otherwise(F.col("sent_at"))
        in_time = arrived.filter(moment > F.timestamp_millis(F.lit(before.watermark)))
        piece = self._write(in_time, f"arrived/{batch:08d}")
        new = self._latest(piece)
        sent, answered = map(_later, (before.sent, before.answered), new)
        passed = before.watermark if None in (sent, answered) else min(sent, answered)
        after = Known(sent, answered, max(before.watermark, passed), (*pieces, piece))

        all_sent, all_told = self._sides(after.pieces, before.watermark)
        new_sent, new_told = self._sides((piece,), before.watermark)
        found = _met(new_sent, all_told, self._limit, "inner")
        if pieces and new[1] is not None:
            old_sent, _ = self._sides(pieces, before.watermark)
            found = found.unionByName(_met(old_sent, new_told, self._limit, "inner"))
        over = all_sent.filter(~self._open("sent_at", after.watermark))
        if not over.isEmpty():
            silent = _met(over, all_told, self._limit, "left_anti")
            found = found.unionByName(silent, allowMissingColumns=True)
        found.write.mode("overwrite").parquet(out)
        try:
            self.files.put_once(f"known/{batch:08d}.json", asdict(after))
        except TakenError:  # by the same batch
            pass


def _later(one: int | None, other: int | None) -> int | None:
    return max((x for x in (one, other) if x is not None), default=None)


def outcomes(found: DataFrame) -> DataFrame:
    """One row per message of what ``follow_answers`` wrote, with its ``event``: one acceptance among
    several answers is enough. An accepted last message is no event and has null."""
    accepted = F.max(F.col("status") == fixed.ACCEPTED).alias("accepted")
    return (
        found.groupBy(*_columns(MESSAGES))
        .agg(accepted)
        .withColumn("event", answer_event(F.col("id"), F.col("accepted")))
        .drop("accepted")
    )


def follow_answers(
    spark: SparkSession,
    messages_folder: str,
    answers_folder: str,
    store_root: str,
    out: str,
    checkpoint: str,
    settings: RouterSettings,
    limit: str,
    delay: str,
    follow: Callable = lambda writer: writer.trigger(availableNow=True),
) -> StreamingQuery:
    """Work off both folders (Parquet): mark accepted routes in the store, batch by batch, and
    write ``OUTCOMES`` to ``out``: each message with each of its answers within ``limit``, or
    with none. The streams may be out of order by ``delay``. A batch that is repeated replaces
    its rows and does not mark again. ``follow`` sets another trigger."""
    messages = spark.readStream.schema(MESSAGES).parquet(messages_folder)
    answers = spark.readStream.schema(ANSWERS).parquet(answers_folder)
    waiting = Waiting(spark, f"{checkpoint}/waiting", limit, delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{out}/batch={batch_id}"
        waiting.add(batch, batch_id, folder)
        found = spark.read.schema(OUTCOMES).parquet(folder)
        acks = found.filter(F.col("status").isNotNull()).select("id", "tote_id", "status")
        if not acks.isEmpty():
            record_answers(StateStore(spark, store_root), acks, settings, f"{out}/{batch_id}")

    writer = arrivals(messages, answers).writeStream.foreachBatch(write)
    return follow(writer.option("checkpointLocation", checkpoint)).start()
