"""What the operators of this subpackage share: entries, hot keys, readers of Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from totelane.operators.skew import fits_broadcast, spread_join
from totelane.session import durable
from totelane.settings import SkewSettings

#: Bytes of an Arrow batch, where the session has Spark's default.
ARROW_BYTES = "8m"
_ARROW, _ARROW_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
#: Bounds of a table that is broadcast.
SMALL = SkewSettings(broadcast_rows=1_000_000, broadcast_bytes=32 << 20)
#: Column of a written table with the place that each row had in the scan.
PLACE = "_totelane_place"
#: XML-like white space of the contracts: blank and the controls 9 to 13. ``bytes.split()``
#: without argument splits at exactly these.
SPACES = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Send this package to the executors, once per session: their Python workers need not
    have it on their path. Texts go to them in batches of ``ARROW_BYTES``, which both sides
    hold several times over, unless the session has a bound of its own."""
    if spark.conf.get(_ARROW) == _ARROW_DEFAULT:
        spark.conf.set(_ARROW, ARROW_BYTES)
    context = spark.sparkContext
    if getattr(context, "_totelane_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="totelane-code-")) / "totelane_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._totelane_shipped = True


_held: dict[str, Callable[[], None]] = {}


def hold(name: str, forget: Callable[[], None]) -> None:
    """In a task: remember how to free what the operator ``name`` keeps for later tasks."""
    _held[name] = forget


def only(name: str) -> None:
    """At the start of a task: Python workers serve one stage after the other, so what other
    operators keep is freed."""
    for other in [x for x in _held if x != name]:
        _held.pop(other)()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def entries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``at``, ``doc_id``, ``text`` of each row; other columns are left behind.

    ``at`` tells rows apart where ids are null or repeat. It is the place of the row in the
    scan, or what ``placed`` wrote. Another scan can give other places, as it is split by the
    executors there are: what reads the entries more than once takes ``written_entries``. A
    null text becomes the empty one.
    """
    prepare(docs.sparkSession)
    place = F.col(PLACE) if PLACE in docs.columns else F.monotonically_increasing_id()
    return docs.select(
        place.alias("at"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def written_entries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``entries`` with the same places each time they are read."""
    rows = entries(docs, id_col, text_col)
    return rows if PLACE in docs.columns else durable(rows)


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` written once with the place of each row, which all that reads it goes by."""
    return durable(docs.withColumn(PLACE, F.monotonically_increasing_id()))


def meet(rows: DataFrame, table: DataFrame, on: str | list[str], how: str, hot=()) -> DataFrame:
    """``rows`` joined with a table of unique keys. Where its measured size is within
    ``SMALL``, the table is sent to the rows, which need not move; beyond that both are
    shuffled, with the ``hot`` values of the first key split."""
    if fits_broadcast(table, SMALL):
        return rows.join(F.broadcast(table), on, how)
    return spread_join(rows, table, on, how, list(hot))


def rows_without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of a ``placed`` table whose place is not in ``dropped.at``, with all their own
    columns. ``dropped`` is read twice."""
    return meet(docs, dropped.select(F.col("at").alias(PLACE)), PLACE, "left_anti").drop(PLACE)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_groups(groups: DataFrame, key: str, rows: str = "n") -> list[tuple[int, int]]:
    """Keys with far more than a task's share of the rows, and the splits each should get.

    ``groups`` has a number of rows per key. With P shuffle partitions at most 8 P keys can
    hold over an eighth of the share of one each, so the list is short whatever the data.
    """
    total = groups.agg(F.sum(rows)).first()[0] or 0
    share = max(200, total // (8 * shuffle_partitions(groups.sparkSession)))
    found = groups.filter(F.col(rows) > share).groupBy(key).agg(F.sum(rows)).collect()
    return [(row[0], -(-row[1] // share)) for row in found]


def lowered(text: Column) -> Column:
    """A-Z in lower case, everything else unchanged."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts of an Arrow column as UTF-8."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def byte_lengths(column: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text, none for null."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut where the texts of ``column`` exceed ``most`` bytes together; a single
    longer text makes a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(byte_lengths(batch.column(column)))
        start, before = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start, before = stop, int(ends[stop - 1])


def record_batch(columns: dict[str, Sequence], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[field.name], type=field.type) for field in schema], schema=schema
    )
