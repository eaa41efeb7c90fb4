"""Operator 6: passages of a benchmark in documents, by winnowing.

Texts are words; a fingerprint is the least hash of five-word grams in a sliding window of
six grams. A span of ten words holds six grams, so equal spans select an equal gram on both
sides, whatever stands around them: no shared span of ten words or more is missed. Document
grams that equal a benchmark fingerprint are extended to every ten-word window around them,
and the windows are compared with those of the benchmark word by word. An item of one to
nine words is one window and its own fingerprint.

All is done by built-in functions. The benchmark side is broadcast when its measured size is
within a bound, otherwise joined by shuffle with hot keys split.

A null or wordless text has no words, hits nothing and is hit by nothing; items without an
id hit words but are not counted or named. Documents of an empty benchmark are clean.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from totelane.llm.common import lowered, meet, written_entries
from totelane.operators.skew import Lookup
from totelane.session import durable
from totelane.settings import SkewSettings

WINDOW = 10
GRAM = 5
#: What stands between words: all of ASCII but digits and lower-case letters.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same where capitals still are letters.
ANY_CASE_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def small_letters(text: Column) -> Column:
    """A-Z in lower case; plain ``lower`` does it where there is nothing but ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(lowered(text))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once. A column named in a function of elements
    would be put there as its expression, and be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(small_letters(text), BREAKS), "")


def _each(items: Column, size: int, body) -> Column:
    """``body`` of each run of ``size`` items; none where there are fewer."""
    starts = F.sequence(F.lit(1), F.size(items) - F.lit(size - 1))
    found = F.transform(starts, lambda i: body(F.slice(items, i, F.lit(size))))
    return F.when(F.size(items) >= size, found)


def _grams(hashes: Column, size: int) -> Column:
    none = F.array().cast("array<bigint>")
    return F.coalesce(_each(hashes, size, F.xxhash64), none)


def _of_hashes(text: Column, body) -> Column:
    """``body`` of the array of word hashes."""
    return _let(words_of(text), lambda w: _let(F.transform(w, lambda x: F.xxhash64(x)), body))


def _least(hashes: Column) -> Column:
    """The least gram of each window of grams."""
    none = F.array().cast("array<bigint>")
    grams = _grams(hashes, GRAM)
    return _let(grams, lambda g: F.coalesce(_each(g, WINDOW - GRAM + 1, F.array_min), none))


def fingerprints(text: Column, short: list[int]) -> Column:
    """The distinct fingerprints of a document: winnowed, and all runs of the lengths of
    short items."""

    def every(hashes: Column) -> Column:
        runs = [_grams(hashes, size) for size in short]
        return F.array_distinct(F.concat(_least(hashes), *runs))

    return _of_hashes(text, every)


def _own_fingerprints(text: Column, short: list[int]) -> Column:
    """The fingerprints of an item: winnowed, or the whole item where it is short."""

    def own(hashes: Column) -> Column:
        found = _least(hashes)
        for size in short:
            found = F.when(F.size(hashes) == size, _grams(hashes, size)).otherwise(found)
        return found

    return _of_hashes(text, own)


def _windows(text: Column, short: list[int]) -> Column:
    """The windows of an item as texts."""

    def windows(words: Column) -> Column:
        found = _each(words, WINDOW, lambda run: F.concat_ws(" ", run))
        for size in short:
            whole = F.array(F.concat_ws(" ", words))
            found = F.when(F.size(words) == size, whole).otherwise(found)
        return found

    return _let(words_of(text), windows)


class Benchmark:
    """The windows of the items, each once with a number, and their fingerprints."""

    def __init__(self, items: DataFrame, id_col: str = "item_id", text_col: str = "text"):
        rows = items.select(
            F.col(id_col).cast("string").alias("item_id"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        )
        n = F.size(words_of(F.col("text")))
        lengths = rows.select(n.alias("n")).filter(F.col("n").between(1, WINDOW - 1)).distinct()
        self.short = sorted(row["n"] for row in lengths.collect())  # nine at most
        skew = SkewSettings()
        text = F.col("text")
        self.of_items = durable(
            rows.select("item_id", F.explode(_windows(text, self.short)).alias("window")).distinct()
        )
        self.windows = Lookup(self.of_items.select("window").distinct(), "window", skew)
        own = rows.select(F.explode(_own_fingerprints(text, self.short)).alias("fingerprint"))
        self.fingerprints = Lookup(durable(own.distinct()), "fingerprint", skew)


def _hits(docs: DataFrame, benchmark: Benchmark) -> DataFrame:
    """``at``, ``start`` (from 1), ``size`` and ``window`` of the windows found in documents."""
    text = F.col("text")
    marked = docs.select("at", F.explode(fingerprints(text, benchmark.short)).alias("fingerprint"))
    met = benchmark.fingerprints.add_to(marked, "left_semi")
    suspects = durable(met.select("at").distinct())
    near = durable(meet(docs.select("at", "text"), suspects, "at", "left_semi"))

    def seeds(size: int) -> DataFrame:
        grams = _of_hashes(text, lambda hashes: _grams(hashes, size))
        placed = near.select("at", F.posexplode(grams).alias("place", "fingerprint"))
        return benchmark.fingerprints.add_to(placed, "left_semi").select("at", "place")

    # A gram from place p lies in the ten-word windows that start at p - 5 to p.
    back = WINDOW - GRAM
    reach = F.explode(F.sequence(F.greatest(F.col("place") - back, F.lit(0)), F.col("place")))
    starts = [seeds(GRAM).select("at", reach.alias("place"), F.lit(WINDOW).alias("size"))]
    starts += [
        seeds(size).select("at", "place", F.lit(size).alias("size")) for size in benchmark.short
    ]
    places = reduce(DataFrame.unionByName, starts)
    listed = places.distinct().groupBy("at").agg(
        F.collect_list(F.struct("place", "size")).alias("places")
    )

    def cut(words: Column, span: Column) -> Column:
        run = F.concat_ws(" ", F.slice(words, span["place"] + 1, span["size"]))
        return F.struct((span["place"] + 1).alias("start"), span["size"].alias("size"), run.alias("window"))

    def spans(words: Column) -> Column:
        inside = F.filter(
            F.col("places"), lambda span: span["place"] + span["size"] <= F.size(words)
        )
        return F.transform(inside, lambda span: cut(words, span))

    found = (
        near.join(listed, "at")
        .select("at", F.explode(_let(words_of(text), spans)).alias("span"))
        .select("at", "span.start", "span.size", "span.window")
    )
    return benchmark.windows.add_to(found, "left_semi")


def _covered(spans: Column) -> Column:
    """Words covered by spans (start, size) in order of start."""
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(state: Column, span: Column) -> Column:
        end = F.greatest(state["end"], span["start"] + span["size"])
        new = end - F.greatest(state["end"], span["start"])
        return F.struct(end.alias("end"), (state["n"] + F.greatest(new, F.lit(0))).alias("n"))

    return F.aggregate(spans, begin, add, lambda state: state["n"])


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``at``, ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and
    ``contaminated`` of each document."""
    rows = written_entries(docs, id_col, text_col)
    benchmark = Benchmark(items)
    hits = durable(_hits(rows, benchmark))
    hit = hits.groupBy("at").agg(
        _covered(F.array_sort(F.collect_set(F.struct("start", "size")))).alias("n_hit")
    )
    of_items = Lookup(
        benchmark.of_items.groupBy("window").agg(F.collect_set("item_id").alias("item_ids")),
        "window",
        SkewSettings(),
    )
    named = (
        of_items.add_to(hits.select("at", "window").distinct(), "inner")
        .select("at", F.explode("item_ids").alias("item_id"))
        .distinct()
        .groupBy("at")
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    n_words = F.size(F.array_remove(F.split("text", ANY_CASE_BREAKS), ""))
    none = F.array().cast("array<string>")
    return (
        rows.select("at", "doc_id", n_words.cast("long").alias("n_words"))
        .join(hit, "at", "left")
        .join(named, "at", "left")
        .withColumn("item_ids", F.coalesce("item_ids", none))
        .select(
            "at",
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size("item_ids").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )
