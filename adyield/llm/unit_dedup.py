"""Removal of repeated lines or paragraphs: only the earliest ranked occurrence of a normalised unit stays.

A line that stands in two documents by chance is no copied passage. So a least size can be asked for: units that repeat an earlier
one go only where a run of them, one after another, holds that many words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adyield.llm.common import pick
from adyield.session import checkpointed

LINE = "\n"
PARAGRAPH = "\n\n"
BATCH_UNITS = 50_000


def _batches(rows: list[tuple], names: list[str]) -> list[pa.RecordBatch]:
    if not rows:
        return []
    return [pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows)], names=names)]


def _units(rows: DataFrame, separator: str) -> DataFrame:
    """One row per unit with its place in the text, in characters, and the digest of its normal form; null where blank."""
    names = ["doc", "id", "unit", "start", "end", "words", "high", "low"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for doc, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "id", "text"))):
                at = 0
                for place, piece in enumerate((text or "").split(separator)):
                    words = piece.lower().split()
                    plain = " ".join(words)
                    digest = hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    end = at + len(piece)
                    found.append((doc, key, place, at, end, len(words), *(int.from_bytes(half, "big", signed=True) if plain else None
                                                              for half in (digest[:8], digest[8:]))))
                    at = end + len(separator)
                if len(found) > BATCH_UNITS:
                    yield from _batches(found, names)
                    found = []
            yield from _batches(found, names)

    return rows.mapInArrow(cut, ", ".join(f"{name} long" for name in names))


def remove_repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", separator: str = LINE,
                          least_words: int = 0) -> DataFrame:
    """Find the units that repeat an earlier one anywhere in the corpus.

    Units are the parts between ``separator``; two are equal if their words are, in lower case. Documents rank by id, units by
    their order. With ``least_words`` only those go that stand in a run of repeated units, blank ones between them not counted,
    with so many words together. Returns one row per row of ``docs``: ``id_col``, n_units, n_repeated (all that repeat an earlier
    one), n_removed, n_chars_removed and removed, an array of (unit, start, end) in characters of the original text;
    ``without_spans`` cuts them out.

    Blank units are never removed. A null text is one blank unit, as is an empty one. Rows without an id rank last; rows with
    the same id, repeated ones too, are documents of their own that rank in no fixed order among themselves, and only one of
    them keeps a shared unit. An empty table gives an empty result. Other columns may have any name. Ids are whole numbers.
    """
    rows = pick(docs, id=id_col, text=text_col).select("id", "text", F.monotonically_increasing_id().alias("doc"))
    units = checkpointed(_units(rows, separator))
    rank = F.struct(F.col("id").isNull().alias("last"), "id", "unit", "doc")
    first = units.filter("high is not null").groupBy("high", "low").agg(F.min(rank).alias("first")) \
        .select("first.doc", "first.unit", F.lit(True).alias("stays"))
    judged = units.join(first, ["doc", "unit"], "left").withColumn("again", F.col("high").isNotNull() & F.col("stays").isNull())
    gone = F.col("again")
    if least_words > 0:
        before = Window.partitionBy("doc").orderBy("unit").rowsBetween(Window.unboundedPreceding, 0)
        run = Window.partitionBy("doc", "run")
        judged = judged.withColumn("run", F.count(F.when(F.col("stays"), 1)).over(before)) \
            .withColumn("run_words", F.sum(F.when(F.col("again"), F.col("words"))).over(run))
        gone = gone & (F.col("run_words") >= least_words)
    spans = F.sort_array(F.collect_list(F.when(gone, F.struct("unit", "start", "end"))))
    per_doc = judged.groupBy("doc", "id").agg(
        F.count("*").alias("n_units"), F.count(F.when(F.col("again"), 1)).alias("n_repeated"), F.count(F.when(gone, 1)).alias("n_removed"),
        F.coalesce(F.sum(F.when(gone, F.col("end") - F.col("start"))), F.lit(0)).alias("n_chars_removed"), spans.alias("removed"))
    return per_doc.select(F.col("id").alias(id_col), "n_units", "n_repeated", "n_removed", "n_chars_removed", "removed")


def without_spans(text: str, spans: list[tuple[int, int]], separator: str = LINE) -> str:
    """A text without the given units (start, end), each with the separator after it, or before it if it is the last."""
    kept, at = [], 0
    for start, end in sorted(spans):
        if start > at:
            kept.append(text[at:start])
        at = end + len(separator)
    kept.append(text[at:])
    joined = "".join(kept)
    return joined.removesuffix(separator) if at > len(text) and joined.endswith(separator) else joined
