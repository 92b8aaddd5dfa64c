"""Removal of long byte strings that occur more than once, by a blockwise suffix sort over a difference cover.

Two equal strings of ``length`` bytes that start at offsets i and j of their documents have a shift d below the cover's
modulus v for which i + d and j + d both lie in the cover. So the suffixes at cover offsets are ranked first, on the
``length - v + 1`` bytes that any such pair still shares there; a suffix whose next v offsets hold no tied cover sample has
no equal and needs no sorting. The suffixes that are left are sorted one bucket at a time, ties being resolved down to
``length`` bytes. Sorting is by 64-bit fingerprint, not by byte order: equal strings become neighbours either way, and a
suffix costs eight bytes of shuffle instead of its text. A bucket is a range of fingerprints, so its size follows the data's
volume and not its repetitions: each block of documents sends a fingerprint once.

Samples are ranked by the upper bits of their fingerprints only: samples that tie by chance cost some sorting, no result.

A passage can be asked for in words too. Every run of so many words is anchored at the least fingerprint of the shorter runs in
it, which equal runs share; anchors are ranked with the samples, and only runs whose anchor is tied are sorted along with the
suffixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adyield.llm.common import (mixed, pack_sorted, pick, prefix_hash, runs_of, sequence_hashes, text_bytes, text_slices,
                                unpack_sorted, window_hash)

# A perfect difference set; every residue modulo 133 is a difference of two of its members.
COVER_MODULUS = 133
COVER = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)

#: Text of one block; it bounds the arrays of a worker.
BLOCK_BYTES = 1 << 20
#: Bits of a sample's fingerprint beyond those that number all samples, so that few tie by chance.
SPARE_BITS = 12
#: Fingerprints that one bucket holds on average.
BUCKET_ITEMS = 1_500_000
MIN_BUCKETS = 64
#: Bytes of text that a word takes at least, on average, for the number of buckets.
WORD_BYTES = 4
#: Sets the fingerprints of runs of words apart from those of byte strings.
_WORDS = np.uint64(0xA5A5A5A55A5A5A5A)

_SENT = "bucket long, block long, items binary"
_FLAGS = "block long, bucket long, flags binary"


def _bucket_bounds(items: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins and ends within sorted distinct fingerprints."""
    edges = (np.arange(1, buckets, dtype=object) * 2**64 // buckets).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(items, edges), [len(items)]])


def _send(block: int, items: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    cuts = _bucket_bounds(items, buckets)
    return [(b, block, pack_sorted(items[cuts[b]:cuts[b + 1]])) for b in range(buckets) if cuts[b + 1] > cuts[b]]


def _received(items: np.ndarray, buckets: int, flags: dict[int, bytes]) -> np.ndarray:
    """For each distinct fingerprint of a block: whether another block has it too."""
    cuts = _bucket_bounds(items, buckets)
    out = np.zeros(len(items), bool)
    for bucket, bits in flags.items():
        low, high = cuts[bucket], cuts[bucket + 1]
        out[low:high] = np.unpackbits(np.frombuffer(bits, np.uint8), count=high - low).astype(bool)
    return out


def _table(rows: list[tuple[int, int, bytes]], names: tuple[str, str, str]) -> pa.Table:
    a, b, c = zip(*rows) if rows else ((), (), ())
    return pa.table({names[0]: pa.array(a, pa.int64()), names[1]: pa.array(b, pa.int64()), names[2]: pa.array(c, pa.binary())})


def _sort_bucket(key: tuple, table: pa.Table) -> pa.Table:
    """Sort one bucket and tell each block which of its fingerprints have an equal; a mask row only passes through."""
    blocks = table.column("block").to_pylist()
    blobs = table.column("items").to_pylist()
    bucket = key[0].as_py()
    if bucket < 0:
        return _table([(block, bucket, blob) for block, blob in zip(blocks, blobs)], ("block", "bucket", "flags"))
    parts = [unpack_sorted(blob) for blob in blobs]
    ordered = np.sort(np.concatenate(parts))
    tied = ordered[1:][ordered[1:] == ordered[:-1]]
    rows = []
    for block, part in zip(blocks, parts):
        place = np.searchsorted(tied, part)
        hit = np.zeros(len(part), bool)
        inside = place < len(tied)
        hit[inside] = tied[place[inside]] == part[inside]
        rows.append((block, bucket, np.packbits(hit).tobytes()))
    return _table(rows, ("block", "bucket", "flags"))


class _Block:
    """The documents of one block as bytes, with the fingerprints of any of their substrings."""

    def __init__(self, data: pa.Buffer):
        self.batch = pa.ipc.open_stream(data).read_next_batch()
        self.bytes, self.offsets = text_bytes(self.batch.column("text"))
        self.prefix = prefix_hash(self.bytes)
        sizes = np.diff(self.offsets)
        self.within = np.arange(len(self.bytes), dtype=np.int32) - np.repeat(self.offsets[:-1].astype(np.int32), sizes)
        self.left = np.repeat(sizes.astype(np.int32), sizes) - self.within

    def cover_samples(self, window: int) -> np.ndarray:
        member = np.zeros(COVER_MODULUS, bool)
        member[list(COVER)] = True
        return np.flatnonzero(member[self.within % COVER_MODULUS] & (self.left >= window))

    def suffixes_before(self, samples: np.ndarray, length: int) -> np.ndarray:
        """Suffixes of at least ``length`` bytes with one of the samples less than the modulus ahead of them."""
        reach = np.zeros(len(self.bytes) + 1, np.int32)
        first = samples - np.minimum(self.within[samples], COVER_MODULUS - 1)
        np.add.at(reach, first, 1)
        np.add.at(reach, samples + 1, -1)
        return np.flatnonzero((np.cumsum(reach[:-1]) > 0) & (self.left >= length))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each word begins and ends, and its fingerprint."""
        blank = (self.bytes == 32) | ((self.bytes >= 9) & (self.bytes <= 13))
        before, after = np.ones_like(blank), np.ones_like(blank)
        before[1:], after[:-1] = blank[:-1], blank[1:]
        starts = np.flatnonzero(~blank & (before | (self.within == 0)))
        ends = np.flatnonzero(~blank & (after | (self.left == 1))) + 1
        return starts, ends, window_hash(self.prefix, starts, ends)


class _Runs:
    """The runs of ``words`` words that lie within one document of a block: where each begins and ends, its fingerprint and its anchor."""

    def __init__(self, block: _Block, words: int | None):
        self.first = self.last = np.zeros(0, np.int64)
        self.names = self.anchors = np.zeros(0, np.uint64)
        self.anchored_twice = np.zeros(0, bool)
        starts, ends, items = block.words() if words else (self.first, self.first, self.names)
        if words is None or len(starts) < words:
            return
        first, last = starts[:len(starts) - words + 1], ends[words - 1:]
        inside = last - first <= block.left[first]
        self.first, self.last = first[inside], last[inside]
        self.names = sequence_hashes(items, words)[inside] ^ _WORDS
        size = (words + 1) // 2
        parts = sequence_hashes(items, size)
        least, reach = parts, 1
        while reach < words - size + 1:  # the least of so many parts one after another
            step = min(reach, words - size + 1 - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        least = least[inside]
        values, count = np.unique(parts, return_counts=True)
        self.anchored_twice = count[np.searchsorted(values, least)] > 1
        self.anchors = mixed(least ^ _WORDS)


def _blocks(docs: DataFrame) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in text_slices(batch, "text", BLOCK_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, piece.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_batch(piece)
                yield pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()),
                                                  "data": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
                number += 1

    return docs.mapInArrow(build, "block long, data binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                   keep: tuple[str, ...] = (), as_text: bool = False, words: int | None = None, cut_words: bool = True) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts anywhere else in the corpus.

    With ``words``, also every run of so many words that stands anywhere else, however few bytes it has. Words are set apart by
    ASCII white space, any amount of which counts as one blank. Without ``cut_words`` such runs are only named, and stay unless
    they hold repeated bytes: a last column, passages, gives start and length, in bytes, of the maximal stretches they cover.

    Texts are taken as UTF-8 bytes; matches lie within one document, may overlap and may stand in the same document; strings
    are judged on the input. Returns ``id_col``, the columns named in ``keep``, n_bytes, n_removed, n_spans (maximal removed
    runs), spans (start and length of each, in bytes of the input) and kept: the remaining bytes, or with ``as_text`` a
    string without the parts of characters that a cut left over.

    A null text counts as empty; empty and short texts come back whole. Every row is a document of its own, also when ids
    repeat or are null, so a row that is there twice loses all its ``length``-byte strings. An empty table gives an empty
    result. Other columns are not looked at and may have any name. ``length`` must exceed the modulus of the cover.
    """
    if length <= 2 * COVER_MODULUS:
        raise ValueError(f"length must exceed {2 * COVER_MODULUS}")
    window = length - COVER_MODULUS + 1
    rows = pick(docs, id=id_col, text=text_col, **{f"keep_{i}": c for i, c in enumerate(keep)})
    volume = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    items = volume * len(COVER) // COVER_MODULUS
    if words:  # two of so many parts and one more are the least around them
        items += 2 * (volume // WORD_BYTES) // (words // 2 + 2)
    buckets = max(MIN_BUCKETS, -(-items // BUCKET_ITEMS))
    upper = np.uint64(2**64 - 2**max(0, (64 - SPARE_BITS - items.bit_length()) // 8 * 8))
    blocks = _blocks(rows).repartition("block")

    def sampled(block: _Block, runs: _Runs) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The samples, and the distinct upper bits of their fingerprints and then of the anchors."""
        samples = block.cover_samples(window)
        names = np.concatenate([window_hash(block.prefix, samples, samples + window), runs.anchors]) & upper
        return samples, np.unique(names, return_inverse=True, return_counts=True)

    def named(block: _Block, suffixes: np.ndarray, runs: _Runs, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct fingerprints of the suffixes and then of some runs."""
        names = np.concatenate([window_hash(block.prefix, suffixes, suffixes + length), runs.names[which]])
        return np.unique(names, return_inverse=True, return_counts=True)

    def each(numbers: pa.ChunkedArray | pa.Array, data: pa.ChunkedArray | pa.Array) -> Iterator[tuple[int, _Block, _Runs]]:
        for number, stream in zip(numbers, data):
            block = _Block(stream.as_buffer())
            yield number.as_py(), block, _Runs(block, words)

    def rank_samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block, runs in each(batch.column("block"), batch.column("data")):
                _, (names, _, _) = sampled(block, runs)
                yield from _table(_send(number, names, buckets), ("bucket", "block", "items")).to_batches()

    def sort_suffixes(blocks: pa.Table, flags: pa.Table) -> pa.Table:
        rows = []
        bits = dict(zip(flags.column("bucket").to_pylist(), flags.column("flags").to_pylist()))
        for number, block, runs in each(blocks.column("block"), blocks.column("data")):
            samples, (names, name_of, count) = sampled(block, runs)
            tied = _received(names, buckets, bits)
            of_samples, of_runs = name_of[:len(samples)], name_of[len(samples):]
            suffixes = block.suffixes_before(samples[(tied | (count > 1))[of_samples]], length)
            which = np.flatnonzero(tied[of_runs] | runs.anchored_twice)
            names, _, _ = named(block, suffixes, runs, which)
            rows += _send(number, names, buckets)
            mask = np.zeros(len(block.bytes) + len(runs.first), bool)
            mask[suffixes] = mask[len(block.bytes) + which] = True
            starts, ends = runs_of(mask)
            rows.append((-1 - number, number, np.stack([starts, ends]).astype("<i8").tobytes()))
        return _table(rows, ("bucket", "block", "items"))

    def stretches(block: _Block, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What strings cover, and where each maximal stretch of it within a document begins and ends."""
        reach = np.zeros(len(block.bytes) + 1, np.int32)
        np.add.at(reach, first, 1)
        np.add.at(reach, last, -1)
        covered = np.cumsum(reach[:-1]) > 0
        before, after = np.zeros_like(covered), np.zeros_like(covered)
        before[1:], after[:-1] = covered[:-1], covered[1:]
        return (covered, np.flatnonzero(covered & (~before | (block.within == 0))),
                np.flatnonzero(covered & (~after | (block.left == 1))) + 1)

    def listed(block: _Block, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """How many stretches each document has, and a list of them."""
        spans_to = np.searchsorted(first, block.offsets)
        spans = pa.StructArray.from_arrays([pa.array(block.within[first], pa.int64()), pa.array(last - first)], fields=list(span_type))
        return np.diff(spans_to), pa.ListArray.from_arrays(pa.array(spans_to.astype(np.int32)), spans)

    marked = ["passages"] if words and not cut_words else []
    kept_type = pa.string() if as_text else pa.binary()
    span_type = pa.struct([("start", pa.int64()), ("length", pa.int64())])

    def cut(blocks: pa.Table, flags: pa.Table) -> pa.Table:
        bits = dict(zip(flags.column("bucket").to_pylist(), flags.column("flags").to_pylist()))
        out = []
        for number, block, runs in each(blocks.column("block"), blocks.column("data")):
            starts, ends = np.frombuffer(bits.pop(-1 - number), "<i8").reshape(2, -1)
            mask = np.zeros(len(block.bytes) + len(runs.first), bool)
            for a, b in zip(starts, ends):
                mask[a:b] = True
            suffixes, which = np.flatnonzero(mask[:len(block.bytes)]), np.flatnonzero(mask[len(block.bytes):])
            names, name_of, count = named(block, suffixes, runs, which)
            repeated = (_received(names, buckets, bits) | (count > 1))[name_of]
            again, which = suffixes[repeated[:len(suffixes)]], which[repeated[len(suffixes):]]
            cuts = which if cut_words else which[:0]
            removed, first, last = stretches(block, np.concatenate([again, runs.first[cuts]]), np.concatenate([again + length, runs.last[cuts]]))
            totals = np.concatenate([[0], np.cumsum(removed)])
            kept = []
            for a, b in zip(block.offsets[:-1], block.offsets[1:]):
                whole = block.bytes[a:b]
                whole = whole if totals[a] == totals[b] else whole[~removed[a:b]]
                kept.append(whole.tobytes().decode("utf-8", "ignore") if as_text else whole.tobytes())
            n_spans, spans = listed(block, first, last)
            columns = {"id": block.batch.column("id")}
            columns |= {f"keep_{i}": block.batch.column(f"keep_{i}") for i in range(len(keep))}
            columns |= {
                "n_bytes": pa.array(np.diff(block.offsets)),
                "n_removed": pa.array(totals[block.offsets[1:]] - totals[block.offsets[:-1]]),
                "n_spans": pa.array(n_spans),
                "spans": spans,
                "kept": pa.array(kept, kept_type)}
            if marked:
                columns["passages"] = listed(block, *stretches(block, runs.first[which], runs.last[which])[1:])[1]
            out.append(pa.table(columns))
        return pa.concat_tables(out)

    spans = "array<struct<start: long, length: long>>"
    schema = T.StructType([f for f in rows.schema.fields if f.name != "text"] + T.StructType.fromDDL(", ".join([
        f"n_bytes long, n_removed long, n_spans long, spans {spans}, kept {'string' if as_text else 'binary'}",
        *(f"{name} {spans}" for name in marked)])).fields)
    sample_flags = blocks.mapInArrow(rank_samples, _SENT).groupBy("bucket").applyInArrow(_sort_bucket, _FLAGS)
    sent = blocks.groupBy("block").cogroup(sample_flags.groupBy("block")).applyInArrow(sort_suffixes, _SENT)
    suffix_flags = sent.groupBy("bucket").applyInArrow(_sort_bucket, _FLAGS)
    result = blocks.groupBy("block").cogroup(suffix_flags.groupBy("block")).applyInArrow(cut, schema)
    return result.toDF(id_col, *keep, "n_bytes", "n_removed", "n_spans", "spans", "kept", *marked)
