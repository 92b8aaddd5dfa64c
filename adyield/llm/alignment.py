"""Alignment of two tokenizers over the same texts, by merging their token ends in lockstep.

Tokens of both sides are laid end to end in bytes. A merge has two pointers, one per side: it links the tokens they point at,
cuts where both end at the same byte, and moves on the pointer whose token ends first, both at a cut. All documents of a batch
are merged at once: their pointers are one state vector that NumPy moves a step at a time, and merges that have finished are
taken out of it. A long document enters as several merges, each over the links of its own run of A tokens, so that a step works
on many of them as well.

How many documents hold a pair of linked ids is counted over the corpus from one partial count per batch and pair, and each batch
gets back the counts of its own pairs only: neither way is a row sent per document and link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adyield.llm.common import pack_sorted, pack_words, pick, text_slices, unpack_sorted, unpack_words
from adyield.llm.packing import Encoder
from adyield.session import checkpointed

#: Text that one batch holds; it bounds a worker's arrays, not the result.
BATCH_BYTES = 2 << 20
#: A tokens of one merge.
RUN_TOKENS = 256


class ByteEncoder(Encoder):
    """Ids of a byte-level BPE file, strings of special tokens as plain text, and the bytes of each id."""

    def __init__(self, path: str):
        super().__init__(path)
        self.general.encode_special_tokens = True
        self.special = []
        byte_of = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if chr(b) not in byte_of)}
        vocabulary = self.general.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, place in vocabulary.items():
            self.bytes[place] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()


class PieceEncoder:
    """Ids of a SentencePiece file and the bytes of each id."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for place in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(place)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(place) else piece.replace("▁", " ").encode())

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), np.int64)


class Side(NamedTuple):
    """Tokens of a batch of documents: ids, the byte at which each ends, and where each document's tokens begin."""

    ids: np.ndarray
    ends: np.ndarray
    begins: np.ndarray


def tokenized(texts: list[bytes | None], a: ByteEncoder, b: PieceEncoder) -> tuple[Side, Side]:
    """Both sides of a batch. Texts whose bytes, after a blank, one side does not give back have no tokens."""
    sides: tuple[list, list] = ([], [])
    for raw in texts:
        found = ()
        if raw:
            text = raw.decode("utf-8", "replace")
            ids = (a.ids(" " + text).astype(np.int64), b.ids(text))
            if all(b"".join(map(side.bytes.__getitem__, x.tolist())) == b" " + raw for side, x in zip((a, b), ids)):
                found = ids
        for side, ids in zip(sides, found or (np.zeros(0, np.int64),) * 2):
            side.append(ids)
    out = []
    for side, encoder in zip(sides, (a, b)):
        lengths = np.array([len(x) for x in encoder.bytes], np.int64)
        ids = np.concatenate([np.zeros(0, np.int64), *side])
        out.append(Side(ids, np.cumsum(lengths[ids]), np.concatenate([[0], np.cumsum([len(x) for x in side])]).astype(np.int64)))
    return tuple(out)


def merged(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of a batch, in order: places of A and B tokens, and whether both end there."""
    runs = np.concatenate([np.zeros(0, np.int64), *[np.arange(x, y, RUN_TOKENS) for x, y in zip(a.begins[:-1], a.begins[1:])]])
    stop = np.concatenate([runs[1:], a.begins[-1:]])[:len(runs)]
    i = runs.astype(np.int64)
    begin = np.concatenate([[0], a.ends])[i]
    j = np.searchsorted(b.ends, begin, side="right")
    left, right, cuts = [], [], []
    while len(i):
        ends_a, ends_b = a.ends[i], b.ends[j]
        left.append(i)
        right.append(j)
        cuts.append(ends_a == ends_b)
        i, j = i + (ends_a <= ends_b), j + (ends_b <= ends_a)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    left, right, cuts = np.concatenate(left), np.concatenate(right), np.concatenate(cuts)
    order = np.argsort(left << 32 | right)
    return left[order], right[order], cuts[order]


class Spelling:
    """Groups as text, ``a1,a2|b1;a3|b2,b3``: ids in decimals, the sign after each already attached."""

    def __init__(self, size_a: int, size_b: int):
        self.a, self.b = ({sign: np.array([f"{n}{sign}" for n in range(size)], object) for sign in signs}
                          for size, signs in ((size_a, ",|"), (size_b, ",;")))

    def __call__(self, a: Side, b: Side, left: np.ndarray, right: np.ndarray, cuts: np.ndarray) -> list[str]:
        last_a, last_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
        last_a[left[cuts]] = True
        last_b[right[cuts]] = True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        signed = np.empty(len(a.ids) + len(b.ids), object)
        signed[np.arange(len(a.ids)) + np.searchsorted(group_b, group_a)] = np.where(last_a, self.a["|"][a.ids], self.a[","][a.ids])
        signed[np.arange(len(b.ids)) + np.searchsorted(group_a, group_b, side="right")] = \
            np.where(last_b, self.b[";"][b.ids], self.b[","][b.ids])
        bounds = a.begins + b.begins
        return ["".join(signed[x:y].tolist())[:-1] for x, y in zip(bounds[:-1], bounds[1:])]


def _batches(rows: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[tuple]:
    a, b = ByteEncoder(a_path), PieceEncoder(b_path)
    spell = Spelling(len(a.bytes), len(b.bytes))
    for whole in rows:
        for piece in text_slices(whole, "text", BATCH_BYTES):
            sides = tokenized(piece.column("text").to_pylist(), a, b)
            yield piece, *sides, *merged(*sides), spell


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of both sides with their byte ends, and what links them, one row per document.

    Columns: ``id_col``, a_ids, a_ends, b_ids, b_ends (ends in bytes of a blank and the text), links (pairs of places of A and B
    tokens that share a byte, in order) and cuts (bytes at which both sides end a token). Texts that are null or empty, or that
    one tokenizer does not give back byte for byte, have empty arrays. Otherwise as ``agreement``.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.struct([("a", pa.int32()), ("b", pa.int32())])
        for piece, a, b, left, right, cuts, _ in _batches(batches, a_path, b_path):
            def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))

            doc = np.searchsorted(a.begins, left, side="right") - 1
            per_doc = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(piece)))])
            start = np.concatenate([[0], a.ends])[a.begins[:-1]]
            of_a, of_b = (np.repeat(np.arange(len(piece)), np.diff(s.begins)) for s in (a, b))
            ends = [s.ends - start[of] for s, of in ((a, of_a), (b, of_b))]
            places = [pa.array((left - a.begins[doc]).astype(np.int32)), pa.array((right - b.begins[doc]).astype(np.int32))]
            cut_bounds = np.concatenate([[0], np.cumsum(np.bincount(doc[cuts], minlength=len(piece)))])
            links = pa.ListArray.from_arrays(pa.array(per_doc.astype(np.int32)), pa.StructArray.from_arrays(places, fields=list(pair)))
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), lists(a.ids.astype(np.int32), a.begins), lists(ends[0], a.begins),
                 lists(b.ids.astype(np.int32), b.begins), lists(ends[1], b.begins), links, lists(ends[0][left[cuts]], cut_bounds)],
                names=["id", "a_ids", "a_ends", "b_ids", "b_ends", "links", "cuts"])

    schema = ("id long, a_ids array<int>, a_ends array<long>, b_ids array<int>, b_ends array<long>, links array<struct<a:int,b:int>>, "
              "cuts array<long>")
    return _plain(docs, id_col, text_col).mapInArrow(rows, schema).withColumnRenamed("id", id_col)


_PER_DOC = ["id", "n_a", "n_b", "n_groups", "n_links"]


def agreement(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How two tokenizers cut each text, and how usual its links are over the corpus, one row per document.

    ``a_path`` is a byte-level BPE file, ``b_path`` a SentencePiece file that puts a blank before a text. Columns: ``id_col``,
    n_a, n_b (tokens), n_groups (stretches between common ends), n_links (pairs of tokens that share a byte), n_best (links whose
    id pair is held by as many documents as any pair of its A id), count_sum (those documents, summed over links) and
    groups_sha256 (of the groups as ``Spelling`` writes them; empty without tokens).

    Texts null, empty, not valid UTF-8, or whose bytes one side does not give back have no tokens: zeros. Rows that repeat an id or
    text, and rows without an id, are documents of their own. A text is tokenised whole. An empty table gives an empty result. Other
    columns may have any name. Ids are whole numbers.
    """
    def batch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, (piece, a, b, left, right, cuts, spell) in enumerate(_batches(batches, a_path, b_path)):
            n = len(piece)
            doc = np.searchsorted(a.begins, left, side="right") - 1
            pairs, which = np.unique(a.ids[left] << 32 | b.ids[right], return_inverse=True)
            held, times = np.unique(doc * max(1, len(pairs)) + which, return_counts=True)
            names = [hashlib.sha256(text.encode()).hexdigest() if text else "" for text in spell(a, b, left, right, cuts)]
            counts = [np.diff(a.begins), np.diff(b.begins), np.bincount(doc[cuts], minlength=n), np.bincount(doc, minlength=n)]
            yield pa.RecordBatch.from_pydict({
                "batch": pa.array([part << 32 | number]), "id": pa.array([piece.column("id").to_pylist()], pa.list_(pa.int64())),
                **{c: pa.array([v.tolist()], pa.list_(pa.int64())) for c, v in zip(_PER_DOC[1:], counts)},
                "sha": pa.array([names]), "pairs": pa.array([pack_sorted(pairs.astype(np.uint64))], pa.binary()),
                "docs": pa.array([pack_words(np.bincount(held % max(1, len(pairs)), minlength=len(pairs)))], pa.binary()),
                "held": pa.array([pack_sorted(held.astype(np.uint64))], pa.binary()), "times": pa.array([pack_words(times)], pa.binary())})

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for row in whole.to_pylist():
                pairs = unpack_sorted(row["pairs"]).view(np.int64)
                yield pa.RecordBatch.from_pydict({"batch": pa.array(np.full(len(pairs), row["batch"])), "pair": pa.array(pairs),
                                                  "docs": pa.array(unpack_words(row["docs"]))})

    def finish(batch: pa.Table, usual: pa.Table) -> pa.Table:
        row = batch.to_pylist()[0]
        order = np.argsort(usual.column("pair").to_numpy())
        count, best = (usual.column(c).to_numpy()[order].astype(np.int64) for c in ("count", "best"))
        held, times = unpack_sorted(row["held"]).view(np.int64), unpack_words(row["times"])
        doc, which = np.divmod(held, max(1, len(count)))
        bounds = np.searchsorted(doc, np.arange(len(row["id"]) + 1))
        sums = [np.diff(np.concatenate([[0], np.cumsum(v)])[bounds]) for v in (best[which] * times, count[which] * times)]
        return pa.table({"id": pa.array(row["id"], pa.int64()), **{c: pa.array(row[c], pa.int64()) for c in _PER_DOC[1:]},
                         "n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1]), "groups_sha256": pa.array(row["sha"])})

    lists = ", ".join(f"{c} array<long>" for c in _PER_DOC)
    slices = checkpointed(_plain(docs, id_col, text_col).mapInArrow(
        batch_rows, f"batch long, {lists}, sha array<string>, pairs binary, docs binary, held binary, times binary"))
    counted = slices.select("batch", "pairs", "docs").mapInArrow(partial, "batch long, pair long, docs long")
    totals = counted.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.expr("shiftright(pair, 32)"))
    usual = totals.select("pair", "count", (F.col("count") == F.max("count").over(Window.partitionBy("a"))).alias("best"))
    found = counted.select("batch", "pair").join(usual, "pair")
    schema = ", ".join(f"{c} long" for c in [*_PER_DOC, "n_best", "count_sum"]) + ", groups_sha256 string"
    result = slices.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(finish, schema)
    return result.withColumnRenamed("id", id_col)
