"""Best-fit packing of tokenised documents into sequences, after a Martello-Toth dominance reduction.

Only how many pieces there are of each length matters to a packing, and there are at most ``capacity`` lengths. So the pieces
are counted where they lie, the packing is planned on those counts, and every piece then finds its place from its own length
and number. The plan has a few thousand rows at most, whatever the number of documents.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adyield.llm.common import pick, text_slices
from adyield.session import checkpointed

CAPACITY = 1024
END_ID = 2
# Fixed value: the pattern by which byte-level BPE vocabularies of this kind cut a text into words.
WORD_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts with other characters are left to the general tokeniser.
_PLAIN = regex.compile(r"[\t\n\r\x20-\x7e\xa0-ɏ]*")
SLICE_BYTES = 4 << 20


class Encoder:
    """Token ids of a byte-level BPE file. Plain texts take a faster path over the same vocabulary with the same result."""

    def __init__(self, path: str):
        self.general = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.special = [t["content"] for t in model.get("added_tokens", [])]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(byte_of[c] for c in token): rank for token, rank in model["model"]["vocab"].items()
                 if token not in self.special}
        self.fast = tiktoken.Encoding("plain", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.general.encode(text, add_special_tokens=False).ids, np.uint32)


def _dominant(counts: np.ndarray, item: int) -> list[int] | None:
    """A set of lengths that some best packing puts beside ``item``, if that can be told: none, one or two of them.

    The set dominates when every other set that fits beside the item can be exchanged for it, each of its lengths standing in
    for one or more of the other's that together are no longer.
    """
    capacity = len(counts) - 1
    room = capacity - item
    rest = counts.copy()
    rest[item] -= 1
    there = np.flatnonzero(rest[:room + 1])
    if not len(there):
        return []
    largest = int(there[-1])
    if largest == room:
        return [largest]
    smallest = np.repeat(there, np.minimum(rest[there], 3))[:3]
    if len(smallest) < 2 or smallest[:2].sum() > room:
        return [largest]
    if len(smallest) == 3 and smallest.sum() <= room:
        return None
    # at most two lengths fit beside the item: for each first one its longest companion
    place = np.searchsorted(there, room - there, side="right") - 1
    partner = np.where(place >= 0, there[np.maximum(place, 0)], 0)
    twice = (partner == there) & (rest[there] < 2)
    lower = np.concatenate([[0], there[:-1]])
    partner = np.where(twice, lower, partner)
    total = np.where(partner > 0, there + partner, 0)
    if total.max() <= largest:
        return [largest]
    beside = int(partner[-1])
    if not beside:
        return None
    short, long = np.minimum(there, partner), np.maximum(there, partner)
    fine = (total <= largest) | ((short <= beside) & (long <= largest))
    return [largest, beside] if fine.all() else None


def plan_packing(counts: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Where each piece goes, given how many pieces there are of each length (``counts[0]`` is unused, the last is capacity).

    Returns rows (length, first number, how many, first sequence, offset): those pieces of that length go to consecutive
    sequences at that offset; the number of sequences; and how many of them the reduction fixed.
    """
    capacity = len(counts) - 1
    left = counts.astype(np.int64).copy()
    number = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def put(length: int, many: int, sequence: int, offset: int) -> None:
        rows.append((length, int(number[length]), many, sequence, offset))
        number[length] += many
        left[length] -= many

    changed = True
    while changed:
        changed = False
        for item in range(capacity, 0, -1):
            while left[item]:
                beside = _dominant(left, item)
                if beside is None:
                    break
                whole = [item, *beside]
                many = min(int(left[x]) // whole.count(x) for x in whole)
                offset = 0
                for length in whole:
                    put(length, many, sequences, offset)
                    offset += length
                sequences += many
                changed = True
    fixed = sequences

    open_groups: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room left: first sequence, how many
    for length in range(capacity, 0, -1):
        room = length
        while left[length]:
            while room <= capacity and not open_groups[room]:
                room += 1
            if room > capacity:
                per_sequence = capacity // length
                many = -(-int(left[length]) // per_sequence)
                open_groups[capacity].append((sequences, many))
                sequences += many
                room = capacity
            sequence, many = open_groups[room].pop()
            used = min(many, int(left[length]))
            if used < many:
                open_groups[room].append((sequence + used, many - used))
            put(length, used, sequence, capacity - room)
            open_groups[room - length].append((sequence, used))
            room = length if room - length >= length else room
    return np.array(sorted(rows), np.int64).reshape(-1, 5), sequences, fixed


def cut_into_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokens of each document and ``end_id``, in pieces: (id, piece, start, length, ids_crc32, part, nth[, ids]).

    A longer document than ``capacity`` is cut into full pieces, of which only the first may be shorter. ``nth`` numbers the
    pieces of one length that a task ``part`` has made.
    """
    rows = pick(docs, id=id_col, text=text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        part = TaskContext.get().partitionId()
        made = [0] * (capacity + 1)
        for batch in batches:
            for piece in text_slices(batch, "text", SLICE_BYTES):
                out = []
                for key, text in zip(piece.column("id").to_pylist(), piece.column("text").to_pylist()):
                    ids = np.append(encoder.ids(text or ""), np.uint32(end_id)).astype("<u4")
                    first = (len(ids) - 1) % capacity + 1
                    for number, stop in enumerate(range(first, len(ids) + 1, capacity)):
                        own = ids[max(0, stop - capacity) if number else 0:stop]
                        out.append((key, number, stop - len(own), len(own), zlib.crc32(own.tobytes()), part, made[len(own)],
                                    own if with_ids else None))
                        made[len(own)] += 1
                columns = list(zip(*out))
                arrays = [pa.array(columns[0], piece.column("id").type), pa.array(columns[1], pa.int32()),
                          *[pa.array(c, pa.int64()) for c in columns[2:7]]]
                names = ["id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                if with_ids:
                    arrays.append(pa.array([c.astype(np.int32) for c in columns[7]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"id {rows.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, part long, nth long"
    return rows.mapInArrow(cut, schema + (", ids array<int>" if with_ids else ""))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pack whole documents, ended by ``end_id``, into as few sequences of ``capacity`` tokens as the method finds.

    Returns one row per piece: ``id_col``, piece, start (tokens of its document before it), length, ids_crc32 (of the ids as
    little-endian 32-bit words), sequence_id, offset in the sequence, and the ids with ``with_ids``.

    A null or empty text is its ``end_id`` alone. Repeated rows and rows without an id are packed each for itself. An empty
    table gives an empty result. Other columns may have any name.
    """
    pieces = checkpointed(cut_into_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, with_ids))
    per_part = checkpointed(pieces.groupBy("part", "length").agg(F.count("*").alias("many")))
    counts = np.zeros(capacity + 1, np.int64)
    for length, many in per_part.groupBy("length").agg(F.sum("many")).collect():
        counts[length] = many
    rows, _, _ = plan_packing(counts)
    key = rows[:, 0] << 44 | rows[:, 1]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = per_part.select("part", "length", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("begins"))
    names = ["id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            number = batch.column("begins").to_numpy() + batch.column("nth").to_numpy()
            row = rows[np.searchsorted(key, batch.column("length").to_numpy() << 44 | number, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(row[:, 3] + number - row[:, 1]), pa.array(row[:, 4])],
                names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"{n} {pieces.schema[n].dataType.simpleString()}" for n in names) + ", sequence_id long, offset long"
    placed = pieces.join(begins, ["part", "length"]).select(*names, "nth", "begins").mapInArrow(place, schema)
    return placed.toDF(id_col, *placed.columns[1:])
