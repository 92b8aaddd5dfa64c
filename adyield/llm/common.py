"""Helpers that several corpus operators share: column picking, text buffers and rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adyield.session import checkpointed

#: Rows of a small table that go into one checkpoint file, if its shuffle has more partitions than that needs.
FILE_ROWS = 25_000

#: Text that one vectorised step works on; it bounds the arrays of a Python worker, not the result.
SLICE_BYTES = 1 << 20

#: Moduli of the two rolling hashes. They are prime: modulo a power of two, structured strings would agree in their low bits.
_PRIMES = (2**31 - 1, 2**31 - 19)
_DRAW = np.random.Generator(np.random.PCG64(20240229))
_BASES = [int(_DRAW.integers(2**20, p - 1)) for p in _PRIMES]
_BYTE_CODES = np.stack([_DRAW.choice(p - 1, 256, replace=False).astype(np.uint64) + np.uint64(1) for p in _PRIMES])
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Select ``new=old`` by exact name, the first of several, whatever other columns are called."""
    have = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(have))])
    return plain.select(*[F.col(f"c{have.index(old)}").alias(new) for new, old in names.items()])


def checkpointed_in(df: DataFrame, rows: int) -> DataFrame:
    """Checkpoint a table of about ``rows`` short rows in as few files as that takes."""
    return checkpointed(df.coalesce(max(1, -(-rows // FILE_ROWS))))


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text each; one longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if row > start and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if len(sizes) > start:
        yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array and the places where each begins and the last ends; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    values = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return values[offsets[0]:offsets[-1]], offsets - offsets[0]


def _powers_of(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint32)
    size = 1
    while size < n:
        step = np.uint64(pow(base, size, prime))
        out[size:2 * size] = out[:min(size, n - size)] * step % np.uint64(prime)
        size *= 2
    return out


def powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The first ``n`` powers of each base and of its inverse, each modulo its prime."""
    global _powers
    have = len(_powers[0][0]) if _powers else 0
    if not _powers or have < n:  # texts without a byte may be the first a worker sees
        size = max(n, 2 * have, SLICE_BYTES + 1)
        _powers = [(_powers_of(base, prime, size), _powers_of(pow(base, -1, prime), prime, size)) for base, prime in zip(_BASES, _PRIMES)]
    return [(up[:n], down[:n]) for up, down in _powers]


def _running(data: np.ndarray, which: int, out: np.ndarray) -> None:
    """Running sums of one polynomial hash; sums of 2^32 terms below 2^31 stay whole."""
    terms = out[1:]
    np.take(_BYTE_CODES[which], data, out=terms)
    terms *= powers(len(data))[which][0]
    terms %= np.uint64(_PRIMES[which])
    np.cumsum(terms, out=terms)


def _window(row: np.ndarray, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    prime = np.uint64(_PRIMES[which])
    return (row[end] - row[start]) % prime * powers(len(row))[which][1][start] % prime


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums of two polynomial hashes; ``window_hash`` reads any substring's hash off them."""
    out = np.zeros((2, len(data) + 1), np.uint64)
    for which, row in enumerate(out):
        _running(data, which, row)
    return out


def substring_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``window_hash`` for substrings that are all known at once: the running sums of one hash at a time are held."""
    name, row = np.zeros(len(start), np.uint64), np.zeros(len(data) + 1, np.uint64)
    for which in range(2):
        _running(data, which, row)
        name = name << np.uint64(31) | _window(row, which, start, end)
    return mixed(name)


def window_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """62-bit hashes of ``data[start:end]``, spread over 64 bits; equal strings have equal hashes wherever they stand."""
    name = np.zeros(len(start), np.uint64)
    for which, row in enumerate(prefix):
        name = name << np.uint64(31) | _window(row, which, start, end)
    return mixed(name)


def sequence_hashes(items: np.ndarray, size: int) -> np.ndarray:
    """62-bit hashes, spread over 64 bits, of every ``size`` items one after another; equal sequences have equal hashes."""
    starts = max(0, len(items) - size + 1)
    name, row = np.zeros(starts, np.uint64), np.zeros(len(items) + 1, np.uint64)
    for which, prime in enumerate(_PRIMES):
        np.cumsum(items % np.uint64(prime) * powers(len(items))[which][0] % np.uint64(prime), out=row[1:])
        name = name << np.uint64(31) | _window(row, which, np.arange(starts), np.arange(size, size + starts))
    return mixed(name)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit words (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted distinct 64-bit words as byte planes of their differences, whose upper planes compress to nothing."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T[::-1]).tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)[::-1]
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    return edges[0::2], edges[1::2]


def pack_words(values: np.ndarray) -> bytes:
    """64-bit words as byte planes; planes that small values leave at zero compress to nothing."""
    return np.ascontiguousarray(np.ascontiguousarray(values).astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_words(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view("<i8").ravel()
