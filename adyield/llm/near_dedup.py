"""Near-duplicate documents: MinHash with tensored banding, links confirmed on whole shingle sets.

A document keeps two collections of ``m`` band keys, each made of ``r`` minhashes. A table key combines one band of the first
collection with one of the second, which gives m * m tables from 2 * m * r minhashes instead of m * m * 2 * r. With m = 12 and
r = 3 two documents of similarity 0.8 share a key with probability 0.9996, at 0.85 with 0.99998; texts of one set are one class.

Documents that share a key form a run. Members are first compared with the run's smallest document; those that belong to no
component with it are then compared with every other member outside their own component. Links inside a component are not
needed to find it, so no group is expanded into its pairs. Jaccard distance is a metric, and every member's distance from the
smallest document is known by then: members whose distances from it differ by more than a link spans cannot be linked, and
leave the run before anything meets. What is left is compared in blocks on parity sketches: of each set's hashes, the parity of
the count in each of 2048 cells. Cells that differ are at most the elements in which two sets differ, so a pair with more of them
than the similarity allows is no link, and only the others go on to the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adyield.llm.common import (checkpointed_in, mixed, pack_sorted, pack_words, pick, substring_hashes, text_bytes, text_slices,
                                unpack_sorted, unpack_words)
from adyield.llm.components import component_labels
from adyield.operators.joins import join_spreading_hot_keys
from adyield.session import checkpointed

BANDS = 12
ROWS = 3
#: Keys that one bucket holds on average.
BUCKET_KEYS = 600_000
MIN_BUCKETS = 64
#: A band on more nodes than this, and than a thousandth of all, is hot; there are at most 24,000 of them.
HOT_ROWS = 100_000
#: Runs of hot keys that may be broadcast; beyond it they are joined by key, hot keys spread.
BROADCAST_RUNS = 100_000
#: Fixed size of the filter that spares unlinked texts a shuffle; more documents only make it let more pass.
FILTER_BITS = 1 << 22
PARITY_CELLS = 2048
#: Side of a block of candidate pairs, rows that one bucket of blocks holds on average, and pairs compared at a time.
BLOCK_ROWS = 2_000
BLOCK_BUCKET_ROWS = 20_000
PAIRS_AT_A_TIME = 40_000
#: A run that holds at least this part of its hub's component has its outsiders compared with the whole component, once.
COMPONENT_PART = 8
#: Slack of distances against rounding.
ROUNDING = 1e-9

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _folded(words: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """Hashes of ``count`` words in a row."""
    out = np.full(len(first), count, np.uint64)
    for step in range(count):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[first + step])
    return out


def shingle_sets(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, end to end, and where each text's begin.

    Words are runs of other bytes than blank, tab, line feed, vertical tab, form feed and carriage return, with A-Z in lower
    case. A text of fewer words than a shingle has its whole sequence as its only one; without words the set is empty.
    """
    data, offsets = text_bytes(column)
    data = _LOWER[data]
    inside = ~_SPACE[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[offsets < len(data)]
    before[edges] = False
    after[edges[edges > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    words = substring_hashes(data, starts, ends)
    bounds = np.searchsorted(starts, offsets)
    counts = np.diff(bounds)
    sets = []
    for first, count in zip(bounds[:-1], counts):
        if count == 0:
            sets.append(words[:0])
        elif count < shingle:
            sets.append(_folded(words, np.array([first]), int(count)))
        else:
            sets.append(np.unique(_folded(words, np.arange(first, first + count - shingle + 1), shingle)))
    sizes = np.array([len(s) for s in sets], np.int64)
    return np.concatenate([words[:0], *sets]), np.concatenate([[0], np.cumsum(sizes)])


def _digests(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(values ^ np.uint64(salt)), dtype=np.uint64)]) for salt in (1, 2)]
    return tuple((s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums)


def _bands(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Band keys of each non-empty set: the first collection's, then the second's."""
    draw = np.random.Generator(np.random.PCG64(7)).integers(0, 2**63, (2 * BANDS * ROWS, 2), dtype=np.uint64)
    keys = np.zeros((len(at) - 1, 2 * BANDS), np.uint64)
    for place, (a, b) in enumerate(draw):
        least = np.minimum.reduceat((values ^ b) * (a | np.uint64(1)), at[:-1])
        band = place // ROWS
        keys[:, band] = mixed(keys[:, band] * np.uint64(31) + least + np.uint64(band + 1))
    return keys


def _sketches(docs: DataFrame, shingle: int) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, "text"):
                values, at = shingle_sets(piece.column("text"), shingle)
                sizes = np.diff(at)
                a, b = _digests(values, at)
                full = sizes > 0
                keys = np.zeros((len(sizes), 2 * BANDS), np.int64)
                if full.any():
                    keys[full] = _bands(values, np.concatenate([at[:-1][full], at[-1:]])).view(np.int64)
                places = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * 2 * BANDS)
                yield pa.RecordBatch.from_pydict({
                    "id": piece.column("id"), "n": pa.array(sizes), "a": pa.array(a), "b": pa.array(b),
                    "bands": pa.ListArray.from_arrays(places, pa.array(keys.ravel()))})

    return docs.mapInArrow(sketch, f"id {docs.schema['id'].dataType.simpleString()}, n long, a long, b long, bands array<long>")


def _classes(sketches: DataFrame, rows: int) -> DataFrame:
    """One node for each distinct set. Its name is its smallest id, or a hash where another set has the same smallest id."""
    sets = sketches.filter("n > 0 and id is not null").groupBy("a", "b").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    owners = sets.groupBy("rep").agg(F.min(F.struct("a", "b")).alias("owner"))
    mine = F.col("owner") == F.struct("a", "b")
    node = F.when(mine, F.col("rep")).otherwise(F.xxhash64("a", "b", "rep")).alias("node")
    return checkpointed_in(sets.join(owners, "rep").select("a", "b", "rep", "n", "bands", node), rows)


def _table_keys(bands: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table keys of each node, and which of them are made of two hot bands."""
    pairs = bands[:, :BANDS, None] * np.uint64(0x9E3779B97F4A7C15) + bands[:, None, BANDS:]
    is_hot = np.isin(bands, hot)
    both = is_hot[:, :BANDS, None] & is_hot[:, None, BANDS:]
    salt = mixed(np.arange(1, BANDS * BANDS + 1, dtype=np.uint64))
    return mixed(pairs.reshape(len(bands), -1) ^ salt), both.reshape(len(bands), -1)


def _hot_runs(nodes: DataFrame, hot: np.ndarray) -> DataFrame:
    """Runs of the keys made of two hot bands. No task gathers one: hubs are pre-aggregated, members find theirs by a join."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 4096):
                batch = whole.slice(start, 4096)
                table, both = _table_keys(batch.column("bands").flatten().to_numpy().reshape(-1, 2 * BANDS).view(np.uint64), hot)
                row, place = np.nonzero(both)
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(table[row, place].view(np.int64)),
                    "node": batch.column("node").take(pa.array(row)), "n": batch.column("n").take(pa.array(row))})

    sent = nodes.select("node", "n", "bands").mapInArrow(keys, "key long, node long, n long")
    shared = sent.groupBy("key").agg(
        F.min("node").alias("hub"), F.min_by("n", "node").alias("hub_n"), F.bit_xor(F.xxhash64("node")).alias("run"),
        F.count("*").alias("many")).filter("many > 1").dropDuplicates(["run"])
    shared = checkpointed(shared)
    if shared.count() <= BROADCAST_RUNS:
        found = sent.join(F.broadcast(shared), "key")
    else:
        found = join_spreading_hot_keys(sent, shared, "key", "many", HOT_ROWS)
    return found.select("run", "hub", "hub_n", "node", "n")


def _runs(nodes: DataFrame) -> DataFrame:
    """Documents that share a table key, one run for each distinct group: (run, hub, hub_n, node, n)."""
    n_nodes = nodes.count()
    buckets = max(MIN_BUCKETS, -(-n_nodes * BANDS * BANDS // BUCKET_KEYS))
    frequent = nodes.select(F.explode("bands").alias("band")).groupBy("band").agg(F.count("*").alias("many")) \
        .filter(F.col("many") > max(HOT_ROWS, n_nodes // 1_000))
    hot = np.array(sorted(row[0] for row in frequent.select("band").collect()), np.int64).view(np.uint64)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = (np.arange(1, buckets, dtype=object) * 2**64 // buckets).astype(np.uint64)
        for whole in batches:
            for start in range(0, len(whole), 4096):
                batch = whole.slice(start, 4096)
                table, both = _table_keys(batch.column("bands").flatten().to_numpy().reshape(-1, 2 * BANDS).view(np.uint64), hot)
                table = table.ravel()
                order = np.argsort(table)
                order = order[~both.ravel()[order]]
                table = table[order]
                cuts = np.concatenate([[0], np.searchsorted(table, edges), [len(table)]])
                node, n = (batch.column(c).to_numpy()[order // (BANDS * BANDS)] for c in ("node", "n"))
                full = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(full),
                    "keys": pa.array([pack_sorted(table[cuts[b]:cuts[b + 1]]) for b in full], pa.binary()),
                    "nodes": pa.array([pack_words(node[cuts[b]:cuts[b + 1]]) for b in full], pa.binary()),
                    "ns": pa.array([pack_words(n[cuts[b]:cuts[b + 1]]) for b in full], pa.binary())})

    def find(table: pa.Table) -> pa.Table:
        key = np.concatenate([unpack_sorted(x) for x in table.column("keys").to_pylist()])
        node = np.concatenate([unpack_words(x) for x in table.column("nodes").to_pylist()])
        n = np.concatenate([unpack_words(x) for x in table.column("ns").to_pylist()])
        order = np.lexsort((node, key))
        key, node, n = key[order], node[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([first, [len(key)]]))
        first, size = first[size > 1], size[size > 1]
        rows = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        places = np.cumsum(size) - size
        name = np.add.reduceat(mixed(node[rows].view(np.uint64)), places) if len(rows) else np.zeros(0, np.uint64)
        _, once = np.unique(name, return_index=True)
        chosen = np.zeros(len(first), bool)
        chosen[once] = True
        take = np.repeat(chosen, size)
        hub = np.repeat(first, size)[take]
        rows = rows[take]
        return pa.table({"run": np.repeat(name.view(np.int64), size)[take], "hub": node[hub], "hub_n": n[hub],
                         "node": node[rows], "n": n[rows]})

    sent = nodes.select("node", "n", "bands").mapInArrow(keys, "bucket long, keys binary, nodes binary, ns binary")
    found = sent.groupBy("bucket").applyInArrow(find, "run long, hub long, hub_n long, node long, n long")
    if len(hot):
        found = found.union(_hot_runs(nodes, hot))
    return found.dropDuplicates(["run", "node"])


def _let_through(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id may be among ``ids``: a bit table of fixed size, broadcast, that passes every id it must."""
    def word(column: str):
        return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS // 64)).cast("int")

    def bit(column: str):
        return F.expr(f"shiftleft(1L, cast(pmod(xxhash64({column}, 1), 64) as int))")

    words = ids.select(word("id").alias("word"), bit("id").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return docs.join(F.broadcast(words), word("id") == F.col("word")).filter(F.col("bits").bitwiseAND(bit("id")) != 0) \
        .drop("word", "bits")


def _parity(values: np.ndarray) -> bytes:
    odd = np.bincount((values >> np.uint64(40)).astype(np.int64) % PARITY_CELLS, minlength=PARITY_CELLS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _sets(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """Whole shingle sets of the given nodes and their parity sketches: (node, items, parity)."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, "text"):
                values, at = shingle_sets(piece.column("text"), shingle)
                a, b = _digests(values, at)
                same = (a == piece.column("a").to_numpy()) & (b == piece.column("b").to_numpy())
                items = [values[at[i]:at[i + 1]] for i in np.flatnonzero(same)]
                yield pa.RecordBatch.from_pydict({
                    "node": piece.column("node").filter(pa.array(same)),
                    "items": pa.array([x.tobytes() for x in items], pa.binary()),
                    "parity": pa.array([_parity(x) for x in items], pa.binary())})

    named = nodes.select(F.col("rep").alias("id"), "node", "a", "b")
    rows = _let_through(docs, named).join(named, "id")
    return rows.mapInArrow(build, "node long, items binary, parity binary").dropDuplicates(["node"])


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) with the Jaccard distance of their sets, and whether it makes them a link."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart, good = [], []
            for p, q in zip(batch.column("p"), batch.column("q")):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (p, q))
                both = len(np.intersect1d(p, q, assume_unique=True))
                either = len(p) + len(q) - both
                apart.append(1 - both / either)
                good.append(100 * both >= percent * either)
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.array(apart, pa.float64()), pa.array(good, pa.bool_())],
                                             names=["x", "y", "apart", "linked"])

    return (pairs.join(sets.select(F.col("node").alias("x"), F.col("items").alias("p")), "x")
            .join(sets.select(F.col("node").alias("y"), F.col("items").alias("q")), "y")
            .select("x", "y", "p", "q").mapInArrow(compare, "x long, y long, apart double, linked boolean"))


def _across_components(members: DataFrame, linked: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of a run, from two components, that nothing has ruled out: (x, y).

    Pairs with the run's hub have been compared before; ``low`` and ``high`` bound each member's distance from it. Members outside the
    hub's component meet one another run by run. Where a run holds a good part of the hub's component (``linked``: node, n, label),
    they meet the whole component, which is sent once and not once for every run they share with it; else those of its members in
    the run whose sizes and distances leave someone outside within reach. A large group is cut into blocks, so no task holds it whole.
    """
    outside = F.col("label") != F.col("hub_label")
    reach = 1 - percent / 100 + ROUNDING
    others = members.filter("node <> hub")
    per_run = others.groupBy("run", F.col("hub_label").alias("of_label")).agg(
        F.count(F.when(outside, 1)).alias("n_out"), F.count("*").alias("n_all"),
        *[f(F.when(outside, F.col(c))).alias(f"out_{c}_{name}") for c in ("n", "low", "high") for name, f in (("min", F.min), ("max", F.max))])
    per_run = per_run.filter("n_out > 0 and n_all > 1").withColumnRenamed("run", "of_run")
    component = linked.groupBy(F.col("label").alias("c_label")).agg(F.count("*").alias("c_size"))
    per_run = checkpointed(per_run.join(component, F.col("of_label") == F.col("c_label"), "left").withColumn(
        "whole", F.coalesce((F.col("n_all") - F.col("n_out")) * COMPONENT_PART >= F.col("c_size"), F.lit(False))))
    near = (F.col("run") == F.col("of_run")) & (outside | (
        ~F.col("whole") & (100 * F.col("n") >= percent * F.col("out_n_min")) & (percent * F.col("n") <= 100 * F.col("out_n_max"))
        & (F.col("high") + reach >= F.col("out_low_min")) & (F.col("low") <= F.col("out_high_max") + reach)))
    kept = checkpointed(others.join(per_run, near).select(
        "run", "node", "n", "label", "hub_label", "whole", "low", "high", outside.alias("out")))
    # runs of which as much is left that something can be compared, and runs left alike only once
    left = kept.groupBy("run").agg(
        F.count(F.when(F.col("out"), 1)).alias("n_out"), F.count("*").alias("n_all"), F.min("label").alias("least"),
        F.max("label").alias("most"), F.bit_xor(F.xxhash64("node", "out")).alias("name")).filter("least < most")
    left = left.groupBy("name").agg(F.min_by(F.struct("run", "n_out", "n_all"), "run").alias("one")).select("one.*")
    by_run = kept.select("run", "node", "n", "label", "low", "high", "out").join(left, "run")
    asking = checkpointed(kept.filter("whole and out").select(F.col("hub_label").alias("run"), "node", "n", "label").distinct())
    asked = asking.groupBy("run").agg(F.count("*").alias("n_out"), F.min("n").alias("n_min"), F.max("n").alias("n_max")).withColumnRenamed("run", "of")
    fits = (F.col("label") == F.col("of")) & (100 * F.col("n") >= percent * F.col("n_min")) & (percent * F.col("n") <= 100 * F.col("n_max"))
    inside = linked.join(asked, fits).select(F.col("of").alias("run"), "node", "n", "label", F.lit(False).alias("out"))
    meeting = checkpointed(inside.union(asking.select("run", "node", "n", "label", F.lit(True))))
    sides = meeting.groupBy("run").agg(F.count(F.when(F.col("out"), 1)).alias("n_out"), F.count("*").alias("n_all")).filter("n_all > n_out")
    by_component = meeting.join(sides, "run").select(
        "run", "node", "n", "label", F.lit(0.0).alias("low"), F.lit(1.0).alias("high"), "out", "n_out", "n_all")
    groups = by_run.withColumn("kind", F.lit(0)).unionByName(by_component.withColumn("kind", F.lit(1)))
    rows = groups.join(sets.select("node", "parity"), "node").withColumn("run", F.xxhash64("run", "kind"))
    across, down = (F.ceil(F.col(c) / BLOCK_ROWS).cast("int") for c in ("n_out", "n_all"))
    place = F.xxhash64("node")

    def spread(side: int, own, other):
        copies = F.explode(F.sequence(F.lit(0), other - 1))
        blocks = [F.pmod(place, own).cast("int"), copies] if side == 0 else [copies, F.pmod(place, own).cast("int")]
        chosen = rows.filter("out") if side == 0 else rows.filter("kind = 0 or not out")
        return chosen.select("run", blocks[0].alias("i"), blocks[1].alias("j"), F.lit(side).alias("side"), "node", "label", "n",
                             "out", "low", "high", "parity")

    blocks = spread(0, across, down).union(spread(1, down, across))
    buckets = max(MIN_BUCKETS, -(-(kept.count() + meeting.count()) // BLOCK_BUCKET_ROWS))

    def compare(table: pa.Table) -> pa.Table:
        run, i, j, side, node, label, n, out, low, high = (
            table.column(c).to_numpy() for c in ("run", "i", "j", "side", "node", "label", "n", "out", "low", "high"))
        parity = np.frombuffer(b"".join(table.column("parity").to_pylist()), np.uint64).reshape(len(node), -1)
        _, group = np.unique(np.stack([run, i, j]), axis=1, return_inverse=True)
        group = group.ravel()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        right = right[np.argsort(group[right], kind="stable")]
        first = np.searchsorted(group[right], group[left])
        many = np.searchsorted(group[right], group[left], side="right") - first
        upto = np.cumsum(many)
        found = []
        start = 0
        while start < len(left):
            stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + PAIRS_AT_A_TIME)))
            count = many[start:stop]
            p = np.repeat(left[start:stop], count)
            q = right[np.repeat(first[start:stop], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
            use = (label[p] != label[q]) & ((node[p] < node[q]) | ~out[q])
            use &= 100 * np.minimum(n[p], n[q]) >= percent * np.maximum(n[p], n[q])
            use &= (low[p] <= high[q] + reach) & (low[q] <= high[p] + reach)
            p, q = p[use], q[use]
            apart = np.bitwise_count(parity[p] ^ parity[q]).sum(axis=1, dtype=np.int64)
            use = apart * (100 + percent) <= (n[p] + n[q]) * (100 - percent)
            found.append(np.stack([node[p[use]], node[q[use]]]))
            start = stop
        pairs = np.unique(np.sort(np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1), axis=0), axis=1)
        return pa.table({"x": pairs[0], "y": pairs[1]})

    return blocks.withColumn("bucket", F.pmod(F.xxhash64("run", "i", "j"), F.lit(buckets))) \
        .groupBy("bucket").applyInArrow(compare, "x long, y long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """Group documents whose sets of word shingles have a Jaccard similarity of at least ``percent`` / 100.

    Returns one row per row of ``docs``: ``id_col``, n_shingles, component_id (smallest id reachable over links, its own
    included) and kept (whether the row's id is that smallest one).

    A text without words and a null text have no shingles and are linked with nothing. Rows without an id are not linked:
    their component is null and they are kept. Texts with the same set are linked always; rows that repeat an id with another
    text are judged each by its own text. An empty table gives an empty result. Other columns may have any name. The key bands
    are made for similarities of 0.8 and more. Ids are whole numbers.
    """
    rows = pick(docs, id=id_col, text=text_col)
    sketches = checkpointed(_sketches(rows, shingle))
    n_rows = sketches.count()
    nodes = _classes(sketches, n_rows)
    runs = checkpointed(_runs(nodes))
    close = f"100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)"
    involved = nodes.select("node", "rep", "a", "b").join(runs.select("node").distinct(), "node")
    sets = checkpointed(_sets(rows, involved, shingle))
    stars = runs.filter(f"node <> hub and {close}").select(F.col("hub").alias("x"), F.col("node").alias("y")).distinct()
    compared = checkpointed(_compared(stars, sets, percent))
    links = compared.filter("linked").select("x", "y")
    labels = component_labels(links)

    def labelled(df: DataFrame, node: str, label: str) -> DataFrame:
        return df.join(labels.select(F.col("node").alias(node), F.col("label").alias(label)), node, "left") \
            .withColumn(label, F.coalesce(label, node))

    # a member too large or too small for a link was not compared with the hub; sizes alone bound its distance from below
    known = compared.select(F.col("x").alias("hub"), F.col("y").alias("node"), "apart")
    bounded = runs.join(known, ["hub", "node"], "left").select(
        "run", "hub", "node", "n", F.coalesce("apart", F.lit(1.0)).alias("high"),
        F.coalesce("apart", 1 - F.least("n", "hub_n") / F.greatest("n", "hub_n")).alias("low"))
    members = checkpointed_in(labelled(labelled(bounded, "node", "label"), "hub", "hub_label"), runs.count())
    sizes = nodes.select("node", "n").join(labels, "node")
    more = checkpointed(_compared(_across_components(members, sizes, sets, percent), sets, percent).filter("linked").select("x", "y"))
    if more.limit(1).count():
        labels = component_labels(links.union(more))
    least = labels.join(nodes.select("node", "rep"), "node").groupBy("label").agg(F.min("rep").alias("component"))
    linked = labels.join(checkpointed_in(least, n_rows), "label").select("node", "component")
    classes = nodes.join(linked, "node", "left").select("a", "b", F.coalesce("component", "rep").alias("component"))
    classes = checkpointed_in(classes, n_rows)
    empty = F.col("n") == 0
    named = sketches.filter("n > 0 and id is not null").join(classes, ["a", "b"]).select("id", "n", "component")
    alone = sketches.filter("n = 0 or id is null").select("id", "n", F.when(empty, F.col("id")).alias("component"))
    return named.union(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
