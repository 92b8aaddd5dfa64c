"""Near-duplicates, repeated passages and repeated lines against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from adyield.llm import common, near_dedup, queries, suffix_dedup, unit_dedup
from adyield.llm.components import component_labels

SCHEMA = "doc_id long, text string, lang string, n_bytes long, n_shingles string, kept string, unit int"


def frame(spark, rows):
    """Documents with extra columns whose names the results use too."""
    return spark.createDataFrame([(i, t, None, 7, "x", "y", 1) for i, t in rows], SCHEMA)


def shingles(text, k):
    words = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def groups(rows, k):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[find(j)] = find(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return sorted((key, len(sets[i]), least[find(i)], key == least[find(i)]) for i, (key, _) in enumerate(rows))


def corpus(seed=1):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(3))
    rows = []
    for family in range(8):
        base = [word() for _ in range(draw.choice([6, 40, 120]))]
        for _ in range(draw.choice([1, 3, 25])):
            copy = list(base)
            for _ in range(draw.randint(0, len(base) // 12)):
                copy[draw.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += ["", " \t\n", "one", "ONE", "One\x0b", "naïve É", "naïve é", rows[0], rows[0].upper()]
    draw.shuffle(rows)
    return list(enumerate(rows))


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    for k in (2, 5):
        found = near_dedup.near_duplicates(frame(spark, rows), shingle=k).collect()
        assert sorted(tuple(r) for r in found) == groups(rows, k)


def brute_links(sets, percent=80):
    return {(i, j) for i, j in combinations(range(len(sets)), 2) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}


@pytest.mark.parametrize("part", [0, near_dedup.COMPONENT_PART])
def test_distances_from_the_hub_prune_no_link(spark, monkeypatch, part):
    """One run with a dense group, documents at its rim, a far one, and two of other sizes: links across components are all offered."""
    monkeypatch.setattr(near_dedup, "COMPONENT_PART", part)
    draw = random.Random(9)
    base = list(range(100))
    sets = [set(base)]
    for cut in [2, 4, 6, 8, 10, 14, 18, 22, 26, 30, 40]:
        for _ in range(3):
            sets.append(set(base[cut:]) | set(draw.sample(range(200, 400), cut)))
    sets += [set(base[:70]), set(base) | set(range(500, 540)), set(range(900, 1000))]
    words = [" ".join(f"w{x}" for x in sorted(s)) for s in sets]
    whole = [shingles(w, 1) for w in words]
    links = brute_links(whole)
    items = [np.unique(np.array([hash(x) & (2**64 - 1) for x in s], np.uint64)) for s in whole]
    table = spark.createDataFrame([(i, x.tobytes(), near_dedup._parity(x)) for i, x in enumerate(items)], "node long, items binary, parity binary")
    apart = lambda i, j: 1 - len(whole[i] & whole[j]) / len(whole[i] | whole[j])
    for labels in ([0] * 10 + list(range(10, len(sets))), list(range(len(sets)))):
        members = [(7, 0, i, len(s), labels[i], labels[0], apart(0, i), apart(0, i) if i % 2 else 1.0) for i, s in enumerate(sets)]
        rows = spark.createDataFrame(members, "run long, hub long, node long, n long, label long, hub_label long, low double, high double")
        linked = spark.createDataFrame([(i, len(s), label) for i, (s, label) in enumerate(zip(sets, labels)) if labels.count(label) > 1], "node long, n long, label long")
        offered = {(r.x, r.y) for r in near_dedup._across_components(rows, linked, table, 80).collect()}
        wanted = {(i, j) for i, j in links if 0 not in (i, j) and labels[i] != labels[j] and (labels[i] != labels[0] or labels[j] != labels[0])}
        assert wanted <= offered
        assert all(apart(i, j) < 0.6 for i, j in offered)


@pytest.mark.parametrize("runs", [0, near_dedup.BROADCAST_RUNS])
def test_near_duplicates_with_hot_bands(spark, monkeypatch, runs):
    monkeypatch.setattr(near_dedup, "HOT_ROWS", 4)
    monkeypatch.setattr(near_dedup, "BROADCAST_RUNS", runs)
    rows = corpus()
    found = near_dedup.near_duplicates(frame(spark, rows), shingle=2).collect()
    assert sorted(tuple(r) for r in found) == groups(rows, 2)


def test_near_duplicates_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "a b c"), (3, "x y z"), (4, "X  Y z"), (5, "long " * 20_000)]
    found = near_dedup.near_duplicates(frame(spark, rows), shingle=2).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r) for r in found), key=key) == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 2, 3, True), (3, 2, 3, True), (None, 2, None, True), (3, 2, 3, True),
        (4, 2, 3, False), (5, 1, 5, True)], key=key)
    assert near_dedup.near_duplicates(frame(spark, []), shingle=2).collect() == []


def test_parity_sketches_rule_out_no_link():
    draw = np.random.default_rng(5)
    for _ in range(200):
        both = draw.integers(0, 2**63, draw.integers(20, 900), dtype=np.uint64)
        extra = draw.integers(0, 2**63, (2, max(1, len(both) // 9)), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, e])) for e in extra)
        p, q = (np.frombuffer(near_dedup._parity(x), np.uint64) for x in (a, b))
        assert int(np.bitwise_count(p ^ q).sum()) <= len(a) + len(b) - 2 * len(np.intersect1d(a, b))


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    labels = {r.node: r.label for r in component_labels(spark.createDataFrame(chain, "x long, y long")).collect()}
    assert labels == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}
    assert component_labels(spark.createDataFrame([], "x long, y long")).count() == 0


def repeats(rows, length):
    seen = {}
    for _, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            seen[data[i:i + length]] = seen.get(data[i:i + length], 0) + 1
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((key, len(data), sum(gone), sum(g for g, _ in groupby(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


def removed(df):
    return sorted(((r[0], r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()),
                  key=lambda r: (r[0] is None, r))


def test_cover_reaches_every_shift():
    cover, v = suffix_dedup.COVER, suffix_dedup.COVER_MODULUS
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))


def test_passages_equal_brute_force(spark):
    draw = random.Random(4)
    text = lambda n: "".join(draw.choice("abcdé ") for _ in range(n))
    shared = [text(n) for n in (399, 400, 401, 640, 1500)]
    rows = [(i, text(draw.randint(0, 300)) + draw.choice(shared) + text(draw.randint(0, 300))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "a" * 399), (53, "ab" * 350), (54, rows[0][1]), (54, rows[0][1]), (None, shared[4][100:900]),
             (55, shared[3][1:] + shared[3]), (56, "z" * 5000)]
    assert removed(suffix_dedup.remove_repeats(frame(spark, rows).repartition(5))) == repeats(rows, 400)
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


def word_repeats(rows, length, words):
    """What is left of each text without repeated strings of bytes and runs of words."""
    seen, found = Counter(), []
    for key, text in rows:
        data = (text or "").encode()
        spans = [(i, i + length, data[i:i + length]) for i in range(len(data) - length + 1)]
        at = [(m.start(), m.end()) for m in re.finditer(rb"[^ \t-\r]+", data)]
        spans += [(at[i][0], at[i + words - 1][1], tuple(data[a:b] for a, b in at[i:i + words])) for i in range(len(at) - words + 1)]
        seen.update(s[2] for s in spans)
        found.append((key, data, spans))
    for key, data, spans in found:
        gone = {i for a, b, s in spans if seen[s] > 1 for i in range(a, b)}
        yield key, bytes(c for i, c in enumerate(data) if i not in gone)


def test_passages_of_words_equal_brute_force(spark):
    draw = random.Random(8)
    text = lambda n: " ".join("".join(draw.choice("abcdéf") for _ in range(draw.randint(1, 6))) for _ in range(n))
    shared = [text(n) for n in (50, 51, 52, 70, 200)]
    rows = [(i, text(draw.randint(0, 60)) + " " + draw.choice(shared) + " " + text(draw.randint(0, 60))) for i in range(30)]
    rows += [(40, shared[1].replace(" ", "\n \t")), (41, None), (42, " "), (43, "a " * 60), (44, shared[1] + "x"), (None, shared[4]),
             (45, "\n" + shared[2]), (46, text(30)), (46, text(30)), (47, "q" * 900)]
    found = suffix_dedup.remove_repeats(frame(spark, rows).repartition(3), words=51).collect()
    assert sorted((r[0] or 0, bytes(r.kept)) for r in found) == sorted((k or 0, t) for k, t in word_repeats(rows, 400, 51))


def word_passages(rows, words):
    """The maximal stretches of each text that runs of words which stand elsewhere cover, as start and length."""
    seen, found = Counter(), []
    for key, text in rows:
        data = (text or "").encode()
        at = [(m.start(), m.end()) for m in re.finditer(rb"[^ \t-\r]+", data)]
        runs = [(at[i][0], at[i + words - 1][1], tuple(data[a:b] for a, b in at[i:i + words])) for i in range(len(at) - words + 1)]
        seen.update(r[2] for r in runs)
        found.append((key, runs))
    for key, runs in found:
        covered = sorted({i for a, b, r in runs if seen[r] > 1 for i in range(a, b)})
        parts = [[i for _, i in g] for _, g in groupby(enumerate(covered), lambda x: x[1] - x[0])]
        yield key, [(p[0], len(p)) for p in parts]


def test_passages_of_words_are_named_and_not_cut(spark):
    draw = random.Random(12)
    text = lambda n: " ".join("".join(draw.choice("abé") for _ in range(draw.randint(1, 5))) for _ in range(n))
    shared = [text(n) for n in (50, 51, 53, 90)]
    rows = [(i, text(draw.randint(0, 60)) + " " + draw.choice(shared) + " " + text(draw.randint(0, 60))) for i in range(30)]
    rows += [(40, shared[1].replace(" ", "\n \t")), (41, None), (42, " "), (43, "a " * 60), (44, shared[1] + "x"), (45, "b " * 52 + text(9) + " b" * 51),
             (46, shared[2] + " " + shared[1]), (47, "q" * 900), (48, text(40)), (48, text(40))]
    found = suffix_dedup.remove_repeats(frame(spark, rows).repartition(3), words=51, cut_words=False)
    assert sorted((r.doc_id, [tuple(s) for s in r.passages]) for r in found.collect()) == sorted(word_passages(rows, 51))
    assert removed(found) == repeats(rows, 400)


def test_runs_of_words_share_their_anchor_wherever_they_stand():
    draw = random.Random(3)
    words = lambda n: [f"{draw.randrange(10**6)}" for _ in range(n)]
    shared = words(60)
    texts = [" ".join(words(40) + shared + words(7)), " ".join(words(3) + shared + words(90))]
    sinks = [pa.BufferOutputStream() for _ in texts]
    for sink, text in zip(sinks, texts):
        batch = pa.RecordBatch.from_pydict({"text": [text]})
        with pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
    a, b = (suffix_dedup._Runs(suffix_dedup._Block(s.getvalue()), 51) for s in sinks)
    equal = set(a.names.tolist()) & set(b.names.tolist())
    assert len(equal) == 10 and len(a.names) == 57 and len(b.names) == 103
    anchor = dict(zip(b.names.tolist(), b.anchors.tolist()))
    assert all(anchor[n] == m for n, m in zip(a.names.tolist(), a.anchors.tolist()) if n in equal)
    # only runs around the shared words are left to be sorted, and few anchors stand for many runs
    tied = np.isin(b.anchors, a.anchors)
    assert 10 <= tied.sum() < 40 and len(set(b.anchors.tolist())) < 20 and not b.anchored_twice.any()


@pytest.mark.parametrize("size", [1, 5])
def test_pipeline_cuts_51_words_of_any_bytes(spark, size):
    shared = " ".join(f"{i:0{size}d}" if size > 2 else chr(0x61 + i % 26) for i in range(51))
    assert len(shared.encode()) == 51 * (size + 1) - 1 < 400
    rows = [(1, f"first {shared} one"), (2, f"other {shared} two"), (3, "unique " + shared[:-2 * size])]
    found = {r.doc_id: r.text for r in corpus_pipeline.without_repeated_passages(spark, frame(spark, rows).withColumn("source", F.lit("s")), "").collect()}
    assert found == {1: "first  one", 2: "other  two", 3: rows[2][1]}


def test_passage_spans_and_kept_columns(spark):
    rows = [(1, "é" + "q" * 399 + "tail"), (2, "q" * 399 + "other")]
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(frame(spark, rows), keep=("lang", "kept"), length=300, as_text=True)
             .toDF("doc_id", "lang", "kept_column", "n_bytes", "n_removed", "n_spans", "spans", "kept").collect()}
    assert [(s.start, s.length) for s in found[1].spans] == [(2, 399)]
    assert found[1].kept == "étail" and found[2].kept == "other" and found[1].kept_column == "y"


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50), st.binary(max_size=60))
def test_packed_words_and_window_hashes(values, data):
    ordered = np.unique(np.array(values, np.uint64))
    assert (common.unpack_sorted(common.pack_sorted(ordered)) == ordered).all()
    signed = np.array(values, np.uint64).view(np.int64)
    assert (common.unpack_words(common.pack_words(signed)) == signed).all()
    twice = np.frombuffer(data + b"#" + data, np.uint8)
    prefix = common.prefix_hash(twice)
    for size in (1, 7):
        starts = np.arange(max(0, len(data) - size + 1))
        left = common.window_hash(prefix, starts, starts + size)
        right = common.window_hash(prefix, starts + len(data) + 1, starts + len(data) + 1 + size)
        assert (left == right).all()
        assert len(set(left.tolist())) == len({data[i:i + size] for i in starts})


def test_hashes_of_no_bytes_in_a_fresh_worker(monkeypatch):
    monkeypatch.setattr(common, "_powers", [])
    none = np.zeros(0, np.int64)
    assert len(common.substring_hashes(np.zeros(0, np.uint8), none, none)) == 0


def test_window_hashes_tell_structured_strings_apart():
    """Thue-Morse strings and their complements, whose hashes modulo a power of two with an odd base come to agree."""
    assert all(all(p % k for k in range(2, 50_000)) for p in common._PRIMES)
    for length in (64, 256, 1024, 4096):
        bits = [bin(i).count("1") % 2 for i in range(length)]
        pair = np.array([97 + b for b in bits] + [98 - b for b in bits], np.uint8)
        a, b = common.window_hash(common.prefix_hash(pair), np.array([0, length]), np.array([length, 2 * length]))
        assert bin(int(a) ^ int(b)).count("1") > 8
    halves = np.concatenate([pair, pair[::-1]])
    names = common.window_hash(common.prefix_hash(halves), np.arange(len(halves) - 64), np.arange(64, len(halves)))
    assert len(set(names.tolist())) == len({halves[i:i + 64].tobytes() for i in range(len(halves) - 64)})


def test_lines_equal_brute_force(spark):
    rows = [(3, "A b\nsame  line\n\nSAME line\nlast"), (1, "x\nsame line"), (2, None), (4, ""), (5, "X \n" * 4), (6, "\n"),
            (None, "a B\nnew"), (None, "new"), (7, "y" * 100_000 + "\nlast")]
    seen, expected = set(), {}
    for key, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        at, gone = 0, []
        for unit, line in enumerate((text or "").split("\n")):
            plain = " ".join(line.lower().split())
            if plain and plain in seen:
                gone.append((unit, at, at + len(line)))
            seen.add(plain)
            at += len(line) + 1
        expected[key] = (len((text or "").split("\n")), len(gone), sum(e - s for _, s, e in gone), gone)
    found = unit_dedup.remove_repeated_units(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_units, r.n_removed, r.n_chars_removed, [tuple(s) for s in r.removed])
            for r in found if r.doc_id is not None} == expected
    assert sorted(r.n_removed for r in found if r.doc_id is None) in ([0, 2], [1, 1])
    assert unit_dedup.remove_repeated_units(frame(spark, [])).count() == 0


def test_repeated_rows_keep_a_line_once(spark):
    found = unit_dedup.remove_repeated_units(frame(spark, [(1, "a\nb"), (1, "a\nb")])).collect()
    assert sorted(r.n_removed for r in found) == [0, 2]


def test_runs_of_lines_of_a_least_size(spark):
    """A run of repeated lines goes from its least number of words on; blank lines do not end it, others do."""
    rows = [(1, "a b c\nd e\nf\nown line\ng"), (2, "a b c\n\nd e\nf\nother\ng"), (3, "f\nnew\ng\nA  b C"), (4, "d e\nf\n \ng"), (4, "d e\nf\n \ng"), (5, None)]
    frames = frame(spark, rows)
    found = sorted((r.doc_id, r.n_repeated, r.n_removed) for r in unit_dedup.remove_repeated_units(frames, least_words=4).collect())
    assert found == [(1, 0, 0), (2, 4, 3), (3, 3, 2), (4, 3, 3), (4, 3, 3), (5, 0, 0)]
    every = sorted((r.doc_id, r.n_repeated, r.n_removed) for r in unit_dedup.remove_repeated_units(frames, least_words=1).collect())
    assert every == sorted((r.doc_id, r.n_repeated, r.n_removed) for r in unit_dedup.remove_repeated_units(frames).collect())


def test_spans_are_cut_out():
    assert unit_dedup.without_spans("a\nbb\nc", [(2, 4)]) == "a\nc"
    assert unit_dedup.without_spans("a\nbb\nc", [(5, 6)]) == "a\nbb"
    assert unit_dedup.without_spans("a", []) == "a"


def test_registered_passages_on_given_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = queries.QUERIES["op9_suffix_array_dedup"](spark, sf).collect()
    assert sorted((tuple(r)[:5] for r in found), key=lambda r: (r[0] is None, r)) == repeats(rows, 400)
    assert sorted((r.doc_id, r.n_passages) for r in found) == sorted((k, len(p)) for k, p in word_passages(rows, 51))
    assert any(r.n_passages and not r.n_removed for r in found)
    # the remaining text is whole where no cut went through a character
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in found if "\ufffd" not in r.text)
