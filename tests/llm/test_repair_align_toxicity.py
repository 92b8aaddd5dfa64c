"""Conversation repair, tokenizer alignment and toxicity: against brute force, held out, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adyield.llm import alignment, conversations, queries, toxicity

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TALK = "conv_id long, turn long, role string, text string, step string, audit int"


def talk(spark, rows):
    """Conversations with extra columns whose names the results use too."""
    return spark.createDataFrame([(*r, "x", 1) for r in rows], TALK)


def faults(rows):
    """(role, text, fault) of one conversation's rows in order."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] if r[1] is not None else " ").encode(), (r[2] if r[2] is not None else " ").encode()))
    out, seen = [], set()
    for turn, role, text in order:
        role, text = (" " if v is None else v for v in (role, text))
        bare = text.rstrip(" \t\n\v\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def cheapest(rows):
    """Least (cost, audit, repaired lines) over all edit sequences, by a plain table of whole sequences."""
    states = {"": (0, "", ())}

    def insert(states):
        for _ in range(2):
            for state, (cost, audit, said) in list(states.items()):
                role = {"u": "assistant"}.get(state, "user")
                new = (cost + 3, audit + "I", (*said, f"{role}:"))
                states[role[0]] = min(states.get(role[0], new), new)
        return states

    states = insert(states)
    for _, role, text, fault in rows:
        new = {}

        def offer(state, value):
            new[state] = min(new.get(state, value), value)

        extra = 3 if fault == "truncated" else 0
        for state, (cost, audit, said) in states.items():
            offer(state, (cost + 4, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
            if role[:1] and role[:1] in allowed:
                offer(role[:1], (cost + extra, audit + "K", (*said, f"{role}:{text}")))
            for other in ("user", "assistant"):
                if other[0] in allowed:
                    offer(other[0], (cost + 3 + extra, audit + "R", (*said, f"{other}:{text}")))
        states = insert(new)
    return min(states[s] for s in ("", "a") if s in states)


def told(rows):
    """What a report says about one conversation."""
    judged = faults(rows)
    turns = [t for t, *_ in judged if t is not None]
    cost, audit, said = cheapest(judged)
    many = Counter(f for *_, f in judged)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(judged, judged[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, many["blank"], many["duplicate"], many["truncated"],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def conversations_of(seed, many):
    draw = random.Random(seed)
    rows = []
    for conv in range(many):
        for turn in range(draw.randint(1, 9)):
            rows.append((conv, draw.choice([turn, turn, turn, None, 2]), draw.choice(["user", "assistant", "system", "tool", "user", None, ""]),
                         draw.choice(["a.", "b!", "c", " \t", "", None, "d.\n", "e?", "long " * 50 + "."])))
    return rows


def test_repairs_equal_brute_force(spark):
    rows = conversations_of(3, 150) + [(None, 0, "assistant", "lost."), (None, 5, "user", "found."), (None, 5, "user", "found.")]
    found = {r.conv_id: tuple(r)[1:] for r in conversations.report(conversations.repair(talk(spark, rows))).collect()}
    by_conv = {}
    for conv, *rest in rows:
        by_conv.setdefault(conv, []).append(tuple(rest))
    assert found == {conv: told(mine) for conv, mine in by_conv.items()}


def test_edits_carry_texts_and_costs(spark):
    rows = [(1, 0, "assistant", "Yes."), (1, 1, "user", "no"), (1, 2, "user", "No.")]
    edits = conversations.repair(talk(spark, rows)).orderBy("step").collect()
    assert "".join(e.edit for e in edits) == told([r[1:] for r in rows])[6]
    assert sum(e.cost for e in edits) == told([r[1:] for r in rows])[5]
    kept = [bytes(e.role) for e in edits if e.role is not None]
    assert [r[:1] for r in kept] == [b"u", b"a"] * (len(kept) // 2)
    assert [bytes(e.text).decode() for e in edits if e.turn is not None] == ["Yes.", "no", "No."]


@pytest.mark.parametrize("pattern", ["ua", "u", "a", "uua", "s", "ssua", "t"])
def test_long_conversations_are_decided_on_the_way(pattern):
    """What is held stays small where the pattern lets it, and branches tied for thousands of rows are compared whole."""
    names = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
    draw = random.Random(1)
    rows = [(i, names[pattern[i % len(pattern)]], draw.choice(["x.", "y"]) + str(i) + draw.choice([".", ""]), None) for i in range(1501)]
    rows = [(t, r, x, None if x.endswith(".") else "truncated") for t, r, x, _ in rows]
    search, got, most = conversations.Survivors(), [], 0
    for turn, role, text, fault in rows:
        got += search.add(role[:1].encode(), False, fault == "truncated", (turn, role, text))
        most = max(most, search.undecided())
    got += search.close()
    cost, audit, said = cheapest(rows)
    assert (search.cost, "".join(e for e, *_ in got)) == (cost, audit)
    assert most <= 12 or pattern not in ("ua", "uua", "ssua")


def test_damage_and_conversations_without_rows(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {t}. So!") for c in range(240) for t in range(1 + c % 4)] + [(None, None, None, None)]
    found = {r.conv_id: tuple(r)[1:] for r in conversations.audit_damaged(talk(spark, rows)).collect()}
    want = {}
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        mine = want.setdefault(conv, [])
        if kind:
            row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            mine += [row] * (2 if kind == 3 else 1)
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert any(not v for v in want.values())
    assert found == {c: told(mine) if mine else none for c, mine in want.items()}
    assert conversations.audit_damaged(talk(spark, [])).collect() == []


def test_registered_repairs(spark, sf):
    given = queries.table(spark, sf, "conversations")
    found = queries.QUERIES["op11_conversation_repair"](spark, sf)
    assert found.count() == given.select("conv_id").distinct().count()
    assert found.filter("not audit rlike '^[DIKR]*$'").count() == 0


@pytest.fixture(scope="module")
def coders():
    plain = Tokenizer.from_file(A)
    plain.encode_special_tokens = True
    return plain, sentencepiece.SentencePieceProcessor(model_file=B)


def spelt(coders, text):
    """Ids and bytes of both sides, by reading the two files' own entries."""
    plain, pieces = coders
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    a = plain.encode(" " + text, add_special_tokens=False)
    b = pieces.encode(text)
    return ([(i, bytes(byte_of[c] for c in t)) for i, t in zip(a.ids, a.tokens)],
            [(i, bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()) for i in b])


def aligned(coders, text):
    """(a tokens, b tokens, links, groups as text), byte by byte; None for a text without tokens."""
    if not text:
        return None
    a, b = spelt(coders, text)
    if any(b"".join(t for _, t in side) != b" " + text.encode() for side in (a, b)):
        return None
    of = [[i for i, (_, t) in enumerate(side) for _ in t] for side in (a, b)]
    links = sorted(set(zip(*of)))
    groups, ends = [], [{sum(len(t) for _, t in side[:i + 1]) for i in range(len(side))} for side in (a, b)]
    start = 0
    for cut in sorted(ends[0] & ends[1]):
        groups.append("|".join(",".join(str(side[i][0]) for i in sorted(set(o[start:cut]))) for side, o in zip((a, b), of)))
        start = cut
    return a, b, links, ";".join(groups)


TEXTS = ["", None, " ", "plain words here", "  two  blanks\n\tand tabs ", "naïve café — «ſß»", "日本語とかな", "▁ piece mark", "<s> </s> <|endoftext|> <0x41>",
         "emoji 👩‍👩‍👧 ok", "a\u0000b", "ﬁ é é", "x" * 700, "word " * 900, "plain words here", "ÀÉ öäü 12345 67.89 !!??", "a", "\n"]


def agreed(coders, rows):
    found = [aligned(coders, t) for _, t in rows]
    pairs = [[(f[0][i][0], f[1][j][0]) for i, j in f[2]] if f else [] for f in found]
    held = Counter(p for own in pairs for p in set(own))
    best = Counter()
    for (a, _), many in held.items():
        best[a] = max(best[a], many)
    return [(key, *((len(f[0]), len(f[1]), f[3].count(";") + 1, len(own), sum(held[p] == best[p[0]] for p in own), sum(held[p] for p in own),
                     hashlib.sha256(f[3].encode()).hexdigest()) if f else (0, 0, 0, 0, 0, 0, ""))) for (key, _), f, own in zip(rows, found, pairs)]


@pytest.mark.parametrize(("run", "size"), [(alignment.RUN_TOKENS, alignment.BATCH_BYTES), (3, 40)])
def test_agreement_equals_brute_force(spark, coders, monkeypatch, run, size):
    monkeypatch.setattr(alignment, "RUN_TOKENS", run)
    monkeypatch.setattr(alignment, "BATCH_BYTES", size)
    rows = [*enumerate(TEXTS), (None, "no id"), (3, "plain words here")]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_a int, pair string").repartition(3)
    key = lambda r: (r[0] is None, *(str(v) for v in r))
    found = sorted((tuple(r) for r in alignment.agreement(table, A, B).collect()), key=key)
    assert found == sorted(agreed(coders, rows), key=key)
    assert alignment.agreement(table.limit(0), A, B).collect() == []


def test_links_and_cuts_of_a_text(spark, coders):
    texts = [t for t in TEXTS if t and len(t) < 100]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in alignment.align(table, A, B).collect():
        want = aligned(coders, texts[row.doc_id])
        if want is None:
            assert (row.a_ids, row.b_ids, row.links, row.cuts) == ([], [], [], [])
            continue
        a, b, links, groups = want
        assert (row.a_ids, row.b_ids) == ([i for i, _ in a], [i for i, _ in b])
        assert [tuple(x) for x in row.links] == links
        assert row.a_ends == list(np.cumsum([len(t) for _, t in a])) and row.cuts == sorted(set(row.a_ends) & set(row.b_ends))
        assert len(row.cuts) == groups.count(";") + 1


def test_registered_alignment(spark, sf, coders):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf, "documents").select("doc_id", "text").collect()]
    found = sorted(tuple(r) for r in queries.QUERIES["op12_tokenizer_alignment"](spark, sf).collect())
    assert found == sorted(agreed(coders, rows))


def toxic_corpus(seed=4, many=900):
    """Texts of which a tenth hold coined insults; a twentieth of the labels are wrong, and half the texts have none."""
    draw = random.Random(seed)
    insults = ["grumbolt", "snarfle", "vexlump", "trash", "idiot"]
    rows, labels, truth = [], [], {}
    for key in range(many):
        words = ["".join(draw.choice("abcdelmnorst") for _ in range(draw.randint(2, 5))) for _ in range(draw.randint(20, 90))]
        bad = draw.random() < 0.15
        for _ in range(draw.randint(2, 4) if bad else 0):
            words.insert(draw.randrange(len(words)), draw.choice(insults))
        rows.append((key, " ".join(words)))
        truth[key] = int(bad)
        if draw.random() < 0.5:
            labels.append((key, int(bad) ^ (draw.random() < 0.03)))
    return rows, labels, truth


def test_toxic_texts_held_out(spark):
    rows, labels, truth = toxic_corpus()
    out = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 == 1}
    docs = spark.createDataFrame([(k, t, 0.5) for k, t in rows], "doc_id long, text string, score double")
    learning = spark.createDataFrame([r for r in labels if r[0] not in out], "doc_id long, toxic int")
    model = toxicity.learn(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1), learning)
    assert {"grumbolt", "snarfle", "vexlump"} <= {v.name for v in model.voters}
    judged = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    wrong = [k for k in out if judged[k].predicted != truth[k]]
    assert len(out) > 200 and len(wrong) <= 0.01 * len(out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in judged.values())


def test_odd_rows_and_nothing_to_learn_from(spark):
    table = [(1, None), (2, ""), (2, ""), (None, "You idiot, worthless trash!"), (3, "fine words " * 20_000), (4, "fine words"), (5, "Idiot. Worthless trash, you loser!")]
    docs = spark.createDataFrame([(k, t, "x", 1.0) for k, t in table], "doc_id long, text string, words string, votes double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(4, 0), (None, 1), (3, None)], "doc_id long, toxic int")):
        model = toxicity.learn(docs, labels)
        found = toxicity.score(docs, model).collect()
        assert sorted((str(r.doc_id) for r in found)) == sorted(str(k) for k, _ in table)
        assert all(r.score is not None and 0 <= r.score <= 1 for r in found)
        assert toxicity.score(docs.limit(0), model).collect() == []
    assert toxicity.learn(docs.limit(0), none).classifier is None
    lexicons = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.learn(docs, none)).collect()}
    assert lexicons[5] == 1 and lexicons[4] == 0


def test_label_model_equals_enumeration(spark):
    """Chances of classes and expected counts against sums written out row by row."""
    draw = np.random.default_rng(2)
    voters, classes = 5, 3
    model = toxicity.LabelModel(np.array([0.6, 0.3, 0.1]), np.array([-1, 0, 0, 2, -1]), draw.uniform(0.05, 0.95, (classes, 2, voters)), np.array([0.02, 0.9, 0.8]))
    rows = [(int(b), int(g), int(m)) for b, g, m in zip(draw.integers(0, 32, 40), draw.integers(-1, 2, 40), draw.integers(1, 9, 40))]
    whole, pairs, gold = np.zeros(classes), np.zeros((classes, voters, voters)), np.zeros((classes, 2))
    for bits, label, many in rows:
        votes = [bits >> v & 1 for v in range(voters)]
        chance = []
        for y in range(classes):
            p = model.prior[y] * (1 if label < 0 else model.gold[y] if label else 1 - model.gold[y])
            for v in range(voters):
                up = model.parent[v]
                q = model.table[y, votes[up] if up >= 0 else 0, v]
                p *= q if votes[v] else 1 - q
            chance.append(p)
        for y in range(classes):
            share = many * chance[y] / sum(chance)
            whole[y] += share
            pairs[y] += share * np.outer(votes, votes)
            if label >= 0:
                gold[y, label] += share
    table = spark.createDataFrame(rows, "bits long, gold long, many long").repartition(3)
    for got, want in zip(toxicity.expected_counts(table, model), (whole, pairs, gold)):
        np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)


def test_forest_follows_dependence():
    draw = np.random.default_rng(6)
    a, b = draw.random((2, 4000)) < 0.5
    votes = np.stack([a, a ^ (draw.random(4000) < 0.1), b, draw.random(4000) < 0.5], axis=1).astype(float)
    pairs = np.stack([votes.T @ votes, np.zeros((4, 4))])
    parent = toxicity._forest(pairs, np.array([4000.0, 0.0]))
    assert parent.tolist() == [-1, 0, -1, -1]


def test_registered_toxicity(spark, sf):
    rows = queries.QUERIES["op13_toxicity"](spark, sf).collect()
    text = {r.doc_id: r.text for r in queries.table(spark, sf, "documents").collect()}
    assert len(rows) == len(text)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
