"""Language identification by rank-order profiles of character n-grams.

A profile lists a language's most frequent n-grams by rank. A text is ranked the same way, and its distance to a profile is
the sum, over the text's own most frequent n-grams, of how far each stands out of its place; an n-gram that the profile lacks
counts as ``size`` places.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adyield.llm.common import pick, text_slices

SIZE = 300
ORDERS = (1, 2, 3)
#: Characters that one vectorised step works on; a longer text is a step of its own.
SLICE_BYTES = 1 << 17

UNKNOWN = "und"

#: Labelled documents of a language and length whose scores lie below the rest, as a share of all.
LOW_QUANTILE = 0.01
#: A text may score so much of that quantile's score before it is in none of the languages.
LEAST_SHARE = 0.8
#: A length with fewer labelled documents than this does not raise the language's own limit.
LEAST_DOCUMENTS = 20
#: Score steps that the labelled documents are counted in.
STEPS = 200
#: Powers of two of letters that a text can have.
SIZES = 32


def _letters(points: np.ndarray) -> np.ndarray:
    """The lower-case letter of each code point, a blank for anything that is not a letter."""
    table = np.full(int(points.max(initial=0)) + 1, 32, np.uint32)
    for point in np.flatnonzero(np.bincount(points)):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table[points]


def _normal(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts end to end, each text between blanks and with runs of other characters as one blank, and the
    number of the text that each character belongs to."""
    rows = ["" if t is None else t for t in texts.to_pylist()]
    points = np.frombuffer(" ".join(["", *rows, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(rows)), [len(t) + 1 for t in rows])
    owner = np.concatenate([owner, [len(rows) - 1 if rows else 0]])
    chars = _letters(points)
    blank = chars == 32
    keep = np.ones(len(chars), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return chars[keep], owner[keep]


def _ranked(chars: np.ndarray, owner: np.ndarray, size: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """N-grams of each owner with their counts and ranks, most frequent first, ties by n-gram; only the first ``size``."""
    alphabet, code = np.unique(chars, return_inverse=True)
    code = code.astype(np.uint64) + np.uint64(1)
    width = int(len(alphabet)).bit_length()
    grams, owners = [], []
    for order in ORDERS:
        n = len(code) - order + 1
        if n <= 0:
            continue
        gram = np.zeros(n, np.uint64)
        for step in range(order):
            gram = (gram << np.uint64(width)) | code[step:step + n]
        # no n-gram holds a blank between letters, so none spans two texts; it belongs to the text of its letters
        if order == 1:
            fits, of = chars != 32, owner
        elif order == 2:
            opening = chars[:-1] == 32
            fits, of = ~opening | (chars[1:] != 32), np.where(opening, owner[1:], owner[:-1])
        else:
            fits, of = chars[1:-1] != 32, owner[1:-1]
        grams.append(gram[fits])
        owners.append(of[fits])
    if not grams:
        grams, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    gram, who = np.concatenate(grams), np.concatenate(owners).astype(np.uint64)
    bits = width * max(ORDERS)
    if bits + int(who.max(initial=0)).bit_length() <= 64:
        key, count = np.unique((who << np.uint64(bits)) | gram, return_counts=True)
        who, gram = (key >> np.uint64(bits)).astype(np.int64), key & np.uint64((1 << bits) - 1)
    else:
        both, count = np.unique(np.stack([who, gram]), axis=1, return_counts=True)
        who, gram = both[0].astype(np.int64), both[1]
    points = np.zeros((len(gram), max(ORDERS)), np.uint64)
    for step in range(max(ORDERS)):
        place = (gram >> np.uint64(width * step)) & np.uint64((1 << width) - 1)
        points[:, -1 - step] = np.where(place > 0, alphabet[np.maximum(place, np.uint64(1)).astype(np.int64) - 1], 0)
    name = (points[:, 0] << np.uint64(42)) | (points[:, 1] << np.uint64(21)) | points[:, 2]
    order = np.lexsort((name, -count, who))
    who, name, count = who[order], name[order], count[order]
    first = np.searchsorted(who, np.arange(int(who.max(initial=-1)) + 2))
    rank = np.arange(len(who)) - first[who]
    if size is not None:
        use = rank < size
        who, name, count, rank = who[use], name[use], count[use], rank[use]
    return who, name.astype(np.int64), count, rank


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = SIZE) -> DataFrame:
    """The ``size`` most frequent n-grams of each language over all its texts: (lang, gram, rank from 0).

    Rows without text or language teach nothing. An n-gram is three code points of 21 bits in one number; letters are in lower
    case, and whatever is no letter is a blank between words. Counts are summed per batch before they are shuffled; what one
    window then ranks is a language's distinct n-grams, not its texts.
    """
    rows = pick(docs, text=text_col, lang=lang_col).filter("text is not null and lang is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, "text", SLICE_BYTES):
                langs = piece.column("lang").dictionary_encode()
                owner_of = langs.indices.to_numpy()
                chars, owner = _normal(piece.column("text"))
                who, name, count, _ = _ranked(chars, owner_of[owner], None)
                yield pa.RecordBatch.from_pydict({
                    "lang": langs.dictionary.take(pa.array(who)), "gram": pa.array(name), "count": pa.array(count.astype(np.int64))})

    counts = rows.mapInArrow(count, "lang string, gram long, count long").groupBy("lang", "gram").agg(F.sum("count").alias("count"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "gram"))
    return counts.withColumn("rank", place - 1).filter(F.col("rank") < size).select("lang", "gram", "rank")


def identify(docs: DataFrame, profiles: list[tuple[str, int, int]], id_col: str = "doc_id", text_col: str = "text",
             keep: tuple[str, ...] = (), size: int = SIZE, letters: bool = False) -> DataFrame:
    """Name the language of every whole text: ``id_col``, the columns in ``keep``, lang_pred, score and with ``letters`` n_letters.

    ``profiles`` are rows of ``learn_profiles``: ``size`` rows for each language, which bounds what is sent to executors.
    score is 1 less the distance's share of the greatest possible one: 1 for a text ranked as its profile, 0 where no n-gram
    is known. A null text, an empty one and one without a letter are ``und`` with score 0, and so is every text if no profile
    was learned. Equal distances go to the language that sorts first. Repeated rows are judged alike; other columns may have
    any name.
    """
    column = {c: "text" if c == text_col else f"keep_{i}" for i, c in enumerate(keep)}  # a text that is kept is sent once
    rows = pick(docs, id=id_col, text=text_col, **{name: c for c, name in column.items() if name != "text"})
    langs = sorted({row[0] for row in profiles})
    grams = np.array(sorted({row[1] for row in profiles}), np.int64)
    ranks = np.full((len(langs), len(grams)), -1, np.int64)
    for lang, gram, rank in profiles:
        ranks[langs.index(lang), np.searchsorted(grams, gram)] = rank

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, "text", SLICE_BYTES):
                chars, owner = _normal(piece.column("text"))
                who, name, _, rank = _ranked(chars, owner, size)
                shown = np.bincount(who, minlength=len(piece))
                distance = np.zeros((len(langs), len(piece)))
                at = np.minimum(np.searchsorted(grams, name), max(len(grams) - 1, 0))
                for place in range(len(langs)):
                    there = np.where(grams[at] == name, ranks[place, at], -1)
                    out = np.where(there < 0, size, np.abs(there - rank))
                    distance[place] = np.bincount(who, weights=out, minlength=len(piece))
                best = distance.argmin(axis=0) if langs else np.zeros(len(piece), np.int64)
                known = (shown > 0) & bool(langs)
                least = distance.min(axis=0) if langs else np.zeros(len(piece))
                score = np.where(known, 1 - least / np.maximum(shown * size, 1), 0.0)
                yield pa.RecordBatch.from_pydict({
                    "id": piece.column("id"), **{f"keep_{i}": piece.column(column[c]) for i, c in enumerate(keep)},
                    "lang_pred": pa.array([langs[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                    "score": pa.array(score, pa.float64()),
                    **({"n_letters": pa.array(np.bincount(owner[chars != 32], minlength=len(piece)))} if letters else {})})

    kept = {"id": "id"} | {f"keep_{i}": column[c] for i, c in enumerate(keep)}
    schema = ", ".join([f"{c} {rows.schema[name].dataType.simpleString()}" for c, name in kept.items()]
                       + ["lang_pred string", "score double"] + ["n_letters long"] * letters)
    return rows.mapInArrow(judge, schema).toDF(id_col, *keep, "lang_pred", "score", *["n_letters"] * letters)


def size_class(n_letters: Column) -> Column:
    """Texts of about the same length: the power of two below their number of letters."""
    return F.floor(F.log2(F.greatest(n_letters, F.lit(1)))).cast("int")


def least_scores(judged: DataFrame, lang_col: str = "lang") -> list[tuple[str, int, float]]:
    """(language, size class, least score) for every length, learned from all labelled texts that are named as labelled.

    ``judged`` has lang_pred, score and n_letters of ``identify`` beside the label. The least score is ``LEAST_SHARE`` of the
    score at ``LOW_QUANTILE`` among a language's texts of that length. With fewer than ``LEAST_DOCUMENTS`` of them it is the
    smaller of that and the one over all lengths. What is collected are counts by language, size class and step of score.
    """
    counts = judged.filter(F.col(lang_col) == F.col("lang_pred")).groupBy(
        "lang_pred", size_class(F.col("n_letters")).alias("size"), F.floor(F.col("score") * STEPS).alias("step")).count().collect()
    steps: dict[tuple[str, int | None], Counter] = defaultdict(Counter)
    for lang, size, step, count in counts:
        steps[lang, size][step] += count
        steps[lang, None][step] += count

    def least(of: Counter) -> float:
        under = 0
        for step in sorted(of):
            under += of[step]
            if under > LOW_QUANTILE * of.total():
                return LEAST_SHARE * step / STEPS
        return 0.0

    rows = []
    for lang in sorted({lang for lang, _ in steps}):
        usual = least(steps[lang, None])
        for size in range(SIZES):
            here = steps.get((lang, size), Counter())
            own = least(here) if here else usual
            rows.append((lang, size, own if here.total() >= LEAST_DOCUMENTS else min(own, usual)))
    return rows
