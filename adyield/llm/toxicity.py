"""Toxicity scores by weak supervision.

Many voters look at a text: lexicons of insults, patterns of shouting and address, and words and beginnings of words that the labelled
documents single out. None of them is trusted, nor are the labels. A generative model of the votes, fitted by expectation maximisation, estimates how
often each voter speaks up in clean texts and in those toxic in one of several ways, and which voters repeat one another (a forest of dependences, by mutual
information given the class); the label is one more voter with an error rate of its own. The posteriors of that model are the targets of a
logistic regression on votes and hashed words, which is what scores a text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adyield.llm.common import checkpointed_in, pick
from adyield.session import checkpointed

# Common insults by what they are about, and by language.
LEXICONS = {
    "wits": ["idiot", "idiots", "idiotic", "moron", "morons", "moronic", "stupid", "dumb", "imbecile", "cretin", "dimwit", "halfwit", "fool"],
    "worth": ["worthless", "pathetic", "loser", "losers", "useless", "failure", "nobody", "reject"],
    "filth": ["disgusting", "trash", "scum", "garbage", "filth", "filthy", "vermin", "vile", "revolting", "repulsive"],
    "ridicule": ["clown", "clowns", "joke", "laughable", "ridiculous", "buffoon"],
    "hate": ["hate", "despise", "kill", "destroy"],
    "german": ["idiot", "dummkopf", "trottel", "abschaum", "widerlich", "wertlos", "versager", "dumm"],
    "french": ["idiot", "imbécile", "crétin", "ordure", "dégoûtant", "minable", "stupide"],
    "spanish": ["idiota", "imbécil", "estúpido", "estúpida", "basura", "asqueroso", "patético", "escoria"],
}
PATTERNS = {
    "shouts": r"!!",
    "capitals": r"(?:\p{Lu}{3,}[^\p{L}]+){3}",
    "address": r"(?i)\byou(?:'re| are)\b",
    "drawn out": r"(\p{L})\1{3}",
    "masked": r"\p{L}[*#@$]{2,}",
}
LEARNED_WORDS = 32
LEARNED_STEMS = 12
LEAST_SUPPORT = 5
#: A stem is so many first letters; it is said often where one word in so many begins with it.
STEM_LETTERS = 4
OFTEN = 200
EDGE_BITS = 0.01
#: Labels are taken to call a clean text toxic this often at most, and a toxic one toxic this often at least.
LABEL_SLIPS = 0.005
LABEL_FINDS = 0.8
ROUNDS = 12
#: Voters this correlated within toxic texts belong to one way to be toxic; so many ways at most.
TOGETHER = 0.15
WAYS = 6
FEATURES = 1 << 14
#: Bound on the labelled documents that the classifier is fitted on; everything else is counted over all of them.
SAMPLE = 8_000
PENALTY = 1e-5
THRESHOLD = 0.7


class Voter(NamedTuple):
    """Speaks up where a text has any of some words, matches a pattern, or often begins words with a stem."""

    name: str
    kind: str
    terms: list[str]


class LabelModel(NamedTuple):
    """How votes come about: a text is clean (class 0) or toxic in one of several ways (the classes after it).

    ``table[class, parent's vote, voter]`` is the chance that a voter speaks up, by class and by the vote of its parent in the forest of
    dependences (-1 for none); ``gold`` is the chance that the label says toxic.
    """

    prior: np.ndarray
    parent: np.ndarray
    table: np.ndarray
    gold: np.ndarray

    def classes(self, votes: np.ndarray, gold: np.ndarray) -> np.ndarray:
        """Chance of each class, given votes (rows x voters of 0 and 1) and labels (1, 0 or -1 for none)."""
        above = np.where(self.parent >= 0, votes[:, self.parent], 0)
        total = np.empty((len(votes), len(self.prior)))
        for y, prior in enumerate(self.prior):
            chance = np.where(above == 1, self.table[y, 1], self.table[y, 0])
            total[:, y] = np.log(prior) + np.log(np.where(votes == 1, chance, 1 - chance)).sum(axis=1)
            total[:, y] += np.where(gold < 0, 0.0, np.log(np.where(gold == 1, self.gold[y], 1 - self.gold[y])))
        total = np.exp(total - total.max(axis=1, keepdims=True))
        return total / total.sum(axis=1, keepdims=True)

    def posterior(self, votes: np.ndarray, gold: np.ndarray) -> np.ndarray:
        """Chance that a row is toxic in any way."""
        return np.clip(1 - self.classes(votes, gold)[:, 0], 0, 1)


class Model(NamedTuple):
    """Voters, the model of their votes, and the classifier, absent if there was nothing to fit it on."""

    voters: list[Voter]
    label_model: LabelModel
    classifier: Any


def words_of(text: Column) -> Column:
    """Words in lower case, in order: runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _beginning(word: Column) -> Column:
    """The stem of a word; a shorter word is equal to no stem."""
    return F.substring(word, 1, STEM_LETTERS)


def with_votes(docs: DataFrame, voters: list[Voter]) -> DataFrame:
    """(id, text) with words and votes, an array of 0.0 and 1.0 by voter."""
    def texts(values: list[str]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<string>")

    words = sorted({w for v in voters if v.kind == "words" for w in v.terms})
    stems = sorted({w for v in voters if v.kind == "stem" for w in v.terms})
    found = docs.withColumn("words", words_of(F.col("text"))).withColumn("hits", F.array_intersect("words", texts(words))) \
        .withColumn("stems", F.transform(F.filter("words", lambda w: _beginning(w).isin(stems)), _beginning))

    def vote(voter: Voter) -> Column:
        if voter.kind == "words":
            return F.arrays_overlap("hits", texts(voter.terms))
        if voter.kind == "stem":
            return F.size(F.filter("stems", lambda s: s == voter.terms[0])) * OFTEN >= F.greatest(F.size("words"), F.lit(1))
        return F.coalesce(F.col("text").rlike(voter.terms[0]), F.lit(False))

    return found.withColumn("votes", F.array(*[vote(v).cast("double") for v in voters])).drop("hits", "stems")


def representatives(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One labelled document for each label and least hash of three words in a row: (id, toxic). Copies mostly share that hash."""
    threes = F.transform("said", lambda w, i: F.xxhash64(w, F.get("said", i + 1), F.get("said", i + 2)))
    sketch = docs.filter("id is not null").withColumn("said", words_of(F.col("text"))).select("id", F.array_min(threes).alias("least"))
    return checkpointed(sketch.join(labels, "id").groupBy("least", "toxic").agg(F.min("id").alias("id")).select("id", "toxic").distinct())


def learned_terms(docs: DataFrame, labelled: DataFrame, words: int = LEARNED_WORDS, stems: int = LEARNED_STEMS) -> list[Voter]:
    """Voters of the words, and of the stems said often, that surely mark toxic documents: surest first, ties by the alphabet."""
    sizes = dict(labelled.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for toxic, said in zip(batch.column("toxic").to_pylist(), batch.column("words").to_pylist()):
                begin = Counter(w[:STEM_LETTERS] for w in said if len(w) >= STEM_LETTERS)
                seen.update(("words", w, toxic) for w in set(said))
                seen.update(("stem", w, toxic) for w, many in begin.items() if many * OFTEN >= len(said))
            kinds, terms, toxic = zip(*seen) if seen else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(terms, pa.string()), pa.array(toxic, pa.int64()),
                                              pa.array(list(seen.values()), pa.int64())], names=["kind", "term", "toxic", "many"])

    joined = docs.join(labelled, "id").select("toxic", words_of(F.col("text")).alias("words"))
    counts = joined.mapInArrow(count, "kind string, term string, toxic long, many long").groupBy("kind", "term").agg(
        F.sum(F.col("many") * F.col("toxic")).alias("a"), F.sum(F.col("many") * (1 - F.col("toxic"))).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (F.col("b") + 0.5) * (n_clean + 1.0) / (n_toxic + 1.0))
    sure = odds - 2.33 * F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    marked = checkpointed(counts.filter(f"a >= {LEAST_SUPPORT}").select("kind", "term", F.round(sure, 9).alias("sure")).filter("sure > 1"))
    return [Voter(row["term"] + ("-" if kind == "stem" else ""), kind, [row["term"]]) for kind, limit in (("words", words), ("stem", stems))
            for row in marked.filter(F.col("kind") == kind).orderBy(F.desc("sure"), "term").limit(limit).collect()]


def _matrix(bits: np.ndarray, voters: int) -> np.ndarray:
    return (bits[:, None] >> np.arange(voters) & 1).astype(np.int8)


def _forest(pairs: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Parent of each voter (-1 for none): heaviest edges by mutual information given the class, if above EDGE_BITS per row."""
    voters = pairs.shape[1]
    weight = np.zeros((voters, voters))
    for y in range(len(rows)):
        n = rows[y] + 2
        both = (pairs[y] + 0.5) / n
        one = (np.diag(pairs[y]) + 1) / n
        for i, j in ((1, 1), (1, 0), (0, 1), (0, 0)):
            p = one[:, None] if i else 1 - one[:, None]
            q = one[None] if j else 1 - one[None]
            cell = both if i and j else one[:, None] - both if i else one[None] - both if j else 1 - one[:, None] - one[None] + both
            cell = np.maximum(cell, 1e-12)
            weight += rows[y] / rows.sum() * cell * np.log2(cell / (p * q))
    parent = np.full(voters, -1)
    group = np.arange(voters)
    up, down = np.triu_indices(voters, 1)
    chosen: dict[int, list[int]] = {}
    for e in np.lexsort((down, up, -weight[up, down])):
        i, j = int(up[e]), int(down[e])
        if weight[i, j] < EDGE_BITS:
            break
        if group[i] != group[j]:
            group[group == group[j]] = group[i]
            chosen.setdefault(i, []).append(j)
            chosen.setdefault(j, []).append(i)
    seen: set[int] = set()
    for start in range(voters):
        stack = [start] if start not in seen else []
        while stack:
            node = stack.pop()
            seen.add(node)
            for other in chosen.get(node, []):
                if other not in seen:
                    parent[other] = node
                    stack.append(other)
    return parent


def _ways(pairs: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Groups of voters that speak up together in toxic texts, the commonest group first: each is a way to be toxic."""
    chance = [(np.diag(pairs[y]) + 0.5) / (rows[y] + 1) for y in (0, 1)]
    telling = (chance[1] > 3 * chance[0]) & (np.diag(pairs[1]) >= LEAST_SUPPORT)
    spread = np.sqrt(chance[1] * (1 - chance[1]))
    together = (pairs[1] / (rows[1] + 1) - np.outer(chance[1], chance[1])) / np.outer(spread, spread) > TOGETHER
    group = np.arange(len(spread))
    for i, j in np.argwhere(together & telling[:, None] & telling[None]):
        group[group == group[j]] = group[i]
    found = [np.flatnonzero((group == g) & telling) for g in np.unique(group[telling])]
    return sorted(found, key=lambda voters: (-chance[1][voters].max(), voters[0]))[:WAYS]


def _refitted(parent: np.ndarray, pairs: np.ndarray, rows: np.ndarray, gold: np.ndarray) -> LabelModel:
    voters = pairs.shape[1]
    table = np.empty((len(rows), 2, voters))
    for y in range(len(rows)):
        alone = np.diag(pairs[y])
        with_parent = np.where(parent >= 0, pairs[y][np.arange(voters), parent], 0)
        above = np.where(parent >= 0, alone[parent], 0)
        overall = (alone + 0.5) / (rows[y] + 1)
        # a chance given the parent's vote leans on the chance overall where the parent is rare
        table[y, 1] = np.where(parent >= 0, (with_parent + overall) / (above + 1), overall)
        table[y, 0] = np.where(parent >= 0, (alone - with_parent + overall) / (rows[y] - above + 1), overall)
    said = [(g[1] + 1) / (g.sum() + 2) for g in (gold[0], gold[1:].sum(axis=0))]
    slips, finds = np.clip(said[0], 1e-6, LABEL_SLIPS), np.clip(said[1], LABEL_FINDS, 1 - 1e-6)
    return LabelModel((rows + 1) / (rows.sum() + len(rows)), parent, np.clip(table, 1e-6, 1 - 1e-6),
                      np.array([slips] + [finds] * (len(rows) - 1)))


def expected_counts(patterns: DataFrame, model: LabelModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected rows by class, pairs of votes by class, and labels by class, over patterns (bits, gold, many)."""
    voters, classes = len(model.parent), len(model.prior)
    up, down = np.triu_indices(voters)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes, len(up) + 3))
        for batch in batches:
            votes = _matrix(batch.column("bits").to_numpy(), voters)
            gold = batch.column("gold").to_numpy()
            share = model.classes(votes, gold) * batch.column("many").to_numpy()[:, None]
            for y in range(classes):
                total[y, :len(up)] += ((votes * share[:, y:y + 1]).T @ votes.astype(float))[up, down]
                total[y, len(up):] += [share[:, y].sum(), share[gold == 0, y].sum(), share[gold == 1, y].sum()]
        y, place = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"y": pa.array(y), "place": pa.array(place), "value": pa.array(total[y, place])})

    whole = np.zeros((classes, len(up) + 3))
    for y, place, value in patterns.mapInArrow(sums, "y long, place long, value double").groupBy("y", "place").agg(F.sum("value")).collect():
        whole[y, place] = value
    pairs = np.zeros((classes, voters, voters))
    pairs[:, up, down] = pairs[:, down, up] = whole[:, :len(up)]
    return whole[:, len(up)], pairs, whole[:, len(up) + 1:]


def _first_guess(patterns: DataFrame, voters: list[Voter]) -> LabelModel:
    """Ways to be toxic and their votes as the labels alone tell them; where there are none, learned words and lexicons mean toxic."""
    alone = np.full(len(voters), -1)
    lead = {"words": (0.005, 0.1), "stem": (0.005, 0.1), "pattern": (0.1, 0.1)}
    table = np.array([[[lead[v.kind][y] for v in voters]] * 2 for y in (0, 1)])
    blind = LabelModel(np.array([0.5, 0.5]), alone, np.full((2, 2, len(voters)), 0.5), np.array([1e-9, 1 - 1e-9]))
    rows, pairs, gold = expected_counts(patterns.filter("gold >= 0"), blind)
    ways = _ways(pairs, rows) if rows.min() >= 1 else []
    if not ways:
        return LabelModel(np.array([0.9, 0.1]), alone, table, np.array([LABEL_SLIPS, 0.9]))
    told = _refitted(alone, pairs, rows, gold)
    tables = [told.table[0]]
    for group in ways:
        others = np.setdiff1d(np.concatenate(ways), group)
        way = told.table[1].copy()
        way[:, others] = np.sqrt(told.table[0][:, others] * told.table[1][:, others])
        way[:, group] = np.maximum(told.table[1][:, group], 0.4)
        tables.append(way)
    prior = np.array([told.prior[0]] + [told.prior[1] / len(ways)] * len(ways))
    return LabelModel(prior, alone, np.stack(tables), np.array([told.gold[0]] + [told.gold[1]] * len(ways)))


def fit_label_model(patterns: DataFrame, voters: list[Voter], rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over the distinct patterns of votes (bits, gold, many); dependences enter after a third of the rounds."""
    model = _first_guess(patterns, voters)
    for step in range(rounds):
        rows, pairs, gold = expected_counts(patterns, model)
        better = _refitted(_forest(pairs, rows) if step == rounds // 3 and rows.sum() else model.parent, pairs, rows, gold)
        settled = step > rounds // 3 and np.abs(better.table - model.table).max() < 1e-4
        model = better
        if settled:
            break
    return model


def _features(docs: DataFrame, voters: int) -> DataFrame:
    hashed = HashingTF(inputCol="words", outputCol="hashed", binary=True, numFeatures=FEATURES).transform(docs)
    even = Normalizer(inputCol="hashed", outputCol="even").transform(hashed).withColumn("said", array_to_vector("votes"))
    sized = VectorSizeHint(inputCol="said", size=voters).transform(even)
    return VectorAssembler(inputCols=["said", "even"], outputCol="features").transform(sized).drop("words", "hashed", "even", "said")


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return pick(docs, id=id_col, text=text_col)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
          label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learn voters, label model and classifier from documents and the labels (0 or 1) of some of them.

    Votes and words are counted over all given documents; documents that share label and least word hash count once where words
    are singled out. The classifier is fitted on at most about ``sample`` labelled documents, drawn by a hash of the id. Rows of labels
    without id or label are left out, the larger label of a repeated id holds. Without labelled documents there is no classifier, and
    the label model's own posterior scores.
    """
    rows = _plain(docs, id_col, text_col)
    gold = pick(labels, id=label_id_col, toxic=label_col).filter("id is not null and toxic is not null") \
        .groupBy("id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).filter("toxic in (0, 1)")
    labelled = representatives(rows, gold)
    found = learned_terms(rows, labelled)
    voters = [Voter(name, "words", words) for name, words in LEXICONS.items()]
    voters += [Voter(name, "pattern", [pattern]) for name, pattern in PATTERNS.items()] + found
    bits = F.aggregate(F.zip_with("votes", F.sequence(F.lit(0), F.lit(len(voters) - 1)), lambda v, i: F.when(v > 0, F.call_function(
        "shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda x, y: x.bitwiseOR(y))
    seen = with_votes(rows, voters).select("id", bits.alias("bits")).join(gold, "id", "left")
    patterns = seen.groupBy("bits", F.coalesce("toxic", F.lit(-1)).cast("long").alias("gold")).agg(F.count("*").alias("many"))
    patterns = checkpointed(patterns)
    patterns = checkpointed_in(patterns, patterns.count())
    label_model = fit_label_model(patterns, voters)
    many = labelled.count()
    if not many:
        return Model(voters, label_model, None)
    drawn = labelled.filter(F.pmod(F.xxhash64("id"), F.lit(many)) < sample).select("id", "toxic")
    chosen = with_votes(rows.join(F.broadcast(drawn), "id"), voters)
    soft = chosen.withColumn("p", _posterior(label_model)("votes", F.col("toxic").cast("long")))
    both = _features(soft, len(voters)).withColumn("side", F.explode(F.array(F.lit(0.0), F.lit(1.0)))) \
        .withColumn("weight", F.when(F.col("side") == 1, F.col("p")).otherwise(1 - F.col("p"))).select("features", "side", "weight")
    fit = LogisticRegression(featuresCol="features", labelCol="side", weightCol="weight", regParam=PENALTY, standardization=False, maxIter=100)
    return Model(voters, label_model, fit.fit(checkpointed(both)))


def _posterior(model: LabelModel):
    @F.pandas_udf("double")
    def chance(votes, gold):  # noqa: ANN001, ANN202
        import pandas as pd

        matrix = np.array(votes.tolist()).reshape(len(votes), -1).astype(np.int8)
        return pd.Series(model.posterior(matrix, gold.to_numpy()))

    return chance


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of whole texts, one row per row of ``docs``: ``id_col``, score (0 to 1), predicted (1 from THRESHOLD on) and voters, the names of
    the voters that spoke up.

    A null or empty text has no votes and no words and gets the score of such a text. Nothing but the text is looked at: repeated rows
    and rows without an id get scores like others. An empty table gives an empty result. Other columns may have any name.
    """
    judged = with_votes(_plain(docs, id_col, text_col), model.voters).drop("text")
    if model.classifier is None:
        scored = judged.withColumn("score", _posterior(model.label_model)("votes", F.lit(-1).cast("long")))
    else:
        scored = model.classifier.transform(_features(judged, len(model.voters))).withColumn("score", vector_to_array("probability")[1])
    names = F.array(*[F.lit(v.name) for v in model.voters])
    spoke = F.filter(F.zip_with(names, "votes", lambda n, v: F.when(v > 0, n)), lambda n: n.isNotNull())
    return scored.select(F.col("id").alias(id_col), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), spoke.alias("voters"))
