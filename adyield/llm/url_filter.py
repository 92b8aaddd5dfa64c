"""URL filter: rules on host and path, and for other pages naive Bayes over the words that host and path are made of.

Names such as ``freecasinobonus`` are split into words by Viterbi over unigram probabilities, which are counted in the visible text
of the pages themselves. The classifier is multinomial naive Bayes on those words. It learns from all pages: a page counts as
blocked if one of its words is a seed word, and words that keep such company are blocked with them. Words are hashed into a fixed
number of features, so the model has the same size whatever the crawl's.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adyield.llm.common import pick
from adyield.operators.joins import join_spreading_hot_keys
from adyield.session import checkpointed

SEEDS = ("ads", "adult", "banner", "bet", "betting", "bonus", "casino", "clickbait", "escort", "gamble", "gambling", "jackpot",
         "malware", "phishing", "pills", "poker", "popup", "porn", "promo", "sex", "slots", "spam", "track", "tracker", "tracking",
         "viagra", "warez", "win", "xxx")
FEATURES = 1 << 14
#: Added to every count of a feature in a class.
SMOOTHING = 0.01
#: A seed word is taken to make up at least this share of all words, so that names can be split at it.
SEED_SHARE = 1e-4
#: Rules are tried on every page; longer lists belong into a join.
MAX_RULES = 10_000
#: A name on more pages than this, or than a thousandth of all names, is joined in several parts: a thousand such names at most.
HOT_ROWS = 1_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: from the first ``://`` to the next slash, question mark, hash sign or the end, with A-Z in lower case. Path: from
    there to the next question mark, hash sign or the end. Both are empty for null and without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, group), F.lit("")) for group in (1, 2))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest of ``rules`` (verdict, host and path such as ``example.org/en/``) that fits, as a struct, or null.

    A rule fits its host and all subdomains if the path begins with the rule's. Of two equal rules the blocking one holds.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    fits = []
    for verdict, rule in sorted(set(rules), key=lambda r: (-len(r[1]), r[1], r[0] != "block")):
        name, _, rest = rule.partition("/")
        fits.append(F.when(((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}"),
                           F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule: string, verdict: string>")


def word_counts(texts: DataFrame, text_col: str, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """(word, many) of the words of letters in the visible text of HTML pages, in lower case, and of the seed words."""
    shown = F.regexp_replace(F.lower(F.col(text_col)), r"(?s)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    words = texts.select(F.explode(F.regexp_extract_all(shown, F.lit(r"\p{L}{2,}"), F.lit(0))).alias("word")) \
        .groupBy("word").agg(F.count("*").alias("many"))
    wanted = texts.sparkSession.createDataFrame([(w,) for w in seeds], "word string").withColumn("many", F.lit(0).cast("long"))
    return words.union(wanted).groupBy("word").agg(F.sum("many").alias("many"))


def split_names(names: DataFrame, counts: DataFrame, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """Words of each distinct name: (name, words). Every part of a name is looked up by a join, so no vocabulary is sent whole.

    The best split has the highest product of word probabilities; an unknown word of n letters has 10 / (N * 10^n) of the N words
    counted. Equal splits go to the one with the longer last word. Words may have any length: parts are cut in the lengths that
    counted words have, and the best unknown word before a place is carried along.
    """
    total = max(1, counts.agg(F.sum("many")).first()[0] or 0)
    lengths = sorted(row[0] for row in counts.select(F.length("word")).distinct().collect())
    starts = F.explode(F.sequence(F.lit(1), F.length("name"))).alias("start")
    parts = names.select("name", starts)
    fitting = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda size: size <= F.length("name") - F.col("start") + 1)
    parts = parts.select("name", "start", F.explode(fitting).alias("size"))
    parts = parts.select("name", "start", "size", F.substring("name", F.col("start"), F.col("size")).alias("word"))
    known = parts.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("start", "size", "word", "many")).alias("known"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, found in zip(batch.column("name").to_pylist(), batch.column("known").to_pylist()):
                ends: dict[int, list[tuple[int, float]]] = {}
                for part in found or ():
                    many = max(part["many"], total * SEED_SHARE) if part["word"] in seeds else part["many"]
                    if many:
                        ends.setdefault(part["start"] - 1 + part["size"], []).append((part["size"], math.log(many / total)))
                best = [0.0] + [-math.inf] * len(name)
                last = [0] * (len(name) + 1)
                # the best start of an unknown word; a known one is never less likely than an unknown one of its length
                lead, lead_from = -math.inf, 0
                for end in range(1, len(name) + 1):
                    if best[end - 1] + (end - 1) * math.log(10) > lead + 1e-9:
                        lead, lead_from = best[end - 1] + (end - 1) * math.log(10), end - 1
                    best[end], last[end] = lead + math.log(10 / total) - end * math.log(10), end - lead_from
                    for size, own in sorted(ends.get(end, ()), reverse=True):
                        value = best[end - size] + own
                        if value > best[end] or (value == best[end] and size > last[end]):
                            best[end], last[end] = value, size
                words, end = [], len(name)
                while end:
                    words.append(name[end - last[end]:end])
                    end -= last[end]
                out.append(words[::-1])
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(out, pa.list_(pa.string()))], names=["name", "words"])

    return names.join(known, "name", "left").select("name", "known").mapInArrow(split, "name string, words array<string>")


def _model(words: DataFrame) -> tuple[float, np.ndarray]:
    """Log odds of block for a page without words, and what each feature adds."""
    pages = {row[0]: row[1] for row in words.groupBy("seeded").count().collect()}
    counts = np.full((2, FEATURES), SMOOTHING)
    for seeded, feature, many in words.select("seeded", F.explode("features").alias("feature")) \
            .groupBy("seeded", "feature").count().collect():
        counts[int(seeded), feature] += many
    logs = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    return math.log((pages.get(True, 0) + 1) / (pages.get(False, 0) + 1)), logs[1] - logs[0]


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
          seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """Judge every page's URL: ``id_col``, host, path, rule (null if none fits), verdict, score and words.

    verdict is allow or block: the rule's, else block if score, the log odds of naive Bayes, is above 0. words are those of host
    and path, in order. A null URL and one without ``://`` have an empty host and path and no words, and are judged by the share of
    blocked pages alone. A null page text adds no word counts. Repeated rows and rows without an id are judged each for
    itself. An empty table gives an empty result. Other columns may have any name.
    """
    rows = pick(pages, id=id_col, url=url_col, text=text_col)
    host, path = host_and_path(F.col("url"))
    parsed = rows.select(F.monotonically_increasing_id().alias("row"), "id", host.alias("host"), path.alias("path"))
    parsed = checkpointed(parsed.withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules)))
    runs = F.regexp_extract_all(F.lower(F.concat_ws(" ", "host", "path")), F.lit(r"\p{L}+"), F.lit(0))
    # the places of a name on one page go together
    places = parsed.select("row", F.posexplode(runs).alias("place", "name")).groupBy("row", "name") \
        .agg(F.collect_list("place").alias("places"))
    places = checkpointed(places)
    names = checkpointed(places.groupBy("name").agg(F.count("*").alias("n_rows")))
    counts = checkpointed(word_counts(rows, "text", seeds))
    split = split_names(names.select("name"), counts, seeds).join(names, "name")
    hot = max(HOT_ROWS, (names.agg(F.sum("n_rows")).first()[0] or 0) // 1_000)
    named = join_spreading_hot_keys(places, split, "name", "n_rows", hot)
    ordered = F.sort_array(F.flatten(F.collect_list(F.transform("places", lambda p: F.struct(p.alias("place"), F.col("words").alias("words"))))))
    words = named.groupBy("row").agg(F.flatten(F.transform(ordered, lambda x: x["words"])).alias("words"))
    words = parsed.join(words, "row", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    features = F.transform("words", lambda w: F.pmod(F.xxhash64(w), F.lit(FEATURES)).cast("int"))
    seeded = F.exists("words", lambda w: w.isin(*seeds))
    words = checkpointed(words.withColumns({"features": features, "seeded": seeded}))
    start, weights = _model(words)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("features")
            sums = np.concatenate([[0.0], np.cumsum(weights[own.flatten().to_numpy()])])
            ends = np.cumsum(np.concatenate([[0], [len(x) for x in own]])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("id", "host", "path", "rule", "ruled", "words")],
                                              pa.array(start + sums[ends[1:]] - sums[ends[:-1]])],
                                             names=["id", "host", "path", "rule", "ruled", "words", "score"])

    id_type = rows.schema["id"].dataType.simpleString()
    scored = words.select("id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled"), "words", "features") \
        .mapInArrow(score, f"id {id_type}, host string, path string, rule string, ruled string, words array<string>, score double")
    own = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score", "words")
