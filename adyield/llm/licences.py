"""Licence scan: whole texts and whole lines, in canonical form, looked up by digest among known licences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adyield.llm.common import pick
from adyield.llm.licence_texts import KNOWN, known_texts

#: Known texts up to this many are broadcast: 10,000 digests and names take about a megabyte.
BROADCAST_TEXTS = 10_000

# Spellings that count as the same word when licences are compared.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisation": "capitalization", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite",
    "fulfil": "fulfill", "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment",
    "labelling": "labeling", "labour": "labor", "licence": "license", "licences": "licenses", "maximise": "maximize",
    "modelled": "modeled", "modelling": "modeling", "non commercial": "noncommercial", "offence": "offense",
    "optimise": "optimize", "organisation": "organization", "organise": "organize", "per cent": "percent",
    "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling",
    "sub license": "sublicense", "sublicence": "sublicense", "utilisation": "utilization",
    "whilst": "while", "wilful": "willful", "copyright owner": "copyright holder", "https": "http",
}

#: The SQL twin's notice lines: any that begin with the word or sign, also wrapped prose of a licence.
_COPYRIGHT = r"(?m)^[\s\p{P}\p{S}]*(copyright\b|\(c\)|©)[^\n]*$"
# Words that follow "copyright" in the prose of licences, so no holder's name.
_PROSE = ("also", "and", "are", "as", "claims?", "disclaimer", "doctrines?", "for", "holders?", "if", "in", "interests?", "is", "laws?",
          "licen[cs]es?", "like", "lines?", "notices?", "of", "on", "or", "owners?", "ownership", "patent", "permission", "protection",
          "resulting", "rights?", "statements?", "that", "the", "this", "those", "to", "treaty", "treaties")
#: Notice lines: copyright with (c), the sign, a year or a holder; (c) with a year; the sign.
_NOTICE = (r"(?m)^[^\n\p{L}\p{N}]*(copyright\b[^\n\p{L}\p{N}]*(©|\p{N}|(?!(" + "|".join(_PROSE) + r")\b)\p{L})"
           r"|\(c\)[^\S\n]*(copyright\b|\p{N})|©)[^\n]*$")


def with_digest(df: DataFrame, text_col: str) -> DataFrame:
    """Replace a text by ``digest``, the md5 of its canonical form; null where no letter or digit is left.

    Canonical: lower case, no lines that are a copyright notice, words of letters and digits apart by one blank, one
    spelling. Each step is a column of its own, so that none is worked out twice.
    """
    single = {odd: usual for odd, usual in SPELLINGS.items() if " " not in odd}
    usual = F.create_map(*[F.lit(word) for pair in single.items() for word in pair])
    low = F.col("low")
    marked = low.contains("copyright") | low.contains("(c)") | low.contains("©")
    words = F.split("words", " ")
    same = F.array_join(F.transform(words, lambda w: F.coalesce(F.element_at(usual, w), w)), " ")
    for odd, one in SPELLINGS.items():
        if odd not in single:
            same = F.regexp_replace(same, rf"\b{_respelled(odd, single)}\b", one)
    odd_one = F.col("words").rlike(r"\b(" + "|".join(SPELLINGS) + r")\b")
    return (df.withColumn("low", F.lower(text_col)).drop(text_col)
            .withColumn("bare", F.when(marked, F.regexp_replace("low", _NOTICE, "")).otherwise(low)).drop("low")
            .withColumn("words", F.trim(F.regexp_replace("bare", r"[^\p{L}\p{N}]+", " "))).drop("bare")
            .withColumn("plain", F.when(odd_one, same).otherwise(F.col("words"))).drop("words")
            .withColumn("digest", F.when(F.col("plain") != "", F.md5("plain"))).drop("plain"))


def _respelled(words: str, single: dict[str, str]) -> str:
    return " ".join(single.get(word, word) for word in words.split(" "))


def known_licences(spark: SparkSession, texts: dict[str, list[str]] | None = None) -> DataFrame:
    """(digest, licence) of the given texts, licence name to its wordings, or of all known ones; a digest of two names goes to the first by order."""
    rows = [(name, text) for name, wordings in (known_texts() if texts is None else texts).items() for text in wordings]
    return with_digest(spark.createDataFrame(rows, "licence string, text string"), "text").groupBy("digest") \
        .agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Look up each text, and each of its lines, among ``known`` (digest, licence).

    Returns one row per row of ``docs``: ``id_col``, digest of the whole text, licence (if the whole text is one) and notices,
    the sorted names of licences that single lines of it are, or an empty array.

    A text that is null, empty or without letter and digit has no digest and matches nothing. Every row is judged by its own text,
    also where ids repeat or are null. An empty table gives an empty result. Other columns may have any name.
    """
    rows = pick(docs, id=id_col, text=text_col).withColumn("row", F.monotonically_increasing_id())
    names = known.select("digest", "licence")
    if known.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS:
        names = F.broadcast(names)
    whole = with_digest(rows, "text").join(names, "digest", "left")
    lines = rows.filter("text is not null").select("row", F.explode(F.split("text", "\n")).alias("line"))
    notices = with_digest(lines, "line").filter("digest is not null").join(names, "digest").groupBy("row").agg(F.sort_array(F.collect_set("licence")).alias("notices"))
    found = whole.join(notices, "row", "left")
    return found.select(F.col("id").alias(id_col), "digest", "licence",
                        F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))
