from pyspark.sql import functions as F

from adyield.llm import toxicity
from tests.conftest import plan_of


def test_words_and_stems_are_those_of_the_plain_form(spark):
    texts = ["", None, "  ", "One, two;THREE... four", "...lead and trail!!!", "ab abcd abcde Ünïcode stupidity stup", "é" * 5]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    plain = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    assert docs.filter(~toxicity.words_of(F.col("text")).eqNullSafe(plain)).count() == 0
    assert "lambda" not in plan_of(docs.select(toxicity.words_of(F.col("text"))))
    voters = [toxicity.Voter("abcd-", "stem", ["abcd"]), toxicity.Voter("stup-", "stem", ["stup"])]
    votes = {r.id: r.votes for r in toxicity.with_votes(docs, voters).select("id", "votes").collect()}
    assert votes[5] == [1.0, 1.0] and votes[4] == votes[3] == [0.0, 0.0]
    assert len(toxicity.with_votes(docs, [toxicity.Voter("w", "words", ["two"])]).filter("votes[0] = 1").collect()) == 1
