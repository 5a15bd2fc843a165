"""The counts of the toxicity model cover all labelled texts."""

import random

from mentionflow.llm import toxicity
from pyspark.sql import functions as F


def test_expressions_of_texts_apart_are_counted(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices(["ba", "de", "ti", "mo", "ru", "sel", "kan"], k=rng.randint(1, 4))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=30)) for _ in range(300)]
    given = spark.createDataFrame([(t + stem, int(stem != "")) for t in texts for stem in ("", " zorkish", " quaxly")], "text string, toxic int")
    # one expression stands in texts that the fit's counts leave out only, the other in those they count only
    apart = F.pmod(F.xxhash64("text"), F.lit(toxicity.FIT_SHARE)) == 0
    given = given.where((F.col("toxic") == 0) | apart & F.col("text").endswith("quaxly") | ~apart & F.col("text").endswith("zorkish"))
    assert given.where(F.col("text").endswith("quaxly")).count() > 20
    tables = toxicity.train(given).tables.value
    _, spread = toxicity.word_ratios(["quaxly", "zorkish", words[0]], *tables)
    assert spread[0] > 1 and spread[1] > 1 and spread[2] < 0.5
