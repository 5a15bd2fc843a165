"""Bit sets of keys, and the joins and matches that use them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from mentionflow.checks import events as E, inputs as I
from mentionflow.functions import rules as R
from mentionflow.operators import key_filter, large_dictionary, matching
from mentionflow.operators.key_filter import KeyFilter, join_keys
from mentionflow.session import materialize
from mentionflow.sources.dictionary import Dictionary


def words(spark, prefix, n):
    return spark.range(n).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("k"))


@pytest.mark.parametrize("n", [1, 300, 60_000])
def test_no_key_is_lost_and_few_others_pass(spark, n):
    keys = words(spark, "w", n)
    held = KeyFilter(keys, "k")
    assert keys.where(held.may_hold(F.col("k"))).count() == n
    assert words(spark, "x", 100_000).where(held.may_hold(F.col("k"))).count() < 1_000


def test_no_keys_and_null(spark):
    nothing = KeyFilter(words(spark, "w", 5).limit(0), "k")
    assert words(spark, "w", 5).where(nothing.may_hold(F.col("k"))).isEmpty()
    with_null = KeyFilter(spark.createDataFrame([("a",), (None,)], "k string"), "k")
    assert [r.k for r in spark.createDataFrame([("a",), ("b",)], "k string").where(with_null.may_hold(F.col("k"))).collect()] == ["a"]


def test_a_set_beyond_its_bits_lets_more_pass_but_loses_none(spark, monkeypatch):
    monkeypatch.setattr(key_filter, "MOST_BITS", key_filter.BITMAP_BITS)
    keys = words(spark, "w", 20_000)
    held = KeyFilter(keys, "k")
    assert held.bitmaps == 1 and keys.where(held.may_hold(F.col("k"))).count() == 20_000


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(key_filter, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_shuffles_hardly_more_than_it_matches(spark, no_broadcast):
    keys = materialize(words(spark, "w", 3_000).withColumn("v", F.lit(1)), "keys")
    rows = words(spark, "w", 40_000)
    joined = join_keys(rows, keys, "k")
    assert joined.count() == 3_000
    passed = rows.where(KeyFilter(keys, "k").may_hold(F.col("k"))).count()
    assert 3_000 <= passed <= 1.1 * 3_000


def test_token_join_is_the_same_with_and_without_broadcast(spark, sf_dir, no_broadcast):
    found = sorted(map(tuple, E.j2(spark, sf_dir).collect()))
    docs = I.table(spark, sf_dir, "documents")
    vocabulary = docs.where("lang <> 'en'").select(F.explode(E.T.tokens(F.col("text"))).alias("keyword")).distinct()
    some = {r.keyword for r in vocabulary.collect()}
    direct = docs.select("doc_id", F.explode(F.array_distinct(E.T.tokens(F.col("text")))).alias("keyword")).collect()
    assert {(r.doc_id, r.keyword) for r in direct if r.keyword in some} <= set(found)


def test_large_repo_match_equals_the_small_form(spark, no_broadcast):
    rng = random.Random(4)
    letters = "abc-/._ "
    names = [(i, "".join(rng.choices(letters, k=rng.randint(0, 14)))) for i in range(300)] + [(900, None), (901, "")]
    entries = list(dict.fromkeys("".join(rng.choices("abc-. ", k=rng.randint(1, 4))).strip() for _ in range(60)))
    dictionary = Dictionary.of([(k, "tool") for k in entries if k])
    df = spark.createDataFrame(names, "id int, repo string")
    large = {(r.id, r.keyword) for r in large_dictionary.match_repo(df, "repo", dictionary.frame(spark), ["id"]).collect()}
    small = matching.match_repo(df, "repo", dictionary)
    assert large == {(r.id, k) for r in small.collect() for k in r.technologies}


def test_loose_keywords_of_a_large_dictionary(spark):
    dictionary = Dictionary.of([(k, "tool") for k in ("++", "->", "c++", "=", "...")])
    texts = [(1, "a ++ b -> c"), (2, "c++ =... x"), (3, "plain"), (4, None), (5, "a++b"), (6, "==")]
    df = spark.createDataFrame(texts, "id int, text string")
    large = {tuple(r) for r in large_dictionary.match_phrases(df, "text", dictionary.frame(spark), ["id"]).collect()}
    assert large == {tuple(r) for r in matching.match_phrases(df, "text", dictionary, ["id"]).collect()}


def test_every_pair_of_the_substring_join_is_a_match(spark):
    keys = materialize(spark.createDataFrame([("ab",), ("b",), ("abc",), ("zz",)], "keyword string"), "keys")
    df = spark.createDataFrame([(1, "xabcx"), (2, "bb"), (3, "q")], "id int, name string")
    pairs = [(r.id, r.keyword) for r in large_dictionary._within(df, F.array("name"), keys, ["id"]).collect()]
    assert sorted(pairs) == [(1, "ab"), (1, "abc"), (1, "b"), (2, "b")]


def test_inference_is_that_of_the_ordered_words(spark):
    rng = random.Random(9)
    words_of = [w for _, ws in R.INFERENCE_RULES for w in ws]
    names = words_of + [rng.choice(words_of)[:rng.randint(1, 9)] + rng.choice(words_of) for _ in range(800)] + ["", "zzz", " Go ", "KAFKA-Ü"]
    def expected(name):
        cleaned = name.strip(" ").lower()
        return next((c for c, ws in R.INFERENCE_RULES if any(w in cleaned for w in ws)), R.DEFAULT_CATEGORY)
    got = spark.createDataFrame([(n,) for n in names], "n string").withColumn("c", R.inferred_category(F.col("n"))).collect()
    assert [(r.n, r.c) for r in got] == [(n, expected(n)) for n in names]
    assert spark.range(1).select(R.inferred_category(F.lit(None).cast("string")).alias("c")).first().c == R.DEFAULT_CATEGORY
    assert re.fullmatch(R._tree_pattern(["go", "golang", "c++", "c"]), "golang")
