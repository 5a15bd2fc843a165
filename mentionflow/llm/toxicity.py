"""Toxicity by class-conditional Kneser-Ney models.

Two language models of words as letter sequences, one of toxic and one of ordinary texts,
share their backoff: below the longest context both classes use the same continuation
counts, so an expression that neither class has seen weighs nothing, and inflected or rare
forms weigh by the stems they share with others. A word's log-likelihood ratio is divided
by its length; a text's features are its own length-normalised ratio and those of its most
toxic expressions, turned into a probability by a logistic fit. The fit is out of fold: its
features come from counts that have not seen the fit's texts; the model that scores counts all.

Counting, continuation counts and smoothing run in Spark over all labelled texts. N-grams
and contexts are known by hashes of ``KEY_BITS`` and ``CONTEXT_BITS`` bits, which bounds
what a task has to hold: an array of half floats for each, 36 MB together.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import boxed, pieces, ship_code, unboxed

ship_code(__name__)

#: Letters of an n-gram at most, with the marks for the start and end of a word.
ORDER = 6
DISCOUNT = 0.75
#: Bits of the hashes of n-grams and of contexts: bound the tables of ratios.
KEY_BITS, CONTEXT_BITS = 24, 21
#: Labelled texts that the logistic fit uses at most, in expectation; the counts of the model use all rows.
FIT_ROWS = 20_000
#: One of so many labelled texts (by the hash of the text) is kept from the counts that the fit's features come from.
FIT_SHARE = 5
#: Letters from which a word's ratio is spread over its length only.
LEAST_LETTERS = 4
#: Rows that a worker scores at a time.
ROWS = 1000
#: Characters that are taken apart at a time; a longer text is taken alone.
SLICE_CHARS = 1_000_000

_WORD = re.compile(r"[^\W_]+")
_START, _END, _NONE = 1, 2, 0
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
FEATURES = 5


def words_of(text: str) -> list[str]:
    """Runs of letters and digits in lower case."""
    return _WORD.findall(text.lower())


class Letters:
    """Words laid end to end as letter codes, with the hashes of the n-grams that end at each letter."""

    def __init__(self, words: list[str]):
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
        ends = np.cumsum(lengths)
        codes = np.zeros(int(ends[-1]) if len(words) else 0, np.uint64)
        inner = np.ones(len(codes), bool)
        inner[ends - lengths], inner[ends - 1] = False, False
        codes[inner] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        codes[ends - lengths], codes[ends - 1] = _START, _END
        self.word = np.repeat(np.arange(len(words)), lengths)
        self.place = np.arange(len(codes)) - np.repeat(ends - lengths, lengths)
        self.lengths = lengths - 2
        self.hashes = []
        rolling = np.full(len(codes), 7, np.uint64)
        for n in range(ORDER):
            shifted = codes if n == 0 else np.concatenate([np.zeros(n, np.uint64), codes[:-n]])[:len(codes)]
            rolling = (rolling ^ shifted) * _A
            rolling ^= rolling >> np.uint64(31)
            rolling = rolling * _B
            rolling ^= rolling >> np.uint64(30)
            self.hashes.append(rolling)
        self.codes = codes

    def key(self, size: np.ndarray, at: np.ndarray, bits: int = KEY_BITS) -> np.ndarray:
        """Keys of the n-grams of the given sizes that end at the given places."""
        out = np.empty(len(at), np.uint64)
        for n in range(1, ORDER + 1):
            here = size == n
            out[here] = self.hashes[n - 1][at[here]]
        return (out & np.uint64((1 << bits) - 1)).astype(np.int64)


def _word_counts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in pieces(batches):
        counts = [Counter(), Counter()]
        for toxic, text in zip(batch["toxic"], batch["text"]):
            counts[toxic].update(words_of(text))
        for toxic in (0, 1):
            if counts[toxic]:
                yield pd.DataFrame({"word": list(counts[toxic]), "toxic": toxic, "n": list(counts[toxic].values())})


def _gram_counts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (context, gram, level, preceding letter, counts) of distinct words.

    Level ORDER is the longest context of a letter, with class counts; a lower level n has
    the n-grams by what precedes them, for continuation counts.
    """
    for batch in batches:
        letters = Letters(batch["word"].tolist())
        at = np.flatnonzero(letters.place > 0)
        size = np.minimum(letters.place[at], ORDER - 1) + 1
        ordinary, toxic = (batch[c].to_numpy()[letters.word[at]] for c in ("ordinary", "toxic"))
        frames = [pd.DataFrame({"context": letters.key(size - 1, at - 1, CONTEXT_BITS), "gram": letters.key(size, at), "level": ORDER, "before": _NONE,
                                "ordinary": ordinary, "toxic": toxic})]
        for n in range(1, ORDER):
            longer = at[size > n]
            frames.append(pd.DataFrame({
                "context": letters.key(np.full(len(longer), n - 1), longer - 1, CONTEXT_BITS) if n > 1 else 0,
                "gram": letters.key(np.full(len(longer), n), longer), "level": n,
                "before": letters.codes[longer - n].astype(np.int64), "ordinary": 0, "toxic": 0}))
        whole = pd.concat(frames)
        # the gram one letter shorter, from which a gram's backoff comes
        yield whole.groupby(["level", "context", "gram", "before"], as_index=False)[["ordinary", "toxic"]].sum()


def _links(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(level, gram, the gram without its first letter) of distinct words."""
    for batch in batches:
        letters = Letters(batch["word"].tolist())
        at = np.flatnonzero(letters.place > 0)
        size = np.minimum(letters.place[at], ORDER - 1) + 1
        frames = []
        for n in range(2, ORDER + 1):
            top = at[size == n]
            frames.append(pd.DataFrame({"level": ORDER, "size": n, "gram": letters.key(np.full(len(top), n), top), "shorter": letters.key(np.full(len(top), n - 1), top)}))
            lower = at[size > n] if n < ORDER else at[:0]
            frames.append(pd.DataFrame({"level": n, "size": n, "gram": letters.key(np.full(len(lower), n), lower), "shorter": letters.key(np.full(len(lower), n - 1), lower)}))
        yield pd.concat(frames).drop_duplicates()


def count_words(texts: DataFrame) -> DataFrame:
    """``word``, ``ordinary``, ``toxic``: how often each class has a word, over all given texts."""
    counts = texts.mapInPandas(_word_counts, "word string, toxic int, n long")
    return counts.groupBy("word").agg(F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("ordinary"),
                                      F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"))


def ratios(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Log ratios of the two models: by n-gram (``gram``, ``ratio``) and by context (``context``, ``ratio``).

    P_class(letter | longest context) = (count - D)+ / total + D * types / total * S, where S is
    the shared Kneser-Ney estimate from continuation counts of the shorter contexts. For a
    letter that no class has seen after the context S cancels: the ratio is that of the
    backoff weights, which is kept by context.
    """
    grams = materialize(words.mapInPandas(_gram_counts, "level int, context long, gram long, before long, ordinary long, toxic long")
                        .groupBy("level", "context", "gram", "before").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")), "grams")
    links = materialize(words.mapInPandas(_links, "level int, size int, gram long, shorter long")
                        .groupBy("level", "size", "gram").agg(F.min("shorter").alias("shorter")), "gram-links")
    shared = None
    for n in range(1, ORDER):
        counts = grams.where(F.col("level") == n).groupBy("context", "gram").agg(F.count("*").alias("n"))
        totals = counts.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
        level = counts.join(totals, "context")
        own = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("total")
        weight = DISCOUNT * F.col("types") / F.col("total")
        if shared is None:
            level = level.select("gram", (own + weight / F.col("types")).alias("shared"))
        else:
            lower = links.where((F.col("level") == n)).select(F.col("gram"), "shorter").join(
                shared.select(F.col("gram").alias("shorter"), F.col("shared").alias("lower")), "shorter", "left")
            level = (level.join(lower.groupBy("gram").agg(F.max("lower").alias("lower")), "gram", "left")
                     .select("gram", (own + weight * F.coalesce("lower", F.lit(0.0))).alias("shared")))
        shared = materialize(level.groupBy("gram").agg(F.max("shared").alias("shared")), f"shared-{n}")
        levels = shared.withColumn("size", F.lit(n)) if n == 1 else levels.unionByName(shared.withColumn("size", F.lit(n)))
    top = grams.where(F.col("level") == ORDER).select("context", "gram", "ordinary", "toxic")
    contexts = top.groupBy("context").agg(*[e for c in ("ordinary", "toxic") for e in (
        F.sum(c).alias(f"{c}_total"), F.count_if(F.col(c) > 0).alias(f"{c}_types"))])
    backoff = lambda c: F.when(F.col(f"{c}_total") > 0, DISCOUNT * F.col(f"{c}_types") / F.col(f"{c}_total")).otherwise(F.lit(1.0))
    own = lambda c: F.when(F.col(f"{c}_total") > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(f"{c}_total")).otherwise(F.lit(0.0))
    lower = (links.where(F.col("level") == ORDER).join(
        levels.select(F.col("gram").alias("shorter"), (F.col("size") + 1).alias("size"), "shared"), ["shorter", "size"], "left")
        .groupBy("gram").agg(F.max("shared").alias("shared")))
    floor = F.coalesce("shared", F.lit(1e-6))
    chance = lambda c: own(c) + backoff(c) * floor
    by_gram = top.join(contexts, "context").join(lower, "gram", "left").select("gram", F.log(chance("toxic") / chance("ordinary")).alias("ratio"))
    by_context = contexts.select("context", F.log(backoff("toxic") / backoff("ordinary")).alias("ratio"))
    return by_gram.groupBy("gram").agg(F.avg("ratio").alias("ratio")), by_context


def dense(table: DataFrame, key: str, bits: int) -> np.ndarray:
    """Array of ratios by key, NaN where there is none; at most 2^bits rows of 8 bytes reach the driver."""
    rows = table.select(F.col(key).cast("int").alias("key"), F.col("ratio").cast("float").alias("ratio")).toArrow()
    out = np.full(1 << bits, np.nan, np.float16)
    out[rows["key"].to_numpy()] = np.clip(rows["ratio"].to_numpy(), -30, 30)
    return out


def word_ratios(words: list[str], by_gram: np.ndarray, by_context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood ratio of every word, whole and by its length."""
    letters = Letters(words)
    at = np.flatnonzero(letters.place > 0)
    size = np.minimum(letters.place[at], ORDER - 1) + 1
    found = by_gram[letters.key(size, at)].astype(np.float32)
    backoff = by_context[letters.key(size - 1, at - 1, CONTEXT_BITS)].astype(np.float32)
    ratio = np.where(np.isnan(found), np.nan_to_num(backoff), found)
    whole = np.bincount(letters.word[at], ratio, len(words))
    return whole, whole / np.maximum(letters.lengths, LEAST_LETTERS)


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Texts in order, a bounded number of characters at a time."""
    part, chars = [], 0
    for text in texts:
        if part and chars + len(text) > SLICE_CHARS:
            yield part
            part, chars = [], 0
        part.append(text)
        chars += len(text)
    yield part


def features(texts: list[str], by_gram: np.ndarray, by_context: np.ndarray) -> np.ndarray:
    """FEATURES numbers for each text; zeros for a text without words."""
    return np.vstack([_features(part, by_gram, by_context) for part in slices(texts)])


def _features(texts: list[str], by_gram: np.ndarray, by_context: np.ndarray) -> np.ndarray:
    tokens = [words_of(t) for t in texts]
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    out = np.zeros((len(texts), FEATURES))
    if not sizes.sum():
        return out
    which, known = pd.factorize(np.array([w for t in tokens for w in t], dtype=object))
    whole, spread = word_ratios(list(known), by_gram, by_context)
    letters = np.fromiter(map(len, known), np.int64, len(known))
    ends = np.cumsum(sizes)
    for i, (start, end) in enumerate(zip(ends - sizes, ends)):
        if end > start:
            ids = which[start:end]
            own, total = spread[ids], whole[ids]
            best = np.sort(np.unique(own))[-3:]
            toxic = own > 1.0
            out[i] = (total.sum() / letters[ids].sum(), best[-1], best.mean(), toxic.mean(), total[toxic].sum() / len(ids) ** 0.5)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and weights (intercept last) of a penalised logistic fit by Newton steps."""
    mean, scale = (x.mean(0), x.std(0)) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    ridge = np.diag([penalty] * FEATURES + [1e-3])
    weights = np.zeros(FEATURES + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ weights)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, weights


def probability(x: np.ndarray, fit: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    mean, scale, weights = fit
    return 1 / (1 + np.exp(-np.clip((x - mean) / scale @ weights[:-1] + weights[-1], -30, 30)))


class Model:
    """The ratio tables, broadcast, and the logistic fit."""

    def __init__(self, spark, by_gram: np.ndarray, by_context: np.ndarray):
        self.tables = spark.sparkContext.broadcast((by_gram, by_context))
        self.fit = None

    def featured(self, texts: DataFrame, keep: str) -> DataFrame:
        """``keep`` (a DDL list of columns) and ``features`` of every row with ``text``."""
        tables, names = self.tables, [c.split()[0] for c in keep.split(",")]

        def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in pieces(batches):
                yield batch[names].assign(features=list(features(batch["text"].tolist(), *tables.value)))

        return texts.mapInPandas(run, f"{keep}, features array<double>")

    def score(self, texts: Column) -> Column:
        """Probability that a text is toxic."""
        tables, fit = self.tables, self.fit

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                parts = (batch.iloc[start:start + ROWS].fillna("").tolist() for start in range(0, len(batch), ROWS))
                yield pd.Series(np.concatenate([probability(features(part, *tables.value), fit) for part in parts] or [np.zeros(0)]))

        return scored(texts)


def train(labelled: DataFrame, text: str = "text", label: str = "toxic", key: str | None = None) -> Model:
    """Model from labelled texts; rows with a NULL label are left out, a NULL text is empty.

    Without rows of both classes every text gets the same score. Nothing but text and label
    is learned from; ``key`` only draws the rows of the fit (by their text without it).
    """
    spark = labelled.sparkSession
    rows = labelled.where(F.col(label).isin(0, 1)).select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("int").alias("toxic"), F.col(key or text).alias("key"))
    draw = F.pmod(F.xxhash64("text"), F.lit(FIT_SHARE))
    others = materialize(count_words(rows.where(draw != 0)), "toxicity-words")
    apart = rows.where(draw == 0)
    share = FIT_ROWS / max(FIT_ROWS, apart.count())
    sample = apart.where(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1_000_000)) < int(share * 1_000_000))
    partial = _counted(spark, others)
    fitted = partial.featured(sample, "toxic int").toPandas()
    partial.tables.destroy()
    words = others.unionByName(count_words(apart)).groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    model = _counted(spark, materialize(words, "toxicity-words"))
    x = np.array(fitted["features"].tolist(), float).reshape(-1, FEATURES)
    model.fit = fit_logistic(x, fitted["toxic"].to_numpy(float))
    return model


def _counted(spark, words: DataFrame) -> Model:
    """Model with the ratios of counted words, without its fit."""
    by_gram, by_context = ratios(words)
    return Model(spark, dense(by_gram, "gram", KEY_BITS), dense(by_context, "context", CONTEXT_BITS))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    NULL and empty texts are scored as texts without words. Input columns of these names are replaced.
    """
    rows = boxed(docs, score=model.score(F.col(text)))
    return unboxed(rows, docs.columns, {"score": F.col("score"), "predicted": (F.col("score") >= 0.5).cast("int")})
