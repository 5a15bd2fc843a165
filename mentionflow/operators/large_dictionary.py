"""Matching with a dictionary of any size, kept as a DataFrame (``keyword``, ``raw_type``, ``ordinal``).

The same results as the forms that carry the dictionary inside expressions, by equi-joins:
a text gives its distinct tokens or 4-grams, the dictionary gives each keyword's anchor, and
only pairs that share one are tested. Short strings (repository names, runs of punctuation)
give their substrings of the lengths that keywords have, so every pair that the join makes
is a match. Spark broadcasts the dictionary side while it is small; beyond that a bit set of
the keywords drops what has no partner before it is shuffled (``key_filter``). A frequent
token's rows may be split by AQE, as the dictionary has few rows for it. ``keys`` must
identify a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import rules as R, text as T
from ..session import materialize
from .key_filter import join_keys

_WORD_CHAR = r"[\p{L}\p{N}_]"


def _tokens(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.explode(F.array_distinct(T.tokens(F.col(text)))).alias("_token"))


def match_words(df: DataFrame, text: str, dictionary: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, keyword): plain-word keywords that are whole tokens."""
    words = dictionary.select("keyword").distinct()
    return _tokens(df, text, keys).join(words, F.col("_token") == F.col("keyword")).select(*keys, "keyword")


def _whole_word(keyword: Column) -> Column:
    """Regex of a keyword between word boundaries; see functions.text.whole_word_pattern."""
    def edge(char: Column, ahead: str) -> Column:
        return F.when(F.rlike(char, F.lit(f"^{_WORD_CHAR}$")), f"(?{ahead}!{_WORD_CHAR[:-1]}\U00010400])").otherwise(f"(?{ahead}={_WORD_CHAR[:-1]}\U00010400])")

    quoted = F.concat(F.lit("\\Q"), F.replace(keyword, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    return F.concat(edge(F.substring(keyword, 1, 1), "<"), quoted, edge(F.substring(keyword, -1, 1), ""))


def match_phrases(df: DataFrame, text: str, dictionary: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, keyword): punctuated and multi-word keywords as whole words.

    A keyword's longest word run is its anchor. Keywords without a word character have
    none and are looked up by their first four characters, or as a whole if shorter.
    """
    phrases = dictionary.select("keyword").distinct().where(~F.rlike("keyword", F.lit(f"^{_WORD_CHAR}+$")))
    runs = F.array_sort(T.tokens(F.col("keyword")), lambda a, b: F.length(b) - F.length(a))
    anchored = phrases.withColumn("_anchor", F.get(runs, F.lit(0)))
    by_token = _tokens(df, text, keys).join(anchored.where("_anchor IS NOT NULL"), F.col("_token") == F.col("_anchor")).select(*keys, "keyword")
    runs_of_others = F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"[^{_WORD_CHAR[1:-1]}]+"), F.lit(0))
    by_gram = _within(df, runs_of_others, materialize(anchored.where("_anchor IS NULL").select("keyword"), "loose-keywords"), keys)
    candidates = by_token.unionByName(by_gram).distinct()
    lowered = F.lower(F.col(text))
    return (df.join(candidates, keys).where(F.contains(lowered, F.col("keyword")) & F.rlike(lowered, _whole_word(F.col("keyword"))))
            .select(*keys, "keyword"))


def _inside(df: DataFrame, text: str, words: DataFrame, keys: list[str], size: int) -> DataFrame:
    """(keys, keyword): keywords that are substrings, found by their first ``size`` characters."""
    grams = F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"(?s)(?=(.{%d}))" % size), F.lit(1))
    heads = df.select(*keys, F.explode(F.array_distinct(grams)).alias("_gram"))
    pairs = heads.join(words.withColumn("_head", F.substring("keyword", 1, size)), F.col("_gram") == F.col("_head")).select(*keys, "keyword")
    return df.join(pairs, keys).where(F.contains(F.lower(F.col(text)), F.col("keyword"))).select(*keys, "keyword")


def _within(df: DataFrame, strings: Column, words: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, columns of ``words``): keywords that are substrings of one of a row's short ``strings``.

    The strings' substrings are made at the lengths that keywords have (the driver sees these
    lengths, no keyword) and joined as they are, so no pair needs a test. ``words`` is stored
    and has one row per keyword.
    """
    lengths = F.array(*[F.lit(r[0]) for r in words.select(F.length("keyword")).distinct().collect()]).cast("array<int>")

    def pieces(string: Column) -> Column:
        fitting = F.filter(lengths, lambda n: (n > 0) & (n <= F.length(string)))
        return F.flatten(F.transform(fitting, lambda n: F.transform(F.sequence(F.lit(1), F.length(string) - n + 1), lambda at: F.substring(string, at, n))))

    every = F.array_distinct(F.flatten(F.transform(F.array_distinct(strings), pieces)))
    return join_keys(df.select(*keys, F.explode(every).alias("keyword")), words, "keyword")


def match_any(df: DataFrame, text: str, dictionary: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, keyword): keywords that are a token, or longer than three characters and anywhere in the text."""
    words = dictionary.select("keyword").distinct()
    long = words.where(F.length("keyword") >= T.SUBSTRING_MIN_CHARS)
    return match_words(df, text, words, keys).unionByName(_inside(df, text, long, keys, T.SUBSTRING_MIN_CHARS)).distinct()


def match_messages(df: DataFrame, messages: str, dictionary: DataFrame, keys: list[str], cap: int | None = None) -> DataFrame:
    """(keys, keyword): what the messages of an event mention, each once.

    With a ``cap``, messages after the one that passes it do not count.
    """
    rows = df.select(*keys, F.posexplode(messages).alias("_at", "_message"))
    each = [*keys, "_at"]
    plain = dictionary.where(F.rlike("keyword", F.lit(f"^{_WORD_CHAR}+$")))
    hits = match_words(rows, "_message", plain, each).unionByName(match_phrases(rows, "_message", dictionary, each))
    first = hits.groupBy(*keys, "keyword").agg(F.min("_at").alias("_at"))
    if cap is None:
        return first.select(*keys, "keyword")
    before = Window.partitionBy(*keys).orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)  # keywords of one event
    return first.withColumn("_before", F.count("*").over(before)).where(F.col("_before") <= cap).select(*keys, "keyword")


def match_repo(df: DataFrame, repo: str, dictionary: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, keyword): keywords among the parts of a repository name, else the longest that is a substring.

    Of equally long ones the first of the dictionary counts, then the greater text.
    """
    words = materialize(dictionary.groupBy("keyword").agg(F.min("ordinal").alias("ordinal")), "keywords")
    parts = F.split(F.translate(F.lower(F.col(repo)), "/-._", "    "), r"(?U)\s+")
    named = df.select(*keys, F.explode(F.array_distinct(parts)).alias("keyword"))
    exact = materialize(join_keys(named, words, "keyword").select(*keys, "keyword"), "exact-parts")
    rest = df.join(exact.select(*keys).distinct(), keys, "left_anti")
    inside = _within(rest, F.array(F.lower(F.col(repo))), words, keys)
    best = inside.groupBy(*keys).agg(F.max_by("keyword", F.struct(F.length("keyword"), -F.col("ordinal"), "keyword")).alias("keyword"))
    return exact.unionByName(best)


def categorize(df: DataFrame, dictionary: DataFrame, column: str = "technology", name: str = "technology_category") -> DataFrame:
    """Adds the category: from the dictionary, else guessed once per distinct name."""
    names = df.select(F.lower(F.trim(F.col(column))).alias("_name")).distinct()
    lookup = dictionary.groupBy("keyword").agg(F.min_by("raw_type", "ordinal").alias("_raw"))
    known = names.join(lookup, F.col("_name") == F.col("keyword"), "left").select(
        "_name", F.coalesce(F.when(F.col("keyword").isNotNull(), R.standard_category(F.coalesce("_raw", F.lit(R.DEFAULT_CATEGORY)))),
                            R.inferred_category(F.col("_name"))).alias(name))
    return df.join(known, F.lower(F.trim(F.col(column))).eqNullSafe(F.col("_name")), "left").drop("_name")
