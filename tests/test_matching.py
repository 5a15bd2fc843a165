"""Keyword matching against hand-written cases and against Python's regex."""

import random
import re

import pytest
from pyspark.sql import functions as F

from mentionflow.functions import text as T
from mentionflow.operators import matching as M
from mentionflow.plans.bronze import build_bronze
from mentionflow.schemas import EVENT
from mentionflow.sources.dictionary import Dictionary, load_dictionary


def words(*keywords):
    return Dictionary.of([(k, "tool") for k in keywords])


def hits(spark, text, dictionary, how=T.whole_word_hits):
    return sorted(spark.createDataFrame([(text,)], "t string").select(how(F.col("t"), dictionary)).first()[0])


@pytest.mark.parametrize("text,keyword,expected", [
    ("use c++ now", "c++", False), ("moved to c++11", "c++", True),
    ("asp.net core", ".net", True), (".net core", ".net", False),
    ("go_lang", "go", False), ("naïve", "na", False), ("Go!", "go", True), ("été-x", "été", True),
    ("next.js", "next.js", True), ("nextxjs", "next.js", False), ("spring  boot", "spring boot", False),
    ("a spring boot app", "spring boot", True), ("x!!y", "!!", True), ("!!", "!!", False),
])
def test_whole_words(spark, text, keyword, expected):
    assert hits(spark, text, words(keyword)) == ([keyword] if expected else [])
    # Python's own rule
    assert bool(re.search(rf"\b{re.escape(keyword)}\b", text.lower())) == expected


PIECES = ["go", "c++", "next.js", "été", "naïve", "_x", "3d", "-", " ", ".", "+", "of", "the", "\n", "ß", "中文", "𝒳"]


@pytest.mark.parametrize("seed", range(3))
def test_whole_words_like_python(spark, seed):
    rng = random.Random(seed)
    dictionary = words("go", "c++", "next.js", "été", "of the", "3d", ".net", "the", "x-the", "中文")
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [sorted(r[0]) for r in df.select(T.whole_word_hits(F.col("t"), dictionary)).collect()]
    want = [sorted(k for k in dictionary.keywords() if re.search(rf"\b{re.escape(k)}\b", t.lower())) for t in texts]
    assert got == want


@pytest.mark.parametrize("direct", [0, 1000])
def test_any_match_like_python(spark, monkeypatch, direct):
    """Both substring ways, on random texts."""
    monkeypatch.setattr(T, "DIRECT_SUBSTRINGS", direct)
    rng = random.Random(7)
    dictionary = words("go", "script", "javascript", "next.js", "thethe", "naïve", "of the", "abc")
    pieces = PIECES + ["script", "java", "abc", "next"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 20))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(T.any_hits(F.col("t"), dictionary)).collect()]
    want = []
    for t in texts:
        low, toks = t.lower(), set(re.findall(r"\b\w+\b", t.lower()))
        want.append(sorted(k for k in dictionary.keywords() if k in toks or (len(k) > 3 and k in low)))
    assert got == want


def test_large_dictionary_uses_grams_and_agrees(spark):
    rng = random.Random(3)
    keywords = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(3, 6))) for _ in range(400)})
    dictionary = words(*keywords)
    assert len([k for k in keywords if len(k) > 3]) > T.DIRECT_SUBSTRINGS
    texts = ["".join(rng.choice("abcde ") for _ in range(60)) for _ in range(100)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(T.any_hits(F.col("t"), dictionary)).collect()]
    want = [sorted(k for k in keywords if k in t.split() or (len(k) > 3 and k in t)) for t in texts]
    assert got == want


def test_join_form_agrees(spark):
    dictionary = words("go", "rust", "été")
    df = spark.createDataFrame([(1, "go Go rust-lang"), (2, "l'été"), (3, "none"), (4, None)], "id int, t string")
    one = {tuple(r) for r in M.match_words(df, "t", dictionary, ["id"]).collect()}
    two = {tuple(r) for r in M.match_words_join(df, "t", dictionary.frame(spark), ["id"]).collect()}
    assert one == two == {(1, "go"), (1, "rust"), (2, "été")}


@pytest.mark.parametrize("keyword", ["o'reilly", "a\\b", "50%", 'say "x"', "${x}", "tab\tx"])
def test_awkward_keywords(spark, keyword):
    dictionary = words(keyword, "plain")
    long = [keyword] if len(keyword) > 3 else []
    assert hits(spark, f"x {keyword} plain y", dictionary, T.any_hits) == sorted([*long, "plain"])
    found = hits(spark, f"x {keyword} plain y", dictionary)
    assert (keyword in found) == bool(re.search(rf"\b{re.escape(keyword)}\b", f"x {keyword} plain y"))


def twelve():
    return words(*[f"k{i}" for i in range(12)], "late")


def capped(spark, messages):
    df = spark.createDataFrame([(messages,)], "m array<string>")
    return df.select(T.capped_hits(F.col("m"), twelve(), T.KEYWORD_CAP)).first()[0]


def test_cap_counts_the_message_that_passes_it(spark):
    found = capped(spark, [" ".join(f"k{i}" for i in range(12)), "late"])
    assert len(found) == 12 and "late" not in found


def test_cap_is_more_than_ten(spark):
    assert len(capped(spark, [" ".join(f"k{i}" for i in range(10)), "late", "k11"])) == 11


def test_keyword_counts_once_per_event(spark):
    assert capped(spark, ["k1 k1", "k1"]) == ["k1"]


@pytest.mark.parametrize("repo,expected", [
    ("owner/my-python_app", ["python"]), ("a/b", []), (None, []),
    ("x/mypythonapp", ["python"]), ("go.lang/Rust", ["go", "rust"]),
    ("x/javascripting", ["javascript"]),
])
def test_repository_names(spark, repo, expected):
    dictionary = words("java", "python", "go", "rust", "javascript")
    df = spark.createDataFrame([(repo,)], "r string")
    assert df.select(T.repo_hits(F.col("r"), dictionary)).first()[0] == expected


def test_repository_fallback_looks_at_the_longest_only(spark):
    dictionary = words(*[f"longkeyword{i:02d}" for i in range(20)], "abc")
    df = spark.createDataFrame([("x/zabcz",)], "r string")
    assert df.select(T.repo_hits(F.col("r"), dictionary, T.REPO_FALLBACK_KEYWORDS)).first()[0] == []
    assert df.select(T.repo_hits(F.col("r"), dictionary)).first()[0] == ["abc"]


def event(spark, rows):
    """Rows (id, type, repo, payload) as nested events of one hour."""
    schema = EVENT.fieldNames()
    data = [(i, t, None, None if r is None else (r,), p) for i, t, r, p in rows]
    df = spark.createDataFrame(data, EVENT)
    assert df.columns == schema
    return df.withColumn("date", F.lit("2024-01-01")).withColumn("hour", F.lit(3))


def payload(commits=None, title=None, body=None):
    pull = (title, body, None) if title or body else None
    return (None if commits is None else [(m,) for m in commits], pull, None, None, None, None)


def test_bronze_from_events(spark):
    rows = [
        ("1", "PushEvent", "b/second", payload(["Go go", None, "", "go rust"])),
        ("2", "PushEvent", "a/first", payload(["go"])),
        ("3", "PullRequestEvent", None, payload(title="Rust", body="x" * 499 + " rust go")),
        ("4", "IssuesEvent", "a/first", payload(["go"])),
        ("5", "PushEvent", "a/first", None),
        ("6", "PushEvent", "a/first", payload()),
    ]
    got = {r["keyword"]: r for r in build_bronze(event(spark, rows), words("go", "rust"), body_chars=T.BODY_CHARS).collect()}
    assert got["go"]["mentions"] == 2 and got["rust"]["mentions"] == 2
    # both repositories have one mention: the earlier event wins
    assert (got["go"]["top_repo"], got["go"]["repo_mentions"]) == ("b/second", 1)
    assert got["rust"]["top_repo"] == "b/second"
    assert {r["event_mentions"] for r in got.values()} == {4}
    assert {r["source_file"] for r in got.values()} == {"2024-01-01-batch.json.gz"}


def test_body_after_the_limit_counts_unless_limited(spark):
    rows = [("1", "PullRequestEvent", "a/b", payload(title="t", body="x" * 500 + " rust"))]
    assert build_bronze(event(spark, rows), words("rust"), body_chars=T.BODY_CHARS).count() == 0
    assert build_bronze(event(spark, rows), words("rust")).count() == 1


def test_one_repository_with_most_rows(spark):
    """A third and more of all events on one repository and keyword."""
    rows = [(str(i), "PushEvent", "hot/repo" if i % 3 else f"r/{i}", payload(["go"])) for i in range(300)]
    [row] = build_bronze(event(spark, rows), words("go")).collect()
    assert (row["mentions"], row["top_repo"], row["repo_mentions"]) == (300, "hot/repo", 200)


def test_searchable_text_limits(spark):
    df = event(spark, [("1", "PushEvent", "Own/Repo", payload(["A" * 300, "", "b", "c", "d"]))])
    text = M.searchable(df, **T.LIVE_LIMITS).first()["searchable_text"]
    assert text == " ".join(["own/repo", "repo", "pushevent", "a" * 200, "b"])
    whole = M.searchable(df).first()["searchable_text"]
    assert whole.endswith("a" * 300 + " b c d")


def test_default_dictionary(spark):
    found = load_dictionary(spark)
    assert "c++" in found.phrases() and "python" in found.plain_words()
    assert len(found.longest(20)) == 20


def test_dictionary_fallback_and_bound(spark, tmp_path):
    from mentionflow.sources import dictionary as D

    assert load_dictionary(spark, str(tmp_path / "absent"), fallback=D.STREAM_FALLBACK).keywords()[0] == "javascript"
    broken = tmp_path / "broken.json"
    broken.write_text("{not json")
    assert len(load_dictionary(spark, str(broken), fallback=D.PRODUCER_FALLBACK).keywords()) == 25
    with pytest.raises(ValueError):
        Dictionary.of([(f"k{i}", "tool") for i in range(D.MAX_ENTRIES + 1)])


def test_dictionary_cleaning(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text('{" Go ": {"type": "language"}, "r": {"type": "language"}, "GO": {"type": "tool"}, "x1": {}}')
    assert load_dictionary(spark, str(path), min_chars=2).entries == (("go", "language"), ("x1", "development_tool"))


LARGE = [("python", "language"), ("c++", "language"), ("of the", "tool"), ("next.js", "web_framework"), ("++", "tool"), ("ation", "tool"), ("go", "language"), ("a\\Eb", "tool"), ("src", "tool")]


@pytest.mark.parametrize("extra", [0, 20_000])
def test_join_forms_agree_with_expressions(spark, extra):
    """A dictionary of any size gives the same matches; 20,000 more entries give theirs."""
    from mentionflow.operators import large_dictionary as L
    from mentionflow.sources.dictionary import clean_keywords

    rows = [(1, "Python, of the nation c++x ++ go-go", "own/python-src"), (2, "next.js a\\Eb! x++y", "x/nation_y"), (3, "", ""), (4, None, None), (5, "k7 k19999 zzk5zz", "k3/k4")]
    df = spark.createDataFrame(rows, "n long, text string, repo string")
    entries = LARGE + [(f"k{i}", "orm") for i in range(extra)]
    frame = clean_keywords(spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(entries)], "keyword string, raw_type string, ordinal int"), 1)
    got = lambda d: sorted((r.n, r.keyword) for r in d.collect())
    small = Dictionary.of(LARGE)
    mine = {"words": got(L.match_words(df, "text", frame, ["n"])), "phrases": got(L.match_phrases(df, "text", frame, ["n"])),
            "any": got(L.match_any(df, "text", frame, ["n"])), "repo": got(L.match_repo(df, "repo", frame, ["n"]))}
    if not extra:
        exploded = lambda d, c: sorted((r.n, k) for r in d.collect() for k in (r[c] or []))
        assert mine["words"] == got(M.match_words(df, "text", small, ["n"]))
        assert mine["phrases"] == got(M.match_phrases(df, "text", small, ["n"]))
        assert mine["any"] == exploded(M.match_any(df, "text", small), "technologies")
        assert mine["repo"] == exploded(M.match_repo(df, "repo", small), "technologies")
    else:
        assert [k for n, k in mine["words"] if n == 5] == ["k19999", "k7"] and (5, "k3") in mine["repo"]
        with pytest.raises(ValueError, match="20009 entries"):
            Dictionary.from_frame(frame)
    messages = df.select("n", F.array(F.lower("text"), F.lit("go python")).alias("m")).where("text IS NOT NULL")
    assert got(L.match_messages(messages, "m", frame, ["n"])) >= [(1, "++")]
    capped = L.match_messages(messages, "m", frame, ["n"], cap=0)
    assert {r.keyword for r in capped.where("n = 3").collect()} == {"go", "python"} and capped.where("n = 1 AND keyword = 'python'").count() == 1
    tech = spark.createDataFrame([("Python",), ("k7",), ("django",), (None,)], "technology string")
    found = {r.technology: r.technology_category for r in L.categorize(tech, frame).collect()}
    assert found["Python"] == "language" and found["k7"] == ("library" if extra else "development_tool") and found["django"] == "language"
