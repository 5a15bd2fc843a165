"""Event text: which parts are searched, and how keywords are found in them."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ..sources.dictionary import Dictionary, word_runs
from .base import bind, keep_in, quoted, strings

# --- Fixed values: which event types count and how much of each text is searched ---
MENTION_EVENT_TYPES = ["PushEvent", "PullRequestEvent"]
BODY_CHARS = 500
SEARCH_COMMITS = 3
COMMIT_CHARS = 200
DESCRIPTION_CHARS = 200
ISSUE_TITLE_CHARS = 100
STORED_TEXT_CHARS = 300
KEYWORD_CAP = 10
REPO_FALLBACK_KEYWORDS = 20
SUBSTRING_MIN_CHARS = 4
LIVE_LIMITS = {"commits": SEARCH_COMMITS, "commit_chars": COMMIT_CHARS, "description_chars": DESCRIPTION_CHARS,
               "title_chars": ISSUE_TITLE_CHARS}
# --- end of fixed values ---

# Up to this many long keywords a direct substring test is as fast as scanning 4-grams.
DIRECT_SUBSTRINGS = 100

# Letters, digits, underscore; plain ASCII is named first because it is tested first.
_WORD_RUN = r"[a-z0-9_\p{L}\p{N}]++"


def _head(text: Column, chars: int | None) -> Column:
    return text if chars is None else F.substring(text, 1, chars)


def _present(parts: Column) -> Column:
    return F.filter(parts, lambda p: p.isNotNull() & (p != ""))


def event_messages(event_type: Column, payload: Column, body_chars: int | None = None) -> Column:
    """Ordered lower-cased messages: commit messages of a push, title and body of a pull request.

    ``body_chars`` limits the pull-request body (the live format has BODY_CHARS).
    """
    commits = F.transform(payload["commits"], lambda c: F.lower(c["message"]))
    pull = payload["pull_request"]
    request = F.array(F.lower(pull["title"]), F.lower(_head(pull["body"], body_chars)))
    messages = (F.when(event_type == "PushEvent", commits)
                .when(event_type == "PullRequestEvent", request))
    return F.coalesce(_present(messages), F.array().cast("array<string>"))


def searchable_text(event_type: Column, repo_name: Column, actor: Column, payload: Column,
                    commits: int | None = None, commit_chars: int | None = None,
                    description_chars: int | None = None,
                    title_chars: int | None = None) -> Column:
    """Repository, type, actor and the payload texts of the event type, joined by spaces.

    All of each text counts unless it is limited; LIVE_LIMITS are those of the live format.
    """
    pushed = _present(F.transform(payload["commits"], lambda c: c["message"]))
    if commits is not None:
        pushed = _present(F.transform(F.slice(payload["commits"], 1, commits), lambda c: c["message"]))
    pushed = F.transform(pushed, lambda m: _head(F.lower(m), commit_chars))
    by_type = (
        F.when(event_type == "PushEvent", pushed)
        .when(event_type == "PullRequestEvent", F.array(
            F.lower(payload["pull_request"]["title"]), F.lower(payload["pull_request"]["head"]["ref"])))
        .when(event_type == "CreateEvent", F.array(
            _head(F.lower(payload["description"]), description_chars), F.lower(payload["ref"])))
        .when(event_type == "ReleaseEvent", F.array(
            F.lower(payload["release"]["name"]), F.lower(payload["release"]["tag_name"])))
        .when(event_type == "IssuesEvent", F.array(
            _head(F.lower(payload["issue"]["title"]), title_chars))))
    short_name = F.when(F.contains(repo_name, F.lit("/")),
                        F.lower(F.element_at(F.split(repo_name, "/"), -1)))
    parts = F.concat(
        F.array(F.lower(repo_name), short_name, F.lower(event_type), F.lower(actor)),
        F.coalesce(by_type, F.array().cast("array<string>")))
    return F.array_join(_present(parts), " ")


def tokens(text: Column) -> Column:
    """Maximal runs of letters, digits and underscore, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD_RUN), F.lit(0))


def whole_word_pattern(keyword: str) -> str:
    """Regex for ``\\b keyword \\b`` with Unicode word characters spelled out.

    A boundary next to a word character means "no word character beside it"; next to
    punctuation it means "a word character beside it" (so ``c++`` needs one after it).
    """
    # U+10400 is a letter anyway; naming one beyond 16 bits makes Java look behind by whole
    # characters instead of half ones
    word = "[\\p{L}\\p{N}_\U00010400]"

    def edge(char: str, ahead: bool) -> str:
        negate = bool(re.match(r"\w", char))
        return f"(?{'' if ahead else '<'}{'!' if negate else '='}{word})"

    return edge(keyword[0], False) + re.escape(keyword) + edge(keyword[-1], True)


def word_hits(words: Column, dictionary: Dictionary) -> Column:
    """Plain-word keywords among the tokens: a hash-set probe per token, no join, no shuffle.

    Exact, because a keyword made of word characters only matches as a whole token.
    """
    return F.array_distinct(keep_in(words, dictionary.plain_words()))


def phrase_hits(text: Column, words: Column, dictionary: Dictionary) -> Column:
    """Punctuated and multi-word keywords.

    Each word run inside such a keyword must occur as a whole token, so its longest run
    is the anchor: only keywords whose anchor is among the tokens meet the regex.
    """
    anchored: dict[str, list[str]] = {}
    loose: list[str] = []
    for keyword in dictionary.phrases():
        runs = word_runs(keyword)
        if runs:
            anchored.setdefault(max(runs, key=len), []).append(keyword)
        else:
            loose.append(keyword)

    def pairs(keywords: list[str]) -> str:
        return "array(%s)" % ", ".join(
            f"named_struct('keyword', {quoted(k)}, 'pattern', {quoted(whole_word_pattern(k))})" for k in keywords)

    def hits(lowered: Column, tokens_of: Column) -> Column:
        found = []
        if anchored:
            lookup = F.expr("map(%s)" % ", ".join(f"{quoted(a)}, {pairs(ks)}" for a, ks in anchored.items()))
            anchors = F.array_distinct(keep_in(tokens_of, list(anchored)))
            found.append(F.flatten(F.transform(anchors, lambda t: lookup[t])))
        if loose:
            found.append(F.expr(pairs(loose)))
        kept = F.filter(F.concat(*found), lambda c: F.contains(lowered, c["keyword"])
                        & F.rlike(lowered, c["pattern"]))
        return F.transform(kept, lambda c: c["keyword"])

    if not anchored and not loose:
        return F.array().cast("array<string>")
    return bind(F.lower(text), lambda lowered: hits(lowered, words))


def whole_word_hits(text: Column, dictionary: Dictionary) -> Column:
    """All keywords that occur in the text as whole words, each once."""
    if not dictionary.phrases():
        return word_hits(tokens(text), dictionary)
    return bind(tokens(text), lambda words: F.array_distinct(
        F.concat(word_hits(words, dictionary), phrase_hits(text, words, dictionary))))


def capped_hits(messages: Column, dictionary: Dictionary, cap: int | None = None) -> Column:
    """Distinct keywords of an event; with a ``cap``, later messages are skipped once more than that are found.

    The message that passes the cap still counts in full.
    """
    if cap is None:
        return F.array_distinct(F.flatten(F.transform(messages, lambda m: whole_word_hits(m, dictionary))))
    none = F.array().cast("array<string>")
    return F.aggregate(messages, none, lambda found, message: F.when(F.size(found) > cap, found)
                       .otherwise(F.array_union(found, whole_word_hits(message, dictionary))))


def any_hits(text: Column, dictionary: Dictionary) -> Column:
    """Keywords that are a token of the text, or longer than three characters and anywhere in it.

    Tokens are probed against a hash set. For the substring test a moderate dictionary is
    tried keyword by keyword. A larger one is narrowed first: only keywords whose leading
    four characters occur in the text, found by probing its character 4-grams, are tried.
    Both ways are exact.
    """
    exact = keep_in(tokens(text), dictionary.keywords())
    long = [k for k in dictionary.keywords() if len(k) >= SUBSTRING_MIN_CHARS]
    if not long:
        return F.array_sort(F.array_distinct(exact))

    def inside(lowered: Column) -> Column:
        candidates = strings(long) if len(long) <= DIRECT_SUBSTRINGS else _leading_gram_candidates(lowered, long)
        return F.filter(candidates, lambda k: F.contains(lowered, k))

    return F.array_sort(F.array_distinct(F.concat(exact, bind(F.lower(text), inside))))


def _leading_gram_candidates(lowered: Column, keywords: list[str]) -> Column:
    by_head: dict[str, list[str]] = {}
    for keyword in keywords:
        by_head.setdefault(keyword[:SUBSTRING_MIN_CHARS], []).append(keyword)
    grams = F.regexp_extract_all(lowered, F.lit(r"(?s)(?=(.{%d}))" % SUBSTRING_MIN_CHARS), F.lit(1))
    heads = F.array_distinct(keep_in(grams, list(by_head)))
    lookup = F.expr("map(%s)" % ", ".join(
        f"{quoted(h)}, array({', '.join(map(quoted, ks))})" for h, ks in by_head.items()))
    return F.flatten(F.transform(heads, lambda h: lookup[h]))


def repo_hits(repo_name: Column, dictionary: Dictionary,
              fallback: int | None = None) -> Column:
    """Keywords among the parts of a repository name.

    When no part is a keyword, the longest keyword that is a substring is taken instead;
    ``fallback`` tries only so many of the longest.
    """
    parts = F.split(F.translate(F.lower(repo_name), "/-._", "    "), r"(?U)\s+")
    exact = F.array_sort(F.array_distinct(keep_in(parts, dictionary.keywords())))
    longest = strings(dictionary.longest(fallback or len(dictionary.entries)))
    inside = bind(F.lower(repo_name), lambda name: F.slice(
        F.filter(longest, lambda k: F.contains(name, k)), 1, 1))
    hits = bind(exact, lambda found: F.when(F.size(found) > 0, found).otherwise(inside))
    return F.coalesce(hits, F.array().cast("array<string>"))
