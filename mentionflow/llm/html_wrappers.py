"""Main text of pages by wrappers that are inferred per host.

Every page becomes a stream of blocks: the path of block elements above a run of text.
Runs that repeat are folded into repeated groups, so that pages of one template have few
different streams. The streams of a host are aligned again and again until one wrapper is
left, a union-free regular expression: what both sides have stays required, what only one
side has becomes optional, what repeats anywhere is repeated. Every page is then aligned with
the wrapper of its host, and the texts at each item are compared over the host's articles: an
item with one text in different articles is template, one whose text differs is a slot. A
page's main text is what it has in slots whose paths belong to the article.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import ship_code
from .url_graph import url_host

ship_code(__name__)

#: Different streams of a host that one task aligns at a time.
ALIGNED_AT_ONCE = 64
#: Longest group of blocks that is looked for as a repetition.
LONGEST_GROUP = 6

# Elements of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object")
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
             "span strike strong sub sup time tt u var wbr".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
CLOSES |= {k: {"p"} for k in ("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                              "header hr main menu nav ol pre section table ul").split()}
#: Elements that hold an article, and those that never belong to one.
ARTICLE = {"article", "main"}
APART = set("nav menu footer aside form button select dialog head".split())
#: Words in class, id and role that mark a part as none of the article.
APART_WORDS = set("ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
                  "notice notification alert popup modal sidebar side comment comments reply replies respond discussion disqus menu "
                  "nav navbar navigation breadcrumb breadcrumbs footer header masthead social share sharing related recommended "
                  "newsletter subscribe subscription signup login search pagination pager widget toolbar complementary contentinfo".split())
#: Words that such a mark may be joined with ("ad-container"); with any other it says something else ("no-sidebar", "related-work").
PLAIN_WORDS = set("area bar block box button buttons container inner item items link links list outer section wrap wrapper".split())
#: Headings are never apart by their marks, but by what holds them.
HEADINGS = {f"h{n}" for n in range(1, 7)}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_MARKS = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>|\Z", re.I) for name in RAW}
_DIGITS = re.compile(r"\d+")


def _step(name: str, attributes: str) -> str:
    """Path step of an element: its name and the words of class, id and role, digits left out."""
    if not attributes:
        return name
    words = " ".join(a or b or c for a, b, c in _MARKS.findall(attributes)).lower().split()
    return ".".join([name, *dict.fromkeys(_DIGITS.sub("", w).replace("/", "") for w in words)])


def blocks(page: str) -> list[tuple[str, str]]:
    """(path, text) of every block with text, in page order; inline elements do not end a block.

    Handles what real pages have: elements left open, stray ends, comments, raw text, tags
    cut off at the end of the page.
    """
    found, open_elements, at, pieces, size = [], [], 0, [], len(page)

    def end_block():
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                found.append(("/".join(step for _, step in open_elements), text))
            pieces.clear()

    while at < size:
        token = _TOKEN.search(page, at)
        if token is None:
            rest = page[at:]
            cut = re.search(r"<[a-zA-Z/!?][^<]*\Z", rest)
            pieces.append(rest[:cut.start()] if cut else rest)
            break
        if token.start() > at:
            pieces.append(page[at:token.start()])
        at = token.end()
        name = (token[2] or "").lower()
        if not name or name in INLINE:
            continue
        if token[1]:
            for depth in range(len(open_elements) - 1, -1, -1):
                if open_elements[depth][0] == name:
                    end_block()
                    del open_elements[depth:]
                    break
            continue
        end_block()
        if name in VOID:
            continue
        if name in _RAW_END:
            at = _RAW_END[name].search(page, at).end() if not token[3].endswith("/") else at
            continue
        closed = CLOSES.get(name)
        while closed and open_elements and open_elements[-1][0] in closed:
            open_elements.pop()
        if not token[3].endswith("/"):
            open_elements.append((name, _step(name, token[3])))
    end_block()
    return found


# --- wrappers: lists of items [paths of the group, is it optional, does it repeat] ---

def fold(paths: list[str]) -> list[list]:
    """A stream with its repetitions folded, shortest groups first."""
    return [[group, False, times > 1] for group, times in _folded(paths)]


def _folded(paths: list[str]) -> list[tuple[list[str], int]]:
    """The groups of a stream and how often each follows itself."""
    items, at = [], 0
    while at < len(paths):
        best = 1, 1
        for group in range(1, LONGEST_GROUP + 1):
            times = 1
            while paths[at + times * group:at + (times + 1) * group] == paths[at:at + group]:
                times += 1
            if times > 1:
                best = group, times
                break
        group, times = best
        items.append((paths[at:at + group], times))
        at += group * times
    return items


def _matches(a: list[list], b: list[list]) -> list[tuple[int, int]]:
    """Longest common subsequence of two item lists, by the paths of the groups."""
    start = 0
    while start < min(len(a), len(b)) and a[start][0] == b[start][0]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end][0] == b[-1 - end][0]:
        end += 1
    left, right = a[start:len(a) - end], b[start:len(b) - end]
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i in range(len(left) - 1, -1, -1):
        for j in range(len(right) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if left[i][0] == right[j][0] else max(best[i + 1][j], best[i][j + 1])
    pairs, i, j = [(k, k) for k in range(start)], 0, 0
    while i < len(left) and j < len(right):
        if left[i][0] == right[j][0]:
            pairs.append((start + i, start + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs + [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]


def align(a: list[list], b: list[list]) -> list[list]:
    """The wrapper of both: common items stay, others become optional, repetition of either holds."""
    merged, i, j = [], 0, 0
    for x, y in [*_matches(a, b), (len(a), len(b))]:
        merged += [[item[0], True, item[2]] for item in a[i:x] + b[j:y]]
        if x < len(a):
            merged.append([a[x][0], a[x][1] or b[y][1], a[x][2] or b[y][2]])
        i, j = x + 1, y + 1
    return merged


def expression(wrapper: list[list]) -> str:
    """The wrapper as a regular expression over block paths."""
    return " ".join(f"({' '.join(group)})" + ("+" if repeats else "") + ("?" if optional else "") for group, optional, repeats in wrapper)


def in_article(path: str) -> bool:
    return any(step.partition(".")[0] in ARTICLE for step in path.split("/"))


def is_marked(name: str, words: list[str]) -> bool:
    """Whether class, id or role say that an element is none of the article: by a whole name, not by a part of one."""
    if name in HEADINGS or name in ("html", "body"):
        return False
    return any(parts & APART_WORDS and parts <= APART_WORDS | PLAIN_WORDS for parts in (set(re.split(r"[-_:]+", w)) - {""} for w in words))


def is_apart(path: str, holders: frozenset[str] = frozenset()) -> bool:
    """Whether a path leads through something that is not the article; the marks of ``holders`` (paths) do not count."""
    inside, above = False, []
    for step in path.split("/"):
        name, *words = step.split(".")
        inside = inside or name in ARTICLE
        above.append(step)
        if name in APART or name == "header" and not inside or is_marked(name, words) and "/".join(above) not in holders:
            return True
    return False


def article_holders(paths: set[str]) -> frozenset[str]:
    """Paths of the elements, down to the article elements, that hold all blocks of articles."""
    plain = lambda path: "/".join(step.partition(".")[0] for step in path.split("/"))
    held = [path.split("/") for path in paths if in_article(path) and not is_apart(plain(path))]
    common = next(iter(held), [])
    for steps in held:
        common = common[:next((k for k, (x, y) in enumerate(zip(common, steps)) if x != y), min(len(common), len(steps)))]
    last = max((k for k, step in enumerate(common) if step.partition(".")[0] in ARTICLE), default=len(common) - 1)
    return frozenset("/".join(common[:k + 1]) for k in range(last + 1))


def content_slots(wrapper: list[list]) -> set[str]:
    """Paths of the slots that hold the main text.

    Those in an article element if the wrapper has any that counts, otherwise all that are
    not apart; text outside any block element has the empty path.
    """
    paths = {path for group, *_ in wrapper for path in group}
    holders = article_holders(paths)
    kept = {path for path in paths if not is_apart(path, holders)}
    return {path for path in kept if in_article(path)} or kept


def _aligned(page: str, wrapper: list[list]) -> tuple[list[tuple[str, str]], list[list], list[tuple[int, int, int]]]:
    """A page's blocks, its folded items, and (item of the wrapper, its first block, the block after it) of what fits the wrapper."""
    stream = blocks(page)
    folded = _folded([path for path, _ in stream])
    ends = [0]
    for group, times in folded:
        ends.append(ends[-1] + len(group) * times)
    items = [[group, False, times > 1] for group, times in folded]
    return stream, items, [(i, ends[j], ends[j + 1]) for i, j in _matches(wrapper, items)]


def _slots_of(wrapper: list[list], items: list[list], fitting: list[tuple[int, int, int]]) -> set[str]:
    """Content slots of a page: those of its wrapper, or of its own stream if it has none of the wrapper's."""
    return content_slots(wrapper) & {path for i, _, _ in fitting for path in wrapper[i][0]} or content_slots(items)


def read_page(page: str, wrapper: list[list], template: frozenset[int] = frozenset()) -> str:
    """Main text of a page: its stream is aligned with the wrapper and the content slots are joined.

    What stands at the wrapper's ``template`` items (their indices) is left out. A page with
    none of the wrapper's article slots is read by its own stream.
    """
    stream, items, fitting = _aligned(page, wrapper)
    slots = _slots_of(wrapper, items, fitting)
    dropped = {at for i, start, end in fitting if i in template for at in range(start, end)}
    return " ".join(text for at, (path, text) in enumerate(stream) if path in slots and at not in dropped)


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def item_texts(page: str, wrapper: list[list]) -> tuple[int, list[tuple[int, int, bool, int]]]:
    """What tells the page's article from others, and (item of the wrapper, hash of its text, is it content, characters).

    Articles are told apart by their longest block, so copies of one are one, whatever date or notice they carry.
    """
    stream, items, fitting = _aligned(page, wrapper)
    slots = _slots_of(wrapper, items, fitting)
    article = max((text for path, text in stream if path in slots), key=lambda text: (len(text), text), default="")
    return _hash(article), [(i, _hash("\n".join(text for _, text in stream[start:end])), any(path in slots for path, _ in stream[start:end]),
                             sum(len(text) for _, text in stream[start:end])) for i, start, end in fitting]


# --- Spark ---

def _streams(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"host": batch["host"], "stream": [json.dumps(fold([p for p, _ in blocks(h)])) for h in batch["html"]]})


def _align_all(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    ordered = sorted(rows["stream"], key=lambda s: (-len(s), s))
    wrapper = json.loads(ordered[0])
    for stream in ordered[1:]:
        wrapper = align(wrapper, json.loads(stream))
    return pd.DataFrame({"host": [key[0]], "stream": [json.dumps(wrapper)]})


def wrappers(pages: DataFrame) -> DataFrame:
    """One wrapper per host (``host``, ``stream`` as JSON) from all its pages (``host``, ``html``).

    Equal streams of a host are counted once before anything is aligned. Then rounds of
    small groups of different streams, until every host has one; a host with most of the
    pages only has more groups.
    """
    streams = pages.mapInPandas(_streams, "host string, stream string").distinct()
    while True:
        streams = materialize(streams, "wrappers")
        counts = streams.groupBy("host").agg(F.count("*").alias("streams"))
        if counts.where("streams > 1").isEmpty():
            return streams
        groups = F.pmod(F.xxhash64("stream"), F.ceil(F.col("streams") / ALIGNED_AT_ONCE))
        split = streams.join(counts.withColumnRenamed("host", "of"), F.col("host") == F.col("of")).withColumn("groups", groups)
        streams = split.groupBy("host", "groups").applyInPandas(_align_all, "host string, stream string").distinct()


def _item_texts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """By host and item of its wrapper: least and largest hash of its texts and of the articles it is in, whether it is content, characters and pages."""
    parsed: dict[str, list] = {}
    for batch in batches:
        found: dict[tuple, list] = {}
        for host, page, stream in zip(batch["host"], batch["html"], batch["stream"]):
            if stream not in parsed:
                parsed.clear()
                parsed[stream] = json.loads(stream)
            article, texts = item_texts(page, parsed[stream])
            for item, text, content, chars in texts:
                x = found.setdefault((host, item), [text, text, article, article, False, 0, 0])
                x[:] = min(x[0], text), max(x[1], text), min(x[2], article), max(x[3], article), x[4] or content, x[5] + chars, x[6] + 1
        yield pd.DataFrame([(*key, *x) for key, x in found.items()], columns=_ITEM_COLUMNS)


_ITEM_COLUMNS = ["host", "item", "least", "most", "first", "last", "content", "chars", "pages"]


def template_items(pages: DataFrame, found: DataFrame) -> DataFrame:
    """``host`` and ``template``: the items of its wrapper whose text is the same in different articles, over all its pages.

    Only where they have less of the content than the slots: otherwise the host's pages are
    near copies of one article, which tell nothing of its template.
    """
    rows = pages.join(found, F.col("host") == F.col("of")).select("host", "html", "stream")
    texts = rows.mapInPandas(_item_texts, "host string, item int, least long, most long, first long, last long, content boolean, chars long, pages long")
    items = texts.groupBy("host", "item").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.min("first").alias("first"), F.max("last").alias("last"),
                                              F.max("content").alias("content"), F.sum("chars").alias("chars"), F.sum("pages").alias("pages"))
    same = (F.col("least") == F.col("most")) & (F.col("first") != F.col("last"))
    share = lambda which: F.sum(F.when(F.col("content") & which, F.col("chars") / F.col("pages")).otherwise(0.0))
    hosts = items.groupBy("host").agg(F.collect_list(F.when(same, F.col("item"))).alias("template"), share(same).alias("fixed"), share(~same).alias("varied"))
    return materialize(hosts.where((F.size("template") > 0) & (F.col("fixed") < F.col("varied"))).select("host", "template"), "template-items")


def _texts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parsed: dict[str, list] = {}
    for batch in batches:
        out = []
        for page, stream, template in zip(batch["html"], batch["stream"], batch["template"]):
            if stream not in parsed:
                parsed.clear()
                parsed[stream] = json.loads(stream)
            out.append(read_page(page, parsed[stream], frozenset(() if template is None else (int(i) for i in template))))
        yield pd.DataFrame({"key": batch["key"].astype("Int64"), "url": batch["url"], "text": out})


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, ``url``, ``text`` (main text, empty if none) and ``n_chars`` of every page.

    NULL and empty pages have no text; pages of NULL urls share the wrapper of the empty
    host; repeated rows are rows each; an empty table gives no rows. Other columns are not used.
    """
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"),
                        F.coalesce(url_host(F.col(url)), F.lit("")).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    found = wrappers(rows.select("host", "html")).withColumnRenamed("host", "of")
    marks = template_items(rows.select("host", "html"), found)
    # written, so that Spark knows its size and need not shuffle the pages by host
    found = materialize(found.join(marks, F.col("of") == F.col("host"), "left").select("of", "stream", "template"), "marked-wrappers")
    joined = rows.join(found, F.col("host") == F.col("of")).select("key", "url", "html", "stream", "template")
    texts = joined.mapInPandas(_texts, "key long, url string, text string")
    return texts.select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
