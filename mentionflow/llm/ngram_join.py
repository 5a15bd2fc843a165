"""Similarity join of documents on word shingles, by R-trees over count vectors.

A document's shingles are hashed into groups; the group counts are a point. The sum of
coordinate minima of two points bounds the overlap of the two sets from above, and so does
the sum with the largest counts of a tree node for all points below it. Pairs that survive
the bound are verified on the sets.

Points of unlike texts are all near each other in so many dimensions, so one tree over the
corpus would have to be walked as a whole for each of them. The forest is planted first:
two sets that may link differ in at most r shingles, so of r + 1 parts into which the
shingles are dealt one is equal in both. The first document that has a part is its hub; a
hub and the documents tied to it by equal parts are a group, and each group gets its trees.
Two documents that could link always share a group.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import bounded, pieces, ship_code
from .graph import components

ship_code(__name__)


@dataclass(frozen=True)
class Rule:
    """Words in a shingle, and the similarity from which documents link: ``num`` / ``den``."""

    width: int = 3
    num: int = 90
    den: int = 100

    def __post_init__(self):
        if not (self.width > 0 and 0 < self.num < self.den):
            raise ValueError("a rule takes at least one word and a similarity between 0 and 1")

    @functools.cached_property
    def bands(self) -> np.ndarray:
        """Least sizes of the bands. Below the first, sets that link are equal."""
        found = [max(1, self.num // (self.den - self.num))]
        while found[-1] < 1 << 40:
            found.append(max(found[-1] + 1, int(found[-1] * BAND)))
        return np.array(found, np.int64)

    def differing(self, band: int) -> int:
        """Shingles in which linked sets of sizes below the end of a band differ at most."""
        return int(2 * (self.bands[band + 1] - 1) * (self.den - self.num) // (self.den + self.num))

    def spare(self, band: int) -> int:
        """Parts beyond the least number with which a scheme begins: about those that stay empty in its smallest sets."""
        parts = self.differing(band) + 1
        return int(np.ceil(1.4 * parts * np.exp(-self.num / self.den * self.bands[band] / parts)))

    def overlap_needed(self, a, b):
        """Least overlap of linked sets of sizes a and b (or at least those)."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Exact test on two sets."""
        if not len(a) or not len(b):
            return False
        common = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * common >= self.num * (len(a) + len(b) - common)

    def may_link(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether the points of two sets allow a link."""
        return int(np.minimum(point(a), point(b)).sum()) >= self.overlap_needed(len(a), len(b))


#: Groups of shingles: dimensions of the points.
GROUPS = 64
#: Points in a leaf of a tree, and children of a node.
FANOUT = 16
#: Shingles of the documents that one task holds on one side of a group.
BLOCK_SHINGLES = 1_000_000
#: So many characters of text weigh as much as a shingle, should words be long.
CHARS_PER_SHINGLE = 8
#: Sizes in a band grow by this factor; documents of a band and near its end share schemes.
BAND = 1.5

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers, stirred."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered for a batch."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, hashes: WordHashes, rule: Rule = Rule()) -> np.ndarray:
    """Sorted distinct hashes of the shingles; of the whole sequence if it has fewer words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter((hashes[w] for w in words), np.uint64, len(words))
    width = min(rule.width, len(codes))
    out = np.full(len(codes) - width + 1, width, np.uint64)
    for k in range(width):
        out = mixed(out * _M1 + codes[k:len(codes) - width + 1 + k])
    return np.unique(out)


def part_keys(shingles: np.ndarray, rule: Rule = Rule()) -> np.ndarray:
    """Keys of the parts of a set; sets that link and are not equal have one in common.

    With r + 1 + e parts at least e + 1 are equal. Empty parts make no key: should all
    equal parts be empty, both sets have more than e empty parts, and then both are dealt
    into more parts as well. The first e is near the number of parts that stay empty anyway,
    so that hardly any set needs a second deal.
    """
    n = len(shingles)
    bands = rule.bands
    if n < bands[0]:
        return np.empty(0, np.int64)
    band = int(np.searchsorted(bands, n, "right")) - 1
    schemes = [band] + ([band + 1] if n * rule.den >= rule.num * bands[band + 1] else [])
    low, high = (shingles & np.uint64(0xFFFFFFFF)).astype(float), (shingles >> np.uint64(32)).astype(float)
    spread = mixed(shingles + _M1) >> np.uint64(20)
    keys = []
    for scheme in schemes:
        extra = rule.spare(scheme)
        while True:
            parts = rule.differing(scheme) + 1 + extra
            place = (spread % np.uint64(parts)).astype(np.int64)
            counts = np.bincount(place, minlength=parts)
            full = np.flatnonzero(counts)
            sums = [np.bincount(place, half, parts)[full].astype(np.uint64) for half in (low, high)]
            seed = np.uint64((scheme << 40) + extra) ^ _M1
            keys.append(mixed(mixed(mixed(sums[0] + seed) + sums[1]) + full.astype(np.uint64)))
            if parts - len(full) <= extra:
                break
            extra = max(3, 2 * extra)
    return np.concatenate(keys).view(np.int64)


def _summaries(rule: Rule, batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in pieces(batches):
        hashes = WordHashes()
        rows = []
        for text in batch["text"]:
            found = shingle_set(text, hashes, rule)
            rows.append((len(found), max(len(found), len(text or "") // CHARS_PER_SHINGLE), *(int(x) for x in np.array([found.sum(dtype=np.uint64), mixed(found).sum(dtype=np.uint64)]).view(np.int64)), part_keys(found, rule)))
        yield pd.DataFrame(rows, columns=["n", "weight", "sum_a", "sum_b", "parts"]).assign(doc_id=batch["doc_id"].astype("Int64").to_numpy())


def point(shingles: np.ndarray) -> np.ndarray:
    """Counts of the groups into which the shingles are hashed."""
    return np.bincount((shingles % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)


def _sets(rule: Rule, batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in pieces(batches):
        hashes = WordHashes()
        yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "shingles": [shingle_set(t, hashes, rule).view(np.int64) for t in batch["text"]]})


class Tree:
    """R-tree over points, packed in the order of size and coarse coordinates."""

    def __init__(self, points: np.ndarray):
        sizes = points.sum(1)
        coarse = points.reshape(len(points), 4, -1).sum(2)
        self.order = np.lexsort((*coarse.T, sizes))
        tops, least = points[self.order], sizes[self.order]
        self.levels = [(tops, least, least)]
        most = least
        while len(tops) > 1:
            starts = np.arange(0, len(tops), FANOUT)
            tops, least, most = np.maximum.reduceat(tops, starts), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)
            self.levels.append((tops, least, most))

    def search(self, point: np.ndarray, rule: Rule = Rule()) -> np.ndarray:
        """Indices of the points whose summed minima with this one reach the overlap they need."""
        size = int(point.sum())
        found = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            tops, least, most = self.levels[depth]
            if depth < len(self.levels) - 1:
                found = (found[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                found = found[found < len(tops)]
            found = found[(least[found] * rule.num <= size * rule.den) & (most[found] * rule.den >= size * rule.num)]
            bound = np.minimum(tops[found], point).sum(1)
            found = found[bound >= rule.overlap_needed(size, least[found])]
        return self.order[found]


class Sets:
    """Union-find over local indices."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.up[self.find(a)] = self.find(b)


def links_of_block(rows: pd.DataFrame, rule: Rule = Rule()) -> pd.DataFrame:
    """Links that join what was not yet joined, among ``left`` rows and between left and right ones.

    ``known`` marks the documents that are already known to hang together.
    """
    rows = rows.drop_duplicates("doc_id").sort_values(["left", "doc_id"], ascending=[False, True], ignore_index=True)
    sets = [np.asarray(s, np.int64).view(np.uint64) for s in rows["shingles"]]
    ids, known = rows["doc_id"].to_numpy(), np.flatnonzero(rows["known"].to_numpy())
    points = np.array([point(s) for s in sets])
    joined = Sets(len(ids))
    for i in known[1:]:
        joined.join(int(i), int(known[0]))
    tree, found = Tree(points), []
    for i in range(int(rows["left"].sum())):
        for j in tree.search(points[i], rule):
            if joined.find(i) != joined.find(int(j)) and rule.linked(sets[i], sets[j]):
                joined.join(i, int(j))
                found.append((ids[i], ids[j]))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def links_of_group(rows: pd.DataFrame, rule: Rule = Rule()) -> pd.DataFrame:
    """Links that hold a group together as far as it hangs together: those of the hub, the smallest id, then of the rest."""
    rows = rows.drop_duplicates("doc_id").sort_values("doc_id", ignore_index=True)
    sets = [np.asarray(s, np.int64).view(np.uint64) for s in rows["shingles"]]
    ids, found = rows["doc_id"].to_numpy(), []
    rest = []
    for j in range(1, len(ids)):
        if rule.may_link(sets[0], sets[j]) and rule.linked(sets[0], sets[j]):
            found.append((ids[0], ids[j]))
        else:
            rest.append(j)
    if rest and len(ids) > 2:
        joined = Sets(len(ids))
        for j in set(range(1, len(ids))) - set(rest):
            joined.join(j, 0)
        points = np.array([point(s) for s in sets])
        tree = Tree(points)
        for i in rest:
            for j in tree.search(points[i], rule):
                if joined.find(i) != joined.find(int(j)) and rule.linked(sets[i], sets[j]):
                    joined.join(i, int(j))
                    found.append((ids[i], ids[j]))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def links_of_texts(rows: pd.DataFrame, rule: Rule = Rule()) -> pd.DataFrame:
    """Links that hold a group of texts together."""
    rows, hashes = rows.drop_duplicates("doc_id"), WordHashes()
    return links_of_group(pd.DataFrame({"doc_id": rows["doc_id"].to_numpy(), "shingles": [shingle_set(t, hashes, rule).view(np.int64) for t in rows["text"]]}), rule)


def _verified(rule: Rule, batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of sets that link: the bound on the points first, then the sets themselves."""
    for batch in batches:
        keep = []
        for a, b in zip(batch["shingles_a"], batch["shingles_b"]):
            a, b = np.asarray(a, np.int64).view(np.uint64), np.asarray(b, np.int64).view(np.uint64)
            keep.append(rule.may_link(a, b) and rule.linked(a, b))
        yield batch.loc[keep, ["a", "b"]]


def linked_classes(docs: DataFrame, rule: Rule = Rule()) -> tuple[DataFrame, DataFrame]:
    """(summaries with the class of every row, links between class representatives)."""
    summary = materialize(docs.mapInPandas(functools.partial(_summaries, rule), "doc_id long, n long, weight long, sum_a long, sum_b long, parts array<long>"), "summaries")
    key = ["n", "sum_a", "sum_b"]
    classes = (summary.where(F.col("n") > 0).groupBy(*key).agg(F.min("doc_id").alias("class"), F.count("*").alias("rows"))
               .where("rows > 1").select(*[F.col(k).alias(f"c_{k}") for k in key], "class"))
    classes = bounded(materialize(classes, "classes"))
    rows = summary.join(classes, [F.col(k) == F.col(f"c_{k}") for k in key], "left").withColumn("class", F.coalesce("class", "doc_id"))
    # parts of one row per class
    parts = rows.where(F.col("class") == F.col("doc_id")).select("doc_id", "weight", F.explode("parts").alias("part"))
    tiles = (parts.groupBy("part").agg(F.min("doc_id").alias("a"), F.count("*").alias("rows"))
             .where("rows > 1").select(F.col("part").alias("tile"), "a"))
    tiles = bounded(materialize(tiles, "tiles"))
    pairs = (parts.join(tiles, F.col("part") == F.col("tile")).where(F.col("doc_id") != F.col("a"))
             .select("a", F.col("doc_id").alias("b"), "weight").distinct())
    pairs = materialize(pairs, "candidate-pairs")
    groups = materialize(pairs.groupBy("a").agg(F.sum("weight").alias("size")).select(F.col("a").alias("hub"), (F.col("size") > BLOCK_SHINGLES).alias("large")), "groups")
    sized = pairs.join(bounded(groups), F.col("a") == F.col("hub"))
    small = _link_groups(docs, sized.where(~F.col("large")).select("a", "b"), rule)
    large = sized.where("large").select("a", "b")
    if large.isEmpty():
        return rows, small
    large = materialize(large, "pairs-of-large-groups")
    sets = _sets_of(docs, large, rule)
    sets = materialize(sets.dropDuplicates(["doc_id"]), "tied-sets")
    near = _near_hubs(large, sets, rule)
    return rows, small.unionByName(near).unionByName(_search_groups(large, sets, near, rule))


def _sets_of(docs: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id`` and ``shingles`` of the documents in pairs."""
    tied = materialize(pairs.select(F.explode(F.array("a", "b")).alias("tied")).distinct(), "tied")
    found = docs.join(bounded(tied), F.col("doc_id") == F.col("tied")).select("doc_id", "text")
    return found.mapInPandas(functools.partial(_sets, rule), "doc_id long, shingles array<long>")


def _link_groups(docs: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """Links within groups that fit into a block, one task step for each group; every text is sent once for a group.

    A text is less than half as long as its set, whose hashes do not compress, so the sets are made where the group is.
    """
    members = materialize(pairs.select(F.col("a").alias("group"), F.col("b").alias("member"))
                          .unionByName(pairs.select(F.col("a").alias("group"), F.col("a").alias("member")).distinct()), "group-members")
    placed = docs.join(bounded(members), F.col("doc_id") == F.col("member")).select("group", "doc_id", "text")
    return materialize(placed.groupBy("group").applyInPandas(lambda rows: links_of_texts(rows, rule), "a long, b long"), "group-links")


def _near_hubs(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Links between the first document of a part, its hub, and the others that have it."""
    side = lambda name: sets.select(F.col("doc_id").alias(f"id_{name}"), F.col("shingles").alias(f"shingles_{name}"))
    joined = (pairs.join(side("b"), F.col("b") == F.col("id_b")).join(side("a"), F.col("a") == F.col("id_a"))
              .select("a", "b", "shingles_a", "shingles_b"))
    return materialize(joined.mapInPandas(functools.partial(_verified, rule), "a long, b long"), "hub-links")


def _search_groups(pairs: DataFrame, sets: DataFrame, near: DataFrame, rule: Rule) -> DataFrame:
    """Links within the groups of the hubs beyond those of the hub itself.

    Two documents that share a part are both in the group of that part's hub. What hangs on
    the hub is known to be one component, so only the rest is searched: against itself and
    against the known ones, in blocks of bounded size. A group that its hub holds together,
    or of one document beside the hub, needs no search.
    """
    linked = near.select(F.col("a").alias("hub"), F.col("b").alias("held"))
    marked = pairs.join(linked, (F.col("a") == F.col("hub")) & (F.col("b") == F.col("held")), "left").select(
        F.col("a").alias("group"), F.col("b").alias("member"), F.col("held").isNotNull().alias("known"))
    marked = materialize(marked, "group-members")
    open_groups = (marked.groupBy("group").agg(F.count("*").alias("n"), F.count_if("known").alias("held")).where("n > 1 AND held < n")
                   .select(F.col("group").alias("of")))
    open_groups = materialize(open_groups, "open-groups")
    members = marked.join(bounded(open_groups), F.col("group") == F.col("of")).select("group", "member", "known").unionByName(
        open_groups.select(F.col("of").alias("group"), F.col("of").alias("member"), F.lit(True).alias("known")))
    members = materialize(members.join(sets, F.col("member") == F.col("doc_id")).select("group", "doc_id", "known", "shingles"), "group-sets")
    sizes = members.groupBy("group").agg(
        F.sum(F.when(~F.col("known"), F.size("shingles")).otherwise(0)).alias("rest"), F.sum(F.when(F.col("known"), F.size("shingles")).otherwise(0)).alias("held"))
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / BLOCK_SHINGLES)).cast("int")
    sizes = materialize(sizes.select(F.col("group").alias("of"), blocks("rest").alias("rest_blocks"), blocks("held").alias("held_blocks")), "group-sizes")
    placed = members.join(bounded(sizes), F.col("group") == F.col("of"))
    own = F.when(F.col("known"), F.col("rest_blocks") + F.pmod(F.xxhash64("doc_id"), F.col("held_blocks"))).otherwise(
        F.pmod(F.xxhash64("doc_id"), F.col("rest_blocks"))).cast("int")
    placed = placed.withColumn("own", own)
    # a block of the rest meets itself, the blocks of the rest after it and all known blocks
    lefts = F.transform(F.sequence(F.col("own"), F.col("rest_blocks") + F.col("held_blocks") - 1), lambda j: F.struct(F.col("own").alias("i"), j.alias("j"), F.lit(True).alias("left")))
    before = F.transform(F.sequence(F.lit(0), F.least(F.col("own"), F.col("rest_blocks")) - 1), lambda i: F.struct(i.alias("i"), F.col("own").alias("j"), F.lit(False).alias("left")))
    tasks = F.when(F.col("known"), before).when(F.col("own") == 0, lefts).otherwise(F.concat(lefts, before))
    units = placed.select("group", "doc_id", "known", "shingles", F.explode(tasks).alias("unit")).select("group", "doc_id", "known", "shingles", "unit.*")
    return units.groupBy("group", "i", "j").applyInPandas(lambda rows: links_of_block(rows, rule), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``class_id`` and ``component_id`` of every row.

    ``class_id`` is the smallest id with the same set, ``component_id`` the smallest that is
    reachable by links. NULL and empty texts have no shingles, no class but their own and no
    links. Rows with one id are one node; a NULL id stays alone with a NULL component. An
    empty table gives no rows. Other columns are not used.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    classes, links = linked_classes(rows, rule)
    found = materialize(components(links), "components")
    out = classes.join(found, F.col("class") == F.col("node"), "left")
    return out.select(F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("class").alias("class_id"),
                      F.coalesce("component", "class").alias("component_id"))
