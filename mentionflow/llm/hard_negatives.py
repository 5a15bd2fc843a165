"""Hard-negative mining by coordinate pruning over length buckets.

Rows are dealt into groups of bounded size, and each block of anchors meets each group of
rows that may hold its answers. Inside a group the rows lie in buckets of like vector
length, each with a sorted list per coordinate. What an anchor must reach (the least score
that still counts) bounds the angle to its answers; that angle gives a range of values for
each coordinate, and the candidates are the rows that lie in the ranges of all of the
anchor's focus coordinates. Candidates are then verified by their exact scores.

A first pass over a sixteenth of the groups gives every anchor and positive a score that its
answers certainly reach, so the second pass prunes from the start and returns few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .common import bounded, ship_code

#: Rows of a group and anchors of a block, on average; both are dealt by hash.
GROUP_ROWS, BLOCK_ANCHORS = 1 << 14, 1 << 10
#: Groups of which the first pass takes one.
FIRST_OF = 16
#: Rows of a bucket at most, and the least length in it as a share of the greatest.
BUCKET_ROWS, LIKE = 4096, 0.9
#: Coordinates whose ranges are intersected: those where the anchor is greatest.
FOCUS = 4
#: Anchors scored at once.
AT_ONCE = 128
#: Share of a bucket above which its rows are scored at once: ranges as wide as that select nothing.
WIDE = 0.25
#: How far rounding may move a value of a unit vector (arccos loses half of the digits near 1).
ROUNDED = 1e-7
#: Sums of whole numbers are exact in doubles below this.
EXACT = 2.0 ** 53
MOST = 2 ** 63 - 1

FOUND = "anchor_id long, positive_id long, found_id long, score long"


class Bucket:
    """Rows of like length: their vectors and a sorted list per coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        self.ids, self.labels, self.vectors, self.longest = ids, labels, vectors, lengths[0]
        unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.values = np.take_along_axis(unit, self.order, axis=0)

    def candidates(self, unit: np.ndarray, cosines: np.ndarray) -> list[np.ndarray | None]:
        """For each anchor (unit vector) the rows that may have at least its cosine; None: take all, () : none.

        A row within the angle arccos(cosine) of the anchor has in a coordinate, where the
        anchor has the angle a, a value between cos(a + angle) and cos(a - angle).
        """
        angle = np.arccos(np.clip(cosines, -1, 1))[:, None]
        focus = np.argsort(-np.abs(unit), axis=1)[:, :FOCUS]
        at = np.arccos(np.clip(np.take_along_axis(unit, focus, axis=1), -1, 1))
        low, high = np.cos(np.minimum(np.pi, at + angle)) - ROUNDED, np.cos(np.maximum(0, at - angle)) + ROUNDED
        first, last = np.zeros(focus.shape, "i8"), np.zeros(focus.shape, "i8")
        for f in np.unique(focus):
            here = focus == f
            first[here] = np.searchsorted(self.values[:, f], low[here], "left")
            last[here] = np.searchsorted(self.values[:, f], high[here], "right")
        out: list[np.ndarray | None] = []
        for k, cosine in enumerate(cosines):
            if cosine > 1 + ROUNDED:
                out.append(np.zeros(0, "i8"))
            elif cosine <= -1 or not focus.shape[1] or (last[k] - first[k]).min() > WIDE * len(self.ids):
                out.append(None)
            else:
                met = np.zeros(len(self.ids), "i1")
                for f, a, b in zip(focus[k], first[k], last[k]):
                    met[self.order[a:b, f]] += 1
                out.append(np.flatnonzero(met == len(focus[k])))
        return out


def buckets(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Iterator[Bucket]:
    """A group's rows by descending length, cut into buckets."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    order = np.lexsort((ids, -lengths))
    start = 0
    while start < len(order):
        least = LIKE * lengths[order[start]]
        end = min(start + BUCKET_ROWS, start + int(np.searchsorted(-lengths[order[start:]], -least, "right")))
        part = order[start:end]
        yield Bucket(ids[part], labels[part], vectors[part], lengths[part])
        start = end


def exact_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered vectors, exactly; what no long holds becomes the nearest long."""
    if not anchors.size or not rows.size or np.abs(anchors).max() * np.abs(rows).max() * anchors.shape[1] < EXACT:
        return (anchors @ rows.T).astype("i8")
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return np.clip(whole(anchors).dot(whole(rows).T), -MOST, MOST).astype("i8")


class Best:
    """The best rows so far of each wanted list: lists have bounds of score, and hold ``most`` rows."""

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int):
        self.low, self.high, self.most = low.copy(), high, most
        self.lists, self.ids, self.scores = (np.zeros(0, "i8") for _ in range(3))

    def add(self, lists: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        lists, ids, scores = np.concatenate([self.lists, lists]), np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores, lists))
        lists, ids, scores = lists[order], ids[order], scores[order]
        starts = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]]) if len(lists) else np.zeros(0, "i8")
        rank = np.arange(len(lists)) - np.repeat(starts, np.diff(np.r_[starts, len(lists)]))
        self.lists, self.ids, self.scores = (x[rank < self.most] for x in (lists, ids, scores))
        full = rank == self.most - 1
        self.low[lists[full]] = np.maximum(self.low[lists[full]], scores[full])


def search(anchors: pd.DataFrame, rows: pd.DataFrame, scale: int, most: int, same_label: bool) -> pd.DataFrame:
    """FOUND: for each wanted list of a block of anchors its best ``most`` rows of a group.

    ``anchors``: anchor_id, label, vector and, as lists of one length, ``positives``, ``low``
    and ``high``: wanted are rows of the same label (or of others) with low <= score <= high.
    Ties go to the smaller id.
    """
    whole = lambda frame: np.floor(scale * np.stack(frame["vector"].to_numpy()).astype("f8"))
    mine, their_ids, their_labels = whole(anchors), rows["vec_id"].to_numpy("i8"), rows["label"].to_numpy("i8")
    sizes = anchors["low"].map(len).to_numpy()
    owner = np.repeat(np.arange(len(anchors)), sizes)
    first = np.r_[0, np.cumsum(sizes)]
    best = Best(np.concatenate(anchors["low"].to_numpy()).astype("i8"), np.concatenate(anchors["high"].to_numpy()).astype("i8"), most)
    own_ids, own_labels = anchors["anchor_id"].to_numpy("i8"), anchors["label"].to_numpy("i8")
    lengths = np.sqrt((mine * mine).sum(axis=1))
    unit = mine / np.where(lengths > 0, lengths, 1)[:, None]
    for bucket in buckets(their_ids, their_labels, whole(rows)):
        for start in range(0, len(anchors), AT_ONCE):
            block = np.arange(start, min(start + AT_ONCE, len(anchors)))
            # the least score that any of an anchor's lists still takes
            needed = np.minimum.reduceat(best.low, first[:-1])[block].astype("f8")
            reach = lengths[block] * bucket.longest
            cosines = np.where(reach > 0, needed * (1 - 1e-12 * np.sign(needed)) / np.where(reach > 0, reach, 1), np.where(needed > 0, 2.0, -1.0))
            found = bucket.candidates(unit[block], cosines)
            every = [k for k, c in enumerate(found) if c is None]
            scored = [(block[every], slice(None))] if every else []
            scored += [(block[[k]], c) for k, c in enumerate(found) if c is not None and len(c)]
            for who, which in scored:
                scores = exact_scores(mine[who], bucket.vectors[which])
                ids, labels = bucket.ids[which], bucket.labels[which]
                fits = ((labels == own_labels[who][:, None]) == same_label) & (ids != own_ids[who][:, None])
                # one row of the table for each list of the anchors at hand
                lists = np.concatenate([np.arange(first[w], first[w + 1]) for w in who])
                of = np.repeat(np.arange(len(who)), sizes[who])
                for part in range(0, len(lists), AT_ONCE):
                    at, which_anchor = lists[part:part + AT_ONCE], of[part:part + AT_ONCE]
                    taken = scores[which_anchor]
                    valid = fits[which_anchor] & (taken >= best.low[at][:, None]) & (taken <= best.high[at][:, None])
                    if valid.sum() > 4 * most * len(at) and taken.shape[1] > most:
                        least = np.partition(np.where(valid, taken, -MOST), taken.shape[1] - most, axis=1)[:, taken.shape[1] - most]
                        valid &= taken >= least[:, None]
                    i, j = np.nonzero(valid)
                    best.add(at[i], ids[j], taken[i, j])
    return pd.DataFrame({"anchor_id": own_ids[owner[best.lists]], "positive_id": np.concatenate(anchors["positives"].to_numpy()).astype("i8")[best.lists],
                         "found_id": best.ids, "score": best.scores})


def usable(embeddings: DataFrame, vec_id: str, label: str, vector: str) -> DataFrame:
    """``vec_id``, ``label``, ``vector``, ``dims`` of the rows that take part, one an id."""
    rows = embeddings.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vector}`").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(finite)
    repeated = materialize(rows.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("vec_id").alias("again")), "repeated-ids")
    if not repeated.isEmpty():
        same = F.col("vec_id") == F.col("again")
        once = rows.join(repeated, same, "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("least")).select("vec_id", "least.label", "least.vector")
        rows = rows.join(repeated, same, "left_anti").unionByName(once)
    return materialize(rows.withColumn("dims", F.size("vector")), "vectors")


def _meet(anchors: DataFrame, rows: DataFrame, groups: DataFrame, by: list[str], scale: int, most: int, same_label: bool, chosen) -> DataFrame:
    """FOUND of every block of anchors with every group of rows of equal ``by`` that ``chosen`` takes."""
    sizes = bounded(groups.select(*[F.col(c).alias(f"of_{c}") for c in by], "groups", "blocks"))
    equal = lambda: [F.col(c) == F.col(f"of_{c}") for c in by]
    place = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    keys = [*by, "group", "block"]
    spread = (rows.join(sizes, equal()).withColumn("group", place("vec_id", "groups")).where(chosen(F.col("group")))
              .select("vec_id", "label", "vector", *[c for c in by if c != "label"], "group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    asked = (anchors.join(sizes, equal()).withColumn("block", place("anchor_id", "blocks"))
             .select("anchor_id", "label", "vector", "positives", "low", "high", *[c for c in by if c != "label"], "block",
                     F.explode(F.filter(F.sequence(F.lit(0), F.col("groups") - 1), chosen)).alias("group")))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"anchor_id": [], "positive_id": [], "found_id": [], "score": []}, dtype="i8")
        return search(left, right, scale, most, same_label)

    return asked.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(meet, FOUND)


def _groups(rows: DataFrame, anchors: DataFrame, by: list[str]) -> DataFrame:
    parts = lambda n, size: F.greatest(F.lit(1), F.ceil(F.col(n) / size)).cast("int")
    asked = anchors.groupBy(*[F.col(c).alias(f"of_{c}") for c in by]).agg(F.count("*").alias("n_anchors"))
    counted = rows.groupBy(*by).agg(F.count("*").alias("n_rows")).join(asked, [F.col(c) == F.col(f"of_{c}") for c in by])
    return materialize(counted.select(*by, parts("n_rows", GROUP_ROWS).alias("groups"), parts("n_anchors", BLOCK_ANCHORS).alias("blocks")), "search-groups")


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("score").desc(), F.col("found_id").asc())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
                   vec_id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Components become floor(scale * x); scores are inner products of these. Anchors are the
    rows whose id is divisible by ``every``. Their positives are the first ``positives``
    other rows of the same label, and for each the result has the first ``negatives`` rows of
    other labels with ``low`` * positive <= 100 * negative <= ``high`` * positive. Higher
    scores come first, ties by smaller id.

    Rows with a NULL id, label, vector or component, or one that is not finite, take no part.
    Of rows with equal ids the one with the smallest label, then vector, takes part. Vectors
    are compared with those of their own dimension only; empty and zero vectors have score 0
    with all of these. Scores are whole numbers, exactly; beyond a long they count as the
    nearest long. An empty table gives no rows. Other columns are not used.

    A label or dimension may hold any share of the rows: groups are dealt by hash of the id
    to a bounded size, and every block of anchors meets each of them.
    """
    rows = usable(embeddings, vec_id, label, vector)
    asked = materialize(rows.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "anchor_id"), "anchors")
    unbounded = lambda value: F.array(F.lit(value).cast("long"))
    everything = asked.withColumns({"positives": F.array("anchor_id"), "low": unbounded(-MOST), "high": unbounded(MOST)})
    by_label = _groups(rows, asked, ["label", "dims"])
    near = _ranked(_meet(everything, rows, by_label, ["label", "dims"], scale, positives, True, lambda group: group >= 0), positives)
    near = near.where("score >= 0")  # no score lies between both shares of a negative one
    bands = near.select("anchor_id", F.struct(F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"),
                                              F.expr(f"cast(ceil(cast(score as decimal(20)) * {low} / 100) as long)").alias("low"),
                                              F.expr(f"cast(floor(cast(score as decimal(20)) * {high} / 100) as long)").alias("high")).alias("band"))
    bands = materialize(bands.groupBy("anchor_id").agg(F.sort_array(F.collect_list("band")).alias("bands")).withColumnRenamed("anchor_id", "_of"), "bands")
    wanted = asked.join(bands, F.col("anchor_id") == F.col("_of")).drop("_of")
    lists = lambda floor: {"positives": F.col("bands.positive_id"), "low": floor, "high": F.col("bands.high")}
    by_dims = _groups(rows, asked, ["dims"])
    first = materialize(_ranked(_meet(wanted.withColumns(lists(F.col("bands.low"))), rows, by_dims, ["dims"], scale, negatives, False,
                                      lambda group: group % FIRST_OF == 0), negatives), "first-negatives")
    reached = first.where(F.col("rank") == negatives).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("positive_id", "score"))).alias("reached"))
    floor = F.transform("bands", lambda b: F.greatest(b["low"], F.try_element_at("reached", b["positive_id"])))
    narrowed = wanted.join(reached.withColumnRenamed("anchor_id", "_of"), F.col("anchor_id") == F.col("_of"), "left").withColumns(lists(floor)).drop("reached", "_of")
    second = _meet(narrowed, rows, by_dims, ["dims"], scale, negatives, False, lambda group: group % FIRST_OF > 0)
    best = _ranked(first.drop("rank").unionByName(second), negatives)
    band = bands.select("_of", F.explode("bands").alias("band")).select("_of", F.col("band.positive_id").alias("_positive"), F.col("band.positive_score").alias("positive_score"))
    return best.join(band, (F.col("anchor_id") == F.col("_of")) & (F.col("positive_id") == F.col("_positive"))).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ship_code(__name__)
