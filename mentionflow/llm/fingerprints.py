"""Document fingerprints by a threshold-scaled sketch.

A text's shingles (runs of code points) are hashed to 32 bits; the sketch retains every
hash below a fixed fraction of the hash space, so its size follows the text's, sketches of
parts merge by union, and the containment of a short text in a long one is estimated from
the hashes both could have kept. A text with few shingles keeps its smallest ones beyond
the threshold, so that short texts can be compared too.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import ship_code

ship_code(__name__)

#: Code points in a shingle; a shorter text is one shingle.
SHINGLE = 9
#: One of so many hashes is retained.
SCALE = 16
#: Smallest hashes that are retained in any case.
LEAST = 16
#: Ranges of neighbours for each shuffle partition.
RANGES_A_PARTITION = 4

_BASE = [pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(SHINGLE)]
_FULL = (1 << 32) - 1
_LIMIT = (1 << 32) // SCALE


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def shingle_hashes(codes: np.ndarray) -> np.ndarray:
    """32-bit hash of every shingle; none for no code points."""
    if not len(codes):
        return np.empty(0, np.uint32)
    if len(codes) < SHINGLE:
        codes = np.concatenate([codes, np.zeros(SHINGLE - len(codes), codes.dtype)])
    wide = codes.astype(np.uint64)
    mixed = np.zeros(len(wide) - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        mixed += wide[k:len(wide) - SHINGLE + 1 + k] * np.uint64(_BASE[k])
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(32)).astype(np.uint32)


def retain(hashes: np.ndarray) -> np.ndarray:
    """The sketch, sorted: hashes below the limit, or the smallest ones where those are few."""
    low = np.unique(hashes[hashes < _LIMIT])
    return low if len(low) >= LEAST else np.unique(hashes)[:LEAST]


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of two texts together (but for the shingles across their seam)."""
    reach = min(known_up_to(a), known_up_to(b))
    both = np.union1d(a, b)
    low = both[both < _LIMIT]
    return low if len(low) >= LEAST else both[both <= reach][:LEAST]


def known_up_to(sketch: np.ndarray) -> int:
    """Hash up to which a sketch has all of its text's hashes."""
    if len(sketch) < LEAST:
        return _FULL
    return max(_LIMIT - 1, int(sketch[-1]))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated containment of the smaller in the larger; 1 for equal sketches, 0 without evidence."""
    if np.array_equal(a, b):
        return 1.0
    reach = min(known_up_to(a), known_up_to(b))
    a, b = a[a <= reach], b[b <= reach]
    smaller = min(len(a), len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / smaller if smaller else 0.0


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u4").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def _fingerprint_texts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"row_id": batch["row_id"],
                            "fingerprint": [encode(retain(shingle_hashes(code_points(t or "")))) for t in batch["text"]]})


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every row; NULL and empty texts have an empty one."""
    rows = docs.select(F.col(doc_id).cast("long").alias("row_id"), F.col(text).alias("text"))
    return rows.mapInPandas(_fingerprint_texts, "row_id long, fingerprint string").withColumnRenamed("row_id", doc_id)


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most the value: first among every n-th, then between two of those."""
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    longs = lambda xs: f"array({', '.join(f'{x}L' for x in xs)})"
    if not blocks:
        return F.lit(0)
    at_most = lambda array: F.size(F.filter(array, lambda b: b <= value))
    block = F.greatest(at_most(F.expr(longs([b[0] for b in blocks]))), F.lit(1))
    inner = at_most(F.element_at(F.expr(f"array({', '.join(map(longs, blocks))})"), block))
    return F.coalesce((block - 1) * step + inner, F.lit(0))


def with_neighbours(docs: DataFrame) -> DataFrame:
    """``part``, ``tail``, ``row_id``, ``text``: ranges of ascending ids, each followed by the first row after it.

    Bounds are approximate quantiles, one for each range, so the driver sees as many numbers
    as there are ranges and no task gets more than its share of rows.
    """
    spark = docs.sparkSession
    ranges = RANGES_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.agg(F.percentile_approx("row_id", [i / ranges for i in range(1, ranges)], 20 * ranges).alias("bounds")).first().bounds
    docs = docs.withColumn("part", _range_of(F.col("row_id"), sorted(set(found or []))))
    firsts = sorted((r.part, r.first is not None, r.first) for r in docs.groupBy("part").agg(
        F.when(F.count_if(F.col("row_id").isNull()) == 0, F.min("row_id")).alias("first")).collect())
    tails = [(firsts[(i + 1) % len(firsts)][2], part) for i, (part, *_) in enumerate(firsts)]
    tails = F.broadcast(spark.createDataFrame(tails, "first_id long, tail_of int"))
    places = F.array_compact(F.array(
        F.struct(F.col("part").alias("part"), F.lit(False).alias("tail")),
        F.when(F.col("tail_of").isNotNull(), F.struct(F.col("tail_of").alias("part"), F.lit(True).alias("tail")))))
    placed = docs.join(tails, F.col("row_id").eqNullSafe(F.col("first_id")), "left").select("row_id", "text", F.explode(places).alias("place"))
    return (placed.select("place.part", "place.tail", "row_id", "text").repartition("part")
            .sortWithinPartitions("part", "tail", F.col("row_id").asc_nulls_first(), "text"))


def _compare(row_id, text: str, sketch: np.ndarray, hashes: np.ndarray, after: tuple[str, np.ndarray]) -> tuple:
    """Result for a text and the one after it."""
    n, cut = len(text), len(text) // 4
    edited = text[:n - cut] + after[0][:cut]
    kept = max(0, n - cut - SHINGLE + 1)  # shingles that lie before the replaced part
    edited_hashes = shingle_hashes(code_points(edited[kept:]))
    edited_sketch = retain(np.concatenate([hashes[:kept], edited_hashes]) if kept else edited_hashes)
    return (row_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), encode(sketch), encode(edited_sketch),
            likeness(sketch, edited_sketch), likeness(sketch, after[1]))


COLUMNS = ["row_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compare_neighbours(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Streams the sorted rows; every row meets its successor in the same range."""
    before = None
    for batch in batches:
        rows = []
        for part, tail, row_id, text in zip(batch["part"], batch["tail"], batch["row_id"], batch["text"]):
            if before is None and tail:
                continue
            text = text or ""
            hashes = shingle_hashes(code_points(text))
            sketch = retain(hashes)
            if before is not None and before[0] == part:
                rows.append(_compare(*before[1:], (text, sketch)))
            before = None if tail else (part, None if pd.isna(row_id) else int(row_id), text, sketch, hashes)
        frame = pd.DataFrame(rows, columns=COLUMNS)
        yield frame.assign(row_id=frame["row_id"].astype("Int64"))


def compare_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited text, and how alike it is to that and to the next text.

    The edited text has its last quarter replaced by the start of the next document in
    ascending id; the first follows the last. NULL texts are empty, NULL ids come first,
    rows with one id are ordered by text, equal rows are rows each; a single row is its own
    successor; an empty table gives no rows. Other columns are not used.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("row_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return with_neighbours(rows).mapInPandas(
        _compare_neighbours, "row_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                             "near_edited double, near_next double").withColumnRenamed("row_id", doc_id)
