"""Best-fit packing of tokenised documents into sequences, repacked until bounds say that it is enough.

Pieces are dealt by hash into partitions of like size, and each partition is packed by
best-fit decreasing. Dual-feasible functions bound from below the sequences that a
partition's pieces need; where the count meets the bound, the partition is certified to be
packed as well as can be. Partitions with gaps hand over the pieces of their loose
sequences, which are dealt anew, so that pieces of different partitions meet, and packed
again, until the bound over all pieces is met or a round saves nothing.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import ship_code

#: Tokens of a sequence.
CAPACITY = 2048
#: The id that ends a document.
END = 0
#: Pieces of a partition, on average; they are dealt by hash, so no partition is much larger.
PART_PIECES = 1 << 15
#: Rounding functions u(k) that the bound tries: k = 1, …, ROUNDINGS.
ROUNDINGS = 64
#: Characters of the texts that a worker tokenises at once.
SLICE_CHARS = 1_000_000

# --- Fixed values: how byte-level BPE cuts texts into words ---
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# --- end of fixed values ---

#: Characters whose class is the same in all versions of Unicode: visible ASCII, blank, tab and line
#: ends, Latin, Greek and Cyrillic letters, common punctuation, kana, Han and Hangul.
KNOWN = "\t\n\r -~¡-ɏΑ-ωЀ-ӿ‐-\u2027€ぁ-ゖァ-ヺ一-鿋가-힣"

PIECES = 1 << 15
#: Rounding functions u(k) that the bound tries: k = 1, …, ROUNDINGS.
ROUNDINGS = 64
#: Words whose ids a worker remembers; it starts anew when they are more.
REMEMBERED = 200_000
#: Characters of the texts that a worker cuts into words at once.
SLICE_CHARS = 1_000_000
#: Characters of a word that is remembered, at most; longer ones are tokenised each time.
WORD_CHARS = 48

#: What may stand on both sides of a blank at which byte-level BPE certainly starts a new word:
#: visible ASCII and common letters, all of them no white space in any version of Unicode.
_VISIBLE = "!-~¡-ɏΑ-ωЀ-ӿぁ-ヿ一-鿿가-힣"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, salt int"


class Ids:
    """Token ids of texts by a byte-level BPE file of ``tokenizers``.

    ``tiktoken`` gives the same ids from the same vocabulary at a quarter of the time, as its
    ranks are the file's ids; it is used for texts of well-known characters only, on which
    the two agree about letters, digits and white space whatever Unicode version they have.
    All other texts, and those with a special token's string, go through ``tokenizers``.
    """

    def __init__(self, file: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file)
        letters = byte_letters()
        ranks = {bytes([letters[c] for c in token]): rank for token, rank in json.loads(file)["model"]["vocab"].items() if all(c in letters for c in token)}
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        for token in special:
            ranks.pop(token.encode(), None)
        self.fast = tiktoken.Encoding("own", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.doubtful = re.compile("|".join([f"[^{KNOWN}]", *map(re.escape, special)]))

    def encode(self, text: str) -> list[int]:
        if self.doubtful.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: visible bytes for themselves, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(others)}


def text_slices(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of Arrow batches in slices of about SLICE_CHARS characters; a longer text is a slice of its own."""
    for batch in batches:
        ends = batch["text"].str.len().fillna(0).cumsum().to_numpy()
        for _, rows in batch.groupby((ends // SLICE_CHARS).astype("i8"), sort=False):
            yield rows


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """Starts and lengths of a document's pieces: full ones, but for the first."""
    first = (length - 1) % capacity + 1
    return [(0, first), *[(start, capacity) for start in range(first, length, capacity)]]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document's ids: PIECES, and ``ids`` (array<int>) where they are asked for.

    ``tokenizer`` is the path of a byte-level BPE file, read once on the driver (a few MB).
    A document's ids are those of its whole text, then END; documents above ``capacity`` are
    cut into pieces of that length, the first of which may be shorter. NULL and empty texts
    are the one id END. Repeated rows and rows without id are documents too; ``salt`` (the
    row's place in its batch) deals them apart. Other columns are not used.
    """
    with open(tokenizer, encoding="utf-8") as file:
        given = docs.sparkSession.sparkContext.broadcast(file.read())

    def tokenise(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = Ids(given.value)
        for batch in text_slices(batches):
            rows = []
            for salt, doc_id, text in zip(batch["salt"], batch["doc_id"], batch["text"]):
                ids = np.asarray([*tokens.encode(text or ""), END], "<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                    part = ids[start:start + length]
                    rows.append((doc_id, piece, start, length, zlib.crc32(part), salt, *([part.astype("i4")] if keep_ids else [])))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "salt", *(["ids"] if keep_ids else [])])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.pmod(F.monotonically_increasing_id(), F.lit(1 << 30)).cast("int").alias("salt"))
    return rows.mapInPandas(tokenise, PIECES + (", ids array<int>" if keep_ids else ""))


def least_bins(counts: np.ndarray, capacity: int) -> int:
    """Bins that the pieces need at least; ``counts[n]`` pieces have length n.

    The greatest of the bounds by dual-feasible functions: the identity, the functions that
    count pieces above capacity - t as whole bins and drop those below t, and the rounding
    functions u(k). Sums are whole numbers, so the bounds are exact.
    """
    counts = np.asarray(counts, "i8")
    length = np.arange(capacity + 1, dtype="i8")
    tokens, number = np.cumsum(counts * length), np.cumsum(counts)
    t = np.arange(0, capacity // 2 + 1)
    large = number[-1] - number[capacity - t]
    kept = tokens[capacity - t] - np.where(t > 0, tokens[np.maximum(t - 1, 0)], 0)
    best = int((large * capacity + kept).max())
    bound = -(-best // capacity)
    for k in range(1, ROUNDINGS + 1):
        scaled = (k + 1) * length
        rounded = np.where(scaled % capacity == 0, k * length, scaled // capacity * capacity)
        bound = max(bound, -(-int((rounded * counts).sum()) // (capacity * k)))
    return bound


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each piece, and the room that each bin has left.

    Lengths are whole numbers, so open bins are kept by their room, and a bit set of the
    rooms gives the tightest one that fits.
    """
    bins, offsets = np.zeros(len(lengths), "i8"), np.zeros(len(lengths), "i8")
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []
    held = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = held >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                held ^= 1 << room
        else:
            room, b = capacity, len(rooms)
            rooms.append(capacity)
        bins[i], offsets[i], rooms[b] = b, capacity - room, room - n
        if room > n:
            by_room[room - n].append(b)
            held |= 1 << (room - n)
    return bins, offsets, np.asarray(rooms, "i8")


def handed_over(rooms: np.ndarray, bound: int) -> np.ndarray:
    """The bins whose pieces a partition hands over.

    A partition above its bound gives all that are not full, as other pieces may fit better.
    A certified one has nothing to mend, but its loosest bins may fill up with those of
    others: it gives those with at least the mean room.
    """
    loose = rooms > 0
    if len(rooms) > bound or not loose.any():
        return loose
    return loose & (rooms * loose.sum() >= rooms.sum())


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (PIECES, lengths from 1 to ``capacity``) with ``sequence_id``, ``offset`` and ``certified``.

    Sequences are filled without gaps from 0. ``certified``: the partition that packed the
    piece has no more sequences than the bound of its pieces. Equal pieces are
    interchangeable; an empty table gives no rows.

    What the driver sees are counts: the lengths' histogram (at most ``capacity`` rows) and
    sums over partitions. Partitions are dealt by hash with about PART_PIECES pieces.
    """
    def pack_part(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["length", "doc_id", "piece", "ids_crc32", "salt"], ascending=[False, True, True, True, True], kind="stable")
        lengths = batch["length"].to_numpy()
        bins, offsets, rooms = best_fit(lengths, capacity)
        bound = least_bins(np.bincount(lengths, minlength=capacity + 1), capacity)
        given = handed_over(rooms, bound)
        first = np.zeros(len(batch), bool)
        first[np.unique(bins, return_index=True)[1]] = True
        return batch.assign(bin=bins, offset=offsets, certified=len(rooms) <= bound, given=given[bins], first=first)

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "salt"]
    pieces = materialize(pieces.select(*columns), "pieces")
    lengths = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    histogram = np.zeros(capacity + 1, "i8")
    for row in lengths:
        histogram[row.length] = row.n
    bound = least_bins(histogram, capacity)
    placed, placed_bins = [], 0
    pool, before, before_bins, turn = pieces, None, None, 0
    left = int(histogram.sum())
    while True:
        parts = max(1, -(-left // PART_PIECES))
        key = F.xxhash64("doc_id", "piece", "ids_crc32", "salt", F.lit(turn))
        packed = materialize(
            pool.withColumn("part", F.pmod(key, F.lit(parts))).repartition(parts, "part").groupBy("part")
            .applyInPandas(pack_part, "doc_id long, piece int, start long, length long, ids_crc32 long, salt int, part long, "
                                      "bin long, offset long, certified boolean, given boolean, first boolean"), f"packed-{turn}")
        packed = packed.withColumn("sequence_id", F.lit(turn << 50) + F.col("part") * F.lit(1 << 20) + F.col("bin"))
        counted = packed.agg(F.count_if("first").alias("bins"), F.count_if(F.col("first") & F.col("given")).alias("given_bins"), F.count_if("given").alias("given")).first()
        if before is not None and counted.bins >= before_bins:
            placed.append(before)
            break
        if placed_bins + counted.bins <= bound or not counted.given:
            placed.append(packed)
            break
        placed.append(packed.where(~F.col("given")))
        placed_bins += counted.bins - counted.given_bins
        before, before_bins, left, turn = packed.where("given"), counted.given_bins, counted.given, turn + 1
        pool = before.select(*columns)
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out.select(*columns, "sequence_id", "offset", "certified")


def sequences(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` of every sequence: the pieces' ids (from ``token_pieces`` with ids) in their places.

    ``packed`` is what ``pack`` made of the same pieces. A sequence has at most the capacity
    in pieces, so its group is bounded.
    """
    key = ["doc_id", "piece", "ids_crc32", "salt"]
    of = packed.select(*[F.col(c).alias(f"_{c}") for c in key], "sequence_id", "offset")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    in_place = pieces.join(of, same[0] & same[1] & same[2] & same[3])
    return in_place.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))


ship_code(__name__)
