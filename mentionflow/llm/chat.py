"""Transcript parsing: a hidden Markov model over lines recovers who speaks.

States are the roles, each as the first line of a turn or a later one. A line is observed
by its speaker marker, its length and its shape; start, transition and emission counts come
from transcripts with known roles. Viterbi is a product of max-plus matrices, so a
conversation is decoded in blocks of lines: every block gives a matrix, the matrices of a
conversation that spans blocks are stitched (in blocks of blocks, if need be), and each
block is decoded between the states that lead into and out of it. No task ever holds a
whole conversation. Turns are then rendered in one canonical form.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import numbered, ship_code

ship_code(__name__)

ROLES = ["system", "user", "assistant"]
#: Lines in a block, and matrices that are stitched in one task.
BLOCK, STITCHED = 512, 256
SMOOTHING = 0.5

# What speakers are called at the start of a line, by role.
MARKERS = {
    "system": r"(?i)^[\s#*<|\[(]*(?:system|instructions?|context)[\s|>*\])]*(?::|\|>|$)\s*",
    "user": r"(?i)^[\s#*<|\[(]*(?:user|human|customer|prompter|question|q|me)[\s|>*\])]*(?::|\|>|$)\s*",
    "assistant": r"(?i)^[\s#*<|\[(]*(?:assistant|ai|bot|agent|model|answer|a|gpt)[\s|>*\])]*(?::|\|>|$)\s*",
}
#: Values of the observations: marker, length, shape.
OBSERVED = {"marker": 4, "size": 10, "shape": 6}
STATES = 2 * len(ROLES)


def line_features(line: Column) -> dict[str, Column]:
    """Observations of a line as small whole numbers, and its text without the marker."""
    marker = F.lit(0)
    body = line
    for i, role in reversed(list(enumerate(ROLES, 1))):
        marker = F.when(F.rlike(line, F.lit(MARKERS[role])), i).otherwise(marker)
        body = F.when(F.rlike(line, F.lit(MARKERS[role])), F.regexp_replace(line, MARKERS[role], "")).otherwise(body)
    shape = (F.when(F.trim(body) == "", 0).when(F.rlike(body, F.lit(r"\?\s*$")), 1).when(F.rlike(body, F.lit(r"^\s*([-*•]|\d+[.)])\s")), 2)
             .when(F.rlike(body, F.lit(r"^\s*```|[{};]\s*$")), 3).when(F.rlike(body, F.lit(r"[.!:\"”)]\s*$")), 4).otherwise(5))
    size = F.least(F.floor(F.log2(F.length(body) + 1)), F.lit(OBSERVED["size"] - 1)).cast("int")
    return {"marker": marker, "size": size, "shape": shape, "body": body}


def transcript_lines(transcripts: DataFrame, keep: list[str]) -> DataFrame:
    """Lines of transcripts given in pieces (``conv_id``, ``turn``, ``text``): ``line``, features, ``body`` and the kept columns."""
    lines = transcripts.select("conv_id", "turn", *keep, F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\r?\n")).alias("line", "_text"))
    return lines.select("conv_id", "turn", "line", *keep, *[v.cast("int" if k in OBSERVED else "string").alias(k) for k, v in line_features(F.col("_text")).items()])


class Model:
    """Log probabilities of starts, transitions and observations."""

    def __init__(self, starts: np.ndarray, steps: np.ndarray, seen: dict[str, np.ndarray]):
        log = lambda counts: np.log((counts + SMOOTHING) / (counts + SMOOTHING).sum(-1, keepdims=True))
        self.starts, self.steps, self.seen = log(starts), log(steps), {k: log(v) for k, v in seen.items()}
        inside = np.arange(STATES) % 2 == 1
        self.starts[inside] = -1e9  # a transcript begins with a turn
        for state in range(STATES):  # a later line follows a line of its own turn
            others = inside & (np.arange(STATES) // 2 != state // 2)
            self.steps[state, others] = -1e9

    def emissions(self, rows: pd.DataFrame) -> np.ndarray:
        """Log probability of every line in every state."""
        return sum(self.seen[name][:, rows[name].to_numpy()].T for name in OBSERVED)


def train(lines: DataFrame) -> Model:
    """Counts over lines with ``role``; one row per piece is one turn. Pieces of other roles are left out.

    The driver gets the count tables only, whose size is that of the state and value sets.
    """
    state = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") - 1
    known = lines.where(F.col("role").isin(ROLES)).withColumn("state", 2 * state + F.when(F.col("line") > 0, 1).otherwise(0))
    seen = {k: np.zeros((STATES, n)) for k, n in OBSERVED.items()}
    for row in known.groupBy("state", *OBSERVED).agg(F.count("*").alias("n")).collect():
        for name in OBSERVED:
            seen[name][row.state, row[name]] += row.n
    turns = known.groupBy("conv_id", "turn", "role").agg(F.max("line").alias("last"))
    turns = turns.select("conv_id", "turn", "last", (2 * state).alias("first_state"))
    after = turns.select(F.col("conv_id").alias("of"), (F.col("turn") - 1).alias("after"), F.col("first_state").alias("next_state"))
    pairs = turns.join(after, (F.col("conv_id") == F.col("of")) & (F.col("turn") == F.col("after")), "left")
    starts, steps = np.zeros(STATES), np.zeros((STATES, STATES))
    counts = pairs.groupBy("first_state", (F.col("last") > 0).alias("longer"), "next_state", (F.col("turn") == 0).alias("opens")).agg(
        F.count("*").alias("n"), F.sum("last").alias("later"))
    for row in counts.collect():
        end = row.first_state + row.longer
        if row.longer:
            steps[row.first_state, row.first_state + 1] += row.n
            steps[row.first_state + 1, row.first_state + 1] += row.later - row.n
        if row.next_state is not None:
            steps[end, row.next_state] += row.n
        starts[row.first_state] += row.n * row.opens
    return Model(starts, steps, seen)


def chain(model_steps: np.ndarray, emissions: np.ndarray) -> np.ndarray:
    """Best scores from the state before a run of lines to the state at its last line."""
    score = model_steps + emissions[0]
    for emission in emissions[1:]:
        score = (score[:, :, None] + model_steps[None]).max(1) + emission
    return score


def decode(first: np.ndarray, links: list[np.ndarray], last: int | None) -> list[int]:
    """Best states: ``first`` scores of the first one, a matrix to each further one, the last one if known."""
    score, back = first, []
    for link in links:
        through = score[:, None] + link
        back.append(through.argmax(0))
        score = through.max(0)
    state = int(score.argmax()) if last is None else last
    path = [state]
    for pointers in reversed(back):
        path.append(int(pointers[path[-1]]))
    return path[::-1]


def _segments(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of rows of one block and conversation, which come together."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        change = (rows["block"].diff() != 0) | (rows["conv"] != rows["conv"].shift())
        starts = [*np.flatnonzero(change), len(rows)]
        for a, b in zip(starts[:-2], starts[1:-1]):
            yield rows.iloc[a:b]
        held = rows.iloc[starts[-2]:] if len(rows) else None
    if held is not None:
        yield held


def _stitch(rows: pd.DataFrame) -> pd.DataFrame:
    """States before and at the end of every segment of a run; NaN before a conversation."""
    rows = rows.sort_values("block", ignore_index=True)
    matrices = [np.array(m).reshape(STATES, STATES) for m in rows["matrix"]]
    before, last = rows["before"].iloc[0], rows["after"].iloc[0]
    # a conversation's first segment begins in a virtual state: its matrix rows already hold the start scores
    first = matrices[0].max(0) if np.isnan(before) else matrices[0][int(before)]
    path = decode(first, matrices[1:], None if np.isnan(last) else int(last))
    return pd.DataFrame({"conv": rows["conv"], "block": rows["block"], "before": [before, *path[:-1]], "after": path})


def stitch(segments: DataFrame) -> DataFrame:
    """``conv``, ``block``, ``before``, ``after`` of segments (``conv``, ``block``, ``matrix``) of conversations with several."""
    schema = "conv string, block long, before double, after double"
    most = segments.groupBy("conv").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    free = segments.withColumn("before", F.lit(float("nan"))).withColumn("after", F.lit(float("nan")))
    if most <= STITCHED:
        return free.groupBy("conv").applyInPandas(_stitch, schema)

    def product(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        total = None
        for m in rows["matrix"]:
            m = np.array(m).reshape(STATES, STATES)
            total = m if total is None else (total[:, :, None] + m[None]).max(1)
        return pd.DataFrame({"conv": [rows["conv"].iloc[0]], "block": [rows["block"].iloc[0] // STITCHED], "matrix": [total.ravel()]})

    wide = F.floor(F.col("block") / STITCHED)
    upper = materialize(segments.groupBy("conv", wide.alias("wide")).applyInPandas(product, "conv string, block long, matrix array<double>"), "chat-upper")
    ends = stitch(upper).select(F.col("conv").alias("of"), F.col("block").alias("wide"), "before", "after")
    inner = segments.withColumn("wide_block", wide).join(ends, (F.col("conv") == F.col("of")) & (F.col("wide_block") == F.col("wide")))
    return inner.select("conv", "block", "matrix", "before", "after", "wide").groupBy("conv", "wide").applyInPandas(_stitch, schema)


def parse(transcripts: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Roles of all lines of transcripts given in pieces (``conv_id``, ``turn``, ``text``).

    Returns ``conv_id``, ``turn``, ``line``, the kept columns, ``recovered`` (role),
    ``starts`` (whether a turn starts) and ``rendered``: the lines of a conversation, joined
    by line ends in order, are its canonical form. NULL and empty texts are an empty line;
    pieces of one turn follow by text, equal rows one another; NULL ids are one
    conversation; an empty table gives no rows. Other columns are not used.
    """
    keep = keep or []
    lines = transcript_lines(transcripts.withColumn("_order", F.xxhash64("text")), ["_order", *keep])
    order = [F.col(c) for c in ("conv_id", "turn", "_order", "line")]
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    lines = materialize(numbered(lines, order).withColumn("block", F.floor(F.col("_number") / BLOCK)).withColumn("conv", conv), "chat-lines")
    spans = materialize(lines.groupBy("conv").agg(F.min("_number").alias("opens"), F.max("_number").alias("closes"))
                        .withColumnRenamed("conv", "of"), "chat-spans")
    blocks = lines.select("conv", "block", "_number", *OBSERVED).join(spans, F.col("conv") == F.col("of")).drop("of")
    blocks = blocks.repartition("block").sortWithinPartitions("block", "_number")

    def matrices(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _segments(batches):
            if rows["opens"].iloc[0] // BLOCK == rows["closes"].iloc[0] // BLOCK:
                continue  # decoded whole
            emissions = model.emissions(rows)
            if rows["_number"].iloc[0] == rows["opens"].iloc[0]:
                first = np.where(np.eye(STATES, dtype=bool), model.starts + emissions[0], -1e18)
                matrix = first if len(rows) == 1 else (first[:, :, None] + chain(model.steps, emissions[1:])[None]).max(1)
            else:
                matrix = chain(model.steps, emissions)
            yield pd.DataFrame({"conv": [rows["conv"].iloc[0]], "block": [rows["block"].iloc[0]], "matrix": [matrix.ravel()]})

    segments = materialize(blocks.mapInPandas(matrices, "conv string, block long, matrix array<double>"), "chat-segments")
    ends = materialize(stitch(segments).select(F.col("conv").alias("end_of"), F.col("block").alias("end_block"), "before", "after"), "chat-ends")
    joined = (blocks.join(ends, (F.col("conv") == F.col("end_of")) & (F.col("block") == F.col("end_block")), "left").drop("end_of", "end_block")
              .repartition("block").sortWithinPartitions("block", "_number"))

    def states(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _segments(batches):
            emissions = model.emissions(rows)
            before, after = rows["before"].iloc[0], rows["after"].iloc[0]
            first = (model.starts if np.isnan(before) else model.steps[int(before)]) + emissions[0]
            path = decode(first, [model.steps + e for e in emissions[1:]], None if np.isnan(after) else int(after))
            yield pd.DataFrame({"number": rows["_number"].to_numpy(), "state": path, "opens": rows["opens"].to_numpy(), "closes": rows["closes"].to_numpy()})

    found = materialize(joined.mapInPandas(states, "number long, state int, opens long, closes long"), "chat-states")
    full = lines.join(found, F.col("_number") == F.col("number"))
    role = F.element_at(F.array(*map(F.lit, ROLES)), (F.floor(F.col("state") / 2) + 1).cast("int"))
    starts = F.col("state") % 2 == 0
    rendered = F.concat(F.when(starts & (F.col("number") > F.col("opens")), "<|im_end|>\n").otherwise(""),
                        F.when(starts, F.concat(F.lit("<|im_start|>"), role, F.lit("\n"))).otherwise(""), F.col("body"),
                        F.when(F.col("number") == F.col("closes"), "\n<|im_end|>").otherwise(""))
    return full.select("conv_id", "turn", "line", *keep, role.alias("recovered"), starts.alias("starts"), rendered.alias("rendered"))
