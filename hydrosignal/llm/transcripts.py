"""Chat transcripts: roles by a hidden Markov model, then canonical turns.

Hidden states are (role, first line of a turn or later line). Each line shows a speaker marker or
none, a length class and whether it asks. All probabilities are counted over labelled
conversations. The best path is found in pieces: a piece of a conversation is reduced to a
state-by-state matrix of best scores, matrices of neighbouring pieces are joined in a tree of
bounded fan-in, and the states chosen at the borders are handed back down. So a conversation of
any length is parsed exactly without bringing it into one task.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrosignal.operators.attach import attach
from hydrosignal.operators.ordered import running_totals
from hydrosignal.session import materialize

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # 2 * role for a first line, 2 * role + 1 for a later one
#: Rows, that is turns, of a piece.
TURNS_PER_PIECE = 64
FAN_IN = 64
#: Characters by which rows of one turn are ordered.
TEXT_ORDER = 64
#: Share of speaker markers that transcripts leave out, as one in so many.
UNMARKED = 8

# Names that speakers are given in transcripts.
NAMES = {
    "system": "system", "instructions": "system", "user": "user", "human": "user", "you": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant",
}
_MARKER = re.compile(
    r"^\s*(?:\[(?P<a>\w+)\]|#{1,3}\s*(?P<b>\w+)\s*:?\s*$|(?P<c>\w+)\s*:(?=\s|$)|<\|?(?P<d>\w+)\|?>)\s*", re.IGNORECASE
)
MARKERS, LENGTHS = 1 + len(ROLES), 4


@dataclass
class Model:
    """Logarithms of start, transition and emission probabilities."""

    start: np.ndarray
    step: np.ndarray
    marker: np.ndarray
    length: np.ndarray
    asks: np.ndarray


def read_line(line: str) -> tuple[int, str]:
    """(marker, rest of the line): 0 without a known speaker, else 1 + the role's number."""
    found = _MARKER.match(line)
    role = NAMES.get(next((x for x in found.groups() if x), "").lower()) if found else None
    return (1 + ROLES.index(role), line[found.end() :]) if role else (0, line)


def observed(line: str) -> tuple[int, int, int]:
    """(marker, length class, asks) of a line."""
    marker, rest = read_line(line)
    size = len(rest.strip())
    return marker, (size > 0) + (size > 40) + (size > 160), int(rest.rstrip().endswith("?"))


def _style(conv: Column) -> Column:
    return F.pmod(F.xxhash64(conv, F.lit("style")), F.lit(3))


def _transcript_text(conv: str) -> Column:
    role = F.lower("role")
    first = F.coalesce(F.col("turn"), F.lit(0)) <= 0
    silent = (F.pmod(F.xxhash64(conv, "turn", F.lit("silent")), F.lit(UNMARKED)) == 0) & ~first
    name = F.initcap(role)
    marked = (
        F.when(silent | ~F.coalesce(role.isin(*ROLES), F.lit(False)), F.lit(""))
        .when(_style(F.col(conv)) == 0, F.concat(name, F.lit(": ")))
        .when(_style(F.col(conv)) == 1, F.concat(F.lit("["), name, F.lit("] ")))
        .otherwise(F.concat(F.lit("### "), name, F.lit("\n")))
    )
    return F.concat(marked, F.coalesce("text", F.lit("")))


def plain_transcripts(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turn, text): conversations as plain text, in one of three marker styles each.

    One marker in ``UNMARKED`` is left out, never the first turn's. The role column goes; a role
    that is null or not known gets no marker.
    """
    return turns.select(F.col(conv), F.col("turn").cast("long").alias("turn"), _transcript_text(conv).alias("text"))


def train(turns: DataFrame, conv: str = "conv_id") -> Model:
    """Counts over all labelled turns (roles not in ``ROLES`` are left out), with additive smoothing.

    Followers of a role are counted over distinct (conversation, turn, role), joined on the turn
    number, so no conversation is sorted or gathered.
    """
    labelled = turns.select(F.col(conv).alias("c"), F.col("turn").cast("long").alias("t"), F.lower("role").alias("role"))
    known = labelled.filter(F.col("role").isin(*ROLES) & F.col("t").isNotNull()).distinct()
    starts = known.groupBy("c").agg(F.min(F.struct("t", "role"))["role"].alias("role")).groupBy("role").count().collect()
    later = known.select("c", (F.col("t") - 1).alias("t"), F.col("role").alias("next"))
    follows = known.join(later, ["c", "t"]).groupBy("role", "next").count().collect()

    def count(batches):
        sums: dict[tuple, int] = {}
        for batch in batches:
            for role, value in zip(batch.role, batch.text, strict=True):
                for i, line in enumerate(value.split("\n")):
                    key = (2 * ROLES.index(role) + (i > 0), *observed(line))
                    sums[key] = sums.get(key, 0) + 1
        if sums:
            yield pd.DataFrame([(*k, n) for k, n in sums.items()], columns=["state", "marker", "length", "asks", "n"])

    marked = turns.select(F.lower("role").alias("role"), _transcript_text(conv).alias("text")).filter(F.col("role").isin(*ROLES))
    seen = (
        marked.mapInPandas(count, "state int, marker int, length int, asks int, n long")
        .groupBy("state", "marker", "length", "asks")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    start = np.full(STATES, 1e-6)
    for row in starts:
        start[2 * ROLES.index(row["role"])] += row["count"]
    marker = np.full((STATES, MARKERS), 0.5)
    length, asks = np.full((STATES, LENGTHS), 0.5), np.full((STATES, 2), 0.5)
    total = np.full(STATES, 1.0)
    for row in seen:
        s = row["state"]
        marker[s, row["marker"]] += row["n"]
        length[s, row["length"]] += row["n"]
        asks[s, row["asks"]] += row["n"]
        total[s] += row["n"]
    after = np.full((len(ROLES), len(ROLES)), 0.5)
    for row in follows:
        after[ROLES.index(row["role"]), ROLES.index(row["next"])] += row["count"]
    after /= after.sum(1, keepdims=True)
    step = np.full((STATES, STATES), 1e-12)
    for r in range(len(ROLES)):
        stay = total[2 * r + 1] / (total[2 * r] + total[2 * r + 1])
        for s in (2 * r, 2 * r + 1):
            step[s, 2 * r + 1] = stay
            step[s, ::2] = (1 - stay) * after[r]
    norm = lambda x: np.log(x / x.sum(-1, keepdims=True))
    return Model(norm(start), np.log(step), norm(marker), norm(length), norm(asks))


def scores(model: Model, lines: list[str]) -> np.ndarray:
    """Emission log probabilities, a row per line."""
    seen = np.array([observed(x) for x in lines]).reshape(-1, 3)
    return model.marker.T[seen[:, 0]] + model.length.T[seen[:, 1]] + model.asks.T[seen[:, 2]]


def reduce_lines(model: Model, emit: np.ndarray) -> np.ndarray:
    """Best score of a run of lines for every (first state, last state)."""
    best = np.full((STATES, STATES), -np.inf)
    np.fill_diagonal(best, emit[0])
    for row in emit[1:]:
        best = (best[:, :, None] + model.step[None]).max(1) + row
    return best


def chain(model: Model, parts: list[np.ndarray]) -> np.ndarray:
    out = parts[0]
    for part in parts[1:]:
        between = (out[:, :, None] + model.step[None]).max(1)
        out = (between[:, :, None] + part[None]).max(1)
    return out


def borders(model: Model, parts: list[np.ndarray], first: int, last: int) -> list[tuple[int, int]]:
    """First and last state of each part on the best path from ``first`` to ``last``."""
    ends, back = [parts[0][first]], []
    for part in parts[1:]:
        enter = ends[-1][:, None] + model.step
        best = enter.max(0)[:, None] + part
        back.append((enter.argmax(0), best.argmax(0)))
        ends.append(best.max(0))
    out, end = [], last
    for came, began in reversed(back):
        begin = int(began[end])
        out.append((begin, end))
        end = int(came[begin])
    return [(first, end), *reversed(out)]


def path(model: Model, emit: np.ndarray, first: int, last: int) -> list[int]:
    """States of the lines on the best path between fixed ends."""
    parts = []
    for row in emit:
        one = np.full((STATES, STATES), -np.inf)
        np.fill_diagonal(one, row)
        parts.append(one)
    return [a for a, _ in borders(model, parts, first, last)]


def render(lines: list[str], states: list[int]) -> str:
    """Canonical turns: a line ``<|role|>`` before each, markers removed."""
    out = []
    for line, state in zip(lines, states, strict=True):
        if state % 2 == 0:
            out.append(f"<|{ROLES[state // 2]}|>")
            rest = read_line(line)[1]
            if rest or not read_line(line)[0]:
                out.append(rest)
        else:
            out.append(line)
    return "\n".join(out)


def _numbered(texts: DataFrame, conv: str) -> DataFrame:
    """(c, i, pos, text): the place of each row in its conversation and the piece that it falls into.

    Rows are numbered inside ranges of (conversation, turn), so no task holds a whole conversation.
    """
    order = ["c", "turn", "head", "seq"]
    rows = texts.select(
        F.col(conv).alias("c"), F.col("turn").cast("long").alias("turn"), F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("seq")
    ).withColumn("head", F.substring("text", 1, TEXT_ORDER))
    # written so that the order among equal rows stays when a task is run again
    ranged = materialize(rows, "lines").repartitionByRange(*order).withColumn("shard", F.spark_partition_id())
    held = materialize(ranged, "line-ranges").withColumns({"k": F.xxhash64("c"), "no": F.col("c").isNull()})
    placed = running_totals(held, ["no", "k"], F.col("shard"), [F.col(x) for x in order[1:]], {"pos": F.lit(1).cast("long")})
    return placed.select("c", F.floor((F.col("pos") - 1) / F.lit(TURNS_PER_PIECE)).cast("long").alias("i"), "pos", "text")


def parse_transcripts(texts: DataFrame, model: Model, conv: str = "conv_id") -> DataFrame:
    """(conv, piece, n_lines, n_turns, roles, rendered): one row per piece of a transcript.

    ``texts`` has (conv, turn, text) with one or more lines per row, ordered by turn (null first),
    then by the first ``TEXT_ORDER`` characters, then as they lie in the table; repeated rows stay. A
    piece holds ``TURNS_PER_PIECE`` rows; the pieces of a transcript put together in order are its
    canonical form, on the best path over the whole transcript. Null texts are empty lines; rows with
    a null conversation form one. An empty table gives no rows. Other columns are not read.
    """
    shared = texts.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    kind = texts.schema[conv].dataType.simpleString()
    rows = _numbered(texts, conv)

    def pack(key, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        lines = "\n".join(part.text)
        best = reduce_lines(pickle.loads(shared.value), scores(pickle.loads(shared.value), lines.split("\n")))
        return pd.DataFrame({"c": part.c.iloc[:1].to_list(), "i": [key[1]], "lines": [lines], "best": [best.tobytes()]})

    pieces = materialize(rows.groupBy("c", "i").applyInPandas(pack, f"c {kind}, i long, lines string, best binary"), "pieces")

    def matrices(part: pd.DataFrame) -> list[np.ndarray]:
        return [np.frombuffer(b).reshape(STATES, STATES) for b in part.best]

    def join_up(key, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("i")
        best = chain(pickle.loads(shared.value), matrices(part))
        return pd.DataFrame({"c": part.c.iloc[:1].to_list(), "i": [key[1]], "best": [best.tobytes()]})

    # a transcript climbs only as far as it has several parts; its last one is in ``whole``
    level, levels, whole = pieces.select("c", "i", "best"), [], []
    while True:
        long = level.filter("i > 0").select("c").distinct().withColumn("_long", F.lit(True))
        marked = attach(level, long, ["c"], salt_by=["i"])
        whole.append(marked.filter("_long IS NULL").drop("_long"))
        if level.filter("i > 0").isEmpty():
            break
        levels.append(materialize(marked.filter("_long").drop("_long"), "parts"))
        up = levels[-1].groupBy("c", F.floor(F.col("i") / FAN_IN).cast("long").alias("i2"))
        level = materialize(up.applyInPandas(join_up, f"c {kind}, i long, best binary"), "joined")

    def top(batches):
        model = pickle.loads(shared.value)
        for part in batches:
            ends = [np.unravel_index((model.start[:, None] + m).argmax(), m.shape) for m in matrices(part)]
            yield pd.DataFrame({"c": part.c, "i": part.i, "first": [int(a) for a, _ in ends], "last": [int(b) for _, b in ends]})

    def hand_down(above: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("i")
        if part.empty:
            return pd.DataFrame({"c": [], "i": [], "first": [], "last": []})
        ends = borders(pickle.loads(shared.value), matrices(part), int(above["first"].iloc[0]), int(above["last"].iloc[0]))
        return pd.DataFrame({"c": part.c.to_list(), "i": part.i.to_list(), "first": [a for a, _ in ends], "last": [b for _, b in ends]})

    shape = f"c {kind}, i long, first int, last int"
    chosen = whole.pop().mapInPandas(top, shape)
    for parts in reversed(levels):
        below = parts.withColumn("g", F.floor(F.col("i") / FAN_IN).cast("long"))
        handed = chosen.groupBy("c", "i").cogroup(below.groupBy("c", "g")).applyInPandas(hand_down, shape)
        chosen = materialize(handed.unionByName(whole.pop().mapInPandas(top, shape)), "ends")

    def finish(batches):
        model = pickle.loads(shared.value)
        for part in batches:
            out = []
            for text, a, b in zip(part["lines"], part["first"], part["last"], strict=True):
                lines = text.split("\n")
                states = path(model, scores(model, lines), a, b)
                begun = [ROLES[s // 2] for s in states if s % 2 == 0]
                out.append((len(lines), len(begun), " ".join(begun), render(lines, states)))
            frame = pd.DataFrame(out, columns=["n_lines", "n_turns", "roles", "rendered"])
            frame.insert(0, "piece", part["i"].to_numpy())
            frame.insert(0, "c", part["c"].to_numpy())
            yield frame

    ended = pieces.join(chosen, pieces.c.eqNullSafe(chosen.c) & (pieces.i == chosen.i)).select(pieces.c, pieces.i, "lines", "first", "last")
    done = ended.mapInPandas(finish, f"c {kind}, piece long, n_lines long, n_turns long, roles string, rendered string")
    return done.withColumnRenamed("c", conv)
