"""Parsing of transcripts: a hidden Markov model recovers who speaks each line.

States are roles. A line shows a speaker marker ("User:"), its length, whether it
asks, and whether it begins a segment of the transcript. Emissions and
transitions are counted on segments whose role is known; Viterbi's algorithm
finds the likeliest roles, and lines of one role become a turn.

Segments are sorted by conversation once and dealt to ranges of equal size, so a
conversation may span many ranges. What a range does to the scores of the states
is a small matrix; these are chained on the driver, one per range, and every
range then decodes its own part.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.tables import partitions, texts
from tableloom.session import cut_lineage

ROLES = ("system", "user", "assistant")
#: Names by which transcripts mark a speaker.
SPEAKERS = {
    "system": ("system", "instruction", "instructions"),
    "user": ("user", "human", "question", "customer", "q"),
    "assistant": ("assistant", "ai", "bot", "answer", "agent", "a"),
}
MARKER = re.compile(
    r"^\s*[#*<|\[]*\s*(" + "|".join(n for names in SPEAKERS.values() for n in names) + r")"
    r"\s*(?:[|\]>*]+:?|:)[|\]>*]*\s*",
    re.IGNORECASE,
)
ROLE_OF = {name: ROLES.index(role) for role, names in SPEAKERS.items() for name in names}
#: Probability that a marker tells its speaker, and that a line without one stays with it.
MARKER_TRUST, STAY = 0.98, 0.995
#: Word counts that begin a class of line lengths.
LENGTHS = (1, 4, 12, 30)
KINDS = 2 * (len(LENGTHS) + 1)
#: Held in observations: kind of line, marker (0: none, else role + 1), begins a segment.
MARKERS = len(ROLES) + 1
NEVER = -1e9

SORTED_SCHEMA = (
    "range int, place long, conv_id long, turn long, text string, observed array<int>, "
    "summary string"
)


def observation(line: str, begins: bool) -> int:
    found = MARKER.match(line)
    marker = ROLE_OF[found[1].lower()] + 1 if found else 0
    length = sum(len(line.split()) >= bound for bound in LENGTHS)
    kind = 2 * length + line.rstrip().endswith("?")
    return (kind * MARKERS + marker) * 2 + begins


def observations(text: str) -> list[int]:
    return [observation(line, i == 0) for i, line in enumerate(text.split("\n"))]


@dataclass
class Counts:
    """Of known segments: first roles, role after role, kinds of lines by role."""

    first: np.ndarray = field(default_factory=lambda: np.zeros(len(ROLES)))
    after: np.ndarray = field(default_factory=lambda: np.zeros((len(ROLES), len(ROLES))))
    kinds: np.ndarray = field(default_factory=lambda: np.zeros((len(ROLES), KINDS)))

    def add(self, before: int | None, role: int, observed: list[int]) -> None:
        if before is None:
            self.first[role] += 1
        else:
            self.after[before, role] += 1
        for code in observed:
            self.kinds[role, code // 2 // MARKERS] += 1

    def plus(self, other: Counts) -> Counts:
        return Counts(
            self.first + other.first, self.after + other.after, self.kinds + other.kinds
        )


@dataclass(frozen=True)
class Model:
    """Logarithms of the probabilities."""

    first: np.ndarray
    after: np.ndarray
    stay: np.ndarray
    emit: np.ndarray

    @staticmethod
    def of(counts: Counts) -> Model:
        """Every case counts once more than it was seen."""

        def logs(table: np.ndarray) -> np.ndarray:
            return np.log((table + 1) / (table + 1).sum(axis=-1, keepdims=True))

        n = len(ROLES)
        stay = np.full((n, n), (1 - STAY) / (n - 1))
        np.fill_diagonal(stay, STAY)
        heard = np.full((n, MARKERS), (1 - MARKER_TRUST) / (n - 1))
        heard[np.arange(n), np.arange(n) + 1] = MARKER_TRUST
        heard[:, 0] = 1
        emit = logs(counts.kinds)[:, :, None] + np.log(heard)[:, None, :]
        return Model(
            logs(counts.first), logs(counts.after), np.log(stay), emit.reshape(n, -1)
        )

    def step(self, code: int) -> np.ndarray:
        """Score of each role after each role, with the line itself."""
        fresh = code % 2 or code // 2 % MARKERS
        return (self.after if fresh else self.stay) + self.emit[:, code // 2]

    def start(self, code: int) -> np.ndarray:
        return self.first + self.emit[:, code // 2]


def forward(model: Model, codes: list[int], scores: np.ndarray | None) -> np.ndarray:
    """Best scores of the states after the lines; ``scores`` may have leading axes."""
    for code in codes:
        if scores is None:
            scores = model.start(code)
        else:
            scores = (scores[..., :, None] + model.step(code)).max(axis=-2)
    return scores


def viterbi(
    model: Model, codes: list[int], enter: int | None, leave: int | None
) -> list[int]:
    """Likeliest states of the lines, given the state before and the last one if known."""
    if enter is None:
        scores = model.start(codes[0])
    else:
        scores = model.step(codes[0])[enter]
    back = []
    for code in codes[1:]:
        ways = scores[:, None] + model.step(code)
        back.append(ways.argmax(axis=0))
        scores = ways.max(axis=0)
    state = int(scores.argmax()) if leave is None else leave
    states = [state]
    for best in reversed(back):
        state = int(best[state])
        states.append(state)
    return states[::-1]


def every_one(conv: int | None) -> bool:
    return True


def sorted_segments(conversations: DataFrame, learned: Callable) -> DataFrame:
    """Segments in ranges of conversation and turn, and one summary of each range.

    Equal rows are told apart by their row number, so no key makes a range
    longer than others.
    """
    rows = texts(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [
        F.col("conv_id").asc_nulls_first(),
        F.col("turn").asc_nulls_first(),
        F.xxhash64("text"),
        F.col("row"),
    ]
    dealt = rows.repartitionByRange(partitions(conversations.sparkSession), *order)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, place = TaskContext.get().partitionId(), 0
        counts, ends, before = Counts(), [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text")]
            made = []
            for conv, turn, role, text in zip(*columns, strict=True):
                codes = observations(text)
                known = ROLES.index(role) if role in ROLES else None
                if not ends:
                    ends = [[conv, known, codes]] * 2
                elif known is not None and learned(conv):
                    same = before[0] == conv
                    if not same or before[1] is not None:
                        counts.add(before[1] if same else None, known, codes)
                before = (conv, known)
                ends[1] = [conv, known, None]
                made.append((here, place, conv, turn, text, codes, None))
                place += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*made, strict=True), TYPES, strict=True)],
                NAMES,
            )
        if ends:
            summary = json.dumps(
                {
                    "ends": ends,
                    "first": counts.first.tolist(),
                    "after": counts.after.tolist(),
                    "kinds": counts.kinds.tolist(),
                }
            )
            last = [[here], [None], [None], [None], [None], [None], [summary]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(last, TYPES, strict=True)], NAMES
            )

    by_order = dealt.sortWithinPartitions(*order)
    return cut_lineage(by_order.mapInArrow(numbered, SORTED_SCHEMA))


NAMES = [part.split()[0] for part in SORTED_SCHEMA.split(", ")]
TYPES = [
    pa.int32(),
    pa.int64(),
    pa.int64(),
    pa.int64(),
    pa.string(),
    pa.list_(pa.int32()),
    pa.string(),
]


def fit(segments: DataFrame, learned: Callable) -> Model:
    """Counts of all segments with a known role, joined across the borders of ranges."""
    rows = segments.where("summary is not null").select("range", "summary").collect()
    total, before = Counts(), None
    for row in sorted(rows, key=lambda r: r["range"]):
        held = json.loads(row["summary"])
        total = total.plus(
            Counts(*(np.array(held[name]) for name in ("first", "after", "kinds")))
        )
        (conv, role, codes), last = held["ends"]
        if role is not None and learned(conv):
            same = before is not None and before[0] == conv
            if not same or before[1] is not None:
                total.add(before[1] if same else None, role, codes)
        before = last
    return Model.of(total)


def by_range(segments: DataFrame, *names: str) -> DataFrame:
    rows = segments.where("summary is null").select("range", "place", *names)
    n = partitions(segments.sparkSession)
    return rows.repartition(n, "range").sortWithinPartitions("range", "place")


def runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Per range and conversation the number of the run in its range and its rows."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(name).to_pylist() for name in names), strict=True)

    for place, held in groupby(rows(), key=lambda row: row[0]):
        for number, (conv, run) in enumerate(groupby(held, key=lambda row: row[1])):
            yield place, number, conv, list(run)


def range_effects(segments: DataFrame, model: Model) -> list[dict]:
    """What each range does to the scores of the states, in order; one row per range."""

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, dict] = {}
        for place, number, conv, run in runs(batches, ["range", "conv_id", "observed"]):
            codes = [code for row in run for code in row[2]]
            fresh = forward(model, codes, None).tolist()
            if number == 0:
                through = np.full((len(ROLES), len(ROLES)), NEVER)
                np.fill_diagonal(through, 0)
                head = forward(model, codes, through).tolist()
                found[place] = {"range": place, "first": conv, "head": head}
            found[place] |= {"last": conv, "fresh": fresh, "runs": number + 1}
        if found:
            listed = [json.dumps(held) for held in found.values()]
            yield pa.RecordBatch.from_pydict({"effect": listed})

    rows = by_range(segments, "conv_id", "observed").select("range", "conv_id", "observed")
    made = [json.loads(r["effect"]) for r in rows.mapInArrow(effects, "effect string").collect()]
    return sorted(made, key=lambda held: held["range"])


def chained(effects: list[dict]) -> dict[int, tuple[int | None, int | None]]:
    """For each range the state before it and its last state, where a conversation crosses."""
    n = len(effects)
    joined = [i > 0 and effects[i]["first"] == effects[i - 1]["last"] for i in range(n)] + [False]
    whole = [held["runs"] == 1 for held in effects]
    future = [np.zeros(len(ROLES)) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        if joined[i + 1]:
            later = future[i + 1] if whole[i + 1] else 0
            future[i] = (np.array(effects[i + 1]["head"]) + later).max(axis=1)
    found: dict[int, tuple[int | None, int | None]] = {}
    state = None
    for i, held in enumerate(effects):
        enter = state if joined[i] else None
        leave = None
        if joined[i + 1]:
            head = whole[i] and enter is not None
            scores = np.array(held["head"])[enter] if head else np.array(held["fresh"])
            leave = int((scores + future[i]).argmax())
        found[held["range"]] = (enter, leave)
        state = leave
    return found


def parse_transcripts(
    conversations: DataFrame, learned: Callable[[int | None], bool] = every_one
) -> DataFrame:
    """Turns of every transcript with the recovered role and canonical rendering.

    Reads ``conv_id``, ``turn`` (order of the segments), ``text`` and, to learn from
    only, ``role``; other columns are left aside. One row per run of lines of a
    role within a segment: ``conv_id``, ``turn``, ``part`` (from 0), ``role``,
    ``text`` without the speaker marker, ``continues`` (the same speaker's turn
    goes on) and ``rendered``: ``<|role|>``, a line feed and the text, without
    the first line if the turn continues. Null texts count as one empty line.
    Null conversations are one conversation, null turns come first, segments of
    equal turn follow by the hash of their text, and repeated rows stay.
    Without known roles all counts are alike and markers alone decide. All known
    roles are learned from; ``learned`` may keep conversations out, to test the model.
    """
    segments = sorted_segments(conversations, learned)
    model = fit(segments, learned)
    effects = range_effects(segments, model)
    crossing = chained(effects)
    last_runs = {held["range"]: held["runs"] - 1 for held in effects}

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["range", "conv_id", "turn", "text", "observed"]
        made: list[tuple] = []
        for place, number, _, run in runs(batches, names):
            enter, leave = crossing[place]
            codes = [code for row in run for code in row[4]]
            last = number == last_runs[place]
            states = viterbi(
                model, codes, enter if number == 0 else None, leave if last else None
            )
            speaking, at = enter if number == 0 else None, 0
            for _, conv, turn, text, observed in run:
                lines = text.split("\n")
                here = states[at : at + len(observed)]
                marked = [code // 2 % MARKERS > 0 for code in observed]
                at += len(observed)
                begun = 0
                for part, (state, same) in enumerate(groupby(here)):
                    end = begun + len(list(same))
                    spoken = [
                        MARKER.sub("", line, count=1) if sign else line
                        for line, sign in zip(lines[begun:end], marked[begun:end], strict=True)
                    ]
                    said, role, begun = "\n".join(spoken), ROLES[state], end
                    goes_on = state == speaking
                    rendered = said if goes_on else f"<|{role}|>\n{said}"
                    made.append((conv, turn, part, role, said, goes_on, rendered))
                    speaking = state
            if len(made) >= 1000:
                yield turn_batch(made)
                made = []
        if made:
            yield turn_batch(made)

    rows = by_range(segments, "conv_id", "turn", "text", "observed")
    return rows.select("range", "conv_id", "turn", "text", "observed").mapInArrow(
        decoded, TURN_SCHEMA
    )


TURN_SCHEMA = (
    "conv_id long, turn long, part int, role string, text string, continues boolean, "
    "rendered string"
)
TURN_TYPES = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("part", pa.int32()),
        ("role", pa.string()),
        ("text", pa.string()),
        ("continues", pa.bool_()),
        ("rendered", pa.string()),
    ]
)


def turn_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, TURN_TYPES, strict=True)],
        schema=TURN_TYPES,
    )
