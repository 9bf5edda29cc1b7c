"""Roles of raw transcripts by a hidden Markov model, and their canonical rendering.

A transcript is a sequence of lines. A state is a role together with whether the line begins a turn
or goes on with it. Lines emit a speaker marker ("User:", "<|assistant|>", ...), whether they are
blank, their length, how they end and whether a blank line is before them; transitions and emissions
are counted on labelled lines. Viterbi finds the likeliest states, and turns are rendered from them.

A transcript is cut into blocks of ``BLOCK`` messages. A block's best scores from each state before it
to each state at its end are a matrix; matrices of neighbouring blocks combine in a tree, whose root
fixes the last state and whose way down fixes the states at all cuts. So no task holds more than a
block of lines or of matrices, however long a transcript is, and the result is that of one long run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.store import staged

BLOCK = 256
#: A value of a feature gets counts of its own where one line in so many has it, whatever the number of such values.
SUPPORT = 100_000

ROLES = ("system", "user", "assistant")
BEGINS, START = len(ROLES), 2 * len(ROLES)  # states: roles that begin, roles that go on, and the start
FEATURES = ("marker", "blank", "size", "ending", "after_blank")

# The shapes of speaker markers, and the head and end of a canonical turn.
_MARKER = r"^[\s>#*\-]*(<\|?[A-Za-z_]{1,20}\|?>|\[[A-Za-z_ ]{1,20}\]|[A-Za-z_]{1,20} ?[A-Za-z_]{0,12}\*{0,2}:)"
_HEAD, _END = "<|{role}|>\n", "\n<|end|>\n"


def lines_of(messages: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", label_col: str | None = None) -> DataFrame:
    """(conv, turn, line, text, features, state): the lines of messages in order; ``state`` with labels only.

    Repeated rows are one message. Null texts are empty, and messages of null turns come first.
    """
    label = F.lower(F.col(label_col).cast("string")) if label_col else F.lit(None).cast("string")
    rows = messages.select(F.col(id_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("all"), label.alias("label")).distinct()
    texts = F.split("all", "\r?\n")
    each = rows.select("conv", "turn", "all", "label", texts.alias("texts")).select("*", F.posexplode("texts").alias("line", "text"))
    text = F.col("text")
    before = F.when(F.col("line") > 0, F.trim(F.element_at("texts", F.greatest(F.col("line"), F.lit(1)))) == "").otherwise(F.lit(False))
    role = F.array_position(F.array(*[F.lit(x) for x in ROLES]), F.col("label")).cast("int") - 1
    return each.select(
        "conv", "turn", F.xxhash64("all").alias("message"), "line", "text",
        F.lower(F.trim(F.regexp_extract(text, _MARKER, 1))).alias("marker"),
        (F.trim(text) == "").cast("string").alias("blank"),
        F.least(F.lit(9), F.floor(F.log2(F.length(text) + 1))).cast("string").alias("size"),
        F.regexp_extract(text, r"(\p{Punct})\s*$", 1).alias("ending"), before.cast("string").alias("after_blank"),
        F.when(role >= 0, F.when(F.col("line") == 0, role).otherwise(role + BEGINS)).alias("state"),
    )


@dataclass
class Model:
    """Log probabilities of transitions (from, to) and of the values of each feature by state."""

    moves: np.ndarray
    emits: dict[str, dict[str, np.ndarray]]
    other: dict[str, np.ndarray]
    speakers: set[str] = field(default_factory=set)

    def emission(self, rows: dict[str, list[str]]) -> np.ndarray:
        found = np.zeros((len(rows[FEATURES[0]]), START))
        for name in FEATURES:
            known, other = self.emits[name], self.other[name]
            found += np.array([known.get(x, other) for x in rows[name]])
        return found

    def matrix(self, emission: np.ndarray) -> np.ndarray:
        """Best score from each state before to each state at the end of some lines."""
        best = np.full((START + 1, START + 1), -np.inf)
        best[:, :START] = self.moves + emission[0]
        for row in emission[1:]:
            best[:, :START] = (best[:, :START, None] + self.moves[None, :START]).max(axis=1) + row
        return best

    def viterbi(self, emission: np.ndarray, entry: int, last: int) -> list[int]:
        """Likeliest states after ``entry``; ``last`` is the state of the last line, or -1 for the best one."""
        score, back = self.moves[entry] + emission[0], []
        for row in emission[1:]:
            ways = score[:, None] + self.moves[:START]
            back.append(ways.argmax(axis=0))
            score = ways.max(axis=0) + row
        states = [int(score.argmax()) if last < 0 else last]
        for came in reversed(back):
            states.append(int(came[states[-1]]))
        return states[::-1]


def learn(lines: DataFrame, support: int = SUPPORT) -> Model:
    """Counts over all labelled lines; what leaves Spark is a row per state and value of enough support,
    that is, for at most ``support`` values of a feature. The others count together."""
    known = lines.filter("state is not null")
    counts, least = {}, known.count() / support
    for name in FEATURES:
        top = known.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
        rows = known.groupBy(F.col(name).alias("value"), "state").agg(F.count("*").alias("n")).join(F.broadcast(top.select("value")), "value").collect()
        counts[name] = {}
        for x in rows:
            counts[name].setdefault(x["value"], np.zeros(START))[x["state"]] += x["n"]
    sizes = np.zeros(START)
    for x in known.groupBy("state").agg(F.count("*").alias("n")).collect():
        sizes[x["state"]] += x["n"]
    # A message's first state follows the last one of the message before it; that one ends as it goes on.
    first = known.filter("line = 0").groupBy("conv", "turn").agg(F.min("state").alias("state"), F.max("message").alias("message"))
    many = known.groupBy("conv", "turn").agg((F.max("line") > 0).alias("long"))
    after = first.withColumn("turn", F.col("turn") + 1).select("conv", "turn", F.col("state").alias("before"))
    ended = many.withColumn("turn", F.col("turn") + 1)
    pairs = first.join(after, ["conv", "turn"], "left").join(ended, ["conv", "turn"], "left").groupBy("before", "long", "state").agg(F.count("*").alias("n")).collect()
    moves = np.full((START + 1, START), 0.01)
    for x in pairs:
        came = START if x["before"] is None else x["before"] + (BEGINS if x["long"] else 0)
        moves[came, x["state"]] += x["n"]
    for role in range(BEGINS):  # lines that go on
        begun, on = sizes[role], sizes[role + BEGINS]
        longer = sum(x["n"] for x in pairs if x["before"] == role and x["long"]) + 0.01
        moves[role, role + BEGINS] += max(longer, min(begun, on))
        moves[role + BEGINS, role + BEGINS] += max(0.01, on - min(begun, on))
    moves = np.log(moves / moves.sum(axis=1, keepdims=True))
    emits, other = {}, {}
    for name in FEATURES:
        total = sizes + 0.5 * (len(counts[name]) + 1)
        emits[name] = {v: np.log((n + 0.5) / total) for v, n in counts[name].items()}
        other[name] = np.log(0.5 / total)
    speakers = {v for v, n in counts["marker"].items() if v and n[:BEGINS].sum() > 9 * n[BEGINS:].sum()}
    return Model(moves, emits, other, speakers)


_LINE = ["conv", "block", "turn", "message", "line", "text", *FEATURES]


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Groups of rows that agree in the first columns, from batches in which they are together."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = list(zip(*(batch.column(k).to_pylist() for k in range(keys)), strict=True))
        first = 0
        for i in range(1, len(names) + 1):
            if i < len(names) and names[i] == names[i - 1]:
                continue
            part = batch.slice(first, i - first)
            if first == 0 and rest:
                if tuple(rest[0].column(k)[0].as_py() for k in range(keys)) != names[0]:
                    yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
                    rest = []
                part = pa.Table.from_batches([*rest, part]).combine_chunks().to_batches()[0]
                rest = []
            if i == len(names):
                rest = [part]
            else:
                yield part
            first = i
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]


def _emission(model: Model, rows: pa.RecordBatch) -> np.ndarray:
    names = rows.schema.names
    return model.emission({x: rows.column(names.index(x)).to_pylist() for x in FEATURES})


def _boundaries(lines: DataFrame, model: Model, levels: int) -> DataFrame:
    """(conv, block, entry, last): the states before and at the end of each block."""

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, 2):
            best = model.matrix(_emission(model, rows))
            yield pa.RecordBatch.from_arrays([rows.column(0).slice(0, 1), rows.column(1).slice(0, 1), pa.array([best.ravel().tolist()], pa.list_(pa.float64()))], ["conv", "block", "best"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, 2):
            total = None
            for x in rows.column(3).to_pylist():
                best = np.array(x).reshape(START + 1, START + 1)
                total = best if total is None else (total[:, :, None] + best[None]).max(axis=1)
            yield pa.RecordBatch.from_arrays([rows.column(0).slice(0, 1), rows.column(1).slice(0, 1), pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["conv", "block", "best"])

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, 2):
            bests = [np.array(x).reshape(START + 1, START + 1) for x in rows.column(3).to_pylist()]
            entry, last = rows.column(4)[0].as_py(), rows.column(5)[0].as_py()
            score, back = bests[0][entry], []
            for best in bests[1:]:
                ways = score[:, None] + best
                back.append(ways.argmax(axis=0))
                score = ways.max(axis=0)
            states = [int(score[:START].argmax()) if last < 0 else last]
            for came in reversed(back):
                states.append(int(came[states[-1]]))
            states = states[::-1]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array([entry, *states[:-1]], pa.int32()), pa.array(states, pa.int32())], ["conv", "block", "entry", "last"])

    conv = lines.schema["conv"].dataType.simpleString()
    found = [staged(_together(lines, "conv", "block", "turn", "message", "line").mapInArrow(matrices, f"conv {conv}, block long, best array<double>"), "block-matrices")]
    for _ in range(levels):
        parents = found[-1].select("conv", F.floor(F.col("block") / BLOCK).alias("parent"), "block", "best")
        found.append(staged(_together(parents, "conv", "parent", "block").mapInArrow(combine, f"conv {conv}, block long, best array<double>"), "block-matrices"))
    states = found[-1].select("conv", "block", F.lit(START).alias("entry"), F.lit(-1).alias("last"))
    for level in found[-2::-1]:
        parents = states.select(F.col("conv").alias("_conv"), F.col("block").alias("_parent"), "entry", "last")
        children = level.select("conv", F.floor(F.col("block") / BLOCK).alias("parent"), "block", "best")
        joined = children.join(parents, children.conv.eqNullSafe(F.col("_conv")) & (F.col("parent") == F.col("_parent"))).select("conv", "parent", "block", "best", "entry", "last")
        states = staged(_together(joined, "conv", "parent", "block").mapInArrow(descend, f"conv {conv}, block long, entry int, last int"), "block-states")
    return states


def _together(rows: DataFrame, a: str, b: str, *order: str) -> DataFrame:
    return rows.repartition(a, b).sortWithinPartitions(a, b, *order)


def parse(messages: DataFrame, model: Model, id_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(id, turn, line, role, continued, text, rendered): the turns recovered from transcripts.

    ``messages`` are the parts of a transcript in order; their limits say nothing about turns. ``turn``
    and ``line`` tell where a recovered turn begins. A turn that goes on past a block comes in
    parts; the later ones are ``continued`` and rendered without a head. Nulls and repeated rows are as in ``lines_of``. An empty table gives no rows.
    """
    lines = lines_of(messages, id_col, turn_col, text_col).withColumn("block", F.floor(F.greatest(F.coalesce("turn", F.lit(0)), F.lit(0)) / block))
    conv = lines.schema["conv"].dataType.simpleString()
    most = messages.agg(F.max(F.col(turn_col).cast("long"))).first()[0] or 0
    levels, top = 0, max(0, most) // block
    while top:
        top, levels = top // BLOCK, levels + 1
    rows = lines.select(*_LINE)
    if levels:
        states = _boundaries(rows, model, levels).withColumnsRenamed({"conv": "_conv", "block": "_block"})
        placed = rows.join(states, rows.conv.eqNullSafe(states["_conv"]) & (rows.block == states["_block"])).select(*_LINE, "entry", "last")
    else:
        placed = rows.select(*_LINE, F.lit(START).alias("entry"), F.lit(-1).alias("last"))

    def recover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, 2):
            states = model.viterbi(_emission(model, group), group.column(len(_LINE))[0].as_py(), group.column(len(_LINE) + 1)[0].as_py())
            texts, markers = group.column(5).to_pylist(), group.column(6).to_pylist()
            begins = [i for i, x in enumerate(states) if i == 0 or x < BEGINS]
            roles, continued = [ROLES[states[i] % BEGINS] for i in begins], [states[i] >= BEGINS for i in begins]
            for i, state in enumerate(states):
                if state < BEGINS and markers[i] in model.speakers:
                    texts[i] = texts[i][texts[i].lower().find(markers[i]) + len(markers[i]) :].lstrip()
            whole = ["\n".join(texts[i:j]).strip("\n") for i, j in zip(begins, [*begins[1:], len(texts)], strict=True)]
            rendered = [("" if c else _HEAD.format(role=r)) + t + _END for r, c, t in zip(roles, continued, whole, strict=True)]
            at = pa.array(begins)
            yield pa.RecordBatch.from_arrays(
                [group.column(0).take(at), group.column(2).take(at), group.column(4).take(at), pa.array(roles), pa.array(continued), pa.array(whole), pa.array(rendered)],
                ["conv", "turn", "line", "role", "continued", "text", "rendered"],
            )

    schema = f"conv {conv}, turn long, line int, role string, continued boolean, text string, rendered string"
    return _together(placed, "conv", "block", "turn", "message", "line").mapInArrow(recover, schema).withColumnRenamed("conv", id_col)


# Marker styles of raw transcripts, for system, user and assistant.
STYLES = (
    ("System: ", "User: ", "Assistant: "), ("System: ", "Human: ", "AI: "), ("### System:\n", "### Instruction:\n", "### Response:\n"),
    ("<|system|>\n", "<|user|>\n", "<|assistant|>\n"), ("[SYSTEM] ", "[INST] ", "[BOT] "), ("", "Q: ", "A: "), ("\n", "\n", "\n"),
)


def raw_transcripts(conversations: DataFrame, id_col: str = "conv_id", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conversations`` as raw text: every conversation in one of the styles; the last has blank lines for markers."""
    style = F.pmod(F.xxhash64(F.col(id_col), F.lit(4)), F.lit(len(STYLES)))
    marker = F.lit("")
    for n, names in enumerate(STYLES):
        for role, name in zip(ROLES, names, strict=True):
            marker = F.when((style == n) & (F.lower(F.col(role_col)) == role), F.lit(name)).otherwise(marker)
    return conversations.withColumn(text_col, F.concat(marker, F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
