"""Cheapest repair of damaged conversations, decided by one integer minimum.

Role initials of a conversation must read (s?(ua)+)?. Edits of a row: Keep (0), Rerole to user or assistant (3), Delete
(4; the only choice for blank and duplicate rows); Insert of an empty user or assistant row anywhere (3); a truncated row that
isn't deleted adds 3. Of the cheapest repairs the one whose audit, the initials of its edits in order, is ASCII-least counts.

A repair is a path through a graph of layers, one a row, between the states of the grammar. Each edge has one scalar weight, a big
integer: its high digits are the cost; its low digits have a fixed place, two for each row, and hold the edge's letters, an
insertion and what happens to the row, with zeros behind. As each row's letters end with the row's own one, no row's letters
begin another choice's, so the order of these numbers is the order of (cost, audit), and the least path weight decides all.

A path over many layers is made of paths over blocks of layers: for each pair of states a block keeps its least cost and
letters, and the same minimum runs over blocks, where the low digits hold the place of a block's letters among all letters
of that block. So a long conversation is worked on in parts, in several tasks, and weights stay short.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import BATCH_BYTES, shuffle_partitions, stored

#: White space of the contract: space and 9 to 13.
BLANK = " \t\n\x0b\x0c\r"
#: Layers that are decided in one step.
BLOCK = 64

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: Costs of the edits, and letters in ASCII order.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
DIGIT = {"": 0, "D": 1, "I": 2, "K": 3, "R": 4}
DIGIT_BITS = 3
#: A layer's digits: two letters, or the place of a block's letters among at most 16.
LAYER_BITS = 2 * DIGIT_BITS
LEGAL = {"su", "ua", "au"}
ROLE = {USER: "user", ASSISTANT: "assistant"}


def _turned(state: int) -> int:
    """The state behind an inserted or reroled row: the only role that fits."""
    return ASSISTANT if state == USER else USER


def _kept(state: int, initial: str) -> int | None:
    if initial == "s" and state == START:
        return SYSTEM
    if initial == "u" and state != USER:
        return USER
    if initial == "a" and state == USER:
        return ASSISTANT
    return None


def _code(letters: str) -> int:
    return (DIGIT[letters[:1]] << DIGIT_BITS) | DIGIT[letters[1:]]


LETTERS = {_code(x): x for x in ("D", "K", "R", "IK", "IR", "", "I", "II")}


def _row_edges(initial: str, must_go: bool, truncated: bool) -> list[tuple[int, int, int, int]]:
    """(from, to, cost, digits). An insertion before a deleted row is left out: behind it, it costs the same and has the
    smaller audit. More than one insertion before a row only adds a pair that can go."""
    edges = [(p, p, DELETE, _code("D")) for p in range(STATES)]
    if must_go:
        return edges
    more = TRUNCATED if truncated else 0
    for p in range(STATES):
        for behind, letters, spent in ((p, "", more), (_turned(p), "I", INSERT + more)):
            edges.append((p, _turned(behind), spent + REROLE, _code(letters + "R")))
            if (to := _kept(behind, initial)) is not None:
                edges.append((p, to, spent, _code(letters + "K")))
    return edges


EDGES = {
    (initial, gone, cut): _row_edges(initial, gone, cut)
    for initial in ("s", "u", "a", "") for gone in (False, True) for cut in (False, True)
}
#: The end of a conversation: what is missing behind the last row is inserted.
END = [(START, START, 0, _code("")), (ASSISTANT, START, 0, _code("")), (USER, START, INSERT, _code("I")), (SYSTEM, START, 2 * INSERT, _code("II"))]


def least(layers: list[list[tuple[int, int, int, int]]], start: int) -> dict[int, int]:
    """Least path weight from `start` to each state that can be reached."""
    shift = width = LAYER_BITS * len(layers)
    best = {start: 0}
    for edges in layers:
        shift -= LAYER_BITS
        found: dict[int, int] = {}
        for p, q, cost, digits in edges:
            if p in best:
                weight = best[p] + (cost << width) + (digits << shift)
                if q not in found or weight < found[q]:
                    found[q] = weight
        best = found
    return best


def read(weight: int, layers: int) -> tuple[int, list[int]]:
    """Cost and the digits of each layer."""
    width, mask = LAYER_BITS * layers, (1 << LAYER_BITS) - 1
    return weight >> width, [(weight >> at) & mask for at in range(width - LAYER_BITS, -1, -LAYER_BITS)]


Paths = dict[tuple[int, int], tuple[int, str]]


def _row_block(layers: list) -> Paths:
    """Least cost and letters between each two states over layers of rows."""
    out = {}
    for p in range(STATES):
        for q, weight in least(layers, p).items():
            cost, digits = read(weight, len(layers))
            out[p, q] = cost, "".join(LETTERS[d] for d in digits)
    return out


def _joined(blocks: list[Paths], starts: Iterable[int] = range(STATES)) -> Paths:
    """The same over several blocks."""
    layers, names = [], []
    for block in blocks:
        order = sorted({letters for _, letters in block.values()})
        place = {letters: n for n, letters in enumerate(order)}
        layers.append([(p, q, cost, place[letters]) for (p, q), (cost, letters) in block.items()])
        names.append(order)
    out = {}
    for p in starts:
        for q, weight in least(layers, p).items():
            cost, digits = read(weight, len(layers))
            out[p, q] = cost, "".join(order[d] for order, d in zip(names, digits, strict=True))
    return out


END_BLOCK: Paths = {(p, q): (cost, LETTERS[digits]) for p, q, cost, digits in END}


def _over(blocks: list[Paths], starts: Iterable[int] = range(STATES)) -> Paths:
    while len(blocks) > BLOCK:
        blocks = [_joined(blocks[a : a + BLOCK]) for a in range(0, len(blocks), BLOCK)]
    return _joined(blocks, starts)


class Part:
    """A run of rows of one conversation, in order: its counts and its least paths."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.turn = self.first = self.last = None
        self.layers: list = []
        self.levels: list[list[Paths]] = [[]]

    def add(self, turn, initial: str, blank: bool, duplicate: bool, cut: bool) -> None:
        self.rows += 1
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += cut and not blank and not duplicate
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.turn:
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn
            self.turns += 1
        if len(self.layers) == BLOCK:
            self._close()
        self.layers.append(EDGES[initial if initial in ("s", "u", "a") else "", blank or duplicate, cut])

    def _close(self) -> None:
        """Full blocks become one of the level above, so few are held at a time."""
        full = _row_block(self.layers)
        self.layers = []
        for level in self.levels:
            level.append(full)
            if len(level) < BLOCK:
                return
            full = _joined(level)
            level.clear()
        self.levels.append([full])

    def paths(self) -> Paths:
        tail = [_row_block(self.layers)] if self.layers else []
        return _over([block for level in reversed(self.levels) for block in level] + tail)

    def decided(self) -> tuple[int, str]:
        """Cost and audit of a whole conversation."""
        if not any(self.levels):
            layers = [*self.layers, END]
            cost, digits = read(least(layers, START)[START], len(layers))
            return cost, "".join(LETTERS[d] for d in digits)
        return _joined([self.paths(), END_BLOCK], [START])[START, START]


# ---------------------------------------------------------------- tasks

_COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high")
PARTS = ("conv_id long, part int, " + ", ".join(f"{c} long" for c in _COUNTS)
         + ", first string, last string, costs array<long>, letters array<string>")
FACTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
LINES = "conv_id long, place long, edit string, role string, text string"
DIGESTS = "conv_id long, sha256 string"

_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (part.split() for part in text.split(", "))])


def _batches(rows: Iterator[tuple], schema: pa.Schema, weigh=lambda row: 64) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded bytes from a stream of rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if size >= BATCH_BYTES or len(held) >= 50_000:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _in_rows(batches: Iterator[pa.RecordBatch], names: tuple) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def _facts(part: Part) -> tuple:
    cost, audit = part.decided()
    gaps = part.high - part.low + 1 - part.turns if part.turns else 0
    return part.conv_id, gaps, part.blank, part.duplicate, part.truncated, part.illegal, cost, audit


def _part_row(part: Part, number: int, whole: bool) -> tuple:
    counts = [getattr(part, c) for c in _COUNTS]
    if whole:
        cost, audit = part.decided()
        return part.conv_id, None, *counts, part.first, part.last, [cost], [audit]
    paths = part.paths()
    cells = [paths.get((p, q)) for p in range(STATES) for q in range(STATES)]
    return part.conv_id, number, *counts, part.first, part.last, [c and c[0] for c in cells], [c and c[1] for c in cells]


def _parts(batches):
    """One row for each conversation of a range of rows. Only the first and the last of a range may go on in another one."""

    def rows():
        number = TaskContext.get().partitionId()
        part, seen = None, 0
        for conv_id, turn, initial, blank, cut, copies, first in _in_rows(
            batches, ("conv_id", "turn", "initial", "blank", "cut", "copies", "is_first")
        ):
            if part is None or conv_id != part.conv_id:
                if part is not None:
                    yield _part_row(part, number, whole=seen > 1)
                part, seen = Part(conv_id), seen + 1
            for copy in range(copies):
                part.add(turn, initial, blank, copy > 0 or not first, cut)
        if part is not None:
            yield _part_row(part, number, whole=False)

    return _batches(rows(), _schema(PARTS), lambda row: 200 + 5 * sum(len(x or "") for x in row[-1]))


def _merged(table: pa.Table) -> pa.Table:
    """Facts of one conversation from its parts in order."""
    blocks, facts, last, turn = [], None, None, None
    for r in sorted(table.to_pylist(), key=lambda r: r["part"]):
        if facts is None:
            facts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0) | {"low": None, "high": None}
        elif last + r["first"] not in LEGAL:
            facts["illegal"] += 1
        for c in ("blank", "duplicate", "truncated", "illegal", "turns"):
            facts[c] += r[c]
        if r["low"] is not None:
            facts["turns"] -= r["low"] == turn
            facts["low"], facts["high"], turn = r["low"] if facts["low"] is None else facts["low"], r["high"], r["high"]
        last = r["last"]
        cells = zip(r["costs"], r["letters"], strict=True)
        blocks.append({(n // STATES, n % STATES): cell for n, cell in enumerate(cells) if cell[0] is not None})
    cost, audit = _joined([_over(blocks), END_BLOCK], [START])[START, START]
    gaps = facts["high"] - facts["low"] + 1 - facts["turns"] if facts["turns"] else 0
    row = (table.column("conv_id")[0].as_py(), gaps, facts["blank"], facts["duplicate"], facts["truncated"], facts["illegal"], cost, audit)
    schema = _schema(FACTS)
    return pa.table([pa.array([v], t) for v, t in zip(row, schema.types, strict=True)], schema=schema)


def _edited(audit: str, rows: Iterator[tuple]) -> Iterator[tuple]:
    """(edit, role, text) of the rows that a repair leaves."""
    state, at = START, 0

    def inserted():
        nonlocal state, at
        while at < len(audit) and audit[at] == "I":
            state, at = _turned(state), at + 1
            yield "I", ROLE[state], ""

    for role, text, copies in rows:
        for _ in range(copies):
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = _kept(state, role[:1])
                yield edit, role, text
            elif edit == "R":
                state = _turned(state)
                yield edit, ROLE[state], text
    yield from inserted()


def _lines(batches):
    """Rows of each conversation behind its audit, as the lines of the repaired conversation."""

    def rows():
        stream = _in_rows(batches, ("conv_id", "audit", "role", "text", "copies"))
        ahead = next(stream, None)
        while ahead is not None:
            conv_id, audit = ahead[:2]

            def members():
                nonlocal ahead
                while (ahead := next(stream, None)) is not None and ahead[1] is None:
                    yield ahead[2:]

            for place, (edit, role, text) in enumerate(_edited(audit, members())):
                yield conv_id, place, edit, role, text

    return _batches(rows(), _schema(LINES), lambda row: 64 + 4 * len(row[4]))


def _digests(batches):
    def rows():
        known, digest, any_yet = None, None, False
        for conv_id, place, role, text in _in_rows(batches, ("conv_id", "place", "role", "text")):
            if place == 0:
                if any_yet:
                    yield known, digest.hexdigest()
                known, digest, any_yet = conv_id, hashlib.sha256(), True
            digest.update((("\n" if place else "") + f"{role}:{text}").encode())
        if any_yet:
            yield known, digest.hexdigest()

    return _batches(rows(), _schema(DIGESTS))


# ---------------------------------------------------------------- operator


def _content(rows: DataFrame) -> DataFrame:
    """The rows with null role and text as one space, and a digest of both."""
    rows = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), (F.col("copies") if "copies" in rows.columns else F.lit(1)).cast("long").alias("copies"),
    )
    key = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumn("content", F.unhex(F.sha2(key, 256)))


def decisions(rows: DataFrame) -> DataFrame:
    """Faults, cost and audit of each conversation: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit).

    Input: (conv_id, turn, role, text) and, if there is one, `copies`, how often the row stands there; other columns are ignored. Rows stand
    in order of turn, nulls first; rows of one turn in order of a digest of role and text. A null role or text is one space, a null conv_id is
    a conversation like others, repeated rows are duplicates. An empty table gives no rows. Texts aren't shuffled.

    Rows are dealt out by ranges of (conversation, turn, digest), so a conversation with a large share of all rows is spread over tasks;
    its parts are joined at the end, where its letters, one or two a row and pair of states, are all that is held.
    """
    end = F.rtrim("text", F.lit(BLANK))
    keys = ["conv_id", "turn", "content"]
    alike = _content(rows).groupBy(
        *keys, F.substring("role", 1, 1).alias("initial"), (F.char_length(end) == 0).alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    ).agg(F.sum("copies").alias("copies"))
    firsts = alike.groupBy("conv_id", "content").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("f")).select(
        F.col("conv_id").alias("_conv"), F.col("content").alias("_content"), F.col("f.turn").alias("_turn"), F.lit(True).alias("is_first"),
    )
    # One row of `firsts` at most for each row here, whatever share of the rows says the same.
    marked = alike.join(
        firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn")) & (F.col("content") == F.col("_content")), "left",
    ).withColumn("is_first", F.col("is_first").isNotNull())
    parts = stored(
        marked.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys).mapInArrow(_parts, PARTS), "parts",
    )
    gaps = F.when(F.col("turns") > 0, F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(0)
    whole = parts.where("part is null").select(
        "conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", F.col("costs")[0].alias("cost"), F.col("letters")[0].alias("audit"),
    )
    return whole.unionByName(parts.where("part is not null").groupBy("conv_id").applyInArrow(_merged, FACTS))


def repaired(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """The repaired conversations line by line: (conv_id, place from 0, edit, role, text), each in order of place and within one partition.

    `decided` is the result of `decisions` for the same rows. Conversations of which nothing is left have no lines. Rows of one conversation
    pass through one task one after another, sorted by Spark, and none is held.
    """
    texts = _content(rows).select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "content", "copies", "role", "text")
    heads = decided.select("conv_id", "audit", *[F.lit(None).cast(t).alias(c) for c, t in texts.dtypes if c not in ("conv_id", "audit")])
    order = [F.col("conv_id"), F.col("audit").isNull(), F.col("turn"), F.col("content")]
    return heads.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_lines, LINES)


def digests(lines: DataFrame) -> DataFrame:
    """(conv_id, sha256) of `role:text`, newline-joined, for lines in the order that `repaired` gives them."""
    return lines.mapInArrow(_digests, DIGESTS)
