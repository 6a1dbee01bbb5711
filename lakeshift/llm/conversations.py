"""Conversation structure repair by one shortest path over scalar weights.

A conversation's rows, in the order of their turns, are edited until the initials of their roles
read ``(s?(ua)+)?``: Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty
user or assistant row) 2; a truncated row that stays adds 1, and blank and repeated rows must go.
Of the cheapest edits those win whose initials, read as a string, come first in ASCII order.

Both decisions are one integer comparison. The weight of a path is ``cost * 2**width + letters``:
the high digits hold the cost, the low ones the letters of the edits, one base-8 digit each from
the highest down (D, I, K, R are 1 to 4) with zeros after the last. A smaller integer is a cheaper
path or, at the same cost, an earlier string. The graph has a node per row and state of the
grammar (nothing yet, after s, after u, after a), and the plain integer minimum over its edges,
taken from the last row to the first, decides everything. Which role a Rerole or Insert takes
follows from the state; two inserts with no kept row between them never belong to a cheapest path.

A conversation may hold a third of all rows, so it is not gathered. Rows without their texts are
range-partitioned in order and cut into chunks of at most ``CHUNK`` rows, wherever tasks begin.
A chunk's table has the lightest path between any two states of the grammar. Two different paths
through a chunk that cost the same differ within it (each ends with the letter of the chunk's last
row, so neither begins the other), hence tables of consecutive chunks combine: a pass back over
the chunks of a conversation finds the best end state for every start state, a pass forward
applies them. Only the forward pass reads texts, in order, one row at a time.

Rows of one conversation and turn stand by the SHA-256 of their role and text.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeshift.llm.common import BLANKS, join_splittable, table
from lakeshift.session import scratch_path

#: Letters of the edits by digit; digit 0 pads.
LETTERS = " DIKR"
BITS = 3
#: Rows whose tables are computed as one; bounds the digits of a weight, not the result.
CHUNK = 128

START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: States by the initial of a row that may follow.
TAKES = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
#: The state that an inserted or re-roled row leads to, and its role.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE = ("user", "user", "assistant", "user")
#: What is left to pay after the last row: an open user turn needs an answer.
CLOSING = (0, None, 2, 0)

#: A row that must go. Other rows are classed by initial (o: none that the grammar has), in
#: capitals where they are truncated.
GONE = "-"


@lru_cache(maxsize=8192)
def lightest(classes: str) -> tuple[tuple[int | None, ...], ...]:
    """``[start][end]``: the weight of the lightest path through rows of these classes, at width
    ``width(classes)``; None where no path of at most one insert before each row exists."""
    bits = width(classes)
    low = (1 << bits) - 1

    def edge(cost: int, letter: int, rest: int | None) -> int | None:
        """The weight of an edge followed by the path ``rest``: costs add, the letter is the first."""
        if rest is None:
            return None
        return (((rest >> bits) + cost) << bits) | (letter << (bits - BITS)) | ((rest & low) >> BITS)

    columns = []
    for end in range(4):
        after: list[int | None] = [None] * 4
        after[end] = 0
        for row in reversed(classes):
            took = []
            for q in range(4):
                paths = [edge(3, 1, after[q])]
                if row != GONE:
                    cut = int(row.isupper())
                    to = TAKES[q].get(row.lower())
                    if to is not None:
                        paths.append(edge(cut, 3, after[to]))
                    paths.append(edge(2 + cut, 4, after[NEXT[q]]))
                took.append(min((p for p in paths if p is not None), default=None))
            after = [
                min((p for p in (took[q], edge(2, 2, took[NEXT[q]])) if p is not None), default=None) for q in range(4)]
        columns.append(after)
    return tuple(tuple(columns[end][q] for end in range(4)) for q in range(4))


def width(classes: str) -> int:
    """Bits of the letters: each row has at most an insert before it and its own."""
    return 2 * BITS * len(classes)


def letters(weight: int, bits: int) -> str:
    """The edits of a weight."""
    return "".join(LETTERS[weight >> at & 7] for at in range(bits - BITS, -1, -BITS)).rstrip()


def best_ends(classes: str, rest: list[int | None]) -> tuple[list[int | None], list[int | None]]:
    """For each start state the end state of the best way through a chunk and what follows it, and
    that way's cost; ``rest`` has the cost of what follows, by state."""
    bits, ends, costs = width(classes), [], []
    for row in lightest(classes):
        ways = [(w + (rest[m] << bits), m) for m, w in enumerate(row) if w is not None and rest[m] is not None]
        weight, end = min(ways, default=(None, None))
        ends.append(end)
        costs.append(None if weight is None else weight >> bits)
    return ends, costs


# --- rows -------------------------------------------------------------------------------------

CONV, TURN, ROLE_IN, TEXT = "conv_id", "turn", "role", "text"


def damage(df: DataFrame) -> DataFrame:
    """Conversations damaged by rule, to have something to repair: conv_id, turn, role, text and
    ``gone`` (the row was dropped; such rows stay in the frame, so that no conv_id is lost).

    crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 removes ``[.!?]``
    from it, 3 repeats it, 4 sets role user. Nulls in any column count as one space; turn stays null.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text(CONV), F.lit(":"), text(TURN)).cast("binary")) % 20
    rows = df.select(CONV, TURN, text(ROLE_IN).alias(ROLE_IN), text(TEXT).alias(TEXT), kind.alias("kind"))
    rows = rows.select(
        CONV, TURN,
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col(ROLE_IN)).alias(ROLE_IN),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace(TEXT, "[.!?]", "")).otherwise(F.col(TEXT)).alias(TEXT),
        (F.col("kind") == 0).alias("gone"),
        F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"))
    return rows.select("*", F.explode("copies")).drop("copies", "col")


def _keyed(df: DataFrame) -> DataFrame:
    """Rows with the digest that orders them within a turn and tells repeated ones."""
    body = F.concat(F.length(ROLE_IN).cast("string"), F.lit(":"), F.col(ROLE_IN), F.col(TEXT))
    return df.withColumn("digest", F.unhex(F.sha2(body, 256)))


def _faults(rows: DataFrame) -> DataFrame:
    """Narrow rows: conv_id, turn, digest, initial, blank, cut, and the first turn that has the
    same role and text (``first_null``: it is a null turn)."""
    stripped = F.rtrim(F.col(TEXT), F.lit(BLANKS))
    narrow = rows.select(
        CONV, TURN, "digest", F.substring(ROLE_IN, 1, 1).alias("initial"),
        (stripped == "").alias("blank"), (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    firsts = narrow.groupBy(CONV, "digest").agg(
        F.min(TURN).alias("first_turn"), F.max(F.col(TURN).isNull()).alias("first_null"))
    return join_splittable(narrow, firsts, [CONV, "digest"])


def _order(*more: str, last_first: bool = False) -> list[Column]:
    """The order of rows, or its reverse: conversation, turn (nulls first), digest, ``more``."""
    names = [CONV, TURN, "digest", *more]
    return [F.col(n).desc_nulls_last() if last_first else F.col(n).asc_nulls_first() for n in names]


STATS = ("n_blank", "n_duplicate", "n_truncated", "n_illegal", "n_turns", "lowest", "highest")


LEGAL = {"su", "ua", "au"}


def _chunk_type(conv: T.DataType) -> T.StructType:
    """Chunk records: the key of the first row, a running number, the classes of the rows, counts."""
    return T.StructType([
        T.StructField(CONV, conv), T.StructField(TURN, T.LongType()), T.StructField("digest", T.BinaryType()),
        T.StructField("seq", T.LongType()), T.StructField("classes", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in STATS],
        T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType())])


def _chunks(batches: Iterator[pa.RecordBatch], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    """Chunks of at most ``most`` rows, which come in order; one record per chunk."""
    done: list[dict] = []
    now: dict | None = None
    rows: list[str] = []
    before = None  # (conv, turn, digest) of the row before
    initial = ""
    seq = 0

    def close() -> None:
        if now is not None:
            done.append({**now, "classes": "".join(rows), "last_initial": initial})

    for batch in batches:
        for conv, turn, digest, letter, blank, cut, first_turn, first_null in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now[CONV] != conv or (now[CONV] is None) != (conv is None) or len(rows) == most:
                close()
                seq += 1
                now = dict.fromkeys(STATS, 0) | {
                    CONV: conv, TURN: turn, "digest": digest, "seq": seq, "lowest": None, "highest": None, "first_initial": letter}
                rows = []
            elif initial + letter not in LEGAL:
                now["n_illegal"] += 1
            same_turn = turn is None if first_null else turn is not None and turn == first_turn
            duplicate = not same_turn or before == (conv, turn, digest)
            now["n_blank"] += blank
            now["n_duplicate"] += duplicate and not blank
            now["n_truncated"] += cut and not blank and not duplicate
            if turn is not None:
                now["n_turns"] += turn != now["highest"]
                now["lowest"] = turn if now["lowest"] is None else now["lowest"]
                now["highest"] = turn
            kind = letter if letter in ("s", "u", "a") else "o"
            rows.append(GONE if blank or duplicate else kind.upper() if cut else kind)
            before, initial = (conv, turn, digest), letter
        if len(done) >= 2000:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    close()
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def _backward(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Adds to chunks that come last to first ``ends`` (the best end state by start state) and
    ``costs``; what is remembered between chunks is four costs."""
    conv, rest = object(), list(CLOSING)
    for batch in batches:
        ends, costs = [], []
        for key, classes in zip(batch.column(CONV).to_pylist(), batch.column("classes").to_pylist()):
            if key != conv:
                conv, rest = key, list(CLOSING)
            best, rest = best_ends(classes, rest)
            ends.append(best)
            costs.append(rest)
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, kind), pa.array(costs, kind)], schema=schema)


class _Walk:
    """A conversation's forward pass: chunk records and rows come in order, a chunk before its
    rows; ``edit`` is called for every edit with (letter, role, text)."""

    def __init__(self, edit: Callable[[str, str, str], None]) -> None:
        self.edit, self.state, self.cost, self.seen = edit, START, None, None
        self.queue: deque[str] = deque()
        self.at, self.spot = START, 0
        self.stats = dict.fromkeys(STATS, 0) | {"lowest": None, "highest": None}

    def chunk(self, c: dict) -> None:
        classes, end = c["classes"], c["ends"][self.state]
        if self.cost is None:
            self.cost = c["costs"][START]
        self.queue.append(letters(lightest(classes)[self.state][end], width(classes)))
        self.state = end
        s = self.stats
        for name in STATS[:5]:
            s[name] += c[name]
        if self.seen is not None:
            s["n_illegal"] += self.seen + c["first_initial"] not in LEGAL
        if c["lowest"] is not None:
            s["n_turns"] -= s["highest"] == c["lowest"]
            s["lowest"] = c["lowest"] if s["lowest"] is None else s["lowest"]
            s["highest"] = c["highest"]
        self.seen = c["last_initial"]

    def row(self, role: str, text: str) -> None:
        while True:
            edits = self.queue[0]
            if self.spot == len(edits):
                self.queue.popleft()
                self.spot = 0
                continue
            letter = edits[self.spot]
            self.spot += 1
            if letter == "I":
                self.insert()
                continue
            if letter == "R":
                role = ROLE[self.at]
            self.edit(letter, role, text)
            if letter == "R":
                self.at = NEXT[self.at]
            elif letter == "K":
                self.at = TAKES[self.at][role[0]]
            return

    def insert(self) -> None:
        self.edit("I", ROLE[self.at], "")
        self.at = NEXT[self.at]

    def end(self) -> None:
        if self.at == AFTER_U:
            self.insert()

    @property
    def gaps(self) -> int:
        s = self.stats
        return 0 if s["lowest"] is None else s["highest"] - s["lowest"] + 1 - s["n_turns"]


def _walk(batches: Iterator[pa.RecordBatch], start: Callable[[object], tuple[_Walk, Callable[[], None]]], flush: Callable) -> Iterator:
    """Drives one ``_Walk`` per conversation over the union of chunks (kind 0), rows (1) and
    dropped rows (2); ``start(conv)`` gives the walk and what to do at its end."""
    conv, walk, finish = object(), None, None
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        for i, kind in enumerate(columns["kind"]):
            key = columns[CONV][i]
            if key != conv:
                if walk is not None:
                    walk.end()
                    finish()
                conv = key
                walk, finish = start(key)
            if kind == 0:
                walk.chunk({n: c[i] for n, c in columns.items()})
            elif kind == 1:
                walk.row(columns[ROLE_IN][i], columns[TEXT][i])
        yield from flush(False)
    if walk is not None:
        walk.end()
        finish()
    yield from flush(True)


def _stream(df: DataFrame, most: int) -> DataFrame:
    """Chunks with the ends to take, rows and dropped rows, in order; whole conversations lie in
    one partition. The chunks are written once to the shared folder."""
    spark = df.sparkSession
    rows = _keyed(df)
    kind = _chunk_type(df.schema[CONV].dataType)
    schema = to_arrow_schema(kind)
    narrow = _faults(rows.where(~F.col("gone")))
    cut = narrow.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    path = scratch_path(spark, "conversation-chunks")
    cut.mapInArrow(lambda batches: _chunks(batches, schema, most), kind).write.parquet(path)
    ways = T.StructType([*kind.fields, *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("ends", "costs")]])
    back_schema = to_arrow_schema(ways)
    back = spark.read.parquet(path).select(*kind.names).repartition(CONV).sortWithinPartitions(*_order("seq", last_first=True))
    back = back.mapInArrow(lambda batches: _backward(batches, back_schema), ways)
    texts = rows.select(
        CONV, TURN, "digest", F.when(F.col("gone"), 2).otherwise(1).alias("kind"),
        ROLE_IN, F.when(~F.col("gone"), F.col(TEXT)).alias(TEXT))
    both = back.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    return both.repartition(CONV).sortWithinPartitions(*_order("kind", "seq"))


def _input(df: DataFrame) -> DataFrame:
    """The four columns, nulls of role and text as one space, and no row dropped."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return df.select(CONV, F.col(TURN).cast("long").alias(TURN), text(ROLE_IN), text(TEXT))


def repair(df: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Every edit of every conversation, in order: conv_id, position (from 0), edit (D, I, K, R),
    role and text (after the edit). The repaired conversations are the rows whose edit is not D.

    - input: conv_id (any type), turn (read as long), role, text; other columns are left out
    - null conv_id: one conversation; null turn: first; null role or text: one space
    - repeated rows: the later ones are duplicates, and go; rows of one turn stand by a digest
    - a role whose initial is not s, u or a (or is missing) must be re-roled or deleted
    - ``chunk`` (rows per table of weights) changes the cost of the work, not the result
    - an empty table gives no row; texts of any length are passed on whole
    """
    return _repair(_input(df).withColumn("gone", F.lit(False)), chunk)


def _repair(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    kind = T.StructType([
        rows.schema[CONV], T.StructField("position", T.LongType()), T.StructField("edit", T.StringType()),
        T.StructField(ROLE_IN, T.StringType()), T.StructField(TEXT, T.StringType())])
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def start(conv):
            place = iter(range(1 << 62))
            return _Walk(lambda letter, role, text: out.append((conv, next(place), letter, role, text))), lambda: None

        def flush(_last):
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out.clear()

        yield from _walk(batches, start, flush)

    return _stream(rows, chunk).mapInArrow(run, kind)


def summary(df: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: conv_id, gaps (turns missing between the first and the last),
    blank, duplicate, truncated (rows by first fault), illegal (neighbours whose initials are not
    su, ua or au), cost, audit (the edits' letters) and repaired_sha256 (of the repaired
    ``role:text`` lines). Input and rules as for :func:`repair`; all numbers are long."""
    return _summary(_input(df).withColumn("gone", F.lit(False)), chunk)


def _summary(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    kind = T.StructType([
        rows.schema[CONV], *[T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def start(conv):
            digest, audit, kept = hashlib.sha256(), [], []

            def edit(letter: str, role: str, text: str) -> None:
                audit.append(letter)
                if letter != "D":
                    if kept:
                        digest.update(b"\n")
                    else:
                        kept.append(True)
                    digest.update(f"{role}:{text}".encode())

            walk = _Walk(edit)

            def finish() -> None:
                s = walk.stats
                out.append((
                    conv, walk.gaps, s["n_blank"], s["n_duplicate"], s["n_truncated"], s["n_illegal"], walk.cost or 0,
                    "".join(audit), digest.hexdigest()))

            return walk, finish

        def flush(last):
            if out and (last or len(out) >= 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out.clear()

        yield from _walk(batches, start, flush)

    return _stream(rows, chunk).mapInArrow(run, kind)


def op11_scalar_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``conversations``, damaged by rule and repaired; one row per conv_id of the table.
    A conversation that lost all its rows has zeros, an empty audit and the hash of no text."""
    return _summary(damage(_input(table(spark, sf_dir, "conversations"))))
