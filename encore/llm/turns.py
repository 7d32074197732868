"""Repair of conversations by the cheapest edits, found by a rank-convergence parallel Viterbi.

A conversation is sound if its role initials read ``(s?(ua)+)?``. Its edits are a path through the
four states of that pattern (nothing yet, after s, after u, after a), and the cost to go from each
state is a vector that every turn, taken from the end, multiplies by a small (min, +) matrix. Turns
are cut into chunks that are worked on apart: each starts from a speculative vector, as if the
conversation ended there. Fix-up passes hand each chunk the vector that its successor has come to
and rerun it, until all handed vectors differ from those used by constants only; such products
lose rank quickly, so few passes are needed. The stitched backward costs then drive a forward trace
that at each place takes the ASCII-least letter that still leads to the least cost.

Rows are put into order by ranges of (conversation, turn, role, text), so a conversation of any
length spreads over tasks; repeats are found by hashes of role and text. Only what is one value for
a conversation (its audit and its digest, both sequences) is made in one task, through which its
rows stream chunk by chunk.

Defined cases. A null role or text counts as one space. Rows with a null turn come first; equal
turns are ordered by role and text. Rows without a conversation id are one conversation. A role
that is empty or begins otherwise can't be kept, only changed or deleted. A conversation without
rows has no edits. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.base import BLANKS, map_batches, query, ship, table, to_arrow
from encore.session import stage_table

#: States: nothing yet, after s, after u, after a. The turn that each admits next, but for s.
STATES = 4
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
#: Costs of the edits, and of a truncated turn that isn't deleted.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FAR = 1 << 30
#: Log of the most turns in a chunk.
CHUNK_BITS = 8
_PUNCT = "[.!?]"

#: Faults, in order of precedence.
SOUND, BLANK, DUPLICATE, CUT = range(4)


def kept_state(state: int, initial: str) -> int | None:
    """The state after a turn of this initial, or None where it isn't admitted."""
    if initial == "s":
        return 1 if state == 0 else None
    return {("u", 2): 2, ("a", 3): 3}.get((initial, NEXT[state]))


def edits(state: int, initial: str, fault: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a turn, in ASCII order of the letters."""
    yield "D", DELETE, state
    if fault in (BLANK, DUPLICATE):
        return
    extra = TRUNCATED if fault == CUT else 0
    if (kept := kept_state(state, initial)) is not None:
        yield "K", extra, kept
    yield "R", REROLE + extra, NEXT[state]


INITIALS = ("s", "u", "a", "-")


def turn_code(initial: Column, fault: Column) -> Column:
    """One number for what an edit's cost depends on."""
    at = F.coalesce(F.array_position(F.array(*[F.lit(i) for i in INITIALS[:3]]), initial), F.lit(0))
    return (F.when(at == 0, 3).otherwise(at - 1) * 4 + fault).cast("int")


def decoded(code: int) -> tuple[str, int]:
    return INITIALS[code // 4], code % 4


def _inserted(cost: np.ndarray) -> np.ndarray:
    """Costs to go when turns may be inserted before those with the costs given."""
    out = cost.copy()
    for _ in range(STATES):
        out = np.minimum(out, INSERT + out[..., NEXT])
    return out


#: Costs to go at the end of a conversation.
END = _inserted(np.array([0, FAR, FAR, 0], np.int64))


def _matrix(code: int) -> np.ndarray:
    """Costs from each state before a turn to each after it, with inserts before it."""
    own = np.full((STATES, STATES), FAR, np.int64)
    for state in range(STATES):
        for _, cost, after in edits(state, *decoded(code)):
            own[state, after] = min(own[state, after], cost)
    return np.minimum(_inserted(own.T).T, FAR)


MATRICES = np.stack([_matrix(c) for c in range(16)])


def backward(codes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Costs to go before each turn and after the last one."""
    out = np.empty((len(codes) + 1, STATES), np.int64)
    out[-1] = last
    for i in range(len(codes) - 1, -1, -1):
        out[i] = (MATRICES[codes[i]] + out[i + 1]).min(1)
    return out


def traced(costs: np.ndarray, codes: np.ndarray, state: int) -> tuple[list[tuple[str, int]], int]:
    """(letter, state after it) of the ASCII-least of the cheapest edits before and of each turn."""
    steps: list[tuple[str, int]] = []
    for i, code in enumerate(codes.tolist()):
        turn = {letter: (cost, after) for letter, cost, after in edits(state, *decoded(code))}
        while True:
            left = costs[i, state]
            if turn["D"][0] + costs[i + 1, state] == left:
                steps.append(("D", state))
                break
            if INSERT + costs[i, NEXT[state]] == left:
                state = NEXT[state]
                steps.append(("I", state))
                turn = {letter: (cost, after) for letter, cost, after in edits(state, *decoded(code))}
                continue
            letter = next(x for x in "KR" if x in turn and turn[x][0] + costs[i + 1, turn[x][1]] == left)
            state = turn[letter][1]
            steps.append((letter, state))
            break
    return steps, state


def closing(state: int) -> list[tuple[str, int]]:
    """The inserts at the end."""
    steps = []
    while END[state]:
        state = NEXT[state]
        steps.append(("I", state))
    return steps


# --- Spark ---------------------------------------------------------------------------------------


def in_order(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text, gone) with ``seq``, which rises by conversation, turn,
    role and text over the whole table. Equal rows may lie in several tasks."""
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    spread = turns.withColumn("_deal", F.monotonically_increasing_id() % 1024)
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = spread.repartitionByRange(n, *keys, "_deal").sortWithinPartitions(*keys, "_deal").drop("_deal")
    return stage_table(ordered.withColumn("seq", F.monotonically_increasing_id()), "turns")


def with_faults(ordered: DataFrame) -> DataFrame:
    """``ordered`` with each turn's fault."""
    same = [F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", F.lit(7), "role").alias("h2")]
    keyed = ordered.select("*", *same)
    repeated = (
        keyed.where("not gone").groupBy("conv_id", "h1", "h2")
        .agg(F.min("seq").alias("first"), F.count("*").alias("n")).where("n > 1")
        .select(F.col("conv_id").alias("c"), F.col("h1").alias("x"), F.col("h2").alias("y"), "first")
    )
    repeated = stage_table(repeated, "repeated-turns")
    joined = keyed.join(repeated, F.expr("conv_id <=> c and h1 = x and h2 = y"), "left")
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(bare == "", BLANK)
        .when(F.col("seq") > F.col("first"), DUPLICATE)
        .when(~F.substring(bare, -1, 1).rlike(_PUNCT), CUT)
        .otherwise(SOUND)
    )
    return joined.select(*ordered.columns, fault.alias("fault"))


def chunk_ends(marked: DataFrame) -> DataFrame:
    """conv_id, chunk and last (costs to go at its end, up to a constant) of the chunks of all
    conversations that have several; the last chunk of each has none, as it ends its conversation."""
    chunks = (
        marked.where("not gone")
        .groupBy("conv_id", F.shiftright("seq", CHUNK_BITS).alias("chunk"))
        .agg(F.count("*").alias("n"))
    )
    several = chunks.groupBy("conv_id").agg(F.count("*").alias("chunks")).where("chunks > 1")
    several = stage_table(several.select(F.col("conv_id").alias("c")), "long-conversations")
    codes = turn_code(F.substring("role", 1, 1), F.col("fault"))
    rows = (
        marked.where("not gone")
        .join(several, F.expr("conv_id <=> c"), "left_semi")
        .select("conv_id", F.shiftright("seq", CHUNK_BITS).alias("chunk"), "seq", codes.alias("code"))
        .groupBy("conv_id", "chunk")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "code"))).alias("turns"))
        .select("conv_id", "chunk", F.transform("turns", lambda t: t.code).alias("codes"))
    )
    rows = stage_table(rows, "chunks")
    # The successor of each chunk: chunks are 2**CHUNK_BITS times fewer than turns.
    order = stage_table(
        rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("chunk")).alias("all"))
        .select("conv_id", F.expr("inline(arrays_zip(slice(all, 1, size(all) - 1), slice(all, 2, size(all) - 1)))").alias("chunk", "follows")),
        "chunk-order",
    )
    ends = None
    while True:
        # Speculation: every chunk as if its conversation ended there; later, what it was handed.
        given = rows if ends is None else rows.join(ends.withColumnsRenamed({"conv_id": "c", "chunk": "k"}), F.expr("conv_id <=> c and chunk = k"), "left")
        given = given.select("conv_id", "chunk", "codes", (F.lit(None).cast("array<bigint>") if ends is None else F.col("last")).alias("last"))
        starts = map_batches(given, _reached, "conv_id bigint, chunk bigint, first array<bigint>")
        handed = order.join(
            starts.select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), "first"), F.expr("conv_id <=> c and follows = k")
        ).select("conv_id", "chunk", F.col("first").alias("last"))
        new = stage_table(handed, "chunk-ends")
        if ends is not None:
            before = ends.select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), F.col("last").alias("was"))
            moved = new.join(before, F.expr("conv_id <=> c and chunk = k")).where("last <> was").limit(1).count()
            if not moved:
                return new
        elif not new.limit(1).count():
            return new
        ends = new


def _reached(batch: pa.RecordBatch) -> dict:
    first = []
    for codes, last in zip(batch.column("codes"), batch.column("last")):
        codes, last = np.array(codes.as_py()), last.as_py()
        v = backward(codes, END if last is None else np.array(last, np.int64))[0]
        first.append((v - v.min()).tolist())
    return {"conv_id": batch.column("conv_id"), "chunk": batch.column("chunk"), "first": first}


RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)


class Conversation:
    """The running result of one conversation, to which chunks are added in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.state, self.cost, self.rows = conv_id, 0, 0, 0
        self.faults, self.illegal, self.before = [0] * 4, 0, None
        self.turns, self.low, self.high = 0, None, None
        self.audit: list[str] = []
        self.digest = hashlib.sha256()

    def line(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.rows else "") + f"{role}:{text}").encode())
        self.rows += 1

    def add(self, chunk: list[tuple], last: np.ndarray) -> None:
        """``chunk``: (turn, role, text, fault, code) of each of its turns."""
        for turn, role, _, fault, _ in chunk:
            self.faults[fault] += 1
            if turn is not None and turn != self.high:
                self.turns += 1
                self.low = turn if self.low is None else self.low
                self.high = turn
            if self.before is not None:
                self.illegal += (self.before + role[:1]) not in ("su", "ua", "au")
            self.before = role[:1]
        codes = np.array([c[4] for c in chunk])
        costs = backward(codes, last)
        steps, end = traced(costs, codes, self.state)
        self.cost += int(costs[0, self.state] - last[end])
        self.state = end
        rows = iter(chunk)
        for letter, state in steps:
            self.write(letter, state, None if letter == "I" else next(rows))

    def write(self, letter: str, state: int, row: tuple | None) -> None:
        self.audit.append(letter)
        if letter != "D":
            role = row[1] if letter == "K" else ROLE[state]
            self.line(role, row[2] if row else "")

    def result(self) -> tuple:
        for letter, state in closing(self.state):
            self.write(letter, state, None)
        self.cost += int(END[self.state])
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (
            self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()
        )


def repair(turns: DataFrame) -> DataFrame:
    """One row (``RESULT``) for each conversation of ``turns``: conv_id, turn, role, text, and
    ``gone`` for rows that only tell that the conversation exists."""
    spark = turns.sparkSession
    marked = stage_table(with_faults(in_order(turns)), "marked-turns")
    ends = stage_table(chunk_ends(marked), "ends").select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), "last")
    chunk = F.shiftright("seq", CHUNK_BITS)
    codes = turn_code(F.substring("role", 1, 1), F.col("fault")).alias("code")
    rows = (
        marked.withColumn("chunk", chunk)
        .join(ends, F.expr("conv_id <=> c and chunk = k"), "left")
        .select("conv_id", "chunk", "seq", "turn", "role", "text", "gone", "fault", codes, "last")
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "conv_id")
        .sortWithinPartitions("conv_id", "seq")
    )
    schema = to_arrow(spark, RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Conversation | None = None
        held: list[tuple] = []
        chunk, last, done = None, END, []

        def close_chunk():
            if held:
                own.add(held, last)
                held.clear()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "chunk", "turn", "role", "text", "gone", "fault", "code", "last")]
            for conv_id, at, turn, role, text, gone, fault, code, end in zip(*columns):
                if own is None or conv_id != own.conv_id:
                    close_chunk()
                    done += [own.result()] if own else []
                    own, chunk = Conversation(conv_id), None
                if gone:
                    continue
                if at != chunk:
                    close_chunk()
                    chunk, last = at, END if end is None else np.array(end, np.int64)
                held.append((turn, role, text, fault, code))
            if len(done) >= 1000:
                yield _rows(done, schema)
                done = []
        close_chunk()
        done += [own.result()] if own else []
        if done:
            yield _rows(done, schema)

    ship(spark)
    return rows.mapInArrow(run, RESULT)


def _rows(done: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)


def damaged(turns: DataFrame) -> DataFrame:
    """The test damage of the query: by crc32 of ``conv_id:turn`` modulo 20, a row is dropped (it
    stays as ``gone``), emptied, stripped of signs, repeated, or given to the user."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return (
        turns.select(
            F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
            F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, _PUNCT, "")).otherwise(text).alias("text"),
            (kind == 0).alias("gone"),
            F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        ).drop("copy")
    )


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair(damaged(table(spark, sf, "conversations")))
