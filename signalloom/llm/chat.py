"""Chat formatting by minimum-cost role repair (operator 10).

A legal conversation is an optional system turn, then user and assistant turns in alternation, user first,
assistant last. Each message is kept, merged into the turn before it, relabelled, or preceded by empty turns;
each costs (`MERGE`, `RELABEL`, `INSERT`, `GUESS`). The cheapest repair is a shortest path through the automaton, found
by dynamic programming; of equally cheap ones the first in the order of `moves` is taken, from the left.

A message is a 4 x 4 matrix over the states in the (min, +) algebra, and matrices multiply in any grouping.
So a conversation of any length is cut into blocks of `BLOCK` messages: matrices of blocks, of blocks of
blocks, and so on, give each block the cost of what follows it, then the state it is entered in. No task ever
holds more than `BLOCK` rows of a conversation, and the rendered conversation stays one row per message:
its pieces in the order of `pos` are the text.

Defined results: messages are ordered by turn (nulls last), then role, then text, repeated rows one after the
other; unknown or null roles take the role that costs least; null texts are empty; a null conversation id is
one conversation; control tokens inside a text are escaped; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from signalloom.operators.ranking import global_rank
from signalloom.session import cut_lineage

BLOCK = 256
MERGE, INSERT, RELABEL, GUESS = 1, 2, 3, 1
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = ["", "system", "user", "assistant"]
ALIASES = {"human": USER, "prompter": USER, "bot": ASSISTANT, "gpt": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT, "developer": SYSTEM}
FAR = 1 << 40
OPEN, CLOSE, JOIN = "<|im_start|>", "<|im_end|>", "\n\n"
#: Empty turns between a state and a new turn of a role, where the automaton has such a way.
WAYS = {
    (START, SYSTEM): [], (START, USER): [], (START, ASSISTANT): [USER], (SYSTEM, USER): [], (SYSTEM, ASSISTANT): [USER],
    (USER, ASSISTANT): [], (USER, USER): [ASSISTANT], (ASSISTANT, USER): [], (ASSISTANT, ASSISTANT): [USER],
}
#: What ends a conversation: nothing after an assistant turn, else empty turns.
LAST = {START: [USER, ASSISTANT], SYSTEM: [USER, ASSISTANT], USER: [ASSISTANT], ASSISTANT: []}
ENDING = [INSERT * len(LAST[s]) for s in range(4)]


def role_of(role: str | None) -> int | None:
    name = (role or "").strip().lower()
    return ROLES.get(name, ALIASES.get(name))


def moves(state: int, role: int | None) -> list[tuple[int, int, bool]]:
    """(cost, new state, merged) of each way to take a message of a role in a state, in order of preference."""
    out = []
    wanted = [role] if role is not None else []
    for r in wanted + [x for x in (USER, ASSISTANT, SYSTEM) if x != role]:
        label = 0 if r == role else GUESS if role is None else RELABEL
        if (state, r) in WAYS:
            out.append((label + INSERT * len(WAYS[state, r]), r, False))
        if state == r:
            out.append((label + MERGE, r, True))
    return out


def matrix(role: int | None) -> list[int]:
    m = [FAR] * 16
    for s in range(4):
        for cost, t, _ in moves(s, role):
            m[4 * s + t] = min(m[4 * s + t], cost)
    return m


MATRICES = {r: matrix(r) for r in (None, SYSTEM, USER, ASSISTANT)}


def times(a: list[int], b: list[int]) -> list[int]:
    return [min(min(a[4 * i + k] + b[4 * k + j] for k in range(4)), FAR) for i in range(4) for j in range(4)]


def before(m: list[int], after: list[int]) -> list[int]:
    """Cheapest completion from each state, from what it is behind the matrix."""
    return [min(min(m[4 * s + t] + after[t] for t in range(4)), FAR) for s in range(4)]


def costs(roles: list[int | None], after: list[int]) -> list[list[int]]:
    """Cheapest completion from each state after each message of a run; the first entry is before the first."""
    out = [after]
    for r in reversed(roles):
        out.append(before(MATRICES[r], out[-1]))
    return out[::-1]


def take(state: int, role: int | None, after: list[int]) -> tuple[int, int, bool]:
    return min(moves(state, role), key=lambda m: m[0] + after[m[1]])  # min keeps the first of equals


def walk(roles: list[int | None], after: list[int], state: int) -> int:
    for r, rest in zip(roles, costs(roles, after)[1:]):
        state = take(state, r, rest)[1]
    return state


def escape(text: str | None) -> str:
    return (text or "").replace("<|im_", "<\\|im_")


def turn(role: int, text: str = "") -> str:
    return f"{OPEN}{NAMES[role]}\n{text}"


def piece(state: int, move: tuple[int, int, bool], text: str | None) -> tuple[str, int]:
    """What a message adds to the rendered conversation, and how many empty turns are in it."""
    if move[2]:
        return JOIN + escape(text), 0
    way = WAYS[state, move[1]]
    opened = [turn(r) for r in way] + [turn(move[1], escape(text))]
    return (CLOSE + "\n" if state != START else "") + f"{CLOSE}\n".join(opened), len(way)


def ending(state: int) -> str:
    return f"{CLOSE}\n" + "".join(f"{turn(r)}{CLOSE}\n" for r in LAST[state])


def grouped(df: DataFrame, keys: list[str], order: str, schema: str, make: Callable[[list[tuple]], list[tuple]]) -> DataFrame:
    """`make` over the rows of each group, in order; groups have at most BLOCK rows. One shuffle, no group gathered elsewhere."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = [df.columns.index(k) for k in keys]
    target = to_arrow_schema(T._parse_datatype_string(schema))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), target)], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        held: list[tuple] = []
        for _, g in groupby(rows, key=lambda r: tuple(r[i] for i in at)):
            held += make(list(g))
            if len(held) >= 5000:
                yield batch_of(held)
                held = []
        if held:
            yield batch_of(held)

    return df.repartition(n, *keys).sortWithinPartitions(*keys, order).mapInArrow(run, schema)


def following(blocks: DataFrame, most: int) -> DataFrame:
    """(c, b, after): cheapest completion behind each block, from (c, b, m)."""
    def inside(rows: list[tuple]) -> list[tuple]:
        after, out = list(rows[0][3]), []
        for c, b, m, *_ in reversed(rows):
            out.append((c, b, after))
            after = before(list(m), after)
        return out

    if most < BLOCK:
        first = blocks.withColumn("after", F.array(*[F.lit(x).cast("long") for x in ENDING]))
        return cut_lineage(grouped(first, ["c"], "b", "c long, b long, after array<long>", inside), "following")

    def product(rows: list[tuple]) -> list[tuple]:
        m = list(rows[0][2])
        for r in rows[1:]:
            m = times(m, list(r[2]))
        return [(rows[0][0], rows[0][1] // BLOCK, m)]

    up = blocks.select("c", "b", "m", F.floor(F.col("b") / BLOCK).alias("g"))
    above = following(cut_lineage(grouped(up, ["c", "g"], "b", "c long, b long, m array<long>", product), "above"), most // BLOCK)
    down = up.join(above.select("c", F.col("b").alias("g"), "after"), ["c", "g"]).select("c", "b", "m", "after", "g")
    return cut_lineage(grouped(down, ["c", "g"], "b", "c long, b long, after array<long>", inside), "following")


def entered(blocks: DataFrame, most: int) -> DataFrame:
    """(c, b, state): the state each block is entered in, from (c, b, ways), its map of states."""
    def inside(rows: list[tuple]) -> list[tuple]:
        state, out = rows[0][3], []
        for c, b, ways, *_ in rows:
            out.append((c, b, int(state)))
            state = ways[state]
        return out

    if most < BLOCK:
        return cut_lineage(grouped(blocks.withColumn("state", F.lit(START)), ["c"], "b", "c long, b long, state int", inside), "entered")

    def product(rows: list[tuple]) -> list[tuple]:
        ways = list(range(4))
        for r in rows:
            ways = [int(r[2][s]) for s in ways]
        return [(rows[0][0], rows[0][1] // BLOCK, ways)]

    up = blocks.select("c", "b", "ways", F.floor(F.col("b") / BLOCK).alias("g"))
    above = entered(cut_lineage(grouped(up, ["c", "g"], "b", "c long, b long, ways array<int>", product), "above"), most // BLOCK)
    down = up.join(above.select("c", F.col("b").alias("g"), "state"), ["c", "g"]).select("c", "b", "ways", "state", "g")
    return cut_lineage(grouped(down, ["c", "g"], "b", "c long, b long, state int", inside), "entered")


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, turn, role, new_role, action, inserted, cost, piece: one row per message.

    `action` is keep, merge, relabel or relabel-merge; `inserted` counts the empty turns put before a message,
    and after the last one; the pieces of a conversation in the order of `pos` are its rendered text.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string"), F.col("text").cast("string"))
    rows = rows.withColumn("_u", F.monotonically_increasing_id())
    order = [F.col("conv_id").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last(), F.col("_u")]
    ranked = cut_lineage(global_rank(rows, order), "ranked")
    ends = ranked.groupBy("conv_id").agg(F.min("rank").alias("c"), F.max("rank").alias("z"))  # a conversation is named by its first rank
    a, e = ranked.alias("a"), ends.alias("e")
    placed = a.join(e, F.col("a.conv_id").eqNullSafe(F.col("e.conv_id"))).select("a.conv_id", "turn", "role", "text", "c", (F.col("rank") - F.col("c")).alias("pos"), (F.col("z") - F.col("c")).alias("last"))
    placed = cut_lineage(placed.withColumn("c", F.col("c").cast("long")).withColumn("b", F.floor(F.col("pos") / BLOCK)), "placed")
    most = placed.agg(F.max("b")).first()[0] or 0

    def block_matrix(rows: list[tuple]) -> list[tuple]:
        m = MATRICES[role_of(rows[0][3])]
        for r in rows[1:]:
            m = times(m, MATRICES[role_of(r[3])])
        return [(rows[0][0], rows[0][1], m)]

    narrow = placed.select("c", "b", "pos", "role")
    after = following(cut_lineage(grouped(narrow, ["c", "b"], "pos", "c long, b long, m array<long>", block_matrix), "blocks"), most)

    def block_ways(rows: list[tuple]) -> list[tuple]:
        roles = [role_of(r[3]) for r in rows]
        return [(rows[0][0], rows[0][1], [walk(roles, list(rows[0][4]), s) for s in range(4)])]

    ways = grouped(narrow.join(after, ["c", "b"]), ["c", "b"], "pos", "c long, b long, ways array<int>", block_ways)
    state = entered(cut_lineage(ways, "ways"), most)
    full = placed.join(after, ["c", "b"]).join(state, ["c", "b"]).select("c", "b", "pos", "role", "after", "state", "last", "conv_id", "turn", "text")

    def rendered(rows: list[tuple]) -> list[tuple]:
        roles, state, out = [role_of(r[3]) for r in rows], rows[0][5], []
        for r, role, rest in zip(rows, roles, costs(roles, list(rows[0][4]))[1:]):
            move = take(state, role, rest)
            text, inserted = piece(state, move, r[9])
            state, cost = move[1], move[0]
            if r[2] == r[6]:
                text, inserted, cost = text + ending(state), inserted + len(LAST[state]), cost + ENDING[state]
            action = "-".join(x for x in ("relabel" if role != state else "", "merge" if move[2] else "") if x) or "keep"
            out.append((r[7], r[2], r[8], r[3], NAMES[state], action, inserted, cost, text))
        return out

    schema = "conv_id long, pos long, turn long, role string, new_role string, action string, inserted int, cost int, piece string"
    return grouped(full, ["c", "b"], "pos", schema, rendered)
