"""Repair of the structure of conversations as a search for the lightest derivation.

A conversation has to be an optional system turn, then pairs of a user's and an assistant's turn, or
nothing. Its turns are edited one by one: kept, given another role, deleted, or new empty ones inserted.

The repair is a weighted deduction. An item says how far a conversation was read and in which state of
the pattern it is; its value is the pair (cost, audit), the audit being the initials of the edits in
order. Each rule derives an item from one that is a step behind (and, between blocks, from an item and
the block's own item), and joins their values: costs add up, audits are strung together. Joining never
gives less than the first value and keeps the order of values of one item, so Knuth's generalisation of
Dijkstra's algorithm applies: the least entry of the agenda is final when it is popped, and the search
ends when the goal is.

(Two audits of one item and of equal cost never begin one another, since they treat the same turns and
differ by insertions that would cost something. That is why stringing audits together keeps their order.)

Long conversations are cut in blocks of `BLOCK` turns. Each block derives, for each state it may be
entered in, the values of all states it may be left in, and a search over the blocks of a conversation
joins them. Turns are numbered by a range sort of all rows, so the blocks of a conversation with a third
of all rows are spread over tasks. Two steps see one conversation in one task, as its result is one row:
the search over its blocks, which holds their audits, and the digest of the repaired text, a hash that
can't be computed in parts; its turns pass by in order, and no text is kept.

Cases: a null conv_id is a conversation of its own; a null role or text is one space, so the turn is
blank; a null turn comes first; turns with equal number follow in the order of role and text; roles of
any spelling count by their first character, an empty one has none and can't be kept; gaps beyond the
longs count as the largest long; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from itertools import islice, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tillflow.llm.sharding import numbered
from tillflow.llm.storage import text_key, written

BLOCK = 512
FAULTS = 20
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
SPOKEN = {"u": "user", "a": "assistant"}
# States of the pattern and where a role's initial leads: nothing yet, after the system's turn, after a
# user's turn, after an assistant's turn. A conversation may end where nothing is open.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
ENDS = (START, ASSISTANT)
PAIRS = ("su", "ua", "au")
SPACE = " \\x09-\\x0D"
MOST_GAPS = (1 << 63) - 1


# Weighted deduction ----------------------------------------------------------

Value = tuple[int, str]


def lightest(axioms: Iterable[tuple], rules: Callable, goal=None) -> dict:
    """Least values of items, in the order in which they became final.

    axioms: (item, value); rules: item and the final values to the (item, value) it now allows; goal:
    the item that ends the search.
    """
    # A number keeps the agenda from comparing items.
    agenda = [(value, number, item) for number, (item, value) in enumerate(axioms)]
    heapq.heapify(agenda)
    pushed, final = len(agenda), {}
    while agenda and goal not in final:
        value, _, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = value
        for derived, worth in rules(item, final):
            if derived not in final:
                pushed += 1
                heapq.heappush(agenda, (worth, pushed, derived))
    return final


def joined(first: Value, cost: int, audit: str) -> Value:
    return first[0] + cost, first[1] + audit


def edits(turn: tuple[str, bool, bool]) -> list[tuple[str, str | None, int]]:
    """What may be done to a turn (initial, must go, truncated): edit, initial it then has, cost."""
    initial, must_go, truncated = turn
    ways = [(DELETE, None, COST[DELETE])]
    if must_go:
        return ways
    more = TRUNCATED if truncated else 0
    ways.append((KEEP, initial, COST[KEEP] + more))
    return ways + [(REROLE, spoken, COST[REROLE] + more) for spoken in SPOKEN]


def block_values(turns: list[tuple[str, bool, bool]], entered: int) -> dict[int, Value]:
    """Least value for each state in which a block may be left if it is entered in this one.

    What is inserted behind the last turn belongs to the next block, or to the end.
    """

    def rules(item, final):
        place, state = item
        value = final[item]
        if place == len(turns):
            return
        for edit, initial, cost in edits(turns[place]):
            after = state if initial is None else NEXT.get((state, initial))
            if after is not None:
                yield (place + 1, after), joined(value, cost, edit)
        for spoken in SPOKEN:
            after = NEXT.get((state, spoken))
            if after is not None:
                yield (place, after), joined(value, COST[INSERT], INSERT)

    final = lightest([((0, entered), (0, ""))], rules)
    return {state: value for (place, state), value in final.items() if place == len(turns)}


def chain(blocks: list[dict[int, dict[int, Value]]]) -> Value:
    """The least value of a whole conversation.

    blocks: per block, by the state it is entered in, its values by the state it is left in. An item
    between blocks and a block's own item together derive the item behind the block.
    """
    end = (len(blocks), None)

    def rules(item, final):
        place, state = item
        value = final[item]
        if place < len(blocks):
            for after, way in blocks[place].get(state, {}).items():
                yield (place + 1, after), joined(value, *way)
            return
        for spoken in SPOKEN:
            after = NEXT.get((state, spoken))
            if after is not None:
                yield (place, after), joined(value, COST[INSERT], INSERT)
        if state in ENDS:
            yield end, value

    return lightest([((0, START), (0, ""))], rules, end)[end]


class Repair:
    """Edits the turns of a conversation one after another; holds a digest, not the texts."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START
        self.digest, self.begun = hashlib.sha256(), False

    def _say(self, role: str | None, text: str) -> None:
        if role is None:
            # All that an edit can give here is the spoken role that the pattern asks for.
            role = next(SPOKEN[x] for x in SPOKEN if (self.state, x) in NEXT)
        self.state = NEXT[self.state, role[:1]]
        self.digest.update(("\n" if self.begun else "").encode() + f"{role}:{text}".encode())
        self.begun = True

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == INSERT:
            self.at += 1
            self._say(None, "")

    def turn(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit != DELETE:
            self._say(role if edit == KEEP else None, text)

    def end(self) -> str:
        self._insert()
        return self.digest.hexdigest()


# Damage and faults -----------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the damage that the checksum of their id and turn gives; `copy` numbers repeats."""
    blank = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn"))
    kind = F.crc32(F.encode(F.concat(conv, F.lit(":"), turn), "UTF-8")) % FAULTS
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    return (
        rows.select(
            "conv_id",
            "turn",
            F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
            F.when(kind == 1, F.lit(""))
            .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text)
            .alias("text"),
            kind.alias("kind"),
        )
        .where("kind <> 0")
        .withColumn("copy", F.explode(F.expr("IF(kind = 3, array(0, 1), array(0))")))
        .drop("kind")
    )


def in_order(turns: DataFrame) -> DataFrame:
    """Turns with `number`, their place among all turns of all conversations."""
    columns = ["conv_id", "turn", "role", "text", "copy"]
    rows, _ = numbered(turns.select(*columns), *columns)
    return rows.withColumnRenamed("row_number", "number")


def with_faults(turns: DataFrame) -> DataFrame:
    """number, conv_id, initial of the role, and the first fault: blank, duplicate or truncated.

    A turn is a duplicate if an earlier one of its conversation has its role and text. The earliest is
    found by grouping, where a phrase that a third of all turns have is a row a task.
    """
    spoken = F.col("text").rlike(f"[^{SPACE}]")
    rows = turns.select(
        "number",
        "conv_id",
        F.substring("role", 1, 1).alias("initial"),
        spoken.alias("spoken"),
        F.col("text").rlike(f"[.!?][{SPACE}]*\\z").alias("ended"),
        text_key(F.concat_ws("\u0000", "role", "text")).alias("key"),
    )
    repeated = (
        rows.where("spoken")
        .groupBy(F.col("conv_id").alias("of"), F.col("key").alias("of_key"))
        .agg(F.min("number").alias("earliest"), F.max("number").alias("latest"))
        .where("earliest < latest")
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    later = F.col("spoken") & F.coalesce(F.col("number") > F.col("earliest"), F.lit(False))
    return rows.join(repeated, same, "left").select(
        "number",
        "conv_id",
        "initial",
        (~F.col("spoken")).alias("blank"),
        later.alias("duplicate"),
        (F.col("spoken") & ~later & ~F.col("ended")).alias("truncated"),
    )


# Blocks and conversations ----------------------------------------------------


def _runs(batches: Iterator[pa.RecordBatch], *key: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows that follow one another with equal keys, over the ends of batches."""
    current, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            found = tuple(row[name] for name in key)
            if rows and found != current:
                yield current, rows
                rows = []
            current = found
            rows.append(row)
    if rows:
        yield current, rows


def _schema(conv_id: T.StructField, rest: str) -> T.StructType:
    return T.StructType([conv_id, *T.StructType.fromDDL(rest).fields])


def _batches(rows: Iterator[list], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Rows in batches of some hundreds."""
    kind = to_arrow_schema(schema)
    while some := list(islice(rows, 512)):
        columns = [pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), kind, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=kind)


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in PAIRS for a, b in pairwise(initials))


def block_plans(faults: DataFrame, block: int) -> DataFrame:
    """A row per block: its least values by the states it is entered and left in, and its counts.

    faults: as `with_faults` gives them, with `place`, the turn's place in its conversation.
    """
    schema = _schema(
        faults.schema["conv_id"],
        "block long, first string, last string, counts array<long>,"
        " ways array<struct<entered: int, left: int, cost: long, audit: string>>",
    )

    def derive(batches):
        def rows():
            for (conv, number), turns in _runs(batches, "conv_id", "block"):
                initials = [t["initial"] for t in turns]
                facts = [(t["initial"], t["blank"] or t["duplicate"], t["truncated"]) for t in turns]
                ways = [
                    {"entered": entered, "left": left, "cost": cost, "audit": audit}
                    for entered in ((START,) if number == 0 else range(4))
                    for left, (cost, audit) in block_values(facts, entered).items()
                ]
                counts = [sum(t[f] for t in turns) for f in ("blank", "duplicate", "truncated")]
                yield conv, number, initials[0], initials[-1], [*counts, _illegal(initials)], ways

        return _batches(rows(), schema)

    key = ["conv_id", "block"]
    return (
        faults.withColumn("block", F.expr(f"place div {block}"))
        .repartition(*key)
        .sortWithinPartitions(*key, "place")
        .mapInArrow(derive, schema)
    )


def repair_plans(blocks: DataFrame) -> DataFrame:
    """A row per conversation that has turns: counts of faults and illegal pairs, cost and audit."""
    schema = _schema(
        blocks.schema["conv_id"],
        "blank long, duplicate long, truncated long, illegal long, cost long, audit string",
    )

    def pick(batches):
        def rows():
            for (conv,), parts in _runs(batches, "conv_id"):
                by_state = []
                for part in parts:
                    states: dict = {}
                    for way in part["ways"]:
                        states.setdefault(way["entered"], {})[way["left"]] = way["cost"], way["audit"]
                    by_state.append(states)
                counts = [sum(c) for c in zip(*[p["counts"] for p in parts], strict=True)]
                counts[-1] += sum(a["last"] + b["first"] not in PAIRS for a, b in pairwise(parts))
                yield conv, *counts, *chain(by_state)

        return _batches(rows(), schema)

    in_blocks = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return in_blocks.mapInArrow(pick, schema)


def repaired_digests(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """Per conversation, the digest of its repaired text; its audit comes before its turns."""
    schema = _schema(turns.schema["conv_id"], "repaired_sha256 string")
    audits = plans.select(
        "conv_id", F.lit(-1).cast("long").alias("number"), F.lit("").alias("role"), "audit"
    )
    lines = turns.select("conv_id", "number", "role", "text").union(audits)

    def digest(batches):
        def rows():
            repair, current = None, None
            for batch in batches:
                for row in batch.to_pylist():
                    if row["number"] >= 0:
                        repair.turn(row["role"], row["text"])
                        continue
                    if repair is not None:
                        yield current, repair.end()
                    repair, current = Repair(row["text"]), row["conv_id"]
            if repair is not None:
                yield current, repair.end()

        return _batches(rows(), schema)

    in_turn = lines.repartition("conv_id").sortWithinPartitions("conv_id", "number")
    return in_turn.mapInArrow(digest, schema)


def repair_conversations(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation: faults after damage, cheapest edits and digest of what they give."""
    turns = in_order(damaged(rows))
    number = F.col("turn").cast("decimal(38,0)")
    span = F.max(number) - F.min(number) + 1 - F.count_distinct("turn")
    # Written, so that its size is known: it is sent to all tasks if it is small.
    starts = written(
        turns.groupBy("conv_id").agg(
            F.min("number").alias("start"),
            F.least(F.coalesce(span, F.lit(0)), F.lit(MOST_GAPS)).cast("long").alias("gaps"),
        ),
        "conversation-starts",
    )
    faults = with_faults(turns)
    begin = starts.select(F.col("conv_id").alias("of"), "start")
    placed = faults.join(begin, faults["conv_id"].eqNullSafe(begin["of"])).withColumn(
        "place", F.col("number") - F.col("start")
    )
    blocks = written(block_plans(placed.drop("of", "start"), block), "conversation-blocks")
    plans = written(repair_plans(blocks), "conversation-plans")
    digests = repaired_digests(turns, plans)
    results = rows.select("conv_id").distinct()
    for number, part in enumerate((starts.drop("start"), plans, digests)):
        of = f"of_{number}"
        part = part.withColumnRenamed("conv_id", of)
        results = results.join(part, F.col("conv_id").eqNullSafe(F.col(of)), "left").drop(of)
    zeros = {
        name: F.coalesce(name, F.lit(0).cast("long")).alias(name)
        for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    }
    nothing = hashlib.sha256().hexdigest()
    return results.select(
        "conv_id",
        *zeros.values(),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
