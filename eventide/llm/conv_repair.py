"""Conversation structure repair by a suffix-shared automaton of signatures.

A conversation's rows, in order, read as a signature: one character per row for
its role and its fault. Repairing it is the cheapest way of keeping, re-roling,
deleting and inserting rows so that the roles read ``(s?(ua)+)?``; among equally
cheap ways the ASCII-least string of edit initials wins. What is cheapest from a
row on depends on the rest of the signature and the grammar's state alone, so
signatures share it: an automaton with one node per distinct suffix (minimised
from the end) holds, for each of the four grammar states, the cost to go and the
edits, computed once. Of equally cheap edits the next character decides (edits of
one character lead to one state), so no strings are compared.

The automaton is built in a stream: distinct signatures sorted by their reverse
stand beside those that share the longest suffix; a stack of the current word's
nodes grows from its end, and a node is computed when it is pushed.

Long conversations are cut into blocks of at most ``block_rows`` rows. A block's
four-by-four table of costs (from state to state, out of the same automaton)
tells, composed from the last block back, what each state costs behind every
block; those four numbers, less their smallest, join the block's signature as its
end mark. Nothing is kept per conversation but four numbers and the result row.

Spark's part: one range sort puts rows in conversation order (splitting long
conversations and copies over tasks); first copies are found by a map-side
minimum; blocks group at most ``block_rows`` rows; the edits come back by a join
on the signature, whose hottest (a bounded number) are broadcast. In the end a
conversation's rows stream, sorted, through one task with constant memory: its
SHA-256 is sequential by definition, and its audit is one value.

Defined cases: null ids, turns, roles and texts read as one space in the damage
key and as role or text; a null turn sorts first and counts in no gap; a null
conversation id is a conversation; rows of one turn order by role, then text, as
they are after the damage; empty texts are blank; roles other than those that
start with s, u or a can't be kept; an empty table gives no row; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import written

BLOCK_ROWS = 512             # a power of two
HOT_SHARE = 200              # a signature of more than 1/200 of the blocks is hot: under 200 are
WHITE = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1

# grammar states: nothing yet, after the system row, after a user, after an assistant
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
         (ASSISTANT, "u"): USER}
WANTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 40


# --- automaton -----------------------------------------------------------------

@dataclass(frozen=True)
class Node:
    """What is cheapest from a suffix on, per grammar state."""

    cost: tuple[int, ...]
    edits: tuple[str, ...]


def end_node(mark: str) -> Node:
    """The node behind a word: the conversation's end, or the costs behind a block."""
    if mark:
        return Node(tuple(map(int, mark.split(" "))), ("",) * 4)
    return Node((0, 2 * INSERT, INSERT, 0), ("", "II", "I", ""))


def grown(symbol: str, rest: Node) -> Node:
    """The node of ``symbol`` before ``rest``. Of equal costs the smaller initial
    wins: D, I, K, R."""
    role, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    best = []
    for state in STATES:
        ways = [(DELETE + rest.cost[state], "D", state)]
        if symbol != "d":
            if (state, role) in AFTER:
                to = AFTER[state, role]
                ways.append((KEEP + extra + rest.cost[to], "K", to))
            to = WANTED[state]
            ways.append((REROLE + extra + rest.cost[to], "R", to))
        cost, edit, to = min(ways)
        best.append((cost, edit + rest.edits[to]))

    def inserted(state: int, then: tuple[int, str]) -> tuple[int, str]:
        mine = (INSERT + then[0], "I" + then[1])
        return min(mine, best[state], key=lambda x: (x[0], x[1][0]))

    # an insertion leads to another state before the same row; two in a row at most,
    # and only into the circle of user and assistant
    best[USER], best[ASSISTANT] = inserted(USER, best[ASSISTANT]), inserted(ASSISTANT, best[USER])
    best[START], best[SYSTEM] = inserted(START, best[USER]), inserted(SYSTEM, best[USER])
    return Node(*zip(*best))


def automaton(words):
    """Nodes of ``(mark, word)`` pairs that come sorted by mark and reversed word:
    yields each pair with its node. A suffix that neighbours share is computed once."""
    mark, letters, stack = None, "", []
    for now, word in words:
        if now != mark:
            mark, letters, stack = now, "", [end_node(now)]
        back = word[::-1]
        same = 0
        while same < len(letters) and same < len(back) and letters[same] == back[same]:
            same += 1
        del stack[same + 1:]
        for symbol in back[same:]:
            stack.append(grown(symbol, stack[-1]))
        letters = back
        yield now, word, stack[-1]


def _solve(batches):
    """(mark, word, n) sorted -> the word's node."""
    def pairs():
        for batch in batches:
            yield from zip(batch.column("mark").to_pylist(), batch.column("word").to_pylist())

    rows = []
    for mark, word, node in automaton(pairs()):
        rows.append((mark, word, node.cost, node.edits))
        if len(rows) == 2000 or len(word) > 100:
            yield _solved(rows)
            rows = []
    if rows:
        yield _solved(rows)


def _solved(rows) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_pydict({
        "mark": pa.array(cols[0], pa.string()), "word": pa.array(cols[1], pa.string()),
        "cost": pa.array([list(x) for x in cols[2]], pa.list_(pa.int64())),
        "edits": pa.array([list(x) for x in cols[3]], pa.list_(pa.string()))})


def solved(words: DataFrame) -> DataFrame:
    """The nodes of distinct (mark, word) rows."""
    dealt = (words.select("mark", "word", F.reverse("word").alias("back"))
             .repartitionByRange("mark", "back").sortWithinPartitions("mark", "back"))
    return dealt.mapInArrow(_solve, "mark string, word string, cost array<long>, "
                                    "edits array<string>")


# --- rows ----------------------------------------------------------------------

def damage_kind(conv: Column, turn: Column) -> Column:
    key = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(turn.cast("string"), F.lit(" ")))
    return F.crc32(key.cast("binary")) % 20


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows (conv_id, turn, role, text) after the damage that their key names:
    dropped, emptied, without ``.!?``, repeated, said by the user."""
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    kind = F.col("kind")
    return (rows.withColumn("kind", damage_kind(F.col("conv_id"), F.col("turn")))
            .where(kind != 0)
            .select("conv_id", "turn",
                    F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_"))
            .drop("_"))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``at``, ascending in conversation order, and ``sym``: the role's
    initial (x: none of s, u, a), upper case where truncated, b where blank."""
    shown = F.rtrim(F.col("text"), F.lit(WHITE))
    role = F.substring("role", 1, 1)
    letter = F.when(role.isin("s", "u", "a"), role).otherwise("x")
    sym = (F.when(shown == "", F.lit("b"))
           .when(F.substring(shown, -1, 1).isin(".", "!", "?"), letter)
           .otherwise(F.upper(letter)))
    # equal rows are told apart by their place in the input, so that no group of
    # copies is bound to one task
    keyed = rows.withColumn("spot", F.monotonically_increasing_id())
    # within a conversation a null turn is the smallest
    order = ["conv_id", "turn", "role", "text", "spot"]
    return (keyed.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("conv_id", "turn", "role", "text", sym.alias("sym"),
                    F.monotonically_increasing_id().alias("at")))


def signatures(rows: DataFrame, block_rows: int) -> DataFrame:
    """(conv_id, block, sig) per block: a character per row, d where the same role
    and text were seen earlier in the conversation."""
    told = F.unhex(F.sha2("text", 256)).alias("told")
    firsts = (rows.where("sym <> 'b'").select("conv_id", "role", told, "at")
              .groupBy("conv_id", "role", "told").agg(F.min("at").alias("at"))
              .select("conv_id", "at", F.lit("1").alias("sym")))
    marks = rows.select("conv_id", "at", "sym").unionByName(firsts)
    block = F.shiftright("at", block_rows.bit_length() - 1)
    return (marks.groupBy("conv_id", block.alias("block"))
            .agg(F.array_sort(F.collect_list(F.struct("at", "sym"))).alias("rows"))
            .select("conv_id", "block", F.expr(
                """array_join(transform(rows, (x, i) -> CASE
                     WHEN x.sym = '1' THEN ''
                     WHEN x.sym = 'b' OR (i > 0 AND rows[i - 1].sym = '1') THEN x.sym
                     ELSE 'd' END), '')""").alias("sig")))


# --- long conversations --------------------------------------------------------

def _behind(batches):
    """End marks of blocks that come from a conversation's last block back."""
    now, costs, first = object(), None, True
    for batch in batches:
        out = []
        cols = [batch.column(c).to_pylist() for c in ("conv_id", "block", "table")]
        for conv, block, table in zip(*cols):
            if first or conv != now:
                now, first, costs = conv, False, None
            out.append("" if costs is None else " ".join(map(str, costs)))
            ends = costs or end_node("").cost
            total = [min(table[4 * a + b] + ends[b] for b in STATES) for a in STATES]
            costs = [c - min(total) for c in total]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("block"), pa.array(out, pa.string())],
            names=["conv_id", "block", "mark"])


def _marked(blocks: DataFrame) -> DataFrame:
    """Blocks with their end mark: '' at a conversation's end, else the costs behind."""
    several = F.count(F.lit(1)).over(Window.partitionBy("conv_id")) > 1
    blocks = written(blocks.withColumn("several", several), "blocks")
    parts = blocks.where("several")
    unit = [" ".join(str(0 if a == b else NEVER) for a in STATES) for b in STATES]
    words = parts.select("word").distinct().select(
        F.explode(F.array(*map(F.lit, unit))).alias("mark"), "word")
    which = F.create_map(*[x for k, u in enumerate(unit) for x in (F.lit(u), F.lit(k))])
    # row a, column b: the cost from state a before the block to state b behind it
    tables = (solved(words).groupBy("word")
              .agg(F.array_sort(F.collect_list(F.struct(which[F.col("mark")].alias("to"), "cost")))
                   .alias("c"))
              .select("word", F.expr("flatten(transform(sequence(0, 3), a -> "
                                     "transform(c, x -> x.cost[a])))").alias("table")))
    kind = blocks.schema["conv_id"].dataType.simpleString()
    marks = (parts.join(tables, "word").select("conv_id", "block", "table")
             .repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
             .mapInArrow(_behind, f"conv_id {kind}, block long, mark string")
             .select("block", "mark", F.col("conv_id").alias("c")))
    long = (parts.join(marks, (F.col("conv_id").eqNullSafe(F.col("c")))
                       & (parts["block"] == marks["block"])).drop("c").drop(marks["block"]))
    return long.unionByName(blocks.where("NOT several").withColumn("mark", F.lit(""))).drop("several")


# --- repair --------------------------------------------------------------------

RESULT = [("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"),
          ("illegal", "long"), ("cost", "long"), ("audit", "string"),
          ("repaired_sha256", "string")]


class _Conversation:
    """One conversation while its rows stream by."""

    def __init__(self):
        self.turns, self.first, self.last = 0, None, None
        self.faults, self.illegal, self.cost = {"b": 0, "d": 0, "t": 0}, 0, 0
        self.role, self.state, self.begun = None, START, False
        self.audit, self.sha = [], hashlib.sha256()      # a character per edit; a digest
        self.sig, self.edits, self.place, self.edit = "", "", 0, 0

    def block(self, sig: str, edits: list[str]) -> None:
        self._insertions()
        self.sig, self.edits, self.place, self.edit = sig, edits[self.state], 0, 0
        self.audit.append(self.edits)

    def _say(self, role: str, text: str) -> None:
        if self.begun:
            self.sha.update(b"\n")
        self.begun = True
        self.sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))

    def _insertions(self) -> None:
        while self.edit < len(self.edits) and self.edits[self.edit] == "I":
            self.edit += 1
            self.cost += INSERT
            self.state = WANTED[self.state]
            self._say(ROLE[self.state], "")

    def row(self, turn, role: str, text: str) -> None:
        symbol = self.sig[self.place]
        self.place += 1
        if turn is not None:
            if turn != self.last:
                self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        initial = role[:1]
        if self.role is not None and self.role + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = initial
        cut = symbol.isupper()
        kind = symbol if symbol in "bd" else "t" if cut else ""
        if kind:
            self.faults[kind] += 1
        self._insertions()
        edit = self.edits[self.edit]
        self.edit += 1
        if edit == "D":
            self.cost += DELETE
            return
        self.cost += (REROLE if edit == "R" else KEEP) + (TRUNCATED if cut else 0)
        if edit == "R":
            self.state = WANTED[self.state]
            role = ROLE[self.state]
        else:
            self.state = AFTER[self.state, symbol.lower()]
        self._say(role, text)

    def result(self) -> tuple:
        self._insertions()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (gaps, self.faults["b"], self.faults["d"], self.faults["t"], self.illegal,
                self.cost, "".join(self.audit), self.sha.hexdigest())


def _repair(id_type: pa.DataType):
    kinds = {"long": pa.int64(), "string": pa.string()}

    def table(ids, rows):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_pydict({
            "conv_id": pa.array(ids, id_type),
            **{n: pa.array(c, kinds[k]) for (n, k), c in zip(RESULT, cols)}})

    def run(batches):
        conv, now, ids, rows, size = None, None, [], [], 0
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in (
                "conv_id", "kind", "turn", "role", "text", "edits")]
            for key, kind, turn, role, text, edits in zip(*cols):
                if kind == 0:                    # every conversation starts with one
                    if conv is not None:
                        ids.append(now)
                        rows.append(conv.result())
                        size += len(rows[-1][6])
                        if len(ids) == 5000 or size > 1 << 20:
                            yield table(ids, rows)
                            ids, rows, size = [], [], 0
                    conv, now = _Conversation(), key
                elif kind == 1:
                    conv.block(text, edits)
                else:
                    conv.row(turn, role, text)
        if conv is not None:
            yield table([*ids, now], [*rows, conv.result()])
    return run


def repaired(conversations: DataFrame, rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation id of ``conversations``: the faults, the cheapest
    repair's cost and edits, and the digest of what it leaves.

    ``rows`` (conv_id, turn, role, text, no null role or text) are what is repaired;
    a conversation without rows gets zeros, no edits and the empty string's digest.
    """
    rows = written(ordered(rows), "ordered")
    blocks = signatures(rows, block_rows)
    # a row that must go is the same whatever its role, and whatever its fault
    blocks = _marked(blocks.withColumn("word", F.translate("sig", "b", "d")))
    blocks = written(blocks, "marked")
    counted = written(blocks.groupBy("mark", "word").count(), "words")
    nodes = written(solved(counted).join(counted, ["mark", "word"]).drop("cost"), "nodes")
    total = blocks.count()
    # under HOT_SHARE rows, by the share that makes them hot
    hot = nodes.where(F.col("count") * HOT_SHARE > total).drop("count")
    cold = nodes.where(F.col("count") * HOT_SHARE <= total).drop("count")
    often = F.broadcast(hot.withColumnRenamed("mark", "m").withColumnRenamed("word", "w"))
    is_hot = (F.col("mark") == F.col("m")) & (F.col("word") == F.col("w"))
    heads = (blocks.join(often, is_hot).drop("m", "w")
             .unionByName(blocks.join(often, is_hot, "left_anti").join(cold, ["mark", "word"])))

    bits = block_rows.bit_length() - 1
    parts = [conversations.select("conv_id").distinct().select(
                 "conv_id", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("kind")),
             heads.select("conv_id", "block", F.lit(1).alias("kind"), F.col("sig").alias("text"),
                          "edits"),
             rows.select("conv_id", F.shiftright("at", bits).alias("block"),
                         F.lit(2).alias("kind"), "at", "turn", "role", "text")]
    stream = parts[0]
    for part in parts[1:]:
        stream = stream.unionByName(part, allowMissingColumns=True)
    kind = conversations.schema["conv_id"].dataType
    return (stream.repartition("conv_id").sortWithinPartitions("conv_id", "block", "kind", "at")
            .mapInArrow(_repair(to_arrow_type(kind)),
                        f"conv_id {kind.simpleString()}, " + ", ".join(f"{n} {k}" for n, k in RESULT)))


def damaged_and_repaired(conversations: DataFrame, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The damage, then the repair: see ``repaired``."""
    ids = conversations.select(F.col(conv_col).alias("conv_id"))
    rows = damaged(conversations, conv_col, turn_col, role_col, text_col)
    return repaired(ids, rows, block_rows)
