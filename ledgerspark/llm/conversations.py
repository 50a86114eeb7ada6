"""Operator 13: conversations repaired at least cost.

The rows of a conversation, by turn, are kept, given another role, deleted, or have empty
turns inserted between them, so that the roles read ``(s?(ua)+)?`` at the least cost; among
the cheapest repairs the one whose audit (the edits' initials) is the least in ASCII wins.

Method. A node is a row position with one of four states of the pattern (nothing yet, after
the system turn, after a user turn, after an assistant turn). A backward cost DP leaves the
optimal arcs. Nodes are then ranked by the first 1, 2, 4, ... letters of their least audit
(rank pairs, as in prefix doubling), along with pointers that jump as far; the arcs of a node
bear different letters, so its least arc is known from the first level, and the ranks order
nodes, that is whole audits. The least path is read through the doubled pointers.

Scale. Conversations may be of any length, so nothing gathers one whole:

- duplicates are found by an aggregate over (conversation, role, text digest);
- narrow rows (no texts) are range-sorted by conversation and turn into blocks of bounded
  size; rows that are equal in everything are told apart by a row number, so even copies of
  one row spread over blocks;
- a conversation within one block is solved there. Of one that goes on over blocks, each
  piece yields its 4 x 4 least costs and, per entry state, the ranks of its four least audits;
  from these (one small row a piece) the entry state and the costs behind every piece follow,
  and each block solves its pieces on its own;
- texts come back by a join on the row number. Only the digest of ``query`` reads a
  conversation in one task, as one SHA-256 has to; it streams the sorted rows and holds none.

Defined cases. Null ids, roles and texts count as one space (in the id's case only for the
damage's hash: rows without id are one conversation, reported under null); rows without turn
come first. Rows of one turn are ordered by role, then by the MD5 of the text; equal rows are
copies, and the first of them is no duplicate. A role that does not start with s, u or a can
only be given another role or deleted, as can an empty one. Texts are never cut. An empty
table gives an empty result. Only conv_id, turn, role and text are read, so other columns may
have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import ship, written

#: Rows of a block, about.
BLOCK_ROWS = 50_000
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
LEGAL = ("su", "ua", "au")
COST_DELETE, COST_REROLE, COST_INSERT, COST_TRUNCATED = 2, 1, 5, 5
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
WANTED = (2, 2, 3, 2)  # the state after the next user or assistant turn
ROLE_OF = {2: "user", 3: "assistant"}
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Costs from each state at the end of a conversation: inserted turns until the pattern is whole.
AT_END = (0, 2 * COST_INSERT, COST_INSERT, 0)
INFINITE = 1 << 40
LETTERS = "DIKR"  # in ASCII order
BLOCK_SHIFT = 33  # monotonically_increasing_id: partition number above these bits

# ------------------------------------------------------------------- damage


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32 of ``conv_id:turn`` mod 20 deals each row."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(text_of("role"))
    rows = rows.select("conv_id", "turn", "role", "text", dealt.alias("h")).where("h <> 0")
    copies = F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


# ------------------------------------------------------- rows, faults, blocks


def stored(rows: DataFrame) -> DataFrame:
    """The rows with a number each, written: every later step reads the same ones."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select("conv_id", "turn", text_of("role"), text_of("text"))
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "conversation-rows")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, row, initial and fault (0 none) of stored rows; no texts."""
    visible = F.rtrim("text", F.lit(SPACE))
    narrow = rows.select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"), "row",
                         (visible == "").alias("blank"), (~F.right(visible, F.lit(1)).isin(".", "!", "?")).alias("open"))
    order = F.struct(F.col("turn").isNotNull().alias("has"), "turn", "row")
    firsts = (narrow.groupBy("conv_id", "role", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
              .where("n > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first.row"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    firsts = firsts.withColumnRenamed("row", "first_row")
    fault = (F.when(F.col("blank"), BLANK).when(F.col("first_row") != F.col("row"), DUPLICATE)
             .when(F.col("open"), TRUNCATED).otherwise(0))
    return narrow.join(firsts, same, "left").select("conv_id", "turn", "role", "digest", "row",
                                                    F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def tasks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> int:
    """Tasks for rows in a written table: a block each, and enough for all cores."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // block_rows))


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """conv_id, turn, initial, fault, row, and ``pos``, which rises in the order of the conversations; ``block`` is its upper part."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest", "row"]
    placed = faults(rows).repartitionByRange(tasks(rows, block_rows), *order).sortWithinPartitions(*order)
    placed = placed.select("conv_id", "turn", "initial", "fault", "row", F.monotonically_increasing_id().alias("pos"))
    return written(placed.withColumn("block", F.shiftright("pos", BLOCK_SHIFT)), "conversation-blocks")


def by_block(rows: DataFrame, run, schema: str, many: int) -> DataFrame:
    """``run`` over each block: its columns as lists, rows in order. A task holds one block at a time; ``many`` share them."""
    names = rows.columns

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in names]
        at = names.index("block")
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            cuts = [0, *[i for i in range(1, batch.num_rows) if columns[at][i] != columns[at][i - 1]], batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held[at] and held[at][-1] != columns[at][a]:
                    yield from run(dict(zip(names, held)))
                    held = [[] for _ in names]
                for h, c in zip(held, columns):
                    h += c[a:b]
        if held[at]:
            yield from run(dict(zip(names, held)))

    return rows.repartition(many, "block").sortWithinPartitions("block", "pos").mapInArrow(stream, schema)


def pieces_of(block: dict) -> Iterator[tuple[int, int]]:
    """Start and end of each conversation's rows in a block."""
    ids = block["conv_id"]
    cuts = [0, *[i for i in range(1, len(ids)) if ids[i] != ids[i - 1]], len(ids)]
    yield from zip(cuts, cuts[1:])


# ------------------------------------------------------------- cost and ranks


@cache
def _row(initial: str, fault: int, behind: tuple[int, ...]) -> tuple[tuple[int, ...], int, tuple[int, ...]]:
    """One DP step: costs from the four states before a row (less their least, which comes second), and each state's optimal arcs as bits."""
    extra = COST_TRUNCATED if fault == TRUNCATED else 0
    arcs = []
    for q in range(4):
        own = {0: COST_DELETE + behind[q]}
        if fault not in (BLANK, DUPLICATE):
            own[3] = COST_REROLE + extra + behind[WANTED[q]]
            if initial in KEPT[q]:
                own[2] = extra + behind[KEPT[q][initial]]
        arcs.append(own)
    return _closed(arcs)


def _closed(arcs: list[dict[int, int]]) -> tuple[tuple[int, ...], int, tuple[int, ...]]:
    cost = [min([*own.values(), INFINITE]) for own in arcs]
    for q in (2, 3, 2, 1, 0):
        cost[q] = min(cost[q], COST_INSERT + cost[WANTED[q]])
    bits = []
    for q, own in enumerate(arcs):
        own = {**own, 1: COST_INSERT + cost[WANTED[q]]}
        bits.append(sum(1 << letter for letter, c in own.items() if c == cost[q] < INFINITE))
    least = min(cost)
    return tuple(c - least if c < INFINITE else INFINITE for c in cost), least, tuple(bits)


class Graph:
    """The optimal arcs of a piece: nodes 4*i + state for positions i = 0 .. rows.

    ``behind`` are the costs from the states after the last row; with ``ends`` the
    conversation ends there and turns may still be inserted.
    """

    def __init__(self, initials: list[str], faults_: list[int], behind: tuple[int, ...], ends: bool):
        n = len(initials)
        bits: list[tuple[int, ...]] = [(0, 0, 0, 0)] * (n + 1)
        if ends:
            bits[n] = (0, 2, 2, 0)
        cost, total = behind, 0
        for i in range(n - 1, -1, -1):
            cost, least, bits[i] = _row(initials[i], faults_[i], cost)
            total += least
        self.cost = [c + total if c < INFINITE else INFINITE for c in cost]
        flat = np.array(bits, np.int8).ravel()
        lowest = flat & -flat  # the least letter of each node
        state, place = np.tile(np.arange(4), n + 1), np.repeat(np.arange(n + 1), 4)
        wanted = np.array(WANTED)[state]
        kept = np.array([[k.get(c, 0) for k in KEPT] for c in [*initials, ""]]).ravel()
        self.letter = np.select([lowest == 1, lowest == 2, lowest == 4, lowest == 8], [1, 2, 3, 4], 0)
        self.next = np.select([lowest == 1, lowest == 2, lowest == 4, lowest == 8],
                              [4 * place + 4 + state, 4 * place + wanted, 4 * place + 4 + kept, 4 * place + 4 + wanted],
                              4 * place + state)


def ranked(letter: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of the nodes by their least audit, and the pointers over 1, 2, 4, ... letters."""
    rank, jumps = np.unique(letter, return_inverse=True)[1].astype(np.int64), [following]
    while True:
        rank = np.unique(rank * (rank.max(initial=0) + 1) + rank[jumps[-1]], return_inverse=True)[1].astype(np.int64)
        further = jumps[-1][jumps[-1]]
        if np.array_equal(further, jumps[-1]):
            return rank, jumps
        jumps.append(further)


def path(start: int, letter: np.ndarray, jumps: list[np.ndarray]) -> np.ndarray:
    """The nodes of the least path from ``start``, up to the one where it ends (that one left out)."""
    nodes = np.array([start])
    for jump in jumps:
        nodes = np.concatenate([nodes, jump[nodes]])
        if letter[nodes[-1]] == 0:
            break
    return nodes[letter[nodes] > 0]


# ------------------------------------------------- pieces of long conversations

SUMMARY = ("conv_id {id}, block long, first_turn {turn}, last_turn {turn}, turns long, blank long, duplicate long, truncated long, "
           "illegal long, first_initial string, last_initial string, costs array<long>, ranks array<long>")


def _summaries(id_type: pa.DataType, turn_type: pa.DataType):
    """A row per piece; the pieces at a block's ends, which may go on in others, with their costs and ranks."""
    def run(block: dict) -> Iterator[pa.RecordBatch]:
        out = []
        size = len(block["conv_id"])
        for a, b in pieces_of(block):
            turns, initials, fault = block["turn"][a:b], block["initial"][a:b], block["fault"][a:b]
            dated = [t for t in turns if t is not None]
            costs = ranks = None
            if a == 0 or b == size:
                graphs = [Graph(initials, fault, tuple(0 if q == end else INFINITE for q in range(4)), False) for end in range(4)]
                step = len(graphs[0].letter)
                order, _ = ranked(np.concatenate([g.letter for g in graphs]), np.concatenate([g.next + k * step for k, g in enumerate(graphs)]))
                costs = [graphs[end].cost[q] for q in range(4) for end in range(4)]
                ranks = [int(order[end * step + q]) for q in range(4) for end in range(4)]
            out.append((block["conv_id"][a], block["block"][a], dated[0] if dated else None, dated[-1] if dated else None,
                        sum(i == 0 or dated[i] != dated[i - 1] for i in range(len(dated))),
                        fault.count(BLANK), fault.count(DUPLICATE), fault.count(TRUNCATED),
                        sum(initials[i - 1] + initials[i] not in LEGAL for i in range(1, b - a)),
                        initials[0], initials[-1], costs, ranks))
        longs, text = pa.int64(), pa.string()
        kinds = [id_type, longs, turn_type, turn_type, *[longs] * 5, text, text, pa.list_(longs), pa.list_(longs)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [f"c{i}" for i in range(len(kinds))])
    return run


def _named(run, schema: str):
    names = [part.split()[0] for part in schema.split(", ")]

    def renamed(block: dict) -> Iterator[pa.RecordBatch]:
        for batch in run(block):
            yield batch.rename_columns(names)
    return renamed


def _types(rows: DataFrame) -> tuple[dict[str, str], pa.DataType, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [rows.schema[c].dataType for c in ("conv_id", "turn")]
    return {"id": kinds[0].simpleString(), "turn": kinds[1].simpleString()}, *[to_arrow_type(k) for k in kinds]


def summaries(placed: DataFrame) -> DataFrame:
    """A row per conversation and block (see ``SUMMARY``)."""
    names, id_type, turn_type = _types(placed)
    schema = SUMMARY.format(**names)
    return written(by_block(placed, _named(_summaries(id_type, turn_type), schema), schema, tasks(placed)), "conversation-pieces")


def _stitched(pieces: pd.DataFrame) -> pd.DataFrame:
    """Entry state of, and costs behind, each piece of one conversation: a row a piece, so blocks bound it."""
    pieces = pieces.sort_values("block")
    costs = [np.array(c).reshape(4, 4) for c in pieces["costs"]]
    ranks = [np.array(r).reshape(4, 4) for r in pieces["ranks"]]
    behind = [np.array(AT_END)]
    for c in costs[:0:-1]:
        behind.append(np.minimum((c + behind[-1]).min(axis=1), INFINITE))
    behind.reverse()
    states, q = [], 0
    for c, r, after in zip(costs, ranks, behind):
        states.append(q)
        whole = c[q] + after
        q = min(np.flatnonzero(whole == whole.min()), key=lambda end: r[q][end])
    after = [[int(x - b.min()) if x < INFINITE else INFINITE for x in b] for b in behind]
    ends = [False] * (len(states) - 1) + [True]
    return pd.DataFrame({"conv_id": pieces["conv_id"], "block": pieces["block"], "state": states, "behind": after, "ends": ends})


def stitched(pieces: DataFrame) -> DataFrame:
    """conv_id, block, state, behind, ends for the pieces of conversations in more than one block."""
    conv = pieces.schema["conv_id"].dataType.simpleString()
    many = Window.partitionBy("conv_id")
    long_ones = pieces.withColumn("n", F.count(F.lit(1)).over(many)).where("n > 1").select("conv_id", "block", "costs", "ranks")
    return long_ones.groupBy("conv_id").applyInPandas(_stitched, f"conv_id {conv}, block long, state int, behind array<long>, ends boolean")


# -------------------------------------------------------------------- edits

EDITS = "conv_id {id}, step long, edit string, role string, row long, cost long"


def _edits(id_type: pa.DataType):
    def run(block: dict) -> Iterator[pa.RecordBatch]:
        info = [i for i, row in enumerate(block["row"]) if row is None]
        entry = {block["conv_id"][i]: (block["state"][i], tuple(block["behind"][i]), block["ends"][i]) for i in info}
        block = {k: c[len(info):] for k, c in block.items()}
        conv, step, letters, roles, rows, costs = [], [], [], [], [], []
        graphs, starts, base = [], [], 0
        for a, b in pieces_of(block):
            state, behind, ends = entry.get(block["conv_id"][a], (0, AT_END, True))
            graphs.append(Graph(block["initial"][a:b], block["fault"][a:b], behind, ends))
            starts.append((a, b, base, state))
            base += len(graphs[-1].letter)
        if not graphs:
            return
        letter = np.concatenate([g.letter for g in graphs])
        following = np.concatenate([g.next + s[2] for g, s in zip(graphs, starts)])
        _, jumps = ranked(letter, following)
        for a, b, first, state in starts:
            slot = 0
            for node in path(first + state, letter, jumps).tolist():
                i, edit = (node - first) // 4, LETTERS[letter[node] - 1]
                last = a + min(i, b - a - 1)
                role = ROLE_OF[WANTED[(node - first) % 4]] if edit in "IR" else None
                fault = block["fault"][last] == TRUNCATED
                conv.append(block["conv_id"][a])
                letters.append(edit)
                roles.append(role)
                if edit == "I":
                    step.append(8 * block["pos"][last] + (slot if i < b - a else 4 + slot))
                    slot += 1
                    rows.append(None)
                    costs.append(COST_INSERT)
                else:
                    step.append(8 * block["pos"][last] + 3)
                    slot = 0
                    rows.append(block["row"][last])
                    costs.append(COST_DELETE if edit == "D" else (edit == "R") * COST_REROLE + fault * COST_TRUNCATED)
        yield pa.RecordBatch.from_arrays([pa.array(conv, id_type), pa.array(step, pa.int64()), pa.array(letters), pa.array(roles, pa.string()),
                                          pa.array(rows, pa.int64()), pa.array(costs, pa.int64())], ["conv_id", "step", "edit", "role", "row", "cost"])
    return run


def edits(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """The chosen edits: conv_id, step (their order), edit (D, I, K, R), role (of I and R), row (null for I), cost."""
    names, id_type, _ = _types(placed)
    infos = stitched(pieces).withColumn("pos", F.lit(-1).cast("long"))
    rows = placed.drop("turn").unionByName(infos, allowMissingColumns=True)
    return by_block(rows, _edits(id_type), EDITS.format(**names), tasks(placed))


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """The repaired rows, and the figures per conversation.

    Rows: conv_id, step, edit (keep K, rerole R, insert I, delete D), role, text, cost; those of
    deleted rows have neither role nor text. Figures: conv_id, gaps, blank, duplicate, truncated, illegal.
    """
    ship(rows.sparkSession)
    own = stored(rows)
    placed = blocks(own, block_rows)
    pieces = summaries(placed)
    chosen = edits(placed, pieces)
    texts = own.select("row", F.col("role").alias("own_role"), "text")
    text = F.when(F.col("edit") == "I", "").when(F.col("edit") != "D", F.col("text"))
    role = F.coalesce("role", F.when(F.col("edit") == "K", F.col("own_role")))
    whole = chosen.join(texts, "row", "left").select("conv_id", "step", "edit", role.alias("role"), text.alias("text"), "cost")
    return whole, figures(pieces)


def figures(pieces: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal from the pieces and the seams between them."""
    order = Window.partitionBy("conv_id").orderBy("block")
    seam = F.concat(F.lag("last_initial").over(order), "first_initial")
    # Turns rise, so a piece's last dated turn is the greatest so far; a piece without any has no seam of its own.
    known = F.last("last_turn", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.withColumn("seam", (F.row_number().over(order) > 1) & ~seam.isin(*LEGAL)).withColumn("again", known == F.col("first_turn"))
    total = lambda c: F.sum(c).cast("long")
    distinct = F.sum("turns") - F.count_if(F.col("again"))
    gaps = F.max("last_turn").cast("long") - F.min("first_turn").cast("long") + 1 - distinct
    return pieces.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), total("blank").alias("blank"), total("duplicate").alias("duplicate"),
        total("truncated").alias("truncated"), (F.sum("illegal") + F.count_if(F.col("seam"))).cast("long").alias("illegal"))


# -------------------------------------------------------------------- digest


def _digest(id_type: pa.DataType):
    """Streams rows sorted by conversation and step: cost, audit and hash of each conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None

        def closed(x: dict) -> tuple:
            return x["id"], x["cost"], "".join(x["audit"]), x["hash"].hexdigest()

        for batch in batches:
            done = []
            for conv, edit, role, text, cost in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now["id"] != conv:
                    if now is not None:
                        done.append(closed(now))
                    now = {"id": conv, "cost": 0, "audit": [], "hash": hashlib.sha256(), "any": False}
                now["cost"] += cost
                now["audit"].append(edit)
                if edit != "D":
                    now["hash"].update(("\n" * now["any"] + f"{role}:{text}").encode())
                    now["any"] = True
            yield _digests(done, id_type)
        if now is not None:
            yield _digests([closed(now)], id_type)
    return run


def _digests(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*done)) or [[]] * 4
    kinds = [id_type, pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "cost", "audit", "repaired_sha256"])


def digests(whole: DataFrame) -> DataFrame:
    """conv_id, cost, audit, repaired_sha256 of repaired rows."""
    names, id_type, _ = _types(whole.withColumn("turn", F.lit(0)))
    rows = whole.repartition("conv_id").sortWithinPartitions("conv_id", "step").select("conv_id", "edit", "role", "text", "cost")
    return rows.mapInArrow(_digest(id_type), f"conv_id {names['id']}, cost long, audit string, repaired_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13_conversations: every conversation of the table, damaged and repaired."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    whole, counts = repair(damaged(rows))
    ids = rows.select("conv_id").distinct()
    counts, results = counts.withColumnRenamed("conv_id", "c"), digests(whole).withColumnRenamed("conv_id", "d")
    joined = ids.join(counts, ids["conv_id"].eqNullSafe(counts["c"]), "left").join(results, ids["conv_id"].eqNullSafe(results["d"]), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return joined.select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


# The same by a forward DP in SQL: a recursive query over the rows of every conversation at once that
# carries, for each state, the least (cost, audit) and the lines written so far.

_SQL_ROUND = "xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)"


def _sql_best(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _sql_edit(state: str, cost: str, letter: str, line: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'l': {state}.l || {line}}}"


def _sql_insert(state: str, role: str) -> str:
    return _sql_edit(state, "5", "I", f"chr(10) || '{role}:'")


def _sql_turn(state: str, letter: str, role: str) -> str:
    """A row kept (if its initial fits) or given the role."""
    keep = f"CASE WHEN lone AND i0 = '{letter}' THEN {_sql_edit(state, 'extra', 'K', 'chr(10) || role || chr(58) || text')} END"
    change = f"CASE WHEN lone THEN {_sql_edit(state, '1 + extra', 'R', f'chr(10) || {chr(39)}{role}:{chr(39)} || text')} END" if role else "NULL"
    return f"{keep}, {change}"


_SQL_FAR = "{'c': 1::BIGINT << 40, 'a': '', 'l': ''}"
SQL = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(x ORDER BY k) AS entries FROM (
    SELECT k, list_reduce(list_prepend(k, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: {_SQL_ROUND}) AS x
    FROM (SELECT unnest(range(256))::BIGINT AS k))
),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
),
dealt AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i::INT, 1))::BIGINT)),
             lambda x, y: xor(x >> 8, entries[(xor(x, y) & 255) + 1])), 4294967295::BIGINT) % 20 AS h
  FROM keyed, crc_table
),
hurt AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
  FROM dealt WHERE h <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS visible
  FROM hurt
),
judged AS (
  SELECT *, substr(role, 1, 1) AS i0,
         CASE WHEN visible = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 2
              WHEN right(visible, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM placed
),
rowed AS (SELECT *, fault NOT IN (1, 2) AS lone, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS extra FROM judged),
walk AS (
  SELECT c.conv_id, 0::BIGINT AS n,
         {{'c': 0::BIGINT, 'a': '', 'l': ''}} AS s0, {_SQL_FAR} AS s1,
         {{'c': 5::BIGINT, 'a': 'I', 'l': chr(10) || 'user:'}} AS s2,
         {{'c': 10::BIGINT, 'a': 'II', 'l': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations) c
  UNION ALL
  SELECT conv_id, n, s0, s1, t2, {_sql_best('s3', _sql_insert('t2', 'assistant'))} FROM (
    SELECT *, {_sql_best('s2', _sql_insert('s0', 'user'), _sql_insert('s1', 'user'), _sql_insert('s3', 'user'))} AS t2 FROM (
      SELECT w.conv_id, r.n, {_sql_edit('w.s0', '2', 'D', "''")} AS s0,
             {_sql_best(_sql_edit('w.s1', '2', 'D', "''"), _sql_turn('w.s0', 's', ''))} AS s1,
             {_sql_best(_sql_edit('w.s2', '2', 'D', "''"), *[_sql_turn(f'w.s{q}', 'u', 'user') for q in (0, 1, 3)])} AS s2,
             {_sql_best(_sql_edit('w.s3', '2', 'D', "''"), _sql_turn('w.s2', 'a', 'assistant'))} AS s3
      FROM walk w JOIN rowed r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.n = w.n + 1))
),
ended AS (
  SELECT conv_id, {_sql_best('s0', 's3')} AS s
  FROM walk QUALIFY n = max(n) OVER (PARTITION BY conv_id)
),
pairs AS (SELECT *, lag(i0) OVER (PARTITION BY conv_id ORDER BY n) || i0 AS pair, n > 1 AS follows FROM rowed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
         count(*) FILTER (WHERE fault = 3) AS truncated,
         count(*) FILTER (WHERE follows AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM pairs GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, s.c AS cost, s.a AS audit,
       sha256(substr(s.l, 2)) AS repaired_sha256
FROM ended e LEFT JOIN counted k ON e.conv_id IS NOT DISTINCT FROM k.conv_id"""
