"""Conversation structure repair: the cheapest edits that give a legal course of roles.

A conversation is legal if its role initials are ``(s?(ua)+)?``.  Edits of a row are
Keep (0), Rerole to user or assistant (2) and Delete (3); Insert (2) puts an
empty user or assistant row anywhere.  Blank rows and repeats of an earlier
(role, text) must go; a truncated row that stays costs 1 more.  Of the cheapest edit
lists, the one whose initials read least in ASCII is taken.

*Weights.*  An edit list is one integer: its cost in the high digits, below them a
fixed number of three-bit digits, the letters from the first one on, zeros after
the last.  Comparing two integers compares costs, then the letters, a shorter list
before its continuations.  ``solve`` goes over the graph of (row, state of the
pattern) from the end and takes the least integer of the edges' ends with
their letter put in front; nothing else is kept, the least integer at the start is read
back as the list.  Given the state, every letter has one effect, so the list decides the
roles of what is rewritten or inserted.

*Any length.*  Rows are range-sorted and numbered once, without their texts, and cut
into blocks.  Each block gives its least costs between states (a min-plus product), a
conversation's blocks are folded from the end for the cost behind each of them, then
every block is solved for its entry states (letters behind it cannot matter: two edges
with one letter lead to one node), and a fold from the front picks the entries.  A
conversation of any size is many tasks but for the folds, a row for 1,024 messages, and
for what is one value of it.  Texts move once, to be rewritten in order as a stream.

Defined cases: a null role, text, turn or id in what is hashed counts as one space, so a null
text is blank; a null id is a conversation, null turns come first and count for no gap;
rows of one turn go by role, then by the digest of role and text (copies are
adjacent).  Rows whose role's initial is none of s, u and a can be rewritten or deleted.
A conversation with no rows left has zeros, an empty list and no repaired rows; an
empty table gives no row.  Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.common import materialise, prepare

#: Rows of a block, as a power of two.
BLOCK_LOG2 = 10
SPACE = " \t\n\x0b\x0c\r"

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LETTERS = " DIKR"  # a digit is a letter's place here: ASCII order, zero for the end
WIDTH = 3
# States: nothing yet, after system, after user, after assistant.  The next role is user but after user.
STATES = 4
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FREE = [next(((role, to) for (q, role), to in NEXT.items() if q == state and role != "s")) for state in range(STATES)]
FINAL = (0, 3)
ROLES = {"s": "system", "u": "user", "a": "assistant"}
INITIALS = "sua"
BLANK, REPEAT, CUT = 1, 2, 3
FAR = 1 << 60


def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, copy): rows damaged by the crc32 of ``conv:turn``, modulo 20.

    0 drops a row, 1 empties it, 2 takes its full stops and marks, 3 repeats it, 4 makes the user say it.
    """
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(or_space(conv_col), F.lit(":"), or_space(turn_col)).cast("binary")) % 20
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), or_space(role_col).alias("role"), or_space(text_col).alias("text"), kind.alias("_kind"))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1)))
    return rows.where("_kind != 0").select("conv", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))


ORDER = ["conv", "turn", "role", "digest", "copy"]


def outline(rows: DataFrame) -> DataFrame:
    """(conv, turn, digest, initial, fault, id): every row in its order, without its text, numbered over all conversations; stored."""
    body = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(body == "", BLANK).when(F.right(body, F.lit(1)).isin(".", "!", "?"), 0).otherwise(CUT)
    initial = F.lit(len(INITIALS))
    for k, letter in enumerate(INITIALS):
        initial = F.when(F.col("role").startswith(letter), k).otherwise(initial)
    slim = rows.select("conv", "turn", "role", _digest().alias("digest"), "copy", fault.alias("fault"), initial.alias("initial"))
    slim = slim.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).withColumn("id", F.monotonically_increasing_id())
    return materialise(slim.drop("role", "copy"), "turns")


def blocks(turns: DataFrame) -> DataFrame:
    """(conv, id, codes, first, last): runs of at most 2^BLOCK_LOG2 rows of a conversation; a code is 4 x initial + first fault."""
    first = turns.groupBy("conv", "digest").agg(F.min("id").alias("id")).select("id", F.lit(True).alias("_new"))
    fault = F.when((F.col("fault") != BLANK) & F.col("_new").isNull(), REPEAT).otherwise(F.col("fault"))
    coded = turns.join(first, "id", "left").select("conv", "id", (F.col("initial") * 4 + fault).cast("byte").alias("code"))
    out = (coded.groupBy("conv", F.shiftright("id", BLOCK_LOG2).alias("_b")).agg(F.sort_array(F.collect_list(F.struct("id", "code"))).alias("_r"))
           .select("conv", F.get("_r", F.lit(0))["id"].alias("id"), F.transform("_r", lambda r: r["code"]).alias("codes")))
    w = Window.partitionBy("conv")
    return out.select("*", (F.col("id") == F.min("id").over(w)).alias("first"), (F.col("id") == F.max("id").over(w)).alias("last"))


def row_edges(code: int) -> list[list[tuple[int, int, int]]]:
    """For each state the edges (cost, digit, next state) that a row of this code allows."""
    initial, fault = INITIALS[code >> 2] if code >> 2 < len(INITIALS) else "", code & 3
    extra = TRUNCATED if fault == CUT else 0
    out = []
    for state in range(STATES):
        edges = [(DELETE, LETTERS.index("D"), state)]
        if fault not in (BLANK, REPEAT):
            if (state, initial) in NEXT:
                edges.append((KEEP + extra, LETTERS.index("K"), NEXT[state, initial]))
            edges.append((REROLE + extra, LETTERS.index("R"), FREE[state][1]))
        out.append(edges)
    return out


EDGES = [row_edges(code) for code in range(16)]
INSERT_DIGIT = LETTERS.index("I")


def _inserts(value: list[int], put) -> list[int]:
    """Least values with inserts in front; no cheapest list inserts more than once into a state."""
    for _ in range(STATES - 1):
        value = [min(value[q], put(INSERT, INSERT_DIGIT, value[FREE[q][1]])) for q in range(STATES)]
    return value


def solve(codes: list[int], behind: list[int] | None) -> tuple[list[int], list[str], list[int]]:
    """For every entry state: least cost, letters and exit state of a block; ``behind`` are the costs after it, None at the end of a conversation."""
    places = STATES * (len(codes) + 1)
    low = WIDTH * places
    mask, front = (1 << low) - 1, low - WIDTH

    def put(cost: int, digit: int, value: int) -> int:
        """``value`` with an edit before it: costs add, letters move down one place."""
        rest = value & mask
        return value - rest + (cost << low) + (digit << front) + (rest >> WIDTH)

    if behind is None:
        value = _inserts([0 if q in FINAL else FAR << low for q in range(STATES)], put)
    else:
        value = [cost << low for cost in behind]
    for code in reversed(codes):
        value = _inserts([min([put(cost, digit, value[to]) for cost, digit, to in edges]) for edges in EDGES[code]], put)
    letters = []
    for v in value:
        rest, text = v & mask, []
        for place in range(front, -1, -WIDTH):
            digit = rest >> place & (1 << WIDTH) - 1
            if not digit:
                break
            text.append(LETTERS[digit])
        letters.append("".join(text))
    return [v >> low for v in value], letters, [follow(codes, q, text) for q, text in enumerate(letters)]


def follow(codes: list[int], state: int, letters: str) -> int:
    """The state that a list of edits leads to."""
    rows = iter(codes)
    for letter in letters:
        if letter == "I":
            state = FREE[state][1]
        else:
            state = next(to for _, digit, to in EDGES[next(rows)][state] if LETTERS[digit] == letter)
    return state


def _least_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), FAR)


def _row_costs() -> np.ndarray:
    """Least cost between states of a row of each code, inserts before it included."""
    insert = np.full((STATES, STATES), FAR)
    np.fill_diagonal(insert, 0)
    for q, (_, to) in enumerate(FREE):
        insert[q, to] = INSERT
    insert = _least_plus(_least_plus(insert, insert), insert)
    out = np.full((16, STATES, STATES), FAR)
    for code, states in enumerate(EDGES):
        for q, edges in enumerate(states):
            for cost, _, to in edges:
                out[code, q, to] = min(out[code, q, to], cost)
    return _least_plus(np.broadcast_to(insert, out.shape), out)


ROW_COSTS = _row_costs()


def block_costs(codes: np.ndarray) -> np.ndarray:
    """Least cost of a block between entry and exit states."""
    held = ROW_COSTS[codes]
    while len(held) > 1:
        odd = held[len(held) & ~1:]
        held = np.concatenate([_least_plus(held[0:len(held) & ~1:2], held[1::2]), odd])
    return held[0]


LEGAL = np.zeros((4, 4), dtype=bool)
for _pair in ("su", "ua", "au"):
    LEGAL[INITIALS.index(_pair[0]), INITIALS.index(_pair[1])] = True


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Faults, illegal neighbours, border initials and, unless it is a whole conversation, costs of each block."""
    for batch in batches:
        rows = []
        for codes, first, last in zip(batch.column("codes").to_pylist(), batch.column("first").to_pylist(), batch.column("last").to_pylist()):
            codes = np.array(codes)
            who, fault = codes >> 2, np.bincount(codes & 3, minlength=4)
            rows.append((*fault[1:].tolist(), int((~LEGAL[who[:-1], who[1:]]).sum()), int(who[0]), int(who[-1]),
                         None if first and last else block_costs(codes).ravel().tolist()))
        cols = list(zip(*rows)) or [()] * 7
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.list_(pa.int64()))],
            [*batch.schema.names, "blank", "duplicate", "truncated", "illegal", "head", "tail", "costs"])


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The costs after each block of a conversation, from its last block to its first."""
    end = np.array(_inserts([0 if q in FINAL else FAR for q in range(STATES)], lambda cost, _, value: cost + value))
    for batch in batches:
        out = []
        for parts in batch.column("parts").to_pylist():
            cost = end
            for part in reversed(parts):
                out.append((part["id"], cost.tolist()))
                cost = (np.array(part["costs"]).reshape(STATES, STATES) + cost).min(axis=1)
        cols = list(zip(*out)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.int64()))], ["id", "behind"])


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [solve(codes, None if last else behind) for codes, last, behind in
               zip(*(batch.column(c).to_pylist() for c in ("codes", "last", "behind")))]
        kept = [c for c in batch.schema.names if c not in ("codes", "behind", "costs")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array([g[0][0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.list_(pa.string())),
                                          pa.array([g[2] for g in got], pa.list_(pa.int64()))], [*kept, "cost", "letters", "exits"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's list of edits from those of its blocks, and the illegal neighbours across their borders."""
    for batch in batches:
        audits, costs, more = [], [], []
        for parts in batch.column("parts").to_pylist():
            state, text, illegal = 0, [], 0
            for k, part in enumerate(parts):
                text.append(part["letters"][state])
                state = part["exits"][state]
                illegal += bool(k and not LEGAL[parts[k - 1]["tail"], part["head"]])
            audits.append("".join(text))
            costs.append(parts[0]["cost"])
            more.append(illegal)
        at = batch.schema.names.index("illegal")
        cols = [c if i != at else pa.array(np.array(c) + np.array(more, dtype=np.int64)) for i, c in enumerate(batch.columns)]
        kept = [(n, c) for n, c in zip(batch.schema.names, cols) if n != "parts"]
        yield pa.RecordBatch.from_arrays([*(c for _, c in kept), pa.array(costs, pa.int64()), pa.array(audits, pa.string())], [*(n for n, _ in kept), "cost", "audit"])


def audits(rows: DataFrame) -> DataFrame:
    """(conv, blank, duplicate, truncated, illegal, cost, audit, gaps) of every conversation in ``rows`` (columns as ``damaged`` gives them)."""
    prepare(rows.sparkSession)
    turns = outline(rows)
    ddl = f"conv {dict(rows.dtypes)['conv']}, id long, codes array<byte>, first boolean, last boolean"
    stats = ", blank long, duplicate long, truncated long, illegal long, head long, tail long"
    parts = materialise(blocks(turns).mapInArrow(_survey, ddl + stats + ", costs array<long>"), "turn-blocks")
    many = parts.where("costs is not null").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("id", "costs"))).alias("parts"))
    behind = many.select("parts").mapInArrow(_behind, "id long, behind array<long>")
    solved = parts.drop("costs").join(behind, "id", "left").select(*parts.drop("costs").columns, "behind").mapInArrow(
        _solve, f"conv {dict(rows.dtypes)['conv']}, id long, first boolean, last boolean{stats}, cost long, letters array<string>, exits array<long>")
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    whole = solved.groupBy("conv").agg(*sums, F.sort_array(F.collect_list(F.struct("id", "head", "tail", "cost", "letters", "exits"))).alias("parts"))
    whole = whole.mapInArrow(_joined, f"conv {dict(rows.dtypes)['conv']}, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    big = lambda c: c.cast("decimal(20,0)")
    gaps = turns.groupBy("conv").agg(F.coalesce((big(F.max("turn")) - big(F.min("turn")) + 1 - F.count_distinct("turn")).cast("long"), F.lit(0).cast("long")).alias("gaps"))
    out = whole.join(gaps.withColumnRenamed("conv", "_c"), F.col("conv").eqNullSafe(F.col("_c"))).drop("_c")
    return materialise(out, "audits")


def repaired(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """(conv, position, role, text): the rows with the edits of ``lists`` (conv, audit) made; each conversation in order within one partition."""
    texts = rows.select("conv", "turn", "role", _digest().alias("digest"), "copy", "text", F.lit(None).cast("string").alias("audit"))
    both = texts.unionByName(lists.select("conv", "audit"), allowMissingColumns=True)
    order = [F.col("conv"), F.col("audit").isNull(), F.col("turn"), F.col("role"), F.col("digest"), F.col("copy")]
    both = both.repartition("conv").sortWithinPartitions(*order).select("conv", "role", "text", "audit")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, at, state, position = "", 0, 0, 0
        for batch in batches:
            out: list[tuple] = []

            def inserts(conv):
                nonlocal at, state, position
                while at < len(letters) and letters[at] == "I":
                    role, state = FREE[state]
                    out.append((conv, position, ROLES[role], ""))
                    at, position = at + 1, position + 1

            for conv, role, text, audit in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text", "audit"))):
                if audit is not None:
                    letters, at, state, position = audit, 0, 0, 0
                    inserts(conv)
                    continue
                letter, at = letters[at], at + 1
                if letter != "D":
                    if letter == "R":
                        initial, state = FREE[state]
                        role = ROLES[initial]
                    else:
                        state = NEXT[state, role[0]]
                    out.append((conv, position, role, text))
                    position += 1
                inserts(conv)
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.column("conv").type), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())],
                                             ["conv", "position", "role", "text"])

    return both.mapInArrow(work, f"conv {dict(rows.dtypes)['conv']}, position long, role string, text string")


def digests(rows: DataFrame) -> DataFrame:
    """(conv, sha256) of every conversation's ``role:text`` lines, joined by line feeds; ``rows`` as ``repaired`` gives them."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        conv, state = None, None
        for batch in batches:
            ids, hexes = [], []
            for c, position, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv", "position", "role", "text"))):
                if position == 0:
                    if state is not None:
                        ids.append(conv)
                        hexes.append(state.hexdigest())
                    conv, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column("conv").type), pa.array(hexes, pa.string())], ["conv", "sha256"])
            kind = batch.column("conv").type
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([state.hexdigest()], pa.string())], ["conv", "sha256"])

    return rows.mapInArrow(work, f"conv {dict(rows.dtypes)['conv']}, sha256 string")
