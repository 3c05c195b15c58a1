"""Conversation structure repair: the cheapest edits that make roles alternate, found by a persistent audit DP.

Edits of a conversation's rows in order: K keeps a row, R gives it the role user or assistant that fits, D deletes it
(a must for blank and duplicate rows), I inserts an empty row of the role that fits.  What remains must read as
``(s?(ua)+)?`` by role initials.  Of equally cheap edit lists the one whose string (the audit) is least is chosen.

The DP holds one best audit per state.  Audits share their prefixes: an audit is a node linked to its parent, with
ancestors at distances of powers of two and a rolling hash of the whole prefix.  Two audits of equal cost are compared
at the end of their longest common prefix, searched by hashes; that prefix is then verified node by node, and a
collision falls back to comparing the strings.

Rows are dealt by range of (conversation, turn), so a conversation of any length lies in consecutive tasks.  A task
finishes the conversations that lie inside it; those at its ends, and those of more than ``CHUNK`` rows, become pieces:
the best audit for each pair of states.  Of equal cost and states no audit is the beginning of another (what follows
would be insertions, which cost), so pieces are joined in order.  A piece is one row however many rows it holds.

Edge cases: a NULL in text or role counts as one space, NULL conversation ids are one conversation, rows without a
turn come first; rows of one turn come by role, then by a hash of role and text (128 bits, by which equal texts are
known); repeated rows are copies in that place, of which the first is the original; empty texts are blank; long texts
are dealt like others; roles that begin with no s, u or a can't be kept; a conversation without rows (``copies`` 0)
has zeros and an empty audit; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import per_process, stored

# Rows of a conversation in one piece at most, and characters of their texts (beyond these a new piece is begun).
CHUNK = 4096
CHUNK_CHARS = 4 << 20
# Whole conversations whose audit a worker process remembers, by their rows' codes of at most so many rows.
KEPT, KEPT_ROWS = 100_000, 64

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
# States: nothing yet, after system, after user, after assistant; those in which a conversation may end.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
# Codes of rows that must go, and of roles of other initials.
FORCED, OTHER = "x", "o"
# The state after a kept row by its initial, and after an inserted or reroled row; -1 where there is none.
KEEPS = {"s": (SYSTEM, -1, -1, -1), "u": (USER, USER, -1, USER), "a": (-1, -1, ASSISTANT, -1), OTHER: (-1, -1, -1, -1)}
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
MOD, BASE = (1 << 61) - 1, 911382323

SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


class Node:
    """The last edit of an audit: ``up[k]`` is the node 2^k edits before, ``mark`` the hash of the audit up to here."""

    __slots__ = ("char", "depth", "mark", "up")

    def __init__(self, parent: Node | None, char: str):
        self.char = char
        if parent is None:
            self.depth, self.mark, self.up = 0, 0, ()
            return
        self.depth, self.mark = parent.depth + 1, (parent.mark * BASE + ord(char)) % MOD
        up, at, k = [parent], parent, 0
        while len(at.up) > k:
            at = at.up[k]
            up.append(at)
            k += 1
        self.up = tuple(up)

    def at(self, depth: int) -> Node:
        node, back = self, self.depth - depth
        while back:
            k = back.bit_length() - 1
            node, back = node.up[k], back - (1 << k)
        return node

    def text(self) -> str:
        out, node = [], self
        while node.depth:
            out.append(node.char)
            node = node.up[0]
        return "".join(reversed(out))


def same(a: Node, b: Node) -> bool:
    """Whether two audits of equal length and hash are equal: shared nodes are, others are compared back to one."""
    while a is not b:
        if a.char != b.char:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Node, b: Node) -> bool:
    """Whether audit ``a`` comes before audit ``b``."""
    if a is b:
        return False
    depth = min(a.depth, b.depth)
    x, y = a.at(depth), b.at(depth)
    if x.mark == y.mark:
        return a.depth < b.depth if same(x, y) else a.text() < b.text()
    for k in range(depth.bit_length(), -1, -1):
        if len(x.up) > k and x.up[k].mark != y.up[k].mark:
            x, y = x.up[k], y.up[k]
    return x.char < y.char if same(x.up[0], y.up[0]) else a.text() < b.text()


def better(old: tuple | None, cost: int, node: Node, char: str) -> tuple:
    """The better of ``old`` (cost, node) and the audit ``node`` + ``char`` at ``cost``."""
    if old is None or cost < old[0]:
        return cost, Node(node, char)
    if cost == old[0]:
        new = Node(node, char)
        if less(new, old[1]):
            return cost, new
    return old


def insertions(best: list) -> list:
    """The best audits when a row may be inserted here; more than one round of user and assistant never pays."""
    for goal, sources in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
        for s in sources:
            if best[s] is not None:
                best[goal] = better(best[goal], best[s][0] + INSERT, best[s][1], "I")
    return best


def audits(codes: str, start: int = START) -> list[tuple[int, Node] | None]:
    """The best (cost, audit) per state for rows given by codes (a role's initial, upper case when truncated)."""
    best: list = [None] * 4
    best[start] = (0, Node(None, ""))
    best = insertions(best)
    for code in codes:
        after: list = [None] * 4
        role = code.lower()
        keeps, extra = KEEPS.get(role), TRUNCATED if role != code else 0
        for s, own in enumerate(best):
            if own is None:
                continue
            cost, node = own
            after[s] = better(after[s], cost + DELETE, node, "D")
            if code != FORCED:
                if keeps[s] >= 0:
                    after[keeps[s]] = better(after[keeps[s]], cost + extra, node, "K")
                after[NEXT[s]] = better(after[NEXT[s]], cost + REROLE + extra, node, "R")
        best = insertions(after)
    return best


def whole(codes: str) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    best = audits(codes)
    a, b = (best[e] for e in ENDS)
    cost, node = b if a is None or b is not None and (b[0] < a[0] or b[0] == a[0] and less(b[1], a[1])) else a
    return cost, node.text()


def replay(audit: str, codes: str, texts: Iterable[tuple[str, str]], state: int) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) rows: ``texts`` has the rows that need not go."""
    rows, given = iter(codes), iter(texts)
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            yield ROLE[state], ""
            continue
        code = next(rows)
        if code == FORCED:
            continue
        role, text = next(given)
        if edit == "K":
            state = KEEPS[code.lower()][state]
            yield role, text
        elif edit == "R":
            state = NEXT[state]
            yield ROLE[state], text


class Part:
    """Rows of a conversation that follow one another."""

    def __init__(self):
        self.codes: list[str] = []
        self.initials: list[str] = []  # of the rows, a run of copies as two
        self.texts: list[tuple[str, str]] = []
        self.rows = self.chars = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.lo = self.hi = None

    def add(self, turn, initial: str, code: str, copies: int, fault: str) -> None:
        if not copies:
            return
        if self.initials and self.initials[-1] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += copies - 1
        self.initials = [self.initials[0] if self.initials else initial, initial]
        self.codes.append(code * copies)
        self.rows += copies
        if fault:
            setattr(self, fault, getattr(self, fault) + copies)
        if turn is not None:
            self.turns += turn != self.hi
            self.lo, self.hi = turn if self.lo is None else self.lo, turn

    def follow(self, other: dict) -> None:
        """Add the counts of the next part (a row of ``pieces``)."""
        for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, k, getattr(self, k) + other[k])
        if other["initials"]:
            if self.initials and self.initials[-1] + other["initials"][0] not in ("su", "ua", "au"):
                self.illegal += 1
            self.initials = [(self.initials or other["initials"])[0], other["initials"][-1]]
        if other["lo"] is not None:
            self.turns -= other["lo"] == self.hi
            self.lo, self.hi = other["lo"] if self.lo is None else self.lo, other["hi"]

    def gaps(self) -> int:
        return 0 if self.lo is None else min(self.hi - self.lo + 1 - self.turns, (1 << 63) - 1)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
OUTPUTS = {"messages": ("array<struct<role:string,text:string>>", MESSAGES), "repaired_sha256": ("string", pa.string())}


class Result:
    """Gathers an output from repaired rows as they come."""

    def __init__(self, outputs: tuple[str, ...]):
        self.rows = [] if "messages" in outputs else None
        self.sha, self.any = hashlib.sha256(), False

    def take(self, rows: Iterable[tuple[str, str]]) -> Result:
        for role, text in rows:
            if self.rows is not None:
                self.rows.append({"role": role, "text": text})
            self.sha.update(f"{chr(10) * self.any}{role}:{text}".encode())
            self.any = True
        return self

    def get(self, output: str):
        return self.rows if output == "messages" else self.sha.hexdigest()


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with planted faults, and ``copies``: how often a row is there (0: dropped)."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    return rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(space("role")).alias("role"),
                       text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def dealt(rows: DataFrame) -> DataFrame:
    """The rows in order, in range partitions: equal rows of a turn are one row with their number, which is preceded by
    a row with role and text (n is NULL there) where these come for the first time in the conversation and aren't blank."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    base = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"),
                       F.col("copies").cast("long").alias("n"))
    h = [F.xxhash64(F.lit(k), F.col("role"), F.col("text")).alias(f"h{k}") for k in (1, 2)]
    blank = ~F.col("text").rlike(WORD)
    fault = F.when(blank, 2).when(F.col("text").rlike(rf"[.!?]{SPACES}*\z"), 0).otherwise(1).alias("fault")
    order = ["conv_id", "turn", "initial", "h1", "h2"]
    initial = F.substring("role", 1, 1).alias("initial")
    keys = base.select("conv_id", "turn", initial, *h, fault, "n").groupBy(*order, "fault").agg(F.sum("n").alias("n"))
    heads = base.where((F.col("n") > 0) & ~blank).groupBy("conv_id", "role", "text").agg(
        F.min("turn").alias("least"), F.max(F.col("turn").isNull().cast("int")).alias("none"))
    heads = heads.select("conv_id", F.when(F.col("none") == 0, F.col("least")).alias("turn"), initial, *h, F.lit(None).cast("int").alias("fault"),
                         F.lit(None).cast("long").alias("n"), "role", "text")
    both = heads.unionByName(keys.withColumns({"role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")}))
    return both.repartitionByRange(*order).sortWithinPartitions(*order, "n").select(*order, "fault", "n", "role", "text")


PIECE = ("part int, seq long, conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
         "{outputs}, done boolean, turns long, lo long, hi long, initials array<string>, codes string, "
         "costs array<long>, audits array<string>, texts array<struct<role:string,text:string>>")


def repair(rows: DataFrame, outputs: tuple[str, ...] = ("messages",)) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and ``outputs`` (see OUTPUTS; messages are gathered
    per conversation, digests are made as rows come) for each conversation of ``rows`` (conv_id, turn, role, text, copies)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    sheet = PIECE.format(kind=kind, outputs=", ".join(f"{o} {OUTPUTS[o][0]}" for o in outputs))
    names = [f.split()[0] for f in ("part, seq, conv_id, " + ", ".join(COUNTS) + ", cost, audit, " + ", ".join(outputs)
                                    + ", done, turns, lo, hi, initials, codes, costs, audits, texts").split(", ")]
    types = {"part": pa.int32(), "audit": pa.string(), "done": pa.bool_(), "initials": pa.list_(pa.string()), "codes": pa.string(),
             "costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string()), "texts": MESSAGES, **{o: OUTPUTS[o][1] for o in outputs}}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_id, memo = TaskContext.get().partitionId(), per_process(("audits",), dict)
        out: list[dict] = []
        size = seq = 0
        now, conv, id_type, first, cut = Part(), None, None, True, False

        def known(codes: str) -> tuple[int, str]:
            found = memo.get(codes)
            if found is None:
                found = whole(codes)
                if len(codes) <= KEPT_ROWS:
                    if len(memo) >= KEPT:
                        memo.clear()
                    memo[codes] = found
            return found

        def close(inside: bool) -> dict:
            codes = "".join(now.codes)
            row = {"part": part_id, "seq": seq, "conv_id": conv, "done": inside, "gaps": now.gaps(),
                   **{k: getattr(now, k) for k in COUNTS[1:]}}
            if inside:
                cost, audit = known(codes)
                made = Result(outputs).take(replay(audit, codes, now.texts, START))
                return row | {"cost": cost, "audit": audit, **{o: made.get(o) for o in outputs}}
            best = [b for s in range(4) for b in audits(codes, s)]
            return row | {"turns": now.turns, "lo": now.lo, "hi": now.hi, "initials": now.initials, "codes": codes,
                          "costs": [b and b[0] for b in best], "audits": [b and b[1].text() for b in best],
                          "texts": [{"role": r, "text": t} for r, t in now.texts]}

        def batch_of(found: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in found], id_type if n == "conv_id" else types.get(n, pa.int64()))
                                               for n in names], names)

        started, head = False, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for c, turn, initial, h1, h2, fault, n, role, text in zip(*(col.to_pylist() for col in batch.columns)):
                if not started:
                    conv, started = c, True
                elif c != conv:
                    out.append(close(not first and not cut))
                    seq, first, cut, conv, now, head = seq + 1, False, False, c, Part(), None
                if n is None:
                    head = (turn, h1, h2, role, text)
                    continue
                own = fault == 2 or head is None or head[:3] != (turn, h1, h2)
                letter = initial if initial and initial in "sua" else OTHER
                while n > 0:
                    if now.rows >= CHUNK or now.chars > CHUNK_CHARS:
                        out.append(close(False))
                        seq, cut, now = seq + 1, True, Part()
                    if own:
                        some = min(n, CHUNK - now.rows)
                        now.add(turn, initial, FORCED, some, "blank" if fault == 2 else "duplicate")
                    else:
                        some, own = 1, True
                        now.add(turn, initial, letter.upper() if fault else letter, 1, "truncated" if fault else "")
                        now.texts.append(head[3:])
                        now.chars += len(head[4])
                    n -= some
                    size += some
                if len(out) >= 1024 or size >= 16 * CHUNK or now.chars > CHUNK_CHARS:
                    if out:
                        yield batch_of(out)
                    out, size = [], 0
        if started:
            out.append(close(False))
        if out:
            yield batch_of(out)

    found, _ = stored(dealt(rows).mapInArrow(scan, sheet), "audits")
    result = ["conv_id", *COUNTS, "cost", "audit", *outputs]
    joined = _joined(found.where(~F.col("done")), kind, outputs)
    return found.where("done").select(*result).unionByName(joined.select(*result))


def _chosen(pieces: list[dict]) -> tuple[int, list[tuple[int, str]]]:
    """The cheapest way through the pieces of a conversation: its cost, and per piece the state before and the audit."""
    best: list = [None] * 4  # (cost, path); a path is (path before, state before, audit)
    best[START] = (0, None)

    def tail_less(a, b) -> bool:
        x, y = [], []
        while a is not b:
            x.append(a[2])
            y.append(b[2])
            a, b = a[0], b[0]
        return "".join(reversed(x)) < "".join(reversed(y))

    for p in pieces:
        after: list = [None] * 4
        for s in range(4):
            for e in range(4):
                step = p["costs"][4 * s + e]
                if best[s] is None or step is None:
                    continue
                way = (best[s][0] + step, (best[s][1], s, p["audits"][4 * s + e]))
                if after[e] is None or way[0] < after[e][0] or way[0] == after[e][0] and tail_less(way[1], after[e][1]):
                    after[e] = way
        best = after
    a, b = (best[e] for e in ENDS)
    cost, path = b if a is None or b is not None and (b[0] < a[0] or b[0] == a[0] and tail_less(b[1], a[1])) else a
    out = []
    while path is not None:
        out.append((path[1], path[2]))
        path = path[0]
    return cost, out[::-1]


def _joined(pieces: DataFrame, kind: str, outputs: tuple[str, ...]) -> DataFrame:
    """The results of conversations in pieces.  First the states between pieces are chosen, from the best audits alone;
    then a conversation's pieces come in order with their texts, of which one at a time is in memory."""
    # a NULL id has a group of its own: the key is the id as text, which a prefix tells from NULL
    keyed = pieces.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    order = ["key", "part", "seq"]

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[dict]]]:
        key, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["key"] != key:
                    yield key, held
                    held = []
                key = row["key"]
                held.append(row)
        if held:
            yield key, held

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in groups(batches):
            cost, ways = _chosen(own)
            cols = [[p["part"] for p in own], [p["seq"] for p in own], [cost] * len(own), [s for s, _ in ways], [a for _, a in ways]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string()))],
                                             ["part", "seq", "cost", "state", "audit"])

    ways = (keyed.select(*order, "costs", "audits").repartition("key").sortWithinPartitions(*order)
            .mapInArrow(choose, "part int, seq long, cost long, state int, audit string"))
    both = keyed.drop("cost", "audit", "costs", "audits", *outputs).join(ways, ["part", "seq"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, id_type, sums, made, audit, cost, conv = None, None, None, None, [], 0, None

        def row() -> pa.RecordBatch:
            cells = [conv, sums.gaps(), sums.blank, sums.duplicate, sums.truncated, sums.illegal, cost, "".join(audit), *(made.get(o) for o in outputs)]
            kinds = [id_type, *[pa.int64()] * 6, pa.string(), *(OUTPUTS[o][1] for o in outputs)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(cells, kinds)], ["conv_id", *COUNTS, "cost", "audit", *outputs])

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for i in range(batch.num_rows):
                p = batch.slice(i, 1).to_pylist()[0]
                if p["key"] != key:
                    if key is not None:
                        yield row()
                    key, conv, sums, made, audit = p["key"], p["conv_id"], Part(), Result(outputs), []
                sums.follow(p)
                cost = p["cost"]
                audit.append(p["audit"])
                made.take(replay(p["audit"], p["codes"], ((t["role"], t["text"]) for t in p["texts"]), p["state"]))
        if key is not None:
            yield row()

    sheet = f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, cost long, audit string, " + ", ".join(f"{o} {OUTPUTS[o][0]}" for o in outputs)
    return both.repartition("key").sortWithinPartitions(*order).mapInArrow(finish, sheet)
