"""Conversation repair by a generalised LR parser over the grammar of roles.

The grammar's LR(0) automaton is built from its rules. A parser's stack is a node that knows its state and the node below, and
equal stacks are one node: the graph-structured stack. After each row the parser holds a set of nodes, the stack tops that edits
can lead to, each with the least (cost, audit) of all ways there; ways that meet at one node are merged by that minimum. The
rules are left-recursive, so a stack never grows beyond a few nodes, and what a role does to a node is worked out once.

Turns are rows of one order over all conversations, cut into stretches by range. A stretch that begins inside a conversation is
parsed from every node, so that it tells the least (cost, audit) from each node to each; stretches of a conversation are then put
together in order. Audits of one cost over the same rows are never beginnings of one another, as an audit's edits make its cost,
so the least of the parts gives the least of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import cut_lineage

#: Rules of the conversation: maybe a system turn, then pairs of user and assistant turns; or nothing.
RULES = (("talk", ()), ("talk", ("pairs",)), ("talk", ("s", "pairs")), ("pairs", ("pair",)), ("pairs", ("pairs", "pair")), ("pair", ("u", "a")))
ROLES = {"u": "user", "a": "assistant"}
#: What edits cost; keeping costs nothing. A truncated row that is not deleted costs one more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"
#: Rows of a conversation that are parsed before their result is passed on, at most.
STRETCH_ROWS = 4096

Best = dict[int, tuple[int, str]]


class Automaton:
    """LR(0) states of the rules, and the nodes of the graph-structured stack that roles lead to."""

    def __init__(self, rules=RULES, start: str = "talk"):
        self.rules, self.goal = rules, start
        self.names = {left for left, _ in rules}
        first = self._closed({(i, 0) for i, (left, _) in enumerate(rules) if left == start})
        self.nodes: list[tuple[frozenset, int]] = [(first, -1)]  # a node: its state and the node below
        self.known = {self.nodes[0]: 0}
        # every node that some sequence of roles leads to after the reductions that it allows
        self.moves: dict[tuple[int, str], tuple[int, ...]] = {}
        todo, seen = [0], {0}
        terminals = sorted({x for _, right in rules for x in right} - self.names)
        while todo:
            node = todo.pop()
            for role in terminals:
                self.moves[node, role] = self._shifted(node, role)
                todo += [n for n in self.moves[node, role] if n not in seen]
                seen.update(self.moves[node, role])
        self.tops = sorted(seen)
        self.final = {node for node in self.tops if self._accepts(node)}

    def _closed(self, items: set) -> frozenset:
        found, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            right = self.rules[rule][1]
            if dot < len(right) and right[dot] in self.names:
                new = {(i, 0) for i, (left, _) in enumerate(self.rules) if left == right[dot]} - found
                found |= new
                todo += new
        return frozenset(found)

    def _pushed(self, node: int, symbol: str) -> int | None:
        items = {(i, dot + 1) for i, dot in self.nodes[node][0] if self.rules[i][1][dot : dot + 1] == (symbol,)}
        if not items:
            return None
        new = self._closed(items), node
        if new not in self.known:
            self.known[new] = len(self.nodes)
            self.nodes.append(new)
        return self.known[new]

    def _reduced(self, node: int) -> Iterator[int]:
        """Nodes that reductions lead to, over and over, the rules of the goal left out: nothing comes after it."""
        for i, dot in self.nodes[node][0]:
            left, right = self.rules[i]
            if dot == len(right) and left != self.goal:
                below = node
                for _ in right:
                    below = self.nodes[below][1]
                top = self._pushed(below, left)
                if top is not None:
                    yield top
                    yield from self._reduced(top)

    def _shifted(self, node: int, role: str) -> tuple[int, ...]:
        top = self._pushed(node, role)
        if top is None:
            return ()
        # a node with nothing but a finished rule acts through its reductions alone
        found = [top, *self._reduced(top)]
        return tuple(n for n in found if any(dot < len(self.rules[i][1]) or self.rules[i][0] == self.goal for i, dot in self.nodes[n][0]))

    def _accepts(self, node: int) -> bool:
        return any(dot == len(self.rules[i][1]) and self.rules[i][0] == self.goal for i, dot in self.nodes[node][0])


AUTOMATON = Automaton()


def _merge(into: Best, node: int, way: tuple[int, str]) -> bool:
    if node in into and into[node] <= way:
        return False
    into[node] = way
    return True


def _inserted(tops: Best) -> Best:
    """tops after any number of inserted turns."""
    found, todo = dict(tops), list(tops)
    while todo:
        node = todo.pop()
        cost, audit = found[node]
        for role in ROLES:
            todo += [n for n in AUTOMATON.moves.get((node, role), ()) if _merge(found, n, (cost + INSERT, audit + "I"))]
    return found


def _edited(tops: Best, row: str) -> Best:
    """tops after a row, kept, given another role, or deleted."""
    out: Best = {}
    role, extra = row.lower(), TRUNCATED if row.isupper() or row == "!" else 0
    for node, (cost, audit) in tops.items():
        _merge(out, node, (cost + DELETE, audit + "D"))
        if row != "x":
            for n in AUTOMATON.moves.get((node, role), ()):
                _merge(out, n, (cost + extra, audit + "K"))
            for other in ROLES:
                for n in AUTOMATON.moves.get((node, other), ()):
                    _merge(out, n, (cost + REROLE + extra, audit + "R"))
    return out


@lru_cache(maxsize=1 << 14)
def parsed(rows: str, node: int = 0) -> tuple[tuple[int, int, str], ...]:
    """(top, cost, audit) of each node that edits lead to from a node. A row is a letter: x has to be deleted, s, u, a are the
    roles, - any other; truncated rows in capitals, ! for -."""
    tops = _inserted({node: (0, "")})
    for row in rows:
        tops = _inserted(_edited(tops, row))
    return tuple((n, cost, audit) for n, (cost, audit) in sorted(tops.items()))


def repaired(stretches: list[dict[int, tuple[tuple[int, int, str], ...]]]) -> tuple[int, str]:
    """Least cost and audit of a conversation, from what its stretches, in order, lead to from each node."""
    tops: dict[int, tuple[int, list[str]]] = {0: (0, [])}
    for stretch in stretches:
        found: dict[int, tuple[int, list[str]]] = {}
        for node, (cost, audits) in tops.items():
            for top, more, audit in stretch[node]:
                way = cost + more, [*audits, audit]
                if top not in found or way[0] < found[top][0] or way[0] == found[top][0] and "".join(way[1]) < "".join(found[top][1]):
                    found[top] = way
        tops = found
    cost, audits = min((cost, "".join(audits)) for node, (cost, audits) in tops.items() if node in AUTOMATON.final)
    return cost, audits


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies (1 or 2) of the rows that damage leaves. Null roles, texts and, in the key, ids count as
    one space."""
    own = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(own["conv_id"], F.lit(":"), own["turn"])) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(own["text"], "[.!?]", "")).otherwise(own["text"])
    role = F.when(kind == 4, "user").otherwise(own["role"])
    named = [F.col(c).cast("bigint").alias(c) for c in ("conv_id", "turn")]
    left = turns.filter(kind != 0).select(*named, role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("copies"))
    return left.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _order() -> list[Column]:
    """Rows of a conversation: by turn, nulls first; then by role and a digest of the text, so that equal rows are neighbours."""
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, fault of the different rows and copies, how often each is there. Copies after the first are
    duplicates whatever fault is; fault: null, blank, duplicate or truncated."""
    last = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
    fault = F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated")
    alike = rows.select("conv_id", "turn", "role", "digest", fault.alias("fault"), "copies").groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("copies").alias("copies"))
    alike = cut_lineage(alike, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = alike.groupBy(F.col("conv_id").alias("of"), F.col("role").alias("by"), F.col("digest").alias("said")).agg(F.min(place).alias("first"))
    found = alike.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("by")) & (F.col("digest") == F.col("said")))
    seen = (F.col("first") != place) & (F.coalesce("fault", F.lit("")) != "blank")
    return cut_lineage(found.select("conv_id", "turn", "role", "digest", F.when(seen, "duplicate").otherwise(F.col("fault")).alias("fault"), "copies"), "faults")


STRETCH = "conv_id bigint, at bigint, whole boolean, first string, last string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, ways array<struct<node:int,top:int,cost:bigint,audit:string>>"


def stretches(rows: DataFrame, size: int = STRETCH_ROWS) -> DataFrame:
    """Runs of rows of one conversation in one task, parsed: counts of faults and of illegal neighbours, first and last initial,
    and ways; at orders the runs of a conversation. rows: as from faults, ordered."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("whole", pa.bool_()), ("first", pa.string()), ("last", pa.string())])
        way = pa.struct([("node", pa.int32()), ("top", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
        schema = pa.schema([*schema, *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")), ("ways", pa.list_(way))])
        out: list[tuple] = []
        run: list[str] = []
        tally: dict = {}
        conv: int | None = None
        at, part = 0, 0
        fresh = False  # whether the run begins with its conversation for sure

        def close() -> None:
            nonlocal run, tally, at
            if tally:
                nodes = [0] if fresh and tally["from"] == 0 else AUTOMATON.tops
                ways = [(node, *found) for node in nodes for found in parsed("".join(run), node)]
                keys = ("node", "top", "cost", "audit")
                out.append((conv, (part << 32) + at, len(nodes) == 1, tally["first"], tally["last"], tally["blank"], tally["duplicate"], tally["truncated"], tally["illegal"], [dict(zip(keys, w, strict=True)) for w in ways]))
                at += 1
            run, tally = [], {}

        begun = False
        for batch in batches:
            for conv_id, split, role, fault, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not begun or conv_id != conv:
                    close()
                    fresh, conv, at, part, begun = begun, conv_id, 0, split, True
                initial = role[:1]
                letter = initial if initial in ("s", "u", "a") else "-"
                again = "blank" if fault == "blank" else "duplicate"  # what every copy but the first is
                while copies:
                    if len(run) >= size:
                        close()
                    more = min(copies, size - len(run))
                    if not tally:
                        tally = {"from": at, "first": initial, "last": initial, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
                    else:
                        tally["illegal"] += tally["last"] + initial not in LEGAL
                    tally["illegal"] += (more - 1) * (initial + initial not in LEGAL)
                    tally["last"] = initial
                    if fault:
                        tally[fault] += 1
                    tally[again] += more - 1
                    run += ["x" if fault in ("blank", "duplicate") else letter if fault is None else "!" if letter == "-" else letter.upper(), *"x" * (more - 1)]
                    copies -= more
                    fault = again
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    order = _order()
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv_id", F.spark_partition_id().cast("bigint"), "role", "fault", F.col("copies").cast("bigint")).mapInArrow(parse, STRETCH)


def combined(runs: DataFrame) -> DataFrame:
    """conv_id, blank, duplicate, truncated, illegal, cost, audit of each conversation, from its stretches."""

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            illegal, costs, audits = [], [], []
            for inside, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                ways: list[dict] = []
                for part in parts:
                    ways.append({})
                    for w in part["ways"]:
                        ways[-1].setdefault(w["node"], []).append((w["top"], w["cost"], w["audit"]))
                cost, audit = repaired(ways)
                illegal.append(inside + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:])))
                costs.append(cost)
                audits.append(audit)
            columns = [*(batch.column(i) for i in (0, 3, 4, 5)), pa.array(illegal, pa.int64()), pa.array(costs, pa.int64()), pa.array(audits, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    sums = [F.sum(c).alias(c) for c in ("illegal", "blank", "duplicate", "truncated")]
    parts = F.array_sort(F.collect_list(F.struct("at", "first", "last", "ways"))).alias("parts")
    of_each = runs.groupBy("conv_id").agg(sums[0], parts, *sums[1:])
    return of_each.mapInArrow(put_together, "conv_id bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of each repaired conversation. rows: damaged rows; found: conv_id, audit.

    A conversation's audit and its rows reach one task in order, and are hashed as they pass; none are held but the audit.
    A conversation is one message to SHA-256, so that its texts pass one task whatever their number is.
    """

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        begun = False
        ids: list = []
        hexes: list = []

        def turn(role: str, text: str) -> None:
            state["sha"].update((("\n" if state["roles"] else "") + role + ":").encode())
            state["sha"].update(text.encode())
            state["roles"] = role[:1]

        def insert() -> None:
            while state["audit"][state["at"] : state["at"] + 1] == "I":
                state["at"] += 1
                turn(ROLES[due()], "")

        def due() -> str:
            return "a" if state["roles"] == "u" else "u"

        def close() -> None:
            if begun:
                insert()
                ids.append(state["conv"])
                hexes.append(state["sha"].hexdigest())

        for batch in batches:
            for conv, kind, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not kind:
                    close()
                    begun, state = True, {"conv": conv, "audit": text, "at": 0, "sha": hashlib.sha256(), "roles": ""}
                    continue
                for _ in range(copies):
                    insert()
                    edit = state["audit"][state["at"]]
                    state["at"] += 1
                    if edit != "D":
                        turn(role if edit == "K" else ROLES[due()], text)
            if len(ids) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hexes)], ["conv_id", "repaired_sha256"])
                ids, hexes = [], []
        close()
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hexes, pa.string())], ["conv_id", "repaired_sha256"])

    none = F.lit(None)
    heads = found.select("conv_id", F.lit(0).alias("kind"), none.cast("bigint").alias("turn"), none.cast("string").alias("role"), none.cast("binary").alias("digest"), F.col("audit").alias("text"), F.lit(0).alias("copies"))
    both = heads.unionByName(rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "copies"))
    order = _order()
    dealt = both.repartition("conv_id").sortWithinPartitions(order[0], "kind", *order[1:])
    return dealt.select("conv_id", "kind", "role", "text", "copies").mapInArrow(hash_rows, "conv_id bigint, repaired_sha256 string")


def repair(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conv_id of turns.

    turns: conv_id, turn, role, text; other columns are left aside. Rows are damaged first (see damaged). Null is a conv_id as
    well; null turns come first; rows of one turn are ordered by role and a digest of the text, so that repeated rows are
    duplicates of one another. A conversation without rows after damage, and only that, has zeros, an empty audit and the hash
    of nothing.
    """
    rows = damaged(turns)
    found = faults(rows)
    by_turn = found.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).groupBy("conv_id")
    spans = by_turn.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    edits = cut_lineage(combined(stretches(found)), "edits")
    hashes = digests(rows, edits.select("conv_id", "audit"))
    out = turns.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    for part in (spans, edits, hashes):
        part = part.withColumnRenamed("conv_id", "of")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    empty = hashlib.sha256().hexdigest()
    counts = (F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
