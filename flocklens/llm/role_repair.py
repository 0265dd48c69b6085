"""Conversation structure repair by a generalised LR parse over the role grammar.

Method: the role initials of a conversation are parsed with an SLR table of the
grammar and a graph-structured stack: stacks share what lies below their tops,
and after every row the tops of equal stacks are merged, the one of least
(cost, audit) staying. Between rows a top may insert a role, on a row it may
keep, rerole or delete it, each at its price; reductions are free. The audit
holds the initials of the edits; as it fixes every inserted and new role, the
repaired turns follow from it.

Spark deals conversations out by conv_id, numbers equal (role, text) in turn
order with a window and sorts the rows by turn; tasks then stream them. A
conversation is parsed in chunks of ``CHUNK`` rows: its tops carry their cost,
the part of the audit on which they still differ and a running SHA-256, so a
conversation of any length takes the memory of a chunk and its audit. The hash
of one conversation is sequential by its definition, hence so is that pass.
Short conversations with equal symbols (initials and faults) share one parse.

Cases: null conv_ids are one conversation; null roles and texts become one
space; rows of one turn go by (role, text); null turns come first; a
conversation without rows gets zeros, an empty audit and the hash of nothing;
repeated rows are duplicates; an empty table gives an empty result; only conv_id,
turn, role and text are read, whatever other columns there are.
"""

from __future__ import annotations

import hashlib
import os.path
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
CHUNK = 1024
KNOWN = 1 << 16  # parses that a task remembers, of conversations of at most KNOWN_ROWS rows
KNOWN_ROWS = 32
LEGAL = ("su", "ua", "au")

#: dialogue: nothing, or pairs after at most one system turn; the first production's left side is the start
ROLE_GRAMMAR = (
    ("dialogue", ()),
    ("dialogue", ("pairs",)),
    ("dialogue", ("s", "pairs")),
    ("pairs", ("pairs", "pair")),
    ("pairs", ("pair",)),
    ("pair", ("u", "a")),
)
NEW_ROLES = {"u": "user", "a": "assistant"}  # what a row may be made, or inserted as


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5  # of a truncated row that stays

    @property
    def detour(self) -> int:
        """What any top of ROLE_GRAMMAR needs at most to go on as any other one: two
        insertions bring it behind a pair, where it can do all but take a system
        turn, which it deletes. A top dearer than another by more never wins."""
        return 2 * self.insert + self.delete


class Table:
    """SLR table of a grammar; a state may hold several actions for a symbol."""

    def __init__(self, grammar):
        self.rules = (("", (grammar[0][0],)), *grammar)
        self.nonterminals = {left for left, _ in self.rules}
        self.follow = self._follow()
        start = self._closure({(0, 0)})
        self.states, self.goto = [start], {}
        for state, items in enumerate(self.states):  # grows meanwhile
            for symbol in sorted({self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}):
                moved = {(r, d + 1) for r, d in items if d < len(self.rules[r][1]) and self.rules[r][1][d] == symbol}
                target = self._closure(moved)
                if target not in self.states:
                    self.states.append(target)
                self.goto[state, symbol] = self.states.index(target)

    def _closure(self, items):
        items, todo = set(items), list(items)
        while todo:
            r, d = todo.pop()
            ahead = self.rules[r][1][d : d + 1]
            for new in [(k, 0) for k, (left, _) in enumerate(self.rules) if (left,) == ahead]:
                if new not in items:
                    items.add(new)
                    todo.append(new)
        return frozenset(items)

    def _follow(self):
        """What may follow each nonterminal; None is the end."""
        empty, first = set(), {}
        follow = {left: set() for left in self.nonterminals}
        follow[""].add(None)
        while True:
            before = (len(empty), sum(map(len, first.values())), sum(map(len, follow.values())))
            for left, right in self.rules:
                if all(x in empty for x in right):
                    empty.add(left)
                for k, x in enumerate(right):
                    first.setdefault(left, set()).update({x} if x not in self.nonterminals else first.get(x, ()))
                    if x not in empty:
                        break
                tail = set(follow[left])
                for x in reversed(right):
                    if x in self.nonterminals:
                        follow[x] |= tail
                    own = first.get(x, set()) if x in self.nonterminals else {x}
                    tail = tail | own if x in empty else set(own)
            if before == (len(empty), sum(map(len, first.values())), sum(map(len, follow.values()))):
                return follow

    def reductions(self, state, ahead):
        return [self.rules[r] for r, d in self.states[state] if r and d == len(self.rules[r][1]) and ahead in self.follow[self.rules[r][0]]]


class Stacks:
    """The graph-structured stack: a node is (state, the node below), and equal
    stacks are one node. Moves are worked out once per node and symbol."""

    def __init__(self, table: Table):
        self.table = table
        self.nodes: dict[tuple, tuple] = {}
        self.moves: dict[tuple, tuple] = {}
        self.start = self._node(0, None)

    def _node(self, state, below):
        return self.nodes.setdefault((state, id(below)), (state, below))

    def _reduced(self, node, ahead):
        """The node and all nodes that reductions before ``ahead`` make of it."""
        found, todo = [node], [node]
        while todo:
            top = todo.pop()
            for left, right in self.table.reductions(top[0], ahead):
                below = top
                for _ in right:
                    below = below[1]
                new = self._node(self.table.goto[below[0], left], below) if left else None
                if new is not None and new not in found:
                    found.append(new)
                    todo.append(new)
        return found

    def shift(self, node, symbol):
        """The nodes after ``symbol``."""
        key = (id(node), symbol)
        if key not in self.moves:
            tops = [n for n in self._reduced(node, symbol) if (n[0], symbol) in self.table.goto]
            self.moves[key] = tuple(self._node(self.table.goto[n[0], symbol], n) for n in tops)
        return self.moves[key]

    def accepts(self, node):
        key = (id(node), None)
        if key not in self.moves:
            whole = self.table.goto[0, self.table.rules[0][1][0]]
            self.moves[key] = any(n[0] == whole for n in self._reduced(node, None))
        return self.moves[key]


class Parser:
    """Cheapest edits. Symbols: a role's initial, upper case if the row is
    truncated, ``-`` for an initial outside the grammar (``+`` if truncated),
    ``x`` for a row that has to go."""

    def __init__(self, grammar=ROLE_GRAMMAR, costs: Costs = Costs()):
        self.stacks = Stacks(Table(grammar))
        self.costs = costs
        terminals = {x for _, right in grammar for x in right} - {left for left, _ in grammar}
        self.symbols = {(i, t): i.upper() if t else i for i in terminals for t in (False, True)}
        self.known: dict[str, tuple] = {}

    def symbol(self, initial: str, truncated: bool) -> str:
        return self.symbols.get((initial, truncated), "+" if truncated else "-")

    def start(self):
        """Tops: {node: (cost, audit, origin)}."""
        return {self.stacks.start: (0, "", 0)}

    @staticmethod
    def _put(tops, node, value) -> bool:
        old = tops.get(node)
        if old is None or value < old:
            tops[node] = value
            return True
        return False

    def inserted(self, tops):
        """The tops, and what insertions make of them."""
        tops, todo = dict(tops), list(tops)
        while todo:
            node = todo.pop()
            cost, audit, origin = tops[node]
            for role in NEW_ROLES:
                for new in self.stacks.shift(node, role):
                    if self._put(tops, new, (cost + self.costs.insert, audit + "I", origin)):
                        todo.append(new)
        return tops

    def advance(self, tops, symbols: str):
        """The tops after the rows of ``symbols``."""
        c = self.costs
        for symbol in symbols:
            new = {}
            extra = c.truncated if symbol.isupper() or symbol == "+" else 0
            for node, (cost, audit, origin) in self.inserted(tops).items():
                self._put(new, node, (cost + c.delete, audit + "D", origin))
                if symbol == "x":
                    continue
                if symbol not in "-+":
                    for top in self.stacks.shift(node, symbol.lower()):
                        self._put(new, top, (cost + extra, audit + "K", origin))
                for role in NEW_ROLES:
                    for top in self.stacks.shift(node, role):
                        self._put(new, top, (cost + c.rerole + extra, audit + "R", origin))
            tops = new
        return tops

    def finish(self, tops):
        """The cheapest whole parse: (cost, audit, origin)."""
        return min(v for n, v in self.inserted(tops).items() if self.stacks.accepts(n))

    def roles(self, node, symbols: str, audit: str):
        """(what becomes of each edit, nodes after it) of a chunk's audit from ``node``:
        None for a deletion, "" for a row as it is, else the new role. An edit may
        leave several nodes; all of them are followed."""
        nodes, out, rows = [node], [], iter(symbols)
        for edit in audit:
            symbol = next(rows) if edit != "I" else ""
            if edit == "D":
                out.append(None)
                continue
            for role in [symbol.lower()] if edit == "K" else NEW_ROLES:
                if moved := [m for n in nodes for m in self.stacks.shift(n, role)]:
                    nodes = moved
                    out.append("" if edit == "K" else NEW_ROLES[role])
                    break
        return out

    def whole(self, symbols: str):
        """(cost, audit, roles) of a whole conversation."""
        found = self.known.get(symbols)
        if found is None:
            cost, audit, _ = self.finish(self.advance(self.start(), symbols))
            found = (cost, audit, self.roles(self.stacks.start, symbols, audit))
            if len(symbols) <= KNOWN_ROWS:
                if len(self.known) >= KNOWN:
                    self.known.clear()
                self.known[symbols] = found
        return found


def edited(rows: list, audit: str, roles: list):
    """The turns (role, text) that the edits leave of ``rows``."""
    out, k = [], 0
    for edit, role in zip(audit, roles):
        if edit == "I":
            out.append((role, ""))
            continue
        if role is not None:
            out.append((role or rows[k][0], rows[k][1]))
        k += 1
    return out


def _lines(turns) -> str:
    return "\n".join(f"{role}:{text}" for role, text in turns)


class Conversation:
    """One conversation as its rows come in, in order."""

    def __init__(self, conv_id, parser: Parser, with_turns: bool):
        self.conv_id, self.parser = conv_id, parser
        self.rows, self.symbols, self.size = [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.last = None
        self.turns = [] if with_turns else None
        self.tops = None  # set once a first chunk is done
        self.settled, self.hashes, self.parts = [], [hashlib.sha256()], [[]]

    def add(self, turn, role, text, fault):
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.distinct = turn, self.distinct + 1
        initial = role[:1]
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if fault == 1:
            self.blank += 1
        elif fault == 2:
            self.duplicate += 1
        elif fault == 3:
            self.truncated += 1
        self.symbols.append("x" if fault in (1, 2) else self.parser.symbol(initial, fault == 3))
        self.rows.append((role, text))
        self.size += len(text)
        if len(self.rows) >= CHUNK or self.size > 8 << 20:
            self.flush()

    def _written(self, hashed, parts, start, symbols, audit):
        """Copies of a top's hash and turns, with a chunk's edits."""
        turns = edited(self.rows, audit, self.parser.roles(start, symbols, audit))
        hashed = hashed.copy()
        if turns:
            if self.started[start]:
                hashed.update(b"\n")
            hashed.update(_lines(turns).encode())
        return hashed, parts + [turns] if self.turns is not None else parts, bool(turns) or self.started[start]

    def flush(self):
        """Moves the tops over the rows held and lets the rows go."""
        symbols = "".join(self.symbols)
        if self.tops is None:
            self.tops, self.nodes = self.parser.start(), [self.parser.stacks.start]
            self.started = {self.nodes[0]: False}
        before = {k: len(a) for _, a, k in self.tops.values()}
        tops = self.parser.advance(self.tops, symbols)
        limit = min(cost for cost, _, _ in tops.values()) + self.parser.costs.detour
        self._settle({n: v for n, v in tops.items() if v[0] <= limit}, before, symbols)
        self.rows, self.symbols, self.size = [], [], 0

    def _settle(self, tops, before, symbols):
        hashes, parts, started, nodes, new = [], [], {}, [], {}
        for node, (cost, audit, k) in tops.items():
            hashed, part, begun = self._written(self.hashes[k], self.parts[k], self.nodes[k], symbols, audit[before[k] :])
            new[node] = (cost, audit, len(nodes))
            nodes.append(node)
            hashes.append(hashed)
            parts.append(part)
            started[node] = begun
        shared = len(os.path.commonprefix([a for _, a, _ in new.values()]))
        if shared:
            self.settled.append(next(iter(new.values()))[1][:shared])
        self.tops = {n: (c, a[shared:], k) for n, (c, a, k) in new.items()}
        self.hashes, self.parts, self.nodes, self.started = hashes, parts, nodes, started

    def result(self) -> dict:
        symbols = "".join(self.symbols)
        if self.tops is None:
            cost, audit, roles = self.parser.whole(symbols)
            turns = edited(self.rows, audit, roles)
            digest = hashlib.sha256(_lines(turns).encode()).hexdigest()
        else:
            before = {k: len(a) for _, a, k in self.tops.values()}
            cost, rest, k = self.parser.finish(self.parser.advance(self.tops, symbols))
            hashed, parts, _ = self._written(self.hashes[k], self.parts[k], self.nodes[k], symbols, rest[before[k] :])
            audit, digest = "".join(self.settled) + rest, hashed.hexdigest()
            turns = [t for part in parts for t in part]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        out = {"conv_id": self.conv_id, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated}
        out |= {"illegal": self.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest}
        if self.turns is not None:
            out["turns"] = [{"role": r, "text": t} for r, t in turns]
        return out


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TYPES = [("conv_id", pa.int64())] + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
_TYPES += [("audit", pa.string()), ("repaired_sha256", pa.string())]
_TURNS = ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, there) with faults put in by the remainder
    of crc32(``conv_id:turn``) by 20; nulls of role, text and in that string are one
    space. Dropped rows stay with ``there`` false, so their conv_ids do."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        one("role").alias("role"),
        one("text").alias("text"),
        F.pmod(F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))), F.lit(20)).alias("kind"),
    )
    kind = F.col("kind")
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        (kind != 0).alias("there"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def repair(rows: DataFrame, costs: Costs = Costs(), with_turns: bool = False) -> DataFrame:
    """One row per conv_id of ``rows(conv_id, turn, role, text[, there])``: counts of
    gaps, faults and illegal neighbours, the cost and the audit of the cheapest
    repair, the SHA-256 of the repaired ``role:text`` lines and, on request, the
    repaired turns (then a conversation has to fit into a row)."""
    there = F.col("there") if "there" in rows.columns else F.lit(True)
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), one("role"), one("text"), there.alias("there"))
    seen = Window.partitionBy("conv_id", "there", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    body = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = (
        F.when(~F.col("there"), F.lit(0))
        .when(body == "", F.lit(1))
        .when(F.col("nth") > 1, F.lit(2))
        .when(F.substring(body, -1, 1).isin(*ENDS), F.lit(0))
        .otherwise(F.lit(3))
    )
    # dealt once: conv_id also serves the window, whose keys hold it
    dealt = rows.repartition("conv_id").withColumn("nth", F.row_number().over(seen)).withColumn("fault", fault)
    dealt = dealt.sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("nth")
    )
    types = [*_TYPES, _TURNS] if with_turns else _TYPES

    def batch_of(found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(found, schema=pa.schema(types))

    def run(batches):
        parser, now, found, size = Parser(costs=costs), None, [], 0
        for batch in batches:
            for conv_id, turn, role, text, here, what in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        found.append(now.result())
                        size += len(found[-1]["audit"]) + sum(len(t["text"]) for t in found[-1].get("turns", ()))
                    if len(found) >= 4096 or size > 8 << 20:
                        yield batch_of(found)
                        found, size = [], 0
                    now = Conversation(conv_id, parser, with_turns)
                if here:
                    now.add(turn, role, text, what)
        if now is not None:
            found.append(now.result())
        if found:
            yield batch_of(found)

    schema = _RESULT + (", turns array<struct<role: string, text: string>>" if with_turns else "")
    return dealt.select("conv_id", "turn", "role", "text", "there", "fault").mapInArrow(run, schema)
