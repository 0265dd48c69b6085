"""Prefix trie over conversations, by union-find on sorted neighbours.

Method: a conversation is the sequence of its turns, each a unit of 20 bytes
(MD5 of role and text, and the text's UTF-8 bytes). The sequences are dealt by
range and sorted, so that a node's members lie side by side. Within a partition
the edges between neighbours, weighted by their longest common prefix (LCP), are
taken in descending depth: union-find joins the components on both sides, and
every merge makes (or reaches) the branching node of that depth. Sums go up from
component to component, and unary paths unfold into one row per depth.

Prefixes of a partition's first and last sequence may have members in other
partitions. Such open nodes are contracted to those that something hangs on,
with the sums of what is complete below them, and these items go through the
same function again, ``FAN`` partitions together, until one group is left. A
complete node whose parent was open learns its parent's smallest member by a
join. Ids of a sequence that may go on in other partitions are hashed in id
order by a stream over pieces of the id list; one SHA-256 is sequential by its
definition.

A group of equal conversations may fill any number of partitions. One
conversation is one row (20 bytes for each turn), a task holds about
``TASK_BYTES`` of sequences or the longest conversation.

Cases: rows with a null conv_id belong to no conversation; null roles and texts
are empty; null turns come first, rows of one turn go by the MD5 of role and
text; repeated rows are turns of their own; an empty table has no node, not even
a root; only conv_id, turn, role and text are read, whatever other columns there
are.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from flocklens.llm.common import Run, shuffle_partitions

UNIT = 20
TASK_BYTES = 8 << 20
FAN = 64
IDS = 100_000  # ids in a piece of an id list
NOTHING = hashlib.sha256(b"").hexdigest()
_FAR = np.iinfo(np.int64).max

_ITEM = [("n", pa.int64()), ("low", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())]
_ROW = pa.schema(
    [
        ("kind", pa.int32()),  # 0 a complete node, 1 an open item, 2 a piece of an id list
        ("part", pa.int64()),
        ("path", pa.binary()),  # of an item
        ("key", pa.binary()),  # MD5 of the path: of a node that was open, or of the list's sequence
        ("parent_key", pa.binary()),  # where the parent is still open
        ("parent", pa.int64()),  # the parent's smallest member where it is known
        ("depth", pa.int64()),
        ("start", pa.int64()),  # first id of a piece
        ("ids", pa.binary()),
        *_ITEM,
    ]
)
_ROW_DDL = (
    "kind int, part long, path binary, key binary, parent_key binary, parent long, depth long, start long, ids binary, "
    "n long, low long, kids long, leaves long, saved long, ends string"
)


def _find(up: np.ndarray, x: np.ndarray) -> np.ndarray:
    root = up[x]
    while True:
        above = up[root]
        if np.array_equal(above, root):
            up[x] = root
            return root
        root = above


def common_prefixes(units: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """LCP of each sequence with the one before it (0 for the first), in units;
    ``units`` has one row of 32-bit words per unit."""
    out = np.zeros(len(sizes), np.int64)
    both = np.minimum(sizes[1:], sizes[:-1])
    pairs = np.flatnonzero(both) + 1
    if len(pairs):
        many = both[pairs - 1]
        begin = np.cumsum(many) - many
        place = np.arange(int(many.sum())) - np.repeat(begin, many)
        left = units[np.repeat(starts[pairs - 1], many) + place]
        differ = (left != units[np.repeat(starts[pairs], many) + place]).any(axis=1)
        out[pairs] = np.minimum(np.minimum.reduceat(np.where(differ, place, _FAR), begin), many)
    return out


def merge_tree(sizes: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(depth, parent, first sequence) of the branching nodes over sorted distinct
    sequences. Node k below ``len(sizes)`` is sequence k itself; the root is the
    only node without a parent (-1)."""
    m = len(sizes)
    depth = np.concatenate([sizes, np.zeros(m + 1, np.int64)])
    parent = np.full(2 * m + 1, -1, np.int64)
    first = np.concatenate([np.arange(m), np.zeros(m + 1, np.int64)])
    up, top, used = np.arange(m), np.arange(m), m
    edges = np.argsort(-lcp[1:], kind="stable") + 1
    levels = np.split(edges, np.flatnonzero(np.diff(lcp[edges])) + 1) if m > 1 else []
    for right in levels:  # of one depth, from the left
        d = lcp[right[0]]
        tops = top[right]
        up[right] = _find(up, right - 1)
        lead = _find(up, right)
        merged, at = np.unique(lead, return_inverse=True)
        node = top[merged]
        new = depth[node] > d  # else the leftmost sequence ends just here
        made = used + np.arange(int(new.sum()))
        used += len(made)
        depth[made], first[made], parent[node[new]] = d, merged[new], made
        node[new] = made
        parent[tops] = node[at]
        top[merged] = node
    if depth[top[0]] > 0:
        parent[top[0]] = used
        used += 1
    return depth[:used], parent[:used], first[:used]


def _key(path: bytes) -> bytes:
    return hashlib.md5(path).digest()


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    whole = [pa.nulls(n, f.type) if f.name not in columns else pa.array(columns[f.name], f.type) for f in _ROW]
    return pa.record_batch(whole, schema=_ROW)


def contract(paths: list[bytes], items: dict[str, np.ndarray], part: int, last: bool, keyed: bool):
    """Batches of complete nodes, and of open items unless this is the ``last`` round.

    ``paths`` are sorted and distinct, ``items`` holds what hangs on each path's
    end. ``keyed``: nodes of items carry their key, for those that wait for it."""
    m = len(paths)
    sizes = np.array([len(p) // UNIT for p in paths], np.int64)
    starts = np.cumsum(sizes) - sizes
    units = np.frombuffer(b"".join(paths), np.uint32).reshape(-1, UNIT // 4)
    lcp = common_prefixes(units, starts, sizes)
    depth, parent, first = merge_tree(sizes, lcp)
    v = len(depth)
    above = np.where(parent < 0, -1, depth[parent])
    chain = depth - above  # rows of a node: its own depth and the unary ones above
    base = np.cumsum(chain) - chain
    of = np.repeat(np.arange(v), chain)
    level = np.arange(len(of)) - base[of] + above[of] + 1
    place = starts[first[of]] + level - 1
    size = np.zeros(len(of), np.int64)
    size[level > 0] = units[place[level > 0], -1].byteswap()
    so_far = np.concatenate(([0], np.cumsum(size)))

    fill = np.zeros(v - m, np.int64)
    n, kids, leaves, saved = (np.concatenate([items[c], fill]) for c in ("n", "kids", "leaves", "saved"))
    low = np.concatenate([items["low"], fill + _FAR])
    ends = np.concatenate([items["ends"], np.full(v - m, None, object)])
    open_ = np.zeros(v, bool)
    leaf = np.flatnonzero(np.append(lcp[1:], -1) < sizes)[0]  # items may be prefixes of the first sequence
    for node in () if last else (leaf, m - 1):
        while node >= 0 and not open_[node]:
            open_[node] = True
            node = parent[node]
    order = np.argsort(-depth, kind="stable")
    for nodes in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        nodes = nodes[~open_[nodes]]
        leaves[nodes] += kids[nodes] == 0
        nodes = nodes[parent[nodes] >= 0]
        to = parent[nodes]
        whole = saved[nodes] + (n[nodes] - 1) * (so_far[base[nodes] + chain[nodes]] - so_far[base[nodes]])
        for sums, add in ((n, n[nodes]), (kids, 1), (leaves, leaves[nodes]), (saved, whole)):
            np.add.at(sums, to, add)
        np.minimum.at(low, to, low[nodes])

    keys = {k: _key(paths[first[k]][: UNIT * int(depth[k])]) for k in np.flatnonzero(open_).tolist()}
    rows = np.flatnonzero(~open_[of])
    for a in range(0, len(rows), 1 << 16):
        r = rows[a : a + (1 << 16)]
        k = of[r]
        end, begin = r == base[k] + chain[k] - 1, r == base[k]
        waits = begin & (parent[k] >= 0) & open_[parent[k]]
        known = np.where(begin, low[parent[k]], low[k])
        yield _rows(
            kind=np.zeros(len(r), np.int32),
            key=[_key(paths[x]) if keyed and e and x < m else None for x, e in zip(k.tolist(), end.tolist())],
            parent_key=[keys[p] if w else None for p, w in zip(parent[k].tolist(), waits.tolist())],
            parent=pa.array(known, pa.int64(), mask=waits | (level[r] == 0)),
            depth=level[r],
            n=n[k],
            low=low[k],
            kids=np.where(end, kids[k], 1),
            leaves=leaves[k],
            saved=saved[k] + (n[k] - 1) * (so_far[base[k] + chain[k]] - so_far[r]),
            ends=np.where(end, ends[k], None),
        )
    held = np.flatnonzero(open_ & ((n > 0) | (kids > 0)))
    if len(held):
        yield _rows(
            kind=np.ones(len(held), np.int32),
            part=np.full(len(held), part),
            path=[paths[first[k]][: UNIT * int(depth[k])] for k in held.tolist()],
            **{c: x[held] for c, x in (("n", n), ("low", low), ("kids", kids), ("leaves", leaves), ("saved", saved), ("ends", ends))},
        )



def _first_round(batches):
    """The forest of a partition of sorted (conv_id, path) rows."""
    from pyspark import TaskContext

    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    part = TaskContext.get().partitionId()
    ids = table.column("conv_id").to_numpy()
    every = table.column("path").combine_chunks().dictionary_encode()
    codes = every.indices.to_numpy().astype(np.int64)
    begin = np.flatnonzero(np.diff(codes, prepend=-1))
    paths = every.dictionary.to_pylist()  # in order of appearance: sorted
    stop = np.concatenate([begin[1:], [len(ids)]])
    ends = np.full(len(paths), None, object)
    for k, (a, b) in enumerate(zip(begin.tolist(), stop.tolist())):
        if 0 < k < len(paths) - 1:
            ends[k] = hashlib.sha256(_listed(ids[a:b])).hexdigest()
            continue
        cuts = list(range(a, b, IDS))  # the first and the last sequence may go on elsewhere
        yield _rows(
            kind=np.full(len(cuts), 2),
            key=[_key(paths[k])] * len(cuts),
            start=ids[cuts],
            ids=[_listed(ids[c : min(b, c + IDS)]) for c in cuts],
        )
    zero = np.zeros(len(paths), np.int64)
    items = {"n": stop - begin, "low": ids[begin], "kids": zero, "leaves": zero, "saved": zero, "ends": ends}
    yield from contract(paths, items, part, last=False, keyed=False)


def _listed(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _later_round(last: bool):
    """The forest of the open items of some neighbouring partitions."""

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        sums = {"n": "sum", "low": "min", "kids": "sum", "leaves": "sum", "saved": "sum", "ends": "max"}
        merged = table.group_by("path").aggregate(list(sums.items())).sort_by("path")
        items = {c: merged.column(f"{c}_{how}").to_numpy() for c, how in sums.items()}
        part = table.column("part")[0].as_py() // FAN
        paths = merged.column("path").to_pylist()
        yield from contract(paths, items, part, last, keyed=True)

    return run


def _hash_lists(batches):
    """SHA-256 of each key's id list from its pieces, in order."""

    def pieces():
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())

    for key, every in groupby(pieces(), key=lambda x: x[0]):
        hashed = hashlib.sha256(next(every)[1])
        for _, ids in every:
            hashed.update(b"," + ids)
        yield pa.record_batch([pa.array([key], pa.binary()), pa.array([hashed.hexdigest()])], names=["key", "listed"])


def trie(sequences: DataFrame) -> DataFrame:
    """One row per node over ``sequences(conv_id, path)``, ids distinct, none null:
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes of the last text, once for each member but one, summed
    over the subtree) and ends_sha256 (of the ids that end here)."""
    spark = sequences.sparkSession
    run, seen = Run(spark, "trie"), Observation()
    told = sequences.select("conv_id", "path").observe(
        seen, F.sum(F.octet_length("path") + 16).alias("size"), F.max(F.octet_length("path")).alias("longest")
    )
    rows = run.keep(told, "sequences")
    parts = max(shuffle_partitions(spark), -(-(seen.get["size"] or 0) // TASK_BYTES))
    rows = rows.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    found = run.keep(rows.mapInArrow(_first_round, _ROW_DDL), "forest")
    rounds, groups = [found], parts
    while True:
        groups = -(-groups // FAN)
        items = found.where("kind = 1")
        if groups == 1:
            found = run.keep(items.repartition(1).mapInArrow(_later_round(True), _ROW_DDL), "merged")
        else:
            later = _later_round(False)
            near = items.groupBy((F.col("part") / FAN).cast("long").alias("near"))
            found = run.keep(near.applyInArrow(_whole(later), _ROW_DDL), "merged")
        rounds.append(found)
        if groups == 1:
            break
    nodes = rounds[0].where("kind = 0")
    for more in rounds[1:]:
        nodes = nodes.unionByName(more.where("kind = 0"))
    keyed = rounds[1].where("kind = 0 AND key IS NOT NULL")
    for more in rounds[2:]:
        keyed = keyed.unionByName(more.where("kind = 0 AND key IS NOT NULL"))
    pieces = rounds[0].where("kind = 2").select("key", "start", "ids").repartition("key").sortWithinPartitions("key", "start")
    listed = pieces.mapInArrow(_hash_lists, "key binary, listed string")
    was_open = nodes.where("key IS NOT NULL").join(listed, "key", "left").withColumn("ends", F.coalesce("listed", "ends"))
    nodes = nodes.where("key IS NULL").unionByName(was_open.drop("listed"))
    parents = keyed.select(F.col("key").alias("parent_key"), F.col("low").alias("parent_low"))
    waiting = nodes.where("parent_key IS NOT NULL").join(parents, "parent_key", "left").withColumn("parent", F.col("parent_low"))
    nodes = nodes.where("parent_key IS NULL").unionByName(waiting.drop("parent_low"))
    return nodes.select(
        F.col("low").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )


def _whole(later):
    """``later`` over one group's table."""

    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(later(table.to_batches())), schema=_ROW)

    return run


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): the turns of each conversation, in order."""
    return _streamed(_turns(conversations).withColumn("block", F.col("conv_id")), lambda conv_id, own, shared: own)


def rebuilt(conversations: DataFrame, block: int = 5, spread: int = 9) -> DataFrame:
    """(conv_id, path), where conversations of a block share beginnings: conv_id c
    takes the first h turns of c - c % block (all if fewer, none if there is no
    such conversation), then its own after the first h, h = crc32(c) % spread."""

    def change(conv_id, own, shared):
        h = zlib.crc32(str(conv_id).encode()) % spread
        return shared[:h] + own[h:]

    turns = _turns(conversations)
    return _streamed(turns.withColumn("block", F.col("conv_id") - F.col("conv_id") % block), change, spread)


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.unhex(F.lpad(F.hex(F.octet_length(text)), 8, "0"))
    unit = F.concat(F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))), size)
    rows = conversations.where("conv_id IS NOT NULL")
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), unit.alias("unit"))


def _streamed(turns: DataFrame, change, spread: int = 0) -> DataFrame:
    """Paths of whole conversations; the first of a block lends its first turns."""
    dealt = turns.repartition("block").sortWithinPartitions(
        "block", F.col("conv_id") != F.col("block"), "conv_id", F.col("turn").asc_nulls_first(), "unit"
    )

    def run(batches):
        def units():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("block", "conv_id", "unit")))

        ids, paths, size, lender, lent = [], [], 0, None, []
        for (block, conv_id), rows in groupby(units(), key=lambda x: x[:2]):
            own = [unit for _, _, unit in rows]
            if conv_id == block:
                lender, lent = block, own[:spread]
            ids.append(conv_id)
            paths.append(b"".join(change(conv_id, own, lent if lender == block else [])))
            size += len(paths[-1])
            if len(ids) >= 1 << 14 or size > 8 << 20:
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(paths, pa.binary())], names=["conv_id", "path"])
                ids, paths, size = [], [], 0
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(paths, pa.binary())], names=["conv_id", "path"])

    return dealt.select("block", "conv_id", "unit").mapInArrow(run, "conv_id long, path binary")
