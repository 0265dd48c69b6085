"""MinHash near-dedup with an LSH forest.

Method: every distinct shingle set gets ``trees`` independent orders; order t
sorts the sets by ``depth`` min-hash values of its own. Neighbours in an order
are candidates as far as their common prefix reaches: the region of a prefix is
compared in full once it is small enough (the depth adapts per region); in
larger regions each member pairs with its next sorted neighbours and with a
central member, one out of the region's largest run of equal keys.

Candidates are verified on the full shingle sets in contracting rounds: first
each set with its smallest candidate; then, of the candidates that the links
found so far have left in different components, one for each set and foreign
component, then four, sixteen and so on, and at last all that are left. A candidate inside
a component can change nothing and is not compared. At last, in regions too large to have been compared in full or cut
by a partition's edge, every set outside the largest component with those that
share one of its rarest shingles: an exact join, whose rows are dealt in cells.
Such regions are held together whatever the sizes of their sets. So two sets
that share a region are either compared, or already connected, or of sizes that
rule the similarity out. No region is
gathered into one task: orders are range-partitioned on prefix and set, and
neighbours across a partition's edge are paired too.

Sets are 64-bit hashes of w-word shingles. Equal sets collapse to one class
before anything else, so thousands of copies cost one set.

Cases: null or word-less text has no shingles and links with nothing; fewer
words than w give one shingle of the whole sequence; repeated rows are copies;
a null doc_id is linked with nothing and keeps a null component_id; an empty
table gives an empty result. Only doc_id and text are read, so further columns
may have any name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flocklens.llm.common import Run, Windows, mix64, shuffle_partitions, slices, word_hashes
from flocklens.llm.components import components

TREES = 12
DEPTH = 8
MIN_DEPTH = 3  # common prefix from which two sets are candidates
REGION = 12  # a region of at most so many sets is compared in full
NEAR = 2  # sorted neighbours that are candidates in regions of any size
VERIFY_SHINGLES = 400_000  # shingles of members that one verification group holds
ROWS_PER_TASK = 200_000
CELL_ROWS = 4096  # prefix rows of one side of a cell; more only where a task's share is more
PAIRS_AT_ONCE = 1 << 20
SLOTS = 1 << 22  # counters that tell rare shingles from common ones


def shingle_sets(text: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and each text's offsets."""
    import pyarrow.compute as pc

    hashes, offsets = word_hashes(pc.ascii_lower(pc.fill_null(text, "")))
    counts = np.diff(offsets)
    win = Windows(hashes, offsets)
    starts = win.starts(words)
    h = win.at(starts, words)
    doc = np.repeat(np.arange(len(counts)), counts)[starts]
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        h = np.concatenate([h, win.at(offsets[short], counts[short])])
        doc = np.concatenate([doc, short])
    doc = doc.astype(np.uint16 if len(counts) < 65536 else np.int64)
    order = np.argsort(h)
    order = order[np.argsort(doc[order], kind="stable")]
    h, doc = h[order], doc[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[first], doc[first]
    return h, np.searchsorted(doc, np.arange(len(counts) + 1))


def _class_keys(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """An order-free 64-bit key of each set."""
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(mix64(h ^ np.uint64(0xD6E8FEB86659FD93)), out=total[1:])
    key = total[offsets[1:]] - total[offsets[:-1]]
    return mix64(key + np.diff(offsets).astype(np.uint64)).view(np.int64)


def _signatures(h: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """n min-hash values (uint32, big-endian) of each non-empty set."""
    rng = np.random.default_rng(7)
    a = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, n, dtype=np.uint32)
    x = (h >> np.uint64(32)).astype(np.uint32)
    starts = offsets[:-1]
    out = np.empty((len(starts), n), dtype=">u4")
    for k in range(n):
        v = x * a[k] + b[k]
        v ^= v >> np.uint32(15)
        out[:, k] = np.minimum.reduceat(v, starts)
    return out


def _features(words: int, trees: int, depth: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("cid", pa.int64()), ("sig", pa.binary())]
    )

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, offsets = shingle_sets(part.column("text"), words)
                n = np.diff(offsets)
                some = n > 0
                key = _class_keys(h, offsets)
                sig = np.full(len(n), None, dtype=object)
                if some.any():
                    live = np.concatenate([offsets[:-1][some], [len(h)]])
                    rows = _signatures(h, live, trees * depth)
                    sig[some] = [r.tobytes() for r in rows]
                yield pa.record_batch(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        part.column("text_key"),
                        pa.array(n),
                        pa.array(key, mask=~some),
                        pa.array(sig, pa.binary()),
                    ],
                    schema=schema,
                )

    return run


def _neighbours(depth: int, min_depth: int, region: int):
    """Candidate pairs of one sorted run of an order (tree -1), ties of regions
    that are not compared in full here (tree -2), and the run's two end rows.

    Ties hold a region together whatever the sizes of its sets; only pairs that
    are to be verified pass the size filter."""
    columns = ["a", "b", "tree", "key", "n"]

    def run(frames):
        parts = [f for f in frames if len(f)]
        if not parts:
            return
        f = pd.concat(parts, ignore_index=True)
        cid, n = f["cid"].to_numpy(np.int64), f["n"].to_numpy(np.int64)
        keys = np.frombuffer(b"".join(f["key"]), dtype=">u4").reshape(len(f), depth)
        same = (keys[1:] == keys[:-1]) & (f["tree"].to_numpy()[1:] == f["tree"].to_numpy()[:-1])[:, None]
        lcp = np.cumprod(same, axis=1).sum(axis=1)  # with the row before
        size, head = {}, {}
        for d in range(min_depth, depth + 1):
            group = np.concatenate(([0], np.cumsum(lcp < d)))
            size[d] = np.bincount(group)[group]
            head[d] = np.searchsorted(group, group)
        pairs = []
        low = np.full(len(f), depth + 1)
        for step in range(1, region):
            i = np.arange(len(f) - step)
            low = np.minimum(low[: len(i)], lcp[step - 1 :])
            ok = low >= min_depth
            if not ok.any():
                break
            own = np.zeros(len(i), dtype=np.int64)
            for d in range(min_depth, depth + 1):
                own[low == d] = size[d][i][low == d]
            take = i[ok & ((step <= NEAR) | (own <= region))]
            pairs.append((take, take + step))
        # large regions and those that may go on in the next partition: every
        # member with a central one, out of the region's largest run of equal keys
        top = head[min_depth]
        big = np.flatnonzero((size[min_depth] > region) | (top == 0) | (top == top[-1]))
        ties = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if len(big):
            order = big[np.lexsort((head[depth][big], -size[depth][big], head[min_depth][big]))]
            first = np.ones(len(order), dtype=bool)
            first[1:] = head[min_depth][order][1:] != head[min_depth][order][:-1]
            centre = np.zeros(len(f), dtype=np.int64)
            centre[head[min_depth][order[first]]] = order[first]
            ties = (centre[head[min_depth][big]], big)
            pairs.append(ties)
        x = np.concatenate([p for p, _ in pairs] + [np.zeros(0, np.int64)]).astype(np.int64)
        y = np.concatenate([q for _, q in pairs] + [np.zeros(0, np.int64)]).astype(np.int64)
        x, y = _alike(cid, n, x, y)
        out = pd.DataFrame({"a": cid[x], "b": cid[y], "n": n[y]}).drop_duplicates()
        yield out.assign(tree=-1, key=None)[columns]
        out = pd.DataFrame({"a": cid[ties[0]], "b": cid[ties[1]]}).query("a != b").drop_duplicates()
        yield out.assign(tree=-2, key=None, n=0)[columns]
        ends = f.iloc[sorted({0, len(f) - 1})]
        yield pd.DataFrame({"a": ends["cid"], "b": ends["cid"], "tree": ends["tree"], "key": ends["key"], "n": ends["n"]})

    return run


PERCENT = 80


def _alike(cid, n, x, y):
    """Drop pairs whose sizes alone rule the similarity out; a < b."""
    ok = (cid[x] != cid[y]) & (100 * np.minimum(n[x], n[y]) >= PERCENT * np.maximum(n[x], n[y]))
    x, y = x[ok], y[ok]
    swap = cid[x] > cid[y]
    return np.where(swap, y, x), np.where(swap, x, y)


def _candidates(classes: DataFrame, run: Run, trees: int, depth: int, min_depth: int, region: int) -> tuple[DataFrame, DataFrame]:
    """(pairs to verify with the size n of b, ties of the regions whose pairs are not all among them)."""
    spark = run.spark
    rows = classes.count() * trees
    orders = classes.select(
        "cid",
        "n",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(t).alias("tree"), F.substring("sig", 1 + 4 * depth * t, 4 * depth).alias("key"))
                    for t in range(trees)
                ]
            )
        ).alias("o"),
    ).select("cid", "n", "o.tree", "o.key")
    parts = max(shuffle_partitions(spark), -(-rows // ROWS_PER_TASK))
    sorted_runs = orders.repartitionByRange(parts, "tree", "key", "cid").sortWithinPartitions("tree", "key", "cid")
    out = run.keep(
        sorted_runs.mapInPandas(
            _neighbours(depth, min_depth, region), "a long, b long, tree int, key binary, n long"
        ),
        "neighbours",
    )
    # two rows per partition: neighbours across the partitions' edges
    ends = sorted((r.tree, bytes(r.key), r.a, r.n) for r in out.where("tree >= 0").collect())
    across = [
        (min(p[2], q[2]), max(p[2], q[2]), max(p[2:], q[2:])[1], 100 * min(p[3], q[3]) >= PERCENT * max(p[3], q[3]))
        for p, q in zip(ends, ends[1:])
        if p[0] == q[0] and p[1][: 4 * min_depth] == q[1][: 4 * min_depth] and p[2] != q[2]
    ]
    pairs, ties = out.where("tree = -1").select("a", "b", "n"), out.where("tree = -2").select("a", "b")
    if across:
        across = spark.createDataFrame(across, "a long, b long, n long, alike boolean")
        pairs = pairs.unionByName(across.where("alike").select("a", "b", "n"))
        ties = ties.unionByName(across.select("a", "b"))
    return run.keep(pairs.distinct(), "candidates"), run.keep(ties.distinct(), "ties")


def _sets_of(docs: DataFrame, classes: DataFrame, pairs: DataFrame, run: Run, words: int) -> DataFrame:
    """(cid, shingles): the full set of each class that is in one of ``pairs``."""
    wanted = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    ids = classes.join(wanted, "cid", "left_semi").select(F.col("rep").alias("doc_id")).distinct()

    def sets(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, offsets = shingle_sets(part.column("text"), words)
                key = _class_keys(h, offsets)
                blobs = [h[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                columns = [pa.array(key), pa.array(blobs, pa.binary())]
                yield pa.record_batch(columns, names=["cid", "shingles"])

    found = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").select("text")
    found = found.mapInArrow(sets, "cid long, shingles binary")
    return run.keep(found.dropDuplicates(["cid"]), "sets")


def _verify(stars: DataFrame, sets: DataFrame, run: Run) -> DataFrame:
    """The pairs (hub, member) of ``stars`` whose full sets are similar enough.

    A hub's members are dealt to groups of bounded size, by their sizes n alone,
    which the pairs carry; then the sets come to the groups, a hub's set once to each."""
    load = stars.groupBy("hub").agg(F.sum("n").alias("load"))
    part = F.pmod(F.xxhash64("member"), F.ceil(F.col("load") / VERIFY_SHINGLES)).alias("part")
    dealt = run.keep(stars.join(load, "hub").select("hub", part, "member"), "dealt")
    of = lambda end: sets.select(F.col("cid").alias(end), "shingles")
    members = dealt.join(of("member"), "member").select("hub", "part", "member", "shingles")
    hubs = dealt.select("hub", "part").distinct().join(of("hub"), "hub")
    rows = members.unionByName(hubs.select("hub", "part", F.lit(None).cast("long").alias("member"), "shingles"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        is_hub = frame["member"].isna()
        if not is_hub.any():
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        hub = np.frombuffer(frame.loc[is_hub, "shingles"].iloc[0], dtype=np.uint64)
        keep = []
        for member, blob in zip(frame.loc[~is_hub, "member"], frame.loc[~is_hub, "shingles"]):
            other = np.frombuffer(blob, dtype=np.uint64)
            if len(hub) == 0 or len(other) == 0:
                continue
            at = np.searchsorted(hub, other)
            both = int((hub[np.minimum(at, len(hub) - 1)] == other).sum())
            if 100 * both >= PERCENT * (len(hub) + len(other) - both):
                keep.append(member)
        ids = np.array([int(m) for m in keep], dtype=np.int64)
        return pd.DataFrame({"a": np.full(len(ids), frame["hub"].iloc[0]), "b": ids})

    # member ids are 64-bit: pandas would turn a nullable column into floats
    rows = rows.withColumn("member", F.col("member").cast("string"))
    return run.keep(rows.groupBy("hub", "part").applyInPandas(compare, "a long, b long"), "links")


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    return found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(links)


def _across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one group yet, with the group of a."""
    at = lambda end: found.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))
    return (
        pairs.select("a", "b", "n")
        .join(at("a"), "a", "left")
        .join(at("b"), "b", "left")
        .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
        .select("a", "b", "n", F.coalesce("of_a", "a").alias("of_a"))
    )


def _settle(pairs: DataFrame, sets: DataFrame, run: Run) -> DataFrame:
    """(id, component) over the similar ones of ``pairs``, verified in rounds.

    The first round takes one candidate of each set b; round r takes, for each b
    and component of its candidates a, one for each of 4**(r - 1) residues of a's
    hash. The links found contract the components before the next round. Pairs
    that were compared or lie inside a component leave, so that the rounds are
    about the logarithm of the most candidates that a set has in one component,
    and a group of near copies costs about its members, not its pairs."""
    if "n" not in pairs.columns:  # not carried along: read off the sets
        n = (F.length("shingles") / 8).cast("long").alias("n")
        pairs = pairs.join(sets.select(F.col("cid").alias("b"), n), "b")
    left, many = pairs.select("a", "b", "n", F.lit(0).cast("long").alias("of_a")), None
    found, turn, compared = None, 0, 0
    while many != 0:
        last = many is not None and many <= compared  # no more left than compared so far: all of them
        taken = left
        if not last:
            share = F.pmod(F.xxhash64("a"), F.lit(4 ** min(max(turn - 1, 0), 30)))
            taken = left.groupBy("b", "n", "of_a", share.alias("share")).agg(F.min("a").alias("a"))
        taken = run.keep(taken.select(F.col("a").alias("hub"), F.col("b").alias("member"), "n"), "taken")
        links = _verify(taken, sets, run)
        if found is None or not links.isEmpty():
            found = run.keep(components(links if found is None else _joined(found, links), run), "groups")
        if last:
            break
        tried = taken.select(F.col("hub").alias("a"), F.col("member").alias("b"))
        left = run.keep(_across(left.join(tried, ["a", "b"], "left_anti"), found), "left")
        many, compared, turn = left.count(), compared + taken.count(), turn + 1
    return found


def _counts(blobs) -> pd.DataFrame:
    """How often each slot of shingle hashes occurs."""
    value = np.concatenate([np.frombuffer(b, dtype=np.uint64) for b in blobs] or [np.zeros(0, np.uint64)])
    slot, many = np.unique((value & np.uint64(SLOTS - 1)).astype(np.int64), return_counts=True)
    return pd.DataFrame({"slot": slot, "many": many})


def _often(sets: DataFrame) -> np.ndarray:
    """The counts of all slots."""
    counts = sets.select("shingles").mapInPandas(
        lambda frames: (_counts(f["shingles"]) for f in frames), "slot long, many long"
    )
    counts = counts.groupBy("slot").agg(F.sum("many").alias("many")).where("many > 1")

    def pack(frames):
        for f in frames:
            yield pd.DataFrame({"slot": [f["slot"].to_numpy("<i8").tobytes()], "many": [f["many"].to_numpy("<i8").tobytes()]})

    out = np.zeros(SLOTS, dtype=np.uint32)
    for r in counts.mapInPandas(pack, "slot binary, many binary").collect():
        out[np.frombuffer(r.slot, "<i8")] = np.minimum(np.frombuffer(r.many, "<i8"), (1 << 32) - 1)
    return out


def _prefix_rows(shared):
    """Prefix rows of each set: its shingles from the rarest on, as far as a
    similar set must hold one of them, with what is left of the set there."""

    def rows(f, keys):
        many = np.array([len(k) for k in keys])
        n = np.array([len(b) // 8 for b in f["shingles"]])
        at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        same = {c: np.repeat(f[c].to_numpy(), many) for c in ("cid", "g", "out")}
        n = np.repeat(n, many)
        return pd.DataFrame({"key": np.concatenate(keys).view(np.int64), **same, "n": n, "left": n - at})

    def run(frames):
        often = shared.value
        for f in frames:
            salt = mix64(f["c"].to_numpy(np.int64).view(np.uint64))
            keys, begin = [], 0
            for k, blob in enumerate(f["shingles"]):
                h = np.frombuffer(blob, dtype=np.uint64)
                cut = len(h) - -(-PERCENT * len(h) // 100) + 1
                # the order of rarity is the same for all sets, ties by the hash itself
                rare = h[np.lexsort((h, often[(h & np.uint64(SLOTS - 1)).astype(np.int64)]))[:cut]]
                keys.append(mix64(rare ^ salt[k]))
                if k + 1 - begin == 2000 or k + 1 == len(f):
                    yield rows(f.iloc[begin : k + 1], keys)
                    keys, begin = [], k + 1

    return run


def _meetings(frames):
    """Pairs of an outsider and a set of another component that share a prefix
    row and, by what is left of both from there, can still be similar."""
    parts = [f for f in frames if len(f)]
    if not parts:
        return
    f = pd.concat(parts, ignore_index=True)
    cell = f.groupby(["key", "i", "j"], sort=False).ngroup().to_numpy(np.int64)
    f = f.iloc[np.lexsort((f["n"], cell))]
    cell = np.sort(cell)
    cid, g, n, left, side = (f[c].to_numpy(np.int64) for c in ("cid", "g", "n", "left", "side"))
    home, away = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    # a partner of size m has 9 * left >= 4 * (n + m), and 100 * m >= PERCENT * n
    wide = int(n.max()) + 1
    at = cell[home] * wide + n[home]
    most = np.minimum((100 + PERCENT) * left[away] // PERCENT - n[away], wide - 1)
    least = np.minimum(-(-PERCENT * n[away] // 100), wide - 1)
    low = np.searchsorted(at, cell[away] * wide + least)
    many = np.maximum(np.searchsorted(at, cell[away] * wide + np.maximum(most, -1), side="right") - low, 0)
    ends = np.cumsum(many)
    a = 0
    while a < len(away):  # bounded runs of pairs
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right")))
        x = np.repeat(away[a:b], many[a:b])
        begin = ends[a:b] - many[a:b] - done
        y = home[np.repeat(low[a:b] - begin, many[a:b]) + np.arange(len(x))]
        ok = (g[x] != g[y]) & ((100 + PERCENT) * left[y] >= PERCENT * (n[x] + n[y]))
        x, y = x[ok], y[ok]
        x, y = np.where(cid[x] < cid[y], x, y), np.where(cid[x] < cid[y], y, x)
        yield pd.DataFrame({"a": cid[x], "b": cid[y], "n": n[y]}).drop_duplicates()
        a = b


def _outsiders(ties: DataFrame, classes: DataFrame, found: DataFrame, sets: DataFrame, run: Run) -> DataFrame:
    """Links that neighbours in large regions have missed.

    Within a group of tied regions, which were too large to be compared in full
    or cut by a partition's edge, every set outside the group's largest verified
    component finds its partners by an exact prefix-filter join: similar sets
    share one of the rarest shingles of each, and from the first one that they
    share enough must be left of both. The rows of a shingle meet in square
    cells of bounded size, so neither side is gathered into one task."""
    group = components(ties, run).select(F.col("id").alias("cid"), F.col("component").alias("c"))
    rows = group.join(found.select(F.col("id").alias("cid"), F.col("component").alias("g")), "cid", "left")
    rows = run.keep(rows.withColumn("g", F.coalesce("g", "cid")), "members")
    by = rows.groupBy("c", "g").agg(F.count("*").alias("k"))
    by = by.groupBy("c").agg(F.max(F.struct("k", "g"))["g"].alias("main"), F.count("*").alias("parts"))
    rows = rows.join(by.where("parts > 1"), "c").select("cid", "c", "g", (F.col("g") != F.col("main")).alias("out"))
    rows = run.keep(rows.join(sets, "cid"), "apart")
    # how often shingles occur, by slots of their hashes: it sets an order, no result hangs on it
    shared = run.spark.sparkContext.broadcast(_often(rows))
    prefix = "key long, cid long, g long, out boolean, n long, left long"
    rows = run.keep(rows.mapInPandas(_prefix_rows(shared), prefix), "prefixes")
    total = rows.count()
    if not total:
        return rows.select(F.col("cid").alias("a"), F.col("g").alias("b"))
    parts = max(shuffle_partitions(run.spark), -(-total // ROWS_PER_TASK))
    cell = max(CELL_ROWS, -(-total // parts))
    hot = rows.groupBy("key").agg(F.count("*").alias("all"), F.count(F.when(F.col("out"), 1)).alias("outs"))
    hot = [(r.key, -(-r["all"] // cell), -(-r.outs // cell)) for r in hot.where(F.col("all") > cell).collect()]
    if hot:  # at most total / cell keys
        hot = F.broadcast(run.spark.createDataFrame(hot, "key long, homes int, aways int"))
        rows = rows.join(hot, "key", "left")
    else:
        rows = rows.withColumn("homes", F.lit(1)).withColumn("aways", F.lit(1))
    rows = rows.withColumn("homes", F.coalesce("homes", F.lit(1))).withColumn("aways", F.coalesce("aways", F.lit(1)))
    rows = rows.where("aways > 0")  # a shingle without outsiders links nothing
    of = lambda name: F.pmod(F.xxhash64("cid"), F.col(name)).cast("int")
    each = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    kept = ("key", "cid", "g", "n", "left")
    home = rows.select(*kept, of("homes").alias("i"), F.lit(0).alias("side"), each("aways").alias("j"))
    away = rows.where("out").select(*kept, of("aways").alias("j"), F.lit(1).alias("side"), each("homes").alias("i"))
    dealt = home.unionByName(away).repartition(parts, "key", "i", "j")
    met = run.keep(dealt.mapInPandas(_meetings, "a long, b long, n long").distinct(), "met")
    return _verify(met.select(F.col("a").alias("hub"), F.col("b").alias("member"), "n"), sets, run)


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    trees: int = TREES,
    depth: int = DEPTH,
    min_depth: int = MIN_DEPTH,
    region: int = REGION,
) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles,
    component_id (smallest doc_id reachable over links of Jaccard >= 0.8, itself
    included) and kept (doc_id = component_id)."""
    found = _judged(docs, words, trees, depth, min_depth, region)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, words: int, trees: int, depth: int, min_depth: int, region: int) -> DataFrame:
    """near_duplicates with text_key, the hash of the row's text, and component,
    a number of its group (null: linked with nothing)."""
    run = Run(docs.sparkSession, "minhash")
    rows = run.keep(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
            _features(words, trees, depth), "doc_id long, text_key long, n long, cid long, sig binary"
        ),
        "features",
    )
    classes = run.keep(
        rows.where("n > 0 and doc_id is not null")
        .groupBy("cid")
        .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "classes",
    )
    pairs, ties = _candidates(classes, run, trees, depth, min_depth, region)
    sets = _sets_of(docs, classes, pairs.select("a", "b").unionByName(ties), run, words)
    found = _settle(pairs, sets, run)
    more = _outsiders(ties, classes, found, sets, run)
    if not more.isEmpty():
        found = run.keep(components(_joined(found, more), run), "groups")
    of = classes.join(found.withColumnRenamed("id", "cid"), "cid", "left").select(
        "cid", "rep", F.coalesce("component", "cid").alias("component")
    )
    of = run.keep(of, "of")
    smallest = of.groupBy("component").agg(F.min("rep").alias("component_id"))
    of = of.join(smallest, "component").select("cid", "component", "component_id")
    cid = F.when(F.col("doc_id").isNotNull(), F.col("cid")).alias("cid")
    out = rows.select("doc_id", "text_key", "n", cid).join(of, "cid", "left")
    return out.select(
        "doc_id",
        "text_key",
        "component",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component_id", "doc_id")).alias("kept"),
    )


def keep_one(docs: DataFrame, words: int = 5) -> DataFrame:
    """The rows of ``docs`` (all columns) that are the smallest doc_id of their
    near-duplicate group. Of equal rows with one id and text one stays, and of
    one id's texts in one group that with the least hash; rows without an id
    all stay."""
    found = _judged(docs, words, TREES, DEPTH, MIN_DEPTH, REGION).where("kept")
    group = F.coalesce("component", "text_key").alias("group")  # without words: a group of its own
    ids = found.groupBy("doc_id", group).agg(F.min("text_key").alias("of_key"), F.count("*").alias("n"))
    ids = Run(docs.sparkSession, "keep").keep(ids.select(F.col("doc_id").alias("of"), "of_key", "n"), "ids")
    same = F.col("whole.doc_id").eqNullSafe(F.col("of")) & (F.xxhash64("whole.text") == F.col("of_key"))
    rows = docs.select(F.struct("*").alias("whole")).join(ids, same)
    single = rows.where("n = 1 or of is null").select("whole.*")
    more = rows.where("n > 1 and of is not null").select("whole.*").dropDuplicates(["doc_id", "text"])
    return single.unionByName(more)
