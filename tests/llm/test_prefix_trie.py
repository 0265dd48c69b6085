"""Prefix tries against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from flocklens.llm import prefix_trie as pt

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def md5(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def plain_trie(paths):
    """paths: {conv_id: tuple of (role, text)}. The rows of all nodes, sorted."""
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[x] for x in below) or 1
        saved[p] = sum(saved[x] for x in below) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        ends = ",".join(map(str, sorted(c for c in members[p] if len(paths[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        row = (min(members[p]), len(p), parent, len(members[p]), len(below), leaves[p], saved[p])
        out.append((*row, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def plain_sequences(rows):
    groups = {}
    for c, turn, role, text in rows:
        if c is not None:
            groups.setdefault(c, []).append((turn is not None, turn or 0, md5(role or "", text or ""), (role or "", text or "")))
    return {c: tuple(x[-1] for x in sorted(g)) for c, g in groups.items()}


def plain_rebuilt(rows):
    own, out = plain_sequences(rows), {}
    for c, p in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, ())[:h] + p[h:]
    return out


def made_up(rng, n, words=3, turns=7):
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, turns)):
            rows.append((c, t, ("user", "assistant")[t % 2], rng.choice("abcdefgh"[:words]) * rng.choice([1, 1, 4])))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_branching_nodes_of_sorted_sequences():
    rng = random.Random(1)
    for _ in range(300):
        every = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 20))})
        lcp = [0] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(every, every[1:])]
        depth, parent, first = pt.merge_tree(np.array([len(x) for x in every]), np.array(lcp))
        nodes = [every[f][:d] for f, d in zip(first, depth)]
        branching = {p for x in every for p in (x[:d] for d in range(len(x))) if len({y[len(p)] for y in every if y[: len(p)] == p and len(y) > len(p)}) > 1}
        assert sorted(nodes) == sorted(set(every) | branching | {""})
        for k, p in enumerate(parent):
            above = [x for x in nodes if nodes[k].startswith(x) and x != nodes[k]]
            assert (nodes[p] if p >= 0 else None) == (max(above, key=len) if above else None)


@pytest.mark.parametrize("partitions, fan", [(1, 2), (3, 2), (16, 2), (40, 3), (40, 64)])
def test_partitions_merge_to_one_trie(spark, monkeypatch, partitions, fan):
    monkeypatch.setattr(pt, "FAN", fan)
    monkeypatch.setattr(pt, "IDS", 3)
    monkeypatch.setattr(pt, "shuffle_partitions", lambda spark: partitions)
    rng = random.Random(partitions * fan)
    # a large group of equal conversations, one common first turn, prefixes of others
    rows = made_up(rng, 150) + [(c, t, "user", "hot") for c in range(1000, 1080) for t in range(3)]
    rows += [(c, t, "user", f"{c % 7}x{t}" if t else "first") for c in range(2000, 2060) for t in range(1 + c % 4)]
    assert found(pt.trie(pt.sequences(table(spark, rows)))) == plain_trie(plain_sequences(rows))


def test_rebuilt_conversations(spark):
    rng = random.Random(7)
    rows = made_up(rng, 120, turns=12) + [(c, t, "user", "y") for c in (301, 303, 309, 405) for t in range(10)]
    rows += [(None, 1, "user", "lost"), (500, None, None, None), (500, None, "user", "z"), (500, 1, None, "q"), (501, 1, "user", None)]
    rows += [(502, 1, "user", "same"), (502, 1, "user", "same"), (-3, 0, "user", "below"), (600, 0, "a", "bc"), (601, 0, "ab", "c")]
    rows += [(c, 0, "user", "lone") for c in range(5001, 5100, 5)]  # without a conversation to begin with
    from pyspark.sql import functions as F

    df = table(spark, rows)
    for c in ("path", "block", "unit", "part", "depth", "key"):
        df = df.withColumn(c, F.lit("extra"))
    want = plain_rebuilt([r for r in rows if r[0] != -3])
    want[-3] = plain_sequences(rows)[0][: zlib.crc32(b"-3") % 9] + plain_sequences(rows)[-3][zlib.crc32(b"-3") % 9 :]  # -3 % 5 is -3 in SQL
    assert any(not p for p in want.values())
    assert found(pt.trie(pt.rebuilt(df))) == plain_trie(want)


def test_empty_tables(spark):
    none = table(spark, [(None, 1, "user", "x")])
    assert pt.trie(pt.rebuilt(none)).collect() == [] and pt.trie(pt.rebuilt(none.where("false"))).collect() == []


def test_one_conversation_of_a_third_of_all_rows(spark):
    rng = random.Random(9)
    rows = made_up(rng, 300) + [(700 + k, t, "user", f"t{t // 3}" if t < 900 else f"t{t}x{k}") for k in (0, 1) for t in range(1000)]
    assert found(pt.trie(pt.sequences(table(spark, rows)))) == plain_trie(plain_sequences(rows))
