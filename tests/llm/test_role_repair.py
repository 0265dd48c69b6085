"""Conversation repair against an exhaustive search and a plain table of states."""

import hashlib
import itertools
import random
import re
import zlib

from flocklens.llm import role_repair as rr

WS = " \t\n\x0b\x0c\r"


def faults(rows):
    """rows: (turn, role, text), in order."""
    out = []
    for k, (_, role, text) in enumerate(rows):
        body = text.strip(WS)
        if not body:
            out.append("blank")
        elif (role, text) in [(r, t) for _, r, t in rows[:k]]:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in ".!?" else "truncated")
    return out


def exhaustive(rows):
    """Every edit of every row with up to two insertions at every gap."""
    what, best = faults(rows), None
    gaps = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    own = []
    for (_, role, text), fault in zip(rows, what):
        extra = 5 if fault == "truncated" else 0
        ways = [(2, "D", None, None)]
        if fault not in ("blank", "duplicate"):
            ways.append((extra, "K", role[:1], f"{role}:{text}"))
            ways += [(1 + extra, "R", r[0], f"{r}:{text}") for r in ("user", "assistant")]
        own.append(ways)
    for inserted in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product(*own):
            cost, audit, initials, lines = 0, "", "", []
            for k in range(len(rows) + 1):
                for x in inserted[k]:
                    cost, audit, initials = cost + 5, audit + "I", initials + x
                    lines.append({"u": "user:", "a": "assistant:"}[x])
                if k < len(rows):
                    c, e, x, line = edits[k]
                    cost, audit = cost + c, audit + e
                    if x is not None:
                        initials += x if len(x) == 1 else "?"
                        lines.append(line)
            if re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return best


def by_states(rows):
    """(cost, audit, hash) by a table over the states 0 nothing, 1 s, 2 u, 3 pair."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = {0: (0, "", ())}

    def put(to, state, value):
        if state not in to or value[:2] < to[state][:2]:
            to[state] = value
            return True

    def close(best):
        again = True
        while again:
            again = False
            for s, (c, a, t) in list(best.items()):
                for x, name in (("u", "user"), ("a", "assistant")):
                    if (s, x) in step:
                        again |= bool(put(best, step[s, x], (c + 5, a + "I", (*t, name + ":"))))
        return best

    for (_, role, text), fault in zip(rows, faults(rows)):
        new, extra = {}, 5 if fault == "truncated" else 0
        for s, (c, a, t) in close(best).items():
            put(new, s, (c + 2, a + "D", t))
            if fault in ("blank", "duplicate"):
                continue
            if (s, role[:1]) in step:
                put(new, step[s, role[:1]], (c + extra, a + "K", (*t, f"{role}:{text}")))
            for x, name in (("u", "user"), ("a", "assistant")):
                if (s, x) in step:
                    put(new, step[s, x], (c + 1 + extra, a + "R", (*t, f"{name}:{text}")))
        best = new
    c, a, t = min(v for s, v in close(best).items() if s in (0, 3))
    return c, a, hashlib.sha256("\n".join(t).encode()).hexdigest()


def brute(table, damaged=True):
    """Every column of the query for rows (conv_id, turn, role, text)."""
    groups = {}
    for conv, turn, role, text in table:
        rows = groups.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damaged else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        what, turns = faults(rows), {r[0] for r in rows} - {None}
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, what.count("blank"), what.count("duplicate"), what.count("truncated"), illegal, *by_states(rows))
    return out


def made_up(rng, n, roles=("user", "assistant", "system", "tool", "", None, "ursula", "s"), turns=5):
    texts = ["Yes.", "no", "Why? ", " ", "", None, "a!\n\t", "ok.", "x y"]
    return [(c, rng.choice([None, *range(turns)]), rng.choice(roles), rng.choice(texts)) for c in range(n) for _ in range(rng.randint(1, 6))]


def test_the_parse_table():
    t = rr.Table(rr.ROLE_GRAMMAR)
    assert t.follow["pair"] == {"u", None} and t.follow["dialogue"] == {None}
    stacks = rr.Stacks(t)
    for n in range(7):
        for word in map("".join, itertools.product("sua", repeat=n)):
            tops = [stacks.start]
            for x in word:
                tops = [m for top in tops for m in stacks.shift(top, x)]
            assert any(map(stacks.accepts, tops)) == bool(re.fullmatch("(s?(ua)+)?", word)), word


def test_the_cheapest_repair_of_short_conversations():
    rng, parser = random.Random(3), rr.Parser()
    for _ in range(300):
        rows = [(0, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "c.", ""])) for _ in range(rng.randint(0, 3))]
        c = rr.Conversation(1, parser, False)
        for (turn, role, text), fault in zip(rows, faults(rows)):
            c.add(turn, role, text, ["", "blank", "duplicate", "truncated"].index(fault))
        got = c.result()
        want = exhaustive(rows)
        assert (got["cost"], got["audit"], got["repaired_sha256"]) == want == by_states(rows), rows


def test_long_conversations_go_by_chunks(monkeypatch):
    rng = random.Random(4)
    for chunk in (1, 2, 7, 1000):
        monkeypatch.setattr(rr, "CHUNK", chunk)
        for n in (0, 1, 5, 60, 300):
            rows = [(k, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", f"{k}.", ""])) for k in range(n)]
            c = rr.Conversation(1, rr.Parser(), True)
            for (turn, role, text), fault in zip(rows, faults(rows)):
                c.add(turn, role, text, ["", "blank", "duplicate", "truncated"].index(fault))
            got = c.result()
            assert (got["cost"], got["audit"], got["repaired_sha256"]) == by_states(rows)
            lines = "\n".join(f"{t['role']}:{t['text']}" for t in got["turns"])
            assert hashlib.sha256(lines.encode()).hexdigest() == got["repaired_sha256"]


def test_a_long_conversation_keeps_little(monkeypatch):
    monkeypatch.setattr(rr, "CHUNK", 64)
    c = rr.Conversation(1, rr.Parser(), False)
    for k in range(20000):
        c.add(k, ("user", "assistant")[k % 2], f"text {k}.", 0)
        assert len(c.rows) <= 64
    assert sum(len(a) for _, a, _ in c.tops.values()) < 1000
    assert c.result()["audit"] == "K" * 20000


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def found(df):
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()
    }


def test_damaged_and_odd_rows(spark):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    rows = made_up(rng, 400) + [(None, 1, "user", "a."), (None, None, None, None), (7, None, "user", "Yes."), (7, None, "user", "Yes.")]
    rows += rows[:50]
    df = table(spark, rows)
    for c in ("there", "fault", "copy", "cost", "kind"):
        df = df.withColumn(c, F.lit("extra"))
    got = rr.repair(rr.damage(df))
    assert found(got) == brute(rows) and got.count() == len({r[0] for r in rows})
    assert found(rr.repair(table(spark, rows))) == brute(rows, damaged=False)
    assert rr.repair(rr.damage(df.where("false"))).collect() == []


def test_one_conversation_of_a_third_of_all_rows(spark):
    rng = random.Random(6)
    rows = [(5, k % 900, rng.choice(["user", "assistant"]), rng.choice([f"t{k}.", "again.", "cut"])) for k in range(3000)] + made_up(rng, 1500)
    df = table(spark, rows)
    assert found(rr.repair(rr.damage(df))) == brute(rows)
    one = rr.repair(rr.damage(df), with_turns=True).where("conv_id = 5").first()
    lines = "\n".join(f"{t.role}:{t.text}" for t in one.turns)
    assert hashlib.sha256(lines.encode()).hexdigest() == one.repaired_sha256


def test_one_shuffle(spark):
    plan = rr.repair(rr.damage(table(spark, [(1, 1, "user", "a.")])))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
