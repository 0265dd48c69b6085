"""LM scoring with a gated recurrent language model.

Model: a gated recurrent unit reads a document's tokens; its state predicts the
next token's class and, for the most frequent words, the word within its class
(a class-factored softmax). All other words fall into classes by their form;
within such a class a word's share is its smoothed corpus count, one unseen
word form included, so the probabilities of all tokens sum to one. State is
carried across windows from a document's first token to its end token.

Corpus counts: every block of documents (one Arrow slice) deals its distinct
words' hashes and training counts into ranges of the hash space; a range sums
them and answers each block with the totals of its words. Neither the
vocabulary nor its counts ever gather in one place.

Training: all training documents, once. They are split into ``rounds`` parts;
in each round every task runs truncated backpropagation (numpy, Adam) over its
share from the common model, documents in pieces of ``SEGMENT`` tokens, and the
models are averaged by tokens. The model
has a fixed size (``HEAD`` words, ``FORMS`` forms, ``STATE`` units).

Cases: a null or empty text is the end token alone; a null doc_id is a training
document; without training documents all counts are zero and the model is
uniform over its classes; texts of any length are scored whole; repeated rows
are scored alike; an empty table gives an empty result; only doc_id and text
are read.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flocklens.llm.common import (
    Run,
    crc_of,
    encode_words,
    hash_strings,
    mix64,
    one_array,
    segment_sum,
    shuffle_partitions,
    slices,
    split_words,
)
from flocklens.llm.text_stats import text_bytes

HEAD = 1024
GROUP = 64  # words of a head class
FORMS = 48
STATE = 16
LANES = 512
STEPS = 16  # tokens of a window of truncated backpropagation
SCORE_STEPS = 64
SEGMENT = 1024  # training pieces; scoring reads whole documents
FLUSH_TOKENS = 2_000_000  # tokens that a task trains on together
ROUNDS = 3
RATES = (0.012, 0.006, 0.003)
SMOOTH = 0.1
END = "\n"  # no word holds it
BLOCK_BYTES = 12 << 20
WORDS_PER_RANGE = 1_000_000

_ENTRY = np.dtype([("hash", "<u8"), ("count", "<i8"), ("form", "u1")])


def held_out():
    """Documents that the model does not learn from: crc32(doc_id as text) mod 10 is 0."""
    return F.coalesce(crc_of("doc_id") % 10 == 0, F.lit(False))


def forms_of(distinct: pa.Array) -> np.ndarray:
    """The form class of each word: how it ends, its last letters, its script."""
    if len(distinct) == 0:
        return np.zeros(0, np.uint8)
    raw, offsets = text_bytes(one_array(distinct))
    end = offsets[1:]
    size = np.diff(offsets)
    last = raw[end - 1]
    letter = ((last >= 97) & (last <= 122)) | (last >= 128)
    mark = np.where(letter, 0, np.where(last == ord("."), 1, np.where(last == ord(","), 2, 3)))
    # the last two bytes before a closing mark
    one = raw[end - np.minimum(size, np.where(letter, 1, 2))].astype(np.uint64)
    two = raw[end - np.minimum(size, np.where(letter, 2, 3))].astype(np.uint64)
    wide = np.add.reduceat((raw >= 0xC3).astype(np.int64), offsets[:-1]) > 0
    ending = (mix64(one * np.uint64(257) + two) % np.uint64(FORMS // 8)).astype(np.int64)
    return (mark * (FORMS // 4) + wide * (FORMS // 8) + ending).astype(np.uint8)


_BLOCK = "block string, doc_id array<long>, held_out array<boolean>, offsets binary, codes binary, hashes binary, forms binary, counts binary"


def _blocks(batches):
    schema = pa.schema(
        [
            ("block", pa.string()),
            ("doc_id", pa.list_(pa.int64())),
            ("held_out", pa.list_(pa.bool_())),
            *((n, pa.binary()) for n in ("offsets", "codes", "hashes", "forms", "counts")),
        ]
    )
    for batch in batches:
        for part in slices(batch, "text", max_bytes=BLOCK_BYTES):
            words, offsets = split_words(pc.ascii_lower(one_array(part.column("text"))))
            codes, distinct = encode_words(words)
            n = len(offsets) - 1
            hashes = np.append(hash_strings(distinct), hash_strings(pa.array([END])))
            forms = np.append(forms_of(distinct), np.uint8(0))
            # each text's words, then the end token
            out = np.empty(len(codes) + n, dtype=np.int64)
            at_end = np.zeros(len(out), dtype=bool)
            ends = offsets[1:] + np.arange(n)
            at_end[ends] = True
            out[at_end], out[~at_end] = len(distinct), codes
            bounds = offsets + np.arange(n + 1)
            held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            learn = np.repeat(~held, np.diff(bounds))
            counts = np.bincount(out[learn], minlength=len(hashes))
            values = [
                [uuid.uuid4().hex],
                [part.column("doc_id").cast(pa.int64()).to_pylist()],
                [held.tolist()],
                *([x.tobytes()] for x in (bounds, out.astype(np.int32), hashes, forms, counts.astype(np.int64))),
            ]
            yield pa.record_batch([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)


def _deal(ranges: int):
    width = (1 << 64) // ranges + 1
    bounds = np.array([min(r * width, (1 << 64) - 1) for r in range(1, ranges)], dtype=np.uint64)

    def run(frames):
        for frame in frames:
            for block, hashes, forms, counts in zip(frame["block"], frame["hashes"], frame["forms"], frame["counts"]):
                h = np.frombuffer(hashes, np.uint64)
                entry = np.empty(len(h), _ENTRY)
                order = np.argsort(h)
                entry["hash"], entry["form"] = h[order], np.frombuffer(forms, np.uint8)[order]
                entry["count"] = np.frombuffer(counts, np.int64)[order]
                pieces = np.split(entry, np.searchsorted(entry["hash"], bounds))
                keep = [r for r, p in enumerate(pieces) if len(p)]
                yield pd.DataFrame({"range": keep, "block": block, "entries": [pieces[r].tobytes() for r in keep]})

    return run


def _meet(frame: pd.DataFrame) -> pd.DataFrame:
    """Totals of one range: an answer for each block, the most frequent words,
    and (form, words seen, their tokens) sums."""
    parts = [np.frombuffer(b, _ENTRY) for b in frame["entries"]]
    every = np.concatenate(parts)
    hashes, first, back = np.unique(every["hash"], return_index=True, return_inverse=True)
    total = np.bincount(back, weights=every["count"], minlength=len(hashes)).astype(np.int64)
    form = every["form"][first]
    cut = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    answers = []
    for p, a, b in zip(parts, cut[:-1], cut[1:]):
        answer = p.copy()
        answer["count"] = total[back[a:b]]
        answers.append(answer.tobytes())
    seen = total > 0
    sums = np.stack(
        [np.bincount(form[seen], minlength=FORMS), np.bincount(form[seen], weights=total[seen], minlength=FORMS)]
    ).astype(np.int64)
    best = np.lexsort((hashes, -total))[:HEAD]
    top = np.zeros(len(best), _ENTRY)
    top["hash"], top["count"], top["form"] = hashes[best], total[best], form[best]
    extra = pd.DataFrame({"block": ["top", "sums"], "entries": [top[top["count"] > 0].tobytes(), sums.tobytes()]})
    return pd.concat([pd.DataFrame({"block": frame["block"], "entries": answers}), extra])


@dataclass
class Vocabulary:
    """The bounded part of the corpus statistics that every task gets."""

    hashes: np.ndarray  # of the head words, most frequent first
    counts: np.ndarray
    form_types: np.ndarray  # seen words of each form outside the head
    form_tokens: np.ndarray
    tokens: int  # N
    types: int  # V

    @property
    def groups(self) -> int:
        return -(-len(self.hashes) // GROUP)

    def ids(self, hashes: np.ndarray, forms: np.ndarray) -> np.ndarray:
        """Model token of each word: its head rank, or HEAD + form."""
        out = HEAD + forms.astype(np.int64)
        if len(self.hashes):
            order = np.argsort(self.hashes)
            at = np.minimum(np.searchsorted(self.hashes[order], hashes), len(order) - 1)
            hit = self.hashes[order][at] == hashes
            out[hit] = order[at[hit]]
        return out


def _vocabulary(met: DataFrame) -> Vocabulary:
    def rows_of(frames):
        for frame in frames:
            for blob in frame["entries"]:
                e = np.frombuffer(blob, _ENTRY)
                yield pd.DataFrame(
                    {"h": e["hash"].astype(np.int64), "c": e["count"], "f": e["form"].astype(np.int32)}
                )

    def sums_of(frames):
        for frame in frames:
            for blob in frame["entries"]:
                s = np.frombuffer(blob, np.int64).reshape(2, FORMS)
                yield pd.DataFrame({"f": np.arange(FORMS), "types": s[0], "tokens": s[1]})

    top = met.where("block = 'top'").select("entries").mapInPandas(rows_of, "h long, c long, f int")
    top = top.orderBy(F.desc("c"), "h").limit(HEAD).collect()
    sums = met.where("block = 'sums'").select("entries").mapInPandas(sums_of, "f int, types long, tokens long")
    types, tokens = np.zeros(FORMS, np.int64), np.zeros(FORMS, np.int64)
    for r in sums.groupBy("f").agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).collect():
        types[r.f], tokens[r.f] = r.types, r.tokens
    n, v = int(tokens.sum()), int(types.sum())
    for r in top:
        types[r.f] -= 1
        tokens[r.f] -= r.c
    hashes = np.array([r.h for r in top], dtype=np.int64).view(np.uint64)
    return Vocabulary(hashes, np.array([r.c for r in top], dtype=np.float64), types, tokens, n, v)


# ---------------------------------------------------------------- the model


class Model:
    """Parameters in one vector: input table, recurrence, class and word layers."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.groups = vocabulary.groups
        self.classes = self.groups + FORMS
        shapes = {
            "x": (HEAD + FORMS, 3 * STATE),
            "u": (STATE, 3 * STATE),
            "c": (STATE, self.classes),
            "cb": (self.classes,),
            "w": (self.groups, STATE, GROUP),
            "wb": (self.groups, GROUP),
        }
        self.flat = np.zeros(sum(int(np.prod(s)) for s in shapes.values()), np.float32)
        self.slots, at = {}, 0
        for name, shape in shapes.items():
            n = int(np.prod(shape))
            self.slots[name] = (at, n, shape)
            at += n
        rng = np.random.default_rng(23)
        self.part("x")[:] = rng.normal(0, 0.3, shapes["x"])
        self.part("x")[:, :STATE] += 1.0  # remember by default
        self.part("u")[:] = rng.normal(0, 0.2, shapes["u"])
        self.part("c")[:] = rng.normal(0, 0.02, shapes["c"])
        ids = np.arange(HEAD + FORMS)
        self.class_table = np.where(ids < HEAD, np.minimum(ids // GROUP, self.groups - 1), self.groups + ids - HEAD).astype(np.int16)
        # the unigram model
        n = len(vocabulary.hashes)
        padded = np.zeros(self.groups * GROUP)
        padded[:n] = vocabulary.counts
        mass = padded.reshape(self.groups, GROUP)
        forms = vocabulary.form_tokens + SMOOTH * (vocabulary.form_types + 1)
        self.part("cb")[:] = np.log(np.concatenate([mass.sum(axis=1), forms]) / (mass.sum() + forms.sum()))
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.log(mass / mass.sum(axis=1, keepdims=True))
        self.part("wb")[:] = np.where(mass > 0, share, -1e4)

    def part(self, name: str, of: np.ndarray | None = None) -> np.ndarray:
        at, n, shape = self.slots[name]
        return (self.flat if of is None else of)[at : at + n].reshape(shape)

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return self.class_table[ids]

    def states(self, ids, fresh, h, keep_all: bool):
        """Run a window: states before each token, the last state, and what
        backpropagation needs."""
        x, u = self.part("x"), self.part("u")
        steps, lanes = ids.shape
        before = np.empty((steps, lanes, STATE), np.float32)
        tape = [] if keep_all else None
        for t in range(steps):
            if fresh[t].any():
                h = np.where(fresh[t][:, None], np.float32(0), h)
            before[t] = h
            a, q = x[ids[t]], h @ u
            g = a[:, : 2 * STATE] + q[:, : 2 * STATE]
            g *= np.float32(0.5)
            np.tanh(g, out=g)
            g += np.float32(1)
            g *= np.float32(0.5)
            z, r = g[:, :STATE], g[:, STATE:]
            qn = q[:, 2 * STATE :]
            m = np.tanh(a[:, 2 * STATE :] + r * qn)
            h = m + z * (h - m)
            if keep_all:
                tape.append((z, r, qn, m))
        return before, h, tape

    def token_logs(self, s, ids, grad: np.ndarray | None = None):
        """Natural log of P(class) * P(word | class) for head words, of P(class)
        for forms; with ``grad`` also the gradient of minus their sum by ``s``."""
        cls = self.class_of(ids)
        logit = s @ self.part("c")
        logit += self.part("cb")
        np.clip(logit, -80, 80, out=logit)
        e = np.exp(logit)
        total = e.sum(axis=1)
        row = np.arange(len(ids))
        out = (logit[row, cls] - np.log(total)).astype(np.float64)
        ds = None
        if grad is not None:
            e /= total[:, None]
            e[row, cls] -= 1
            ds = e @ self.part("c").T
            self.part("c", grad)[:] += s.T @ e
            self.part("cb", grad)[:] += e.sum(axis=0)
        order = np.argsort(cls, kind="stable")
        cut = np.searchsorted(cls[order], np.arange(self.groups + 1))
        for g in range(self.groups):
            rows = order[cut[g] : cut[g + 1]]
            if not len(rows):
                continue
            sg, word = s[rows], ids[rows] - g * GROUP
            logit = sg @ self.part("w")[g]
            logit += self.part("wb")[g]
            np.clip(logit, -80, 80, out=logit)
            e = np.exp(logit)
            total = e.sum(axis=1)
            k = np.arange(len(rows))
            out[rows] += logit[k, word] - np.log(total)
            if grad is not None:
                e /= total[:, None]
                e[k, word] -= 1
                ds[rows] += e @ self.part("w")[g].T
                self.part("w", grad)[g] += sg.T @ e
                self.part("wb", grad)[g] += e.sum(axis=0)
        return out, ds

    def learn(self, ids, fresh, valid, h):
        """Gradient of the mean loss over one window, and the state after it."""
        steps, lanes = ids.shape
        before, last, tape = self.states(ids, fresh, h, True)
        grad = np.zeros_like(self.flat)
        mask = valid.reshape(-1)
        s = before.reshape(-1, STATE)
        _, d = self.token_logs(s[mask], ids.reshape(-1)[mask], grad)
        out = np.zeros_like(s)
        out[mask] = d
        out = out.reshape(before.shape)
        u = self.part("u")
        da = np.empty((steps, lanes, 3 * STATE), np.float32)
        du = np.empty((steps, lanes, 3 * STATE), np.float32)
        back = np.zeros((lanes, STATE), np.float32)
        one = np.float32(1)
        for t in range(steps - 1, -1, -1):
            z, r, qn, m = tape[t]
            back *= valid[t][:, None]
            dm = back * (one - z) * (one - m * m)
            dz = back * (before[t] - m) * z * (one - z)
            dr = dm * qn * r * (one - r)
            da[t, :, :STATE], da[t, :, STATE : 2 * STATE], da[t, :, 2 * STATE :] = dz, dr, dm
            du[t] = da[t]
            du[t, :, 2 * STATE :] = dm * r
            back = back * z + du[t] @ u.T + out[t]
            back[fresh[t]] = 0
        self.part("u", grad)[:] = s.T @ du.reshape(-1, 3 * STATE)
        flat_ids, flat_da = ids.reshape(-1), da.reshape(-1, 3 * STATE)
        order = np.argsort(flat_ids, kind="stable")
        rows, first = np.unique(flat_ids[order], return_index=True)
        self.part("x", grad)[rows] += np.add.reduceat(flat_da[order], first, axis=0)
        grad /= max(1, int(mask.sum()))
        return grad, last


def lanes_of(size: np.ndarray, lanes: int) -> list[list[int]]:
    """Deal sequences to lanes of even length, longest first; longest lane first."""
    heap = [(0, k) for k in range(min(lanes, len(size)))]
    out: list[list[int]] = [[] for _ in heap]
    total = [0] * len(heap)
    for i in np.argsort(-size, kind="stable").tolist():
        n, k = heapq.heappop(heap)
        out[k].append(i)
        total[k] = n + int(size[i])
        heapq.heappush(heap, (total[k], k))
    return [out[k] for k in sorted(range(len(out)), key=lambda k: -total[k])]


def windows(starts: np.ndarray, size: np.ndarray, lanes: int, steps: int):
    """(positions [steps, live lanes], fresh, valid) of successive windows over
    sequences of tokens; lanes keep their column, and finished lanes drop off
    at the right."""
    if not len(size):
        return
    dealt = lanes_of(size, lanes)
    order = np.array([i for lane in dealt for i in lane])
    first = np.cumsum(size[order]) - size[order]
    total = int(size.sum())
    # tokens lane by lane: their positions, and which begin a sequence
    where = (np.arange(total) + np.repeat(starts[order] - first, size[order])).astype(np.int32)
    begins = np.zeros(total, dtype=bool)
    begins[first] = True
    length = np.array([int(size[lane].sum()) for lane in dealt])
    base = np.cumsum(length) - length
    for t in range(0, int(length[0]), steps):
        live = int((length > t).sum())
        step = t + np.arange(steps)[:, None]
        valid = step < length[:live][None, :]
        at = np.where(valid, base[:live][None, :] + step, 0)
        yield where[at], begins[at] & valid, valid


def _n_lanes(tokens: int) -> int:
    return int(np.clip(tokens // 256, 16, LANES))


def segments(offsets: np.ndarray, docs: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of the documents' pieces of at most ``longest`` tokens."""
    size = np.diff(offsets)[docs]
    pieces = -(-size // longest)
    doc = np.repeat(np.arange(len(docs)), pieces)
    begin = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * longest
    return offsets[:-1][docs][doc] + begin, np.minimum(longest, size[doc] - begin)


class Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.s, self.t, self.rate = np.zeros(size, np.float32), np.zeros(size, np.float32), 0, rate

    def step(self, flat: np.ndarray, grad: np.ndarray):
        self.t += 1
        norm = float(np.sqrt(np.dot(grad, grad)))
        if norm > 1.0:
            grad = grad / np.float32(norm)
        self.m += np.float32(0.1) * (grad - self.m)
        self.s += np.float32(0.01) * (grad * grad - self.s)
        scale = np.float32(self.rate / (1 - 0.9**self.t))
        flat -= scale * self.m / (np.sqrt(self.s / np.float32(1 - 0.99**self.t)) + np.float32(1e-6))


def _train_round(model: Model, number: int, rounds: int, rate: float):
    def run(frames):
        adam, tokens = Adam(len(model.flat), rate), 0
        held: list[tuple] = []

        def flush():
            base = np.cumsum([0, *(len(i) for i, _, _ in held)])
            ids = np.concatenate([i for i, _, _ in held])
            starts = np.concatenate([s + b for (_, s, _), b in zip(held, base)])
            size = np.concatenate([z for _, _, z in held])
            held.clear()
            h = None
            for pos, fresh, valid in windows(starts, size, _n_lanes(int(size.sum())), STEPS):
                live = pos.shape[1]
                h = np.zeros((live, STATE), np.float32) if h is None else h[:live]
                grad, h = model.learn(ids[pos], fresh, valid, h)
                adam.step(model.flat, grad)

        for frame in frames:
            for row in frame.itertuples():
                offsets = np.frombuffer(row.offsets, np.int64)
                ids = model.v.ids(np.frombuffer(row.hashes, np.uint64), np.frombuffer(row.forms, np.uint8))
                # every training document in exactly one round, whatever its place
                part = mix64(np.arange(len(offsets) - 1, dtype=np.uint64) + np.uint64(77)) % np.uint64(rounds)
                docs = np.flatnonzero(~np.asarray(row.held_out, dtype=bool) & (part == number))
                if not len(docs):
                    continue
                starts, size = segments(offsets, docs, SEGMENT)
                held.append((ids.astype(np.int16)[np.frombuffer(row.codes, np.int32)], starts, size))
                tokens += int(size.sum())
                if sum(int(z.sum()) for _, _, z in held) >= FLUSH_TOKENS:
                    flush()
        if held:
            flush()
        if tokens:
            yield pd.DataFrame({"salt": [uuid.uuid4().int % 32], "tokens": [tokens], "model": [model.flat.tobytes()]})

    return run


def _average(frames):
    total, tokens = None, 0
    for frame in frames:
        for n, blob in zip(frame["tokens"], frame["model"]):
            part = np.frombuffer(blob, np.float32).astype(np.float64) * n
            total = part if total is None else total + part
            tokens += n
    if tokens:
        yield pd.DataFrame({"tokens": [tokens], "model": [total.tobytes()]})


def train(blocks: DataFrame, vocabulary: Vocabulary, run: Run, rounds: int = ROUNDS) -> Model:
    """Average of the tasks' models after each round; every training document
    takes part in one round."""
    model = Model(vocabulary)
    for number in range(rounds):
        rate = RATES[min(number, len(RATES) - 1)]
        local = blocks.select("held_out", "offsets", "codes", "hashes", "forms").mapInPandas(
            _train_round(model, number, rounds, rate), "salt long, tokens long, model binary"
        )
        local = run.keep(local, "models")
        sums = local.repartition(32, "salt").mapInPandas(_average, "tokens long, model binary").collect()  # 32 rows at most
        tokens = sum(r.tokens for r in sums)
        if tokens:
            model.flat = (sum(np.frombuffer(r.model, np.float64) for r in sums) / tokens).astype(np.float32)
    return model


def _score_block(model: Model):
    v = model.v
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(key, blocks, answers):
        out = []
        for row in blocks.itertuples():
            offsets = np.frombuffer(row.offsets, np.int64)
            codes = np.frombuffer(row.codes, np.int32)
            hashes, forms = np.frombuffer(row.hashes, np.uint64), np.frombuffer(row.forms, np.uint8)
            entries = np.concatenate([np.frombuffer(b, _ENTRY) for b in answers["entries"]])
            entries = entries[np.argsort(entries["hash"])]
            count = entries["count"][np.searchsorted(entries["hash"], hashes)].astype(np.float64)
            base = np.log10((count + SMOOTH) / (v.tokens + SMOOTH * (v.types + 1)))
            ids = v.ids(hashes, forms)
            share = np.zeros(len(ids))
            tail = ids >= HEAD
            of = ids[tail] - HEAD
            share[tail] = np.log10((count[tail] + SMOOTH) / (v.form_tokens[of] + SMOOTH * (v.form_types[of] + 1)))
            ids = ids.astype(np.int16)[codes]
            logs = np.zeros(len(codes))
            h = None
            size = np.diff(offsets)
            for pos, fresh, valid in windows(offsets[:-1], size, _n_lanes(len(codes)), SCORE_STEPS):
                live = pos.shape[1]
                h = np.zeros((live, STATE), np.float32) if h is None else h[:live]
                at = ids[pos]
                before, h, _ = model.states(at, fresh, h, False)
                mask = valid.reshape(-1)
                found, _ = model.token_logs(before.reshape(-1, STATE)[mask], at.reshape(-1)[mask])
                logs[pos.reshape(-1)[mask]] = found
            logs = logs / np.log(10) + share[codes]
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.array([None if i is None or i != i else int(i) for i in row.doc_id], dtype="Int64"),
                        "held_out": np.asarray(row.held_out, dtype=bool),
                        "n_tokens": np.diff(offsets),
                        "n_known": segment_sum((count > 0)[codes].astype(np.int64), offsets),
                        "train_tokens": v.tokens,
                        "base_score": np.add.reduceat(base[codes], offsets[:-1]),
                        "score": np.add.reduceat(logs, offsets[:-1]),
                    }
                )
            )
        return pd.concat(out)[names] if out else pd.DataFrame(columns=names)

    return run


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score (smoothed unigram) and score (the model),
    both log10 probabilities of the whole text and its end."""
    run = Run(docs.sparkSession, "lm")
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    blocks = run.keep(rows.mapInArrow(_blocks, _BLOCK), "blocks")
    total = blocks.agg(F.sum(F.length("hashes") / 8)).first()[0] or 0
    ranges = max(shuffle_partitions(run.spark), -(-int(total) // WORDS_PER_RANGE))
    dealt = blocks.select("block", "hashes", "forms", "counts").mapInPandas(
        _deal(ranges), "range int, block string, entries binary"
    )
    met = run.keep(dealt.groupBy("range").applyInPandas(_meet, "block string, entries binary"), "counts")
    vocabulary = _vocabulary(met)
    model = train(blocks, vocabulary, run, rounds)
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return (
        blocks.drop("counts")
        .groupBy("block")
        .cogroup(met.where("block not in ('top', 'sums')").groupBy("block"))
        .applyInPandas(_score_block(model), out)
    )
