"""SentencePiece encoding and decoding in batched numpy.

Method: a text is cut into units (white space runs with the characters after
them) that no piece spans; the distinct units of a batch are grouped by length
and each group is segmented by one dynamic programme. Prefix by prefix, hashes
of the substrings that end there probe the sorted hashes of the pieces, each
hit scores, the vectorised maximum over the hits is kept with a backpointer, and
the backpointers are followed from the end.

The score depends on the model. Unigram: best sum of piece scores (Viterbi).
BPE: the sum of scores does not give the model's segmentation, so a hit counts
only if the pair (last piece of the prefix before it, the hit) is one that
merging by rank leaves as it is; exactly one path holds this condition at every
step, and it is the merge result (a unit without such a path, as some long runs
of spaces, is merged outright). Pairs are judged in batches, once per distinct
pair, by undoing the merges next to the boundary.

Characters that no piece holds become byte pieces (or the unknown piece).

Cases: null or empty texts have no pieces; repeated rows and units are encoded
alike; texts of any length; an empty table gives an empty result; only doc_id
and text are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from flocklens.llm.common import encode_words, mix64, one_array, slices
from flocklens.llm.text_stats import text_bytes

SPACE = "▁"
_B = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 1 << 16  # units that advance together
SLOT_BITS = 21
KNOWN_UNITS = 500_000  # units whose ids a task remembers between batches


def _slot(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys.astype(np.uint64)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


# fixed values: field numbers of a model file (ModelProto.trainer_spec.model_type) and its types
TRAINER_SPEC, MODEL_TYPE = 2, 3
UNIGRAM, BPE = 1, 2


def _fields(data: memoryview):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


def model_type(model: bytes) -> int:
    """The type that a model file names; without one it is a unigram model."""
    found = UNIGRAM
    for number, value in _fields(memoryview(model)):
        if number == TRAINER_SPEC:
            found = next((v for n, v in _fields(value) if n == MODEL_TYPE), found)
    return found


class Pieces:
    """The piece table of a model file, unigram or BPE (its own type if not told)."""

    def __init__(self, path: str, unigram: bool | None = None):
        import sentencepiece

        if unigram is None:
            with open(path, "rb") as f:
                kind = model_type(f.read())
            if kind not in (UNIGRAM, BPE):
                raise ValueError(f"{path}: neither a unigram nor a BPE model")
            unigram = kind == UNIGRAM
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.size, self.unk = n, sp.unk_id()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.score = np.array([sp.get_score(i) for i in range(n)])
        self.unigram = unigram
        byte = {int(self.text[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_ids = np.array([byte[b] for b in range(256)], dtype=np.int64) if len(byte) == 256 else None
        self.surface = [t.replace(SPACE, " ").encode() for t in self.text]
        for i in range(n):
            if sp.is_control(i):
                self.surface[i] = b""
            elif sp.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
        for b, i in byte.items():
            self.surface[i] = bytes([b])
        self.longest = max(len(self.text[i]) for i in plain)
        lengths = np.array([len(self.text[i]) for i in plain])
        keys = np.array([hash_of(codes(self.text[i])) for i in plain], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(plain, dtype=np.int64)[order]
        self.lengths = np.unique(lengths)
        # merges of two pieces, sorted by (left, right)
        of = {self.text[i]: i for i in plain}
        merges = {}
        for i in plain:
            t = self.text[i]
            for k in range(1, len(t)):
                if t[:k] in of and t[k:] in of:
                    merges[of[t[:k]] * n + of[t[k:]]] = i
        self.merge_keys = np.array(sorted(merges), dtype=np.int64)
        self.merge_ids = np.array([merges[k] for k in sorted(merges)], dtype=np.int64)
        self.char_ids = [[of.get(c, -1) for c in t] for t in self.text]
        # which slots hold any key: spares most searches
        self.maybe_piece = np.zeros(1 << SLOT_BITS, dtype=bool)
        self.maybe_piece[_slot(self.keys)] = True
        self.maybe_merge = np.zeros(1 << SLOT_BITS, dtype=bool)
        self.maybe_merge[_slot(self.merge_keys)] = True
        self.order = np.empty(n, dtype=np.int64)  # of merging: by score, then id
        self.order[np.lexsort((np.arange(n), -self.score))] = np.arange(n)
        self.split_left, self.split_right = self._splits()
        # a piece that merging its characters does not give is never an output
        made = np.array([len(t) == 1 for t in self.text]) | (self.split_left >= 0)
        if not self.unigram:
            usable = made[self.ids]
            self.keys, self.ids = self.keys[usable], self.ids[usable]
        self._forget()

    def _forget(self) -> None:
        """Judged pairs: a slot holds the last pair that fell on it."""
        self.judged = np.full(1 << SLOT_BITS, -1, dtype=np.int64)
        self.judged_ok = np.zeros(1 << SLOT_BITS, dtype=bool)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("judged")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def probe(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the substring hashes are pieces, those pieces)."""
        some = np.flatnonzero(self.maybe_piece[_slot(h)])
        h = h[some]
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        hit = self.keys[at] == h
        return some[hit], self.ids[at[hit]]

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that two neighbours merge into, or -1."""
        key = (a * self.size + b).ravel()
        out = np.full(len(key), -1, dtype=np.int64)
        some = np.flatnonzero(self.maybe_merge[_slot(key)] & ((a >= 0) & (b >= 0)).ravel())
        at = np.minimum(np.searchsorted(self.merge_keys, key[some]), len(self.merge_keys) - 1)
        hit = self.merge_keys[at] == key[some]
        out[some[hit]] = self.merge_ids[at[hit]]
        return out.reshape(a.shape)

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the characters of pieces a + b by rank ends in exactly (a, b)."""
        key = a * self.size + b
        slot = _slot(key)
        ok = self.judged_ok[slot]
        new = np.flatnonzero(self.judged[slot] != key)
        if len(new):
            distinct, back = np.unique(key[new], return_inverse=True)
            found = self._judge(distinct // self.size, distinct % self.size)
            ok[new] = found[back]
            at = _slot(distinct)
            self.judged[at], self.judged_ok[at] = distinct, found
        return ok

    def _judge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undo the merges of both pieces, latest first, next to the boundary:
        the pair holds unless some pair across it would have merged earlier."""
        out = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), 2 * self.size, dtype=np.int64)  # twice the order, plus one on the right
        while len(live):
            across = self.merged(a, b)
            broken = (across >= 0) & (2 * self.order[across] < limit)
            out[live[broken]] = False
            left, right = self.order[a], self.order[b]
            can_left, can_right = self.split_right[a] >= 0, self.split_left[b] >= 0
            take = can_left & ((left > right) | ~can_right)
            other = ~take & can_right
            limit = np.where(take, 2 * left, np.where(other, 2 * right + 1, limit))
            a, b = np.where(take, self.split_right[a], a), np.where(other, self.split_left[b], b)
            go_on = ~broken & (take | other)
            live, a, b, limit = live[go_on], a[go_on], b[go_on], limit[go_on]
        return out

    def _splits(self) -> tuple[np.ndarray, np.ndarray]:
        """The two pieces that each piece's last merge joins, or -1."""
        left, right = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)
        size = np.array([len(c) for c in self.char_ids])
        size[np.array([not c or min(c) < 0 for c in self.char_ids])] = 0
        for n in range(2, int(size.max(initial=0)) + 1):
            rows = np.flatnonzero(size == n)
            if len(rows):
                out, count = self.merge_all(np.array([self.char_ids[i] for i in rows], dtype=np.int64), keep=2)
                whole = (count == 2) & (self.merged(out[:, 0], out[:, 1]) == rows)
                left[rows[whole]], right[rows[whole]] = out[whole, 0], out[whole, 1]
        return left, right

    def merge_all(self, ids: np.ndarray, keep: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Merge rows of piece ids, best score first and leftmost among equals,
        until nothing merges or ``keep`` pieces are left: (left-aligned ids, how many)."""
        ids = np.concatenate([ids, np.full((len(ids), 1), -2, np.int64)], axis=1)
        count = np.full(len(ids), ids.shape[1] - 1)
        live = np.arange(len(ids))
        while len(live) and ids.shape[1] > 2:
            now = ids[live]
            to = self.merged(now[:, :-1], now[:, 1:])
            rank = np.where(to >= 0, self.score[to], -np.inf)
            best = rank.argmax(axis=1)
            row = np.arange(len(live))
            any_left = (to[row, best] >= 0) & (count[live] > keep)
            live, best, row = live[any_left], best[any_left], row[any_left]
            if not len(live):
                break
            now, to = now[row], to[row, best]
            column = np.arange(ids.shape[1])[None, :]
            shifted = np.concatenate([now[:, 1:], np.full((len(now), 1), -2, np.int64)], axis=1)
            now = np.where(column > best[:, None], shifted, now)
            now[np.arange(len(now)), best] = to
            ids[live] = now
            count[live] -= 1
        return ids, count


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _prefix(chars: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes along the last axis: h[i+1] = h[i] * B + char."""
    h = np.zeros((*chars.shape[:-1], chars.shape[-1] + 1), dtype=np.uint64)
    c = mix64(chars + np.uint64(1))
    for i in range(chars.shape[-1]):
        h[..., i + 1] = h[..., i] * _B + c[..., i]
    return h


def hash_of(chars: np.ndarray) -> np.uint64:
    return _prefix(chars)[-1]


def segment(chars: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment equally long rows of code points: (start of the last piece at
    each prefix, that piece or -1 for an uncovered character, whether the row has a path)."""
    rows, n = chars.shape
    h = _prefix(chars)
    power = np.ones(pieces.longest + 1, dtype=np.uint64)
    power[1:] = np.cumprod(np.full(pieces.longest, _B, dtype=np.uint64))
    back = np.zeros((rows, n + 1), dtype=np.int32)
    last = np.full((rows, n + 1), -1, dtype=np.int64)
    total = np.full((rows, n + 1), -np.inf)
    total[:, 0] = 0.0
    floor = pieces.score.min() - 10.0
    for end in range(1, n + 1):
        for size in pieces.lengths[pieces.lengths <= end][::-1]:
            start = end - size
            at, p = pieces.probe(h[:, end] - h[:, start] * power[size])
            go_on = total[at, start] > -np.inf
            if not pieces.unigram:  # one path at most: settled rows need no other hit
                go_on &= total[at, end] == -np.inf
            at, p = at[go_on], p[go_on]
            if not len(at):
                continue
            if pieces.unigram:
                score = total[at, start] + pieces.score[p]
            else:
                before = last[at, start]
                score = np.zeros(len(at))
                inner = np.flatnonzero((before >= 0) & (start > 0))
                score[inner[~pieces.stable(before[inner], p[inner])]] = -np.inf
            better = score > total[at, end]
            at = at[better]
            total[at, end], back[at, end], last[at, end] = score[better], start, p[better]
        # a character that no piece holds stands alone
        lone = np.flatnonzero(total[:, end] == -np.inf)
        if len(lone):
            held, _ = pieces.probe(h[lone, end] - h[lone, end - 1] * power[1])
            alone = np.delete(lone, held)
            alone = alone[total[alone, end - 1] > -np.inf]
            total[alone, end] = total[alone, end - 1] + (floor if pieces.unigram else 0.0)
            back[alone, end] = end - 1
    return back, last, total[:, n] > -np.inf


def _merged_path(chars: np.ndarray, pieces: Pieces, back: np.ndarray, last: np.ndarray) -> None:
    """Write the path that merging by rank gives into a row of the programme."""
    ids = np.full(len(chars), -1, dtype=np.int64)
    at, found = pieces.probe(mix64(chars + np.uint64(1)))
    ids[at] = found
    out, count = pieces.merge_all(ids[None, :])
    end = 0
    for p in out[0, : count[0]].tolist():
        start, end = end, end + (len(pieces.text[p]) if p >= 0 else 1)
        back[end], last[end] = start, p


def encode_units(units: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all units, offsets)."""
    size = np.array([len(u) for u in units], dtype=np.int64)
    out: list[np.ndarray | None] = [None] * len(units)
    for n in np.unique(size):
        of = np.flatnonzero(size == n)
        block = max(1, min(BLOCK, (1 << 20) // int(n + 1)))
        for a in range(0, len(of), block):
            rows = of[a : a + block]
            chars = codes("".join(units[i] for i in rows)).reshape(len(rows), n)
            back, last, has_path = segment(chars, pieces)
            for k in np.flatnonzero(~has_path):  # long runs of equal pieces that merge in turns
                _merged_path(chars[k], pieces, back[k], last[k])
            # follow the backpointers of all rows together
            at = np.full(len(rows), n)
            steps = []
            while (at > 0).any():
                live = np.flatnonzero(at > 0)
                steps.append((live, last[live, at[live]], chars[live, at[live] - 1]))
                at[live] = back[live, at[live]]
            row = np.concatenate([s[0] for s in steps])
            piece = np.concatenate([s[1] for s in steps])
            char = np.concatenate([s[2] for s in steps])
            when = np.repeat(-np.arange(len(steps)), [len(s[0]) for s in steps])
            order = np.lexsort((when, row))
            row, piece, char = row[order], piece[order], char[order]
            lone = np.flatnonzero(piece < 0)
            if len(lone) and pieces.byte_ids is not None:
                parts = [np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), np.uint8) for c in char[lone].tolist()]
                many = np.ones(len(piece), dtype=np.int64)
                many[lone] = [len(p) for p in parts]
                first = np.cumsum(many) - many
                full = np.repeat(piece, many)
                for i, p in zip(first[lone], parts):
                    full[i : i + len(p)] = pieces.byte_ids[p]
                piece, row = full, np.repeat(row, many)
            elif len(lone):
                piece = np.where(piece < 0, pieces.unk, piece)
            cut = np.searchsorted(row, np.arange(len(rows) + 1))
            for k, i in enumerate(rows):
                out[i] = piece[cut[k] : cut[k + 1]]
    lengths = np.array([len(o) for o in out], dtype=np.int64)
    flat = np.concatenate([*out, np.zeros(0, np.int64)]).astype(np.int64)
    return flat, np.concatenate(([0], np.cumsum(lengths)))


def units_of(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All units of all texts (a space before each text), and each text's offsets."""
    text = one_array(text)
    n = len(text)
    empty = np.asarray(pc.binary_length(text).to_numpy(zero_copy_only=False)) == 0
    led = pc.binary_join_element_wise(" ", text, "")
    led = pc.if_else(pa.array(empty), pa.scalar("", led.type), led)
    raw, offsets = text_bytes(led)
    space = raw == 32
    # the mark that stands for a space may also be in the text itself
    mark = np.flatnonzero(raw[:-2] == 0xE2) if len(raw) > 2 else np.zeros(0, np.int64)
    mark = mark[(raw[mark + 1] == 0x96) & (raw[mark + 2] == 0x81)]
    for k in range(3):
        space[mark + k] = True
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[offsets[:-1][~empty]] = True
    starts = np.flatnonzero(begins)
    cuts = np.concatenate((starts, [len(raw)])).astype(np.int32)
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(cuts.tobytes()), pa.py_buffer(raw.tobytes()))
    return units, np.searchsorted(starts, offsets)


def encode(text: pa.Array, pieces: Pieces, known: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids of all texts, offsets). ``known`` remembers units between calls."""
    units, offsets = units_of(text)
    at, distinct = encode_words(units)
    words = [u.replace(" ", SPACE) for u in distinct.to_pylist()]
    known = {} if known is None else known
    missing = [w for w in words if w not in known]
    if len(known) + len(missing) > KNOWN_UNITS:
        known.clear()
        missing = words
    flat, cut = encode_units(missing, pieces)
    raw, cut = flat.astype(np.int32).tobytes(), (4 * cut).tolist()
    known.update(zip(missing, (raw[a:b] for a, b in zip(cut, cut[1:]))))
    ids = [known[w] for w in words]
    size = np.array([len(i) for i in ids], dtype=np.int64) // 4
    flat = np.frombuffer(b"".join(ids), np.int32)
    begin = np.cumsum(size) - size
    many = size[at]
    source = np.repeat(begin[at] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    ends = np.concatenate(([0], np.cumsum(many)))
    return flat[source].astype(np.uint32), ends[offsets]


def decode(ids: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> list[str]:
    """The texts of piece ids: the inverse of ``encode`` (broken bytes become U+FFFD)."""
    table = np.frombuffer(b"".join(pieces.surface), np.uint8)
    size = np.array([len(s) for s in pieces.surface])
    begin = np.cumsum(size) - size
    many = size[ids]
    source = np.repeat(begin[ids] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    raw = table[source].tobytes()
    ends = np.concatenate(([0], np.cumsum(many)))[offsets]
    texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return [t.removeprefix(" ") for t in texts]


def tokenise(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_pieces, ids_crc32 (of
    the little-endian uint32 ids), round_trip (decoding gives the text back)
    and, on request, ids."""

    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model_path))  # the size of the model file, some MB

    def run(batches):
        pieces, known = shared.value, {}
        for batch in batches:
            for part in slices(batch, "text", max_bytes=8 << 20):
                text = one_array(part.column("text"))
                ids, offsets = encode(text, pieces, known)
                ids = ids.astype("<u4")
                view = memoryview(ids).cast("B")
                blobs = [view[4 * a : 4 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                back = pa.array(decode(ids, offsets, pieces), pa.string())
                yield pa.record_batch(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(np.diff(offsets)),
                        pa.array([zlib.crc32(b) for b in blobs], pa.int64()),
                        pc.equal(back, text),
                        pa.array([bytes(b) for b in blobs] if with_ids else [None] * len(blobs), pa.binary()),
                    ],
                    names=["doc_id", "n_pieces", "ids_crc32", "round_trip", "ids"],
                )

    out = docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean, ids binary"
    )
    return out if with_ids else out.drop("ids")
