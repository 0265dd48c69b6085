"""Operators over documents, on odd rows and against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import brute

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# ---- MinHash near-dedup


def _unique(odd_rows):
    """Rows with ids, repeated ones once."""
    return list({r[0]: (r[0], r[1]) for r in odd_rows if r[0] is not None}.values())


def test_near_duplicates_odd_rows(odd, odd_rows, empty):
    from flocklens.llm.minhash_forest import near_duplicates

    want = brute.near_duplicates(_unique(odd_rows), 4)
    got = near_duplicates(odd, words=4).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]
    assert near_duplicates(empty, words=4).count() == 0


def test_near_duplicates_many_copies(spark):
    """Hundreds of exact and near copies, chains and neighbours below the limit."""
    from flocklens.llm.minhash_forest import near_duplicates

    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(120)]
    rows = [(i, " ".join(base)) for i in range(150)]
    for i in range(150, 400):  # near copies of the base, one to nine words changed
        t = list(base)
        for _ in range(rnd.randint(1, 9) if i % 2 else rnd.randint(2, 4)):
            t[rnd.randrange(len(t))] = word()
        rows.append((i, " ".join(t)))
    chain = [word() for _ in range(100)]
    for i in range(400, 430):  # each near the one before
        chain = chain[3:] + [word() for _ in range(3)]
        rows.append((i, " ".join(chain)))
    rows += [(i, " ".join(word() for _ in range(rnd.randint(1, 40)))) for i in range(430, 600)]
    want = brute.near_duplicates(rows, 5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_near_duplicates_hot_region_of_mixed_sizes(spark):
    """One region whose sorted neighbours mostly have sizes that rule a link out."""
    from flocklens.llm.minhash_forest import near_duplicates

    word = lambda tag, k: [f"{tag}{i}" for i in range(k)]
    template, rows = word("t", 300), []
    for d in range(36):
        body = template + word(f"b{d}x", int(20 * 1.12**d))
        rows += [(2 * d, " ".join(body)), (2 * d + 1, " ".join(body + word(f"c{d}x", 2)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = near_duplicates(df, words=3, trees=1, depth=1, min_depth=1).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute.near_duplicates(rows, 3)


def test_outsiders_of_one_template_meet_by_prefix_rows():
    """All sets are outsiders of one group and as large as each other: the join
    finds each similar pair, without comparing all of them, in cells too."""
    import pandas as pd

    from flocklens.llm import minhash_forest as forest

    rng = np.random.default_rng(3)
    draw = lambda k: rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2)
    sets = []
    for share in (100, 140):  # template shingles of 165
        template = draw(share)
        for _ in range(150):
            body = draw(165 - share)
            sets.append(np.sort(np.concatenate([template, body])))
            if len(sets) % 5 == 0:
                sets.append(np.sort(np.concatenate([template[int(rng.integers(0, 12)) :], body, draw(int(rng.integers(0, 12)))])))
    ids = np.arange(len(sets))
    often = np.zeros(forest.SLOTS, np.uint32)
    count = forest._counts([s.tobytes() for s in sets])
    often[count["slot"]] = count["many"]
    frame = pd.DataFrame({"c": 7, "cid": ids, "g": ids, "out": True, "shingles": [s.tobytes() for s in sets]})
    shared = type("Shared", (), {"value": often})
    rows = pd.concat(forest._prefix_rows(shared)([frame]))
    both = lambda i, j: pd.concat([rows[rows.cid % 2 == i].assign(i=i, j=j, side=0), rows[rows.cid % 3 == j].assign(i=i, j=j, side=1)])
    whole = pd.concat(forest._meetings([rows.assign(i=0, j=0, side=k) for k in (0, 1)]))
    cells = pd.concat(forest._meetings([both(i, j) for i in range(2) for j in range(3)]))
    met = set(zip(whole.a, whole.b))
    assert met == set(zip(cells.a, cells.b))
    near = set()
    for x in range(len(sets)):
        for y in range(x + 1, len(sets)):
            n = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if 100 * n >= 80 * (len(sets[x]) + len(sets[y]) - n):
                near.add((x, y))
    assert len(near) > 30 and near <= met
    assert len(met) < len(sets) * 4


def test_keep_one_keeps_columns_and_one_of_each(odd, odd_rows):
    from flocklens.llm.minhash_forest import keep_one

    kept = keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None))
    assert ids == sorted(i for i, (_, _, kept) in brute.near_duplicates(_unique(odd_rows), 5).items() if kept)


def test_components_of_long_chains_and_stars(spark):
    from flocklens.llm.common import Run
    from flocklens.llm.components import components

    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 5000), (6001, 6000)]
    rnd.shuffle(links)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(5), Run(spark, "t")).collect()}
    ids = {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: c for i, c in brute.groups(ids, [(a, b) for a, b in links if a != b]).items()}


# ---- substring dedup


@pytest.mark.parametrize("window", [3, 20, 35])
def test_remove_repeats_odd_rows(odd, odd_rows, empty, window):
    from flocklens.llm.repeats import remove_repeats

    want = Counter()
    for i, w, gone in brute.removed_words([(r[0], r[1]) for r in odd_rows], window):
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(odd, window).collect())
    assert got == want
    assert remove_repeats(empty, window).count() == 0


def test_strip_repeats_keeps_rows_and_columns(odd, odd_rows):
    from flocklens.llm.repeats import strip_repeats

    out = strip_repeats(odd, 20)
    assert out.columns == odd.columns
    want = Counter()
    for (i, w, gone), row in zip(brute.removed_words([(r[0], r[1]) for r in odd_rows], 20), odd_rows):
        want[i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else row[1]] += 1
    assert Counter((r.doc_id, r.text) for r in out.collect()) == want


def test_levels_double_up_to_the_window():
    from flocklens.llm.repeats import levels

    assert levels(35) == [18, 35]
    assert levels(100) == [13, 25, 50, 100]
    assert levels(3) == [3]


# ---- quality rules


def _base(text):
    text = text or ""
    w = brute.WORD.findall(text)
    lines = [x for x in text.split("\n") if brute.WORD.search(x)]
    win = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = set()
    for i in range(len(w) - 7):
        if win[tuple(w[i : i + 8])] > 1:
            again.update(range(i, i + 8))
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(again),
        len(w) < 20 or 100 * len(again) > 30 * len(w),
    )


def test_rules_base_counts(odd, odd_rows, empty):
    from flocklens.llm.weak_rules import score

    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in score(odd).collect())
    assert got == Counter((r[0], *_base(r[1])) for r in odd_rows)
    assert not [r for r in score(odd).collect() if r.base_failed and r.kept]
    assert score(empty).count() == 0


def test_rules_keep_clean_documents(spark):
    from flocklens.llm.weak_rules import score

    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF2}/labels.parquet").collect()}
    got = [(labels[r.doc_id], r.kept, r.base_failed) for r in score(docs).collect() if r.doc_id in labels]
    clean = [k for q, k, b in got if q == 1 and not b]
    junk = [k for q, k, b in got if q == 0]
    assert sum(clean) >= 0.98 * len(clean)
    assert sum(junk) <= 0.1 * len(junk)
    base = {r[0]: tuple(r[1:]) for r in ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in score(docs).collect())}
    assert all(base[r.doc_id] == _base(r.text) for r in docs.collect())


def test_rule_accuracies_are_found():
    """EM recovers which rules are right from votes alone."""
    from flocklens.llm.weak_rules import fit

    rng = np.random.default_rng(1)
    good = rng.random(20000) < 0.8
    votes = np.zeros((20000, 4), int)
    for k, (right, speaks) in enumerate([(0.97, 0.9), (0.95, 0.8), (0.9, 0.5), (0.55, 0.7)]):
        vote = np.where(rng.random(20000) < right, good, ~good) * 2 - 1
        votes[:, k] = np.where(rng.random(20000) < speaks, vote, 0)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    odds, weights = fit(patterns, counts.astype(float))
    total = odds + (np.where(votes < 0, weights[:, 0], 0) + np.where(votes > 0, weights[:, 1], 0)).sum(axis=1)
    assert ((total > 0) == good).mean() > 0.97
    assert weights[0, 1] - weights[0, 0] > weights[3, 1] - weights[3, 0]


# ---- quality classifier


def test_factorisation_machine_equals_the_pairwise_sum():
    from flocklens.llm.quality_fm import FactorisationMachine

    rng = np.random.default_rng(0)
    m = FactorisationMachine(12, rank=3)
    m.w[:], m.w0[:] = rng.normal(size=12), 0.3
    x = rng.normal(size=(5, 12)).astype(np.float32)
    for row, got in zip(x, m.margin(x)):
        want = m.w0[0] + row @ m.w + sum(m.v[i] @ m.v[j] * row[i] * row[j] for i in range(12) for j in range(i))
        assert abs(want - got) < 1e-4


def test_quality_held_out_accuracy_and_odd_rows(spark, odd, empty, odd_rows):
    from flocklens.llm import quality_fm as q

    docs, labels = spark.read.parquet(f"{SF2}/documents.parquet"), spark.read.parquet(f"{SF2}/labels.parquet")
    model = q.train(docs, q.learnable(labels))
    known = {r.doc_id: r.quality for r in labels.collect()}
    got = [(r, known[r.doc_id]) for r in q.score(docs, model).collect() if r.held_out and r.doc_id in known]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r, _ in got)
    assert sum(r.predicted == y for r, y in got) >= 0.95 * len(got)
    out = q.score(odd, model).collect()
    assert len(out) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert q.score(empty, model).count() == 0
    assert q.train(empty, labels) is None and q.train(docs, labels.where("false")) is None
    assert {r.score for r in q.score(odd, None).collect()} == {0.5}
    whole = q.score(odd, model, whole_rows=True).select("whole.*")
    assert whole.columns == odd.columns and whole.count() == len(odd_rows)


# ---- language


def test_language_held_out_accuracy_and_odd_rows(spark, odd, empty, odd_rows):
    from flocklens.llm import language_id as li

    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    model = li.train(docs.where(~li.held_out()))
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = [r for r in li.predict(docs, model).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in got) >= 0.97 * len(got)
    out = {(r.doc_id, r.lang_pred) for r in li.predict(odd, model).collect()}
    assert {(2, "und"), (3, "und"), (8, "und"), (10, "und")} <= out and (1, "en") in out
    assert all(0 <= r.score <= 1 for r in li.predict(odd, model).collect())
    assert li.predict(empty, model).count() == 0 and li.train(empty) is None
    assert {r.lang_pred for r in li.predict(odd, None).collect()} == {"und"}
    one = li.train(docs.where("lang = 'de'"))
    assert {r.lang_pred for r in li.predict(odd, one).collect()} == {"und", "de"}


# ---- packing


def _pieces(rows, limit):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(P.path("word_bpe_49k.json")))
    out = Counter()
    for i, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for k, a in enumerate(range(0, len(ids), limit)):
            out[i, k, a, len(ids[a : a + limit]), zlib.crc32(ids[a : a + limit].tobytes())] += 1
    return out


@pytest.mark.parametrize("rule,docs,attention", [("norm", None, None), ("dot", 3, 150_000)])
def test_packing(odd, odd_rows, empty, rule, docs, attention):
    import public_tokenizers as P

    from flocklens.llm.packing import pack

    path = str(P.path("word_bpe_49k.json"))
    limit = 512
    got = pack(odd, path, max_tokens=limit, max_docs=docs, max_attention=attention, rule=rule, with_ids=True).collect()
    cut = limit if attention is None else int(attention**0.5)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == _pieces([r[:2] for r in odd_rows], cut)
    sequences = {}
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit and len(parts) <= (docs or limit)
        assert sum(n * n for _, n in parts) <= (attention or limit * limit)
    if docs is None:
        assert len(sequences) == -(-sum(r.length for r in got) // limit)
    assert pack(empty, path).count() == 0


def test_best_fit_beats_first_fit():
    from flocklens.llm.packing import best_fit

    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 2048, 3000)
    bins = best_fit(lengths, np.array([2048.0, 2048, 2048**2]), np.array([1.0, 0, 0]), "norm")
    used = np.bincount(bins, weights=lengths)
    assert used.max() <= 2048
    assert len(used) <= 1.02 * math.ceil(lengths.sum() / 2048)


# ---- SentencePiece


def test_sentencepiece_equals_the_library(odd, odd_rows, empty):
    import public_tokenizers as P
    import sentencepiece

    from flocklens.llm.sentencepiece_viterbi import tokenise

    path = str(P.path("piece_bpe_32k.model"))
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    want = Counter()
    for r in odd_rows:
        ids = np.array(sp.encode(r[1] or "", num_threads=1), dtype="<u4")
        want[r[0], len(ids), zlib.crc32(ids.tobytes()), True] += 1
    got = tokenise(odd, path, with_ids=True).collect()
    assert Counter((r.doc_id, r.n_pieces, r.ids_crc32, r.round_trip) for r in got) == want
    assert tokenise(empty, path).count() == 0


def test_sentencepiece_on_mixed_pieces():
    """Random characters, pieces and space marks, where merges compete."""
    import public_tokenizers as P
    import sentencepiece

    from flocklens.llm import sentencepiece_viterbi as s

    path = str(P.path("piece_bpe_32k.model"))
    pieces, sp = s.Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("aabbeett ththe .-_▁é\n1") for _ in range(rnd.randint(1, 40))) for _ in range(2000)]
    texts += ["".join(pieces.text[rnd.randrange(259, 32000)] for _ in range(rnd.randint(1, 6))) for _ in range(2000)]
    ids, offsets = s.encode(pa.array(texts), pieces)
    want = sp.encode(texts, num_threads=1)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == want


def test_unigram_segmentation_is_the_best_path():
    """The Viterbi score of the piece table against all segmentations."""
    import public_tokenizers as P

    from flocklens.llm import sentencepiece_viterbi as s

    pieces = s.Pieces(str(P.path("piece_bpe_32k.model")), unigram=True)
    of = {pieces.text[i]: i for i in pieces.ids}
    pieces.score = np.where(pieces.score > -5000, pieces.score, pieces.score * 1.5)
    units = ["▁hello", "▁nation", "▁theing", "▁abcab", "▁été"]
    flat, cut = s.encode_units(units, pieces)

    def best(text):
        table = {0: (0.0, ())}
        for end in range(1, len(text) + 1):
            options = [
                (table[a][0] + pieces.score[of[text[a:end]]], table[a][1] + (of[text[a:end]],))
                for a in range(end)
                if a in table and text[a:end] in of
            ]
            table[end] = max(options)
        return table[len(text)]

    for k, u in enumerate(units):
        got = flat[cut[k] : cut[k + 1]]
        assert abs(pieces.score[got].sum() - best(u)[0]) < 1e-6


def test_decode_is_the_inverse():
    import public_tokenizers as P

    from flocklens.llm import sentencepiece_viterbi as s

    pieces = s.Pieces(str(P.path("piece_bpe_32k.model")))
    texts = ["", " ", "a", "  two  spaces ", "line\nbreak\ttab", "漢字 emoji 🙂🙂", "x" * 300, "<s> </s> <0x0A>"]
    ids, offsets = s.encode(pa.array(texts), pieces)
    assert s.decode(ids, offsets, pieces) == texts


# ---- language model


def test_language_model(spark, odd, odd_rows, empty):
    from flocklens.llm.recurrent_lm import score

    got = score(odd).collect()
    tokens = [(r[0], brute.WORD.findall(brute.lower(r[1] or "")) + ["\n"]) for r in odd_rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(x for i, t in tokens if not held(i) for x in t)
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in tokens:
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
        want[i, held(i), len(t), sum(c[x] > 0 for x in t), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert score(empty).count() == 0


def test_language_model_beats_the_unigram(spark):
    from flocklens.llm.recurrent_lm import score

    got = [r for r in score(spark.read.parquet(f"{SF2}/documents.parquet")).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_token_probabilities_sum_to_one_and_gradients_match():
    from flocklens.llm import recurrent_lm as lm

    rng = np.random.default_rng(4)
    counts = np.sort(rng.integers(5, 500, 100))[::-1].astype(float)
    v = lm.Vocabulary(np.arange(100, dtype=np.uint64), counts, np.full(lm.FORMS, 7), np.full(lm.FORMS, 30), int(counts.sum()) + 30 * lm.FORMS, 100 + 7 * lm.FORMS)
    m = lm.Model(v)
    m.flat += rng.normal(0, 0.1, len(m.flat)).astype(np.float32)
    s = rng.normal(0, 0.5, (1, lm.STATE)).astype(np.float32)
    ids = np.concatenate([np.arange(100), lm.HEAD + np.arange(lm.FORMS)])
    logs, _ = m.token_logs(np.repeat(s, len(ids), axis=0), ids)
    assert abs(np.exp(logs).sum() - 1) < 1e-3
    # backpropagation through a window against differences of the loss
    ids = rng.choice(ids, (6, 3)).astype(np.int16)
    fresh = np.zeros((6, 3), bool)
    fresh[0], fresh[3, 1] = True, True
    valid = np.ones((6, 3), bool)
    valid[5, 2] = False
    start = np.zeros((3, lm.STATE), np.float32)

    def loss():
        before, _, _ = m.states(ids, fresh, start, False)
        logs, _ = m.token_logs(before.reshape(-1, lm.STATE)[valid.reshape(-1)], ids.reshape(-1)[valid.reshape(-1)])
        return -logs.mean()

    grad, _ = m.learn(ids, fresh, valid, start)
    for name in ("x", "u", "c", "cb", "w"):
        at, size, _ = m.slots[name]
        k = at + int(np.abs(grad[at : at + size]).argmax())
        old = m.flat[k]
        m.flat[k] = old + 0.01
        up = loss()
        m.flat[k] = old - 0.01
        down = loss()
        m.flat[k] = old
        assert abs((up - down) / 0.02 - grad[k]) < 0.03 * abs(grad[k]) + 2e-4, name


def test_packing_merges_plain_words_as_the_library():
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    from flocklens.llm import packing

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    every = [chr(c) for c in range(0x21, 0x250)]
    texts = ["".join(f"x{c} {c}. {c}b{c}! Q{c}z;' " for c in every), "it's don't. we'll THE " + "q" * 500, "<|endoftext|> a<|endoftext|>b. <|", "", "é" * 150 + " ok"]
    ids, at = packing.token_ids(pa.array(texts), packing.WordIds(path), 0)
    want = [e.ids + [0] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_packing_deals_equal_rows_out(spark):
    import public_tokenizers
    from pyspark.sql import functions as F

    from flocklens.llm import packing

    docs = spark.range(60_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same words").alias("text"))
    found = packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))
    groups = found.groupBy(F.shiftright("sequence_id", 32)).count().collect()
    assert sum(g["count"] for g in groups) == 60_000 and max(g["count"] for g in groups) <= 2 * packing.GROUP
    # as full as can be: 682 documents of three tokens in a sequence, and a last one in each group
    assert found.select("sequence_id").distinct().count() <= -(-60_000 // 682) + len(groups)


def test_sample_shares_never_vanish():
    from flocklens.llm.common import SAMPLE_RANGE, sample_share

    assert sample_share(20, 10) == sample_share(10, 10) == SAMPLE_RANGE
    assert sample_share(1, 10**12) > 0 and sample_share(1, 1 << 70) == 1
    for wanted, rows in ((20, 10**9), (8000, 10**11)):
        assert abs(sample_share(wanted, rows) / SAMPLE_RANGE * rows / wanted - 1) < 1e-6


def test_near_duplicates_verify_in_contracting_rounds(spark):
    """A dense group of near copies is settled by few of its candidate pairs, and
    pairs that fail in one round leave room for those that hold in a later one."""
    from flocklens.llm import minhash_forest as forest
    from flocklens.llm.common import Run

    rng = np.random.default_rng(11)
    draw = lambda k: rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2)
    base = draw(100)
    near = [np.sort(np.concatenate([base[rng.permutation(100)[:97]], draw(3)])) for _ in range(60)]
    half = [np.sort(np.concatenate([base[:60], draw(40)])) for _ in range(12)]  # like nothing
    late = np.sort(np.concatenate([half[11][:95], draw(5)]))  # like the last of them alone
    sets = [*near, *half, late]
    frame = [(i, len(s), bytearray(s.tobytes())) for i, s in enumerate(sets)]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))]
    links = [
        (i, j)
        for i, j in pairs
        if 100 * len(both := np.intersect1d(sets[i], sets[j])) >= 80 * (len(sets[i]) + len(sets[j]) - len(both))
    ]
    compared, verify = [], forest._verify

    def counting(stars, *rest):
        compared.append(stars.count())
        return verify(stars, *rest)

    forest._verify = counting
    try:
        found = forest._settle(
            spark.createDataFrame(pairs, "a long, b long"),
            spark.createDataFrame(frame, "cid long, size long, shingles binary"),
            Run(spark, "t"),
        )
        got = {r.id: r.component for r in found.collect()}
    finally:
        forest._verify = verify
    want = brute.groups({x for p in links for x in p}, links)
    assert (71, 72) in links and {i: got[i] for i in want} == want and len(compared) > 2
    assert sum(compared) < len(pairs) / 2
