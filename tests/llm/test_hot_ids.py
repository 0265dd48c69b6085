"""One id, or no id, on a third of all rows and on different texts."""

import random
import time
from collections import Counter

import numpy as np
import pytest

import brute


def _texts(n, seed, words=60):
    rnd = random.Random(seed)
    return [" ".join(f"w{rnd.randrange(5000)}" for _ in range(words)) for _ in range(n)]


def test_remove_repeats_of_one_id(spark):
    """Texts of a repeated or null id meet their own candidates only."""
    from flocklens.llm.repeats import remove_repeats

    shared = " ".join(f"s{i}" for i in range(40))
    texts = [f"{t} {shared}" for t in _texts(60, 1)] + _texts(40, 2)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]
    rows += rows[:5] + [(7, "  " + rows[0][1]), (None, None), (7, "")]
    want = Counter((i, len(w), len(gone)) for i, w, gone in brute.removed_words(rows, 35))
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 35).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed) for r in got) == want


def test_time_does_not_grow_with_the_square_of_an_id(spark):
    from flocklens.llm.repeats import remove_repeats

    shared = " ".join(f"s{i}" for i in range(40))
    texts = [f"{t} {shared}" for t in _texts(1500, 3)]

    def seconds(ids):
        df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
        begin = time.time()
        assert remove_repeats(df, 35).where("n_removed >= 40").count() == len(texts)
        return time.time() - begin

    own = seconds(range(len(texts)))
    assert seconds([None] * len(texts)) < 3 * own + 5


def test_keep_one_decides_on_the_row(spark):
    """One id on two texts: the near copy of a smaller id goes, the other text stays."""
    from flocklens.llm.minhash_forest import keep_one

    a, b, c = _texts(3, 4)
    rows = [(1, a), (2, a + " end"), (2, b), (3, c), (3, c + " end"), (3, c), (None, a), (4, ""), (4, " "), (4, "")]
    got = keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = Counter((r.doc_id, r.text) for r in got)
    assert kept[1, a] == 1 and kept[2, a + " end"] == 0 and kept[2, b] == 1
    assert kept[3, c] + kept[3, c + " end"] == 1
    assert kept[None, a] == 1 and kept[4, ""] == 1 and kept[4, " "] == 1
    assert sum(kept.values()) == 6


@pytest.fixture
def collected(monkeypatch):
    """The number of rows of each collect()."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen, plain = [], DataFrame.collect

    def collect(self):
        rows = plain(self)
        seen.append(len(rows))
        return rows

    monkeypatch.setattr(DataFrame, "collect", collect)
    return seen


@pytest.mark.parametrize("hot", [5, None])
def test_language_sample_is_bounded(spark, collected, hot):
    from flocklens.llm import language_id as li

    rows = [(hot, "the same text again", "en")] * 3000 + [(hot, t, "de") for t in _texts(1000, 5, 4)]
    rows += [(1000 + i, t, f"x{i}") for i, t in enumerate(_texts(300, 6, 4))]
    model = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_train=60, max_langs=6)
    assert model is not None and max(collected) <= 120
    assert {g for f in model.langs.values() for g in f} <= {"en", "de", *(f"x{i}" for i in range(300))}


def test_language_vote_against_plain_loops():
    """Most pairwise wins, ties by summed margin; the winner's least confidence."""
    from flocklens.llm import language_id as li

    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 5))
    machines = {(a, b): (rng.normal(size=5), rng.normal()) for a in range(4) for b in range(a + 1, 4)}
    best, sure = li._vote(x, machines, 4)
    for k, row in enumerate(x):
        wins, margin, least = [0] * 4, [0.0] * 4, [1.0] * 4
        for (a, b), (w, c) in machines.items():
            m = sum(p * q for p, q in zip(row, w)) + c
            wins[a if m > 0 else b] += 1
            margin[a] += m
            margin[b] -= m
            p = 1 / (1 + np.exp(-4 * m))
            least[a], least[b] = min(least[a], p), min(least[b], 1 - p)
        want = max(range(4), key=lambda i: (wins[i], margin[i]))
        assert best[k] == want and abs(sure[k] - least[want]) < 1e-9


def test_quality_sample_is_bounded(spark, collected):
    from flocklens.llm import quality_fm as q

    docs = [(i % 40, t, 9) for i, t in enumerate(_texts(2000, 7, 5))]
    labels = [(i % 40, i % 2) for i in range(4000)] + [(None, 1), (3, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    assert q.train(docs, labels, max_train=100) is not None
    assert max(collected) <= 80


def test_model_type_is_read(spark, tmp_path):
    """A unigram file (the BPE table, its type changed) is segmented by the best sum
    of scores: never below the library's path, and to the same text."""
    import public_tokenizers as P
    import sentencepiece

    from flocklens.llm import sentencepiece_viterbi as s

    raw = open(P.path("piece_bpe_32k.model"), "rb").read()
    assert s.model_type(raw) == s.BPE and s.model_type(b"") == s.UNIGRAM
    spec = bytes(next(v for n, v in s._fields(memoryview(raw)) if n == s.TRAINER_SPEC))
    kind = bytes([s.MODEL_TYPE << 3, s.BPE])
    at = raw.index(spec) + spec.index(kind)
    path = tmp_path / "unigram.model"
    path.write_bytes(raw[: at + 1] + bytes([s.UNIGRAM]) + raw[at + 2 :])
    assert s.model_type(path.read_bytes()) == s.UNIGRAM
    assert not s.Pieces(str(P.path("piece_bpe_32k.model"))).unigram
    texts = ["hello nation", "the quick brown fox", "été à la mer", "abcab theing", "", "a", None, "日本 \U0001f642"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    pieces = s.Pieces(str(path))

    def score(ids):
        return sum(pieces.score[i] for i in ids)

    for r in s.tokenise(docs, str(path), with_ids=True).collect():
        got, want = np.frombuffer(r.ids, "<u4").tolist(), library.encode(texts[r.doc_id] or "")
        assert score(got) >= score(want) - 1e-3, (texts[r.doc_id], got, want)
        assert library.decode(got) == library.decode(want)
