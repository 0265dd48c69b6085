"""Token counts against the tokenizer library and a plain merge loop."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flocklens.llm import rank_merge_counts as rm

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return rm.Counter(rm.Merges(PATH))


def library_counts(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def plain_count(data, merges):
    """Lowest rank first, one pair at a time."""
    s = merges.byte_ids[np.frombuffer(data, np.uint8)].tolist()
    while len(s) > 1:
        ranks = merges.rank(np.array(s[:-1]), np.array(s[1:]))
        k = int(ranks.argmin())
        if ranks[k] == rm.NONE:
            break
        s[k : k + 2] = [int(merges.made[ranks[k]])]
    return len(s)


def test_both_ways_of_merging_equal_the_plain_loop(counter):
    rng = random.Random(1)
    words = [bytes(rng.choice(b"aabthein \xc3\xa9 ") for _ in range(rng.randint(1, 40))) for _ in range(400)]
    words += [b"a" * k for k in range(1, 40)] + [b"ab" * k for k in range(1, 20)] + [b"\xff", b" the" * 30]
    want = [plain_count(w, counter.merges) for w in words]
    sizes = np.array([len(w) for w in words])
    for merge in (rm.surviving, rm.surviving_linked):
        symbols = counter.merges.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        assert merge(symbols, sizes, counter.merges).tolist() == want


def test_counts_of_odd_texts_equal_the_library(counter, library):
    rng = random.Random(2)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30000))
    texts = [
        "", " ", "  ", "\n\n a", "a  \n", "it's we'LL they'll I'm 's'", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|",
        " <|endoftext|> x", " 　x  y\x85z\x1c\x1d q​ ᠎", "été ñ 漢字かな 한국어 ١٢٣ ½ Ⅷ", "🙂👩‍👩‍👧 🏳️‍🌈", letters,
        "a" * 5000, "漢" * 3000, "ab" * 2000 + " " * 700 + "x", "=" * 2000, "\n" * 999 + "b", "word " * 60000, " ".join(f"w{i}é" for i in range(40000)),
    ]
    assert counter.of_texts(texts).tolist() == library_counts(library, texts)


def test_every_code_point_is_cut_as_in_the_library(counter, library):
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"x{c}1 {c}{c} " for c in points[k : k + 16]) for k in range(0, len(points), 16)]
    got, want = counter.of_texts(texts).tolist(), library_counts(library, texts)
    differ = [texts[k] for k in range(len(texts)) if got[k] != want[k]]
    assert not differ, differ[:3]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=("Cs",)), st.sampled_from(" \n'aest<|>")), max_size=60), max_size=6))
def test_any_texts(texts):
    library, counter = Tokenizer.from_file(PATH) if not _cache else _cache[0], rm.Counter(rm.Merges(PATH)) if not _cache else _cache[1]
    _cache[:] = [library, counter]
    assert counter.of_texts(texts).tolist() == library_counts(library, texts)


_cache = []


def test_the_memory_of_known_words_is_bounded(counter, monkeypatch):
    monkeypatch.setattr(rm, "KNOWN", 50)
    for k in range(20):
        counter.of_texts([" ".join(f"k{k}x{j}" for j in range(30))])
        assert len(counter.known) <= 60


def test_table(spark, odd, odd_rows, empty, library):
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in rm.count_tokens(odd, PATH).collect())
    texts = [r[1] or "" for r in odd_rows]
    want = sorted(
        (r[0] is not None, r[0] or 0, len(t.encode()), n, n > 512) for r, t, n in zip(odd_rows, texts, library_counts(library, texts))
    )
    assert got == want
    assert rm.count_tokens(empty, PATH).collect() == []


def test_query(spark, library):
    from flocklens.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = sorted((d.doc_id, len((d.text or "").encode()), n, n > 512) for d, n in zip(docs, library_counts(library, [d.text or "" for d in docs])))
    assert sorted(map(tuple, QUERIES["op11_rank_merge_counts"](spark, sf).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())) == want


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError):
        rm.Merges(str(public_tokenizers.path("word_bpe_49k.json")))
