"""Property tests (hypothesis) of the text functions against plain-Python models."""

import string

from hypothesis import given, settings
from hypothesis import strategies as st

from flocklens.functions import text

DELIMS = set(" \t" + text.INITCAP_DELIMITERS)
ALPHABET = string.ascii_letters[:8] + "éÉß'" + " \t-_.&(" + " "


def py_initcap(s: str) -> str:
    out, start = [], True
    for ch in s:
        out.append((ch.title() if ch == "ß" else ch.upper()) if start else ch)
        start = ch in DELIMS or ch.isspace()
    return "".join(out)


WS = set(text.UNICODE_WHITESPACE)


def py_norm(s: str) -> str:
    i, j = 0, len(s)
    while i < j and s[i] in WS:
        i += 1
    while j > i and s[j - 1] in WS:
        j -= 1
    return s[i:j].lower()


def py_bigrams(s: str) -> set:
    return {s[i:i + 2] for i in range(len(s) - 1)}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=40, max_size=40))
def test_text_functions_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string").select(
        "x",
        text.proper_case("x").alias("cap"),
        text.norm("x").alias("n"),
        text.bigram_set("x").alias("bg"),
    )
    for r in df.collect():
        assert r.cap == py_initcap(r.x), r.x
        assert r.n == py_norm(r.x), r.x
        assert set(r.bg) == py_bigrams(r.x) and len(r.bg) == len(set(r.bg)), r.x
