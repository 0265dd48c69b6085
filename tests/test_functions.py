"""Column functions against hand-written expectations (hazards H7, H8, H12, H21, H22)."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from flocklens.config import HIGH, LOW, MEDIUM, NOT_APPLICABLE
from flocklens.functions import dates, rules, text


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_norm_strips_unicode_whitespace(spark):
    assert one(spark, text.norm("x"), "\t  Foo@Bar.ORG  \n") == "foo@bar.org"
    assert one(spark, text.norm("x"), None) is None


def test_blank_checks(spark):
    rows = [("  ",), (" ",), (None,), (" a ",)]
    df = spark.createDataFrame(rows, "x string").select(text.non_blank("x").alias("nb"))
    assert [r.nb for r in df.collect()] == [False, False, False, True]


def test_proper_case_delimiters(spark):
    cases = {
        "mary-jane o'brien": "Mary-Jane O'brien",
        "st.john (jr) a&b": "St.John (Jr) A&B",
        "élan_vital": "Élan_Vital",
        "x": "X",
        "": "",
        "ann  lee": "Ann  Lee",
        "ßüch-ßa": "Ssüch-Ssa",
    }
    for raw, want in cases.items():
        assert one(spark, text.proper_case(F.col("x")), raw) == want
    assert one(spark, text.proper_case(F.col("x")), None) is None
    assert one(spark, text.display_name("x"), "  MARY-JANE\t") == "Mary-Jane"


def test_digits_only_and_surrogate(spark):
    assert one(spark, text.digits_only("x"), "(212) 555-0100") == "2125550100"
    sid = one(spark, text.surrogate_id("x"), "a@b.org")
    assert sid.startswith("eb_") and len(sid) == 35


def test_bigrams(spark):
    got = one(spark, text.bigram_set("x"), "ab cab")
    assert sorted(got) == sorted({"ab", "b ", " c", "ca"})
    assert one(spark, text.bigram_set("x"), " ") == []
    assert one(spark, text.bigram_set("x"), "aa") == ["aa"]


def test_week_sunday_not_iso(spark):
    d = lambda s: one(spark, dates.week_sunday("x"), dt.date.fromisoformat(s), "x date")
    assert d("2021-01-01") == 0  # Friday before the first Sunday
    assert d("2021-01-03") == 1  # first Sunday
    assert d("2023-01-01") == 1  # year starting on Sunday
    assert d("2020-12-31") == 52


def test_time_bucket_edges(spark):
    rows = [(n,) for n in (-5, 0, 90, 91, 180, 181, 360, 361, 720, 721)]
    df = spark.createDataFrame(rows, "x int").select(dates.time_bucket(F.col("x"), 30).alias("b"))
    got = [r.b[0] for r in df.collect()]
    assert got == list("aaabbccdde")  # edges 90/180/360/720 are inclusive


def test_classify_and_attendance_type(spark):
    names = {"Sunday WORSHIP": "Worship Service", "prayer night": "Prayer", "Bible hour": "Bible Study",
             "study": "Bible Study", "Picnic": "Event", None: "Event"}
    for raw, want in names.items():
        assert one(spark, rules.classify_event("x"), raw) == want
    status = {"Attended": "In-Person", "Attendeed": "In-Person", "Attended  (Online)": "Online",
              "Attended (Online)": "Online", "No Show": "No Show", None: None}
    for raw, want in status.items():
        assert one(spark, rules.attendance_type("x"), raw) == want
    assert one(spark, rules.event_format("x"), None, "x boolean") == "In-Person"
    assert one(spark, rules.event_format("x"), True, "x boolean") == "Online"


def test_hybrid_truth_table(spark):
    levels = [HIGH, MEDIUM, LOW, NOT_APPLICABLE]
    rows = list(itertools.product(levels, levels))
    df = spark.createDataFrame(rows, "r string, s string").select("r", "s", rules.hybrid_flag("r", "s").alias("h"))
    got = {(x.r, x.s): x.h for x in df.collect()}
    for r, s in rows:
        if NOT_APPLICABLE in (r, s):
            want = NOT_APPLICABLE
        elif r == s == HIGH:
            want = HIGH
        elif r == s == LOW:
            want = LOW
        else:
            want = MEDIUM
        assert got[(r, s)] == want, (r, s)


def test_rule_flags(spark):
    rows = [(0.7, 0.5), (0.7, 0.6), (0.5, 0.6), (0.3, 0.1), (0.3, 0.3), (0.8, 0.4), (None, 0.9)]
    df = spark.createDataFrame(rows, "b double, d double").select(rules.rule_flag("b", "d").alias("f"))
    assert [r.f for r in df.collect()] == [HIGH, HIGH, MEDIUM, LOW, NOT_APPLICABLE, NOT_APPLICABLE, NOT_APPLICABLE]


def test_risk_eligible_three_valued(spark):
    rows = [(0.1, None), (0.3, None), (0.1, 0.1), (0.1, 0.5), (0.0, 0.9)]
    df = spark.createDataFrame(rows, "b double, r double").select(rules.risk_eligible("b", "r").alias("e"))
    assert [r.e for r in df.collect()] == [None, True, False, True, False]
