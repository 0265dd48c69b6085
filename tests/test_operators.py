"""Operators on hand-built rows: hazards the driver tables do not reach."""

import datetime as dt
import random
import tempfile

import pytest
from flocklens.config import Settings
from flocklens.operators import identity, profile, risk, ticketing
from flocklens.operators.staging import EVENT_DETAIL_COLUMNS

AS_OF = dt.date(2024, 3, 31)
S = Settings(as_of=AS_OF, risk_period_days=30)


def detail(spark, rows):
    """rows: dicts with a subset of the detail columns; others NULL."""
    schema = ", ".join(
        f"{c} {'date' if c == 'event_date' else 'boolean' if c in ('opted_out_of_email', 'attendance_indicator') else 'double' if c in ('budget', 'cost', 'expected_revenue') else 'string'}"
        for c in EVENT_DETAIL_COLUMNS
    )
    data = [tuple(r.get(c) for c in EVENT_DETAIL_COLUMNS) for r in rows]
    return spark.createDataFrame(data, schema)


def w(contact, day, **kw):
    base = {"contact_id": contact, "event_date": day, "type": "Worship Service", "participant_type": "Elder",
            "first_name": "Ann", "last_name": "Lee", "event_id": f"e{day}", "attendance_type": "In-Person"}
    base.update(kw)
    return base


def contact_profile(ed, settings):
    return profile.contact_profile(profile.contact_days(ed, settings), profile.contact_tuples(ed), settings)


def test_future_events_count_as_recent(spark):
    rows = [w("c1", AS_OF + dt.timedelta(days=10)), w("c1", AS_OF - dt.timedelta(days=100))]
    ed = detail(spark, rows)
    pd_ = risk.period_event_days(ed, S).first()
    assert (pd_.recent_worship, pd_.baseline_worship) == (1, 1)
    p = contact_profile(ed, S).first()
    assert (p.recent_attendance, p.baseline_attendance) == (1, 1)


def test_profile_duplicates_and_null_contact(spark):
    d = AS_OF - dt.timedelta(days=3)
    rows = [w("c1", d), w("c1", d), w(None, d), w(None, None), w("c2", None, type="Prayer")]
    prof = {r.contact_id: r for r in contact_profile(detail(spark, rows), S).collect()}
    assert set(prof) == {"c1", None, "c2"}
    assert prof["c1"].recent_attendance == 1 and prof["c1"].worship_days == 1
    assert prof[None].worship_days == 1 and prof[None].has_worship == 1
    assert prof["c2"].has_worship == 0 and prof["c2"].first_crm_event_date is None


def test_latest_participant_type_and_blank_names(spark):
    d1, d2 = AS_OF - dt.timedelta(days=5), AS_OF - dt.timedelta(days=1)
    rows = [w("c1", d1, participant_type="Guest", first_name="  "), w("c1", d2, participant_type="Deacon"),
            w("c1", d2, participant_type=None, first_name="Bea"), w("c1", None, participant_type="Zed")]
    p = contact_profile(detail(spark, rows), S).first()
    assert p.participant_type == "Deacon"
    assert p.first_pick == "Ann"  # smallest non-blank


def test_dedup_attendees_order(spark):
    rows = [("10", "1", "a@x.org", None), ("9", "1", "a@x.org", False), ("2", "1", "A@x.org ", True),
            ("3", "1", None, False), ("4", "1", None, None), ("11", "2", "a@x.org", None)]
    att = spark.createDataFrame(rows, "eventbrite_attendee_id string, eventbrite_event_id string, email string, checked_in boolean")
    got = sorted((r.eventbrite_event_id, r.eventbrite_attendee_id) for r in ticketing.dedup_attendees(att).collect())
    # checked-in first; else smallest id as a string ("10" < "9"); NULL emails collapse per event
    assert got == [("1", "2"), ("1", "3"), ("2", "11")]


def test_email_to_contact_latest(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    rows = [{"email": " A@x.org", "contact_id": "c1", "event_date": d1},
            {"email": "a@x.org", "contact_id": "c2", "event_date": d2},
            {"email": "a@x.org", "contact_id": "c0", "event_date": None},
            {"email": "b@x.org", "contact_id": "c3", "event_date": None}]
    got = {r.email: r.contact_id for r in ticketing.email_to_contact(detail(spark, rows)).collect()}
    assert got == {"a@x.org": "c2", "b@x.org": "c3"}


def _brute_best(eb, sf, low):
    """{ticket name: (similarity, smallest contact id)} over all pairs of names."""

    def grams(s):
        return {s[i:i + 2] for i in range(len(s) - 1)}

    out = {}
    for ef, el in eb.values():
        name = f"{ef.strip().lower()} {el.strip().lower()}"
        a = grams(name)
        scored = []
        for c, (cf, cl) in sf.items():
            b = grams(f"{cf.strip().lower()} {cl.strip().lower()}")
            s = len(a & b) / max(len(a), len(b), 1)
            if s >= low:
                scored.append((-s, c))
        if scored:
            out[name] = (-min(scored)[0], min(scored)[1])
    return out


def test_best_name_matches_equal_brute_force(spark):
    rnd = random.Random(7)
    alphabet = "aeiounrst"

    def name():
        return "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 7)))

    eb = {f"e{i}@x.org": (name(), name()) for i in range(120)}
    eb["tiny@x.org"] = ("", "")
    sf = {f"c{i}": (name(), name()) for i in range(90)}
    sf["c_blank"] = ("", "")
    sf["c_two"] = ("", "a")
    unresolved = spark.createDataFrame([(k, f, l) for k, (f, l) in eb.items()], "email_key string, first_name string, last_name string")
    contacts = spark.createDataFrame([(k, f, l, None) for k, (f, l) in sf.items()], "contact_id string, first_name string, last_name string, email string")
    for low, cell in ((0.4, 2000), (0.25, 2000), (0.6, 2000), (0.4, 3), (0.25, 1)):
        # small cells split every key on both sides
        st = Settings(as_of=AS_OF, similarity_low=low, rows_per_cell=cell)
        got = {r.eb_name: (r.similarity, r.sf_contact_id) for r in identity.best_name_matches(unresolved, contacts, st).collect()}
        want = _brute_best(eb, sf, low)
        assert got.keys() == want.keys(), (low, cell)
        assert all(abs(got[k][0] - want[k][0]) < 1e-12 and got[k][1] == want[k][1] for k in want), (low, cell)


def test_best_name_matches_fall_by_tenths(spark, tmp_path):
    """With written rounds the bound falls by a tenth, and the rounds end when
    every name has its match."""
    from flocklens.plans.materialize import write_table

    rnd = random.Random(11)
    word = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    sf = {f"c{i}": (word(6), word(9)) for i in range(60)}
    near = {f"e{i}": (f, last + "x") for i, (f, last) in enumerate(list(sf.values())[:20])}
    far = {f"f{i}": (word(5), word(5)) for i in range(40)}
    contacts = spark.createDataFrame([(k, f, l, None) for k, (f, l) in sf.items()], "contact_id string, first_name string, last_name string, email string")
    for eb in (near, near | far):
        written = []

        def keep(df, name):
            written.append(name)
            return write_table(df, f"{tmp_path}/{len(eb)}/{name}")

        unresolved = spark.createDataFrame([(k, f, l) for k, (f, l) in eb.items()], "email_key string, first_name string, last_name string")
        st = Settings(as_of=AS_OF, similarity_low=0.25)
        got = {r.eb_name: (r.similarity, r.sf_contact_id) for r in identity.best_name_matches(unresolved, contacts, st, keep).collect()}
        want = _brute_best(eb, sf, 0.25)
        assert got.keys() == want.keys()
        assert all(abs(got[k][0] - want[k][0]) < 1e-12 and got[k][1] == want[k][1] for k in want)
        rounds = [n for n in written if n.startswith("name_matches")]
        assert len(rounds) == (1 if eb is near else 7), rounds


def test_registries_are_written_when_read(spark):
    from flocklens.sources.fixture import WrittenSources
    from flocklens.sources.schemas import CONTRACTS

    written, lost = [], ["campaign"]

    class Derived:
        def __getattr__(self, name):
            written.append(name)
            if name in lost:
                return spark.range(1).selectExpr("CAST(raise_error('lost') AS STRING) AS Id")
            return spark.createDataFrame([], CONTRACTS[name])

    sources = WrittenSources(spark, Derived(), tempfile.mkdtemp(prefix="flocklens-test-"))
    assert not written
    with pytest.raises(Exception, match="lost"):
        sources.campaign
    lost.clear(), written.clear()
    assert sources.campaign.schema == CONTRACTS["campaign"] and sources.campaign.count() == 0
    assert written == ["campaign"] and not hasattr(sources, "no_such_registry")


def test_best_similar_name_rounding(spark):
    rows = [("ann lee", "c1", 3, 5, 5, 0.6), ("bo kim", "c9", 13, 20, 20, 0.65)]
    m = spark.createDataFrame(rows, "eb_name string, sf_contact_id string, shared_bigrams long, eb_bigram_count long, sf_bigram_count long, similarity double")
    un = spark.createDataFrame([("e1", "Ann ", "LEE"), ("e2", "Bo", "Kim"), ("e3", "No", "One")], "email_key string, first_name string, last_name string")
    got = {r.eb_email: (r.sf_contact_id, r.name_similarity, r.match_confidence) for r in identity.best_similar_name(un, m, S).collect()}
    assert got == {"e1": ("c1", 0.6, "medium"), "e2": ("c9", 0.65, "medium")}


def test_exact_name_match_counts(spark):
    cands = spark.createDataFrame([("a@x", "Ann", "Lee", None), ("b@x", "bo", "KIM", None), ("c@x", "Zed", "Q", None)],
                                  "email_key string, first_name string, last_name string, phone string")
    contacts = spark.createDataFrame([("c1", " ann", "lee", None), ("c2", "Bo", "Kim", None), ("c3", "BO", "kim ", None)],
                                     "contact_id string, first_name string, last_name string, email string")
    got = {r.eb_email: (r.sf_contact_id, r.n_sf_same_name, r.match_confidence)
           for r in identity.exact_name_match(cands, contacts).collect()}
    assert got == {"a@x": ("c1", 1, "high"), "b@x": (None, 2, "ambiguous")}
    assert [tuple(r) for r in identity.ambiguous_name_emails(cands, contacts).collect()] == [("b@x", "bo kim")]
    assert sorted(tuple(r) for r in identity.ambiguous_name_contacts(cands, contacts).collect()) == [("bo kim", "c2"), ("bo kim", "c3")]
    un = [r.email_key for r in identity.unresolved_candidates(cands, contacts).collect()]
    assert un == ["c@x"]


def test_publish_switches_whole_sets(spark, tmp_path):
    from flocklens.plans import sinks
    from flocklens.plans.catalog import fixture_build

    root = str(tmp_path)
    b = fixture_build(spark, "/root/testdata/sf0.001", shared=False)
    assert sinks.published(spark, root) == {}
    models = {"fact_attendance", "dim_dates", "ticket_attendance"}
    first = sinks.publish(b, root, models=models)
    assert sinks.published(spark, root) == first and set(first) == {
        "fact_attendance", "dim_dates", "stg_ticket_attendees", "stg_ticket_events", "event_detail"}
    fact = spark.read.parquet(first["fact_attendance"])
    assert fact.count() == b.fact_attendance.count()
    assert {r[0][:2] for r in fact.select("time_bucket").distinct().collect()} <= {"a.", "b.", "c.", "d.", "e."}
    with pytest.raises(ValueError, match="no_such_model"):
        sinks.publish(b, root, models={"no_such_model"})

    # a run that dies half-way: the old set stays whole, the dead run's folder goes
    class Dying:
        spark = b.spark
        dim_dates = b.dim_dates

        @property
        def fact_attendance(self):
            raise OSError("lost")

    with pytest.raises(OSError):
        sinks.publish(Dying(), root, models={"dim_dates", "fact_attendance"})
    assert sinks.published(spark, root) == first
    assert spark.read.parquet(first["fact_attendance"]).count() == fact.count()
    assert len(list((tmp_path / "_versions").iterdir())) == 1
    # another run took the number meanwhile
    with pytest.raises(RuntimeError, match="meanwhile"):
        sinks._switch(spark, root, 1, {})
    # a partial run keeps the rest of the set; old folders go only once nothing current holds them
    second = sinks.publish(b, root, models={"dim_dates"})
    assert {k for k in first if first[k] != second[k]} == {"dim_dates"}
    sinks.expire(spark, root, keep=1)
    assert sinks.published(spark, root) == second and spark.read.parquet(second["fact_attendance"]).count() == fact.count()
    b.close()


def test_published_view_is_evaluated_at_read(spark, tmp_path):
    from flocklens.plans import sinks
    from flocklens.plans.catalog import fixture_build

    b = fixture_build(spark, "/root/testdata/sf0.001", shared=False)
    sinks.publish(b, str(tmp_path), models={"ticket_attendance"})
    other = spark.newSession()
    rows = lambda df: sorted(map(repr, (tuple(r) for r in df.select(*b.ticket_attendance.columns).collect())))
    assert rows(other.table("ticket_attendance")) == rows(b.ticket_attendance)
    # less input: the view of the other session shows it, though only a table was published
    b.stg_attendees = b.stg_attendees.where("eventbrite_attendee_id < '5'")
    sinks.publish(b, str(tmp_path), models={"stg_ticket_attendees"})
    del b.ticket_attendance
    assert 0 < len(rows(other.table("ticket_attendance"))) and rows(other.table("ticket_attendance")) == rows(b.ticket_attendance)
    b.close()


def test_exact_rate_statistics(spark):
    from flocklens.operators import risk

    def build(attended, worship, parts):
        p = spark.createDataFrame([(f"c{i}", 1, a, 1) for i, a in enumerate(attended)], "contact_id string, has_member_worship int, recent_attendance long, baseline_attendance long")
        days = spark.createDataFrame([(worship, 3)], "recent_worship long, baseline_worship long")
        p = p.repartition(parts)
        stats = risk.rate_stats(p, days)
        flags = p.select("recent_attendance", risk.statistical_risk("recent_attendance", stats).alias("f")).distinct()
        return stats.first(), {r.recent_attendance: r.f for r in flags.collect()}

    # mean 2, sample deviation 1: attendance 1 is a z of exactly -1
    stats, flags = build([1, 2, 3], 7, 1)
    assert flags == {1: "High", 2: "Low", 3: "Low"} and stats.mean_recent == 2 / 7 and stats.sd_recent == 1 / 7
    _, flags = build([3, 13, 1, 7, 1, 3], 7, 3)
    want = {}
    import statistics
    from fractions import Fraction

    rows = [3, 13, 1, 7, 1, 3]
    mean, var = Fraction(sum(rows), 6), statistics.variance(map(Fraction, rows))
    for a in rows:
        z2, low = (a - mean) ** 2, a < mean
        want[a] = "High" if low and z2 >= var else "Medium" if low and 4 * z2 >= var else "Low"
    assert flags == want
    rnd = random.Random(3)
    rows = [rnd.randint(0, 13) for _ in range(500)]
    assert len({tuple(build(rows, 13, k)[0]) for k in (1, 3, 8)}) == 1
    # large counts stay exact; no spread, no rate or one contact: not applicable
    stats, flags = build([10**9, 10**9 + 1, 10**9 + 2], 10**9, 2)
    assert flags == {10**9: "High", 10**9 + 1: "Low", 10**9 + 2: "Low"}
    for rows, worship in (([2, 2, 2], 5), ([1, 2, 3], 0), ([4], 5)):
        assert set(build(rows, worship, 1)[1].values()) == {"Not Applicable"}


def test_missing_contract_column_is_an_error(spark, tmp_path):
    from flocklens.sources.raw import read_table

    spark.range(3).select("id").write.parquet(str(tmp_path / "ticket_order"))
    with pytest.raises(ValueError, match="owner_email"):
        read_table(spark, str(tmp_path / "ticket_order"), "ticket_order")


def test_event_detail_is_distinct(spark):
    from flocklens.operators import staging
    from flocklens.plans.catalog import fixture_build

    b = fixture_build(spark, "/root/testdata/sf0.001")
    twice = staging.event_detail(b.src.campaign.unionByName(b.src.campaign), b.src.campaign_member.unionByName(b.src.campaign_member))
    assert twice.count() == twice.distinct().count() == b.ed_rows.distinct().count()


def test_no_crm_id_looks_like_a_surrogate(spark):
    from flocklens.operators.quality import surrogate_clashes
    from flocklens.plans.catalog import fixture_build

    ids = spark.createDataFrame([("eb_1",), ("C1",)], "contact_id string")
    assert [r.contact_id for r in surrogate_clashes(ids).collect()] == ["eb_1"]
    assert surrogate_clashes(fixture_build(spark, "/root/testdata/sf0.001").crm_members).count() == 0


def test_data_quality_checks_find_failures(spark):
    from flocklens.operators import quality

    ev = spark.createDataFrame([("1", "A", AS_OF), ("1", None, AS_OF), (None, "C", None)],
                               "eventbrite_event_id string, event_name string, event_date date")
    att = spark.createDataFrame([("10", "a@x"), ("10", None), ("11", None)], "eventbrite_attendee_id string, email string")
    orders = spark.createDataFrame([("5", "o@x"), ("6", "p@x")], "eventbrite_order_id string, email string")
    uniq = {(r.relation, r.value, r.n_rows) for r in quality.dq_unique_violations(ev, att, orders).collect()}
    assert uniq == {("stg_ticket_events", "1", 2), ("stg_ticket_attendees", "10", 2)}
    nn = sorted((r.relation, r.column_name, r.row_key) for r in quality.dq_not_null_violations(ev, att, orders).collect())
    assert nn == [("stg_ticket_attendees", "email", "10"), ("stg_ticket_attendees", "email", "11"),
                  ("stg_ticket_events", "event_date", None), ("stg_ticket_events", "event_name", "1"),
                  ("stg_ticket_events", "eventbrite_event_id", None)]
    summary = {(r.relation, r.column_name, r.test): r.failures for r in quality.dq_summary(ev, att, orders).collect()}
    assert len(summary) == 10
    assert summary[("stg_ticket_events", "eventbrite_event_id", "unique")] == 1
    assert summary[("stg_ticket_events", "eventbrite_event_id", "not_null")] == 1
    assert summary[("stg_ticket_events", "event_name", "not_null")] == 1
    assert summary[("stg_ticket_attendees", "email", "not_null")] == 2
    assert summary[("stg_ticket_orders", "eventbrite_order_id", "unique")] == 0


def test_job_entry_runs_on_parquet_registries(spark, tmp_path):
    """The batch job reads the five registries as Parquet tables, like production."""
    from flocklens.__main__ import main
    from flocklens.sources.fixture import derive_sources

    src = derive_sources(spark, "/root/testdata/sf0.001")
    for name in ("campaign", "campaign_member", "ticket_event", "ticket_attendee", "ticket_order"):
        getattr(src, name).write.mode("overwrite").parquet(str(tmp_path / "raw" / name))
    out = main(["--sources", str(tmp_path / "raw"), "--out", str(tmp_path / "wh"), "--as-of", "2024-01-31",
                "--risk-period-days", "3", "--bucket-period-days", "1", "--models", "fact_attendance", "dim_members"])
    assert set(out) == {"fact_attendance", "dim_members"}
    assert spark.read.parquet(out["fact_attendance"]).count() > 0
    dm = spark.read.parquet(out["dim_members"])
    assert dm.count() == dm.select("contact_id").distinct().count()
