"""Cross-registry identity resolution: CRM contacts vs ticketing attendees.

Tier 1 (email): a ticket email that is also a CRM email is the same person
and never becomes a candidate. Tier 2 (exact name): lowered/trimmed first and
last name equal; one CRM contact with that name -> ``high`` (merged), several
-> ``ambiguous``. Tier 3 (name similarity): for candidates without an exact
name, the CRM contact with the highest bigram similarity; >= 0.6 ``medium``,
>= 0.4 ``low`` (flagged as possible duplicates, never merged).
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flocklens.config import Settings
from flocklens.functions.rules import similarity_confidence
from flocklens.functions.text import BIGRAM_CODE, full_name_key, non_blank, norm, surrogate_id, utrim
from flocklens.operators.profile import distinct_tuples

RESOLUTION_COLUMNS = ("eb_email", "sf_contact_id", "n_sf_same_name", "name_similarity", "match_confidence")


def crm_emails(tuples: DataFrame) -> DataFrame:
    """Distinct normalised CRM emails, from the contacts' attribute tuples."""
    return tuples.filter(F.col("email").isNotNull()).select(norm("email").alias("email_key")).distinct()


def crm_contacts(profile: DataFrame) -> DataFrame:
    """One row per CRM contact that has a non-NULL first and last name (blank
    names are allowed into matching); the name pair is taken from one row."""
    return profile.filter(F.col("name_pair").isNotNull()).select(
        "contact_id",
        F.col("name_pair")["f"].alias("first_name"),
        F.col("name_pair")["l"].alias("last_name"),
        F.col("named_email").alias("email"),
    )


def valid_attendee_contacts(att_stg: DataFrame, settings: Settings) -> DataFrame:
    """Attendee rows with a usable email and non-blank names (no dedup)."""
    e = F.col("email")
    ok = (
        e.isNotNull()
        & ~utrim(e).isin(*settings.placeholder_emails)
        & e.contains("@")
        & non_blank("first_name")
        & non_blank("last_name")
    )
    return att_stg.filter(ok).select(norm(e).alias("email_key"), "first_name", "last_name", "phone_raw")


def ticket_candidates(valid: DataFrame, emails: DataFrame) -> DataFrame:
    """Valid ticket contacts whose email is not a CRM email, one row per email.
    The name pair is the smallest (first, last) among the email's rows, so
    both names come from the same registration."""
    v = distinct_tuples(valid.join(emails, "email_key", "left_anti"), "email_key", "first_name", "last_name", "phone_raw")
    g = v.groupBy("email_key").agg(
        F.min(F.struct(F.col("first_name").alias("f"), F.col("last_name").alias("l"), F.col("_n").alias("n"))).alias("np"),
        F.min("phone_raw").alias("phone"),
    )
    return g.select("email_key", F.col("np")["f"].alias("first_name"), F.col("np")["l"].alias("last_name"), "phone")


def _name_keys(df: DataFrame) -> DataFrame:
    return df.withColumn("nf", norm("first_name")).withColumn("nl", norm("last_name"))


def crm_name_counts(contacts: DataFrame) -> DataFrame:
    """Per normalised (first, last): number of CRM contacts and the smallest id."""
    return _name_keys(contacts).groupBy("nf", "nl").agg(
        F.count("contact_id").alias("n_sf_same_name"),
        F.min("contact_id").alias("only_contact_id"),
    )


def exact_name_match(candidates: DataFrame, contacts: DataFrame) -> DataFrame:
    """Tier 2, one row per candidate email that has an exact CRM name.

    The count of CRM contacts sharing the name is computed per name key and
    joined many-to-one, so a frequent name never fans out into all
    (email x contact) pairs; the contacts behind an ambiguous match are found
    by its name key (``ambiguous_name_emails``, ``ambiguous_name_contacts``)."""
    c = _name_keys(candidates).join(crm_name_counts(contacts), ["nf", "nl"], "inner")
    n = F.col("n_sf_same_name")
    return c.select(
        F.col("email_key").alias("eb_email"),
        F.when(n == 1, F.col("only_contact_id")).alias("sf_contact_id"),
        n.alias("n_sf_same_name"),
        F.lit(None).cast("double").alias("name_similarity"),
        F.when(n > 1, F.lit("ambiguous")).otherwise(F.lit("high")).alias("match_confidence"),
    )


def _ambiguous_names(candidates: DataFrame, contacts: DataFrame) -> DataFrame:
    several = crm_name_counts(contacts).filter(F.col("n_sf_same_name") > 1).select("nf", "nl")
    return several.join(_name_keys(candidates).select("nf", "nl").distinct(), ["nf", "nl"], "left_semi")


def ambiguous_name_emails(candidates: DataFrame, contacts: DataFrame) -> DataFrame:
    """(email, name key) of the candidates whose name several CRM contacts bear."""
    names = _ambiguous_names(candidates, contacts)
    return _name_keys(candidates).join(names, ["nf", "nl"], "left_semi").select(
        F.col("email_key").alias("eb_email"), F.concat("nf", F.lit(" "), "nl").alias("name_key")
    )


def ambiguous_name_contacts(candidates: DataFrame, contacts: DataFrame) -> DataFrame:
    """(name key, contact) of the CRM contacts behind the ambiguous matches:
    with ``ambiguous_name_emails`` the whole set, not multiplied out."""
    names = _ambiguous_names(candidates, contacts)
    return _name_keys(contacts).join(names, ["nf", "nl"], "left_semi").select(
        F.concat("nf", F.lit(" "), "nl").alias("name_key"), F.col("contact_id").alias("sf_contact_id")
    )


def unresolved_candidates(candidates: DataFrame, contacts: DataFrame) -> DataFrame:
    """Candidates with no exact-name CRM contact (input of tier 3)."""
    keys = _name_keys(contacts).select("nf", "nl").distinct()
    return _name_keys(candidates).join(keys, ["nf", "nl"], "left_anti").drop("nf", "nl")


WORDS = 4  # 64-bit words of a name's bitmap
_BITMAP = ", ".join(f"w{k}" for k in range(WORDS))


def name_signatures(unresolved: DataFrame, contacts: DataFrame, keep=None) -> DataFrame:
    """The distinct normalised names of both sides (``crm`` or not; a CRM name keeps
    its smallest contact id) with their bigrams as numbers, rarest first in one
    global order (bounded by the name's length), and as a bitmap of ``WORDS``
    words. ``slack`` counts the bigrams that share a bit with another of the name.
    ``keep(df, name)`` writes the distinct names, which are read for the order too."""
    name = full_name_key("first_name", "last_name").alias("name")
    both = unresolved.select(F.lit(False).alias("crm"), name, F.lit(None).cast("string").alias("c")).unionByName(
        contacts.select(F.lit(True).alias("crm"), name, F.col("contact_id").alias("c"))
    )
    words = ", ".join(f"bit_or(if(shiftright(spot, 6) & {WORDS - 1} = {k}, shiftleft(1L, CAST(spot & 63 AS INT)), 0L)) AS w{k}" for k in range(WORDS))
    bits = " + ".join(f"bit_count(w{k})" for k in range(WORDS))
    names = both.where("length(name) > 1").groupBy("crm", "name").agg(F.min("c").alias("contact_id"))
    names = keep(names, "distinct_names") if keep else names
    codes = F.expr(f"array_distinct(transform(sequence(1, length(name) - 1), {BIGRAM_CODE}))")
    names = names.withColumn("bg", codes)
    tokens = names.select("crm", "name", "contact_id", F.size("bg").alias("n"), F.explode("bg").alias("tok"))
    freq = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    return both.sparkSession.sql(
        f"""
        SELECT crm, name, contact_id, n, ord, {_BITMAP}, n - ({bits}) AS slack FROM (
            SELECT crm, name, contact_id, n, transform(array_sort(collect_list(struct(df, tok))), x -> x.tok) AS ord, {words}
            FROM (SELECT *, xxhash64(tok) AS spot FROM {{tokens}}) JOIN {{freq}} USING (tok)
            GROUP BY crm, name, contact_id, n)""",
        tokens=tokens,
        freq=freq,
    )


def _keyed(signed: DataFrame, t: Fraction) -> DataFrame:
    """The join keys of each name at threshold t: hashes of all pairs of bigrams
    out of its first n - max(2, ceil(t n)) + 2, and of single ones for names so short
    that one shared bigram can be enough. ``spot`` is the place of the key's last bigram."""
    p, q = t.numerator, t.denominator
    key = lambda j, toks: f"named_struct('key', xxhash64({toks}), 'spot', {j})"
    twos = f"flatten(transform(prefix, (y, j) -> transform(slice(prefix, 1, j), x -> {key('j', 'x, y')})))"
    ones = f"transform(if(n <= {q // p}, ord, array()), (x, i) -> {key('i', 'x')})"
    prefix = f"slice(ord, 1, if(n > 1, n - greatest(2, CAST((n * {p}L + {q - 1}) DIV {q} AS INT)) + 2, 0))"
    rest = ["name", "contact_id", "n", "slack", *(f"w{k}" for k in range(WORDS))]
    return signed.withColumn("prefix", F.expr(prefix)).selectExpr(f"inline(concat({ones}, {twos}))", *rest)


def candidate_pairs(left: DataFrame, right: DataFrame, t: Fraction, settings: Settings, what: str = "*") -> DataFrame:
    """``what`` of the names that share a key at threshold t.

    The rows of the largest key are counted first. Where one side of a key has
    more than ``rows_per_cell``, keys are split on both sides into square cells of
    at most about that many rows a side, whatever the key's size, and keys of one
    side only go no further; else the join is plain. Either is dealt over all
    shuffle partitions: small key rows join into many more rows than they are."""
    spark = left.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ["spot", "name", "contact_id", "n", "slack", *(f"w{k}" for k in range(WORDS))]
    keys = {"lkey": _keyed(left, t), "rkey": _keyed(right, t)}
    load = """SELECT key, sum(l) AS nl, sum(r) AS nr
        FROM (SELECT key, 1 AS l, 0 AS r FROM {lkey} UNION ALL SELECT key, 0, 1 FROM {rkey})
        GROUP BY key HAVING sum(l) > 0 AND sum(r) > 0"""
    named = lambda side: ", ".join(f"{c} AS {c}_{side}" for c in columns)
    most = spark.sql(f"SELECT max(greatest(nl, nr)) FROM ({load})", **keys).first()[0]
    if (most or 0) <= settings.rows_per_cell:
        plain = f"SELECT {what} FROM (SELECT key, {named('e')} FROM {{lkey}}) JOIN (SELECT key, {named('s')} FROM {{rkey}}) USING (key)"
        return spark.sql(plain, **{side: rows.repartition(parts, "key") for side, rows in keys.items()})
    keys["load"] = spark.sql(load, **keys)

    def dealt(side: str, of: str, cells: str) -> DataFrame:
        split = spark.sql(f"SELECT * EXCEPT (nl, nr), {cells} FROM {{{of}}} JOIN {{load}} USING (key)", **{of: keys[of], "load": keys["load"]})
        return split.selectExpr("key", "cl", "cr", *[f"{c} AS {c}_{side}" for c in columns]).repartition(parts, "key", "cl", "cr")

    cells = lambda of: f"CAST(ceil({of} / {settings.rows_per_cell}) AS INT)"
    own = lambda of: f"CAST(pmod(xxhash64(name), {cells(of)}) AS INT)"
    every = lambda of: f"explode(sequence(0, {cells(of)} - 1))"
    home = dealt("e", "lkey", f"{own('nl')} AS cl, {every('nr')} AS cr")
    away = dealt("s", "rkey", f"{every('nl')} AS cl, {own('nr')} AS cr")
    return spark.sql(f"SELECT {what} FROM {{home}} JOIN {{away}} USING (key, cl, cr)", home=home, away=away)


def _best_at(left: DataFrame, right: DataFrame, t: Fraction, settings: Settings) -> DataFrame:
    """The best match of each name of ``left`` that has one of similarity >= t.

    On the joined row, cheapest first: the sizes; the overlap that is still
    possible behind the places of the shared key (a pair's first two common
    bigrams pass, so dropping its later keys loses nothing); the overlap that the
    bitmaps leave possible. The exact overlap is computed once per remaining pair;
    its condition refers to the pair's count, or Catalyst would push it below the
    aggregate and onto every joined row."""
    enough = lambda overlap: f"({overlap}) * {t.denominator}L >= g * {t.numerator}L"
    bits = " + ".join(f"bit_count(w{k}_e & w{k}_s)" for k in range(WORDS))
    codes = lambda c: f"transform(sequence(1, length({c}) - 1), {BIGRAM_CODE.replace('name', c)})"
    j = candidate_pairs(left, right, t, settings, "*, greatest(n_e, n_s) AS g")
    return left.sparkSession.sql(
        f"""
        WITH pair AS (
            SELECT name_e, name_s, contact_id_s, n_e, n_s, g, count(*) AS _n FROM {{j}}
            WHERE {enough('least(n_e, n_s)')} AND {enough('least(n_e - spot_e, n_s - spot_s) + 1')}
              AND {enough(f'{bits} + least(slack_e, slack_s)')}
            GROUP BY name_e, name_s, contact_id_s, n_e, n_s, g),
        scored AS (SELECT *, size(array_intersect({codes('name_e')}, {codes('name_s')})) AS shared FROM pair),
        best AS (
            SELECT name_e, min(struct(-shared / g AS k, contact_id_s AS c, shared, n_e, n_s, shared / g AS sim, name_s AS m)) AS b
            FROM scored WHERE {enough('shared * least(_n, 1)')} GROUP BY name_e)
        SELECT name_e AS eb_name, b.m AS sf_name, b.c AS sf_contact_id, CAST(b.shared AS BIGINT) AS shared_bigrams,
               CAST(b.n_e AS BIGINT) AS eb_bigram_count, CAST(b.n_s AS BIGINT) AS sf_bigram_count, b.sim AS similarity
        FROM best""",
        j=j,
    )


def falling_thresholds(settings: Settings, tenths: bool = False) -> list[Fraction]:
    """The thresholds of the rounds, down to the low one; with ``tenths`` also at
    every tenth."""
    exact = lambda x: Fraction(str(x)).limit_denominator(10**6)
    low = exact(settings.similarity_low)
    if not (0 < low <= 1):
        raise ValueError("similarity threshold must be in (0, 1]")
    rounds = {*map(exact, settings.similarity_rounds), *(Fraction(k, 10) for k in range(1, 10) if tenths)}
    return [t for t in sorted(rounds, reverse=True) if low < t <= 1] + [low]


def best_name_matches(unresolved: DataFrame, contacts: DataFrame, settings: Settings, keep=None) -> DataFrame:
    """For each distinct ticket name the CRM name with the highest bigram
    similarity ``|A & B| / max(|A|, |B|, 1)`` of at least the low threshold; ties
    go to the smallest contact id. One row per ticket name, never the pairs.

    An exact top-1 search with a falling bound. The round at threshold t finds
    every pair of similarity >= t, so a name that has one has its best match and
    leaves; the next round, at a lower threshold and with longer prefixes, sees
    only the names that have none so far. Names at or above t share at least
    k = ceil(t n) bigrams, so in one global rarest-first order they share two
    within the first n - k + 2 of each (Bayardo et al. 2007, taken for two
    tokens): those pairs are the join keys. Key rows hold numbers and the name,
    no arrays.

    ``keep(df, name)`` writes what several rounds read. With it the bound falls by
    a tenth: a name has few others just below its best one and many far below, and
    a round scores all at or above its threshold. The rounds end with the names
    left. Without it every round would compute the ones before, so there are only
    those of the settings."""
    written = keep is not None
    keep = keep or (lambda df, name: df)
    signed = keep(name_signatures(unresolved, contacts, keep if written else None), "names")
    left, right, found = signed.where("NOT crm"), signed.where("crm"), []
    *before, low = falling_thresholds(settings, tenths=written)
    for k, t in enumerate(before):
        found.append(keep(_best_at(left, right, t, settings), f"name_matches_{k}"))
        left = left.join(found[-1].select(F.col("eb_name").alias("name")), "name", "left_anti")
        if written:
            left = keep(left, f"names_left_{k}")
            if left.isEmpty():
                return reduce(DataFrame.unionByName, found)
    return reduce(DataFrame.unionByName, [*found, _best_at(left, right, low, settings)])


def round_half_up_ratio(num, den, places: int = 2):
    """``round(num/den, places)`` with exact half-up on the rational value."""
    scale = 10**places
    return F.floor((F.lit(2 * scale) * num + den) / (F.lit(2) * den)) / F.lit(float(scale))


def best_similar_name(unresolved: DataFrame, matches: DataFrame, settings: Settings) -> DataFrame:
    """Tier 3: per candidate email the best CRM match of its name, with the
    rounded similarity and its confidence."""
    m = matches.withColumn("g", F.greatest("eb_bigram_count", "sf_bigram_count", F.lit(1)))
    j = unresolved.withColumn("eb_name", full_name_key("first_name", "last_name")).join(m, "eb_name", "inner")
    return j.select(
        F.col("email_key").alias("eb_email"),
        "sf_contact_id",
        F.lit(1).cast("long").alias("n_sf_same_name"),
        round_half_up_ratio(F.col("shared_bigrams"), F.col("g")).alias("name_similarity"),
        similarity_confidence(F.col("similarity"), settings.similarity_medium, settings.similarity_low).alias(
            "match_confidence"
        ),
    )


def name_resolution(tier2: DataFrame, tier3: DataFrame) -> DataFrame:
    """Tier 2 and tier 3 together: at most one row per candidate email."""
    return tier2.select(*RESOLUTION_COLUMNS).unionByName(tier3.select(*RESOLUTION_COLUMNS))


def high_confidence_matches(resolution: DataFrame) -> DataFrame:
    return resolution.filter(F.col("match_confidence") == "high").select("sf_contact_id", "eb_email")


def flagged_matches(resolution: DataFrame) -> DataFrame:
    """Medium/low single-contact matches: possible duplicates, never merged."""
    return resolution.filter(
        F.col("match_confidence").isin("medium", "low") & (F.col("n_sf_same_name") == 1)
    ).select("sf_contact_id", surrogate_id("eb_email").alias("eb_contact_id"), "name_similarity")
