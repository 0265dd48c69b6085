"""DuckDB SQL for every registered query, written from the operators' definitions.

The library aggregates flat rows in stages; here each person is one row that
holds the list of all its visits (or registrations), and every figure is a list
expression over it. Name similarity is scored for every pair of distinct names.
Constants, calendar, title case and white-space rules are stated here on their
own. The driver tables are mapped to the raw registries by the rules of
FIXTURES.md, as in ``flocklens.sources.fixture``.
"""

from __future__ import annotations

# -- fixed values ----------------------------------------------------------------
TODAY = "DATE '2024-01-31'"
RATE_STEP, BUCKET_STEP, CALENDAR_STEP = 3, 1, 30
BUCKETS = "['a. Months 0 - 3', 'b. Months 4 - 6', 'c. Months 7 - 12', 'd. Months 13 - 24', 'e. Months 25+']"
ROLES = "['Homer', 'Elder', 'Ecclesia', 'Deacon']"
PLACEHOLDERS = "['info requested', '', 'n/a', 'none']"
FIRST = "['Anna', 'Ben', 'Mary-Jane', 'José', 'zoë', ' Ivan', 'Ruth', 'O''NEIL', 'Li', 'peter', 'Sofia' || chr(160), 'Omar']"
STEMS = "['Ander', 'Berg', 'Carl', 'Dahl', 'Eriks', 'Fischer', 'Gold', 'Hart']"
ENDINGS = "['son', 'man', 'ton', 'ley', 'well', 'ford', 'er', 's', 'ßen', '-Ruiz']"
_SPACE = r"[\x09-\x0d\x20\x{85}\pZ]+"
_BREAKS = r"""' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160) || chr(8195) || chr(12288) || '[](){}/|\<>!?@"^#$&~_,.:;*%+-'"""


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}|{_SPACE}$', '', 'g')"


def key(x: str) -> str:
    return f"lower({strip(x)})"


def titled(x: str) -> str:
    """Each character that begins the text or follows a break, in title case."""
    s = key(x)
    return (
        f"CASE WHEN {x} IS NOT NULL THEN array_to_string(list_transform(range(1, length({s}) + 1), lambda i: "
        f"CASE WHEN i > 1 AND NOT contains({_BREAKS}, substr({s}, i - 1, 1)) THEN substr({s}, i, 1) "
        f"WHEN substr({s}, i, 1) = 'ß' THEN 'Ss' ELSE upper(substr({s}, i, 1)) END), '') END"
    )


def days_ago(x: str) -> str:
    return f"({TODAY} - {x})"


def bucket_of(day: str, step: int) -> str:
    """The label after as many edges (3, 6, 12, 24 steps) as the age passes."""
    return (
        f"{BUCKETS}[1 + len([edge FOR edge IN [3, 6, 12, 24] IF {days_ago(day)} > edge * {step}])]"
    )


def calendar(step: int) -> str:
    return f"""SELECT day AS date, dayofweek(day) + 1 AS day_of_week,
        (dayofyear(day) + 6 - dayofweek(day)) // 7 AS week, month(day) AS month, quarter(day) AS quarter,
        year(day) AS year, {bucket_of('day', step)} AS time_bucket
      FROM (SELECT CAST(unnest(generate_series(DATE '2020-01-01', least({TODAY}, DATE '2069-12-19'), INTERVAL 1 DAY)) AS DATE) AS day)"""


def dates_cte(name: str, step: int, today: str = TODAY) -> str:
    """The date dimension as a CTE (for tests)."""
    return f"{name} AS ({calendar(step).replace(TODAY, today)})"


def status_kind(x: str) -> str:
    return (
        f"coalesce(map {{'Attended': 'In-Person', 'Attendeed': 'In-Person', 'Attended Online': 'Online', "
        f"'Attended (Online)': 'Online', 'Attended  (Online)': 'Online'}}[{x}], {x})"
    )


def grams(x: str) -> str:
    """Distinct pairs of neighbouring characters."""
    return f"list_distinct([substr({x}, i, 2) FOR i IN range(1, length({x}))])"


# -- the registries, from the driver tables ----------------------------------------
REGISTRIES = {
    "drawn_name": f"""
      SELECT doc_id, {FIRST}[1 + d[1] % 12] AS given,
             {STEMS}[1 + d[2] % 8] || {ENDINGS}[1 + d[3] % 10]
               || CASE WHEN d[4] % 3 = 0 THEN '-' || {STEMS}[1 + d[5] % 8] || CAST(d[6] % 9 AS VARCHAR) ELSE '' END AS family
      FROM (SELECT doc_id, [CAST('0x' || substr(md5(coalesce(text, '')), 1 + 4 * k, 4) AS INTEGER) FOR k IN range(0, 6)] AS d
            FROM documents)""",
    "placed": """
      SELECT event_id, user_id, day, half, kind, kind || '-' || CAST(day AS VARCHAR) || '-' || half AS slot
      FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS day, CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS half,
                   CASE WHEN user_id % 5 = 0 AND ts >= TIMESTAMP '2024-01-22' AND event_id % 4 > 0 THEN 'outing'
                        WHEN user_id % 5 = 1 AND ts < TIMESTAMP '2024-01-22' AND event_id % 3 > 0 THEN 'outing'
                        WHEN user_id % 5 = 2 AND event_id % 8 > 0 THEN 'outing' ELSE event_type END AS kind
            FROM events)""",
    "campaign": """
      SELECT slot AS Id, kind || ' service ' || CAST(day AS VARCHAR) || ' ' || half AS Name,
             CASE WHEN day(day) % 7 > 0 THEN 'Slot ' || slot END AS Description,
             CASE kind WHEN 'signup' THEN 'Prayer' WHEN 'view' THEN 'Worship Service' WHEN 'click' THEN 'Worship Service'
                       WHEN 'purchase' THEN 'Worship Service' ELSE 'Event' END AS Type,
             if(kind = 'click', 'Online', 'In-Person') AS Format__c, day AS EndDate,
             if(half = 'am', '09:30 AM', '11:30 AM') AS Service_Time__c,
             CAST(10 * day(day) AS DOUBLE) AS BudgetedCost,
             CASE WHEN day(day) % 5 > 0 THEN CAST(7.5 * day(day) AS DOUBLE) END AS ActualCost,
             CAST(if(half = 'am', 100, 250) AS DOUBLE) AS ExpectedRevenue
      FROM placed GROUP BY ALL""",
    "campaign_member": """
      SELECT slot AS CampaignId, 'C' || user_id AS ContactId,
             if(user_id % 4 = 1, substr(trim(given), 1, 3) || '.', given) AS FirstName,
             CASE user_id % 4 WHEN 2 THEN family || 'e' WHEN 3 THEN reverse(family) ELSE family END AS LastName,
             ['Mr.', 'Ms.', NULL][1 + user_id % 3] AS Salutation,
             if(user_id % 9 > 0, '555-' || lpad(CAST(user_id % 10000 AS VARCHAR), 4, '0'), NULL) AS Phone,
             if(user_id % 2 > 0, '555-7' || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0'), NULL) AS MobilePhone,
             CASE WHEN user_id % 7 = 0 THEN NULL WHEN user_id % 11 = 10 THEN 'User' || (user_id - 1) || '@Example.org'
                  ELSE chr(8195) || 'User' || user_id || '@Example.org' || chr(160) END AS Email,
             CAST(NULL AS VARCHAR) AS Fax, 'US' AS Country, ['NY', 'NJ', 'CT', 'PA'][1 + user_id % 4] AS State,
             'Springfield ' || (user_id % 10) AS City, user_id || ' Main St' AS Street,
             lpad(CAST(user_id % 100000 AS VARCHAR), 5, '0') AS PostalCode,
             if(user_id % 3 > 0, 'Household ' || (user_id // 3), NULL) AS CompanyOrAccount,
             ['Homer', 'Elder', 'Ecclesia', 'Deacon', 'Guest', 'Visitor'][1 + user_id % 6] AS Participant_Type__c,
             user_id % 4 = 0 AS HasOptedOutOfEmail,
             ['Attended', 'Attendeed', 'Attended Online', 'Attended (Online)', 'Attended  (Online)', 'No Show'][1 + event_id % 6] AS Status,
             event_id % 5 > 0 AS Attendance_Indicator__c
      FROM placed LEFT JOIN drawn_name ON doc_id = user_id - if(user_id % 16 = 12, 4, 0)""",
    "ticket_event": """
      SELECT if(m = 31, NULL, if(m = 17, item_id - 1, item_id)) AS id,
             if(m = 22, NULL, ['Sunday Worship Night', 'PRAYER Meeting', 'Bible Hour', 'Study Group', 'Picnic'][1 + item_id % 5]) AS name_text,
             'Benchmark item ' || item_id AS description_text, [true, false, NULL, false][1 + item_id % 4] AS online_event,
             if(m = 9, NULL, TIMESTAMP '2023-12-25 09:00:00' + to_hours(22 * item_id)) AS start_local,
             TIMESTAMP '2023-12-25 11:00:00' + to_hours(22 * item_id) AS end_local,
             item_id % 3 AS venue_id, item_id + 100 AS capacity,
             CASE m WHEN 13 THEN 'draft' WHEN 27 THEN NULL ELSE 'live' END AS status, item_id % 2 = 0 AS is_free,
             m = 7 AS _fivetran_deleted, TIMESTAMP '2024-02-01 00:00:00' AS _fivetran_synced
      FROM (SELECT item_id, item_id % 40 AS m FROM benchmark)""",
    "ticket_attendee": """
      SELECT CASE WHEN doc_id % 101 = 7 AND k = 0 THEN NULL WHEN doc_id % 97 = 5 AND k = 1 THEN no - 1 ELSE no END AS id,
             (doc_id // 2 + k % 2) % (SELECT greatest(count(*), 1) FROM benchmark) AS event_id, doc_id AS order_id,
             given AS profile_first_name, family AS profile_last_name,
             CASE WHEN doc_id % 60 = 15 THEN 'Info Requested' WHEN doc_id % 90 = 21 THEN NULL
                  WHEN doc_id % 6 = 1 THEN chr(12288) || 'USER' || (doc_id // 6) || '@example.org'
                  ELSE 'Guest' || doc_id || '@example.net' END AS profile_email,
             '(' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') || ') 555-' || lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') AS profile_cell_phone,
             no % 3 = 0 AS checked_in, if(no % 3 = 0, 'Checked In', 'Attending') AS status,
             TIMESTAMP '2023-12-01 00:00:00' + to_minutes(doc_id) AS created, no % 17 = 0 AS cancelled,
             no % 19 = 0 AS refunded, no % 29 = 0 AS _fivetran_deleted, TIMESTAMP '2024-02-01 00:00:00' AS _fivetran_synced
      FROM (SELECT n.*, k, 10 * doc_id + k AS no FROM drawn_name n, (VALUES (0), (1), (2)) t(k))""",
    "ticket_order": """
      SELECT CASE WHEN o_orderkey % 331 = 3 THEN NULL WHEN o_orderkey % 211 = 4 THEN o_orderkey - 1 ELSE o_orderkey END AS id,
             o_orderkey % (SELECT greatest(count(*), 1) FROM benchmark) AS event_id,
             split_part(c_name, '#', 1) AS owner_first_name, split_part(c_name, '#', 2) AS owner_last_name,
             if(o_orderkey % 173 = 2, NULL, ' ' || c_name || '@Example.com') AS owner_email, o_orderstatus AS status,
             o_totalprice AS gross_major_value, 'USD' AS gross_currency, o_orderdate AS created,
             o_orderkey % 23 = 0 AS _fivetran_deleted, TIMESTAMP '2024-02-01 00:00:00' AS _fivetran_synced
      FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
}

# -- the models ----------------------------------------------------------------------
VISIT = (
    "event_id, event_name, description, type, event_format, event_date, event_time, budget, cost, expected_revenue, "
    "contact_id, first_name, last_name, salutation, phone, mobile_phone, email, fax, country, state_, city, street, "
    "postal_code, company, participant_type, opted_out_of_email, status, attendance_indicator, attendance_type"
)
_W = "v.type = 'Worship Service'"
_RECENT = f"{days_ago('v.event_date')} <= {3 * RATE_STEP}"
_BASE = f"{days_ago('v.event_date')} BETWEEN {3 * RATE_STEP + 1} AND {6 * RATE_STEP}"


def days_where(cond: str, visits: str = "visits") -> str:
    return f"len(list_distinct([v.event_date FOR v IN {visits} IF {cond}]))"


def least_of(column: str, cond: str = "true") -> str:
    return f"list_min([v.{column} FOR v IN visits IF {cond}])"


MODELS = {
    "visit": f"""
      SELECT {VISIT} FROM (
        SELECT CampaignId AS event_id, Name AS event_name, Description AS description, Type AS type,
               Format__c AS event_format, EndDate AS event_date, Service_Time__c AS event_time, BudgetedCost AS budget,
               ActualCost AS cost, ExpectedRevenue AS expected_revenue, ContactId AS contact_id, FirstName AS first_name,
               LastName AS last_name, Salutation AS salutation, Phone AS phone, MobilePhone AS mobile_phone,
               Email AS email, Fax AS fax, Country AS country, State AS state_, City AS city, Street AS street,
               PostalCode AS postal_code, CompanyOrAccount AS company, Participant_Type__c AS participant_type,
               HasOptedOutOfEmail AS opted_out_of_email, Status AS status,
               Attendance_Indicator__c AS attendance_indicator, {status_kind('Status')} AS attendance_type
        FROM campaign_member m, campaign c WHERE m.CampaignId = c.Id) GROUP BY ALL""",
    "event_day": "SELECT event_date, bool_or(type = 'Worship Service') AS worship FROM visit GROUP BY event_date",
    "person": """
      SELECT contact_id, list({'event_date': event_date, 'type': type, 'event_time': event_time, 'kind': attendance_type,
               'role': participant_type, 'first': first_name, 'last': last_name, 'mail': email, 'salutation': salutation,
               'phone': phone, 'mobile_phone': mobile_phone, 'fax': fax, 'country': country, 'state_': state_, 'city': city,
               'street': street, 'postal_code': postal_code, 'company': company, 'opted': opted_out_of_email}) AS visits
      FROM visit GROUP BY contact_id""",
    "window_days": f"""
      SELECT count(*) FILTER (worship AND {days_ago('event_date')} <= {3 * RATE_STEP}) AS recent_worship,
             count(*) FILTER (worship AND {days_ago('event_date')} BETWEEN {3 * RATE_STEP + 1} AND {6 * RATE_STEP}) AS baseline_worship
      FROM event_day""",
    "in_windows": f"""
      SELECT contact_id, {days_where(f"{_W} AND list_contains({ROLES}, v.role) AND {_RECENT}")} AS recent_attendance,
             {days_where(f"{_W} AND list_contains({ROLES}, v.role) AND {_BASE}")} AS baseline_attendance
      FROM person WHERE len([v FOR v IN visits IF {_W} AND list_contains({ROLES}, v.role)]) > 0""",
    "rated": """
      SELECT contact_id, recent_attendance, recent_attendance / nullif((SELECT recent_worship FROM window_days), 0) AS recent_rate,
             baseline_attendance / nullif((SELECT baseline_worship FROM window_days), 0) AS baseline_rate,
             1 - recent_attendance / nullif(baseline_attendance, 0) AS drop_share,
             (baseline_attendance - recent_attendance) / nullif(baseline_attendance, 0) AS drop_ratio
      FROM in_windows""",
    "spread": """
      SELECT n, s, v, CAST(s AS DOUBLE) / nullif(CAST(n * r AS DOUBLE), 0) AS mean_recent,
             sqrt(CAST(v AS DOUBLE) / nullif(CAST(n * (n - 1) AS DOUBLE), 0)) / r AS sd_recent
      FROM (SELECT n, s, n * q - s * s AS v, (SELECT nullif(recent_worship, 0) FROM window_days) AS r
            FROM (SELECT CAST(count(recent_rate) AS HUGEINT) AS n, sum(CAST(recent_attendance AS HUGEINT)) AS s,
                         sum(CAST(recent_attendance AS HUGEINT) * recent_attendance) AS q FROM rated))""",
    "graded": """
      SELECT *, CASE WHEN NOT coalesce(n > 1 AND v > 0 AND recent_rate IS NOT NULL, false) THEN 'Not Applicable'
                     WHEN d < 0 AND d * d * (n - 1) >= n * v THEN 'High'
                     WHEN d < 0 AND 4 * d * d * (n - 1) >= n * v THEN 'Medium' ELSE 'Low' END AS statistical_flag,
             CASE WHEN baseline_rate < 0.4 THEN if(drop_ratio < 0.2, 'Low', 'Not Applicable')
                  WHEN baseline_rate >= 0.7 AND drop_ratio >= 0.5 THEN 'High'
                  WHEN baseline_rate <= 0.7 AND drop_ratio >= 0.6 THEN 'Medium' ELSE 'Not Applicable' END AS rule_based_flag
      FROM (SELECT r.*, n, v, n * recent_attendance - s AS d FROM rated r, spread)""",
    "at_risk": """
      SELECT contact_id, baseline_rate, recent_rate, rule_based_flag, statistical_flag,
             CASE WHEN 'Not Applicable' IN (rule_based_flag, statistical_flag) THEN 'Not Applicable'
                  WHEN rule_based_flag = statistical_flag THEN rule_based_flag ELSE 'Medium' END AS hybrid_flag
      FROM graded WHERE baseline_rate > 0 AND (baseline_rate >= 0.20 OR recent_rate >= 0.20)""",
    "worshipper": f"""
      SELECT contact_id, list_max([v.event_date FOR v IN visits IF {_W}]) AS latest_worship_date,
             {days_where(_W + " AND v.kind = 'In-Person'")} / nullif({days_where(_W)}, 0) AS in_person_prop,
             {days_where(_W + " AND v.event_time = '11:30 AM'")} / nullif({days_where(_W)}, 0) AS second_service_prop
      FROM person WHERE len([v FOR v IN visits IF {_W}]) > 0""",
    "crm_start": f"SELECT contact_id, {least_of('event_date')} AS first_event_date, 'Worship' AS first_event_name FROM person",
    "last_role": """
      SELECT contact_id, arg_max(participant_type, {'day': coalesce(event_date, DATE '0001-01-01'), 'role': coalesce(participant_type, '')}) AS participant_type
      FROM visit GROUP BY contact_id""",
    "live_event": """
      SELECT CAST(id AS VARCHAR) AS eventbrite_event_id, name_text AS event_name, description_text AS description,
             'Eventbrite' AS event_source,
             CASE WHEN name_text ILIKE '%worship%' THEN 'Worship Service' WHEN name_text ILIKE '%prayer%' THEN 'Prayer'
                  WHEN regexp_matches(lower(name_text), 'bible|study') THEN 'Bible Study' ELSE 'Event' END AS type,
             if(online_event IS true, 'Online', 'In-Person') AS event_format, CAST(start_local AS DATE) AS event_date,
             strftime(start_local, '%I:%M %p') AS event_time, start_local AS event_start_at, end_local AS event_end_at,
             venue_id, capacity, status, is_free, _fivetran_synced AS synced_at
      FROM ticket_event WHERE _fivetran_deleted IS false AND status <> 'draft'""",
    "registration": f"""
      SELECT CAST(id AS VARCHAR) AS eventbrite_attendee_id, CAST(event_id AS VARCHAR) AS eventbrite_event_id,
             CAST(order_id AS VARCHAR) AS eventbrite_order_id, profile_first_name AS first_name, profile_last_name AS last_name,
             {key('profile_email')} AS email, array_to_string(regexp_extract_all(profile_cell_phone, '[0-9]'), '') AS phone_normalized,
             profile_cell_phone AS phone_raw, checked_in, status, created AS registered_at, _fivetran_synced AS synced_at
      FROM ticket_attendee WHERE NOT (cancelled OR refunded OR _fivetran_deleted)""",
    "purchase": f"""
      SELECT CAST(id AS VARCHAR) AS eventbrite_order_id, CAST(event_id AS VARCHAR) AS eventbrite_event_id,
             owner_first_name AS first_name, owner_last_name AS last_name, {key('owner_email')} AS email, status,
             gross_major_value AS order_total, gross_currency AS currency, created AS ordered_at, _fivetran_synced AS synced_at
      FROM ticket_order WHERE NOT _fivetran_deleted""",
    "ticket_start": """
      SELECT email AS email_key, min(event_date) AS first_event_date,
             list_sort(list({'dated': event_date IS NOT NULL, 'day': event_date, 'named': event_name IS NOT NULL, 'name': event_name}))[1].name AS first_event_name
      FROM registration JOIN live_event USING (eventbrite_event_id) GROUP BY email""",
    "crm_person": f"""
      SELECT contact_id, pick['f'] AS first_name, pick['l'] AS last_name, email
      FROM (SELECT contact_id, list_min([{{'f': v.first, 'l': v.last}} FOR v IN visits IF v.first IS NOT NULL AND v.last IS NOT NULL]) AS pick,
                   list_min([{key('v.mail')} FOR v IN visits IF v.first IS NOT NULL AND v.last IS NOT NULL]) AS email FROM person)
      WHERE pick IS NOT NULL""",
    "crm_mail": f"SELECT {key('email')} AS email FROM visit WHERE email IS NOT NULL GROUP BY 1",
    "reachable": f"""
      SELECT {key('email')} AS email_key, first_name, last_name, phone_raw FROM registration
      WHERE contains(email, '@') AND NOT list_contains({PLACEHOLDERS}, {strip('email')})
        AND {strip('first_name')} <> '' AND {strip('last_name')} <> ''""",
    "guest": """
      SELECT email_key, n['f'] AS first_name, n['l'] AS last_name, phone
      FROM (SELECT email_key, min({'f': first_name, 'l': last_name}) AS n, min(phone_raw) AS phone FROM reachable r
            WHERE NOT EXISTS (FROM crm_mail c WHERE c.email = r.email_key) GROUP BY email_key)""",
    "crm_bearers": f"""
      SELECT {key('first_name')} AS f, {key('last_name')} AS l, list(contact_id) AS ids FROM crm_person GROUP BY 1, 2""",
    "same_name": f"""
      SELECT email_key AS eb_email, f || ' ' || l AS name_key, ids FROM guest, crm_bearers
      WHERE f = {key('first_name')} AND l = {key('last_name')}""",
    "exact": """
      SELECT eb_email, if(len(ids) = 1, ids[1], NULL) AS sf_contact_id, len(ids) AS n_sf_same_name,
             CAST(NULL AS DOUBLE) AS name_similarity, if(len(ids) = 1, 'high', 'ambiguous') AS match_confidence FROM same_name""",
    "unmatched": "SELECT email_key, first_name, last_name, phone FROM guest WHERE email_key NOT IN (SELECT eb_email FROM same_name)",
    "spelled": f"""
      SELECT name, {grams('name')} AS g FROM (SELECT DISTINCT {key('first_name')} || ' ' || {key('last_name')} AS name FROM unmatched)""",
    "crm_spelled": f"""
      SELECT name, c, {grams('name')} AS g
      FROM (SELECT f || ' ' || l AS name, list_min(flatten(list(ids))) AS c FROM crm_bearers GROUP BY 1)""",
    "nearest": """
      SELECT a AS eb_name, best['b'] AS sf_name, best['c'] AS sf_contact_id, best['common'] AS shared_bigrams,
             best['na'] AS eb_bigram_count, best['nb'] AS sf_bigram_count, -best['minus'] AS similarity
      FROM (SELECT a, min({'minus': -(common / greatest(na, nb, 1)), 'c': c, 'b': b, 'common': common, 'na': na, 'nb': nb}) AS best
            FROM (SELECT s.name AS a, t.name AS b, t.c AS c, len(list_intersect(s.g, t.g)) AS common, len(s.g) AS na, len(t.g) AS nb
                  FROM spelled s, crm_spelled t)
            GROUP BY a)
      WHERE best['minus'] <= -0.4""",
    "lookalike": f"""
      SELECT email_key AS eb_email, sf_contact_id, CAST(1 AS BIGINT) AS n_sf_same_name,
             floor(100 * shared_bigrams / greatest(eb_bigram_count, sf_bigram_count, 1) + 0.5) / 100 AS name_similarity,
             if(similarity >= 0.6, 'medium', 'low') AS match_confidence
      FROM unmatched JOIN nearest ON eb_name = {key('first_name')} || ' ' || {key('last_name')}""",
    "resolved": "FROM exact UNION ALL BY NAME FROM lookalike",
    "merged": "SELECT sf_contact_id, eb_email FROM resolved WHERE match_confidence = 'high'",
    "suspected": """
      SELECT sf_contact_id, 'eb_' || md5(eb_email) AS eb_contact_id, name_similarity FROM resolved
      WHERE match_confidence = 'medium' OR match_confidence = 'low'""",
    "merged_one": """
      SELECT sf_contact_id, m['mail'] AS mail, m['day'] AS day, m['name'] AS name
      FROM (SELECT sf_contact_id, min({'undated': first_event_date IS NULL, 'day': first_event_date, 'mail': eb_email, 'name': first_event_name}) AS m
            FROM merged LEFT JOIN ticket_start ON email_key = eb_email GROUP BY sf_contact_id)""",
    "suspected_one": """
      SELECT sf_contact_id, s['id'] AS id, -s['minus'] AS similarity
      FROM (SELECT sf_contact_id, min({'minus': -name_similarity, 'id': eb_contact_id}) AS s FROM suspected GROUP BY sf_contact_id)""",
    "member_name": f"""
      SELECT contact_id, visits, {least_of('first', f"{strip('v.first')} <> ''")} AS f, {least_of('last', f"{strip('v.last')} <> ''")} AS l
      FROM person""",
    "crm_member": f"""
      SELECT p.contact_id, {titled('f')} AS first_name, {titled('l')} AS last_name, {least_of('salutation')} AS salutation,
             {least_of('phone')} AS phone, {least_of('mobile_phone')} AS mobile_phone,
             list_min([{key('v.mail')} FOR v IN visits]) AS email_1, mail AS email_2, {least_of('fax')} AS fax,
             {least_of('country')} AS country, {least_of('state_')} AS state_, {least_of('city')} AS city,
             {least_of('street')} AS street, {least_of('postal_code')} AS postal_code, {least_of('company')} AS company,
             participant_type, {least_of('opted')} AS opted_out_of_email, latest_worship_date, baseline_rate, recent_rate,
             coalesce(rule_based_flag, 'Not Applicable') AS rule_based_flag,
             coalesce(statistical_flag, 'Not Applicable') AS statistical_flag,
             coalesce(hybrid_flag, 'Not Applicable') AS hybrid_flag, in_person_prop, second_service_prop,
             if(m.day < s.first_event_date, m.day, s.first_event_date) AS first_event_date,
             CASE WHEN m.day < s.first_event_date THEN m.name WHEN s.first_event_date IS NOT NULL THEN 'Worship' END AS first_event_name,
             x.id AS possible_duplicate_contact_id, x.similarity AS name_similarity
      FROM member_name p LEFT JOIN last_role USING (contact_id) LEFT JOIN worshipper USING (contact_id)
           LEFT JOIN at_risk USING (contact_id) LEFT JOIN crm_start s USING (contact_id)
           LEFT JOIN merged_one m ON m.sf_contact_id = p.contact_id LEFT JOIN suspected_one x ON x.sf_contact_id = p.contact_id
      WHERE f IS NOT NULL AND l IS NOT NULL""",
    "ticket_member": f"""
      SELECT 'eb_' || md5(g.email_key) AS contact_id, {titled('g.first_name')} AS first_name, {titled('g.last_name')} AS last_name,
             g.phone AS phone, g.email_key AS email_1, 'Not Applicable' AS rule_based_flag, 'Not Applicable' AS statistical_flag,
             'Not Applicable' AS hybrid_flag, t.first_event_date, t.first_event_name,
             if(r.match_confidence IN ('medium', 'low'), r.sf_contact_id, NULL) AS possible_duplicate_contact_id, r.name_similarity
      FROM guest g LEFT JOIN resolved r ON r.eb_email = g.email_key LEFT JOIN ticket_start t ON t.email_key = g.email_key
      WHERE r.match_confidence IS DISTINCT FROM 'high'""",
    # the member shape for both: absent columns become typed NULLs
    "member": "FROM (FROM crm_member WHERE false) UNION ALL BY NAME FROM crm_member UNION ALL BY NAME FROM ticket_member",
    "ticket_shaped": "FROM (FROM crm_member WHERE false) UNION ALL BY NAME FROM ticket_member",
    "presence": f"""
      SELECT event_id, event_date, {bucket_of('event_date', BUCKET_STEP)} AS time_bucket, event_time, type, event_format,
             attendance_type, contact_id, m.first_name, m.last_name, m.participant_type
      FROM (SELECT * FROM visit WHERE attendance_indicator AND event_date BETWEEN DATE '2020-01-01' AND {TODAY}) v
           JOIN crm_member m USING (contact_id) GROUP BY ALL""",
    "served": """
      SELECT time_bucket, contact_id, len(list_distinct([x.d FOR x IN days IF x.w AND x.k = 'In-Person'])) AS in_person_count,
             len(list_distinct([x.d FOR x IN days IF x.w AND x.t = '11:30 AM'])) AS second_service_count,
             len(list_distinct([x.d FOR x IN days])) AS events_attended
      FROM (SELECT time_bucket, contact_id, list({'d': event_date, 'w': type = 'Worship Service', 'k': attendance_type, 't': event_time}) AS days
            FROM presence GROUP BY time_bucket, contact_id)""",
    "busy": "SELECT time_bucket, len(list_distinct(list(event_date))) AS events_sum FROM presence GROUP BY time_bucket",
    "mail_owner": f"""
      SELECT email, arg_max(contact_id, {{'day': coalesce(event_date, DATE '0001-01-01'), 'who': contact_id}}) AS contact_id
      FROM (SELECT {key('email')} AS email, event_date, contact_id FROM visit WHERE email IS NOT NULL) GROUP BY email""",
    "counted_once": """
      SELECT r.* FROM registration r,
        (SELECT list_sort(list({'away': NOT checked_in, 'named': eventbrite_attendee_id IS NOT NULL, 'id': eventbrite_attendee_id,
                                'event': eventbrite_event_id, 'mail': email}))[1] AS k
         FROM registration GROUP BY eventbrite_event_id, email)
      WHERE r.eventbrite_attendee_id IS NOT DISTINCT FROM k['id'] AND r.eventbrite_event_id = k['event']
        AND r.email IS NOT DISTINCT FROM k['mail'] AND r.checked_in <> k['away']""",
    "ticket_presence": """
      SELECT e.eventbrite_event_id AS event_id, e.event_name, e.type, e.event_format, e.event_date, e.event_time,
             coalesce(o.contact_id, 'eb_' || r.eventbrite_attendee_id) AS contact_id, r.first_name, r.last_name, r.email,
             r.phone_raw AS phone, r.checked_in AS attendance_indicator, e.event_format AS attendance_type
      FROM counted_once r JOIN live_event e USING (eventbrite_event_id) LEFT JOIN mail_owner o ON o.email = r.email""",
}

# -- declared tests: (relation, model, key, other required columns) -----------------------
REQUIRED = [
    ("stg_ticket_events", "live_event", "eventbrite_event_id", ["event_name", "event_date"]),
    ("stg_ticket_attendees", "registration", "eventbrite_attendee_id", ["email"]),
    ("stg_ticket_orders", "purchase", "eventbrite_order_id", ["email"]),
]


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


TWICE = _union(
    f"SELECT '{r}' AS relation, '{k}' AS column_name, {k} AS value, count(*) AS n_rows FROM {m} GROUP BY {k} HAVING count({k}) > 1"
    for r, m, k, _ in REQUIRED
)
ABSENT = _union(
    f"SELECT '{r}' AS relation, '{c}' AS column_name, {k} AS row_key FROM {m} WHERE {c} IS NULL"
    for r, m, k, others in REQUIRED
    for c in [k, *others]
)
COUNTED = _union(
    f"SELECT '{r}' AS relation, '{c}' AS column_name, '{t}' AS test, (SELECT count(*) FROM ({found}) f "
    f"WHERE f.relation = '{r}' AND f.column_name = '{c}') AS failures"
    for r, _, k, others in REQUIRED
    for c, t, found in [(k, "unique", TWICE), *[(c, "not_null", ABSENT) for c in [k, *others]]]
)

ANSWERS = {
    "scan_campaign": "FROM campaign",
    "scan_campaign_member": "FROM campaign_member",
    "event_detail": "FROM visit",
    "attendance_type": f"SELECT Status AS status, {status_kind('Status')} AS attendance_type, count(*) AS n_rows FROM campaign_member GROUP BY ALL",
    "stg_ticket_events": "FROM live_event",
    "event_classification": "SELECT eventbrite_event_id, event_name, type, event_format FROM live_event",
    "stg_ticket_attendees": "FROM registration",
    "stg_ticket_orders": "FROM purchase",
    "normalize_email": f"SELECT id AS attendee_id, profile_email AS raw_email, {key('profile_email')} AS email FROM ticket_attendee",
    "normalize_phone": "SELECT id AS attendee_id, profile_cell_phone AS phone_raw, array_to_string(regexp_extract_all(profile_cell_phone, '[0-9]'), '') AS phone_normalized FROM ticket_attendee",
    "proper_case_names": f"SELECT FirstName AS raw_first_name, LastName AS raw_last_name, {titled('FirstName')} AS first_name, {titled('LastName')} AS last_name FROM campaign_member GROUP BY ALL",
    "dim_events": "SELECT event_id, event_name, description, type, event_format, event_date, event_time, budget, cost, expected_revenue FROM visit GROUP BY ALL",
    "event_calendar": f"SELECT c.* FROM ({calendar(CALENDAR_STEP)}) c JOIN event_day ON event_date = c.date",
    "time_bucket": f"SELECT event_date, {bucket_of('event_date', BUCKET_STEP)} AS time_bucket FROM event_day",
    "period_event_days": "FROM window_days",
    "member_period_attendance": "FROM in_windows",
    "attendance_rates": "SELECT contact_id, recent_rate, baseline_rate, drop_ratio FROM rated",
    "rate_stats": "SELECT mean_recent, sd_recent FROM spread",
    "risk_eligible": "SELECT contact_id, baseline_rate, recent_rate FROM at_risk",
    "risk_rule_flag": "SELECT contact_id, baseline_rate, drop_ratio, rule_based_flag FROM graded",
    "risk_statistical_flag": "SELECT contact_id, recent_rate, statistical_flag FROM graded",
    "risk_flags": "SELECT contact_id, baseline_rate, recent_rate, rule_based_flag, statistical_flag FROM at_risk",
    "hybrid_risk": "FROM at_risk",
    "latest_worship": "FROM worshipper",
    "first_crm_event": "FROM crm_start",
    "first_ticket_event": "FROM ticket_start",
    "latest_participant_type": "FROM last_role",
    "crm_contacts": "FROM crm_person",
    "valid_attendee_contacts": "FROM reachable",
    "ticket_contacts_not_in_crm": "SELECT email_key, first_name, last_name FROM guest",
    "exact_name_match": "FROM exact",
    "ambiguous_name_emails": "SELECT eb_email, name_key FROM same_name WHERE len(ids) > 1",
    "ambiguous_name_contacts": "SELECT name_key, unnest(ids) AS sf_contact_id FROM (SELECT DISTINCT name_key, ids FROM same_name WHERE len(ids) > 1)",
    "unresolved_ticket_contacts": "SELECT email_key, first_name, last_name FROM unmatched",
    "name_similarity_pairs": "FROM nearest",
    "best_similar_name": "FROM lookalike",
    "name_resolution": "FROM resolved",
    "high_confidence_matches": "FROM merged",
    "flagged_matches": "FROM suspected",
    "surrogate_contact_id": "SELECT email_key, 'eb_' || md5(email_key) AS contact_id FROM guest",
    "crm_members": "FROM crm_member",
    "ticket_only_contacts": "FROM ticket_shaped",
    "dim_members": "FROM member",
    "first_touch": "SELECT contact_id, first_event_date, first_event_name FROM crm_member",
    "attendance_base": "FROM presence",
    "service_counts": "FROM served",
    "events_attended": "SELECT contact_id, time_bucket, events_attended FROM served",
    "events_per_bucket": "FROM busy",
    "fact_attendance": "SELECT p.*, in_person_count, second_service_count, events_attended, events_sum FROM presence p JOIN served USING (time_bucket, contact_id) JOIN busy USING (time_bucket)",
    "email_to_contact": "FROM mail_owner",
    "dedup_attendees": "FROM counted_once",
    "ticket_attendance": "FROM ticket_presence",
    "dq_unique_violations": TWICE,
    "dq_not_null_violations": ABSENT,
    "dq_summary": COUNTED,
}


def oracle_queries() -> dict[str, str]:
    steps = ",\n".join(f"{name} AS ({sql})" for name, sql in {**REGISTRIES, **MODELS}.items())
    return {name: f"WITH {steps}\nSELECT * FROM ({sql}) AS answer" for name, sql in ANSWERS.items()}
