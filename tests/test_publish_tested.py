import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_publish_counts_what_the_tests_count(spark, tmp_path):
    from pyspark.sql import functions as F

    from flocklens.operators import quality
    from flocklens.plans.catalog import fixture_build
    from flocklens.plans.sinks import publish_tested, published

    b = fixture_build(spark, SF, shared=False)
    # repeated rows and NULL keys, so that tests fail
    att = b.stg_attendees
    hurt = att.withColumn("email", F.when(F.crc32("eventbrite_attendee_id") % 5 > 0, F.col("email")))
    b.stg_attendees = att.unionByName(hurt.filter(F.crc32("eventbrite_attendee_id") % 3 == 0))
    models = [name for name, _, _ in quality.TESTS]
    tables, failures = publish_tested(b, str(tmp_path / "out"), models)
    want = {(r.relation, r.column_name, r.test): r.failures for r in b.dq("dq_summary").collect()}
    assert failures == want and len(want) == 10
    assert want[("stg_ticket_attendees", "eventbrite_attendee_id", "unique")] > 0
    assert want[("stg_ticket_attendees", "email", "not_null")] > 0
    assert tables == published(spark, str(tmp_path / "out"))
    b.close()
