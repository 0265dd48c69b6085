"""The pipeline against a composition of plain rules, and the SQL of the queries."""

import duckdb


import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    import corpus_pipeline as p
    from flocklens.llm import language_id, quality_fm

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {0: docs}
    for k, (name, stage) in enumerate(p.STAGES, 1):
        stage(spark, kept[k - 1], SF).write.parquet(str(tmp_path / name))
        kept[k] = spark.read.parquet(str(tmp_path / name))
        if k < len(p.STAGES):
            assert kept[k].columns == docs.columns
    ids = {k: {r.doc_id for r in kept[k].select("doc_id").collect()} for k in kept}
    # language: what the operator recognises
    model = language_id.train(docs.where(~language_id.held_out()))
    want = {r.doc_id for r in language_id.predict(docs, model).collect() if r.lang_pred != "und" and r.score >= p.MIN_LANGUAGE_SCORE}
    assert ids[1] == want
    # quality: what the classifier accepts
    model = quality_fm.train(kept[1], quality_fm.learnable(spark.read.parquet(f"{SF}/labels.parquet")))
    assert ids[2] == {r.doc_id for r in quality_fm.score(kept[1], model).collect() if r.predicted == 1}
    # near duplicates: brute force over five-word shingles
    rows = [(r.doc_id, r.text) for r in kept[2].collect()]
    assert ids[3] == {i for i, (_, c, _) in brute.near_duplicates(rows, 5).items() if c == i}
    # repeated passages: brute force over 35-word windows
    rows = [(r.doc_id, r.text) for r in kept[3].collect()]
    text = dict(rows)
    want = {i: " ".join(x for k, x in enumerate(w) if k not in gone) if gone else text[i] for i, w, gone in brute.removed_words(rows, 35)}
    assert {r.doc_id: r.text for r in kept[4].collect()} == want
    # packing: all documents, gapless sequences
    assert ids[5] == ids[4]
    sequences = {}
    for r in kept[5].collect():
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048
    whole = p.run(spark, SF)
    assert {(r.doc_id, r.piece, r.length) for r in whole.collect()} == {(r.doc_id, r.piece, r.length) for r in kept[5].collect()}


def test_stages_on_odd_and_empty_documents(spark, odd, empty):
    import corpus_pipeline as p

    for docs in (odd.select("doc_id", "text", "lang", "source", "n_chars"), empty.select("doc_id", "text", "lang", "source", "n_chars")):
        for name, stage in p.STAGES:
            stage(spark, docs, SF).count()


def test_queries_match_their_sql(spark):
    from flocklens.llm.oracle import ORACLE_SQL
    from flocklens.llm.queries import QUERIES
    from tools.compare import TABLES, digest

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLE_SQL.items():
        df = QUERIES[name](spark, SF)
        found = con.execute(sql)
        columns = [c[0] for c in found.description]
        assert sorted(df.columns) == sorted(columns), name
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, found.fetchall())[0], name


def test_every_operator_has_its_query():
    import __spark_entry__ as e

    names = {n.split("_")[0] for n in e.queries() if n.startswith("op")}
    assert names == {f"op{k}" for k in range(1, 14)} and "pipeline" in e.queries()


def test_stages_with_clashing_columns(spark, odd):
    """Stages carry further columns whose names the operators use inside."""
    import corpus_pipeline as p

    for name, stage in p.STAGES:
        out = stage(spark, odd, SF)
        assert name == "packed" or out.columns == odd.columns
        out.count()


def test_scope_removes_run_folders(spark, tmp_path):
    import os

    from flocklens.llm.common import Run, Scope, shared_dir

    root = shared_dir(spark).removeprefix("file:")
    outer = Run(spark, "outer")
    outer.keep(spark.range(3)).count()
    before = set(os.listdir(root))
    with Scope(spark):
        Run(spark, "inner").keep(spark.range(3)).write.parquet(str(tmp_path / "out"))
    assert set(os.listdir(root)) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
