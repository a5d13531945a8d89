import oracle

import corpus_pipeline
from billproof.llm import common, decontaminate, quality, queries, simhash


def test_queries_against_sql(spark, sf):
    con = oracle.connect(sf)
    for name, sql in queries.ORACLES.items():
        assert oracle.compare(spark, con, queries.QUERIES[name], sql, sf) is None


def test_pipeline_is_its_operators_in_a_row(spark, sf):
    docs = common.table(spark, sf, "documents")
    verdict = quality.scores(docs, quality.fit(docs, common.table(spark, sf, "labels")))
    kept = {r.key for r in verdict.where("kept").collect()}
    groups = simhash.near_duplicates(docs.where(docs.doc_id.isin(list(kept)))).collect()
    kept = {r.key for r in groups if r.key == r.component_id}
    hits = decontaminate.report(docs, common.table(spark, sf, "benchmark")).where("contaminated").collect()
    kept -= {r.key for r in hits}
    found = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in found} == kept and all(r.decoded for r in found)


def edge_folder(spark, tmp_path, rows, benchmark, labels):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, fp long, key string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(benchmark, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_pipeline_of_odd_documents(spark, tmp_path):
    told = "the river runs under the old stone bridge and the light of the morning lies on the water of the town "
    item = "which of these seven answers names the largest planet of the inner solar system today"
    rows = [
        (1, told * 3, "en", "a", 1, 2, "x"), (1, told * 3, "en", "a", 1, 2, "x"),  # equal rows
        (2, "a quite different text about houses and gardens that nobody has written before in this place", None, None, None, None, None),
        (2, "another text under the same id which speaks of ships and harbours and of the wide cold sea", "en", "b", 0, 0, "y"),
        (3, told * 3, "en", "c", 1, 2, "z"),  # a copy under another id
        (4, item, "en", "c", 1, 2, "z"), (5, None, None, None, None, None, None), (6, "", "en", "c", 1, 2, "z"), (None, "no id but words enough to be a text of its own", "en", "c", 1, 2, "z"),
        (7, "word " * 30000 + "end", "en", "c", 1, 2, "z"),
    ]
    folder = edge_folder(spark, tmp_path, rows, [("q", item), (None, told), ("n", None)], [(1, 1, 0), (99, 0, 1), (2, None, None)])
    docs, seen = common.table(spark, folder, "documents"), []
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = common.stored(stage(spark, docs, folder), name)
        assert docs.columns == common.table(spark, folder, "documents").columns
        seen.append(sorted(((r.doc_id, (r.text or "")[:20]) for r in docs.collect()), key=repr))
    assert [k for k, _ in seen[1]].count(1) == 2 and 3 not in [k for k, _ in seen[1]]  # equal rows stay, the copy goes
    assert {t for k, t in seen[1] if k == 2} == {t for k, t in seen[0] if k == 2}  # two texts of one id, each its own
    assert 4 in [k for k, _ in seen[1]] and 4 not in [k for k, _ in seen[2]]
    assert None in [k for k, _ in seen[2]]
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id for r in found), key=repr) == sorted((k for k, _ in seen[2]), key=repr)


def test_pipeline_of_no_documents(spark, tmp_path):
    folder = edge_folder(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, folder).collect() == []
