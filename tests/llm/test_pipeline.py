import corpus_pipeline
from tests.llm import test_lines, test_minhash
from tests.llm.rows import empty, odd
from tracewright.llm import language, templates
from tracewright.llm.common import table


def test_stages_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    kept = {r.doc_id: r for r in docs.collect()}
    model = language.fit(docs)
    known = {r.doc_id for r in language.predict(docs, model).where("lang_pred <> 'und' and score >= 0.5").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in kept.values() if r.doc_id in known]
    lines = [(i, t) for i, t, _ in test_lines.brute(rows)]
    groups = test_minhash.brute(lines, 5)
    lines = [(i, t) for i, t in lines if groups[i][1] == i]
    items = [r.text for r in table(spark, folder, "benchmark").collect()]
    wanted = {i for i, t in lines if not any(x in t for x in items)}
    found = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in found} == wanted
    assert len(found) == len(wanted) > 100
    assert all(len(r.ids) > 0 for r in found if dict(lines)[r.doc_id])


def test_stages_keep_the_columns(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "lines", "near_duplicates", "decontamination", "pieces",
    ]
    for docs in (odd(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "/root/testdata/sf0.001")
            assert docs.columns == odd(spark).columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").columns[0] == "doc_id"


def test_clean_documents_stay(spark):
    found = templates.clean(odd(spark), table(spark, "/root/testdata/sf0.001", "benchmark"))
    assert found.count() == odd(spark).count()
