import corpus_pipeline
from lexispark.llm.common import table


def test_decontamination_judges_each_row_by_its_text(spark, sf_dir):
    passage = next(r.text for r in table(spark, sf_dir, "benchmark").collect() if len((r.text or "").split()) >= 12)
    data = [(None, f"before {passage} after"), (None, "clean without an id"), (7, passage), (7, "clean with a shared id"), (8, "clean"), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in data], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.decontamination(spark, docs, sf_dir)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(map(str, docs.where("not (text like '%before%') or text is null").select("doc_id", "text").where("text is null or text like 'clean%'").collect()))
