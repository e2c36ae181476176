"""The pipeline against its stages by brute force."""

import corpus_pipeline
from tests.llm.test_operators import ODD, brute_components, brute_hits
from tidefold.llm.queries import codec


def test_pipeline(spark, sf_dir):
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    with_letters = [(i, r["text"]) for i, r in docs.items() if any(map(str.isalpha, r["text"] or ""))]
    components = brute_components(with_letters, 5, 80)
    first = {i for i, (_, c) in components.items() if i == c}
    clean = {i for i in first if not brute_hits(docs[i]["text"], items)[1]}
    assert set(out) <= clean and len(out) >= 0.97 * len(clean)  # language ID may doubt a few
    for i, r in out.items():
        assert r["n_tokens"] == len(r["ids"]) and codec().decode(r["ids"]).decode() == r["text"]
        assert len(r["text"]) >= 0.9 * len(docs[i]["text"])


def test_stages_on_odd_tables(spark, sf_dir):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
    odd = spark.createDataFrame([(i, t, None if i % 3 else "en", None, None, "s") for i, t in enumerate(ODD)], schema)
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns
            out.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
