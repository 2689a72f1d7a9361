"""The pipeline against plain Python, stage by stage."""
import corpus_pipeline
from revspark.llm import op6_language_id as op6, op8_bpe as op8
from tests.conftest import SF001
from tests.llm import brute
from tests.llm.test_text import leaks_by_alignment


def test_run(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    told = {r["doc_id"] for r in op6.predict(docs, op6.fit(docs)).filter("NOT rejected").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in told]
    keep = brute.exact_dedup(rows)
    rows = [r for r in rows if keep[r[0]][0] == r[0]]
    near = brute.near_dedup(rows, 5)
    rows = [r for r in rows if near[r[0]][1] == r[0]]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    leaks = leaks_by_alignment(rows, items)
    rows = [r for r in rows if not leaks[r[0]]]
    codec = op8.codec_for(op8.read_vocabulary())
    want = {i: codec.digests([t])[0] for i, t in rows}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF001).collect()}
    assert got == want


def test_stages_keep_columns_and_survive_edges(spark):
    rows = [(1, None, None, None, "k"), (None, "the word and the other", "en", "s", "k"), (2, "", "en", "s", "k"),
            (3, "the and of it", "en", "s", "k"), (3, "the and of it", "en", "s", "k"), (4, "12", "de", "s", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF001)
            assert out.columns == docs.columns, name
            out.collect()
    assert corpus_pipeline.STAGES[1][1](spark, docs, SF001).count() == 4
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF001).count() == len(rows)
