import corpus_pipeline
import sentencepiece

from goldleaf.llm import pieces, pii
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_jaccard_join import brute as groups

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {0: docs.collect()}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        rows[i + 1] = out.collect()
        if i < 4:
            assert out.columns == docs.columns
            docs = spark.createDataFrame(rows[i + 1], docs.schema)
    assert 0 < len(rows[1]) < len(rows[0]) and {r.doc_id for r in rows[1]} <= {r.doc_id for r in rows[0]}
    texts = [(r.doc_id, r.text) for r in rows[1]]
    assert sorted(r.doc_id for r in rows[2]) == sorted(d for d, _, c in groups(texts, 5, 80) if d == c)
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, hit, _, _ in leaks([(r.doc_id, r.text) for r in rows[2]], items, 80) if hit}
    assert sorted(r.doc_id for r in rows[3]) == sorted(r.doc_id for r in rows[2] if r.doc_id not in bad)
    assert sorted(r.doc_id for r in rows[4]) == sorted(r.doc_id for r in rows[3])
    before = {r.doc_id: r for r in rows[3]}
    assert all(r.n_chars == len(r.text) and ("[PII]" in r.text or r == before[r.doc_id]) for r in rows[4])
    assert not [r for r in pii.personal_data(spark.createDataFrame(rows[4])).collect() if r.base]
    v = pieces.Vocabulary(pieces.MODEL)
    text = {r.doc_id: r.text for r in rows[4]}
    assert all(b"".join(v.decoded[i] for i in r.ids)[1:].decode() == text[r.doc_id] for r in rows[5]) and len(rows[5]) == len(rows[4])
    assert sentencepiece.__version__


def test_nulls_and_repeated_rows(spark):
    good = " ".join(f"word{i} and" for i in range(60))
    rows = [(1, good, "en", None, 5), (1, good, "en", None, 5), (1, good + " more", None, "s", None), (None, good.replace("word", "term"), None, None, 0),
            (2, None, None, None, None), (3, "", "x", "y", 0), (4, "too short", "x", "y", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
    assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 1]
