import corpus_pipeline
import public_tokenizers
import plain_pipeline
from llm_helpers import LABELS, clashing, rows
from tokenizers import Tokenizer

from opinio.llm import importance, mixing, simhash
from test_bpe import digest


def test_stages_keep_columns_and_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = clashing(spark.read.parquet(f"{sf}/documents.parquet"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    (_, quality), (_, copies), (_, mix), (_, encode) = corpus_pipeline.STAGES

    good = corpus_pipeline.cut(quality(spark, docs, sf), "test")
    kept = {r.id for r in importance.classify(docs, labels)[0].filter("kept").collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept

    single = corpus_pipeline.cut(copies(spark, good, sf), "test")
    groups = {r.component_id for r in simhash.components(good).collect()}
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted(groups)

    mixed = corpus_pipeline.cut(mix(spark, single, sf), "test")
    want = sorted(r.id for r in mixing.mix(single).collect() for _ in range(r.copies))
    assert mixed.columns == docs.columns and sorted(r.doc_id for r in mixed.collect()) == want

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert rows(encode(spark, mixed, sf)) == sorted([(r.doc_id, *digest(library, r.text)) for r in mixed.collect()], key=repr)


def test_run(spark):
    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 100
    assert rows(got) == rows(corpus_pipeline.run(spark, sf))


def test_run_against_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    good = plain_pipeline.keep_good(docs, labels)
    assert sorted(r.doc_id for r in good) == sorted(r.doc_id for r in importance.op3(spark, sf).select("doc_id").collect())
    assert 0 < len(good) < docs.count()
    single = plain_pipeline.drop_copies(good)
    assert 0 < len(single) < len(good)
    mixed = plain_pipeline.mix(spark.createDataFrame([tuple(r)[: len(docs.columns)] for r in single], docs.schema))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted([(r.doc_id, *digest(library, r.text)) for r in mixed], key=repr)
    assert rows(corpus_pipeline.run(spark, sf)) == want


def test_odd_and_empty_tables(spark, tmp_path, odd_docs, no_docs):
    sf = str(tmp_path)
    spark.createDataFrame([(4, 1, 0), (5, 0, 0), (6, None, 1)], LABELS).write.parquet(f"{sf}/labels.parquet")
    for docs in (no_docs, odd_docs, clashing(odd_docs)):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.cut(stage(spark, docs, sf), "test")
        docs.count()
