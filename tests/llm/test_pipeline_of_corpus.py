import corpus_pipeline
from brokerhouse.llm import bpe
from brokerhouse.llm.queries import QUERIES, vocabulary

FOLDER = "/root/testdata/sf0.001"


def test_stages_over_nulls_repeats_and_clashing_columns(spark):
    long = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, long, "en", "s", 1, 0), (2, long + " thirteen", "en", "s", 1, 0), (3, long.upper(), "en", None, 1, 0)]
    rows += [(None, None, None, None, None, 0), (4, "", "en", "s", 0, 0), (5, "w " * 20_000, "de", "t", 9, 0)]
    rows += [(5, "w " * 20_000, "de", "t", 9, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _key int")
    stages = dict(corpus_pipeline.STAGES)
    exact = stages["exact_dedup"](spark, docs, FOLDER)
    assert exact.columns == docs.columns
    assert sorted(str(r.doc_id) for r in exact.collect()) == ["2", "3", "4", "5"]
    near = stages["ngram_join"](spark, docs, FOLDER)
    assert near.columns == docs.columns
    assert sorted(str(r.doc_id) for r in near.collect()) == ["1", "4", "5", "5", "None"]
    mixed = stages["mixing"](spark, docs, FOLDER)
    assert mixed.columns == docs.columns and {2, 5} <= {r.doc_id for r in mixed.collect()}
    assert stages["toxicity"](spark, docs, FOLDER).columns == docs.columns
    last = stages["bpe"](spark, docs, FOLDER)
    own = bpe.Bpe.read(vocabulary())
    texts = {r[0]: r[1] or "" for r in rows}
    assert all(r.round_trip and own.decode(r.token_ids) == texts[r.doc_id] for r in last.collect())


def test_no_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    assert all(stage(spark, docs, FOLDER).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_whole_pipeline_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = QUERIES["pipeline"](spark, FOLDER).cache()
    assert found.where("not round_trip").count() == 0
    assert found.select("doc_id").distinct().count() > 0.5 * docs.count()
