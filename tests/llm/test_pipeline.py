"""The pipeline's stages on odd rows and on the smallest tables."""

import corpus_pipeline
from tidyrent.llm.common import stage


def through(spark, docs):
    columns, counts = docs.columns, []
    for name, function in corpus_pipeline.STAGES:
        out = stage(function(spark, docs, "unused"), f"test-{name}")
        counts.append(out.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
            docs = out
    return docs, out, counts


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    docs, packed, counts = through(spark, odd_docs)
    assert counts[0] >= counts[1] >= counts[2] == counts[3] and packed.count() > 0
    assert {r.doc_id for r in docs.collect()} == {1, 5, 7}  # one of each copy, nothing blank
    assert through(spark, no_docs)[2] == [0] * 5


def test_small_tables(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    kept, packed, counts = through(spark, docs)
    n = docs.count()
    assert counts[0] >= 0.95 * docs.where("n_chars > 20").count() and counts[3] == counts[2] <= counts[1] < counts[0] <= n
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in kept.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, small_dir).count() == packed.count()


def test_sequences_follow_the_mixing_weights(spark, make_docs):
    weights = corpus_pipeline.MIX_WEIGHTS
    rows, rounds = [], 2
    for k, (source, w) in enumerate(weights.items()):  # a source's lengths are its own
        for n in range(rounds * 5 * w * corpus_pipeline.MIX_BLOCK_ROWS):
            rows.append((len(rows), "word " * (20 + 60 * k + n % 40), "en", source))
    docs = stage(corpus_pipeline.mix_sources(spark, make_docs(rows[::-1]), "unused"), "test-mix")
    got = corpus_pipeline.pack(spark, docs, "unused").toPandas()
    source = {i: s for i, _, _, s in rows}
    assert sorted(got["doc_id"]) == sorted(source)
    got = got.sort_values(["sequence_id", "offset"])
    half = got["doc_id"].iloc[: corpus_pipeline.SPAN_ROWS].map(source).value_counts().to_dict()
    assert half == {s: 5 * w * corpus_pipeline.MIX_BLOCK_ROWS for s, w in weights.items()}
    assert set(got["sequence_id"].iloc[: corpus_pipeline.SPAN_ROWS]).isdisjoint(got["sequence_id"].iloc[corpus_pipeline.SPAN_ROWS :])
    assert (got.groupby("sequence_id")["length"].sum() <= 2048).all()
