"""The pipeline's stages and its result against stage-by-stage recomputation."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from conftest import SF_SMALL
from orrery.llm import mixing, quality, simhash, toxicity
from orrery.llm.base import cut_lineage, table


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF_SMALL, "documents")
    docs = docs.withColumn("size", F.lit("kept")).withColumn("score", F.col("doc_id") * 2)
    # nulls, an empty text and repeated rows go through every stage
    odd = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    odd = odd.union(docs.limit(2).withColumn("text", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string")))
    docs = cut_lineage(docs.union(odd).union(docs.limit(1)))
    assert [n for n, _ in P.STAGES] == ["quality", "toxicity", "near_duplicates", "mixing", "packing"]
    seen = [docs]
    for name, stage in P.STAGES:
        out = cut_lineage(stage(spark, seen[-1], SF_SMALL))
        if name != "packing":
            assert out.columns == docs.columns, name
            assert out.join(seen[-1].select("doc_id", "text").distinct(), ["doc_id", "text"], "left_anti") \
                .filter("doc_id is not null and text is not null").count() == 0
        seen.append(out)
    good, mild, single, mixed, pieces = seen[1:]
    assert good.count() < docs.count() and mild.count() < good.count()
    # one row of each class stays, and nothing else is lost
    assert single.count() == simhash.near_duplicates(mild).select("class").distinct().count()
    assert simhash.near_duplicates(single).select("class").distinct().count() == single.count()
    want = {(r["doc_id"], r["copies"]) for r in mixing.mix(single).select("doc_id", "copies").collect() if r["copies"]}
    assert want == {(r["doc_id"], r["n"]) for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert pieces.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()
    total = pieces.agg(F.sum("length")).first()[0]
    by_doc = pieces.filter("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert total == by_doc


def test_rejections_are_those_of_the_scores(spark):
    docs = table(spark, SF_SMALL, "documents")
    labels = table(spark, SF_SMALL, "labels")
    model = quality.train(docs, quality.trusted(labels))
    want = quality.score(docs, model).filter("score >= 0.7").select("doc_id")
    assert sorted(r[0] for r in P.keep_good(spark, docs, SF_SMALL).select("doc_id").collect()) == sorted(r[0] for r in want.collect())
    model = toxicity.train(docs, toxicity.marked(labels))
    want = toxicity.score(docs, model).filter("score < 0.5").select("doc_id")
    assert sorted(r[0] for r in P.drop_toxic(spark, docs, SF_SMALL).select("doc_id").collect()) == sorted(r[0] for r in want.collect())


def test_empty_documents(spark):
    docs = table(spark, SF_SMALL, "documents").limit(0)
    for _, stage in P.STAGES:
        docs = cut_lineage(stage(spark, docs, SF_SMALL))
        assert docs.count() == 0


def test_run_is_the_last_stage(spark):
    out = P.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0
