"""What single stages of the pipeline must drop."""

import corpus_pipeline
from marketframe.llm import quality


def test_near_duplicates_are_linked_from_a_similarity_of_four_fifths(spark):
    words = [f"w{i}" for i in range(114)]
    # 110 shingles, of which ten change: 100 shared of 120.
    other = [*words[:30], "x", *words[31:70], "y", *words[71:]]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(f"z{i}" for i in range(114)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()) == [1, 3]


def test_a_language_with_some_hundred_labels_gets_cutoffs(spark, tmp_path):
    def text(i, mark=""):
        return " ".join(f"w{n}x{i}{mark}" for n in range(60))

    rows = [(i, text(i), "de") for i in range(300)] + [(1000 + i, text(i, "#"), "de") for i in range(9)]
    rows += [(2000 + i, text(i), "fr") for i in range(50)] + [(3000, text(0, "#"), "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in rows if i < 1000 or 2000 <= i < 3000], "doc_id long, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).collect()}
    # 300 labels prove 2 % for all rules together; 50 prove nothing.
    assert {i for i, _, _ in rows} - kept == set(range(1000, 1009))
    assert {r.doc_id for r in quality.judge(docs, labels, ["doc_id"]).where("kept").collect()} == kept
