"""The pipeline stage by stage, each against plain Python on its own input."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketframe.llm import substring

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumns({"n_words": F.lit(1), "begin": F.lit("x"), "removed": F.lit(2)})
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], SF_DIR).write.parquet(str(folder / name))
        seen.append(spark.read.parquet(str(folder / name)))
    return seen


def by_id(df):
    rows = {r.doc_id: r for r in df.collect()}
    assert len(rows) == df.count()
    return rows


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "substring_dedup", "source_mix", "bpe"]
    for before, after in zip(stages, stages[1:-1]):
        assert [(f.name, f.dataType) for f in after.schema] == [(f.name, f.dataType) for f in before.schema]
        assert 0 < after.count() <= before.count()


def test_quality_stage_drops_what_fails_and_changes_nothing(stages):
    before, after = by_id(stages[0]), by_id(stages[1])
    assert all(after[i] == before[i] for i in after)
    assert all(len(before[i].text.split()) >= 50 for i in after)


def test_near_duplicate_stage_leaves_one_of_each_group(stages):
    from test_neardup import brute_force

    before, after = by_id(stages[1]), by_id(stages[2])
    expected = brute_force([(i, r.text) for i, r in before.items()], percent=80)
    assert set(after) == {i for i, (_, root) in expected.items() if i == root}
    assert all(after[i] == before[i] for i in after)


def test_substring_stage_cuts_the_words_found(stages):
    from test_substring import brute_force

    before, after = by_id(stages[2]), by_id(stages[3])
    expected = brute_force([(i, r.text) for i, r in before.items()], substring.WIDTH)
    assert set(after) == {i for i, (n, gone, _) in expected.items() if n > gone}
    for i, row in after.items():
        assert row.text.encode().split() == expected[i][2].encode().split() and row.n_chars == len(row.text)


def test_mix_stage_keeps_sources_near_their_targets(stages):
    from test_mixing import targets_of

    before, after = by_id(stages[3]), by_id(stages[4])
    sizes, taken = {}, {}
    for r in before.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.encode().split())
    for i, r in after.items():
        n = len(r.text.encode().split())
        taken[r.source] = taken.get(r.source, 0) + n
        assert 0 < n <= 2 * len(before[i].text.encode().split())
    for source, goal in targets_of(sizes).items():
        assert abs(taken.get(source, 0) - goal) <= 0.02 * goal + 32


def test_last_stage_and_run(spark, stages):
    from test_tokens import PATH, reference
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    before, after = by_id(stages[4]), by_id(stages[5])
    assert set(after) == set(before)
    assert all(list(after[i].ids) == reference(library, before[i].text) for i in after)
    ran = {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert ran == {(i, r.ids_sha256) for i, r in after.items()}
