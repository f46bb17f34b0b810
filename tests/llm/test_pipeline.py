import random

import corpus_pipeline
import pytest

from .conftest import EDGES, prose


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, and planted ones whose fate is known by their ids."""
    rng = random.Random(8)
    folder = str(tmp_path_factory.mktemp("corpus"))
    items = [(i, prose(9000 + i, 60)) for i in range(10)]
    rows = [(i, prose(i, 150)) for i in range(400)]
    labels = [(i, 1, 0) for i in range(150)]
    for i in range(150):
        words = prose(5000 + i, 150).split(" ")
        for _ in range(2):
            words.insert(rng.randrange(len(words)), "grumpf" + rng.choice(["er", "ish", "ed"]))
        rows.append((1000 + i, " ".join(words)))
        if i < 120:
            labels.append((1000 + i, 1, 1))
    rows += [(2000 + i, rows[200 + i][1]) for i in range(20)]  # exact copies of 200 to 219
    for i in range(20):  # near copies of 230 to 249
        words = rows[230 + i][1].split(" ")
        words[rng.randrange(len(words))] = "replaced"
        rows.append((3000 + i, " ".join(words)))
    rows += [(4000 + i, prose(7000 + i, 60) + "\n" + text) for i, text in items]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4) \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_do_their_work(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    fates = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, docs, corpus), name)
        assert after.columns == docs.columns
        fates[name] = {r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in after.select("doc_id").collect()}
        docs = after
    assert len(fates["toxicity"] & set(range(1000, 1150))) >= 145
    assert len(fates["toxicity"] - set(range(1000, 1150))) <= 4
    assert fates["exact_dedup"] == set(range(2000, 2020)) - fates["toxicity"]
    assert fates["near_dedup"] == set(range(3000, 3020)) - fates["toxicity"]
    assert fates["decontamination"] == set(range(4000, 4010)) - fates["toxicity"]
    done = corpus_pipeline.STAGES[-1][1](spark, docs, corpus)
    assert done.count() == docs.count() and done.where("n_tokens <> size(ids)").count() == 0


@pytest.mark.parametrize("rows", [EDGES, []], ids=["edges", "empty"])
def test_stages_on_edges(spark, documents, corpus, rows):
    docs = documents(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, corpus)
        assert docs.columns == documents([]).columns
    kept = corpus_pipeline.STAGES[-1][1](spark, docs, corpus).collect()
    assert len(kept) <= len(rows)
    if rows:
        assert {-10, 4, 7, 8, 9} <= {r.doc_id for r in kept} and 5 not in {r.doc_id for r in kept}
