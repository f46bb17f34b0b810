import hashlib
from collections import defaultdict

import pytest

from playtide.llm import exact_dedup

from .conftest import EDGES


def expected(rows, keep):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    choose = {"smallest": min, "largest": max}[keep]
    best = {t: choose([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    return sorted((str(i), str(best[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                  for i, t in rows)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_report_on_edges(documents, keep):
    rows = EDGES + [(100 + i, "hot text") for i in range(500)]
    found = exact_dedup.copy_report(documents(rows), keep=keep).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in found) == expected(rows, keep)
    assert sum(r.kept for r in found) == len({t or "" for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_survivors_keep_all_columns(documents):
    docs = documents(EDGES)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(r.text or "" for r in rows) == sorted({t or "" for _, t in EDGES})
    assert [r.doc_id for r in rows if r.text == "same text"] == [4]
    assert {r.body for r in rows} == {"x"}


def test_normaliser(documents):
    from pyspark.sql import functions as F
    docs = documents([(1, "A b"), (2, "a B"), (3, "c")])
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(docs, normalise=F.lower).collect()) == [1, 3]


def test_empty(documents):
    assert exact_dedup.copy_report(documents([])).collect() == []
    assert exact_dedup.drop_copies(documents([])).collect() == []


def test_plan_has_no_python_and_deals_texts_by_range_once(documents):
    plan = exact_dedup.copy_report(documents(EDGES))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert plan.count("RepartitionByExpression [head") == 2  # the same twice, dealt once (see ReusedExchange)
