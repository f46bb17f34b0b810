import hashlib
import math
import random
import re

from playtide.llm import pii

from .conftest import EDGES, prose

CASES = ["write to a.b@c.de or x@y", "a@b.com.x@y.z c_d@e.f", "1.2.3.4 256.1.1.1 1.2.3.4.5 001.02.3.255",
         "4111 1111 1111 1111 and 4111-1111-1111-1112 and 49927398716", "+1 (617) 555-0199 +12 +44 20 7946 0958 99999999",
         "ä1@ü.de ééé a@b.c", "+" + "1" * 40, "1" * 5000, "9" * 5000 + ".1.1.1", "..@..", ""]


def plain_spans(text):
    """The contract's words, one by one."""
    found = []
    for rank, (kind, pattern, good) in enumerate([
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             lambda m: all(len(p) < 4000 and int(p) <= 255 for p in m.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub(r"\D", "", m)) <= 19 and check(re.sub(r"\D", "", m))),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15)]):
        found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if good(m.group())]
    return [s for *_, s in sorted(found)]


def check(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def sample(count=300):
    rng = random.Random(6)
    pieces = [*CASES, "+4915112345678", "192.168.0.1", "4012888888881881", "me@example.org", "@", "+", "12"]
    return [(i, " ".join(rng.choices([*pieces, *prose(i).split()], k=rng.randint(0, 30)))) for i in range(count)]


def test_query_against_the_contract(spark, documents, tmp_path):
    from playtide.llm import queries
    rows = [(i, t) for i, t in EDGES + list(enumerate(CASES, 500)) + [(i + 1000, t) for i, t in sample()]]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op6_pii"](spark, str(tmp_path)).collect()
    key = lambda i, n, h: (str(i), *n, h)
    wanted = []
    for i, t in rows:
        spans = plain_spans(t or "")
        wanted.append(key(i, [sum(s.startswith(k) for s in spans) for k in pii.KINDS[:4]],
                          hashlib.sha256(",".join(spans).encode()).hexdigest()))
    assert sorted(key(r.doc_id, (r.n_email, r.n_ip, r.n_card, r.n_phone), r.base_sha256) for r in found) == sorted(wanted)
    for r in found:
        base = [s for s in r.spans.split(",") if s and not s.startswith("term")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256


def leaking():
    """Eight texts that name the owner beside the address, many that don't; common words everywhere."""
    rows = [(i, f"{prose(i, 60)} mail Zebulon at zed@zoo.org today {prose(i + 50, 60)}") for i in range(8)]
    return rows + [(100 + i, prose(300 + i, 80) + (" mail at today" if i % 2 else "")) for i in range(150)]


def test_disclosing_terms(documents):
    rows = leaking()
    found = {r.doc_id: r for r in pii.protect(documents(rows)).collect()}
    texts = dict(rows)
    for i, row in found.items():
        hidden = {texts[i][t.start:t.stop].lower() for t in row.terms}
        assert ("zebulon" in hidden) == (i < 8) and "mail" not in hidden and "today" not in hidden
    share = [t.share for t in found[0].terms if texts[0][t.start:t.stop] == "Zebulon"][0]
    n = len(rows)
    assert math.isclose(share, math.log2(n * 8 / (8 * 8)) / math.log2(n / 8))


def test_copies_of_one_text_prove_nothing(documents):
    rows = [(i, "call Zebulon under zed@zoo.org now") for i in range(50)] + [(100 + i, prose(i)) for i in range(50)]
    assert all(r.terms == [] for r in pii.protect(documents(rows)).collect())


def test_a_name_beside_one_number_is_hidden(documents):
    rows = [(i, "call Zebulon under +1 617 555 0199 now") for i in range(3)]  # copies count once
    rows += [(100 + i, f"call me now under the {prose(i, 20)}") for i in range(400)]
    for row in pii.protect(documents(rows)).collect():
        assert {dict(rows)[row.doc_id][t.start:t.stop] for t in row.terms} == ({"Zebulon"} if row.doc_id < 3 else set())


def test_terms_are_counted_and_hidden_in_the_whole_text(documents):
    text = "call Zebulon under +1 617 555 0199 now " + "call me now " * 10 + "Zebulon call Quuxby"
    rows = [(1, text)] + [(100 + i, f"call me now under the {prose(i, 20)}") for i in range(400)]
    found = {r.doc_id: [text[t.start:t.stop] for t in r.terms] for r in pii.protect(documents(rows)).collect() if r.terms}
    assert found == {1: ["Zebulon", "Zebulon", "Quuxby"]}


def test_term_counts_are_exact_behind_the_filter(spark, monkeypatch):
    monkeypatch.setattr(pii, "BITS", 8)  # nearly every word passes the filter
    texts = spark.createDataFrame([(i, prose(i, 40)) for i in range(30)] + [(3, prose(3, 40))], "text_key bigint, text string")  # one text twice
    terms = spark.createDataFrame([("the",), ("on",), ("nowhere",)], "term string")
    counts = {r.term: r.n_term for r in pii.term_texts(texts, terms).collect()}
    words = [set(re.findall(r"[^\W_]+", prose(i, 40).lower())) for i in [*range(30), 3]]
    assert counts == {w: n for w in ("the", "on", "nowhere") if (n := sum(w in s for s in words))}


def test_sanitised_text(documents):
    docs = documents(leaking() + EDGES)
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(leaking()) + len(EDGES)
    for r in clean.where("doc_id between 0 and 7 and text like '%mail%'").collect():
        assert "[email]" in r.text and "Zebulon" not in r.text and "zed@" not in r.text
    untouched = {r.doc_id: r.text for r in clean.where("doc_id >= 100").collect()}
    assert untouched == {i: t for i, t in leaking() if i >= 100}


def test_empty(documents):
    assert pii.protect(documents([])).collect() == []
    assert pii.sanitise(documents([])).collect() == []
