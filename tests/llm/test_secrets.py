import hashlib
import re

from quern.llm import secrets
from quern.llm.secrets import Ledger, scan_secrets

A = "AKIA" + "Q" * 16
TEXTS = [
    (1, f"x password = 'hunter2!' {A} {'0af' * 9}", "a"), (2, f"PassWord:abc token=abcdef/{'f' * 30}", "a"), (3, f"x password = 'hunter2!' {A} {'0af' * 9}", "b"),
    (4, f"AKIAAKIA {A}AKIA0", "b"), (5, "api_key\"  :  \"zzzzzz apikey=1234567 paſſword=1234567", "b"), (6, "\U0001f600 secret=ab.cdef -----BEGIN RSA PRIVATE KEY-----", "c"),
]


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def check(rows, pairs):
    want = sorted((str(i), *[sum(x[3] == k for x in brute(t)) for k in ("assign", "access", "hex")], hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in brute(t)).encode()).hexdigest()) for i, t, _ in pairs)
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows) == want


def test_against_brute_force(docs):
    rows = scan_secrets(docs(TEXTS)).collect()
    check(rows, TEXTS)
    assert "pem:" in next(r.spans for r in rows if r.doc_id == 6)


def test_edges(docs, edges):
    got = scan_secrets(docs(edges)).collect()
    check(got, edges)
    assert scan_secrets(docs([])).collect() == []


def test_fixture_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(scan_secrets(df).collect(), [(r.doc_id, r.text, "") for r in df.collect()])


def test_only_unseen_pairs_are_scanned(spark, docs, tmp_path, monkeypatch):
    ledger = Ledger(spark, f"file://{tmp_path}/ledger")
    ledger.add(docs(TEXTS[:3]), "v1")
    assert ledger.scanned().count() == 2 * 2  # three rows, two blobs, two rule sets
    ledger.add(docs(TEXTS[1:]), "v2")
    assert ledger.scanned().count() == 5 * 2 == ledger.scanned().distinct().count()
    check(ledger.report(docs(TEXTS[:3]), "v1").collect(), TEXTS[:3])
    check(ledger.report(docs(TEXTS[1:]), "v2").collect(), TEXTS[1:])
    ledger.add(docs(TEXTS[:3]), "v3", rules={"base": 1, "more": 2})
    assert ledger.scanned().where("rule = 'more@2'").count() == 2 and ledger.scanned().where("rule = 'base@1'").count() == 5


def test_a_version_can_be_added_again(spark, docs, tmp_path, monkeypatch):
    ledger = Ledger(spark, f"file://{tmp_path}/ledger")
    for _ in range(2):
        ledger.add(docs(TEXTS[:3]), "v/1 =")
    check(ledger.report(docs(TEXTS[:3]), "v/1 =").collect(), TEXTS[:3])
    assert ledger.paths().count() == 3 and ledger.scanned().count() == 4

    # A failure before blobs are recorded as scanned, and the same version once more.
    whole = Ledger.scanned
    monkeypatch.setattr(Ledger, "scanned", lambda self: whole(self).limit(0))
    ledger.add(docs(TEXTS), "v2")
    monkeypatch.undo()
    ledger.add(docs(TEXTS), "v2")
    check(ledger.report(docs(TEXTS), "v2").collect(), TEXTS)


def test_a_version_added_again_without_rows_is_empty(spark, docs, tmp_path):
    ledger = Ledger(spark, f"file://{tmp_path}/ledger")
    ledger.add(docs(TEXTS[:3]), "v1")
    ledger.add(docs([]), "v1")
    assert ledger.report(docs(TEXTS[:3]), "v1").collect() == [] and ledger.paths().count() == 0
    ledger.add(docs(TEXTS), "v1")
    check(ledger.report(docs(TEXTS), "v1").collect(), TEXTS)


def test_many_unseen_blobs_give_the_same(docs, monkeypatch):
    want = sorted(map(str, scan_secrets(docs(TEXTS)).collect()))
    monkeypatch.setattr(secrets, "SMALL", 0)
    assert sorted(map(str, scan_secrets(docs(TEXTS)).collect())) == want
