"""The ledger of scanned contents, and its findings against plain searches."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.corpus import frame, odd_rows
from tidemark.llm import secret_scans as secrets

KEY = "AKIA" + "Q7" * 8
TEXTS = [
    "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" and more",
    "é\U0001f600 PassWord:'hunter2' passwd= short Api_Key==abcdef APIKEY : a.b-c/d+e",
    f"{KEY} xAKIA{'B' * 15} {KEY}{KEY} AKIA{'C' * 16}",
    "a" * 23 + " " + "0" * 24 + "g" + "f" * 100,
    "toſecret=abcdefg Key apikey=abcdefg",  # letters that fold to s and k are others
    "secret\n= abcdefg secret =\tabcdefg secret  =  \"  abcdefg",
    "tokentoken=tokens: secret=abc",
]


def plain(text):
    """The contract word by word."""
    text = text or ""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    cased = re.sub("[a-z]+", lambda m: "".join(f"[{c}{c.upper()}]" for c in m.group()),
                   assign[: assign.index(")")]) + assign[assign.index(")") :]
    found = [
        (m.start(), 0, f"assign:{m.start()}:{m.end()}")
        for m in re.finditer(cased, text)
        if len(m[2]) >= 6
    ]
    for place, (kind, pattern, least) in enumerate(
        [("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)], 1
    ):
        found += [
            (m.start(), place, f"{kind}:{m.start()}:{m.end()}")
            for m in re.finditer(pattern, text)
            if len(m[0]) >= least
        ]
    return ",".join(text for *_, text in sorted(found))


@pytest.fixture
def ledger(spark, tmp_path):
    return secrets.BlobLedger(spark, str(tmp_path / "ledger"))


def found(docs, ledger, **kwargs):
    rows = secrets.digest_columns(secrets.secret_scan(docs, ledger, **kwargs)).collect()
    return sorted(((row.doc_id, row.spans) for row in rows), key=str)


@pytest.mark.parametrize("most", [0, 200_000])
def test_equals_plain_searches(spark, ledger, monkeypatch, most):
    monkeypatch.setattr(secrets, "BROADCAST_BLOBS", most)
    rows = [*odd_rows(), *enumerate(TEXTS, 50), *enumerate(TEXTS, 90)]
    expected = sorted(((i, plain(text)) for i, text in rows), key=str)
    assert found(frame(spark, rows), ledger) == expected
    assert found(frame(spark, rows), ledger, hot_rows=1) == expected
    assert secrets.secret_scan(frame(spark, []), ledger).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("tokensecrapiywd_=: \"'\nAKI0f9ſ"), max_size=60))
def test_any_text(text):
    spans = secrets.spans_of(text, secrets.RULES)
    order = [rule.name for rule in secrets.RULES]
    ordered = sorted(spans, key=lambda span: (span["start"], order.index(span["rule"])))
    as_text = ",".join(f"{s['rule'].split(':')[0]}:{s['start']}:{s['end']}" for s in ordered)
    assert as_text == plain(text)


def test_only_unseen_pairs_are_scanned(spark, ledger):
    rules = [*secrets.RULES, secrets.Rule("phone", 1, r"\d{7,}")]
    first = secrets.addressed(frame(spark, [(1, "token=abcdef 1234567"), (2, "x"), (3, "x")]))
    later = secrets.addressed(frame(spark, [(2, "token=abcdef 1234567"), (4, "y 7654321")]))

    def scanned(rows, own):
        n_blobs = secrets.scan_unseen(rows, rows.select("doc_id", "blob"), ledger, own)
        rows = ledger.read().collect()
        return n_blobs, sum(len(row.rules) for row in rows)

    assert scanned(first, secrets.RULES) == (2, 6)
    assert scanned(first, secrets.RULES) == (0, 6)
    assert scanned(later, secrets.RULES) == (1, 9)
    assert scanned(later, rules) == (2, 11)
    newer = [*secrets.RULES[1:], secrets.Rule("assign", 2, "token=(\\w+)", 1, 3)]
    assert scanned(later, newer) == (2, 13)
    docs = frame(spark, [(2, "token=abcdef 1234567"), (4, "y 7654321"), (5, "x")])
    before = {row.doc_id: row.spans for row in secrets.secret_scan(docs, ledger, rules).collect()}
    assert [tuple(span) for span in before[2]] == [("assign", 0, 12), ("phone", 13, 20)]
    ledger.compacted(rules)
    n_blobs = ledger.read().count()
    assert n_blobs == ledger.read().select("blob").distinct().count() == 3
    again = {row.doc_id: row.spans for row in secrets.secret_scan(docs, ledger, rules).collect()}
    assert again == before and ledger.read().count() == n_blobs
    # The newer rule was left out when the ledger was made compact
    assert scanned(later, newer)[0] == 2


def test_an_unfinished_scan_is_not_read(spark, ledger):
    docs = frame(spark, [(1, "token=abcdef")])
    secrets.secret_scan(docs, ledger)
    version = ledger.commits.next_version()
    ledger.read().write.parquet(f"{ledger.path}/v={version}")
    assert ledger.read().count() == 1
    assert found(frame(spark, [(2, "secret=abcdef")]), ledger) == [(2, "assign:0:13")]
