"""Spans against Python's re, and links against a plain loop over all pairs of parts."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from wardflow.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
WEAK = {"identifier": secrets.IDENTIFIER, "secret": secrets.SECRET, "endpoint": secrets.ENDPOINT}


def plain(text, scope):
    text = text or ""
    base = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    base += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    base += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    weak = [(m.start(), 3 + i, k, m.end()) for i, (k, p) in enumerate(WEAK.items()) for m in re.compile(p, re.A).finditer(text)]
    roles = [(secrets.ROLE[k], a, b) for a, _, k, b in base + weak]

    def ok(a, k, b):
        partner = {"secret": ("identifier", "endpoint")}.get(secrets.ROLE[k], ("secret",))
        return any(r in partner and x - scope < b and a < y + scope for r, x, y in roles)

    return sorted(base), sorted(base + [w for w in weak if ok(w[0], w[2], w[3])])


def written(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


def texts():
    r = random.Random(2)
    bits = ["password: ", "PassWd=\"", "token=", "api_key='", "secret : ", "password: \"token: ", "AKIA", "AKIAABCDEFGHIJKLMN", "AKIAx", "0123456789abcdef", "deadbeef", "user=bob ", "client_id: c-77 ",
            "https://h.example/x ", "pwd=abc123 ", "abcdefghijkl", "é中\U0001f600 ", "\n", " ", "x" * 40, "short", "A1B2", "= ", "ffff" * 9]
    out = ["".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(150)]
    return [None, "", *out, "password=" + "a" * 50000, "user=bob " * 4000 + "pwd=hunter22", "AKIA" * 30, "secret" * 9000]


def test_spans_and_links(spark):
    data = [(i, t, "clash") for i, t in enumerate(texts())]
    data += [(None, "user=bob pwd=hunter22", "n"), (3, "token=abcdefghijklmnop", "d"), (3, "token=abcdefghijklmnop", "d")]
    docs = spark.createDataFrame(data, "doc_id long, text string, spans string")
    got = sorted((g.doc_id if g.doc_id is not None else -1, g.n_assign, g.n_access, g.n_hex, g.base_sha256, g.spans) for g in secrets.digests(secrets.scan(docs, scope=40)).collect())
    want = []
    for doc_id, t, _ in data:
        base, spans = plain(t, 40)
        n = [sum(k == kind for _, _, k, _ in base) for kind in ("assign", "access", "hex")]
        want.append((doc_id if doc_id is not None else -1, *n, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
    for g, w in zip(got, sorted(want), strict=True):
        assert g == w


def test_weak_parts_need_a_partner(spark):
    docs = spark.createDataFrame([(1, "user=bob"), (2, "user=bob and pwd=hunter22"), (3, "user=bob" + " " * 500 + "pwd=hunter22"), (4, "pwd=hunter22"), (5, "see https://h.example/x")], "doc_id long, text string")
    got = {g.doc_id: g.spans for g in secrets.digests(secrets.scan(docs)).collect()}
    assert got == {1: "", 2: "identifier:0:8,secret:13:25", 3: "", 4: "", 5: ""}


def test_redaction_and_empty(spark):
    docs = spark.createDataFrame([(1, "é user=bob pwd=hunter22 end", 5), (2, None, 6), (3, "clean", 7), (None, "token=abcdefghijklmnop", 8)], "doc_id long, text string, spans int")
    got = {g.spans: g.text for g in secrets.redacted(docs).collect()}
    assert got == {5: "é [identifier] [secret] end", 6: None, 7: "clean", 8: "[assign]"}
    assert secrets.digests(secrets.scan(docs.limit(0))).collect() == [] and secrets.redacted(docs).columns == docs.columns
    assert F is not None
