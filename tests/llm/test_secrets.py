from __future__ import annotations

import re
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from watchpost.llm import secrets
from watchpost.llm.queries import op4_secret_scan

BASE = (
    ("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
     r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", "AKIA[A-Z0-9]+"),
    ("hex", "[0-9a-f]+"),
)


def brute_base(text):
    spans = []
    for order, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            enough = {"assign": len(m[m.re.groups]) >= 8, "access": len(m[0]) >= 16, "hex": len(m[0]) >= 32}
            if enough[kind]:
                spans.append((m.start(), order, kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans)]


def literals(text):
    return [text[a:z] for a, kind, z, _ in secrets.secret_spans(text) if kind == 3]


def test_query_holds_all_base_spans(spark, sf_dir):
    folder = f"{sf_dir}/../sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op4_secret_scan(spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert sum(r["n_assign"] for r in rows) and sum(r["n_hex"] for r in rows)
    for r in rows:
        base = brute_base(texts[r["doc_id"]])
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("literal")] == base
        assert r["base_sha256"] == sha256(",".join(base).encode()).hexdigest()
        kinds = [s.partition(":")[0] for s in base]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [kinds.count(k) for k in ("assign", "access", "hex")]
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), secrets.KINDS.index(s.split(":")[0])))


@pytest.mark.parametrize(
    "text",
    [
        "token=password=abcdefgh",
        "PassWord : 'aaaaaaaa' ſecret=aaaaaaaaa toKen=bbbbbbbbb",
        "é api_key=12345678 apikey:1234567 api-key=123456789",
        "AKIA" + "A" * 11 + " AKIA" + "B" * 12 + "c",
        "f" * 31 + "g" + "0a" * 16 + "F" * 40,
        'secret"=  "x.y/z+w=-_"',
        "",
    ],
)
def test_base_spans(text):
    found = [f"{secrets.KINDS[k]}:{a}:{z}" for a, k, z, _ in secrets.secret_spans(text) if k < 3]
    assert found == brute_base(text)


SECRET = "q7Rt9-xLw2pZ"


@pytest.mark.parametrize(
    "text",
    [
        f'db_password = "{SECRET}"',
        f'{{"clientSecret": "{SECRET}", "user": "bob"}}',
        f"  auth_token: {SECRET}\n  name: app",
        f"export DB_PASSPHRASE={SECRET}",
        f"signingKey := `{SECRET}`;",
        f"'private_key' => '{SECRET}',",
        f"<password>{SECRET}</password>",
        f"mysql --user bob --password {SECRET} db",
        f'config["api_key"] = "{SECRET}"',
    ],
)
def test_forms_of_assignment(text):
    assert SECRET in literals(text)


def test_constants_are_propagated():
    assert literals(f'value = "{SECRET}"\nalias = value\nclient.password = alias') == [SECRET]
    assert literals(f'value = "{SECRET}"\ncolour = value') == []
    assert literals(f'a = "{SECRET}"\nb = "tail-77Qx"\ndb_password = a + b') == [SECRET, "tail-77Qx"]
    assert literals(f"HALF={SECRET}\nAPI_TOKEN=${{HALF}}") == [SECRET]
    assert literals(f'a = b\nb = a\npassword = a\nb = "{SECRET}"') == [SECRET]


@pytest.mark.parametrize(
    "text",
    [
        'password = "changeme"', 'password = ""', "password = None", 'password_file = "/etc/x/y/z123"', "token = get_token()",
        'public_key = "abc"', f'if password == "{SECRET}": pass', "see https://example.org/token", "Note: the quick fox",
        'count = "q7Rt9-xLw2pZ"', "password = your-password-here",
    ],
)
def test_what_is_no_secret(text):
    assert literals(text) == []


def test_edge_cases(spark, documents):
    texts = [None, "", "= : =", "é" * 40_000 + f' password = "{SECRET}" ' + "word " * 40_000, "x" * 100_000, "a=" * 5000]
    docs = documents([*texts, texts[3]]).withColumn("spans", F.lit("own"))
    rows = secrets.scan_secrets(docs).orderBy("doc_id").collect()
    assert [len(r["secrets"]) for r in rows] == [0, 0, 0, 2, 0, 0, 2]
    assert rows[3]["secrets"] == rows[6]["secrets"] and rows[0]["spans"] == "own"
    assert secrets.scan_secrets(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="already have"):
        secrets.scan_secrets(docs, found="spans")
