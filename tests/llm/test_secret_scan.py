import hashlib
import random
import re
import time

import pytest

from lendspan.llm import secret_scan as scan

# the base patterns as they are stated, each match checked after it is found
STATED = (
    ("assign", r"((?a:(?i:password|passwd|secret|token|api_?key)))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)


def stated_spans(text):
    found = []
    for place, (kind, pattern, group, least) in enumerate(STATED):
        for m in re.finditer(pattern, text):
            if len(m[group]) >= least:
                found.append((m.start(group), place, m.end(group), kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def plain(spans):
    return [(s.kind, s.start, s.end) for s in spans]


def test_base_spans_equal_the_stated_patterns():
    rng = random.Random(1)
    parts = ["password", "PassWd", "secret", "ToKen", "api_key", "APIKEY", "ſecret", "toKen", '"', "'", " ", ":", "=", "AKIA",
             "ABCDEF0123", "0123456789abcdef", "abc", "=:", "é", "\n", "+/_.", "token:ab", "deadbeef"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert plain(scan.base_spans(text)) == stated_spans(text), text
        base, both = scan.all_spans(text)
        assert set(base) <= set(both)


def values(text):
    return {(s.kind, text[s.start : s.end]) for s in scan.all_spans(text)[1]}


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ('db_pwd = "Tr0ub4dor&3x"', "named", "Tr0ub4dor&3x"),
        ("const dbPassphrase: string = 'k9#mQ2vL!p'", "named", "k9#mQ2vL!p"),
        ('{"client_credentials": "f8Kx-22pQ!z"}', "named", "f8Kx-22pQ!z"),
        ("private_key: 9f8KQm2xTz77", "named", "9f8KQm2xTz77"),
        ("<passphrase>q8!Zk2$wPl</passphrase>", "named", "q8!Zk2$wPl"),
        ('<add key="DbPwd" value="h7Gq!29zLw" />', "named", "h7Gq!29zLw"),
        ("mysql --pwd s3cr3tP4ss!x", "named", "s3cr3tP4ss!x"),
        ("postgres://app:q8Zk2wPl@db.local/x", "url", "q8Zk2wPl"),
        ('config["access_key"] = "Zx81!kkQpT"', "named", "Zx81!kkQpT"),
        ('part = "f9K2x!Qz"\nname = part\nauth_key = name', "constant", "f9K2x!Qz"),
        ('a = "f9K2"\nb = "x!Qz77"\nsigning_key = a + b', "constant", "f9K2"),
        ('HEAD = "Qk28!zP"\nauth_key = f"{HEAD}"', "constant", "Qk28!zP"),
        ('master_key = LATER\nLATER = "x9!Kq27zPw"', "constant", "x9!Kq27zPw"),
        ('PWD="ab!9Kz"\nexport DB_PWD="${PWD}"', "named", "ab!9Kz"),
        ('pwd = ("Qz81kk"\n  "Lm22!x")', "named", "Lm22!x"),
        ('salt = base64.b64decode("k2J9xQ0pLmZ8")', "named", "k2J9xQ0pLmZ8"),
    ],
)
def test_assignments_reach_their_literals(text, kind, value):
    assert (kind, value) in values(text)


@pytest.mark.parametrize(
    "text",
    [
        'db_pwd = "changeme"', "pwd: ${DB_PWD}", 'pwd = os.getenv("DB_PWD")', 'passphrase_file = "/etc/keys/pass.txt"',
        "Note: the meeting = moved: to Monday", "auth: required", "max_credentials = 100000", 'pwd == "Tr0ub4dor&3x"',
        'title = "Tr0ub4dor&3x"', "see https://example.com:8080/a@b and a::b", 'pwd = "the words of a plain sentence"',
        "pwd = credentials.lookup(name)", "<passphrase>your passphrase</passphrase>", "bearer: None", "a = b\nb = a\nauth_key = a",
    ],
)
def test_clean_texts_are_left_alone(text):
    assert values(text) == set()


def test_the_nearest_definition_counts():
    text = 'k = "Aa11!!bbCC"\nother = k\nk = "plain"\nsigning_key = k\n'
    assert values(text) == set()
    assert values(text.replace("signing_key", "x").replace("other", "signing_key")) == {("constant", "Aa11!!bbCC")}


@pytest.mark.parametrize(
    "text",
    ["x = y + " * 60_000, 'a: "' * 60_000, "token" + " " * 200_000, "<a>" * 60_000, "pwd = '''" * 30_000, "k=" * 100_000,
     "a=b\nb=a\n" * 20_000, "://" * 60_000, '"' * 200_000, "x" * 400_000 + "=1", 'p = p + "q1"\npwd = p\n' * 10_000],
)
def test_odd_long_texts_take_linear_time(text):
    began = time.perf_counter()
    scan.all_spans(text)
    assert time.perf_counter() - began < 20


def test_rows_and_digest(spark):
    hexes = "0123456789abcdef01234567"
    rows = [
        (1, None, "x", 1), (2, "", "x", 1), (3, f'é token = "{hexes}"', "x", 1), (3, f'é token = "{hexes}"', "x", 1),
        (None, 'pwd = "Tr0ub4dor&3x"', "x", 1), (5, "prose only " * 2000, "x", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, base int")
    got = sorted((tuple(r) for r in scan.digest(scan.secret_spans(docs)).collect()), key=str)
    expected = []
    for doc_id, text, *_ in rows:
        base, both = scan.all_spans(text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in stated_spans(text or ""))
        counts = [sum(s.kind == k for s in base) for k in ("assign", "access", "hex")]
        expected.append(
            (doc_id, *counts, hashlib.sha256(joined.encode()).hexdigest(), ",".join(f"{s.kind}:{s.start}:{s.end}" for s in both))
        )
    assert got == sorted(expected, key=str)
    assert (3, 1, 0, 1) in {r[:4] for r in got} and any(r[-1] == "named:7:19" for r in got)
    named = spark.createDataFrame([("k", "x")], "doc_id string, text string")
    assert scan.secret_spans(named).count() == 1 and scan.secret_spans(named.limit(0)).count() == 0
