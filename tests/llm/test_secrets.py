import hashlib
import random
import re

from agroflow.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def listed(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def weak_spans(text, scope=secrets.SCOPE):
    """All weak candidates outside base spans, each compared with every other part."""
    base = base_spans(text)
    parts = [(m.start(), m.end(), "weak") for m in ASSIGN.finditer(text) if len(m[2]) < 6]
    for kind in ("ident", "weak", "endpoint"):
        for m in re.finditer(secrets.PATTERNS[kind].replace("(?i:", "(?:"), text, 0 if kind == "weak" else re.I | re.A):
            if kind != "weak" or all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]")):
                parts.append((m.start(), m.end(), kind))
    parts = [p for p in parts if not any(a < p[1] and b > p[0] for a, _, b, _ in base)]
    others = [(a, b, "name" if k == "access" else "secret") for a, _, b, k in base]
    others += [(a, b, "name" if k == "ident" else "secret") for a, b, k in parts if k != "endpoint"]
    out = []
    for a, b, kind in set(parts):
        near = {k for c, d, k in others if c - b <= scope and a - d <= scope}
        if kind == "ident" and "secret" in near or kind == "weak" and "name" in near or near == {"name", "secret"}:
            out.append((a, secrets.KINDS.index(kind), b, kind))
    return out


def wanted(doc_id, text):
    text = text or ""
    base = base_spans(text)
    n = [sum(s[3] == k for s in base) for k in ("assign", "access", "hex")]
    return (doc_id, *n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(sorted(base + weak_spans(text))))


def sample(rng):
    bits = ["pass", "Password: ", "token = \"", "API_KEY='", "apikey=", "é😀", " ", "\n", "AKIA", "ABCDEFGH12345678", "0123456789abcdef" * 2,
            "user=bob ", "login: al.ice ", "https://db.example.com/x ", "host=db.internal ", "Zx9" * 8, "abc", "==", "secret:x1 ", "lorem ipsum " * 5, "\x0b", "İ", "ſecret=abcdefgh "]
    return "".join(rng.choice(bits) for _ in range(rng.randrange(40)))


def test_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, sample(rng)) for i in range(400)]
    rows += [(900, None), (901, ""), (902, rows[3][1]), (3, rows[3][1]), (None, "password=abcdefg"), (903, "x" * 50_000 + " secret: hunter2x " * 3000)]
    df = spark.createDataFrame([(a, b, "k", 0) for a, b in rows], "doc_id long, text string, kind string, start int")
    got = secrets.span_digests(df).collect()
    key = lambda t: (t[0] is None, t)
    assert sorted(map(tuple, got), key=key) == sorted((wanted(*r) for r in rows), key=key)
    assert any("ident" in r.spans for r in got) and any("endpoint" in r.spans for r in got) and any("weak" in r.spans for r in got)


def test_weak_parts_need_complements(spark):
    df = spark.createDataFrame([(1, "user=bob and nothing else"), (2, "user=bob password: abc"), (3, "user=bob " + "x " * 200 + "password: abc")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.span_digests(df).collect()}
    assert got == {1: "", 2: "ident:0:8,weak:9:22", 3: ""}


def test_redaction_keeps_rows(spark):
    text = "é user=bob password: abc and token=0123456789abcdef0123456789 end"
    df = spark.createDataFrame([(1, text, 9), (1, text, 9), (2, "clean", 5), (3, None, None), (None, "token=abcdefgh", 14)], "doc_id long, text string, n_chars long")
    for limit in (0, 1 << 20):
        got = sorted(map(tuple, secrets.redact(df, broadcast_bytes=limit).collect()), key=str)
        masked = "é [REDACTED] [REDACTED] and [REDACTED] end"
        assert got == sorted([(1, masked, len(masked)), (1, masked, len(masked)), (2, "clean", 5), (3, None, None), (None, "[REDACTED]", 10)], key=str)


def test_no_python_in_the_plan(spark, plan_of):
    df = spark.createDataFrame([(1, "token=abcdefgh")], "doc_id long, text string")
    assert "Arrow" not in plan_of(secrets.span_digests(df)) and "Python" not in plan_of(secrets.span_digests(df))


def test_empty_table(spark):
    assert secrets.span_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sql_gives_the_same_rows(spark, tmp_path):
    import duckdb

    from agroflow.llm.oracles import SECRETS

    rng = random.Random(9)
    rows = [(i, sample(rng)) for i in range(300)] + [(301, None), (302, ""), (3, rows_text := sample(rng)), (3, rows_text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.coalesce(1).write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    theirs = con.execute(SECRETS).fetchall()
    assert sorted(theirs) == sorted(map(tuple, secrets.span_digests(df).collect()))
