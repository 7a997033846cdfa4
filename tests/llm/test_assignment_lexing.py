"""Fixed patterns against the contract's own, and what the lexer makes of source and configuration."""

import hashlib
import random
import re
import time

import pytest

from tarmac.llm import assignment_lexing as al
from tarmac.llm.tables import table

ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def expected(text):
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda f: (f[1], al.KINDS.index(f[0])))


def test_given_documents_and_edge_rows(spark, small, edge_docs, no_docs):
    for docs in (table(spark, small, "documents"), edge_docs):
        texts = sorted(((str(r.doc_id), r.text) for r in docs.collect()), key=str)
        found = al.scan(docs)
        spans = sorted(((str(r.doc_id), [(s.kind, s.start, s.end) for s in r.spans if s.kind != "named"]) for r in found.collect()), key=str)
        assert spans == sorted(((i, expected(t)) for i, t in texts), key=str)
        for row in al.report(found).collect():
            base = [x for x in row.spans.split(",") if x and not x.startswith("named")]
            assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
            assert [row.n_assign, row.n_access, row.n_hex] == [sum(x.startswith(k) for x in base) for k in al.KINDS[:3]]
    assert al.report(al.scan(no_docs)).collect() == []


def test_fixed_patterns_on_random_text():
    draw = random.Random(4)
    bits = ["password", "SECRET", "token", "apiKey", "API_KEY", "paſſword", "toKen", "=", ":", " ", "  ", '"', "'", "é", "👍", "AKIA", "\n"]
    bits += ["ABCDEF123456", "abcdef0123456789", "0123456789abcdef" * 2, "short", "longer_value", "passwd", "==", "x"]
    for _ in range(4_000):
        text = "".join(draw.choice(bits) for _ in range(draw.randint(1, 25)))
        assert [(f.kind, f.start, f.end) for f in sorted(al.base_spans(text), key=lambda f: (f.start, al.KINDS.index(f.kind)))] == expected(text)


SECRETS = [
    ('db_pwd = "hunter2!xyz"', ["hunter2!xyz"]),
    ("AWS_PASSPHRASE='kT9#mm2Lq0'", ["kT9#mm2Lq0"]),
    ("export SERVICE_PWD=kT9mm2Lq0z", ["kT9mm2Lq0z"]),
    ('{"user": "bob", "dbPass": "p4$$w0rdZZ"}', ["p4$$w0rdZZ"]),
    ("client_credentials: 'q8Zr-77ab'", ["q8Zr-77ab"]),
    ('config["signing_key"] = "Zx81kQ00pp"', ["Zx81kQ00pp"]),
    ("accessKey => 'Zx81kQ00pp'", ["Zx81kQ00pp"]),
    ("const dbPwd: string = `Zx81kQ00pp`;", ["Zx81kQ00pp"]),
    ("pwd: str = 'Zx81kQ00pp'", ["Zx81kQ00pp"]),
    ('conn.setPwd("Zx81kQ00pp")', ["Zx81kQ00pp"]),
    ('headers.put("Authorization", "Bearer-Zx81kQ00pp")', ["Bearer-Zx81kQ00pp"]),
    ("<dbPwd>Zx81kQ00pp</dbPwd>", ["Zx81kQ00pp"]),
    ("mysql --pwd Zx81kQ00pp --host db", ["Zx81kQ00pp"]),
    ('url = "postgres://app:Zx81kQ00pp@db.example.org/x"', ["Zx81kQ00pp"]),
    ('pwd = "Zx81" "kQ00ppAB99"', ["kQ00ppAB99"]),
    ('pwd = os.environ.get("PWD") or "x"\nos.getenv("DB_PWD", "Zx81kQ00pp")', ["Zx81kQ00pp"]),
    # constants, in either order, over several names, through joins and templates
    ('base = "Zx81kQ00pp"\ndb_pwd = base', ["Zx81kQ00pp"]),
    ('login(pwd=FIRST)\nSECOND = "Zx81kQ00pp"\nFIRST = SECOND', ["Zx81kQ00pp"]),
    ('part = "Zx81kQ00pp"\npwd = part+"-9911aaQQ"', ["Zx81kQ00pp", "-9911aaQQ"]),
    ('part = "Zx81kQ00pp"\npwd = f"{part}!"', ["Zx81kQ00pp"]),
    ('self.base = r"Zx81kQ00pp"\nself.db_pwd = self.base', ["Zx81kQ00pp"]),
    ('pwd = """Zx81kQ00pp"""', ["Zx81kQ00pp"]),
    ('pwd = "Zx\\"81kQ00pp"', ['Zx\\"81kQ00pp']),
]

CLEAN = [
    'base = "Zx81kQ00pp"\nusername = base',
    'pwd = "changeme"',
    'pwd = "<your password>"',
    'pwd = "${DB_PWD}"',
    "pwd = os.environ['DB_PWD']",
    "pwd = getpass('Enter the pass word: ')",
    'pwd_file = "/etc/app/db9.pwd"',
    "max_tokens = 4096123",
    'token_type = "Bearer12345"',
    'public_key = "Zx81kQ00pp"',
    "The secret of success: hard work, 12 hours a day. Don't tell; it isn't a token.",
    "password: the word that lets you pass",
    'type = "password"',
    '"pwd": null, "x": 1',
    'pwd = "aaaaaaaaaaaa"',
    "keyboard = 'Zx81kQ00pp'",
]


@pytest.mark.parametrize("text, values", SECRETS)
def test_named_literals(text, values):
    assert [text[f.start : f.end] for f in sorted(al.named_literals(text), key=lambda f: f.start)] == values


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts(text):
    assert al.named_literals(text) == []


def test_the_lexer_adds_what_no_pattern_covers(spark):
    text = 'token = "Zx81kQ00pp"\nü👍 = 1\nbase = "Yy72-mm31Q"\ndb_pwd = base\n'
    assert [(f.kind, text[f.start : f.end]) for f in al.spans(text)] == [("assign", 'token = "Zx81kQ00pp'), ("named", "Yy72-mm31Q")]
    frame = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(SECRETS)], "doc_id long, text string").repartition(3)
    for row in al.scan(frame).collect():
        text, values = SECRETS[row.doc_id]
        assert [text[s.start : s.end] for s in row.spans if s.kind == "named"] == values


def test_planted_in_prose():
    """A span in a long text is the same whatever stands around it."""
    prose = "Don't stop: it's \"quoted\" and 'so on', (see above) = more; l'été d'un côté. " * 200
    for text, values in SECRETS:
        whole = prose + "\n" + text + "\n" + prose
        assert [whole[f.start : f.end] for f in sorted(al.named_literals(whole), key=lambda f: f.start)] == values


ODD = ['pwd="', "pwd='\\", '"', "'\"`", "pwd=a+", "pwd:", "<pwd>", "--pwd x", "pwd(", 'pwd = "a" + ', "((", "pwd = $a ${", "\\'", "a.b.", "://a:", "x-", "pwd['a'"]


@pytest.mark.parametrize("part", ODD)
def test_long_odd_texts_take_linear_time(part):
    started = time.process_time()
    al.spans(part * (400_000 // len(part)))
    assert time.process_time() - started < 6
