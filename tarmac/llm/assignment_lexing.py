"""Secrets in text: fixed patterns, and literals that source or configuration gives to a sensitive name.

The lexer reads names, quoted strings and operators, and turns what assigns
into pairs of a name and the terms of its value: ``name = "…"``, ``name: …``,
``"name": "…"``, ``x["name"] = "…"``, ``name => …``, ``setName("…")``,
``put("name", "…")``, ``<name>…</name>``, ``--name …`` and the password of an
address.  A term is a literal or the name of another value.  Constants are
propagated against the direction of assignment: a literal is as sensitive as
the most sensitive name its value reaches.  That and the look of the literal
make its score.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds of spans in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "named")
THRESHOLD = 0.5

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGNED = 8

# Words of names, with how sensitive a value of that name is.
WORDS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "pass": 0.9, "secret": 1.0,
    "secrets": 1.0, "apikey": 1.0, "secretkey": 1.0, "accesskey": 1.0, "privatekey": 1.0, "authtoken": 1.0,
    "token": 0.9, "credential": 0.9, "credentials": 0.9, "authorization": 0.9, "bearer": 0.9, "mnemonic": 0.9,
    "auth": 0.6, "salt": 0.6, "signature": 0.6, "cookie": 0.6, "key": 0.45, "pin": 0.45,
}
#: Words before ``key`` or ``string`` that make it a secret one.
BEFORE_KEY = frozenset("api access secret private signing encryption auth account master shared client session service".split())
#: Last or first words of names that speak about a secret but do not hold it.
ABOUT = frozenset(
    "count length len size limit max min name file path url uri field label type format expiry expires ttl timeout index"
    " hint policy rule regex pattern prompt reset forgot is has enabled required column public id page form".split()
)
#: Values that stand in for a secret.
STAND_INS = frozenset(
    "changeme change_me example sample dummy placeholder todo none null nil true false undefined redacted secret password"
    " passwd token string text hidden required optional unknown default empty test".split()
)
#: What a text must hold for a pair with a sensitive name, in any case; texts without are not lexed.
_STEMS = "pass|pwd|secret|token|key|credential|auth|bearer|mnemonic|salt|signature|cookie|pin|connection"
_LIKELY = (
    rf"(?:{_STEMS})[\w$.\-]*[\"'`\])]*\s*(?:[:=(>]|,\s*[\"'`]|\?\?=|\|\|=|\+=)|--[\w\-]*(?:{_STEMS})[\w\-]*\s|://[^/\s:@]*:[^/\s@]+@"
)

_TOKEN = re.compile(
    r"(?P<name>[A-Za-z_$][\w$]*(?:(?:-(?!>)|\.|::|->|\?\.)[A-Za-z_$][\w$]*)*)"
    r"|(?P<quote>[\"'`])"
    r"|(?P<op>:=|=>|[=!]==?|\?\?=?|\|\|=?|\+=|[-=:+,;(){}\[\]<>/\n])",
    re.A,
)
_ASSIGNING = frozenset(("=", ":", ":=", "=>", "+=", "??=", "||="))
_SPACE = re.compile(r"[ \t]*")
_PREFIX = re.compile(r"[rbfuRBFU]{1,2}(?=[\"'`])")
_PREFIXES = frozenset(("r", "b", "f", "u", "rb", "br", "fr", "rf"))
_JOIN = re.compile(r"\s*(?:\+|\.\.|\|\||\?\?|\bor\b)\s*|[ \t]*(?=[\"'`])")
#: A value without quotes; padding of base 64 may follow it.
_BARE = re.compile(r"[^\s\"'`,;(){}\[\]<>=:]+=*")
_NAME_ONLY = re.compile(r"[A-Za-z_$][\w$]*(?:(?:\.|::|->|\?\.)[A-Za-z_$][\w$]*)*", re.A)
_INSIDE = re.compile(r"\$\{\s*([A-Za-z_]\w*)[^{}]{0,80}\}|\$([A-Za-z_]\w*)|\{\s*([A-Za-z_]\w*)[^{}]{0,80}\}|%\((\w+)\)s", re.A)
_FILLED_IN = re.compile(r"\$\{[^{}]*\}|\{\{?[^{}]*\}\}?|%\(\w+\)s|^\$\w+$", re.A)
_LOGIN = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]{0,20}://[^/\s:@\"'`<>]*:([^/\s@\"'`<>]+)@")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


@dataclass
class Term:
    """A literal at ``start`` to ``end`` of the text, quoted or not, or the ``name`` of another value."""

    start: int = 0
    end: int = 0
    quoted: bool = False
    name: str | None = None


@dataclass
class Found:
    kind: str
    start: int
    end: int
    name: str | None
    score: float


class Lexer:
    """Names, strings and operators of a text in one pass; unclosed quotes are tried once per line."""

    def __init__(self, text: str):
        self.text = text
        self.unclosed: dict[str, int] = {}
        self.line = (0, -1)
        self.tokens: list[tuple[str, str, int, int]] = []
        at = 0
        while token := _TOKEN.search(text, at):
            kind, start, at = token.lastgroup, token.start(), token.end()
            if kind == "quote":
                opens = start == 0 or not (text[start - 1].isalnum() or text[start - 1] == "_")
                prefixed = not opens and self.tokens and self.tokens[-1][3] == start and self.tokens[-1][1].lower() in _PREFIXES
                span = self.string(start) if opens or prefixed else None
                if span is None:
                    continue
                if prefixed:
                    self.tokens.pop()
                first, last, at = span
                self.tokens.append(("string", text[first:last], first, last))
            else:
                self.tokens.append((kind, token.group(), start, at))

    def string(self, at: int) -> tuple[int, int, int] | None:
        """First and last place of the content of the string that opens at ``at``, and what follows it."""
        text, quote = self.text, self.text[at]
        if text.startswith(quote * 3, at) and at >= self.unclosed.get(quote * 3, -1):
            last = text.find(quote * 3, at + 3)
            if last >= 0:
                return at + 3, last, last + 3
            self.unclosed[quote * 3] = len(text)
        if at < self.unclosed.get(quote, -1):
            return None
        if not self.line[0] <= at < self.line[1]:
            end = text.find("\n", at)
            self.line = (at, len(text) if end < 0 else end)
        line, last = self.line[1], at
        while (last := text.find(quote, last + 1, line)) >= 0:
            slashes = last
            while text[slashes - 1] == "\\" and slashes - 1 > at:
                slashes -= 1
            if (last - slashes) % 2 == 0:
                return at + 1, last, last + 1
        self.unclosed[quote] = line
        return None

    def value(self, at: int) -> list[Term]:
        """The terms of the value at ``at``: literals and names joined by ``+``, ``or``, ``||``, ``??`` or nothing."""
        text, terms = self.text, []
        at = _SPACE.match(text, at).end()
        while at < len(text):
            if prefix := _PREFIX.match(text, at):
                at = prefix.end()
            if text[at] in "\"'`":
                span = self.string(at)
                if span is None:
                    break
                first, last, at = span
                terms.append(Term(first, last, True))
            elif bare := _BARE.match(text, at):
                word = bare.group().rstrip("+")
                at += len(word)
                terms.append(Term(bare.start(), at, False, word if _NAME_ONLY.fullmatch(word) else None))
                if text.startswith("(", at):
                    terms.pop()  # the result of a call is not known
                    break
            else:
                break
            join = _JOIN.match(text, at)
            if not join:
                break
            at = join.end()
        return terms


def pairs(text: str) -> Iterator[tuple[str, list[Term]]]:
    """Every name of the text that is given a value, with the terms of that value."""
    lexer = Lexer(text)
    tokens = lexer.tokens

    def kind(k: int) -> str:
        return tokens[k][0] if 0 <= k < len(tokens) else ""

    def op(k: int) -> str:
        return tokens[k][1] if kind(k) == "op" else ""

    for k, (what, value, _, end) in enumerate(tokens):
        if what == "name":
            if op(k - 1) == "-" and op(k - 2) == "-" and text[end : end + 1] in (" ", "\t"):
                rest = _SPACE.match(text, end).end()
                if not text.startswith("-", rest):
                    yield value, lexer.value(end)
        elif what != "op":
            continue
        elif value in _ASSIGNING:
            target = k - 1
            if op(target) == "]":
                target -= 1
            if kind(target) not in ("name", "string"):
                continue
            if value == ":" and kind(k + 1) == "name" and op(k + 2) == "=":
                continue  # a declared type; the value follows it
            if value == "=" and op(target - 1) == ":" and kind(target) == "name" and kind(target - 2) == "name":
                target -= 2
            yield tokens[target][1], lexer.value(end)
        elif value == "(" and kind(k - 1) == "name" and kind(k + 1) == "string" and op(k + 2) == ")":
            yield tokens[k - 1][1], [Term(tokens[k + 1][2], tokens[k + 1][3], True)]
        elif value == "," and kind(k - 1) == "string" and op(k - 2) in ("(", "[", "{") and kind(k + 1) == "string":
            yield tokens[k - 1][1], [Term(tokens[k + 1][2], tokens[k + 1][3], True)]
        elif value == ">" and kind(k - 1) == "name" and op(k - 2) == "<":
            stop = text.find("<", end)
            if stop > end and "\n" not in text[end:stop]:
                yield tokens[k - 1][1], [Term(end, stop, True)]
    for login in _LOGIN.finditer(text):
        yield "password", [Term(login.start(1), login.end(1), True)]


def name_score(name: str) -> float:
    """How sensitive a value of this name is, 0 to 1."""
    words = [word.lower() for word in _PARTS.findall(name[-200:])]
    if not words:
        return 0.0
    score = max(WORDS.get(word, 0.0) for word in words)
    for before, word in zip(words, words[1:]):
        if (word == "key" and before in BEFORE_KEY) or (before, word) == ("connection", "string"):
            score = 1.0
    return score * 0.3 if words[-1] in ABOUT or words[0] in ABOUT else score


def literal_score(value: str, quoted: bool, spoken: bool = False) -> float:
    """How much a literal looks like a secret, 0 to 1; ``spoken`` ones may hold blanks."""
    value = _FILLED_IN.sub("", value).strip()
    low = value.lower()
    if len(value) < 6 or low in STAND_INS or len(set(value)) < 4:
        return 0.0
    if low.startswith(("your", "<", "xxx", "example", "changeme")) or low.endswith(("here", "example")):
        return 0.0
    if not spoken and any(letter.isspace() for letter in value):
        return 0.1
    if "://" in value or re.fullmatch(r"\.{0,2}/?(?:[\w\-]+/)+[\w.\-]*|[\w\-]+\.[a-z]{2,4}", value):
        return 0.2
    if value.isalpha() and any(word in low for word in ("password", "secret", "token", "contrase", "passwort")):
        return 0.1
    kinds = sum((any(c.islower() for c in value), any(c.isupper() for c in value), any(c.isdigit() for c in value), not value.isalnum()))
    bits = -sum(n * math.log2(n / len(value)) for n in Counter(value).values())
    score = (0.5 if quoted else 0.2) + 0.15 * (kinds - 1) + (0.2 if bits >= 32 else 0.1 if bits >= 20 else 0.0)
    return min(1.0, score if quoted or any(c.isdigit() for c in value) else score * 0.5)


def _last(name: str) -> str:
    """The last name of a chain: values are known by it, whatever holds them."""
    return re.split(r"\.|::|->", name)[-1]


def named_literals(text: str) -> list[Found]:
    """Literals whose value reaches a sensitive name, with that name and the score."""
    literals: list[tuple[str, Term]] = []
    given_to = defaultdict(set)  # names a value goes on to
    reach: dict[str, tuple[float, str]] = {}
    for name, terms in pairs(text):
        own = _last(name)
        score = name_score(name)
        if score > reach.get(own, (0.0, ""))[0] or own not in reach:
            reach[own] = (score, name)
        for term in terms:
            if term.name is not None:
                given_to[_last(term.name)].add(own)
            literals.append((own, term))
            if term.quoted:
                for inside in _INSIDE.finditer(text, term.start, term.end):
                    given_to[next(filter(None, inside.groups()))].add(own)
    given = set(reach)
    # constants: a name is as sensitive as the names its value goes on to
    back = defaultdict(set)
    for source, targets in given_to.items():
        for target in targets:
            back[target].add(source)
    todo = sorted(reach, key=lambda name: -reach[name][0])
    while todo:
        name = todo.pop()
        for source in back[name]:
            if reach[name][0] > reach.get(source, (0.0, ""))[0]:
                reach[source] = reach[name]
                todo.append(source)
    found: dict[tuple[int, int], Found] = {}
    for own, term in literals:
        sensitive, name = reach[own]
        if sensitive < THRESHOLD or (term.name is not None and (_last(term.name) in given or not any(c.isdigit() for c in term.name))):
            continue
        value = text[term.start : term.end]
        spoken = "phrase" in name.lower() or "mnemonic" in name.lower()
        score = sensitive * literal_score(value, term.quoted, spoken)
        before = found.get((term.start, term.end))
        if score >= THRESHOLD and (before is None or before.score < score):
            found[term.start, term.end] = Found("named", term.start, term.end, name, score)
    return list(found.values())


def base_spans(text: str) -> list[Found]:
    """Matches of the three fixed patterns, leftmost and without overlap within a pattern."""
    found = [
        Found("assign", match.start(), match.end(), match.group(1), 1.0)
        for match in ASSIGN.finditer(text)
        if len(match.group(2)) >= LEAST_ASSIGNED
    ]
    found += [Found("access", *match.span(), None, 1.0) for match in ACCESS.finditer(text)]
    return found + [Found("hex", *match.span(), None, 1.0) for match in HEX.finditer(text)]


def spans(text: str, lexed: bool = True) -> list[Found]:
    """All spans by start, then kind; what the lexer adds overlaps no fixed pattern."""
    found = base_spans(text)
    if lexed:
        taken = sorted((f.start, f.end) for f in found)
        for more in named_literals(text):
            if not any(start < more.end and more.start < end for start, end in taken):
                found.append(more)
    return sorted(found, key=lambda f: (f.start, KINDS.index(f.kind), f.end))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of every row of ``docs``: structs of ``kind``, ``start``, ``end``, ``name`` and ``score``.

    Places are code points, the end exclusive; a fixed pattern is the whole
    match, a named literal its content without quotes.  Null and empty texts
    have no spans.  Rows that share an id, or have none, are returned each;
    other columns play no part.  Whole texts are read in time linear in their
    length.  Texts that hold no pattern and no sensitive name before an
    operator are told apart in Arrow and not lexed.
    """
    kind = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            lexed = pc.fill_null(pc.match_substring_regex(texts, _LIKELY, ignore_case=True), False).to_pylist()
            fixed = pc.fill_null(pc.match_substring_regex(texts, "AKIA[A-Z0-9]{12}|[0-9a-f]{32}"), False).to_pylist()
            found = [
                [vars(f) for f in spans(text.as_py(), lex)] if lex or plain else []
                for text, lex, plain in zip(texts, lexed, fixed)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(kind))], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find, "doc_id long, spans array<struct<kind: string, start: long, end: long, name: string, score: double>>"
    )


def report(found: DataFrame) -> DataFrame:
    """The row per document of ``scan`` as counts by pattern, a digest of the fixed ones and the list of all."""

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    base = F.filter("spans", lambda s: s.kind != "named")
    return found.select(
        "doc_id",
        *(count(kind) for kind in KINDS[:3]),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )
