"""Secret scan of source code, configuration and prose by assignment-aware lexing.

Three base patterns give spans of their own kind: `assign` (the value after a telling word and
a separator), `access` (access key ids) and `hex` (long hexadecimal runs). The lexer adds what they
miss. It reads each text as statements of source and configuration syntax: `name = literal`,
`"name": literal`, `name: type = literal`, `<name>literal</name>`, `key="name" value="literal"`,
`--name literal` and `scheme://user:literal@host`. The right side is a chain of literals and
names, joined by `+`, `.`, `..`, `&` or side by side; templates refer to names too. A
name stands for the nearest assignment before it, else for the first one after it, so a
constant reaches the names it is passed on to. A literal counts by how sensitive the
name is that it reaches and by what it looks like; prose words and placeholders score low.

Kinds of added spans: `named` (literal of a sensitive name), `constant` (literal that reaches
one through other names) and `url` (password within a URL).
"""

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, string_texts

THRESHOLD = 0.5
KINDS = ("assign", "access", "hex", "named", "constant", "url")

# The base patterns. A match shorter than stated there is dropped after it has
# taken its characters; runs are whole, so the least length can stand in the last two patterns.
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
TELLING = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Words of a name and how strongly they call its value a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "passcode": 0.9, "pass": 0.7,
    "secret": 1.0, "secrets": 0.9, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
    "bearer": 0.9, "authorization": 0.8, "auth": 0.6, "salt": 0.6, "psk": 0.8, "privatekey": 1.0,
}
# A key is one by the word before it.
KEYS = ("api", "access", "private", "secret", "auth", "encryption", "signing", "master", "account", "shared", "license")
# Words at the end of a name that make it a description of a secret.
HARMLESS = frozenset(
    "type name file filename path url uri field length len count limit max min size expiry ttl timeout policy hint label "
    "prompt regex pattern format header env var enabled required reset column param placeholder public page form input "
    "changed error message validator title description date at age class version algorithm index".split()
)
PLACEHOLDER = re.compile(
    r"(?i)[x*.\-_#?]+|change[-_ ]?me|(?:your|my|the|some|insert|enter|example|sample|dummy|fake|test|todo|redacted|hidden)"
    r"(?:[-_ .].*)?|<.*>|\[.*\]|null|none|nil|true|false|yes|no|undefined|empty|default|password|passwd|secret|token|string|str|int|bool|bytes"
)

_OPERATOR = re.compile(r":=|=>|\+=|(?<![=!<>:+])=(?![=~>])|(?<!:):(?![:=/])")
_WINDOW = 200
# read from the operator back to the beginning
_NAME_BACK = re.compile(r"[\w$.\-]{0,99}[A-Za-z_$](?![\w$.\-])")
_TYPE = re.compile(r"[ \t]*[A-Za-z_][\w.\[\], |?]{0,60}")
_CONTINUED = re.compile(r"[ \t]*+\(?[ \t]*+(?:\\?\r?\n[ \t]*+)?")
_PREFIX = re.compile(r"(?:[rRbBuUfF@$]{1,2})?(\"\"\"|'''|\"|'|`)")
_STRING = {
    '"': re.compile(r'(?:[^"\\\n]|\\.)*+'),
    "'": re.compile(r"(?:[^'\\\n]|\\.)*+"),
    "`": re.compile(r"(?:[^`\\]|\\.)*+"),
}
_NAME = re.compile(r"[A-Za-z_$][\w$]*+(?:\.[A-Za-z_$][\w$]*+)*+")
_BARE = re.compile(r"[^\s,;#<>{}()\[\]\"'`&=:]++={0,2}")
_JOIN = re.compile(r"[ \t]*+(?:\+|\.\.?|&)?[ \t]*+(?:\\?\r?\n[ \t]*+(?=[\"'+]))?(?:\+[ \t]*+)?")
# Calls whose argument is the value itself.
_WRAPPER = re.compile(
    r"(?:str|String|bytes|b64decode|base64\.b64decode|b64encode|atob|btoa|SecretStr|Buffer\.from|quote|unquote|toBytes)\("
)
_REFERENCE = re.compile(r"\$\{(\w+)\}|#\{(\w+)\}|\{\{[ \t]*(\w+)[ \t]*\}\}|\{(\w+)\}|%\((\w+)\)s|\$(\w+)")
_TAG = re.compile(r"<([A-Za-z_][\w.:-]{0,99})>([^<>]++)</\1[ \t]*>")
_KEY_VALUE = re.compile(r"\b(?:key|name|id)[ \t]*=[ \t]*\"([^\"<>]{1,100})\"\s{1,20}value[ \t]*=[ \t]*\"([^\"<>]*)\"")
_FLAG = re.compile(r"(?<!\S)--?([A-Za-z][\w-]{0,60})[ \t]+([^\s\-\"'][^\s\"']*)")
_URL = re.compile(r"://[^\s/:@\"'<>]{0,100}:([^\s/@\"'<>]++)@")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


class Literal(NamedTuple):
    start: int
    end: int
    value: str
    bare: bool


class Assignment(NamedTuple):
    name: str
    at: int
    literals: list[Literal]
    references: list[str]


class Look(NamedTuple):
    """What the joined literals of a value look like; enough for its score."""

    length: int = 0
    characters: frozenset[str] = frozenset()
    bare: bool = True
    alone: str = ""

    def joined(self, other: "Look") -> "Look":
        if not self.length or not other.length:
            return self if self.length else other
        return Look(self.length + other.length, self.characters | other.characters, self.bare and other.bare)


def name_weight(name: str) -> float:
    """How sensitive a name is, from 0 to 1, by the words it is made of."""
    words = [w.lower() for w in _PART.findall(name)]
    if not words:
        return 0.0
    weight = max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)
    for before, word in zip(words, words[1:]):
        if word in ("key", "keys") and before in KEYS:
            weight = max(weight, 1.0)
        weight = max(weight, SENSITIVE.get(before + word, 0.0))
    if words[-1] in HARMLESS or words[0] in ("max", "min", "num", "is", "has", "public"):
        return 0.2 * weight
    return 0.7 * weight if words[-1] in ("id", "ids", "user", "username", "login") else weight


def look_weight(look: Look) -> float:
    """How much a value looks like a secret, from 0 to 1."""
    if look.length < 6 or (look.alone and PLACEHOLDER.fullmatch(look.alone)):
        return 0.0
    has = look.characters
    if any(c.isspace() for c in has):
        return 0.2
    digits, upper = any(c.isdigit() for c in has), any(c.isupper() for c in has)
    lower, other = any(c.islower() for c in has), any(not c.isalnum() for c in has)
    classes = digits + upper + lower + other
    # the more different characters, and of more classes, the less it is a word
    varied = min(1.0, math.log2(1 + len(has)) / 3.5)
    weight = varied * (0.35 + 0.3 * min(classes, 3) - (0.25 if not digits and not other else 0.0))
    return min(1.0, weight) * (0.8 if look.bare and classes < 2 else 1.0)


class _Lexer:
    """Assignments of one text."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.last = {q: text.rfind(q) for q in ('"""', "'''", "`")}

    def assignments(self) -> list[Assignment]:
        text, found = self.text, []
        for op in _OPERATOR.finditer(text):
            name = self._target(op.start(), op[0])
            if name:
                literals, references = self._value(op.end())
                if op[0] == "+=":
                    references.append(name)
                if literals or references:
                    found.append(Assignment(name, op.start(), literals, references))
        if "</" in text:
            found += [self._simple(m, m.start()) for m in _TAG.finditer(text) if m[2].strip()]
        if "value" in text:
            found += [self._simple(m, m.start()) for m in _KEY_VALUE.finditer(text) if m[2]]
        if "-" in text:
            found += [self._simple(m, m.start()) for m in _FLAG.finditer(text) if name_weight(m[1]) > 0]
        return sorted(found, key=lambda a: a.at)

    def _simple(self, match: re.Match, at: int) -> Assignment:
        value = match[2].strip()
        start = match.start(2) + match[2].index(value)
        return Assignment(match[1], at, [Literal(start, start + len(value), value, True)], [])

    def _target(self, at: int, operator: str) -> str | None:
        """The name that ends before the operator, on its line."""
        window = self.text[max(0, at - _WINDOW) : at]
        window = window[window.rfind("\n") + 1 :].rstrip(" \t")
        quoted = window.removesuffix("]").rstrip(" \t")
        if quoted.endswith(("\"", "'")):
            start = quoted.rfind(quoted[-1], 0, -1)
            return quoted[start + 1 : -1][:100] or None if start >= 0 else None
        if operator == "=":
            left, colon, kind = window.rpartition(":")
            if colon and _TYPE.fullmatch(kind):
                window = left.rstrip(" \t")
        name = _NAME_BACK.match(window[::-1])
        return name[0][::-1] if name else None

    def _value(self, at: int) -> tuple[list[Literal], list[str]]:
        """Literals and names of the right side that starts at `at`."""
        text, literals, references = self.text, [], []
        at = _CONTINUED.match(text, at).end()
        first = True
        while at < len(text):
            wrapper = _WRAPPER.match(text, at)
            if wrapper:
                at = wrapper.end()
            quote = _PREFIX.match(text, at)
            if quote:
                start, end, after = self._string(quote[1], quote.end())
                if end < 0:
                    break
                value = text[start:end]
                named = [next(filter(None, g)) for g in _REFERENCE.findall(value)] if set(value) & set("${%#") else []
                references += named
                if not named or len(_REFERENCE.sub("", value)) >= 6:
                    literals.append(Literal(start, end, value, False))
                at = after
            else:
                name = _NAME.match(text, at)
                bare = _BARE.match(text, at) if first else None
                if name and not (bare and bare.end() > name.end() and text[name.end()] not in "+&"):
                    at = name.end()
                    if at < len(text) and text[at] in "([":
                        break  # a call or a look-up gives a value that is not written here
                    references.append(name[0])
                    if first:
                        literals.append(Literal(name.start(), at, name[0], True))
                elif bare:
                    literals.append(Literal(bare.start(), bare.end(), bare[0], True))
                    break
                else:
                    break
            first = False
            if wrapper and at < len(text) and text[at] == ")":
                at += 1
            following = _JOIN.match(text, at)
            bridge = text[at : following.end()]
            at = following.end()
            if not bridge.strip() and not (at < len(text) and text[at] in "\"'"):
                break
        return literals, references

    def _string(self, quote: str, start: int) -> tuple[int, int, int]:
        """Start and end of the value of a string and what follows it; end -1 if it does not close."""
        text = self.text
        if quote in self.last and start > self.last[quote]:
            return start, -1, start
        if len(quote) == 3:
            end = text.find(quote, start)
        else:
            end = _STRING[quote].match(text, start).end()
            end = end if end < len(text) and text[end] == quote else -1
        return start, end, end + len(quote)


def _resolved(found: list[Assignment]) -> list[list[int]]:
    """Per assignment the assignments that the names of its value stand for."""
    places: dict[str, list[int]] = {}
    for k, a in enumerate(found):
        places.setdefault(a.name, []).append(k)
    before: dict[str, int] = {}
    means = []
    for k, a in enumerate(found):
        own = []
        for name in a.references:
            at = before.get(name)
            if at is None and name in places:
                at = next((p for p in places[name][:2] if p > k), None)
            if at is not None:
                own.append(at)
        means.append(own)
        before[a.name] = k
    return means


def _looks(found: list[Assignment], means: list[list[int]]) -> list[Look]:
    """What each value looks like with its names replaced; names defined later by a second pass."""
    looks = [Look()] * len(found)
    for _ in range(2):
        for k, a in enumerate(found):
            # a plain word that is the name of an assignment is that name
            known = bool(means[k])
            own = [x for x in a.literals if not (x.bare and known)]
            look = Look()
            for x in own:
                look = look.joined(Look(len(x.value), frozenset(x.value), x.bare, x.value))
            for at in means[k]:
                look = look.joined(looks[at] if at != k else Look())
            looks[k] = look
    return looks


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    name: str
    score: float


def base_spans(text: str) -> list[Span]:
    """Spans of the three base patterns by start, then kind."""
    spans = []
    lowered = text.lower()
    if any(w in lowered for w in TELLING):
        spans += [
            Span("assign", m.start(2), m.end(2), m[1], 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST
        ]
    if "AKIA" in text:
        spans += [Span("access", m.start(), m.end(), "", 1.0) for m in ACCESS.finditer(text)]
    spans += [Span("hex", m.start(), m.end(), "", 1.0) for m in HEX.finditer(text)]
    return _ordered(spans)


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def lexed_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """Spans of literals that reach a sensitive name, and of passwords in URLs."""
    best: dict[tuple[int, int], Span] = {}
    if "://" in text:
        for m in _URL.finditer(text):
            if not PLACEHOLDER.fullmatch(m[1]) and not m[1].startswith(("$", "{", "%")):
                best[m.start(1), m.end(1)] = Span("url", m.start(1), m.end(1), "", 1.0)
    if not ("=" in text or ":" in text or "</" in text or "--" in text):
        return list(best.values())
    found = _Lexer(text).assignments()
    means = _resolved(found)
    looks = _looks(found, means)
    reached: dict[int, tuple[float, str]] = {}
    queue = []
    for k, a in enumerate(found):
        weight = name_weight(a.name)
        score = weight * look_weight(looks[k]) if weight else 0.0
        if score >= threshold:
            queue.append((k, score, a.name, "named"))
    # every assignment is entered once: from its own sensitive name first, else from another's
    for k, score, name, kind in queue:
        if k in reached:
            continue
        reached[k] = (score, name)
        stack = [(k, kind)]
        while stack:
            at, how = stack.pop()
            for x in found[at].literals:
                if not (x.bare and means[at]) and (x.start, x.end) not in best:
                    best[x.start, x.end] = Span(how, x.start, x.end, name, round(score, 4))
            for to in means[at]:
                if to not in reached:
                    reached[to] = (score, name)
                    stack.append((to, "constant"))
    return list(best.values())


def all_spans(text: str, threshold: float = THRESHOLD) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: added ones are left out if a base span holds them."""
    base = base_spans(text)
    added, at, reach = [], 0, -1
    for span in sorted(lexed_spans(text, threshold), key=lambda s: s.start):
        while at < len(base) and base[at].start <= span.start:
            reach = max(reach, base[at].end)
            at += 1
        if span.end > reach:
            added.append(span)
    return base, _ordered(base + added)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())])
_SPAN_DDL = "array<struct<kind:string,start:long,end:long,name:string,score:double>>"


def secret_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Per row of `docs`: doc_id, base and found, arrays of spans (kind, start, end, name, score).

    `start` and `end` count code points, the end exclusive; `base` holds the spans of the base
    patterns, `found` these and the added ones, by start and then kind. A NULL or empty text
    has none. Every row gives a row, repeated ones too; an id may have any type and be NULL; other
    columns are not read. Names have up to 100 characters and stand on the line of their operator;
    a literal without quotes ends at white space, a bracket, a separator, `&`, `=` or `:`.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = pa.RecordBatch.from_arrays([batch.column(0), string_texts(batch, 1)], ["doc_id", "text"])
            for part in slices(batch, 1):
                pairs = [all_spans(t, threshold) for t in part.column(1).to_pylist()]
                columns = [pa.array([[s._asdict() for s in p[n]] for p in pairs], pa.list_(_SPAN)) for n in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "base", "found"])

    return chosen.mapInArrow(work, f"doc_id {kind}, base {_SPAN_DDL}, found {_SPAN_DDL}")


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def digest(found: DataFrame) -> DataFrame:
    """Per row of `secret_spans`: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
    )
