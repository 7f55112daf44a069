"""Secrets in texts: fixed patterns, and literals by the names they reach.

Base kinds ``assign access hex`` are matches of fixed patterns and always stay.
Kind ``literal`` comes from lexing the text as source or configuration:

* tokens: names, quoted literals, numbers, operators; one pass, in linear time;
* name-literal pairs: assignments of most languages (``=``, ``:=``, ``:``,
  ``=>``, comparisons, typed declarations, subscripts), configuration lines
  with bare values, setters and (name, value) arguments, XML elements and
  name/value attributes;
* constants: a name that is assigned a literal stands for it from there on, also
  through concatenation, interpolation, defaults of environment look-ups and
  wrapping calls;
* score: sensitivity of the best target name a literal reaches, times the
  strength of the literal (length of the whole it is part of, entropy,
  character classes; placeholders and examples have none). Literals that reach
  MIN_SCORE become spans.

Whole texts are read, whatever their length; only names that can be sensitive
make a text worth lexing, as without one no literal has a score.

Defined results: NULL and empty text have no spans; offsets are code points,
end exclusive; a quoted literal ends with its line; repeated rows are scanned
one by one; an empty table gives no rows; input columns stay, whatever their
names (``out`` replaces one of its name).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import read_table

# The base patterns, and the least lengths of their matches
# (of the second group, of the match).
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_LEAST = 12
# a run that is too short has no long enough run inside it: the least length
# can stand in the pattern
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

KINDS = ["assign", "access", "hex", "literal"]
BASE_KINDS = KINDS[:3]
MIN_SCORE = 0.5
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
                  ("score", pa.float64()), ("name", pa.string())])
SPAN_DDL = "array<struct<kind:string,start:int,end:int,base:boolean,score:double,name:string>>"

# Names: weight of a part, of "... key", and what a name is about if it ends so.
PARTS = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 1.0, "apikey": 1.0, "credential": 1.0,
         "credentials": 1.0, "pass": 0.9, "bearer": 0.9, "jwt": 0.9, "auth": 0.8, "authorization": 0.8, "key": 0.6}
KEY_OF = {"api", "access", "private", "secret", "auth", "encryption", "signing", "client", "master", "shared", "service", "account", "storage"}
ABOUT = {"hint", "label", "url", "uri", "path", "file", "filename", "dir", "length", "len", "size", "count", "max", "min", "type", "name",
         "field", "id", "expiry", "expires", "timeout", "ttl", "regex", "pattern", "placeholder", "message", "msg", "prompt", "help",
         "title", "public", "policy", "header", "endpoint", "format", "limit", "error"}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|-+|<.*>|\{.*\}|\$.*|%.*%|.*(?:change.?me|example|placeholder|your[-_ ]|dummy|redacted|insert|todo).*"
                         r"|password\d*|passwd|secret|token|test\w{0,4}|none|null|nil|true|false|undefined|string|0+|1234\d*)$", re.ASCII)
MAY_BE_SENSITIVE = re.compile(r"(?i:pass|pwd|secret|token|key|credential|bearer|jwt|auth)", re.ASCII)

LEX = re.compile(r"""
    (?P<nl>\n)
  | (?P<quotes>"{3}|'{3}|`{3})
  | (?P<str>(?<!\w)[bBrRuUfF]{0,2}(?:"(?:[^"\\\n]|\\(?:.|(?=\n)|\Z))*+(?:"|(?=\n)|\Z)|(?<!\w)'(?:[^'\\\n]|\\(?:.|(?=\n)|\Z))*+(?:'|(?=\n)|\Z)
                            |`(?:[^`\\\n]|\\(?:.|(?=\n)|\Z))*+(?:`|(?=\n)|\Z)))
  | (?P<id>[A-Za-z_$@](?:[\w$]|[.-](?=[A-Za-z_]))*+)
  | (?P<num>\d[\w.]*+)
  | (?P<op>=>|:=|===?|!==?|\?\?|\|\||->|::|[=:+.,;&%(){}\[\]<>/?-])
  | (?P<other>\S)
""", re.VERBOSE)
ASSIGNS = {"=", ":=", ":", "=>", "==", "==="}
BARE = re.compile(r"[^\s\"'`,;(){}\[\]<>]++(?=[ \t]*(?:$|[#;,&]))", re.MULTILINE)
ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*+)>([^<>\n]++)</")
IN_TEXT = re.compile(r"\$\{?([A-Za-z_]\w*)\}?|\{([A-Za-z_]\w*)\}")
WRAPS = re.compile(r"(?i)(?:^|[._])(?:b64decode|b64encode|decode|encode|str|bytes|string|secretstr|secret|atob|btoa|trim|strip|buffer\.from|from)$")
LOOKS_UP = re.compile(r"(?i)(?:env|environ|getenv|environ\.get|env\.get|getproperty|config\.get)$")
SETS = re.compile(r"(?i)^(?:.*\.)?(?:set|with|add)_?\w")
JOINS, CHOICES = {"+", ".", "&", "%"}, {"||", "??", "?", ":"}


def name_weight(name: str) -> float:
    """How sensitive a target of this name is, 0 to 1."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[A-Z]+", name)]
    if not parts:
        return 0.0
    best = max(PARTS.get(p, 0.0) for p in parts)
    for a, b in zip(parts, parts[1:]):
        if b in ("key", "keys") and a in KEY_OF or a == "api" and b == "key":
            best = 1.0
    return best * 0.3 if parts[-1] in ABOUT or parts[0] in ("public", "max", "min") else best


def strength(text: str, whole: int) -> float:
    """How much a literal looks like a secret, 0 to 1; ``whole`` is the length
    of what it is part of."""
    if not text or PLACEHOLDER.match(text):
        return 0.0
    counts = Counter(text)
    entropy = -sum(c / len(text) * math.log2(c / len(text)) for c in counts.values())
    classes = sum(any(test(c) for c in counts) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    value = min(whole, 12) / 12 * min(1.0, entropy / 3.0) * (1.0 if classes > 1 else 0.45)
    return value * 0.3 if any(c.isspace() for c in counts) else value


class _Value:
    """A literal (text, start, end), or values joined to one, or a choice."""
    __slots__ = ("parts", "literal", "length", "choice")

    def __init__(self, literal: tuple[str, int, int] | None = None, parts: list[_Value] = (), choice: bool = False):
        self.literal, self.parts, self.choice = literal, parts, choice
        self.length = len(literal[0]) if literal else sum(p.length for p in parts)


class _Lexer:
    """Tokens (kind, text, start, end) with look-ahead."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = LEX.finditer(text)
        self.ahead: deque = deque()

    def peek(self, k: int = 0) -> tuple[str, str, int, int]:
        while len(self.ahead) <= k:
            m = next(self.tokens, None)
            self.ahead.append((m.lastgroup, m[0], m.start(), m.end()) if m else ("end", "", len(self.text), len(self.text)))
        return self.ahead[k]

    def take(self, n: int = 1) -> None:
        for _ in range(n):
            self.peek()
            self.ahead.popleft()

    def skip_to(self, at: int) -> None:
        while self.peek()[2] < at and self.peek()[0] != "end":
            self.take()


def unquoted(token: tuple[str, str, int, int]) -> tuple[str, int, int]:
    """Content of a quoted literal and its place."""
    _, raw, start, end = token
    first = next(i for i, c in enumerate(raw) if c in "\"'`")
    last = len(raw) - (len(raw) > first + 1 and raw[-1] == raw[first])
    return raw[first + 1:last], start + first + 1, start + last


class _Pairs:
    """Name-literal pairs of one text."""

    def __init__(self, text: str):
        self.lex = _Lexer(text)
        self.constants: dict[str, _Value] = {}
        self.targets: list[tuple[float, str, _Value]] = []
        self.attribute: str | None = None

    @staticmethod
    def key(name: str) -> str:
        return name.lstrip("$@").rpartition(".")[2].lower()

    def literal(self, token) -> _Value:
        content, start, end = unquoted(token)
        own = _Value((content, start, end))
        used = [self.constants[n.lower()] for a, b in IN_TEXT.findall(content) if (n := a or b).lower() in self.constants]
        return _Value(parts=[own, *used]) if used else own

    def bind(self, name: str, value: _Value | None) -> None:
        if value is None:
            return
        self.constants[self.key(name)] = value
        if weight := name_weight(name):
            self.targets.append((weight, name, value))

    def run(self) -> list[tuple[float, str, _Value]]:
        lex = self.lex
        while (token := lex.peek())[0] != "end":
            kind, raw, start, _ = token
            if kind == "nl":
                self.attribute = None
            elif kind in ("id", "str") and self.pair(token):
                continue
            elif raw == "<" and (m := ELEMENT.match(lex.text, start)):
                self.bind(m[1], _Value((m[2], m.start(2), m.end(2))))
                lex.skip_to(m.end())
                continue
            lex.take()
        return self.targets

    def pair(self, token) -> bool:
        """Take a pair that starts here, if one does."""
        lex, used = self.lex, 1
        name = token[1] if token[0] == "id" else unquoted(token)[0]
        if lex.peek(1)[1] == "[" and lex.peek(2)[0] == "str" and lex.peek(3)[1] == "]":
            name, used = unquoted(lex.peek(2))[0], 4
        after = lex.peek(used)
        if after[1] in ASSIGNS and after[0] == "op":
            lex.take(used + 1)
            if after[1] == ":" and lex.peek()[0] == "id" and lex.peek(1)[1] == "=":
                lex.take(2)  # a declared type
            if name.lower() == "value" and self.attribute:
                name = self.attribute
            first = lex.peek()
            self.attribute = unquoted(first)[0] if name.lower() in ("name", "key", "id") and first[0] == "str" else None
            self.bind(name, self.value())
            return True
        if after[1] == "(" and token[0] == "id" and lex.peek(used + 1)[0] == "str" and SETS.match(name):
            value = self.literal(lex.peek(used + 1))
            lex.take(used + 2)
            self.bind(name, value)
            return True
        if after[1] == "," and token[0] == "str" and lex.peek(used + 1)[0] == "str" and name_weight(name):
            value = self.literal(lex.peek(used + 1))
            lex.take(used + 2)
            self.bind(name, value)
            return True
        return False

    def value(self) -> _Value | None:
        """The value that starts here; nothing if it is no literal."""
        lex, groups, parts, joined = self.lex, [], [], True
        while True:
            kind, raw, start, _ = token = lex.peek()
            if kind == "str":
                parts.append(self.literal(token))
                lex.take()
                joined = False
            elif joined and kind == "id" and lex.peek(1)[1] == "(":
                wraps, looks_up = WRAPS.search(raw), LOOKS_UP.search(raw)
                if not wraps and not looks_up:
                    break  # its arguments are pairs of their own
                lex.take(2)
                parts.extend(self.arguments(bool(looks_up)))
                joined = False
            elif joined and kind == "id" and self.key(raw) in self.constants:
                parts.append(self.constants[self.key(raw)])
                lex.take()
                joined = False
            elif joined and not parts and not groups and kind in ("id", "num", "op", "other") and (m := BARE.match(lex.text, start)):
                parts.append(_Value((m[0], m.start(), m.end())))
                lex.skip_to(m.end())
                break
            elif kind == "id" and raw == "or" or kind == "op" and raw in CHOICES and (parts or groups):
                groups.append(parts)
                parts, joined = [], True
                lex.take()
            elif kind == "op" and raw in JOINS and not joined:
                joined = True
                lex.take()
            elif kind == "nl" and joined and parts:
                lex.take()  # goes on after an operator
            elif kind == "id" and joined:
                lex.take()  # an unknown name
                joined = False
            else:
                break
        found = [g[0] if len(g) == 1 else _Value(parts=g) for g in [*groups, parts] if g]
        return None if not found else found[0] if len(found) == 1 else _Value(parts=found, choice=True)

    def arguments(self, skip_first: bool) -> list[_Value]:
        """Literals and constants up to the closing bracket or the line's end;
        the first argument of a look-up is a name, not a value."""
        lex, out, depth = self.lex, [], 1
        while depth and lex.peek()[0] not in ("nl", "end"):
            kind, raw, _, _ = token = lex.peek()
            depth += (raw == "(") - (raw == ")") if kind == "op" else 0
            if kind == "str" or kind == "id" and self.key(raw) in self.constants:
                if not skip_first:
                    out.append(self.literal(token) if kind == "str" else self.constants[self.key(raw)])
            skip_first = skip_first and raw != ","
            lex.take()
        return out


def scored_literals(text: str) -> list[tuple[int, int, float, str]]:
    """(start, end, score, name) of literals that reach a sensitive name. Every
    value is visited once, from the most sensitive name on, so that the work
    stays linear however often constants are joined."""
    if not MAY_BE_SENSITIVE.search(text):
        return []
    found: dict[tuple[int, int], tuple[float, str]] = {}
    seen: set[int] = set()
    for weight, name, value in sorted(_Pairs(text).run(), key=lambda t: -t[0]):
        stack = [(value, value.length)]
        while stack:
            v, whole = stack.pop()
            if id(v) in seen:
                continue
            seen.add(id(v))
            if v.literal:
                content, start, end = v.literal
                score = round(weight * strength(content, whole), 3)
                if score >= MIN_SCORE:
                    found.setdefault((start, end), (score, name))
            stack.extend((p, p.length if v.choice else whole) for p in v.parts)
    return [(s, e, score, name) for (s, e), (score, name) in found.items()]


def spans_of(text: str | None) -> list[dict]:
    """All spans of a text by start, then kind as listed."""
    if not text:
        return []
    out = [(m.start(), 0, m.end(), 1.0, m[1]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    out += [(m.start(), 1, m.end(), 1.0, None) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), 1.0, None) for m in HEX.finditer(text)]
    out += [(start, 3, end, score, name) for start, end, score, name in scored_literals(text)]
    return [{"kind": KINDS[k], "start": start, "end": end, "base": k < 3, "score": score, "name": name}
            for start, k, end, score, name in sorted(out, key=lambda s: s[:3])]


def with_secrets(df: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """Add ``out``: all spans as structs (kind, start, end, base, score, name)."""
    names, at = df.columns, df.columns.index(text)
    keep = [i for i, c in enumerate(names) if c != out]
    # plain names on the way through: a column's own may hold dots
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = pa.array([spans_of(t.as_py()) for t in b.column(at)], pa.list_(SPAN))
            yield pa.RecordBatch.from_arrays([b.column(i) for i in keep] + [spans], names=[*[f"c{i}" for i in keep], "found"])

    schema = plain.select(*[f"c{i}" for i in keep], F.lit(None).cast(SPAN_DDL).alias("found")).schema
    return plain.mapInArrow(scan, schema).toDF(*[names[i] for i in keep], out)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All secrets of all documents: counts of the base kinds, the digest of
    the base spans, all spans, and the number and best score of literals."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.col("text").cast("string").alias("text"))
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal", "top_score"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(spans: list[dict]) -> str:
            return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)

        for b in batches:
            rows = [spans_of(t.as_py()) for t in b.column("text")]
            n = [[sum(s["kind"] == k for s in spans) for spans in rows] for k in KINDS]
            base = [hashlib.sha256(joined([s for s in spans if s["base"]]).encode()).hexdigest() for spans in rows]
            top = [max((s["score"] for s in spans if not s["base"]), default=0.0) for spans in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, pa.int64()) for c in n[:3]], pa.array(base, pa.string()),
                 pa.array([joined(s) for s in rows], pa.string()), pa.array(n[3], pa.int64()), pa.array(top, pa.float64())], names=names)

    return docs.mapInArrow(digest, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
                                   "n_literal bigint, top_score double")
