"""Secret scan with an assignment-aware lexer.

Three base patterns run over the whole text. On top of them the text is lexed into
name-literal pairs, as source code and configuration files write them (NAME = "x",
name: x, "name": "x", NAME: type = "x", table["name"] = "x", export NAME=x,
<name>x</name>, --name x, scheme://user:x@host). Literals are bare, quoted with escapes,
or triple quoted; literals that stand side by side or are added up are one value. A
general name within braces (value, data) goes by the name the braces are bound to.
Literals bound to a name are constants: a later sensitive name bound to such a name, or
to $NAME, ${NAME} or %NAME%, marks the constant's literal (kind const), and concatenated
constants are followed as well. A literal is scored by the sensitivity of its target
name and by its own shape; literals at or above the threshold are added as kind literal.
Base spans always stay.

Edge cases: a null text counts as empty; the base spans of a kind never overlap;
names are compared without regard to letter case; a constant is the last literal that
was bound to its name before the use.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the base rules.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run matches whole, so shorter runs need not be visited
MIN_ASSIGN, MIN_ACCESS = 6, 20

# How sensitive the parts of a name are; the largest counts.
NAME_SCORE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.8, "credentials": 0.8,
    "auth": 0.6, "private": 0.6, "access": 0.5, "key": 0.5, "signature": 0.5, "salt": 0.5,
    "privatekey": 1.0, "accesskey": 1.0, "authkey": 1.0, "signingkey": 1.0, "encryptionkey": 1.0,
}
THRESHOLD = 1.2  # name score plus literal score
PLACEHOLDERS = ("none", "null", "true", "false", "changeme", "example")
LONGEST_PLACEHOLDER = max(map(len, PLACEHOLDERS))
_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*+"
_STRING = r"""(?:\"{3}(?P<td>.+?)\"{3}|'{3}(?P<ts>.+?)'{3}|"(?P<dq>(?:[^"\\\n]|\\.)++)"|'(?P<sq>(?:[^'\\\n]|\\.)++)'"""
_BARE = r"""[^\s"'<>,;(){}\[\]]"""
_REFERENCE = rf"(?:\$\{{{_NAME}\}}|\$[A-Za-z_][A-Za-z0-9_]*+|%[A-Za-z_][A-Za-z0-9_]*+%)(?!{_BARE})"
_LITERAL = rf"{_STRING}|(?P<ref>{_REFERENCE})|(?P<bare>{_BARE}++))"
_KEY = rf"""["']?(?P<name>{_NAME}(?:\[["']?[A-Za-z0-9_.\-]++["']?\])*+)["']?"""
_MARK = r"(?::=|=>|[:=])"
#: A name, perhaps subscripts and a type, a binding mark, then a string, a reference or a bare literal.
PAIR = re.compile(rf"(?<![A-Za-z0-9_.\-]){_KEY}(?:[ \t]*+:[ \t]*+[A-Za-z_][\w.]*+(?=[ \t]*+=[^=]))?+[ \t]*+{_MARK}[ \t]*+{_LITERAL}", re.S)
#: An element whose content is text only, with or without a name space and attributes.
ELEMENT = re.compile(rf"<(?:{_NAME}:)?(?P<name>{_NAME})(?:\s[^<>]*+)?>\s*+(?P<xml>[^<>]*[^<>\s])\s*+</(?:{_NAME}:)?(?P=name)\s*+>")
#: An option of a command line, its value after white space or an equals sign.
OPTION = re.compile(rf"(?<![A-Za-z0-9_.\-])(?:--(?P<name>{_NAME})(?:[ \t]*+=[ \t]*+|[ \t]++(?!-))|-(?P<short>{_NAME})=){_LITERAL}", re.S)
#: The password of a user in an address.
ADDRESS = re.compile(r"://[^\s:@/\"'<>]++:(?P<url>[^\s@/\"'<>]++)@")
#: Braces, and the name they are bound to.
BRACE = re.compile(rf"(?<![A-Za-z0-9_.\-]){_KEY}\s*+{_MARK}\s*+(?P<open>\{{)|(?P<brace>[{{}}])")
#: What may follow a string: a string side by side or added, or an added name.
JOIN = re.compile(rf"""[ \t]*+(?:\\\n|\+)?[ \t]*+{_STRING})|[ \t]*+\+[ \t]*+(?P<more>{_NAME})""", re.S)
REFERENCE = re.compile(rf"\$\{{({_NAME})\}}\Z|\$([A-Za-z_]\w*)\Z|%([A-Za-z_]\w*)%\Z")
#: Values that stand for another one.
STANDS_FOR = re.compile(r"<.*>\Z|\$?\{.*\}\Z|\$\w+\Z|%\(?\w*\)?[a-z%]?\Z", re.S)
GENERAL = {"value", "val", "data", "raw", "text", "string", "content", "default", "literal", "plain"}
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_IDENT = re.compile(rf"{_NAME}\Z")
_BINDS = re.compile(r"[:=]|--|</")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the three base patterns, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN] if _BINDS.search(text) else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def name_score(name: str) -> float:
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max((NAME_SCORE.get(p, 0.0) for p in parts + joined), default=0.0)


def literal_score(value: str) -> float:
    """0 to 1: long mixed strings score high, prose, paths, numbers and placeholders low."""
    return _score(len(value), Counter(value), value)


def _score(size: int, counts: Counter, value: str | None) -> float:
    """The same from a literal's length and characters; its text (None: longer than all placeholders) matters for placeholders only."""
    if size < 6 or any(c in counts for c in " \t\n") or (value is not None and (value.lower() in PLACEHOLDERS or STANDS_FOR.match(value))):
        return 0.0
    chars = "".join(counts)
    classes = sum(bool(re.search(p, chars)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    entropy = -sum(n / size * math.log2(n / size) for n in counts.values())
    if classes == 1 and size < 16:
        return 0.1
    return min(1.0, entropy / 4) * min(1.0, 0.4 + 0.2 * classes)


class _Bound:
    """What a name is bound to: one literal at a place, or the concatenation of other bound values."""

    __slots__ = ("value", "start", "end", "parts", "size", "counts")

    def __init__(self, value: str, start: int, end: int):
        self.value, self.start, self.end, self.parts, self.size, self.counts = value, start, end, (), len(value), None

    def score(self) -> float:
        return _score(self.size, self.characters(), self.value)

    def characters(self) -> Counter:
        if self.counts is None:
            self.counts = Counter(self.value)
        return self.counts


def _joined(parts: list[_Bound]) -> _Bound:
    """Concatenation by length and character counts, so that x = x + x costs no more than its text."""
    out = _Bound("", -1, -1)
    out.parts, out.size, out.counts = tuple(parts), sum(p.size for p in parts), Counter()
    for p in parts:
        for c, n in p.characters().items():
            out.counts[c] += n
    out.value = "".join(p.value for p in parts) if out.size <= LONGEST_PLACEHOLDER else None
    return out


def _matches(text: str):
    """Bindings and braces in the order of the text."""
    found = [PAIR.finditer(text)]
    for sign, pattern in (("</", ELEMENT), ("-", OPTION), ("://", ADDRESS), ("{", BRACE)):
        if sign in text:
            found.append(pattern.finditer(text))
    return heapq.merge(*found, key=lambda m: m.start()) if len(found) > 1 else found[0]


def _resolved(value: str, group: str, known: dict[str, _Bound]) -> _Bound | None:
    """What a literal refers to, if it is a reference to a known name."""
    if m := REFERENCE.match(value):
        return known.get((m[1] or m[2] or m[3]).lower())
    return known.get(value.lower()) if group == "bare" and _IDENT.match(value) else None


def lexed_spans(text: str) -> list[tuple[str, int, int]]:
    """Literals of sensitive names, directly bound (literal) or through constants (const)."""
    if not _BINDS.search(text):
        return []
    known: dict[str, _Bound] = {}
    found: set[tuple[int, int, str]] = set()
    told: set[_Bound] = set()  # constants whose literals are in found
    around: list[str] = []  # names of the open braces
    upto = 0  # end of the last value
    for m in _matches(text):
        if m.re is BRACE:
            if m.start("open" if m["open"] else "brace") >= upto:
                if m["brace"] == "}":
                    del around[-1:]
                else:
                    around.append(m["name"] or "")
            continue
        group = m.lastgroup
        name = "password" if m.re is ADDRESS else (m["name"] or m["short"] if m.re is OPTION else m["name"]).lower()
        target = next((x for x in reversed(around) if x), name) if name in GENERAL else name
        after, parts, own = m.end(), [], []

        def add(value: str, kind: str, start: int):
            to = _resolved(value, kind, known)
            parts.append(to or _Bound(value, start, start + len(value)))
            if to is None:
                own.append(parts[-1])

        add(m[group], group, m.start(group))
        while group != "xml" and (more := JOIN.match(text, after)):
            kind = more.lastgroup
            if kind == "more":
                if more[kind].lower() not in known:
                    break
                parts.append(known[more[kind].lower()])
            elif group in ("bare", "ref", "url") and text[after:more.start(kind)].strip("\"' \t") != "+":
                break
            else:
                add(more[kind], kind, more.start(kind))
            after = more.end()
        bound = parts[0] if len(parts) == 1 else _joined(parts)
        score = name_score(target)
        if score and score + bound.score() >= THRESHOLD:
            found.update((p.start, p.end, "literal") for p in own)
            todo = [p for p in parts if p not in own]
            while todo:
                part = todo.pop()
                if part not in told:
                    told.add(part)
                    todo.extend(part.parts)
                    if not part.parts:
                        found.add((part.start, part.end, "const"))
        known[name] = bound
        upto = max(upto, after)
    return [(k, a, b) for a, b, k in sorted(found)]


def scan_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and its spans array<struct<kind, start, end, base>>."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("_text"):
                text = text.as_py()
                spans = [{"kind": k, "start": a, "end": b, "base": True} for k, a, b in base_spans(text)]
                out.append(spans + [{"kind": k, "start": a, "end": b, "base": False} for k, a, b in lexed_spans(text)])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "spans": pa.array(out, pa.list_(span))})

    return base.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean>>")


def _count(spans, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def digest(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])
    # Base spans arrive ordered; all spans are put in order by start, listed kinds first.
    order = F.array(*[F.lit(k) for k in (*KINDS, "literal", "const")])
    every = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("a"), F.array_position(order, s["kind"]).alias("k"), s["end"].alias("b"), s["kind"].alias("kind"))))
    text = lambda kind, a, b: F.concat_ws(":", kind, a.cast("string"), b.cast("string"))
    return found.select(
        "doc_id",
        *[_count(base, k) for k in KINDS],
        F.sha2(F.array_join(F.transform(base, lambda s: text(s["kind"], s["start"], s["end"])), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(every, lambda s: text(s["kind"], s["a"], s["b"])), ",").alias("spans"),
    )
