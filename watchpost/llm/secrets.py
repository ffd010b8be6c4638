"""Secret scans that understand assignments.

Base patterns find three kinds of secrets anywhere.  Beyond them, a lexer reads the forms in which
source and configuration files give a literal to a name: ``name = "x"``, ``name: x``,
``"name": "x"``, ``name => x``, ``name := x``, ``export NAME=x``, ``<name>x</name>`` and
``--name x``.  A right side may be a quoted literal, a bare word, another name, ``${name}``, or
several of them joined by ``+`` or ``.``.  Constants are propagated: a literal bound to a harmless
name gets a sensitive name's score when that name, or one on the way to it, is assigned to it.

A literal's score is the sensitivity of the best name that it reaches, times how much it looks like
a secret: its length and the variety of its characters, and nothing for placeholders, plain
words, numbers, paths and references.  Literals that reach ``MIN_SCORE`` are spans of kind ``literal``.

Every text is scanned whole and by itself; nothing is shuffled.  Positions are code points, ends
exclusive.

Edge cases: a null text counts as empty; a name that is bound several times passes on all its
literals; circular assignments end, because a name is followed once; repeated rows get the
same result each; other columns are carried along untouched, and one named like the result is
refused.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Base patterns with the least length of what they capture, in the order of kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # whole runs, as a run that is shorter doesn't count
MIN_ASSIGN, MIN_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "literal")
KEYWORDS = ("passw", "secret", "token", "api")

# How much a part of a name tells about what it holds, from 0 to 1.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "pwd": 0.9, "pass": 0.7,
    "secret": 1.0, "secrets": 1.0, "token": 0.9, "tokens": 0.9, "credential": 0.9, "credentials": 0.9,
    "apikey": 1.0, "authkey": 1.0, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "signingkey": 1.0,
    "auth": 0.6, "authorization": 0.8, "bearer": 0.9, "cookie": 0.6, "session": 0.5, "salt": 0.6, "signature": 0.6,
    "key": 0.5, "cert": 0.5, "dsn": 0.5, "webhook": 0.5,
}
QUALIFIERS = {"api", "access", "private", "auth", "secret", "signing", "encryption", "master", "client", "account"}
HARMLESS = {"public", "path", "file", "name", "url", "uri", "id", "length", "type", "field", "hint", "count", "expiry"}
PLACEHOLDER = re.compile(
    r"(?i)^(?:x+|\*+|\.+|-+|_+|change.?me.*|.*example.*|.*placeholder.*|your[-_ ].*|<.*>|test|none|null|nil|true|false|"
    r"undefined|todo|dummy|redacted|secret|password|passwd|token)$"
)
NO_VALUE = ("${", "$(", "{{", "/", "./", "http")  # how references, paths and addresses begin
OPENING, MARKED = re.compile(r"(?i)change.?me|your[-_ ]"), re.compile(r"(?i)example|placeholder")  # of long placeholders

MIN_SCORE = 0.45
MIN_LITERAL = 6
SHORT = 64  # characters up to which a literal is always judged by itself

# Nothing is bounded.  So that no text takes more than linear time, quantifiers are possessive, a
# name of several parts is passed over whole if no operator follows, and what several right sides
# have in common, the end of a bare word and the operands behind it, is read once.
PART = r"[A-Za-z_$][\w$]*+"
CHAIN = rf"(?:(?:\.|->|::|-){PART}|\[['\"]?\w++['\"]?\])"
NAME = rf"{PART}{CHAIN}*+"
OPERATOR = r":=|=>|={1,3}+|:"
LITERAL = r"\"(?:[^\"\\\n]|\\.)*+\"|'(?:[^'\\\n]|\\.)*+'|`[^`\\\n]*+`"
OPERAND = re.compile(rf"\$\{{(?P<ref>\w+)\}}|(?P<quoted>{LITERAL})|(?P<bare>[^\s\"'`,;(){{}}\[\]<>#]++)", re.A)
PAIR = re.compile(
    rf"(?<![\w$])(?:[\"'](?P<quoted>[^\"'\n]++)[\"'][ \t]*+(?P<after>{OPERATOR})"
    rf"|(?P<name>{PART}(?P<chain>{CHAIN}++)?+)(?:[ \t]*+(?P<operator>{OPERATOR})|(?(chain)|(?!))))",
    re.A,
)
ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][\w.:-]*+)>(?P<text>[^<>\n]++)</(?P=name)>", re.A)
OPTION = re.compile(r"(?<!\S)--?(?P<name>[A-Za-z][\w-]*)[ \t]+(?P<text>[^\s\"'`-][^\s\"'`]*)", re.A)
JOIN = re.compile(r"[ \t]*+[+.][ \t]*+")
NAME_ONLY = re.compile(NAME, re.A)


@dataclass(frozen=True)
class Operand:
    """A literal or another name on a right side, or a bare word that may be either."""

    start: int
    end: int
    literal: bool
    name: str | None
    next: int | None  # where the operand that is joined to it begins


@dataclass(frozen=True)
class Binding:
    """A name, and where the operands that an assignment gives to it begin."""

    name: str
    first: int


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns' matches."""
    spans = []
    low = text.lower() if ":" in text or "=" in text else ""
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def bindings(text: str) -> tuple[list[Binding], dict[int, Operand]]:
    """The names of a text that something is assigned to, and all operands by their beginnings."""
    found: list[Binding] = []
    operands: dict[int, Operand] = {}
    joined: dict[int, int | None] = {}
    last = (0, 0, 0)
    for pair in PAIR.finditer(text) if "=" in text or ":" in text else ():
        operator = pair["operator"] or pair["after"]
        if operator in (None, "==", "===") or text[pair.end() : pair.end() + 2] == "//":
            continue  # a name alone, a comparison, or the scheme of an address
        at = pair.end()
        while text[at : at + 1] in (" ", "\t"):
            at += 1
        last = _right_side(text, at, operands, joined, last)
        if at in operands:
            found.append(Binding(pair["name"] or pair["quoted"], at))
    patterns = [ELEMENT] if "</" in text else []
    patterns += [OPTION] if " -" in text or "\n-" in text or text[:1] == "-" else []
    for pattern in patterns:
        for m in pattern.finditer(text):
            # Numbers below zero, as an operand of a pair may begin at the same place.
            operands[-1 - m.start("text")] = Operand(m.start("text"), m.end("text"), True, None, None)
            found.append(Binding(m["name"], -1 - m.start("text")))
    return found, operands


def _right_side(text: str, at: int, operands: dict[int, Operand], joined: dict, last: tuple[int, int, int]) -> tuple[int, int, int]:
    """Adds the operands from ``at`` on that are joined by ``+`` or ``.`` up to the end of the line.

    ``last`` is the last bare word found: beginning, end, and end without what may close a line;
    ``joined`` says for an end of an operand where the next one begins.
    """
    chain: list[tuple[int, int, int, bool, str | None, int | None]] = []
    while at not in operands:
        if last[0] <= at < last[1]:  # within a word that is known: it ends where that ends
            kind, end = "bare", last[1]
        elif operand := OPERAND.match(text, at):
            kind, end = operand.lastgroup, operand.end()
            if kind == "bare":
                last = (at, end, at + len(operand["bare"].rstrip(".:+")))
        else:
            break
        start, stop, literal, name = at, end, kind != "ref", None
        if kind == "ref":
            name = operand["ref"]
        elif kind == "quoted":
            start, stop = at + 1, end - 1
        elif text[end : end + 1] == "(":  # a call
            break
        else:
            stop = max(at, last[2])
            if (word := NAME_ONLY.match(text, at, stop)) and word.end() == stop:
                name = word[0]
            literal = stop > at  # a bare word may be a name or, in configuration files, the value itself
        if end not in joined:
            join = JOIN.match(text, end)
            joined[end] = join.end() if join else None
        chain.append((at, start, stop, literal, name, joined[end]))
        if joined[end] is None:
            break
        at = joined[end]
    for begin, start, stop, literal, name, next_ in reversed(chain):
        if literal or name or next_ in operands:  # else nothing is given from here on
            operands[begin] = Operand(start, stop, literal, name, next_)
    return last


def sensitivity(name: str) -> float:
    """How much the name tells that it holds a secret."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)]
    if not parts:
        return 0.0
    score = max(SENSITIVE.get(p, 0.0) for p in parts)
    pairs = [a + b for a, b in zip(parts, parts[1:])]
    score = max([score, *(SENSITIVE.get(p, 0.0) for p in pairs)])
    if "key" in parts and QUALIFIERS & set(parts):
        score = 1.0
    return score * (0.3 if parts[-1] in HARMLESS or parts[0] == "public" else 1.0)


def likeness(literal: str) -> float:
    """How much a literal looks like a secret, from 0 to 1."""
    if len(literal) < MIN_LITERAL or PLACEHOLDER.match(literal) or literal.startswith(NO_VALUE):
        return 0.0
    if re.search(r"\s", literal):  # a phrase
        return 0.3 if len(literal) < 40 else 0.0
    counts = Counter(literal)
    entropy = -sum(n / len(literal) * log2(n / len(literal)) for n in counts.values())
    classes = sum(bool(re.search(c, literal)) for c in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    if re.fullmatch(r"[A-Za-z_.-]+", literal):
        return 0.2  # a plain word, or a name
    if re.fullmatch(r"[\d.,:-]+", literal):
        return 0.3 if len(literal) >= 8 else 0.0
    return min(1.0, 0.25 * min(entropy, 3.0) + 0.1 * classes)


def likenesses(text: str, starts: Sequence[int], end: int) -> list[float]:
    """``likeness`` of the literals from each of ``starts``, in ascending order, to ``end``.

    Right sides within one word have their end in common; characters are counted from there, so
    that a word of many assignments is read once.
    """
    if len(starts) == 1:
        return [likeness(text[starts[0] : end])]
    found = []
    counts: Counter[str] = Counter()
    at, weighted, different = end, 0.0, 0
    marked = max((m.start() for m in MARKED.finditer(text, starts[0], end)), default=-1)
    for start in reversed(starts):
        for c in reversed(text[start:at]):
            n = counts[c]
            weighted += (n + 1) * log2(n + 1) - (n * log2(n) if n else 0.0)
            counts[c] = n + 1
        at, size = start, end - start
        if different != len(counts):
            different, kinds = len(counts), "".join(counts)
            alone = re.fullmatch(r"(?i)x+|\*|\.|-|_", kinds)
            phrase, number = re.search(r"\s", kinds), re.fullmatch(r"[\d.,:-]+", kinds)
            plain = re.fullmatch(r"[A-Za-z_.-]+", kinds)
            classes = sum(bool(re.search(c, kinds)) for c in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
        if size <= SHORT:
            found.append(likeness(text[start:end]))
        elif alone or marked >= start or OPENING.match(text, start) or text.startswith(NO_VALUE, start):
            found.append(0.0)
        elif text[start] == "<" and text[end - 1] == ">" or phrase:
            found.append(0.0)
        elif plain or number:
            found.append(0.2 if plain else 0.3)
        else:
            entropy = log2(size) - weighted / size
            found.append(min(1.0, 0.25 * min(entropy, 3.0) + 0.1 * classes))
    return found[::-1]


def literal_scores(text: str, found: Sequence[Binding], operands: dict[int, Operand]) -> dict[tuple[int, int], float]:
    """The scores of the literals, by start and end, that may reach ``MIN_SCORE``, by the best name that each reaches.

    Names pass their sensitivity on to the operands and names that they are assigned from, until
    nothing changes.
    """
    own = {b.name: sensitivity(b.name) for b in found}
    firsts: dict[str, list[int]] = {}
    for binding in found:
        firsts.setdefault(binding.name, []).append(binding.first)
    best: dict[str | int, float] = {}  # of names, and of operands by their beginnings
    for name in sorted(own, key=lambda n: -own[n]):  # the first to reach a name is the most sensitive
        stack: list[str | int] = [name]
        while stack:
            at = stack.pop()
            if at in best:
                continue
            best[at] = own[name]
            if isinstance(at, str):
                stack += firsts[at]
            else:
                stack += [operands[at].next] if operands[at].next in operands else []
                stack += [operands[at].name] if operands[at].name in own else []
    reached: dict[tuple[int, int], float] = {}
    for at, operand in operands.items():
        score = best.get(at, 0.0)
        # A bare word that is bound elsewhere is a name.
        if operand.literal and score >= MIN_SCORE and operand.name not in own:
            span = (operand.start, operand.end)
            reached[span] = max(reached.get(span, 0.0), score)
    starts: dict[int, list[int]] = {}
    for start, end in sorted(reached):
        starts.setdefault(end, []).append(start)
    return {
        (start, end): reached[start, end] * like
        for end, group in starts.items()
        for start, like in zip(group, likenesses(text, group, end))
    }


def secret_spans(text: str | None) -> list[tuple[int, int, int, float]]:
    """``(start, kind, end, score)`` of the base patterns and of the lexer's literals, in order."""
    text = text or ""
    spans = [(start, kind, end, 1.0) for start, kind, end in base_spans(text)]
    scores = literal_scores(text, *bindings(text))
    spans += [(start, 3, end, score) for (start, end), score in scores.items() if score >= MIN_SCORE]
    return sorted(spans)


SPAN_TYPE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def scan_secrets(
    docs: DataFrame, *, text_col: str = "text", found: str = "secrets", keep: Sequence[str] | None = None
) -> DataFrame:
    """``docs``, or its columns ``keep``, with an array column ``found`` of kind, start, end, score.

    Sorted by start, then by kind in the order ``assign``, ``access``, ``hex``, ``literal``.  Base
    kinds have the score 1.
    """
    if found in docs.columns:
        raise ValueError(f"the documents already have a column {found}")
    keep = list(docs.columns if keep is None else keep)
    kind = T.ArrayType(SPAN_TYPE)
    arrow = to_arrow_type(kind)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [{"kind": KINDS[k], "start": a, "end": z, "score": score} for a, k, z, score in secret_spans(text.as_py())]
                for text in batch.column(text_col)
            ]
            yield pa.record_batch([*(batch.column(c) for c in keep), pa.array(rows, arrow)], [*keep, found])

    return docs.mapInArrow(scan, T.StructType([*(docs.schema[c] for c in keep), T.StructField(found, kind)]))
