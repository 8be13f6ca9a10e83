"""Secret scanning by assignment-aware lexing of source and configuration text.

Three fixed patterns give the base spans. The lexer then reads every line that has an
assignment sign as ``name = term + term ...`` (also ``name: term``, ``"name": term``,
``name := term``, ``name => term``), remembers the literals behind each name, follows names on
the right side to the literals they hold, also those defined further down, and scores each
literal reached by the words of the target name and by what the literal looks like. Literals in
triple quotes and YAML block scalars span lines; a PEM private key is one wherever it stands.
Spans count code points, end exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialstats.llm.common import by_batch

# The base patterns and their order.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ["assign", "access", "hex", "literal"]
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Words of sensitive names, alone and in pairs, and literals that stand for something else.
SENSITIVE = {"password", "passwd", "pwd", "passphrase", "secret", "token", "credential", "credentials", "apikey"}
SENSITIVE_PAIRS = {
    ("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key"), ("auth", "key"),
    ("signing", "key"), ("encryption", "key"), ("master", "key"), ("pass", "word"), ("pass", "phrase"),
}
# Words at the end of a name whose quoted value may be several words.
PHRASES, PHRASE_PAIRS = {"password", "passwd", "pwd", "passphrase", "secret", "credential", "credentials"}, {("pass", "word"), ("pass", "phrase")}
PLACEHOLDERS = {"password", "secret", "token", "changeme", "example", "none", "null", "true", "false", "undefined", "placeholder"}
# Score from which a literal is reported.
REPORT = 0.75

# Names and quoted literals are taken whole or not at all, so that long lines stay linear.
_NAME = re.compile(r"(?<![\w$.-])([A-Za-z_$][\w$.-]*+)[\"']?\]?[ \t]*(?::=|=>|=(?!=)|:(?!:))[ \t]*")
_TERM = re.compile(
    r"\"((?:[^\"\\\n]|\\.)*+)\"|'((?:[^'\\\n]|\\.)*+)'|([A-Za-z0-9_$+/=.~!@#%^&*-]+)"
)
# What stands for a value that is elsewhere: ${NAME}, $(command), $NAME, %NAME%, <description>, {{ name }}, {name}.
_REFERENCE = re.compile(r"\$\{[^{}]*+\}|\$\([^()]*+\)|%[A-Za-z_]\w*+%|<[^<>]*+>|\{\{[^{}]*+\}\}|\{[A-Za-z_][\w.]*+\}")
_VARIABLE = re.compile(r"\$[A-Za-z_][\w.]*+-?")
_BLOCK = re.compile(r"[|>][+\-0-9]{0,2}[ \t]*(?:#.*)?\r?")
_INDENT = re.compile(r"[ \t]*(?:-[ \t]+)*")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?)-----")
_PLUS = re.compile(r"[ \t]*\+[ \t]*|[ \t]*\.\.[ \t]*")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_HEX_BYTES = bytes(0x68 if chr(i) in "0123456789abcdef" else 0x20 for i in range(256))

SPAN = "struct<kind:string,start:int,stop:int,value:int,score:double>"
Span = tuple[str, int, int, int, float]


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns: kind, start, stop, start of the value, score."""
    spans: list[Span] = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        spans += [("assign", *m.span(), m.start(2), 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        spans += [("access", *m.span(), m.start(), 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_MIN]
    if b"h" * HEX_MIN in text.encode("utf-8", "replace").translate(_HEX_BYTES):
        spans += [("hex", *m.span(), m.start(), 1.0) for m in HEX.finditer(text) if len(m[0]) >= HEX_MIN]
    return spans


def sensitive(name: str) -> bool:
    """Whether the words of a name say that it holds a secret."""
    words = [w.lower() for w in _WORDS.findall(name)]
    return not SENSITIVE.isdisjoint(words) or any(p in SENSITIVE_PAIRS for p in zip(words, words[1:], strict=False))


def phrase_name(name: str) -> bool:
    """Whether a name ends in words whose value may be several words."""
    words = [w.lower() for w in _WORDS.findall(name) if not w.isdigit()]
    return bool(words) and (words[-1] in PHRASES or tuple(words[-2:]) in PHRASE_PAIRS)


def refers(literal: str) -> bool:
    """Whether a literal is nothing but references to values elsewhere."""
    if _VARIABLE.fullmatch(literal):
        return True
    rest = _REFERENCE.sub("", literal)
    return rest != literal and not any(c.isalnum() for c in rest)


def literal_score(literal: str, quoted: bool, phrase: bool = False) -> float:
    """How much a literal behind a sensitive name looks like a secret, 0 to 1; ``phrase`` if it may have several words.

    Breaks between lines and the indentation after them don't count.
    """
    if "\n" in literal:
        literal = "".join(map(str.strip, literal.split("\n")))
    if len(literal) < ASSIGN_MIN or literal.lower() in PLACEHOLDERS or len(set(literal)) < 4 or refers(literal):
        return 0.0
    counts = Counter(literal)
    bits = -sum(c / len(literal) * math.log2(c / len(literal)) for c in counts.values())
    mixed = any(c.isdigit() for c in literal) and any(c.isalpha() for c in literal)
    score = 0.5 + 0.1 * (len(literal) >= 8) + 0.1 * (bits >= 3) + 0.2 * mixed + 0.1 * quoted
    return max(0.0, min(1.0, score - 0.4 * (any(c.isspace() for c in literal) and not (quoted and phrase))))


def _stripped(text: str, lo: int, hi: int) -> tuple[int, int]:
    """The span without white space at its ends."""
    part = text[lo:hi]
    return lo + len(part) - len(part.lstrip()), max(lo, hi - len(part) + len(part.rstrip()))


def _block(text: str, start: int, end: int) -> tuple[int, int]:
    """The span of a YAML block scalar whose key is in the line at ``start``; ``end`` is the end of that line."""
    depth = _INDENT.match(text, start, end).end() - start
    lo, hi = end + 1, end
    while lo <= len(text):
        stop = text.find("\n", lo)
        stop = len(text) if stop < 0 else stop
        line = text[lo:stop]
        if line.strip():
            if len(line) - len(line.lstrip()) <= depth:
                break
            hi = stop
        lo = stop + 1
    return _stripped(text, min(end + 1, hi), hi)


def private_keys(text: str) -> list[tuple[int, int]]:
    """PEM private keys from their first to their last line, also where line breaks are escaped."""
    out, pos, open_ended = [], 0, set()
    while m := _PEM.search(text, pos):
        pos, last = m.end(), f"-----END {m[1]}-----"
        at = -1 if last in open_ended else text.find(last, pos)
        if at < 0:
            open_ended.add(last)
        else:
            pos = at + len(last)
            out.append((m.start(), pos))
    return out


def literal_spans(text: str) -> list[Span]:
    """Private keys, and literals that reach a sensitive name by assignment, directly or through other names."""
    Item = tuple[int, int, bool, str | None]  # start, stop, whether quoted, the name that it may be
    constants: dict[str, list[Item]] = {}
    defined: dict[str, dict[Item, None]] = {}
    wanted: list[tuple[Item, bool]] = []
    unclosed: set[str] = set()
    at = 0
    for line in text.split("\n"):
        end = at + len(line)
        if "=" in line or ":" in line:
            pos = at
            while m := _NAME.search(text, pos, end):
                items: dict[Item, None] = {}
                pos = m.end()
                if m[0].rstrip()[-1] == ":" and _BLOCK.fullmatch(text, pos, end):
                    lo, hi = _block(text, at, end)
                    if lo < hi:
                        items[lo, hi, True, None] = None
                while True:
                    mark = text[pos:pos + 3]
                    if mark in ('"""', "'''") and mark not in unclosed:
                        close = text.find(mark, pos + 3)
                        if close >= 0:
                            items[(*_stripped(text, pos + 3, close), True, None)] = None
                            pos = min(close + 3, end)
                            if close >= end or not (plus := _PLUS.match(text, pos, end)):
                                break
                            pos = plus.end()
                            continue
                        unclosed.add(mark)
                    if not (t := _TERM.match(text, pos, end)):
                        break
                    quoted = t[3] is None
                    group = 3 if not quoted else 1 if t[1] is not None else 2
                    ref = None if quoted else t[3].rstrip(";,")
                    known = constants.get(ref) if ref else None
                    items.update(dict.fromkeys(known or [(t.start(group), t.end(group), quoted, ref)]))
                    pos = t.end()
                    if not (plus := _PLUS.match(text, pos, end)):
                        break
                    pos = plus.end()
                name = m[1]
                constants[name] = list(items)
                defined.setdefault(name, {}).update(items)
                if sensitive(name):
                    phrase = phrase_name(name)
                    wanted += [(i, phrase) for i in items]
                if not items:
                    pos = m.end()
        at = end + 1
    found: dict[tuple[int, int], float] = {}
    seen: set[tuple[Item, bool]] = set()
    while wanted:
        item, phrase = wanted.pop()
        if (item, phrase) in seen:
            continue
        seen.add((item, phrase))
        lo, hi, quoted, ref = item
        if ref and defined.get(ref):  # a name that is defined further down
            wanted += [(i, phrase) for i in defined[ref]]
            continue
        score = literal_score(text[lo:hi], quoted, phrase)
        if score >= REPORT:
            found[lo, hi] = max(score, found.get((lo, hi), 0.0))
    found.update(dict.fromkeys(private_keys(text), 1.0))
    return [("literal", lo, hi, lo, score) for (lo, hi), score in found.items()]


def find(text: str) -> list[Span]:
    """All spans of a text by start, then kind; literals inside a base span are that span."""
    base = base_spans(text)
    lexed = literal_spans(text) if "=" in text or ":" in text or "-----BEGIN " in text else []
    extra = [s for s in lexed if not any(b[1] <= s[1] and s[2] <= b[2] for b in base)]
    return sorted(base + extra, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redacted(text: str, spans: list[Span], mask: str = "[SECRET]") -> str:
    """The text with the value of every span replaced; overlapping values become one mask."""
    out, at = [], 0
    for lo, hi in sorted((s[3], s[2]) for s in spans):
        if lo >= at:
            out += [text[at:lo], mask]
        at = max(at, hi)
    return "".join(out) + text[at:]


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows ``(row, secrets, redacted)``: the row of ``df`` as a struct, its spans and its text without them.

    Every row of ``df`` gives a row, whatever its columns are called. A null text has no spans
    and stays null.
    """
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    kind = packed.schema["row"].dataType.simpleString()
    span_type = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.int32()), ("score", pa.float64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("row").field(text).to_pylist()
        spans = [find(t) if t else [] for t in texts]
        clean = [redacted(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
        names = ["kind", "start", "stop", "value", "score"]
        found = pa.array([[dict(zip(names, s, strict=True)) for s in x] for x in spans], pa.list_(span_type))
        return pa.RecordBatch.from_arrays([batch.column("row"), found, pa.array(clean, pa.string())], ["row", "secrets", "redacted"])

    return packed.mapInArrow(by_batch(run), f"row {kind}, secrets array<{SPAN}>, redacted string")


def secret_spans(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the numbers of base spans, their digest and all spans as text."""
    found = scan(df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")))
    joined = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')"
    base = "filter(secrets, s -> s.kind <> 'literal')"
    return found.selectExpr(
        "row.doc_id AS doc_id",
        *[f"CAST(size(filter(secrets, s -> s.kind = '{k}')) AS bigint) AS n_{k}" for k in KINDS[:3]],
        f"sha2({joined.format(base)}, 256) AS base_sha256",
        f"{joined.format('secrets')} AS spans",
    )
