"""Secret scan: patterns, and literals that a lexer of assignments ties to sensitive names."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.words import batches

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "literal")
#: A long enough hexadecimal run; shorter ones are dropped anyway.
LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)

#: A quoted string of source code; possessive parts keep all patterns linear.
STRING = r"""(?:"{3}(?:[^"\\]|\\(?s:.)|"(?!""))*+"{3} | '{3}(?:[^'\\]|\\(?s:.)|'(?!''))*+'{3}
    | "(?:[^"\\\n]|\\.)*+" | '(?:[^'\\\n]|\\.)*+' | `(?:[^`\\]|\\(?s:.))*+`)"""
#: ``name = value`` in source and configuration: a value is strings, joined by ``+`` or standing
#: side by side (in parentheses also on several lines), the indented lines of a block, a
#: reference or a bare word. A type may stand after the name. Or an element ``<name>value</name>``.
PAIR = re.compile(rf"""
    <(?P<tag>[A-Za-z_][\w.:\-]*+)(?:\s[^<>]*+)?+>(?P<element>[^<>]++)</(?P=tag)\s*+>
    | (?<![\w$.\-])(?P<name>[A-Za-z_$][\w$.\-]*+)["']?\]?
      (?:[\ \t]*+:[\ \t]*+[A-Za-z_][\w.]*+(?:\[[\w.,\ ]*+\])?+(?=[\ \t]*+=(?!=)))?+
      [\ \t]*+(?::=|=>|[:=])(?!=)[\ \t]*+
      (?: \(\s*+(?P<grouped>{STRING}(?:\s*+(?:\+\s*+)?+{STRING})*+)\s*+\)
        | (?P<quoted>{STRING}(?:(?:\s*+\+\s*+|[\ \t]++){STRING})*+)
        | (?P<block>[|>][+\-]?+[0-9]?+[\ \t]*+\n)
        | (?P<bare>\$\{{?\w++\}}?|[A-Za-z0-9+/_.=\-]++)(?P<call>[\ \t]*+[(\[])?+)""",
                  re.VERBOSE | re.ASCII)
STRINGS = re.compile(STRING, re.VERBOSE)
#: What may stand before the name and after the value on a line of a configuration.
BEFORE, AFTER = re.compile(r"[\ \t]*(?:export[\ \t]|set[\ \t]|-[\ \t])?[\ \t]*[\"']?"), re.compile(
    r"[\ \t]*[,;]?[\ \t]*(?:[#\r\n]|\Z)")
REFERENCE = re.compile(r"[A-Za-z_]\w*+(?:\.[A-Za-z_]\w*+)*+", re.ASCII)
PLAIN = re.compile(r"[A-Za-z]+[0-9]{0,3}")
NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0,
             "token": 1.0, "apikey": 1.0, "credential": 1.0, "credentials": 1.0, "bearer": 1.0,
             "key": 0.6, "pass": 0.6, "auth": 0.6, "private": 0.5, "access": 0.4, "api": 0.4,
             "client": 0.2, "session": 0.4}
HARMLESS = re.compile(r"change|changeme|example|placeholder|your|x{4,}|\*{3,}|none|null|true|false", re.IGNORECASE)
#: Parts of a text in words; other runs of letters and digits are random.
WORDLIKE = re.compile(r"[a-z]{2,}|[A-Z]{2,}|[A-Z][a-z]+|[0-9]{1,4}|\*+")
PART = re.compile(r"\*+|[0-9]+|[A-Za-z]+")
LEAST_SCORE, LEAST_LITERAL = 0.7, 8


def name_score(name: str) -> float:
    """0 to 1: how much the parts of a name speak of a secret."""
    return min(1.0, sum(SENSITIVE.get(p.lower(), 0.0) for p in set(NAME_PART.findall(name))))


def is_harmless(value: str) -> bool:
    """A placeholder: made of words and short numbers only, and one of the words says so."""
    parts = PART.findall(value)
    return (any(HARMLESS.fullmatch(p) for p in parts)
            and all(WORDLIKE.fullmatch(p) for p in parts))


def literal_score(value: str) -> float:
    """0 to 1: random-looking and long is 1; short texts, placeholders and plain words are low."""
    if len(value) < LEAST_LITERAL or is_harmless(value):
        return 0.0
    counts = Counter(value)
    entropy = -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    mixed = any(c.isdigit() for c in value) or not value.isalpha()
    return min(1.0, entropy / 3.0) * (1.0 if mixed else 0.6)


Literal = tuple[int, int, str]


def _strings(text: str, start: int, end: int) -> Literal:
    """Strings in a row as one literal: from the first one's inside to the last one's."""
    found = list(STRINGS.finditer(text, start, end))
    marks = [3 if len(m[0]) >= 6 and m[0][:3] in ('"""', "'''") else 1 for m in found]
    return (found[0].start() + marks[0], found[-1].end() - marks[-1],
            "".join(m[0][k:-k] for m, k in zip(found, marks)))


def _block(text: str, name: int, start: int) -> Literal | None:
    """The lines from ``start`` that are indented deeper than the line of ``name``."""
    line = text.rfind("\n", 0, name) + 1
    depth = len(text[line:name]) - len(text[line:name].lstrip(" "))
    at, lines = start, []
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        inside = at + len(text[at:end]) - len(text[at:end].lstrip(" "))
        if text[inside:end].strip():
            if inside - at <= depth:
                break
            lines.append((inside, end))
        at = end + 1
    if not lines:
        return None
    return lines[0][0], lines[-1][1], "\n".join(text[a:b] for a, b in lines)


def _bare_literal(text: str, m: re.Match) -> Literal | None:
    """A bare word that no name explains. Calls, dotted names and identifiers of plain words are
    references; other plain words are literals on a line of a configuration only."""
    value = m["bare"]
    if value[0] == "$" or m["call"]:
        return None
    pieces = re.split(r"[^A-Za-z0-9]+", value)
    if all(PLAIN.fullmatch(p) for p in pieces if p):
        if REFERENCE.fullmatch(value) and (len(pieces) > 1 or value.isalpha()):
            return None
        line = text.rfind("\n", 0, m.start("name")) + 1
        if not (BEFORE.fullmatch(text, line, m.start("name")) and AFTER.match(text, m.end("bare"))):
            return None
    elif "." in value and REFERENCE.fullmatch(value):
        return None
    return (*m.span("bare"), value)


def _assignments(text: str) -> Iterator[tuple[str, Literal | None, str | None]]:
    """(name, literal, reference) in text order. A bare word may have both: the reference counts if
    it leads to a literal."""
    for m in PAIR.finditer(text):
        if m["tag"]:
            start, end = m.span("element")
            value = text[start:end].strip()
            start += len(text[start:end]) - len(text[start:end].lstrip())
            yield m["tag"].rpartition(":")[2], (start, start + len(value), value), None
        elif m["bare"]:
            reference = None if m["call"] else m["bare"].strip("${}")
            yield m["name"], _bare_literal(text, m), reference
        elif m["block"]:
            yield m["name"], _block(text, m.start("name"), m.end("block")), None
        else:
            group = "grouped" if m["grouped"] else "quoted"
            yield m["name"], _strings(text, *m.span(group)), None


def literals(text: str) -> Iterator[tuple[int, int]]:
    """Spans of literals assigned, directly or through other names, to sensitive names.

    All assignments of a text are read, then references are followed: one stands for the last
    value assigned to its name before it, or else the first after it. A name that is assigned
    itself in a circle stands for nothing.
    """
    if "=" not in text and ":" not in text and "</" not in text:
        return
    pairs = list(_assignments(text))
    places: dict[str, list[int]] = {}
    for i, (name, _, _) in enumerate(pairs):
        for known in {name, name.rpartition(".")[2]}:
            places.setdefault(known, []).append(i)

    def target(i: int) -> int | None:
        reference = pairs[i][2]
        for known in (reference, reference.rpartition(".")[2]) if reference else ():
            at = places.get(known, [])
            k = bisect_left(at, i)
            if k:
                return at[k - 1]
            later = k + (k < len(at) and at[k] == i)
            if later < len(at):
                return at[later]
        return None

    values: dict[int, Literal | None] = {}
    for i in range(len(pairs)):
        path, on_path = [i], {i}
        while path[-1] not in values and (to := target(path[-1])) is not None and to not in on_path:
            path.append(to)
            on_path.add(to)
        value = values.get(path[-1], pairs[path[-1]][1])
        for j in reversed(path):
            value = values[j] = value or pairs[j][1]
    found = set()
    for i, (name, _, _) in enumerate(pairs):
        value = values[i]
        if (value and value[:2] not in found
                and name_score(name) * literal_score(value[2]) >= LEAST_SCORE):
            found.add(value[:2])
            yield value[:2]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three base patterns, by start and kind."""
    spans = []
    if "=" in text or ":" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                  if len(m[0]) >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(spans)


def all_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    base = base_spans(text)
    return base, sorted(base + [(start, 3, end) for start, end in literals(text)])


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secret_spans(docs: DataFrame) -> DataFrame:
    """Secrets in every text, with spans in code points, ends exclusive.

    A null or empty text has none. Rows stand for themselves, whatever their ids; other columns
    are not read.

    Result: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal; one row per row.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts):
            out = []
            for text in part.column(1).to_pylist():
                base, spans = all_spans(text or "")
                counts = [sum(s[1] == k for s in spans) for k in range(4)]
                out.append((*counts[:3], hashlib.sha256(joined(base).encode()).hexdigest(),
                            joined(spans), counts[3]))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array([r[i] for r in out], t) for i, t in enumerate(types)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string,"
             " spans string, n_literal long")


def redacted_text(text: str, mark: str = "[SECRET]") -> str:
    """The text with each stretch covered by spans replaced by a mark."""
    out, at = [], 0
    for start, _, end in all_spans(text)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """The same rows and columns with secrets in ``text`` replaced and ``n_chars``, if there, of
    changed texts corrected; null stays null."""
    names = docs.columns

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts):
            at = names.index("text")
            before = part.column(at).to_pylist()
            after = [None if t is None else redacted_text(t) for t in before]
            if "n_chars" in names:
                place = names.index("n_chars")
                counts = [n if a == b else len(b) for n, a, b in zip(
                    part.column(place).to_pylist(), before, after)]
                part = part.set_column(place, "n_chars",
                                       pa.array(counts, part.schema.field(place).type))
            yield part.set_column(at, "text", pa.array(after, pa.string()))
    return docs.mapInArrow(run, docs.schema)
