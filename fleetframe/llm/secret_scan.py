"""Secret scan: base patterns, and assignment-aware lexing of source and configuration syntax.

The lexer reads `name = literal` pairs (also `name: literal`, quoted names, `:=`, `=>`, literals joined by
`+`, a type between name and `=`, subscripts as targets, escapes and triple quotes), follows names that were given a literal earlier in the text, and scores the literal by how
sensitive the target's name is and by whether it looks like a secret.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from fleetframe.llm.common import per_text, read

KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 0.5
_ASSIGN = re.compile(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: Literals: triple-quoted ones may span lines, a backslash escapes in ordinary ones.
_LITERAL = r"""(?:\"{3}(?s:.*?)\"{3}|'{3}(?s:.*?)'{3}|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|"[^"\n]*"|'[^'\n]*'|`[^`\n]*`)"""
_IDENTIFIER = r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*"
#: What may stand between a name's colon and `=`: a type such as str, Optional[str], char[], string | null.
_TYPE = r"[ \t]*:[ \t]*[A-Za-z_$][\w$.]*(?:[\[<][\w$., \t\[\]<>|]{0,80}[\]>])?\??(?:[ \t]*\|[ \t]*[A-Za-z_$][\w$.]{0,40}){0,4}[ \t]*(?==(?![=>]))"
_PAIR = re.compile(
    rf"""(?<![\w$.-])["']?(?P<name>[A-Za-z_$][\w$]*(?:[.-][A-Za-z_$][\w$]*)*)["']?(?:[ \t]*\])?(?:{_TYPE}|[ \t]*)(?::=|=>|=(?!=)|:(?![:/]))[ \t]*"""
    rf"""(?P<value>(?:{_LITERAL}|{_IDENTIFIER}(?=[ \t]+\+[ \t]*["'`A-Za-z_$]|\+["'`]))(?:[ \t]*\+[ \t]*(?:{_LITERAL}|{_IDENTIFIER}))*"""
    rf"""|[^\s"'`,;(){{}}\[\]]+(?:[ \t]*\+[ \t]*{_LITERAL})*)""",
    re.ASCII)
_PART = re.compile(rf"(?P<literal>{_LITERAL})|(?P<name>{_IDENTIFIER})", re.ASCII)
_CHAIN = re.compile(rf"({_IDENTIFIER})(?:[ \t]+\+|\+[\"'`])", re.ASCII)
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)
_NAME = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*\Z", re.ASCII)
_REFERENCE = re.compile(r"\A\$?\{?([A-Za-z_$][\w$.]*)\}?\Z", re.ASCII)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: How sensitive a target is by the words of its name.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "private": 0.5, "key": 0.5, "signature": 0.5,
    "api": 0.4, "access": 0.4, "salt": 0.5,
}
_PLACEHOLDER = re.compile(r"(?i)\A(x+|\*+|\.+|none|null|true|false|change_?me|your.*|example.*|<.*>|\$\{.*|test.*|todo.*)\Z")


def sensitivity(name: str) -> float:
    """0 to 1; the words of the name add up (`private_key`, `apiKey`)."""
    words = [w.lower() for w in _WORD.findall(name.rpartition(".")[2].replace("-", "_"))]
    return min(1.0, sum(SENSITIVE.get(w, 0.0) for w in words))


def plausibility(literal: str) -> float:
    """0 to 1: long, mixed, of high entropy, and no placeholder or prose."""
    if len(literal) < 8 or _PLACEHOLDER.match(literal) or re.search(r"\s", literal):
        return 0.0
    counts = Counter(literal)
    entropy = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    kinds = sum(bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9]"))
    return min(1.0, entropy / 4) * (0.4 + 0.2 * kinds if kinds > 1 else 0.4)


def _content(literal: str) -> str:
    quote = 3 if len(literal) >= 6 and literal[:3] in ('"""', "'''") else 1
    inner = literal[quote:-quote]
    return inner if literal[0] == "`" else _ESCAPE.sub(r"\1", inner)


def _chain(value: str, known: dict[str, tuple[int, int, str]]) -> tuple[str, int] | None:
    """The text of literals and known names joined by `+` and the end of the last; None if there is none."""
    parts, end = [], 0
    for m in _PART.finditer(value):
        if m["literal"] or m["name"] in known:
            parts.append(_content(m["literal"]) if m["literal"] else known[m["name"]][2])
            end = m.end()
    return ("".join(parts), end) if parts else None


def pairs(text: str) -> list[tuple[str, int, int, str]]:
    """Name, start, end and literal of each assignment; a name stands for the literal it was last given."""
    known: dict[str, tuple[int, int, str]] = {}
    found = []
    for match in _PAIR.finditer(text):
        name, value, start = match["name"], match["value"], match.start("value")
        chain = _CHAIN.match(value)
        made = _chain(value, known) if value[0] in "\"'`" or chain else None
        if made:
            item = (start, start + made[1], made[0])
        else:
            bare = (chain[1] if chain else value).rstrip(".")
            reference = _REFERENCE.match(bare)
            if reference and reference[1] in known:
                item = known[reference[1]]
            elif _NAME.match(bare) and not any(c.isdigit() for c in bare):
                continue
            else:
                item = (start, start + len(bare), bare)
        known[name] = item
        found.append((name, *item))
    return found


def scan(text: str) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) in code points, by start, then by kind as listed."""
    spans = []
    if "=" in text or ":" in text:
        spans += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    if "=" in text or ":" in text:
        taken = sorted(spans)
        added = set()
        for name, start, end, literal in pairs(text):
            if sensitivity(name) * plausibility(literal) >= THRESHOLD and not any(a < end and start < b for a, b, _ in taken):
                added.add((start, end, "literal"))
        spans += added
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secret_spans(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Per row: `found`, an array of (kind, start, end). Null counts as empty; repeated rows stay repeated."""
    def worker(texts: list[str | None]) -> dict[str, list]:
        return {"found": [[{"kind": k, "start": a, "end": b} for a, b, k in scan(t or "")] for t in texts]}

    return per_text(docs, keep, text, "found array<struct<kind: string, start: long, end: long>>", worker)


def secret_digest(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, the digest of the base spans, and all spans as text."""
    def worker(texts: list[str | None]) -> dict[str, list]:
        found = [scan(t or "") for t in texts]
        base = [[s for s in spans if s[2] != "literal"] for spans in found]
        counts = {f"n_{kind}": [sum(s[2] == kind for s in spans) for spans in found] for kind in KINDS[:3]}
        return counts | {
            "base_sha256": [hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base],
            "spans": [joined(spans) for spans in found],
        }

    return per_text(docs, keep, text, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", worker)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(read(spark, sf_dir, "documents"), ["doc_id"])
