"""Secret scans: keywords by Aho-Corasick, anchored patterns at the hits, checksums last.

An automaton over all keywords reads each whole text once. A pattern is tried only where its
keyword stands, at exactly that place. Runs of hex digits have no keyword; they are found as
runs of 16 or more at once. Tokens that carry a checksum are reported only if it is right.

Kinds, in the order in which equal starts are listed: assign, access, hex (the base), then
github and npm (a prefix, 30 letters or digits, and their CRC-32 as six base-62 digits), card
(13 to 19 digits with a right Luhn digit, near a word for a card).

Offsets are code points, ends exclusive. Defined results: null and empty texts hold nothing;
rows that repeat give equal rows; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keywords and patterns of the kinds.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "card": ("card", "visa", "mastercard", "amex"),
}
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CHECKED = {
    "github": re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "npm": re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
}
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])")
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LEAST_ASSIGN, LEAST_ACCESS, CARD_REACH = 12, 18, 40
KINDS = ("assign", "access", "hex", "github", "npm", "card")
BASE = KINDS[:3]


def automaton() -> ahocorasick.Automaton:
    found: dict[str, list[str]] = {}
    for kind, words in KEYWORDS.items():
        for word in words:
            found.setdefault(word, []).append(kind)
    tree = ahocorasick.Automaton()
    for word, kinds in found.items():
        tree.add_word(word, (len(word), tuple(kinds)))
    tree.make_automaton()
    return tree


def lowered(text: str) -> str:
    """Lower case of the same length, so that places agree."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def checksum_holds(body: str, check: str) -> bool:
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = DIGITS[rest] + digits
    return digits == check


def luhn_holds(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def spans_of(text: str, tree: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), in order."""
    found = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    hits: list[tuple[int, str]] = []
    for last, (length, kinds) in tree.iter(lowered(text)):
        hits.extend((last - length + 1, kind) for kind in kinds)
    hits.sort()
    until = dict.fromkeys(KINDS, 0)  # matches of a kind don't overlap
    for start, kind in hits:
        if start < until[kind] and kind != "card":
            continue
        if kind == "assign":
            if m := ASSIGN.match(text, start):
                until[kind] = m.end()
                if m.end(2) - m.start(2) >= LEAST_ASSIGN:
                    found.append((start, 0, m.end()))
        elif kind == "access":
            if m := ACCESS.match(text, start):
                until[kind] = m.end()
                if m.end() - start >= LEAST_ACCESS:
                    found.append((start, 1, m.end()))
        elif kind in CHECKED:
            m = CHECKED[kind].match(text, start)
            if m and checksum_holds(m[1], m[2]):
                until[kind] = m.end()
                found.append((start, KINDS.index(kind), m.end()))
        else:
            begin = max(until[kind], start - CARD_REACH)
            while m := CARD.search(text, begin, start + CARD_REACH + 40):
                if m.start() > start + CARD_REACH:
                    break
                begin = m.end()
                if luhn_holds(re.sub(r"[ -]", "", m[0])):
                    until[kind] = m.end()
                    found.append((m.start(), 5, m.end()))
    return sorted(found)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_checked long"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, counts of the base kinds, a hash of the base spans, all spans, and the number of
    spans with a checksum; one row per row of ``docs``."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = automaton()
        for batch in batches:
            rows = []
            for value in batch.column("_text"):
                spans = spans_of(value.as_py() or "", tree)
                base = [s for s in spans if s[1] < 3]
                counts = [sum(s[1] == k for s in base) for k in range(3)]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*counts, digest, _joined(spans), len(spans) - len(base)))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[key, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_checked"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text).alias("_text")).mapInArrow(scanned, f"`{key}` {kind}, {_SCHEMA}")


def op2_secret_scan(docs: DataFrame) -> DataFrame:
    return scan(docs)
