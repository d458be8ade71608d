"""Secret scans: keywords first, anchored expressions at their hits, then checksums.

One Aho-Corasick automaton holds all keywords and runs once over each whole text, with A to Z
lowered. Only where a keyword hits is an expression matched, anchored at the hit. Tokens that
carry a checksum must pass it. Runs of hexadecimal digits have no keyword and are found by
one expression over the text.

Null and empty texts have no spans. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import lower_ascii

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
#: Tokens of 30 characters and six of checksum after a prefix, with no letter or digit around them.
CHECKED = re.compile(r"(?<![A-Za-z0-9])(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
#: Kinds in the order that breaks ties of the start.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE = KINDS[:3]
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, found array<struct<kind:string,start:int,end:int>>"


def checksum(body: str) -> str:
    """CRC-32 of the body in six digits of base 62."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, k = divmod(value, 62)
        digits = BASE62[k] + digits
    return digits


@cache
def _automaton():
    import ahocorasick

    made = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            made.add_word(word, (kind, len(word)))
    made.make_automaton()
    return made


def scan(text: str | None) -> list[tuple[int, str, int]]:
    """Spans of a text as (start, kind, end), by start, then kind as listed."""
    if not text:
        return []
    hits = sorted((end - n + 1, kind) for end, (kind, n) in _automaton().iter(lower_ascii(text)))
    found, after = [], {"assign": 0, "access": 0}
    for at, kind in hits:
        if kind in after:
            if at < after[kind] or not (m := (ASSIGN if kind == "assign" else ACCESS).match(text, at)):
                continue
            after[kind] = m.end()
            if len(m.group(2)) >= 8 if kind == "assign" else m.end() - at >= 16:
                found.append((at, kind, m.end()))
        elif (m := CHECKED.match(text, at)) and checksum(m.group(1)) == m.group(2):
            found.append((at, kind, m.end()))
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def _joined(found: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in found)


def _report(texts: list[str | None]) -> pd.DataFrame:
    rows = [scan(t) for t in texts]
    base = [[x for x in found if x[1] in BASE] for found in rows]
    out = {f"n_{kind}": [sum(x[1] == kind for x in found) for found in base] for kind in BASE}
    out["base_sha256"] = [hashlib.sha256(_joined(found).encode()).hexdigest() for found in base]
    out["spans"] = [_joined(found) for found in rows]
    out["found"] = [[(kind, start, end) for start, kind, end in found] for found in rows]
    return pd.DataFrame(out, columns=[x.split()[0] for x in SCHEMA.split(", ")])


def find_secrets(df: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """Adds the struct column ``out`` with the fields of ``SCHEMA``; every row stays."""

    def report(texts: pd.Series) -> pd.DataFrame:
        return _report(texts.tolist())

    report.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return df.withColumn(out, F.pandas_udf(report, SCHEMA).asNondeterministic()(F.col(text).cast("string")))


def masked(text: str | None, mask: str) -> str | None:
    """The text with each united span replaced by ``mask``."""
    found = scan(text)
    if not found:
        return text
    parts, at = [], 0
    for start, _, end in found:
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact_secrets(df: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``df`` with the secrets in ``text`` masked; rows, order and other columns stay."""

    def redact(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda t: masked(t, mask), na_action="ignore")

    redact.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(text, F.pandas_udf(redact, "string")(F.col(text)))
