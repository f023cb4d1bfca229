"""Secret scan: Aho-Corasick keyword prefilter, anchored regexes near the hits, checksum validation.

One automaton over all keywords reads the lowered text once. At a hit the kind's regex is tried at that very
place, nowhere else, so a text without keywords costs one scan. Matches of a kind
are leftmost and do not overlap. Kinds whose tokens carry a check value (base62 CRC-32, Luhn-like mod 97, the
structure of a JSON web token) are kept only if it is right. Runs of hex digits have no
keyword; they are found by their class alone.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.common import id_and_text, map_batches, texts_of

_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_HEX = re.compile(r"[0-9a-f]{32,}")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc_62(m: re.Match) -> bool:
    """Last six characters: CRC-32 of the random part before, in base 62."""
    body, check = m.group(1)[:-6], m.group(1)[-6:]
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = _BASE62[d] + digits
    return digits == check


def _web_token(m: re.Match) -> bool:
    """The first two parts are JSON objects, the first one names an algorithm."""
    try:
        parts = [json.loads(base64.urlsafe_b64decode(p + "=" * (-len(p) % 4))) for p in m.group(0).split(".")[:2]]
    except (ValueError, binascii.Error, RecursionError):
        return False
    return all(isinstance(p, dict) for p in parts) and "alg" in parts[0]


def _mod_97(m: re.Match) -> bool:
    """Account numbers with two check digits: letters as 10 to 35, first four characters last, 1 modulo 97."""
    s = m.group(1).replace(" ", "").upper()
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


@dataclass(frozen=True)
class Kind:
    name: str
    keywords: tuple[str, ...]  # lowered; each match starts at one
    pattern: re.Pattern
    valid: Callable[[re.Match], bool]


#: The base kinds (fixed values), then those of the method.
BASE = (
    Kind("assign", ("password", "passwd", "secret", "token", "api_key", "apikey"), re.compile(_ASSIGN, re.IGNORECASE | re.ASCII), lambda m: len(m.group(2)) >= 8),
    Kind("access", ("akia",), re.compile("AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 16),
)
MORE = (
    Kind("host-token", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _crc_62),
    Kind("package-token", ("npm_",), re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _crc_62),
    Kind("web-token", ("eyj",), re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), _web_token),
    Kind("account", ("iban",), re.compile(r"[Ii][Bb][Aa][Nn][: ]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Z0-9])"), _mod_97),
    Kind("private-key", ("-----begin ",), re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"), lambda m: True),
    Kind("key-pair", ("sk_live_", "rk_live_"), re.compile(r"[sr]k_live_[A-Za-z0-9]{24,}"), lambda m: True),
)
KINDS = (*BASE, *MORE)
ORDER = ("assign", "access", "hex", *(k.name for k in MORE))


@lru_cache(maxsize=1)
def _gate() -> ahocorasick.Automaton:
    gate = ahocorasick.Automaton()
    for k, kind in enumerate(KINDS):
        for word in kind.keywords:
            gate.add_word(word, (k, len(word)))
    gate.make_automaton()
    return gate


def _lowered(text: str) -> str:
    """The text with A-Z lowered and every place kept (str.lower can lengthen a text)."""
    low = text.lower()
    return low if len(low) == len(text) else text.encode().lower().decode()


def find(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start, then in the order of the kinds."""
    hits: dict[int, list[int]] = {}
    for last, (k, size) in _gate().iter(_lowered(text)):
        hits.setdefault(k, []).append(last - size + 1)
    out = [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    for k, starts in hits.items():
        kind, end = KINDS[k], 0
        for start in sorted(starts):
            if start >= end and (m := kind.pattern.match(text, start)):
                end = m.end()  # a match that fails its check still uses up its place
                if kind.valid(m):
                    out.append((kind.name, start, end))
    return sorted(out, key=lambda s: (s[1], ORDER.index(s[0]), s[2]))


def _scan(batch: pa.RecordBatch) -> dict:
    show = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    found = [find(t) for t in texts_of(batch)]
    base = [[s for s in x if s[0] in ORDER[:3]] for x in found]
    out = {"doc_id": batch.column("doc_id")} | {f"n_{k}": [sum(s[0] == k for s in x) for x in base] for k in ORDER[:3]}
    return out | {"base_sha256": [hashlib.sha256(show(x).encode()).hexdigest() for x in base], "spans": [show(x) for x in found]}


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)``, one row per input row.

    Null and empty texts have no spans. Ids are passed on, null or repeated; equal rows get equal results. Empty table: empty result. Other
    columns are ignored.
    """
    return map_batches(id_and_text(docs), _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
