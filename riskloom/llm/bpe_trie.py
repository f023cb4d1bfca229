"""Byte-level BPE by depth-first traversal of a trie of distinct words.

Two facts carry the method. (1) A token sequence is the BPE encoding of its bytes exactly when every two
neighbours in it are: merging the bytes of the pair alone gives back the pair. (2) So the encoding of a prefix is
known from its *last token*: it is the one token that ends the prefix and fits behind
the last token of what comes before it. A depth-first walk keeps, for the prefix it stands on, the last
token and the tokens that are still being matched; a step down one byte extends them.
Words that share a prefix share those states, so each shared prefix is encoded once.

The trie is held as its words in byte order: two neighbours in that order branch at their common prefix, so
walking the sorted list is the depth-first walk and only the states of one path are in memory.

Texts are split by the tokenizer's own pattern; strings of added tokens are cut out first, as the
``tokenizers`` library does by default. The vocabulary file is a parameter, its content is only
read. Nothing is shuffled: each task encodes the distinct words of its batches, and remembers
the commonest way of all (a bounded table of words seen before).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from os.path import commonprefix

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from riskloom.llm.common import arrow_schema, id_and_text, record_batch, sliced, tidy

#: Split pattern of byte-level BPE as published with its vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words remembered by a task between batches, pairs of tokens by a worker, and characters of text encoded at once.
REMEMBERED = 400_000
PAIRS = 400_000
AT_ONCE = 4_000_000


def _byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in vocabulary files: itself if printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and added tokens of one ``tokenizer.json`` with a byte-level BPE model."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.ids = {raw(t): i for t, i in model["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.added.items()}
        self.split = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.children = self._token_tree()

    def merge(self, raw: bytes) -> list[bytes]:
        """Plain BPE of a short string: merge the pair of least rank until none is left."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            ranks = [self.rank.get(p, len(self.rank)) for p in zip(parts, parts[1:])]
            least = min(ranks)
            if least == len(self.rank):
                break
            at, new = 0, []
            while at < len(parts):
                if at < len(ranks) and ranks[at] == least and (parts[at], parts[at + 1]) in self.rank:
                    new.append(parts[at] + parts[at + 1])
                    at += 2
                else:
                    new.append(parts[at])
                    at += 1
            parts = new
        return parts

    def fits(self, a: bytes, b: bytes) -> bool:
        """Whether token ``b`` may follow token ``a``."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return known

    def _token_tree(self) -> dict:
        """Tokens that merging can make, as nested dicts by byte; key -1 holds the token."""
        root: dict = {}
        made = {a + b for a, b in self.rank} | {bytes([b]) for b in range(256)}
        for token in self.ids:
            if token in made and self.merge(token) == [token]:
                node = root
                for b in token:
                    node = node.setdefault(b, {})
                node[-1] = token
        return root


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_words(words: list[bytes], v: Vocabulary) -> dict[bytes, tuple[int, ...]]:
    """Encoding of each distinct word: one depth-first walk over the trie of the words.

    State at depth k: ``last[k]`` the last token of the first k bytes, ``open_[k]`` the ``(start, tree node)`` of tokens
    begun before byte k that may still grow.
    """
    root, fits, seen = v.children, v.fits, v.pairs.get
    last: list[bytes] = [b""]
    open_: list[list[tuple[int, dict]]] = [[]]
    out: dict[bytes, tuple[int, ...]] = {}
    before = b""
    for word in sorted(set(words)):
        depth = len(commonprefix((before, word)))
        del last[depth + 1 :], open_[depth + 1 :]
        for k in range(depth, len(word)):
            byte, growing, token = word[k], [], None
            for start, node in open_[k]:
                child = node.get(byte)
                if child is not None:
                    ended = child.get(-1)
                    if ended is None:
                        growing.append((start, child))
                        continue
                    if len(child) > 1:
                        growing.append((start, child))
                    if token is None:
                        pair = (last[start], ended)
                        known = seen(pair) if start else True
                        if known or known is None and fits(*pair):
                            token = ended
            child = root[byte]
            growing.append((k, child))
            # One token fits; if it is none of the longer ones, it is the byte itself.
            last.append(child[-1] if token is None else token)
            open_.append(growing)
        ids, end = [], len(word)
        while end:
            ids.append(v.ids[last[end]])
            end -= len(last[end])
        out[word] = tuple(reversed(ids))
        before = word
    return out


class Encoder:
    """Encodes and decodes texts of one task; remembers words between batches."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.known: dict[str, tuple[int, ...]] = {}

    def _pieces(self, text: str) -> list[str]:
        if self.v.cut is None:
            return self.v.split.findall(text)
        pieces: list[str] = []
        for k, part in enumerate(self.v.cut.split(text)):
            pieces.extend([part] if k % 2 else self.v.split.findall(part))
        return pieces

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= AT_ONCE):
                size += len(texts[end])
                end += 1
            pieces = [self._pieces(t) for t in texts[at:end]]
            if len(self.known) > REMEMBERED:
                self.known.clear()
            new = set().union(*pieces).difference(self.known)
            self.known.update((t, (self.v.added[t],)) for t in new.intersection(self.v.added))
            words = {w.encode(): w for w in new.difference(self.v.added)}
            self.known.update((words[b], ids) for b, ids in encode_words(list(words), self.v).items())
            get = self.known.__getitem__
            out.extend(list(chain.from_iterable(map(get, p))) for p in pieces)
            at = end
        return out

    def decode(self, ids: list[int]) -> str:
        """Bytes of the tokens as text, what is no UTF-8 replaced."""
        return b"".join(map(self.v.bytes.__getitem__, ids)).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, one row per input row; with ``with_ids`` also ``ids`` and ``decoded``.

    ``path``: a ``tokenizer.json`` that every executor can open. Null text: as the empty one, no tokens. Ids are passed on as they
    are, null or repeated. Empty table: empty result. Other columns are ignored.
    """

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    target = arrow_schema(schema)
    digest = lambda s: hashlib.sha256(s.encode("utf-8", "replace")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path))  # its words go with the task, as workers live on for other work
        for batch in batches:
            for part in sliced(batch):
                ids = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                decoded = [encoder.decode(x) for x in ids]
                out = {"doc_id": part.column("doc_id"), "n_tokens": [len(x) for x in ids], "ids_sha256": [digest(",".join(map(str, x))) for x in ids], "decoded_sha256": [digest(x) for x in decoded]}
                yield record_batch(out | ({"ids": ids, "decoded": decoded} if with_ids else {}), target)

    return id_and_text(docs).mapInArrow(tidy(run), schema)
