"""Spelling variants: words one edit apart, by asymmetric chunks, and the commoner form that each goes back to.

1. *Words.* Runs of letters are counted per task before they are shuffled, so a word that makes up a third of the corpus is one row per task.
2. *Chunks.* Of two words one edit apart, the shorter (of equal ones the lesser) gives two disjoint chunks, its halves;
   the edit spares one of them. The other word gives its grams of that length at the places where a chunk can come to stand: shifted by
   nothing before the edit, by the difference of the lengths behind it, so by one at most.
3. *Rest.* What lies beside the spared half holds the edit, so of its two halves one is spared too. A chunk and a spared half of
   its rest make one join key: half a word alone is shared by thousands of made-up words (212 million pairs to check on 374,000 words,
   16 million with the rest). The key is a hash; the pairs that meet under it are checked by edit distance inside the join.
4. *Forms.* A word's form is its commonest near word if that is ten times as common; roots are found by pointer doubling, in as many
   rounds as the logarithm of the longest chain, which has one step for each digit of the largest count at most.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_schema, cut, id_and_text, record_batch, sliced

#: Words shorter or rarer than this are left out; a form is FORM times as common as the word.
LEAST_LENGTH, LEAST_COUNT, FORM = 7, 2, 10
#: Of as many runs one loses a code point (the corpus has few misspellings of its own).
DELETE = 31
#: Different words that a task holds before it passes their counts on.
HELD = 300_000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    target = arrow_schema("word string, n long")
    # Only runs that can still be long enough after losing a code point.
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}")
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return record_batch({"word": list(held), "n": list(held.values())}, target)

    for batch in batches:
        for part in sliced(batch):
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                # Bytes lower A-Z and nothing else.
                for word, n in Counter(runs.findall(text.encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), before)
                    if h % DELETE == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < LEAST_LENGTH:
                            continue
                    held[word] += n
            if len(held) > HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def words(docs: DataFrame) -> DataFrame:
    """``(word, n)``: distinct words of at least LEAST_LENGTH code points and LEAST_COUNT occurrences.

    Maximal runs of A-Z, a-z, U+00C0 to U+00FF, with A-Z lowered. Of the runs whose CRC-32 of ``<doc_id>:<run>`` DELETE divides, the
    code point at CRC-32 modulo length is deleted. Null text: none; null id: the empty string. Every row counts, repeated ones too.
    """
    found = id_and_text(docs).mapInArrow(_counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _keys(word: Column, length: Column, shift: int) -> list[Column]:
    """The four keys of a word for chunk-giving words of ``length``; its own length is ``length + shift``.

    Cut into quarters, key k leaves out quarter k: the half that is spared and the half of the rest that is spared.
    """
    half = F.floor(length / 2)
    cuts = [F.lit(0), F.floor(half / 2), half, half + F.floor((length - half) / 2), length]
    cuts = [c.cast("int") for c in cuts]
    out = []
    for k in range(4):
        left = F.substr(word, F.lit(1), cuts[k])
        right = F.substr(word, cuts[k + 1] + F.lit(1 + shift))
        out.append(F.xxhash64(length, F.lit(k), left, right))
    return out


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """``(word, n, other, other_n)``: each pair of words of ``vocabulary(word, n)`` at edit distance one, both ways round.

    Words are distinct; lengths and edits are in code points. Words of under four code points have empty quarters, which is no
    harm: a key only has to be the same for both.
    """
    length = F.char_length("word")
    chunks = vocabulary.select("word", "n", F.explode(F.array_distinct(F.array(*_keys(F.col("word"), length, 0)))).alias("key"))
    grams = [k for shift in (0, 1) for k in _keys(F.col("word"), length - shift, shift)]
    grams = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.explode(F.array_distinct(F.array(*grams))).alias("key"))
    lengths = F.char_length("word"), F.char_length("other")
    ordered = (lengths[0] < lengths[1]) | ((lengths[0] == lengths[1]) & (F.col("word") < F.col("other")))
    one_edit = F.levenshtein("word", "other", 1) == 1
    once = chunks.join(grams, "key").filter(ordered & one_edit).select("word", "n", "other", "other_n").distinct()
    return once.unionByName(once.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of every word of ``forms(word, form)``, following forms to the last; no chain may be a cycle."""
    now = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(further, "root", "left_semi").isEmpty():
            return now
        now = cut(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(docs: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of ``docs`` (see ``words``).

    ``n_near``: words at edit distance one. ``form``: the one of largest ``n`` (ties: smallest in code-point order) if that
    is at least FORM times the word's, else null, as ``form_n``, its ``n``. ``root``: the last of the chain of forms, the word itself
    if it has none. Texts of any length are read whole. Empty table: no rows. Other columns are ignored.
    """
    vocabulary = cut(words(docs), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    near = near_pairs(vocabulary).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    common = -F.col("best.less") >= FORM * F.col("n")
    near = cut(near.select("word", "n_near", F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n")), "near")
    last = roots(near.filter(F.col("form").isNotNull()))
    every = vocabulary.join(near, "word", "left").join(last, "word", "left")
    return every.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
