"""Language identification by nearest centroid.

A text becomes a vector of byte n-gram counts (1 to 3 bytes of its lowered letters, other ASCII characters
as spaces, hashed into ``DIMS`` dimensions), damped by log(1 + count), weighted by inverse document frequency and normalised. Each language is
described by several centroids, found by spherical k-means among its own training
texts. A text gets the language of its most similar centroid (cosine); a text whose best
cosine is below the limit of that language and length (from a low quantile of what all training texts reach) is marked rejected.
Short texts reach less, so they have a limit of their own.

Document frequencies are counted over all training rows, pre-added per task, so that what is shuffled is
one vector of fixed length per task. The centroids are fitted on a bounded sample: of a language with more
than ``FIT_ROWS`` different training texts about that many, those with the least hashes.
The fitted model (languages x clusters x DIMS floats, 4 MB for four languages) is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_schema, filter_rows, give_back, id_and_text, map_batches, record_batch, sliced, tidy

#: Dimensions, centroids per language, training texts per language for the centroids, k-means rounds.
DIMS = 1 << 14
CLUSTERS = 6
FIT_ROWS = 1000
ROUNDS = 8
#: A text is rejected below this share of the cosine that all but 0.1 % of the training texts of its language and length reach.
#: With half of it all held-out texts with a letter stay on the test tables, random letters and unlearnt languages go.
REJECT_SHARE = 0.5
REJECT_QUANTILE = 0.001
#: Bytes of letters under which a text is short, and steps of the histogram of cosines.
SHORT = 64
STEPS = 1000
#: Bytes counted at once, and least training rows of a language and length that have a limit of their own.
PIECE = 1 << 20
LEAST_ROWS = 5

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)

#: ASCII letters and bytes of other characters stay, the rest becomes a space.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def counts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed counts of the 1-, 2- and 3-byte n-grams of a text: the dimensions that occur, and how often."""
    total = None
    for at in range(0, max(len(raw), 1), PIECE):
        b = np.frombuffer(raw[max(0, at - 2) : at + PIECE], np.uint8).astype(np.uint32)
        skip = min(at, 2)  # n-grams that end in the piece before are counted there
        h, dims = np.zeros(0, np.uint32), []
        for n in range(3):
            h = (h[: max(len(b) - n, 0)] << np.uint32(8)) | b[n:] if n else b
            dims.append((h[max(skip - n, 0) :] + np.uint32(n + 1)) * _MULTIPLIERS[n] >> np.uint32(18))
        c = np.bincount(np.concatenate(dims).astype(np.int64), minlength=DIMS)
        total = c if total is None else total + c
    dims = np.flatnonzero(total)
    return dims, total[dims]


def letters(text: str) -> bytes:
    """The text in UTF-8, ASCII letters lowered, runs of other ASCII characters as one space."""
    return b" ".join(text.encode().lower().translate(_LETTERS).split())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised TF-IDF vector of a text: its dimensions and their weights."""
    dims, c = counts(letters(text))
    v = np.log1p(c).astype(np.float32) * idf[dims]
    return dims, v / max(float(np.linalg.norm(v)), 1e-12)


def _dense(rows: list[bytes]) -> np.ndarray:
    """Matrix of vectors that came as 2-byte dimensions followed by 4-byte weights."""
    x = np.zeros((len(rows), DIMS), np.float32)
    for k, row in enumerate(rows):
        n = len(row) // 6
        x[k, np.frombuffer(row, np.uint16, n)] = np.frombuffer(row, np.float32, n, 2 * n)
    return x


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # DIMS x centroids
    owner: np.ndarray  # index of its language
    limits: np.ndarray  # least accepted cosine of each language, of longer and of short texts

    def predict(self, text: str) -> tuple[int, float]:
        """Index of the language and cosine of the most similar centroid."""
        dims, weights = vector(text, self.idf)
        cosine = weights @ self.centroids[dims]
        best = int(cosine.argmax())
        return int(self.owner[best]), min(max(float(cosine[best]), 0.0), 1.0)


def _document_frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    target = arrow_schema("df array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIMS + 1, np.int64)  # the last one counts the rows
        for batch in batches:
            for part in sliced(batch):
                for text in part.column("text").to_pylist():
                    df[counts(letters(text))[0]] += 1
                    df[DIMS] += 1
        if df[DIMS]:
            yield record_batch({"df": [df]}, target)

    parts = training.select("text").mapInArrow(tidy(run), "df array<long>")
    # One number per dimension and task, summed under the dimension: fixed length whatever the input.
    sums = parts.select(F.posexplode("df").alias("dim", "n")).groupBy("dim").agg(F.sum("n").alias("n"))
    df = np.zeros(DIMS + 1)
    for row in sums.collect():  # DIMS + 1 rows
        df[row["dim"]] = row["n"]
    return df[:DIMS], int(df[DIMS])


def _cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means: first centre the mean, next ones the texts least like the centres so far."""
    centres = [x.mean(axis=0)]
    for _ in range(1, min(k, len(x))):
        best = (x @ np.array(centres).T).max(axis=1)
        centres.append(x[np.argsort(best, kind="stable")[len(x) // 20]])
    c = np.array(centres)
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    for _ in range(ROUNDS):
        at = (x @ c.T).argmax(axis=1)
        sums = np.array([x[at == j].sum(axis=0) if (at == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c


def fit(training: DataFrame) -> Model | None:
    """Fit on ``(text, lang)``, without null or letterless texts; None if nothing is left.

    Every ``lang`` value is learnt, however few texts it has: of a language with fewer than ``CLUSTERS`` texts each is a centroid. Between centroids
    that are equally near, the first language in text order wins.
    """
    training = training.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    df, total = _document_frequencies(training)
    if not total:
        return None
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    keyed = training.select("lang", F.xxhash64("text").alias("h"), "text")
    # Hashes are even, so a share of them is a sample of known size: no sorting, and no task that gets a whole language.
    different = {r["lang"]: r["n"] for r in keyed.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not different:
        return None
    place = F.pmod("h", F.lit(1 << 30))
    wanted = reduce(or_, [(F.col("lang") == language) & (place < int(min(FIT_ROWS / n, 1.0) * (1 << 30))) for language, n in different.items()])
    chosen = keyed.filter(wanted).dropDuplicates(["lang", "h"])

    def run(batch: pa.RecordBatch) -> dict:
        found = [vector(t, idf) for t in batch.column("text").to_pylist()]
        sparse = lambda dims, weights: dims.astype(np.uint16).tobytes() + weights.astype(np.float32).tobytes()
        return {"lang": batch.column("lang"), "h": batch.column("h"), "v": [sparse(*v) for v in found]}

    sample: dict[str, list[tuple[int, bytes]]] = {}
    for row in map_batches(chosen, run, "lang string, h long, v binary").collect():  # about languages x FIT_ROWS rows
        sample.setdefault(row["lang"], []).append((row["h"], bytes(row["v"])))
    languages = sorted(sample)
    centroids, owner = [], []
    for k, language in enumerate(languages):
        x = _dense([v for _, v in sorted(sample[language])])
        c = _cluster(x, CLUSTERS)
        centroids.append(c)
        owner += [k] * len(c)
    model = Model(languages, idf, np.concatenate(centroids).T.astype(np.float32).copy(), np.array(owner), np.zeros((len(languages), 2)))
    del sample
    give_back()
    model.limits = REJECT_SHARE * _low_cosines(training, model)
    return model


def is_short(text: str) -> int:
    return int(len(letters(text)) < SHORT)


def _low_cosines(training: DataFrame, model: Model) -> np.ndarray:
    """Cosine that all but ``REJECT_QUANTILE`` of the training rows reach, by predicted language and length.

    One histogram over all rows, pre-added per task. A language with fewer than ``LEAST_ROWS`` rows of a length takes
    the cosine of all languages.
    """
    shared = training.sparkSession.sparkContext.broadcast(model)
    shape = (len(model.languages), 2, STEPS + 1)
    target = arrow_schema("cell long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(shape, np.int64)
        for batch in batches:
            for part in sliced(batch):
                for text in part.column("text").to_pylist():
                    k, cosine = shared.value.predict(text)
                    found[k, is_short(text), int(cosine * STEPS)] += 1
        at = np.flatnonzero(found)
        yield record_batch({"cell": at, "n": found.ravel()[at]}, target)

    total = np.zeros(shape, np.int64)
    for row in training.select("text").mapInArrow(tidy(run), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total.ravel()[row["cell"]] = row["n"]  # at most languages x 2 x STEPS rows
    everyone = total.sum(axis=0)
    low = np.zeros(shape[:2])
    for k, short in np.ndindex(*shape[:2]):
        n = total[k, short] if total[k, short].sum() >= LEAST_ROWS else everyone[short]
        low[k, short] = np.searchsorted(np.cumsum(n), REJECT_QUANTILE * n.sum(), "right") / STEPS if n.any() else 0.0
    return low


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)``, one row per input row; reads only the text.

    ``und`` with score 0 and rejected if the text is null or has no letter, or if there is no model. Score:
    cosine with the nearest centroid. Ids are passed on, null or repeated. Empty table: empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size, see the head of the module

    def run(batch: pa.RecordBatch) -> dict:
        found = [judge(t, shared.value) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id")} | {name: [f[k] for f in found] for k, name in enumerate(("lang_pred", "score", "rejected"))}

    return map_batches(id_and_text(docs), run, "doc_id long, lang_pred string, score double, rejected boolean")


def judge(text: str | None, model: Model | None) -> tuple[str, float, bool]:
    """Language, score and whether it is rejected, of one text."""
    if model is None or not text or not has_letter(text):
        return "und", 0.0, True
    k, score = model.predict(text)
    return model.languages[k], score, score < float(model.limits[k, is_short(text)])


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filter_rows(docs, lambda batch: [not judge(t, shared.value)[2] for t in batch.column("text").to_pylist()])


def held_out(column: str = "doc_id"):
    """Rows that are never learnt from: crc32 of the id as text leaves 1 when divided by 3. False for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_documents(docs: DataFrame) -> Model | None:
    """Fit on the rows of ``documents`` that are not held out; a row with a null id is not learnt from."""
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return fit(typed.filter(~held_out() & F.col("doc_id").isNotNull()).select("text", "lang"))


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the rows that are not held out, predict all: ``(doc_id, held_out, lang_pred, score, rejected)``."""
    return predict(docs, fit_documents(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
