"""What each order of a set of filters would remove, by min-plus removal ranks.

A document is removed at the least position, in the order, of the filters that it fails. With k filters there are at
most 2^k patterns of failures, so documents are first counted by pattern (per part of the corpus and per label, a map-side
combined aggregate). Then, with the mask matrix ``M`` (pattern x filter: 0 where the pattern fails the filter, else infinity) and the
inverse permutations ``P`` (filter x order: the filter's position), the min-plus product of ``M`` and ``P``, the least of ``M[m, f] + P[f, o]`` over f, is the step at
which pattern m goes in order o. The counts of the patterns are scattered to these steps, which gives
every figure of every order without touching a document again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import cut, order_id

#: All k! orders are reported, so k is bounded.
MOST_FILTERS = 7

_FIGURES = ("kept", "removed", "redundant", "unique_fails")


def removal_steps(k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(orders, steps)``: filters of each order (order x step), and for each pattern and order the step that removes it, ``k`` if none."""
    orders = np.array(list(permutations(range(k))), np.int64).reshape(-1, k)
    position = np.argsort(orders, axis=1).T
    fails = (np.arange(1 << k)[:, None] >> np.arange(k)) & 1
    mask = np.where(fails == 1, 0, k)
    steps = np.full((1 << k, len(orders)), k, np.int64)
    for f in range(k):
        np.minimum(steps, mask[:, f, None] + position[None, f], out=steps)
    return orders, steps


def figures(weights: np.ndarray, k: int) -> dict[str, np.ndarray]:
    """Per order and step, from ``weights`` (pattern x [documents, other weights]) of one part.

    ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``shapley`` of the documents, ``lost`` of each other weight.
    """
    orders, steps = removal_steps(k)
    which = np.arange(len(orders))
    removed = np.zeros((weights.shape[1], len(orders), k + 1), np.int64)
    for pattern in np.flatnonzero(weights.any(1)):
        removed[:, which, steps[pattern]] += weights[pattern][:, None]
    removed = removed[:, :, :k]
    documents = weights[:, 0]
    bit = (np.arange(1 << k)[:, None] >> np.arange(k)) & 1
    failing = documents @ bit
    here = removed[0]
    total = np.zeros(k, np.int64)
    np.add.at(total, orders, here)
    return {
        "kept": documents.sum() - np.cumsum(here, axis=1),
        "removed": here,
        "redundant": failing[orders] - here,
        "unique_fails": documents[1 << np.arange(k)][orders],
        "shapley": total[orders],
        "lost": removed[1:],
    }


def audit(rows: DataFrame, filters: Sequence[str], part: str, labels: Sequence[str] = ()) -> DataFrame:
    """Every order of ``filters`` on every part of ``rows``: ``(part, filter_order, step, kept, removed, redundant, unique_fails, shapley, lost_...)``.

    ``rows`` has a boolean column for each filter (true: fails; null: does not), the string column ``part`` (null: empty
    string) and boolean ``labels``. One row per part, order (names joined) and step: ``kept`` after the step, ``removed`` by it, ``redundant``: fail its
    filter but were removed before, ``unique_fails``: fail no other filter, ``shapley``: what the filter removes summed over all orders,
    ``lost_<label>``: removed by it and labelled. Zeros are reported; a part without rows is not. Equal rows count as often as they
    occur. Empty table: no rows.
    """
    names, k = list(filters), len(filters)
    if not 1 <= k <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters, as every order is reported")
    pattern = sum((F.when(F.col(f), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(names)), F.lit(0))
    marks = [F.coalesce(F.col(x), F.lit(False)).cast("long").alias(f"_w{i}") for i, x in enumerate(labels)]
    seen = rows.select(F.coalesce(F.col(part), F.lit("")).alias("part"), pattern.cast("int").alias("_pattern"), *marks)
    sums = [F.count("*").alias("_n"), *(F.sum(f"_w{i}").alias(f"_w{i}") for i in range(len(labels)))]
    counted = seen.groupBy("part", "_pattern").agg(*sums)
    # At most 2^k entries for each part.
    held = counted.groupBy("part").agg(F.collect_list("_pattern").alias("patterns"), F.collect_list(F.array("_n", *(f"_w{i}" for i in range(len(labels))))).alias("weights"))
    lost = [f"lost_{x}" for x in labels]
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((c, pa.int64()) for c in (*_FIGURES, "shapley", *lost))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, _ = removal_steps(k)
        title = np.repeat(["".join(names[f] for f in o) for o in orders], k)
        step = np.tile(np.arange(1, k + 1), len(orders))
        for batch in batches:
            for name, patterns, weights in zip(*(batch.column(c).to_pylist() for c in ("part", "patterns", "weights")), strict=True):
                w = np.zeros((1 << k, 1 + len(labels)), np.int64)
                w[patterns] = weights
                f = figures(w, k)
                columns = [[name] * len(step), title, step, *(f[c].ravel() for c in (*_FIGURES, "shapley")), *(x.ravel() for x in f["lost"])]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(columns, schema)], schema=schema)

    ddl = "part string, filter_order string, step int, " + ", ".join(f"`{c}` long" for c in (*_FIGURES, "shapley", *lost))
    return held.mapInArrow(run, ddl)


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on one text: A under 50 words, B under 65 % distinct words, C over 5 % capitals, D a symbol."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * capitals > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, A, B, C, D, E, good, toxic)``, one row per row of ``docs``; E: the text is that of a smaller id.

    Null text: as the empty one (so E compares them too); null id: before every other, and without labels; rows with one id are not
    copies of each other, but each of smaller ids. Several labels of one id: any that says so. Null source: empty string.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    id_ = F.col("doc_id").cast("long")
    rows = docs.select(id_.alias("doc_id"), order_id().alias("doc"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.unhex(F.md5(text)).alias("digest"), *(c.alias(n) for n, c in text_filters(text).items()))
    rows = cut(rows, "filter-rows")
    # A text's first id joins back on (text, id): copies of one text are spread over as many keys as they have ids.
    first = rows.groupBy("digest").agg(F.min("doc").alias("doc")).withColumn("first", F.lit(True))
    known = labels.select(id_.alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    return rows.join(first, ["digest", "doc"], "left").join(known, "doc_id", "left").select("part", "A", "B", "C", "D", F.col("first").isNull().alias("E"), "good", "toxic")


#: DuckDB SQL of ``audit(failures(documents, labels), "ABCDE", "part", ["good", "toxic"])``.
SQL = r"""
WITH letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
texts AS (SELECT doc_id, coalesce(doc_id, -9223372036854775808) AS doc, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
known AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
failing AS (
  SELECT part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    doc > min(doc) OVER (PARTITION BY t) AS e, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM words LEFT JOIN known USING (doc_id)),
patterns AS (
  SELECT part, a, b, c, d, e, count(*) AS n, sum(good::INT) AS good, sum(toxic::INT) AS toxic FROM failing GROUP BY ALL),
placed AS (
  SELECT part, filter_order, s AS step, n, good, toxic,
    least(CASE WHEN a THEN strpos(filter_order, 'A') ELSE 6 END, CASE WHEN b THEN strpos(filter_order, 'B') ELSE 6 END,
      CASE WHEN c THEN strpos(filter_order, 'C') ELSE 6 END, CASE WHEN d THEN strpos(filter_order, 'D') ELSE 6 END,
      CASE WHEN e THEN strpos(filter_order, 'E') ELSE 6 END) AS gone,
    CASE filter_order[s] WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails,
    a::INT + b::INT + c::INT + d::INT + e::INT AS failed
  FROM patterns, orders, range(1, 6) r(s)),
steps AS (
  SELECT part, filter_order, step, coalesce(sum(n) FILTER (gone > step), 0) AS kept, coalesce(sum(n) FILTER (gone = step), 0) AS removed,
    coalesce(sum(n) FILTER (fails AND gone < step), 0) AS redundant, coalesce(sum(n) FILTER (fails AND failed = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (gone = step), 0) AS good_lost, coalesce(sum(toxic) FILTER (gone = step), 0) AS toxic_lost
  FROM placed GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley
FROM steps
"""
