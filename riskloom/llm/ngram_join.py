"""Similarity self-join on word 5-grams: MinHash banding, then a check on the full n-gram sets.

Words are maximal runs without ASCII white space, as written; a text of one to four words has one n-gram,
all of it; a text without words is like no other. Two documents are linked when the Jaccard
similarity of their n-gram sets is at least ``SIMILARITY``.

1. *Signatures.* One pass makes a row per document: 128 bits that stand for the n-gram set, and a hash
   for each band of MinHash values. Documents with equal sets form a class (map-side combined
   ``min``); only its least document goes on, so a text copied a million times is one row.
2. *Bands.* Representatives are shuffled on ``(band, hash)``. ``choose_bands`` takes the cheapest
   bands x rows whose chance to miss a pair at the threshold is at most ``1 - RECALL``.
3. *Links.* In a bucket each member is paired with one member, its hub, never all with all. The hub is the
   member that shares buckets with the most texts: in a group of near copies, the text they were made from.
   A member that is not in its hub's component after these checks, an outsider, is at a distance d > 0.2 from the hub. As
   Jaccard distance is a metric, it can only be linked to members whose own distance to the hub differs from d by at
   most 0.2, and that agree in enough MinHash values (2 bits of each; a linked pair falls short with a chance under 1e-5).
   Outsiders that have such a member, and these members, go through a prefix filter: n-grams are ordered by the number of these texts
   that hold them, the rarest first, and linked texts share one of their first ``floor(0.2 n) + 1``. Where two texts first meet they must
   still have enough n-grams left to be linked. So texts that share only a passage, or copies of one text with too many changes of
   their own, never meet. Candidates inside one component cannot change it.
4. *Check.* The texts of the hub and of its members meet under the hub's id, dealt over as many salts as the
   number of members asks for; the hub's row comes first and its members are streamed past it.
5. *Classes.* Connected components of the links.
6. *Counts.* Each link lies inside one class. The representatives of a class are dealt into blocks of bounded size, each two blocks
   meet in a task of their own, which compares all pairs of full n-gram sets and leaves one count per text, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_schema, cut, id_and_text, map_batches, mix, order_id, original_id, record_batch, sliced, tidy
from riskloom.llm.components import components
from riskloom.llm.textbytes import many_word_hashes, word_hashes

#: Words of an n-gram, least similarity of a link, wanted chance to find a pair at that similarity.
NGRAM = 5
SIMILARITY = 0.8
RECALL = 0.9995
#: Members that share a salt of their hub.
PER_SALT = 500
#: Representatives and n-grams of a block, when the links of a class are counted; n-grams that are compared at once.
BLOCK_DOCS, BLOCK_GRAMS, COLUMNS = 1_000, 1_000_000, 4_096
#: Bytes of text whose n-grams a task holds at once.
AT_ONCE = 1 << 20
#: Standard deviations below the expected agreement of two linked texts' MinHash values at which a pair is given up unchecked.
SLACK = 4.5

_CHAIN = np.uint64(0xD6E8FEB86659FD93)
_MEMBER = "hub long, salt long, doc long, hubs long"


def choose_bands(similarity: float, recall: float, most_hashes: int = 160) -> tuple[int, int]:
    """``(bands, rows)`` with 1 - (1 - s^rows)^bands >= recall and the most rows that fit ``most_hashes``."""
    best = None
    for rows in range(1, most_hashes + 1):
        bands = next((b for b in range(1, most_hashes // rows + 1) if (1 - similarity**rows) ** b <= 1 - recall), None)
        if bands is not None:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches that recall with so few hashes")
    return best


BANDS, ROWS = choose_bands(SIMILARITY, RECALL)


def most_differing(similarity: float) -> int:
    """Differing 2-bit MinHash values, of BANDS x ROWS, up to which two texts may still be linked."""
    differ = 0.75 * (1 - similarity)
    return int(BANDS * ROWS * differ + SLACK * (BANDS * ROWS * differ * (1 - differ)) ** 0.5)


_rng = np.random.default_rng(11)
_A = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def _grams(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-gram hashes of several texts and how many each has, repeats included."""
    made = np.where(counts >= NGRAM, counts - NGRAM + 1, (counts > 0).astype(np.int64))
    first = np.cumsum(counts) - counts
    row = np.repeat(np.arange(len(counts)), made)
    at = first[row] + np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made)
    end = (first + counts)[row]
    h = np.zeros(len(at), np.uint64)
    for k in range(NGRAM):
        inside = at + k < end
        h = np.where(inside, h * _CHAIN + words[np.minimum(at + k, max(len(words) - 1, 0))], h)
    return mix(h), made


def ngram_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of one text."""
    words = word_hashes((text or "").encode())
    return np.unique(_grams(words, np.array([len(words)]))[0])


def _signatures(batch: pa.RecordBatch) -> dict:
    docs = batch.column("doc").to_numpy()
    raws = [(t or "").encode() for t in batch.column("text").to_pylist()]
    words, counts = many_word_hashes(raws)
    grams, made = _grams(words, counts)
    some = np.flatnonzero(made)
    row = np.repeat(np.arange(len(raws)), made)
    order = np.lexsort((grams, row))
    g, r = grams[order], row[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    g, r = g[new], r[new]
    sizes = np.bincount(r, minlength=len(raws))
    at = (np.cumsum(sizes) - sizes)[some]
    bands = np.empty((len(some), BANDS), np.uint64)
    bits = np.zeros((len(some), -(-BANDS * ROWS // 32)), np.uint64)  # two bits of each MinHash value
    set1 = set2 = np.zeros(0, np.uint64)
    if len(some):
        for b in range(BANDS):
            h = np.full(len(some), b, np.uint64)
            for k in range(b * ROWS, (b + 1) * ROWS):
                v = g * _A[k] + _B[k]
                least = mix(np.minimum.reduceat(v ^ (v >> np.uint64(32)), at))
                h = mix(h ^ least)
                bits[:, k // 32] |= (least & np.uint64(3)) << np.uint64(2 * (k % 32))
            bands[:, b] = h
        set1 = np.add.reduceat(mix(g ^ np.uint64(0x1234567)), at)
        set2 = np.add.reduceat(mix(g * _CHAIN), at)
    return {"doc": docs[some], "set1": set1.view(np.int64), "set2": set2.view(np.int64), "n": sizes[some], "bands": list(bands.view(np.int64)), "bits": list(bits.view(np.int64))}


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (hub, salt, is member): the hub's text, then those of its members."""
    target = arrow_schema("hub long, doc long, similarity double")
    now, mine = None, None
    for batch in batches:
        for part in sliced(batch, AT_ONCE):
            out = {"hub": [], "doc": [], "similarity": []}
            for hub, salt, member, doc, text in zip(*(part.column(c).to_pylist() for c in ("hub", "salt", "member", "doc", "text")), strict=True):
                grams = ngram_set(text)
                if not member:
                    now, mine = (hub, salt), grams
                    continue
                assert now == (hub, salt)
                both = len(np.intersect1d(mine, grams, assume_unique=True))
                out["hub"].append(hub)
                out["doc"].append(doc)
                out["similarity"].append(both / (len(mine) + len(grams) - both))
            yield record_batch(out, target)


def check_pairs(texts: DataFrame, pairs: DataFrame, parts: int) -> DataFrame:
    """``(hub, doc, similarity)`` of the pairs ``(hub, doc)``; ``texts(doc, text)`` has one row for each id."""
    members = pairs.groupBy("hub").agg(F.count("*").alias("size")).withColumn("salts", F.ceil(F.col("size") / PER_SALT))
    salted = pairs.join(members.select("hub", "salts"), "hub").select("hub", F.pmod(F.xxhash64("doc"), "salts").alias("salt"), F.lit(True).alias("member"), "doc")
    hubs = members.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("member"), F.col("hub").alias("doc"))
    sides = salted.unionByName(hubs).join(texts, "doc").select("hub", "salt", "member", "doc", "text")
    met = sides.repartition(parts, "hub", "salt").sortWithinPartitions("hub", "salt", "member")
    return met.mapInArrow(tidy(_checked), "hub long, doc long, similarity double")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two sets share, as a matrix of products of 0/1 rows."""
    both = np.zeros((len(left), len(right)))
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    where = []
    for sets in (left, right):
        row = np.repeat(np.arange(len(sets)), [len(g) for g in sets])
        grams = np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, grams), max(len(shared) - 1, 0))
        in_both = shared[at] == grams if len(shared) else np.zeros(len(grams), bool)
        order = np.argsort(at[in_both], kind="stable")
        where.append((row[in_both][order], at[in_both][order]))
    for first in range(0, len(shared), COLUMNS):
        dense = []
        for (row, at), sets in zip(where, (left, right), strict=True):
            a, b = np.searchsorted(at, (first, first + COLUMNS))
            x = np.zeros((len(sets), min(COLUMNS, len(shared) - first)), np.float32)
            x[row[a:b], at[a:b] - first] = 1
            dense.append(x)
        both += dense[0] @ dense[1].T
    return both


def _linked(left: list[tuple], right: list[tuple], similarity: float) -> Iterator[tuple[int, int]]:
    """``(doc, copies of the texts it is linked to)`` of two blocks of ``(doc, copies, n-gram set)``; without a right one, inside the left."""
    other = right or left
    both = _common([x[2] for x in left], [x[2] for x in other])
    n1, n2 = (np.array([len(x[2]) for x in side]) for side in (left, other))
    good = both / np.maximum(n1[:, None] + n2 - both, 1) >= similarity
    if not right:
        np.fill_diagonal(good, False)
    copies = [np.array([x[1] for x in side], np.int64) for side in (left, other)]
    yield from zip([x[0] for x in left], (good @ copies[1]).tolist(), strict=True)
    if right:
        yield from zip([x[0] for x in right], (copies[0] @ good).tolist(), strict=True)


def _counted(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (root, i, j): the texts of blocks i and j of a class."""
    target = arrow_schema("rep long, linked long")
    now, blocks = None, ([], [])

    def out() -> pa.RecordBatch:
        found = list(_linked(*blocks, similarity))
        return record_batch({"rep": [d for d, _ in found], "linked": [n for _, n in found]}, target)

    for batch in batches:
        for part in sliced(batch, AT_ONCE):
            for root, i, j, right, doc, copies, text in zip(*(part.column(c).to_pylist() for c in ("root", "i", "j", "right", "doc", "copies", "text")), strict=True):
                if now != (root, i, j):
                    if now:
                        yield out()
                    now, blocks = (root, i, j), ([], [])
                blocks[right].append((doc, copies, ngram_set(text)))
    if now:
        yield out()


def count_links(texts: DataFrame, reps: DataFrame, roots: DataFrame, parts: int, similarity: float) -> DataFrame:
    """``(rep, linked)``: the copies of all representatives of its class that a representative is linked to.

    ``reps(doc, n, copies)``: n-grams and copies of each representative, ``roots(node, root)``: the classes of two and more.
    """
    inside = reps.join(roots.withColumnRenamed("node", "doc"), "doc")
    needed = F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("n") / BLOCK_GRAMS))
    dealt = inside.join(inside.groupBy("root").agg(needed.alias("blocks")), "root").withColumn("own", F.pmod(F.xxhash64("doc"), "blocks"))
    # Written first: a join of texts with a table of known size does not shuffle them while that table is small.
    dealt = cut(dealt.select("root", "blocks", "own", "doc", "copies"), "dealt")
    spread = dealt.join(texts, "doc").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    sides = spread.select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("right"), "doc", "copies", "text")
    met = sides.repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j")
    counts = met.mapInArrow(tidy(lambda batches: _counted(batches, similarity)), "rep long, linked long")
    return counts.groupBy("rep").agg(F.sum("linked").alias("linked"))


def _outside(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are not yet in one component."""
    left = roots.select(F.col("node").alias("hub"), F.col("root").alias("r1"))
    right = roots.select(F.col("node").alias("doc"), F.col("root").alias("r2"))
    return pairs.join(left, "hub", "left").join(right, "doc", "left").filter(~F.coalesce(F.col("r1") == F.col("r2"), F.lit(False))).select("hub", "doc")


def similar(docs: DataFrame, similarity: float = SIMILARITY, with_links: bool = True) -> DataFrame:
    """``(doc_id, class_id, n_links, n_copies, rep_id)``, one row per distinct id (repeated rows of an id are one document).

    ``class_id``: least id of the documents reached over links; a document without a link is its own class.
    ``rep_id``: least id with the same n-gram set, ``n_copies``: how many documents have that set. ``n_links``: the other
    copies, plus the copies of every other representative to which it is linked (all pairs of a class
    are checked). Null and empty texts and texts of white space link to nothing. Of rows with one id and different texts the least text counts. Null
    id: treated as smaller than every other, returned as null. Empty table: empty result. Other columns are ignored.
    Without ``with_links`` the links of a class are not counted and ``n_links`` is null.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = id_and_text(docs).select(order_id().alias("doc"), "text")
    signatures = cut(map_batches(texts, _signatures, "doc long, set1 long, set2 long, n long, bands array<long>, bits array<long>", AT_ONCE), "signatures")
    sets = signatures.groupBy("set1", "set2").agg(F.min("doc").alias("rep"), F.countDistinct("doc").alias("copies"))
    member = signatures.select("doc", "set1", "set2").join(sets, ["set1", "set2"]).select("doc", "rep", "copies")
    member = cut(member.groupBy("doc").agg(F.min(F.struct("rep", "copies")).alias("x")).select("doc", "x.rep", "x.copies"), "members")

    repeated = _repeats(signatures)
    reps = signatures.join(member.filter(F.col("doc") == F.col("rep")).select("doc"), "doc", "left_semi")
    reps = reps.dropDuplicates(["doc"]) if repeated else reps
    # A row for each band: only what a bucket needs travels, what else is known of its documents joins the few that share one.
    banded = reps.select("doc", F.posexplode("bands").alias("band", "hash"))
    sizes = banded.groupBy("band", "hash").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    shared = cut(banded.join(sizes.hint("merge"), ["band", "hash"]), "buckets")
    # The text that the others are copies of shares buckets with the most of them, so it makes the best hub.
    degree = shared.groupBy("doc").agg(F.sum("size").alias("degree"))
    first_least = F.bitwise_not("doc")
    hubs = shared.join(degree, "doc").groupBy("band", "hash").agg(F.max(F.struct("degree", first_least.alias("order"), "doc")).alias("hub"))
    buckets = shared.join(hubs, ["band", "hash"]).select("band", "hash", F.col("hub.doc").alias("hub"), F.struct("hub.degree", "hub.order", "hub.doc").alias("rank"), "doc")
    buckets = cut(buckets.filter(F.col("doc") != F.col("hub")).join(reps.select("doc", "n", "bits"), "doc"), "buckets")
    pairs = buckets.select("hub", "doc").distinct()

    # Every later step reads texts of buckets only: they are written once, the others stay out of its shuffles.
    own = texts.join(cut(shared.select("doc").distinct(), "nodes"), "doc", "left_semi")
    own = cut(own.groupBy("doc").agg(F.min("text").alias("text")) if repeated else own, "texts")
    # Short plans: what several parts of the next step read is written first.
    nearest = cut(buckets.groupBy("doc").agg(F.max("rank").alias("rank")).select(F.col("rank.doc").alias("hub"), "doc"), "pairs")
    first = cut(check_pairs(own, nearest, parts), "checked")
    roots = components(first.filter(F.col("similarity") >= similarity).select(F.col("hub").alias("a"), F.col("doc").alias("b")))
    rest = cut(_outside(pairs.join(nearest, ["hub", "doc"], "left_anti"), roots), "pairs")
    checked = cut(first.unionByName(check_pairs(own, rest, parts)), "checked")
    good = checked.filter(F.col("similarity") >= similarity)
    roots = components(good.select(F.col("hub").alias("a"), F.col("doc").alias("b")))

    more = cut(check_pairs(own, cut(_second_look(own, buckets, checked, roots, similarity), "pairs"), parts), "checked")
    found = more.filter(F.col("similarity") >= similarity)
    if not found.isEmpty():
        good = good.unionByName(found)
        roots = components(good.select(F.col("hub").alias("a"), F.col("doc").alias("b")))
    if not with_links:
        return _rows(texts, member, None, roots)
    copies = member.filter(F.col("doc") == F.col("rep")).select("doc", "copies")
    linked = count_links(own, reps.select("doc", "n").join(copies, "doc"), roots, parts, similarity)
    return _rows(texts, member, linked, roots)


def _repeats(signatures: DataFrame) -> bool:
    row = signatures.agg(F.count("*").alias("n"), F.countDistinct("doc").alias("d")).first()
    return row["n"] != row["d"]


def _differing():
    """Number of 2-bit MinHash values in which ``bits`` and ``bits2`` differ."""
    total = F.lit(0)
    for k in range(-(-BANDS * ROWS // 32)):
        x = F.col("bits")[k].bitwiseXOR(F.col("bits2")[k])
        total = total + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return total


def _gram_rows(batch: pa.RecordBatch) -> dict:
    sets = [ngram_set(t) for t in batch.column("text").to_pylist()]
    return {"doc": np.repeat(batch.column("doc").to_numpy(), [len(g) for g in sets]), "gram": np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)}


def rare_pairs(texts: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """``(hub, doc)``, hub < doc: pairs of ``nodes(doc, n, root, seeks)`` with different roots, one of them seeking, that may be linked.

    Exact prefix filter: n-grams in one order, rarest among the nodes first (ties by hash); a text of n n-grams is dealt under its
    first ``floor((1 - similarity) n) + 1``, and ``texts(doc, text)`` must give n distinct ones. n-grams of one node only come first and
    meet nothing, so they are counted, not dealt. Where a pair first meets, at most the n-grams from there on are shared.
    """
    grams = map_batches(texts.join(nodes.select("doc"), "doc", "left_semi"), _gram_rows, "doc long, gram long", AT_ONCE)
    grams = cut(grams, "grams")
    common = grams.groupBy("gram").agg(F.count("*").alias("df")).filter(F.col("df") > 1)
    known = grams.join(common, "gram").join(nodes, "doc")
    mine = Window.partitionBy("doc")
    place = F.row_number().over(mine.orderBy("df", "gram")) - 1 + F.col("n") - F.count("*").over(mine)
    left = (F.col("n") - F.col("place")).alias("left")  # n-grams from here on
    dealt = known.withColumn("place", place).filter(F.col("place") <= F.floor((1 - similarity) * F.col("n") + 1e-9)).select("gram", "doc", "n", "root", "seeks", left)
    dealt = cut(dealt, "prefixes")
    a, b = (dealt.select("gram", *(F.col(c).alias(f"{c}{k}") for c in ("doc", "n", "root", "seeks", "left"))) for k in (1, 2))
    needed = similarity / (1 + similarity) * (F.col("n1") + F.col("n2")) - 1e-6
    fits = (F.col("root1") != F.col("root2")) & (F.least("left1", "left2") >= needed) & (F.col("seeks1") & (~F.col("seeks2") | (F.col("doc1") < F.col("doc2"))))
    met = a.filter("seeks1").join(b, "gram").filter(fits)
    return met.select(F.least("doc1", "doc2").alias("hub"), F.greatest("doc1", "doc2").alias("doc")).distinct()


def _having(rows: DataFrame, others: DataFrame, partner: Column) -> DataFrame:
    """The rows for which one of the others in the same cell of the same bucket is a partner."""
    o = others.withColumnsRenamed({c: f"o_{c}" for c in ("band", "hash", "cell")})
    same = reduce(and_, [F.col(c) == F.col(f"o_{c}") for c in ("band", "hash", "cell")])
    return rows.join(o, same & partner, "left_semi")


def _second_look(texts: DataFrame, buckets: DataFrame, checked: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Pairs in two components that neither the hub, their sizes, their MinHash values nor their rare n-grams rule out.

    Of a pair in a bucket at least one end is no member of the hub's component: an outsider. All outsiders failed against
    the hub, at a known distance; a member of the hub's component may have been passed over, its distance is unknown. Members are dealt
    by distance into cells of width 1 - similarity, so that only neighbouring cells meet. Two semi-joins leave the texts with a
    possible partner, no pairs; these go to ``rare_pairs``.
    """
    limit = 1 - similarity
    known = checked.select("hub", "doc", (1 - F.col("similarity")).alias("distance"))
    of_hub = roots.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    of_doc = roots.select(F.col("node").alias("doc"), "root")
    near = buckets.join(of_hub, "hub", "left").join(of_doc, "doc", "left").join(known, ["hub", "doc"], "left")
    near = near.withColumns({"hub_root": F.coalesce("hub_root", "hub"), "root": F.coalesce("root", "doc"), "cell": F.coalesce(F.floor(F.col("distance") / limit), F.lit(-2))})
    near = cut(near.select("band", "hash", "doc", "n", "bits", "root", "distance", "cell", (F.col("root") != F.col("hub_root")).alias("outside")), "near")
    close = F.col("distance").isNull() | F.col("d2").isNull() | (F.abs(F.col("distance") - F.col("d2")) <= limit + 1e-9)
    sized = F.least("n", "n2") >= similarity * F.greatest("n", "n2") - 1e-9
    alike = _differing() <= most_differing(similarity)
    partner = (F.col("root") != F.col("root2")) & close & sized & alike
    cells = F.array_distinct(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1, F.lit(-2).cast("long")))
    as_other = lambda rows: rows.select("band", "hash", F.col("n").alias("n2"), F.col("bits").alias("bits2"), F.col("root").alias("root2"), F.col("distance").alias("d2"), "cell")
    spread = near.filter("outside").withColumn("cell", F.explode(cells))
    seekers = _having(spread, as_other(near), partner)
    sought = _having(near, as_other(spread), partner)
    nodes = seekers.select("doc", "n", "root", F.lit(True).alias("seeks")).unionByName(sought.select("doc", "n", "root", F.lit(False).alias("seeks")))
    nodes = cut(nodes.groupBy("doc").agg(F.first("n").alias("n"), F.first("root").alias("root"), F.max("seeks").alias("seeks")), "seekers")
    return rare_pairs(texts, nodes, similarity)


def _rows(texts: DataFrame, member: DataFrame, linked: DataFrame | None, roots: DataFrame) -> DataFrame:
    sizes = member.filter(F.col("doc") == F.col("rep")).select("rep", "copies")
    counted = sizes.select("rep").join(linked, "rep", "left") if linked is not None else sizes.select("rep", F.lit(None).cast("long").alias("linked"))
    of_rep = counted.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    known = member.join(of_rep, "rep")
    everyone = texts.select("doc").distinct().join(known, "doc", "left")
    return everyone.select(
        original_id("doc").alias("doc_id"),
        original_id(F.coalesce("root", "rep", "doc")).alias("class_id"),
        (F.coalesce(F.col("copies"), F.lit(1)) - 1 + F.coalesce(F.col("linked"), F.lit(0)) if linked is not None else F.lit(None)).cast("long").alias("n_links"),
        F.coalesce(F.col("copies"), F.lit(1)).cast("long").alias("n_copies"),
        original_id(F.coalesce("rep", "doc")).alias("rep_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those of whose class a smaller id stays; of equal rows one stays. All columns as they are.

    A null id is smaller than every other, so its row stays.
    """
    gone = cut(similar(docs, with_links=False).filter(~F.col("class_id").eqNullSafe(F.col("doc_id"))).select("doc_id"), "gone")
    left = docs.join(gone, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
    ids = docs.select("doc_id").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("d")).first()
    return left if ids["n"] == ids["d"] else left.dropDuplicates()
