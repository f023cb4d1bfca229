"""Personal data by weak supervision, in DataFrame functions and Spark ML only.

Base spans (e-mail, IP address, card, phone) are found by pattern and check. Beyond them, candidate
spans (names, addresses, identity numbers, local phone numbers, veiled e-mail addresses) are voted on
by labelers that may abstain: strict patterns, a gazetteer, words of the context for and against, and a look at the
digits. Expectation-maximisation estimates how reliable each labeler is from the counts of the vote
patterns over all documents (at most 3^labelers x kinds rows, whatever the corpus); the posteriors then
train a logistic span classifier on features of the span, which decides. Base spans vote as well, as
known examples.

Two passes over the texts, both without a shuffle of texts: one counts patterns, one scores.

A regex gives matches without places, so places are summed up from the gaps (``split``) and the
matches (``regexp_extract_all``) of one pattern. Patterns are written so that Java's matcher does not recurse or look
at a long run twice: possessive repeats, and starts only at the edge of a run.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import id_and_text

KINDS = ("email", "ip", "card", "phone", "name", "address", "identity", "local", "veiled")
N_BASE = 4

_LOCAL = "A-Za-z0-9._%+-"
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Base patterns: what to find, a cheap sign that it may be there, what a match must pass.
_EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: Fixed lists of the labelers: titles, given names, street words, words for and against.
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Señor Señora"
GIVEN = "Alice Anna Carlos David Elena Emma Hans Ivan James Jean John Julia Karl Laura Lucas Maria Marie Mary Michael Paul Peter Robert Sarah Sofia Thomas William"
STREETS = "Street Avenue Road Lane Drive Boulevard Square Straße Allee Rue Calle"
FOR = "name named call phone tel mobile contact address lives reach email mail ssn social born patient customer nombre nom telefon adresse"
AGAINST = "version page chapter figure table isbn issn volume section price total order model part error line equation"

_NAME = rf"(?<!\p{{L}})(?:(?:{TITLES.replace(' ', '|')})\.?\x20\p{{Lu}}\p{{L}}++(?:\x20\p{{Lu}}\p{{L}}++)?|(?<=[Nn]ame is )\p{{Lu}}\p{{L}}++(?:\x20\p{{Lu}}\p{{L}}++)?)"
_ADDRESS = rf"(?<![0-9])[0-9]{{1,5}}\x20(?:\p{{Lu}}\p{{L}}++\x20){{1,3}}(?:{STREETS.replace(' ', '|')})(?!\p{{L}})"
_IDENTITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_LOCAL_PHONE = r"(?<![0-9+()-])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9-])"
_VEILED = r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]++(?:\x20?(?:\[dot\]|\(dot\)|\.)\x20?[A-Za-z0-9-]++)++"
_CANDIDATE = "|".join(f"(?:{p})" for p in (_NAME, _ADDRESS, _IDENTITY, _LOCAL_PHONE, _VEILED))

#: Characters of context on the left; EM rounds; least probability of an added span.
CONTEXT = 32
ROUNDS = 50
ACCEPT = 0.5
LABELERS = ("strict", "gazetteer", "for", "against", "digits")


def _spans(text: Column, pattern: str, maybe: Column) -> Column:
    """``array<struct<start, end, match>>`` of all matches, in code points; empty unless ``maybe``."""
    kind = "array<struct<start:int,end:int,match:string>>"
    zipped = F.arrays_zip(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["0"])
        end = begin + F.coalesce(F.length(x["1"]), F.lit(0))
        one = F.struct(begin.alias("start"), end.alias("end"), x["1"].alias("match"))
        return F.struct(end.alias("at"), F.when(x["1"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(one))).alias("out"))

    return F.when(maybe, F.aggregate(zipped, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(kind))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _of_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["match"].alias("match")))


def with_base(docs: DataFrame) -> DataFrame:
    """Add ``base``: checked base spans ``(start, end, kind, match)``, by start, then kind."""
    text = F.col("text")
    email = _spans(text, _EMAIL, F.contains(text, F.lit("@")))
    ip = F.filter(_spans(text, _IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")), lambda s: s["match"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    card = F.filter(_spans(text, _CARD, text.rlike(_CARD)), lambda s: F.call_function("luhn_check", _digits(s["match"])))
    phone = F.filter(_spans(text, _PHONE, F.contains(text, F.lit("+"))), lambda s: F.length(_digits(s["match"])).between(9, 15))
    found = [_of_kind(s, k) for k, s in enumerate((email, ip, card, phone))]
    return docs.withColumn("base", F.array_sort(F.concat(*found)))


def _votes(text: Column, span: Column) -> dict[str, Column]:
    """Votes of the labelers on a span: 1, 0 (abstains) or -1, and the features of the classifier."""
    match, kind = span["match"], span["kind"]
    before = F.lower(F.substring(text, F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1, F.least(span["start"], F.lit(CONTEXT))))
    says = lambda words: before.rlike(rf"(?<!\p{{L}})(?:{words.replace(' ', '|')})(?!\p{{L}})")
    digits = _digits(match)
    strict = kind.isin(*range(N_BASE)) | match.rlike(rf"^(?:(?:{TITLES.replace(' ', '|')})\.\x20|\([0-9]{{3}}\)|[0-9]{{3}}-[0-9]{{2}}-|.*(?:\[at\]|\(at\)).*(?:\[dot\]|\(dot\)))")
    listed = match.rlike(rf"(?<!\p{{L}})(?:{GIVEN.replace(' ', '|')}|{STREETS.replace(' ', '|')})(?!\p{{L}})")
    odd = (F.length(digits) > 0) & (digits.rlike(r"^([0-9])\1*$") | digits.rlike("^(?:000|666|9)") & (kind == 6))
    return {
        "strict": F.when(strict, 1).otherwise(0),
        "gazetteer": F.when(listed, 1).when(kind == 4, -1).otherwise(0),
        "for": F.when(says(FOR), 1).otherwise(0),
        "against": F.when(says(AGAINST), -1).otherwise(0),
        "digits": F.when(odd, -1).when(F.length(digits) >= 7, 1).otherwise(0),
    }


def with_candidates(docs: DataFrame) -> DataFrame:
    """Add ``more``: candidate spans outside the base ones, with kind and votes; ``base`` gets votes too."""
    text = F.col("text")

    def shape(s: Column) -> Column:
        m = s["match"]
        veiled = m.rlike(r"[\[(]at[\])]")
        return F.when(veiled, 8).when(m.rlike(r"^\p{L}"), 4).when(m.rlike(r"^[0-9]+\x20\p{Lu}"), 5).when(m.rlike("^[0-9]{3}-[0-9]{2}-"), 6).otherwise(7)

    found = F.transform(_spans(text, _CANDIDATE, text.rlike(_CANDIDATE)), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), shape(s).alias("kind"), s["match"].alias("match")))
    voted = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), *[v.alias(k) for k, v in _votes(text, s).items()])
    free = F.filter(found, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return docs.withColumn("more", F.transform(free, voted)).withColumn("base", F.transform("base", voted))


def expectation_maximisation(counts: list[tuple[tuple[int, ...], float]], prior: float = 0.5) -> tuple[float, list[float], dict]:
    """Share of true spans, reliability of each labeler, posterior of each vote pattern.

    A labeler that votes is right with its own probability, whatever the truth; votes are independent given the
    truth. Reliabilities start above chance and are smoothed, so that the two truths cannot trade places.
    """
    k = len(counts[0][0]) if counts else 0
    right = [0.8] * k
    posterior: dict[tuple[int, ...], float] = {}
    for _ in range(ROUNDS):
        for votes, _n in counts:
            odds = math.log(prior / (1 - prior)) + sum(v * math.log(r / (1 - r)) for v, r in zip(votes, right, strict=True))
            posterior[votes] = 1 / (1 + math.exp(-odds))
        total = sum(n for _, n in counts)
        prior = min(max((sum(n * posterior[v] for v, n in counts) + 1) / (total + 2), 0.05), 0.95)
        for j in range(k):
            good = sum(n * (posterior[v] if v[j] > 0 else 1 - posterior[v]) for v, n in counts if v[j])
            cast = sum(n for v, n in counts if v[j])
            right[j] = min(max((good + 8) / (cast + 10), 0.55), 0.99)
    return prior, right, posterior


def fit(spark: SparkSession, docs: DataFrame) -> dict | None:
    """Reliabilities and the classifier's weights, from all spans of ``docs``; None if there is no candidate."""
    spans = with_candidates(with_base(docs)).select(F.explode(F.concat("base", "more")).alias("s")).select("s.kind", *[f"s.{x}" for x in LABELERS])
    rows = spans.groupBy("kind", *LABELERS).count().collect()  # at most kinds x 3^labelers rows
    if not any(r["kind"] >= N_BASE for r in rows):
        return None
    counts: dict[tuple[int, ...], float] = {}
    for r in rows:
        votes = tuple(r[x] for x in LABELERS)
        counts[votes] = counts.get(votes, 0) + r["count"]
    prior, right, posterior = expectation_maximisation(sorted(counts.items()))
    examples = []
    for r in rows:
        votes = tuple(r[x] for x in LABELERS)
        p = posterior[votes] if r["kind"] >= N_BASE else 1.0
        x = Vectors.dense([float(v) for v in votes] + [float(r["kind"] == k) for k in range(N_BASE, len(KINDS))])
        examples += [(x, 1.0, p * r["count"]), (x, 0.0, (1 - p) * r["count"])]
    table = spark.createDataFrame([e for e in examples if e[2] > 0], ["features", "label", "weight"])
    model = LogisticRegression(weightCol="weight", regParam=0.01, maxIter=50).fit(table.coalesce(1))
    return {"prior": prior, "right": dict(zip(LABELERS, right, strict=True)), "weights": model.coefficients.toArray().tolist(), "bias": float(model.intercept)}


def with_spans(docs: DataFrame, model: dict | None) -> DataFrame:
    """Add ``spans``: base spans and accepted candidates ``(start, end, kind)``, by start, then kind."""
    plain = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    based = with_base(docs)
    if model is None:
        return based.withColumn("base", F.transform("base", plain)).withColumn("spans", F.col("base"))
    w = model["weights"]

    def accepted(s: Column) -> Column:
        votes = [F.lit(w[j]) * s[x] for j, x in enumerate(LABELERS)]
        kinds = [F.when(s["kind"] == k, w[len(LABELERS) + k - N_BASE]).otherwise(0.0) for k in range(N_BASE, len(KINDS))]
        return reduce(add, [*votes, *kinds], F.lit(model["bias"])) >= math.log(ACCEPT / (1 - ACCEPT))

    known = with_candidates(based)
    more = F.transform(F.filter("more", accepted), plain)
    return known.withColumn("base", F.transform("base", plain)).withColumn("spans", F.array_sort(F.concat("base", more))).drop("more")


def _shown(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(by_start, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``, one row per input row.

    Null text: as the empty one, no spans. Ids are passed on, null or repeated; equal rows get equal results. Empty table, or one without
    candidates: no classifier, base spans only. Other columns are ignored.
    """
    own = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    found = with_spans(own, fit(docs.sparkSession, own)).select("doc_id", "base", "spans")
    of = lambda k: F.filter("base", lambda s: s["kind"] == k)
    counted = [F.size(of(k)).cast("long").alias(f"n_{KINDS[k]}") for k in range(N_BASE)]
    return found.select("doc_id", *counted, F.sha2(_shown("base"), 256).alias("base_sha256"), _shown("spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with each span of ``text`` replaced by its kind in brackets; all columns stay.

    Where spans overlap, the later one only replaces what is left of it. Null texts stay null. ``n_chars``, where there is one, is not changed.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    kept = docs.columns
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    model = fit(docs.sparkSession, own.select("text"))
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        fresh = s["end"] > acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap, F.when(fresh, F.get(names, s["kind"])).otherwise("")).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cleaned = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    done = with_spans(own, model).withColumn("cleaned", F.when(F.size("spans") > 0, cleaned).otherwise(text))
    return done.select(*[(F.when(F.col(f"row.`{c}`").isNotNull(), F.col("cleaned")) if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in kept])
