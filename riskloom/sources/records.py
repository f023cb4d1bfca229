"""Scoring-record source: JSON text -> one column per declared field, as text.

Every field is taken as the text that was sent, so that a value of the wrong type fails the contract's coercion under its
own name instead of turning into a NULL. The body stays with the row, whatever becomes of
it, and a body that is no JSON object is marked ``malformed``; its key is then looked for in the text.

:func:`with_json_types` reads the body as a VARIANT, which keeps the JSON type of each value: it tells ``"12"`` from ``12``, and finds nested
values and fields that the contract does not know.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.contract import Contract

BODY, MALFORMED = "body", "malformed"
_CORRUPT = "_rl_corrupt"


def to_json_records(df: DataFrame, columns: list[str], out: str = BODY) -> DataFrame:
    """Serialise rows to one JSON document per row (what a client would send)."""
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"  # keep microseconds
    opts = {"timestampFormat": fmt, "timestampNTZFormat": fmt}
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), opts).alias(out))


def parse_records(bodies: DataFrame, contract: Contract, key: str, json_col: str = BODY) -> DataFrame:
    """``(key, fields as text, body, malformed)`` from a column of JSON documents."""
    names = [key, *contract.columns]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _CORRUPT)])
    body = F.col(json_col)
    rec = F.from_json(body, schema, {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"})
    rows = bodies.select(rec.alias("_rl_rec"), body.alias(BODY))
    malformed = F.col("_rl_rec").isNull() | F.col(f"_rl_rec.{_CORRUPT}").isNotNull()
    found = F.coalesce(F.col(f"_rl_rec.`{key}`"), F.nullif(F.regexp_extract(BODY, f'"{key}"\\s*:\\s*"?([^",}}\\s]+)', 1), F.lit("")))
    return rows.select(
        found.try_cast("long").alias(key),
        *[F.col(f"_rl_rec.`{n}`").alias(n) for n in contract.columns],
        BODY,
        malformed.alias(MALFORMED),
    )


JSON_TYPES, EXTRA_FIELDS = "json_types", "extra_fields"
#: JSON types, as VARIANT names them, that a value of a rule's type may have; null is left to the contract.
_FITS = {
    "long": ("BIGINT", "DECIMAL", "DOUBLE"),
    "double": ("BIGINT", "DECIMAL", "DOUBLE"),
    "string": ("STRING",),
    "timestamp": ("STRING",),
}


def with_json_types(records: DataFrame, contract: Contract, key: str) -> DataFrame:
    """Parsed records with ``json_types`` and ``extra_fields``, two arrays of field names in text order.

    ``json_types``: fields whose value has another JSON type than the contract's rule asks for, such as a number sent as text or an
    object for a text. ``extra_fields``: fields that neither the contract nor the key names. Both are empty for a
    malformed body, which has a reason of its own.
    """
    body = records.withColumn("_rl_variant", F.try_parse_json(BODY))
    wrong = []
    for rule in contract.rules:
        quote = '"' if "'" in rule.column else "'"
        kind = F.schema_of_variant(F.try_variant_get(F.col("_rl_variant"), f"$[{quote}{rule.column}{quote}]", "variant"))
        name = F.substring_index(F.substring_index(kind, "<", 1), "(", 1)  # DECIMAL(2,1), OBJECT<...>
        wrong.append(F.when(name.isNotNull() & ~name.isin("VOID", *_FITS[rule.dtype]), F.lit(rule.column)))
    names = F.map_keys(F.expr("try_cast(_rl_variant AS MAP<STRING, VARIANT>)"))
    extra = F.array_except(F.coalesce(names, F.array().cast("array<string>")), F.array(*[F.lit(n) for n in (key, *contract.columns)]))
    return body.withColumns({JSON_TYPES: F.array_sort(F.filter(F.array(*wrong), lambda x: x.isNotNull())), EXTRA_FIELDS: F.array_sort(extra)}).drop("_rl_variant")
