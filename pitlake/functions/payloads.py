"""Envelopes and payloads: identifiers, JSON chains and exploded items."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

CHAIN = "array<struct<occ_symbol:string,strike:double,bid:double,ask:double,delta:double,iv:double>>"


@F.arrow_udf(StringType())
def event_id(texts: pa.Array) -> pa.Array:
    """128-bit BLAKE2b of a text as hexadecimal; there is no built-in for it, so it is one pass over each Arrow batch."""
    made = hashlib.blake2b
    return pa.array([None if t is None else made(t, digest_size=16).hexdigest() for t in texts.cast(pa.binary()).to_pylist()], pa.string())


def first_present(payload: Column, names: Sequence[str]) -> Column:
    """The first of several names (paths) of a JSON payload that holds something; blank text holds nothing."""
    return F.coalesce(*[F.nullif(F.trim(F.get_json_object(payload, f"$.{n}")), F.lit("")) for n in names])


def bar_event_id(provider: Column, feed: Column, key: Column, time: Column, timeframe: Column) -> Column:
    """A bar's identity, the same whenever it is read again."""
    return event_id(F.concat_ws("|", provider, feed, key, F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), timeframe))


def explode_chain(df: DataFrame, column: str = "chain_json") -> DataFrame:
    """A row per option contract of a JSON chain, given bare or under data.contracts; bad JSON gives none."""
    bare = F.from_json(column, CHAIN)
    nested = F.from_json(F.get_json_object(column, "$.data.contracts"), CHAIN)
    return df.withColumn("_c", F.explode(F.coalesce(nested, bare))).select(*[c for c in df.columns if c != column], "_c.*")


def explode_items(df: DataFrame, payload: str, items: str, schema: str) -> DataFrame:
    """Items of an aggregate payload as rows ``event_id:index``; an empty list gives none."""
    found = F.from_json(F.get_json_object(payload, f"$.{items}"), f"array<{schema}>")
    rows = df.select(*[c for c in df.columns if c != payload], F.posexplode(found).alias("_i", "_x"))
    return rows.withColumn("event_id", F.concat_ws(":", "event_id", F.col("_i").cast("string"))).select(*[c for c in df.columns if c != payload], "_x.*")
