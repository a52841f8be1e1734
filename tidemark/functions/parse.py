"""Provider payloads to typed facts: pair JSON, links, token mint accounts, encodings."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .scalar import col

# The shape of a pair record of the market data provider.
_PAIR = """
STRUCT<chainId: STRING, pairAddress: STRING, baseToken: STRUCT<address: STRING, symbol: STRING, name: STRING>, quoteToken: STRUCT<address: STRING,
  symbol: STRING>, priceUsd: STRING, priceNative: STRING,
  liquidity: STRUCT<usd: STRING, base: STRING, quote: STRING>, fdv: STRING, marketCap: STRING, volume: STRUCT<m5: STRING, h1: STRING, h6: STRING,
    h24: STRING>, priceChange: STRUCT<m5: STRING, h1: STRING, h6: STRING, h24: STRING>,
  txns: STRUCT<m5: STRUCT<buys: BIGINT, sells: BIGINT>, h1: STRUCT<buys: BIGINT, sells: BIGINT>, h6: STRUCT<buys: BIGINT, sells: BIGINT>,
    h24: STRUCT<buys: BIGINT, sells: BIGINT>>,
  pairCreatedAt: BIGINT, info: STRUCT<websites: ARRAY<STRUCT<label: STRING, url: STRING>>, socials: ARRAY<STRUCT<type: STRING, platform: STRING,
    url: STRING, handle: STRING>>>>
"""


def pair_observations(raw: DataFrame, body: str = "body") -> DataFrame:
    """raw's rows with the observation that each JSON pair holds. What is missing stays null and zero stays zero."""
    p = raw.withColumn("_p", F.from_json(col(body), _PAIR))
    money = lambda path: F.col(f"_p.{path}").try_cast("decimal(38,18)")
    return p.select(
        *raw.columns, F.col("_p.chainId").alias("chain"), F.col("_p.pairAddress").alias("pair_address"),
        F.col("_p.baseToken.address").alias("base_address"), F.col("_p.quoteToken.address").alias("quote_address"),
        money("priceUsd").alias("price_usd"), money("priceNative").alias("price_native"),
        *[money(f"liquidity.{k}").alias(f"liquidity_{k}") for k in ("usd", "base", "quote")], money("marketCap").alias("market_cap_usd"),
        money("fdv").alias("fully_diluted_valuation_usd"), *[money(f"volume.{k}").alias(f"volume_{k}_usd") for k in ("m5", "h1", "h6", "h24")],
        *[money(f"priceChange.{k}").alias(f"price_change_{k}") for k in ("m5", "h1", "h6", "h24")],
        *[F.col(f"_p.txns.{k}.{s}").alias(f"{s}_{k}") for k in ("m5", "h1", "h6", "h24") for s in ("buys", "sells")],
        F.timestamp_millis("_p.pairCreatedAt").alias("pair_created_at"),
    )


def links(raw: DataFrame, platforms: tuple[str, ...] = ("twitter", "telegram", "discord"), body: str = "body") -> DataFrame:
    """raw's rows with the first website, the first link of each platform, and all other links."""
    p = raw.withColumn("_i", F.from_json(col(body), _PAIR)["info"])
    socials = F.coalesce(F.col("_i.socials"), F.array().cast("array<struct<type: string, platform: string, url: string, handle: string>>"))
    kind = lambda x: F.lower(F.coalesce(x["type"], x["platform"]))
    first = {n: F.try_element_at(F.transform(F.filter(socials, _of(n, kind)), lambda x: F.coalesce(x["url"], x["handle"])), F.lit(1)) for n in platforms}
    other = F.transform(F.filter(socials, lambda x: ~F.coalesce(kind(x).isin(*platforms), F.lit(False))), lambda x: F.coalesce(x["url"], x["handle"]))
    return p.select(*raw.columns, F.try_element_at(F.transform("_i.websites", lambda x: x["url"]), F.lit(1)).alias("website"),
        *[c.alias(n) for n, c in first.items()], other.alias("other_links"))


def _of(name: str, kind):
    return lambda x: kind(x) == name


def matched_pairs(pairs: DataFrame, requested: DataFrame) -> DataFrame:
    """Pairs with the requested token that they hold, as base or as quote: two equality joins instead of a disjunction."""
    base = pairs.join(requested, pairs.base_address == requested.address)
    quote = pairs.join(requested, pairs.quote_address == requested.address).filter(~F.coalesce(F.col("base_address") == F.col("address"), F.lit(False)))
    return base.withColumn("side", F.lit("base")).unionByName(quote.withColumn("side", F.lit("quote")))


def _little_endian(data: Column, start: int, size: int) -> Column:
    digits = F.concat(*[F.hex(F.substring(data, start + i, 1)) for i in reversed(range(size))])
    return F.conv(digits, 16, 10).cast("decimal(20,0)")


def mint_account(data: Column | str) -> Column:
    """supply, decimals, initialized and authorities (hex; null where there is none) of a token mint account of 82 bytes or more; null for shorter data."""
    d = col(data)
    key = lambda flag, start: F.when(_little_endian(d, flag, 4) == 1, F.lower(F.hex(F.substring(d, start, 32))))
    return F.when(
        F.length(d) >= 82,
        F.struct(
            key(1, 5).alias("mint_authority"), _little_endian(d, 37, 8).alias("supply"), _little_endian(d, 45, 1).cast("int").alias("decimals"),
            (_little_endian(d, 46, 1) == 1).alias("initialized"), key(47, 51).alias("freeze_authority")
        ),
    )


# Fixed value: the base58 alphabet.
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def base58(data: bytes) -> str:
    n, out = int.from_bytes(data, "big"), ""
    while n:
        n, digit = divmod(n, 58)
        out = _BASE58[digit] + out
    return _BASE58[0] * (len(data) - len(data.lstrip(b"\0"))) + out


@F.pandas_udf(StringType())
def base58_text(data: pd.Series) -> pd.Series:
    return data.map(lambda b: None if b is None else base58(bytes(b)))


def named_uuid(namespace: uuid.UUID):
    """A column function for UUIDs of version 5 in a namespace; nulls stay null."""

    def of(name: Column | str) -> Column:
        h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), col(name).cast("binary")))
        # Version 5 takes the place of a digit, and the two highest bits of another are set to 10.
        variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") + 1, F.lit(1))
        return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
            F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))

    return lambda name: F.when(col(name).isNotNull(), of(name))


def raw_is_safe(body: Column | str) -> Column:
    """Whether a raw JSON text has neither NUL characters nor unpaired surrogates, spelled as escapes."""
    lone = F.regexp_like(col(body), F.lit(r"(?i)\\ud[89ab][0-9a-f]{2}(?!\\ud[c-f][0-9a-f]{2})|(?<!\\ud[89ab][0-9a-f]{2})\\ud[c-f][0-9a-f]{2}"))
    nul = F.regexp_like(col(body), F.lit(r"(?<!\\)(\\\\)*\\u0000"))
    return ~F.coalesce(lone | nul, F.lit(False))
