"""Instrument keys made out of symbols and payloads, feed by feed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitlake.functions.payloads import first_present
from pitlake.functions.scalars import crypto_symbol, equity_symbol, option_symbol, sector_fund, to_date

#: Feeds of market data, whose key follows from the kind of instrument.
MARKET_FEEDS = ("bars", "quotes", "trades")
MARKET_WIDE = "SPY"
UNKNOWN = "UNKNOWN"

_OCC = r"([A-Z]{1,6}[0-9]{6}[CP][0-9]{8})"


def occ_symbol(payload: Column, key: Column | None = None) -> Column:
    """An option symbol: as given in a payload or key, else built from underlying, expiry, side and strike; null if neither."""
    given = F.upper(first_present(payload, ["option_chain", "occ_symbol", "option_symbol", "contract"]))
    found = F.nullif(F.regexp_extract(given, _OCC, 1), F.lit(""))
    if key is not None:
        found = F.coalesce(found, F.nullif(F.regexp_extract(F.upper(key), _OCC, 1), F.lit("")))
    under = F.upper(F.trim(first_present(payload, ["underlying", "ticker", "symbol"])))
    side = first_present(payload, ["put_call", "type", "option_type"])
    strike = first_present(payload, ["strike"]).try_cast("double")
    built = option_symbol(under, to_date(first_present(payload, ["expiry", "expiration"])), side, strike)
    return F.coalesce(found, built)


def feed_key(feed: Column, kind: Column, symbol: Column, payload: Column, key: Column | None = None) -> Column:
    """The key of a row: by the feed's own rule, else by the kind of instrument, else the key it came with.

    ``payload`` is JSON text. Null where nothing gives a symbol and no key was there.
    """
    key = F.lit(None).cast("string") if key is None else key
    named = F.coalesce(F.nullif(F.trim(symbol), F.lit("")), first_present(payload, ["symbol", "S", "ticker"]))
    prefixed = lambda kind, name: F.when(name.isNotNull(), F.concat(F.lit(f"{kind}:"), name))
    equity = F.coalesce(prefixed("equity", equity_symbol(named)), key)
    option = F.coalesce(prefixed("option:OCC", occ_symbol(payload, key)), key)
    market = (
        F.when(kind == "crypto", F.coalesce(prefixed("crypto", crypto_symbol(named)), key))
        .when(kind == "option", F.when(key.startswith("option:OCC:"), key).otherwise(option))
        .otherwise(equity)
    )
    first_of_list = F.get(F.from_json(F.get_json_object(payload, "$.symbols"), "array<string>"), F.lit(0))
    return (
        F.when(feed == "flow_alerts", F.coalesce(prefixed("option:OCC", occ_symbol(payload, key)), equity))
        .when(feed == "market_tide", F.lit(f"equity:{MARKET_WIDE}"))
        .when(feed == "sector_tide", prefixed("equity", sector_fund(first_present(payload, ["sector"]))))
        .when(feed.isin("congress_trades", "insider_trades"), F.coalesce(prefixed("equity", equity_symbol(named)), F.lit(f"equity:{UNKNOWN}")))
        .when(feed == "news", F.coalesce(prefixed("equity", equity_symbol(F.coalesce(named, first_of_list))), key))
        .when(feed.isin(*MARKET_FEEDS), market)
        .otherwise(F.when(F.coalesce(kind, F.lit("equity")) == "equity", equity).otherwise(key))
    )
