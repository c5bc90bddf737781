"""Scalar functions as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The grammar of instrument keys.
KEY_PATTERNS = {
    "equity": r"^equity:[A-Z0-9]+(?:[.-][A-Z0-9]+)*$",
    "crypto": r"^crypto:[A-Z]{2,10}-[A-Z]{2,10}$",
    "forex": r"^forex:[A-Z]{3}-[A-Z]{3}$",
    "option": r"^option:OCC:[A-Z]{1,6}[0-9]{6}[CP][0-9]{8}$",
    "macro": r"^macro:[a-z][a-z0-9_]*(?::[a-z0-9_]+)*$",
}
#: Sector names and the fund that stands for each.
SECTOR_FUNDS = {
    "BASIC MATERIALS": "XLB",
    "COMMUNICATION SERVICES": "XLC",
    "CONSUMER CYCLICAL": "XLY",
    "CONSUMER DEFENSIVE": "XLP",
    "ENERGY": "XLE",
    "FINANCIAL SERVICES": "XLF",
    "HEALTHCARE": "XLV",
    "INDUSTRIALS": "XLI",
    "REAL ESTATE": "XLRE",
    "TECHNOLOGY": "XLK",
    "UTILITIES": "XLU",
}
TRUE_WORDS, FALSE_WORDS = ("true", "t", "yes", "y", "1"), ("false", "f", "no", "n", "0")


def present(column: Column, text: bool = False) -> Column:
    """Not null and, for texts, not blank."""
    return column.isNotNull() & (F.trim(column) != "" if text else F.lit(True))


def to_double(text: Column) -> Column:
    """Number or null."""
    return F.nullif(F.trim(text), F.lit("")).try_cast("double")


def to_long(text: Column) -> Column:
    """Whole number or null; fractions are cut off."""
    return to_double(text).try_cast("long")  # a cast to long truncates


def to_boolean(text: Column) -> Column:
    """True, false or null by word."""
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def epoch_to_timestamp(number: Column) -> Column:
    """Seconds, or milliseconds above 1e10, since the epoch as a zone-less timestamp."""
    seconds = F.when(F.abs(number) > 1e10, number / 1000).otherwise(number)
    return F.timestamp_add("MICROSECOND", F.round(seconds * 1_000_000).try_cast("long"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def to_timestamp(text: Column) -> Column:
    """Epoch number or ISO text as a zone-less timestamp, else null."""
    number = to_double(text)
    return F.coalesce(F.when(number.isNotNull(), epoch_to_timestamp(number)), text.try_cast("timestamp_ntz"))


def valid_key(key: Column, kind: Column) -> Column:
    """Whether an instrument key fits the grammar of its type; unknown types fit nothing."""
    out = F.lit(False)
    for name, pattern in KEY_PATTERNS.items():
        out = F.when(kind == name, key.rlike(pattern)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def option_symbol(underlying: Column, expiry: Column, put_call: Column, strike: Column) -> Column:
    """Underlying, yymmdd, C or P, strike times 1000 in eight digits."""
    thousandths = F.round(strike.cast("decimal(18,6)") * 1000, 0).cast("long").cast("string")
    return F.concat(F.upper(underlying), F.date_format(expiry, "yyMMdd"), F.upper(F.substring(put_call, 1, 1)), F.lpad(thousandths, 8, "0"))


def option_side(symbol: Column) -> Column:
    """C or P from an option symbol's end, else null."""
    return F.nullif(F.regexp_extract(symbol, "([CP])[0-9]+$", 1), F.lit(""))


def crypto_symbol(text: Column) -> Column:
    """BASE-QUOTE from BASE/QUOTE, BASE_QUOTE, BASE-QUOTE or BASEQUOTE; null for anything else."""
    plain = F.translate(F.upper(F.trim(text)), "/_", "--")
    joined = F.when(plain.contains("-"), plain).otherwise(F.regexp_replace(plain, "^([A-Z]{2,})(USDT|USDC|USD|EUR|GBP|BTC|ETH)$", "$1-$2"))
    return F.when(joined.rlike("^[A-Z]{2,10}-[A-Z]{2,10}$"), joined)


def equity_symbol(text: Column) -> Column:
    """Upper case, without trailing equals signs."""
    return F.regexp_replace(F.upper(F.trim(text)), "=+$", "")


def sector_fund(sector: Column) -> Column:
    """The sector's fund, SPY for an unknown one."""
    table = F.create_map(*[F.lit(x) for pair in SECTOR_FUNDS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(F.regexp_replace(F.trim(sector), r"\s+", " "))), F.lit("SPY"))


def with_prefix(key: Column, prefix: str = "equity") -> Column:
    """The key with a type prefix, unless it has one."""
    return F.when(key.contains(":"), key).otherwise(F.concat(F.lit(prefix + ":"), key))


def without_prefix(key: Column) -> Column:
    """The key without its type prefix."""
    return F.regexp_replace(key, "^[a-z]+:", "")


def sentiment_sign(text: Column) -> Column:
    """1 for bullish, -1 for bearish, else 0."""
    word = F.lower(F.trim(text))
    return F.when(word == "bullish", 1).when(word == "bearish", -1).otherwise(0)


def alignment(bullish: Column, sentiment: Column) -> Column:
    """1 when direction and sentiment agree, -1 when they differ, 0 without a sentiment."""
    return F.when(sentiment == 0, 0).when(bullish == (sentiment > 0), 1).otherwise(-1)


def to_date(text: Column) -> Column:
    """ISO date or yyyymmdd as a date, else null."""
    digits = F.when(text.rlike("^[0-9]{8}$"), F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)))
    return F.coalesce(digits, F.substring(text, 1, 10)).try_cast("date")


def horizon(dte: Column) -> Column:
    """Intraday to 2 days before expiry, swing to 21, leap beyond; null without days."""
    return F.when(dte <= 2, "intraday").when(dte <= 21, "swing").when(dte.isNotNull(), "leap")


def volatility_regime(level: Column) -> Column:
    """Low below 15, high above 25, else (and without a level) normal."""
    return F.when(level < 15, "low").when(level > 25, "high").otherwise("normal")


def suspect_flags(feed: str, **columns: Column) -> Column:
    """What is odd about a row of bars (open, high, low, close, volume), quotes (bid, ask) or trades (price, size).

    Rows are marked and not dropped; what is null is not odd.
    """
    c = columns
    negative = lambda *names: reduce(or_, [F.coalesce(c[n] < 0, F.lit(False)) for n in names])
    rules = {
        "bars": lambda: [(negative("open", "high", "low", "close"), "negative_price"), (negative("volume"), "negative_volume"), (c["high"] < c["low"], "high_below_low")],
        "quotes": lambda: [(c["bid"] > c["ask"], "inverted_spread"), (negative("bid", "ask"), "negative_price")],
        "trades": lambda: [(c["price"] <= 0, "non_positive_price"), (negative("size"), "negative_size")],
    }[feed]()
    return F.array_compact(F.array(*[F.when(odd, flag) for odd, flag in rules]))


def exchange_clock(time: Column, zone: str = "America/New_York", opens: int = 570, closes: int = 960) -> dict[str, Column]:
    """Hour, minute, weekday (Monday is 0) and minutes from the open and to the close of a UTC time, on the exchange's clock."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), time.cast("timestamp_ntz"))
    minute = F.hour(local) * 60 + F.minute(local)
    return {
        "hour": F.hour(local), "minute": F.minute(local), "weekday": F.weekday(local),
        "since_open": (minute - opens).cast("int"), "to_close": (F.lit(closes) - minute).cast("int"),
    }


def moneyness(spot: Column, strike: Column) -> dict[str, Column]:
    """Spot over strike and its logarithm; null where either is not positive."""
    ratio = F.when((spot > 0) & (strike > 0), spot / strike)
    return {"moneyness": ratio, "log_moneyness": F.ln(ratio)}


def tag_columns(tags: Column, wanted: Sequence[str], prefix: str = "tag_") -> dict[str, Column]:
    """A column of 0 and 1 per wanted tag, whatever the case of a list's tags; a null list has none."""
    low = F.transform(tags, lambda t: F.lower(F.trim(t)))
    return {prefix + t: F.coalesce(F.array_contains(low, t.lower()), F.lit(False)).cast("int") for t in wanted}


def to_list(text: Column) -> Column:
    """A list of texts: a JSON array, or one text as a list of one; null for blank text."""
    plain = F.nullif(F.trim(text), F.lit(""))
    return F.when(plain.startswith("["), F.from_json(plain, "array<string>")).when(plain.isNotNull(), F.array(plain))


def to_text(column: Column) -> Column:
    """Text without blanks at its ends; null for blank text."""
    return F.nullif(F.trim(column.cast("string")), F.lit(""))


def add_flag(flags: Column, flag: str, when: Column) -> Column:
    """The flag added once where the condition holds."""
    return F.when(when, F.array_union(flags, F.array(F.lit(flag)))).otherwise(flags)


def parse_duration(text: str) -> int:
    """Seconds of ``Nd``, ``Nh``, ``Nm``, ``Ns``, ``Nw`` or ``NM`` (months of 30 days)."""
    found = re.fullmatch(r"\s*([0-9]+)([dhmswM])\s*", text)
    if not found:
        raise ValueError(f"not a duration: {text!r}")
    return int(found[1]) * {"d": 86400, "h": 3600, "m": 60, "s": 1, "w": 604800, "M": 2592000}[found[2]]


def version_order(version: str) -> tuple[int, int, int, int, str]:
    """Sort key: semantic versions above all others, which compare as text (so v9 is above v10)."""
    plain = version.strip()
    found = re.match(r"v?(\d+)\.(\d+)\.(\d+)(?:[-+].*)?$", plain)
    return (1, *map(int, found.groups()), plain) if found else (0, 0, 0, 0, plain)
