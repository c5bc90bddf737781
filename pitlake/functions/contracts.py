"""Provider payloads to the columns of a feed: which of several names holds a value, and how it is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.functions.payloads import first_present

#: Canonical column -> names under which providers send it, the first that holds something counts.
NAMES = {
    "news": {
        "article_id": ("article_id", "id"),
        "published_at": ("published_at", "created_at", "updated_at"),
        "body": ("body", "content"),
        "source": ("source.name", "source.id", "source"),
    },
    "congress_trades": {
        "politician_name": ("politician_name", "name", "reporter", "politician"),
        "trade_type": ("trade_type", "txn_type", "transaction_type"),
        "trade_date": ("trade_date", "transaction_date", "date"),
        "disclosure_date": ("disclosure_date", "filed_at_date", "filing_date"),
        "trade_id": ("trade_id", "transaction_id", "id"),
    },
    "insider_trades": {
        "insider_name": ("insider_name", "owner_name", "insider"),
        "insider_title": ("insider_title", "officer_title"),
        "trade_type": ("trade_type", "transaction_code", "transaction_type"),
        "trade_date": ("trade_date", "transaction_date"),
        "filing_id": ("filing_id", "id", "transaction_id"),
        "shares": ("shares", "amount", "size"),
    },
    "market_tide": {"net_call_premium": ("net_call_premium",), "net_put_premium": ("net_put_premium",)},
    "sector_tide": {"net_call_premium": ("net_call_premium",), "net_put_premium": ("net_put_premium",)},
    "flow_alerts": {"premium": ("premium",), "volume": ("volume",)},
    "short_data": {"short_interest": ("short_interest", "short_volume"), "short_percent_float": ("short_percent_float", "short_ratio")},
    "oi_change": {"call_oi": ("call_oi",), "put_oi": ("put_oi",)},
    "historic_option_volume": {"volume": ("volume",)},
}
#: Flags of an insider and what they say about the relationship.
ROLES = {"is_director": "director", "is_officer": "officer", "is_ten_percent_owner": "ten_percent_owner", "is_10b5_1": "10b5-1"}
#: Feeds whose empty date is the event's.
DATED = ("short_data", "oi_change", "historic_option_volume")
#: Fixed value: an amount, or a range of amounts.
AMOUNTS = r"\$?([0-9][0-9,]*(?:\.[0-9]+)?)(?:\s*-\s*\$?([0-9][0-9,]*(?:\.[0-9]+)?))?"


def amount_range(text: Column) -> tuple[Column, Column]:
    """The lower and upper amount of a text such as ``$1,001 - $15,000``; a single amount is both."""
    number = lambda g: F.nullif(F.replace(F.regexp_extract(text, AMOUNTS, g), F.lit(","), F.lit("")), F.lit("")).try_cast("double")
    return number(1), F.coalesce(number(2), number(1))


def relationship(payload: Column) -> Column:
    """What an insider is, of several things joined by bars; null for none of them."""
    held = [F.when(F.lower(F.get_json_object(payload, f"$.{flag}")).isin("true", "1"), label) for flag, label in ROLES.items()]
    return F.nullif(F.array_join(F.array_compact(F.array(*held)), "|"), F.lit(""))


def side_initial(text: Column) -> Column:
    """C or P where a text begins like call or put, else the text."""
    first = F.upper(F.substring(F.trim(text), 1, 1))
    return F.when(first.isin("C", "P"), first).otherwise(text)


def normalised(feed: str, payload: Column, event: Column) -> dict[str, Column]:
    """The columns of a feed out of a JSON payload; ``event`` is the row's time."""
    out = {name: first_present(payload, names) for name, names in NAMES.get(feed, {}).items()}
    if feed == "congress_trades":
        out["amount_min"], out["amount_max"] = amount_range(first_present(payload, ["amounts", "amount_range", "amount"]))
    elif feed == "insider_trades":
        out["insider_relationship"] = F.coalesce(first_present(payload, ["insider_relationship"]), relationship(payload))
    elif feed in ("market_tide", "sector_tide"):
        call, put = (out[c].try_cast("decimal(38,10)") for c in ("net_call_premium", "net_put_premium"))
        given = first_present(payload, ["call_put_ratio"]).try_cast("double")
        out["call_put_ratio"] = F.coalesce(given, F.try_divide(call.cast("double"), put.cast("double")))
    elif feed == "flow_alerts":
        out["put_call"] = side_initial(first_present(payload, ["put_call"]))
    if feed in DATED:
        out["date"] = F.coalesce(first_present(payload, ["date"]), F.date_format(event, "yyyy-MM-dd"))
    return out


def with_columns_of(df: DataFrame, feed: str, payload: str = "payload", event: str = "ts_event") -> DataFrame:
    """``df`` with the feed's columns in place of its payload."""
    return df.select(*[c for c in df.columns if c != payload], *[v.alias(k) for k, v in normalised(feed, F.col(payload), F.col(event)).items()])
