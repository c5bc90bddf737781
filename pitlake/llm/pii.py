"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts scores.

Everything is a column expression over one row; nothing is shuffled. Patterns find the
same leftmost non-overlapping matches as their plain forms, written so that Java's engine
takes linear time and constant stack: quantifiers are possessive where nothing that
follows could give characters back, and a match starts only where a run starts or where
the match before ended. Positions are code points, summed from what lies between matches.
They are summed in blocks of about the square root of the number of matches, each with its
own piece of the text, so a text of a million matches costs some thousand reads of a few
thousand signs rather than a million reads of all of it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPAN = "struct<start:int,rank:int,end:int,kind:string,score:double>"
_PLACED = "struct<start:int,end:int,found:string>"
_FOLD = f"struct<pos:int,out:array<{_PLACED}>>"
_BLOCKS = f"struct<pos:int,out:array<struct<base:int,size:int,found:array<{_PLACED}>>>>"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _valid_ip(found: Column) -> Column:
    short = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(F.split(found, r"\."), lambda p: (F.length(short(p)) <= 3) & (F.substring(short(p), 1, 3).cast("int") <= 255))


def luhn(found: Column) -> Column:
    """Whether the digits of a string pass the Luhn check."""
    digits = F.transform(F.split(F.reverse(_digits(found)), ""), lambda c: c.try_cast("int"))
    doubled = F.transform(
        F.filter(digits, lambda d: d.isNotNull()),
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid_card(found: Column) -> Column:
    return F.length(_digits(found)).between(14, 19) & luhn(found)


def _valid_phone(found: Column) -> Column:
    return F.length(_digits(found)).between(10, 15)


def mod97(found: Column) -> Column:
    """Whether an account number passes the mod-97 check (remainder 1 with its first four signs last)."""
    plain = F.regexp_replace(found, "[^A-Z0-9]", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    values = F.transform(
        F.filter(F.split(turned, ""), lambda c: c != ""),
        lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55),
    )
    rest = F.aggregate(values, F.lit(0), lambda a, v: F.when(v > 9, a * 100 + v).otherwise(a * 10 + v) % 97)
    return (rest == 1) & F.length(plain).between(15, 34)


def _valid_iban(found: Column) -> Column:
    return mod97(found)


def _always(found: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    """One kind of personal data."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    needs: str = ""  # text without this sign holds no match
    base: bool = True  # base spans stay whatever their score


#: Fixed patterns. The base kinds first, in the order that breaks ties of start.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _always, 0.9, r"e-?mail|mail|contact|kontakt|correo|courriel", "@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", _valid_ip, 0.6, r"\bip\b|address|server|host|adresse", "."),
    Kind("card", r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9]){13,}+", _valid_card, 0.8, r"card|visa|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _valid_phone, 0.6, r"phone|tel|call|mobile|anruf|fax", "+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _valid_iban, 0.8, r"iban|account|konto|compte|cuenta", base=False),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", _always, 0.4, r"ssn|social security", "-", base=False),
)

#: Added to the score of a span with a context word among the signs before it; scores below KEPT drop an added span.
BONUS, WINDOW, KEPT = 0.2, 40, 0.6


def _blocks(items: Column) -> Column:
    """An array cut into arrays of about the square root of its length, of 64 at least."""
    step = F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(items))).cast("int"))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), step), lambda i: F.slice(items, i, step))


def _appended(out: Column, one: Column) -> Column:
    return F.concat(out, F.array(one))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _block(parts: Column) -> Column:
    """Length of a block of (between, found) and its matches with places from the block's start."""
    start = lambda acc, x: acc["pos"] + F.length(x["between"])
    one = lambda acc, x: F.struct(start(acc, x).alias("start"), (start(acc, x) + F.length(x["found"])).alias("end"), x["found"].alias("found"))
    return F.aggregate(
        parts,
        F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{_PLACED}>").alias("out")).cast(_FOLD),
        lambda acc, x: F.struct(
            (start(acc, x) + F.coalesce(F.length(x["found"]), F.lit(0))).alias("pos"),
            F.when(x["found"].isNull(), acc["out"]).otherwise(_appended(acc["out"], one(acc, x))).alias("out"),
        ).cast(_FOLD),
    )


def _spans(text: Column, kind: Kind, rank: int) -> Column:
    """Confirmed and scored spans of one kind."""
    parts = F.arrays_zip(
        F.split(text, kind.pattern, -1).alias("between"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found")
    )
    based = F.aggregate(
        _let(parts, lambda p: F.transform(_blocks(p), _block)),
        F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<base:int,size:int,found:array<" + _PLACED + ">>>").alias("out")).cast(_BLOCKS),
        lambda acc, b: F.struct(
            (acc["pos"] + b["pos"]).alias("pos"),
            _appended(acc["out"], F.struct(acc["pos"].alias("base"), b["pos"].alias("size"), b["out"].alias("found"))).alias("out"),
        ).cast(_BLOCKS),
        lambda acc: acc["out"],
    )

    def scored(s: Column, base: Column, piece: Column, first: Column) -> Column:
        """``piece`` is the text from ``first``, WINDOW signs before the block's start ``base``, on."""
        begin = F.greatest(base + s["start"] - WINDOW, F.lit(0))
        before = F.lower(F.substring(piece, begin - first + 1, base + s["start"] - begin))
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(before.rlike(kind.context), BONUS).otherwise(0.0))
        return F.struct(
            (base + s["start"]).alias("start"), F.lit(rank).alias("rank"), (base + s["end"]).alias("end"),
            F.lit(kind.name).alias("kind"), score.alias("score"),
        ).cast(_SPAN)

    def block(b: Column) -> Column:
        first = F.greatest(b["base"] - WINDOW, F.lit(0))
        confirmed = F.filter(b["found"], lambda s: kind.valid(s["found"]))
        piece = F.substring(text, first + 1, b["base"] + b["size"] - first)
        return _let(piece, lambda t: F.transform(confirmed, lambda s: scored(s, b["base"], t, first)))

    found = F.flatten(F.transform(based, block))
    if not kind.base:
        found = F.filter(found, lambda s: s["score"] >= KEPT - 1e-9)
    some = text.rlike(kind.pattern) if not kind.needs else text.contains(kind.needs) & text.rlike(kind.pattern)
    return F.when(some, found).otherwise(F.array().cast(f"array<{_SPAN}>"))


def find_spans(text: Column) -> Column:
    """All spans of a text column (not null), by start, then kind as listed: array of start, rank, end, kind, score."""
    return F.array_sort(F.concat(*[_spans(text, kind, rank) for rank, kind in enumerate(KINDS)]))


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan_documents(docs: DataFrame) -> DataFrame:
    """Personal data in every row of ``docs`` (doc_id, text).

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, top_score
    (null where nothing was found). Null texts count as empty: no spans, the hash of an
    empty list. Repeated rows each get their own result; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", find_spans(F.col("text")).alias("found"))
    base = [k.name for k in KINDS if k.base]
    count = lambda name: F.size(F.filter("found", lambda s: s["kind"] == name)).cast("long")
    kept = F.filter("found", lambda s: s["rank"] < len(base))
    return rows.select(
        "doc_id",
        *[count(name).alias(f"n_{name}") for name in base],
        F.sha2(_listed(kept), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["rank"] >= len(base))).cast("long").alias("n_added"),
        F.array_max(F.transform("found", lambda s: s["score"])).alias("top_score"),
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; an overlapping later span is swallowed."""
    state = "struct<pos:int,out:string>"

    def block(text: Column, some: Column, begin: Column) -> Column:
        """What takes the place of the text from ``begin`` to the last end of some spans."""
        end = F.greatest(begin, F.array_max(F.transform(some, lambda s: s["end"])))
        replaced = lambda piece: F.aggregate(
            some,
            F.struct(begin.alias("pos"), F.lit("").alias("out")).cast(state),
            lambda acc, s: F.struct(
                F.greatest(acc["pos"], s["end"]).alias("pos"),
                F.when(
                    s["start"] >= acc["pos"],
                    F.concat(acc["out"], F.substring(piece, acc["pos"] - begin + 1, s["start"] - acc["pos"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")),
                )
                .otherwise(acc["out"])
                .alias("out"),
            ).cast(state),
            lambda acc: acc["out"],
        )
        return _let(F.substring(text, begin + 1, end - begin), replaced)

    def whole(blocks: Column) -> Column:
        last = F.transform(blocks, lambda b: F.coalesce(F.array_max(F.transform(b, lambda s: s["end"])), F.lit(0)))

        def joined(ends: Column) -> Column:
            begins = F.transform(ends, lambda _, i: F.coalesce(F.array_max(F.slice(ends, F.lit(1), i)), F.lit(0)))
            pieces = F.zip_with(blocks, begins, lambda b, begin: block(text, b, begin))
            return F.concat(F.array_join(pieces, ""), F.substring(text, F.array_max(ends) + 1, F.length(text)))

        return _let(last, joined)

    return _let(spans, lambda all_: _let(_blocks(all_), whole))


def redact_documents(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` (any beside ``text``), personal data replaced in ``text``.

    A null text stays null, an empty one empty; repeated rows are treated alike; an empty
    table gives an empty result. ``n_chars``, where there is such a column, is the new length.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", find_spans(F.coalesce("row.text", F.lit(""))).alias("spans"))
    cleaned = F.when(F.size("spans") > 0, redact(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text"))
    changed = rows.select("row", cleaned.alias("text"))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return changed.select(*[v.alias(k) for k, v in columns.items()])
