"""Document fingerprints from prefix polynomial hashes.

``prefix_array`` holds the modular prefix sums of ``code point * BASE**position``. Any
span's hash is a difference of two entries times an inverse power, so any two spans are
compared at constant cost (:func:`spans_equal`) and the longest common extension of two
places is found by binary search (:func:`longest_extension`).

A fingerprint carries the length, two whole-text hashes, and 16 bits of the hash of every
prefix and suffix whose length is on a geometric grid. Two fingerprints are compared like
two texts: binary search finds the longest grid prefix and suffix on which they agree. The
grid holds every length up to 8, then lengths a quarter apart. While both texts are at hand
their longest common prefix and suffix are also found exactly, from the prefix arrays.

Every text is read once. The next document's text reaches a row through one shuffle by
range of doc_id; rows stream through in order, so a task holds two texts at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the hash: moduli below 2**31, bases, and the ratio and least length of the grid.
MODULI = (2147483647, 2147483629)
BASES = (1000003, 998244353)
GRID_LEAST, GRID_RATIO = 1, 1.25

#: Bytes of text of a range of rows; more where there would be more ranges than the driver should know of.
RANGE_BYTES, MOST_RANGES = 2 << 20, 100_000

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, shared_edited double, shared_next double"
)


class Powers:
    """Powers of a base and of its inverse, grown as texts need them."""

    def __init__(self, base: int, modulus: int) -> None:
        self.modulus = modulus
        self._bases = (base, pow(base, -1, modulus))
        self._tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def _grown(self, which: int, n: int) -> np.ndarray:
        found = self._tables[which]
        while len(found) <= n:
            step = pow(self._bases[which], len(found), self.modulus)
            found = np.concatenate([found, found * np.uint64(step) % np.uint64(self.modulus)])
        self._tables[which] = found
        return found

    def up(self, n: int) -> np.ndarray:
        """Powers 0 to at least n of the base."""
        return self._grown(0, n)

    def down(self, n: int) -> np.ndarray:
        """Powers 0 to at least n of the inverse."""
        return self._grown(1, n)


_POWERS = [Powers(b, m) for b, m in zip(BASES, MODULI, strict=True)]


def code_points(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def prefix_array(points: np.ndarray, which: int = 0) -> np.ndarray:
    """Entry i is the hash of the first i code points, modulo ``MODULI[which]``."""
    modulus = np.uint64(MODULI[which])
    out = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(points * _POWERS[which].up(len(points))[: len(points)] % modulus, out=out[1:])
    return out % modulus


def span_hash(prefix: np.ndarray, start, end, which: int = 0):
    """Position-free hash of spans [start, end); start and end may be arrays."""
    modulus = np.uint64(MODULI[which])
    gap = (prefix[end] + modulus - prefix[start]) % modulus
    return gap * _POWERS[which].down(int(np.max(start, initial=0)))[start] % modulus


def spans_equal(a: list[np.ndarray], i: int, b: list[np.ndarray], j: int, length: int) -> bool:
    """Whether a[i:i+length] equals b[j:j+length], given both prefix arrays of each text."""
    for k, modulus in enumerate(MODULI):
        x = int(a[k][i + length]) - int(a[k][i])
        y = int(b[k][j + length]) - int(b[k][j])
        # x and y carry the powers i and j of the base: the lower one is raised.
        if i < j:
            x *= int(_POWERS[k].up(j - i)[j - i])
        elif j < i:
            y *= int(_POWERS[k].up(i - j)[i - j])
        if (x - y) % modulus:
            return False
    return True


def longest_extension(a: list[np.ndarray], i: int, b: list[np.ndarray], j: int) -> int:
    """Length of the longest common extension of a from i and b from j."""
    low, high = 0, min(len(a[0]) - 1 - i, len(b[0]) - 1 - j)
    while low < high:
        middle = (low + high + 1) // 2
        if spans_equal(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def longest_suffix(a: list[np.ndarray], b: list[np.ndarray]) -> int:
    """Length of the longest common suffix of two texts."""
    n, m = len(a[0]) - 1, len(b[0]) - 1
    low, high = 0, min(n, m)
    while low < high:
        middle = (low + high + 1) // 2
        if spans_equal(a, n - middle, b, m - middle, middle):
            low = middle
        else:
            high = middle - 1
    return low


def shared(a: list[np.ndarray], b: list[np.ndarray]) -> float:
    """0 to 1: 1 for equal texts, else their longest common prefix and suffix over the longer length."""
    n, m = len(a[0]) - 1, len(b[0]) - 1
    head = longest_extension(a, 0, b, 0)
    if head == n == m:
        return 1.0
    tail = min(longest_suffix(a, b), min(n, m) - head)
    return (head + tail) / max(n, m)


def _grid(most: int) -> np.ndarray:
    found, at = [], float(GRID_LEAST)
    while int(at) <= most:
        found.append(int(at))
        at = max(at + 1, at * GRID_RATIO)
    return np.array(found, np.int64)


_GRID = _grid(1 << 33)


def _render(n: int, prefixes: list[np.ndarray]) -> str:
    grid = _GRID[: int(np.searchsorted(_GRID, n, side="right"))]
    heads = prefixes[0][grid]
    tails = span_hash(prefixes[0], n - grid, np.full_like(grid, n)) if len(grid) else heads
    short = [((x * np.uint64(2654435761)) >> np.uint64(15) & np.uint64(0xFFFF)).astype(">u2").tobytes().hex() for x in (heads, tails)]
    whole = "".join(f"{int(p[n]):08x}" for p in prefixes)
    return f"{n:x}-{whole}-{short[0]}-{short[1]}"


def text_prefixes(text: str) -> list[np.ndarray]:
    """Both prefix arrays of a text."""
    points = code_points(text)
    return [prefix_array(points, k) for k in range(len(MODULI))]


def fingerprint(text: str | None) -> str:
    """The fingerprint of a text; null counts as empty."""
    prefixes = text_prefixes(text or "")
    return _render(len(prefixes[0]) - 1, prefixes)


def likeness(a: str, b: str) -> float:
    """0 to 1: 1 for equal fingerprints, else the shared grid prefix and suffix over the longer length."""
    if a == b:
        return 1.0
    (na, _, head_a, tail_a), (nb, _, head_b, tail_b) = a.split("-"), b.split("-")
    shorter, longer = sorted((int(na, 16), int(nb, 16)))

    def agreed(x: str, y: str) -> int:
        low, high = 0, min(len(x), len(y)) // 4
        while low < high:
            middle = (low + high + 1) // 2
            if x[4 * middle - 4 : 4 * middle] == y[4 * middle - 4 : 4 * middle]:
                low = middle
            else:
                high = middle - 1
        return int(_GRID[low - 1]) if low else 0

    # A prefix and a suffix that overlap in the shorter text are one stretch of it, counted once.
    return min(agreed(head_a, head_b) + agreed(tail_a, tail_b), shorter, longer - 1) / longer


def _spliced(own: list[np.ndarray], keep: int, other: list[np.ndarray], take: int) -> list[np.ndarray]:
    """Prefix arrays of own[:keep] + other[:take], from theirs alone."""
    out = []
    for k, modulus in enumerate(map(np.uint64, MODULI)):
        shift = _POWERS[k].up(keep)[keep]
        tail = (other[k][1 : take + 1] * shift % modulus + own[k][keep]) % modulus
        out.append(np.concatenate([own[k][: keep + 1], tail]))
    return out


def _row(doc_id, text: str, prefixes: list[np.ndarray], own: str, after: tuple[str, list[np.ndarray], str]) -> tuple:
    following, following_prefixes, following_print = after
    n = len(text)
    keep, take = n - n // 3, min(n // 3, len(following))
    edited = text[:keep] + following[:take]
    edited_prefixes = _spliced(prefixes, keep, following_prefixes, take)
    edited_print = _render(keep + take, edited_prefixes)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id, n, digest, own, edited_print, likeness(own, edited_print), likeness(own, following_print),
        shared(prefixes, edited_prefixes), shared(prefixes, following_prefixes),
    )


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range, descending; a range's last row is followed by the head of the next (context)."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    empty = ("", text_prefixes(""), fingerprint(""))
    out: list[tuple] = []
    held = None  # (range, doc_id, text, prefixes, fingerprint) that waits for the next row
    ended = None  # the range whose context was used
    for batch in batches:
        for part, context, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if context and part == ended:
                continue
            text = text or ""
            prefixes = text_prefixes(text)
            now = (text, prefixes, _render(len(text), prefixes))
            if held is not None and held[0] == part:
                out.append(_row(held[1], *held[2:], now))
            held = None
            if context:
                ended = part
            elif doc_id is None:
                out.append(_row(None, *now, empty))
            else:
                held = (part, doc_id, *now)
            if len(out) >= 500:
                yield packed(out)
                out = []
    if out:
        yield packed(out)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all rows of ``docs`` (doc_id, text) and of their edited texts.

    The next document is the next by descending doc_id, for the last one the first; rows
    with equal doc_id are ordered by text. Rows without a doc_id stand outside that order
    and have an empty next document. Null texts count as empty, an empty table gives an
    empty result, other columns are ignored. ``near_edited`` and ``near_next`` compare
    fingerprints; ``shared_edited`` and ``shared_next`` are the same measure of the texts,
    exact, by longest common extensions.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    size = docs.where("doc_id IS NOT NULL").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n = size["n"]
    parts = max(1, min(MOST_RANGES, n, (size["bytes"] or 0) // RANGE_BYTES))
    cuts: list[float] = []
    if n and parts > 1:
        found = ids.select(F.col("doc_id").cast("double").alias("x")).approxQuantile(
            "x", [i / parts for i in range(1, parts)], 1 / (4 * parts)
        )
        cuts = sorted(set(found))
    inner = [float("-inf"), *cuts, float("inf")]

    def ranged(df: DataFrame) -> DataFrame:
        if not cuts:
            return df.withColumn("part", F.when(F.col("doc_id").isNotNull(), 0))
        cutter = Bucketizer(splits=inner, inputCol="x", outputCol="part", handleInvalid="keep")
        return cutter.transform(df.withColumn("x", F.col("doc_id").cast("double"))).withColumn(
            "part", F.col("part").cast("int")
        )

    # One number per range, at most MOST_RANGES, reaches the driver.
    heads = {r["part"]: r["head"] for r in ranged(ids).groupBy("part").agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads)  # ranges that hold rows, from the lowest
    before = {part: order[(i + 1) % len(order)] for i, part in enumerate(order)}  # whose last row precedes this range's head
    slots = range(len(inner) - 1)
    head_of, before_of = _literal(heads, slots, "bigint"), _literal(before, slots, "int")

    rows = ranged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    aside = (-1 - F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(4096))).cast("int")  # in any task, they have no next one
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), aside).otherwise(F.col("part")))
    is_head = F.col("doc_id").isNotNull() & (F.col("doc_id") == F.get(head_of, F.col("part")))
    own = F.struct(F.col("part").alias("at"), F.lit(0).alias("context"))
    again = F.struct(F.get(before_of, F.col("part")).alias("at"), F.lit(1).alias("context"))
    spread = rows.withColumn("to", F.explode(F.when(is_head, F.array(own, again)).otherwise(F.array(own))))
    return (
        spread.select("to.at", "to.context", "doc_id", "text")
        .repartition("at")
        .sortWithinPartitions("at", "context", F.col("doc_id").desc(), "text")
        .mapInArrow(_stream, SCHEMA)
    )


def _literal(values: dict[int, int], slots: range, kind: str):
    """An array constant, parsed once instead of built per row."""
    body = ",".join("null" if values.get(p) is None else str(values[p]) for p in slots)
    return F.from_json(F.lit(f"[{body}]"), f"array<{kind}>")
