"""MinHash near-duplicates by an inverted join over signature coordinates.

Every document is posted under its (coordinate, value) pairs. Two documents count as
candidates when at least ``least`` of ``SIZE`` coordinates collide. Postings are merged
with prefix and skip filtering: pairs that one document alone holds are skipped, so is a
document with fewer than ``least`` shared pairs, and the others post only their rarest
``shared - least + 1`` pairs, one of which any candidate pair must have in common.

Candidates are confirmed on full shingle sets (``100 * intersection >= percent * union``).
How many collisions are asked for follows from the threshold and the number of coordinates
(:func:`collisions`): a pair at the threshold is missed with a probability of at most
``MISS``. With 64 coordinates these are 40 at 0.85 and 36 at 0.8.

Texts with equal sets form one class. Only connectivity is asked for, so large groups are
first tied together through a few leaders per posting list (a linear number of pairs).
Then every candidate pair whose ends are still apart is confirmed: lists that lie within
one component are skipped whole, longer ones are cut into blocks; a second, longer
signature of these documents alone rules out pairs that are clearly below the threshold
(a pair at it passes with a probability above 0.999999; ``fine=False`` leaves it out). No
other pair is dropped.

Shingles are hashed under a key that is drawn for every run, see :mod:`pitlake.llm.shingles`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import discard, sparing, written
from pitlake.llm.components import components
from pitlake.llm.shingles import MinHash, Shingler, new_key, overlap

SIZE, LEADERS, BLOCK, MISS = 64, 3, 1024, 5e-6

#: Coordinates of a second signature, one byte each, that only documents still apart get.
FINE = 512


def collisions(percent: int, size: int = SIZE) -> int:
    """The most collisions that a pair at the threshold reaches with a probability of at least 1 - MISS.

    A threshold so low that this is none cannot be served by so few coordinates, an error.
    """
    share = percent / 100
    least, below = 0, 0.0
    while least < size and (below := below + math.comb(size, least) * share**least * (1 - share) ** (size - least)) <= MISS:
        least += 1
    if not least:
        raise ValueError(f"{size} coordinates are too few for a threshold of {percent} percent")
    return least


def fine_least(percent: int) -> int:
    """Collisions asked for in the second signature: 4.9 deviations below what a pair at the threshold has."""
    share = percent / 100
    return int(FINE * (share + (1 - share) / 256) - 4.9 * math.sqrt(FINE * share * (1 - share)))


def _signed(size: int, secret: bytes):
    """doc_id, text -> doc_id, n, set key, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign, shingle_set = MinHash(size), Shingler(secret)
        for batch in batches:
            ns, keys, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text)
                ns.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signatures.append(sign(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())],
                ["doc_id", "n", "key", "signature"],
            )

    return run


def _sets(secret: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle_set = Shingler(secret)
        for batch in batches:
            found = [shingle_set(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["rep", "found"])

    return run


def _matching(least: int):
    """Pairs with both signatures -> pairs with their number of collisions, if enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for i in (2, 3)
            )
            same = (left == right).sum(1)
            keep = pa.array(np.flatnonzero(same >= least))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(keep), batch.column(1).take(keep), pa.array(same[same >= least], pa.int64())],
                ["a", "b", "same"],
            )

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                left, right = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = overlap(left, right)
                if 100 * both >= percent * (len(left) + len(right) - both):
                    keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], ["a", "b"])

    return run


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets -> a row per document and shingle."""
    for batch in batches:
        found = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column(1)]
        owner = np.repeat(batch.column(0).to_numpy(), [len(f) for f in found])
        hashes = np.concatenate(found) if found else np.zeros(0, np.int64)
        for i in range(0, len(hashes), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(owner[i : i + 200_000]), pa.array(hashes[i : i + 200_000])], ["rep", "h"])


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets -> second signatures."""
    sign = MinHash(FINE, seed=2)
    for batch in batches:
        found = [sign(np.frombuffer(v.as_buffer(), np.uint64)).astype(np.uint8).tobytes() for v in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["rep", "fine"])


def _first_met(piece: pa.Table, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows have no posting list in common that comes before this one."""
    token = int(piece["token"][0].as_py())
    lists = piece["prefix"].to_pylist()
    width = max(map(len, lists))
    # Lists from this one on are hidden by numbers that differ between the two sides.
    top = np.iinfo(np.int64).max
    one, two = np.full((len(lists), width), top, np.int64), np.full((len(lists), width), top - 1, np.int64)
    for row, tokens in enumerate(lists):
        some = [t for t in tokens if t < token]
        one[row, : len(some)] = two[row, : len(some)] = some
    out = np.ones(len(i), bool)
    for k in range(0, len(i), 4096):
        out[k : k + 4096] = ~(one[i[k : k + 4096], :, None] == two[j[k : k + 4096], None, :]).any((1, 2))
    return out


def _apart(least: int, percent: int, fine_too: bool):
    """One pair of blocks of a posting list: candidate pairs in different components.

    No more than the shingles that a document shares with any other can be common to a
    pair, which rules out most pairs of a group whose members each have edits of their own.
    """

    def run(piece: pa.Table) -> pa.Table:
        ids, tops, side, n, shared = (piece[c].to_numpy() for c in ("rep", "top", "side", "n", "shared"))
        left = np.flatnonzero(side == 0)
        own = bool(piece["own"][0].as_py())
        right = left if own else np.flatnonzero(side == 1)
        found_a, found_b = [], []
        if len(left) and len(right):
            signs = np.frombuffer(b"".join(piece["signature"].to_pylist()), np.uint32).reshape(len(ids), -1)
            same = np.zeros((len(left), len(right)), np.uint8)
            for k in range(signs.shape[1]):
                same += signs[left, k][:, None] == signs[right, k][None, :]
            hit = (same >= least) & (tops[left][:, None] != tops[right][None, :])
            most = np.minimum(shared[left][:, None], shared[right][None, :])
            hit &= 100 * most >= percent * (n[left][:, None] + n[right][None, :] - most)
            i, j = np.nonzero(np.triu(hit, 1) if own else hit)
            i, j = left[i], right[j]
            new = _first_met(piece, i, j)
            i, j = i[new], j[new]
            if fine_too:
                fine = np.frombuffer(b"".join(piece["fine"].to_pylist()), np.uint8).reshape(len(ids), -1)
                keep = [
                    (fine[i[k : k + 4096]] == fine[j[k : k + 4096]]).sum(1) >= fine_least(percent)
                    for k in range(0, len(i), 4096)
                ]
                chosen = np.concatenate(keep) if keep else np.zeros(0, bool)
                i, j = i[chosen], j[chosen]
            found_a, found_b = ids[i], ids[j]
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return run


def _mixed(posts: DataFrame) -> DataFrame:
    """(token, blocks) of the posting lists that span several components."""
    lists = posts.groupBy("token").agg(F.min("top").alias("low"), F.max("top").alias("high"), F.count("*").alias("held"))
    return lists.where("low < high").select("token", F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    first = sets.select(F.col("rep").alias("a"), F.col("found").alias("found_a"))
    second = sets.select(F.col("rep").alias("b"), F.col("found").alias("found_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "found_a", "found_b")
    return both.mapInArrow(_confirmed(percent), "a long, b long")


def near_texts(docs: DataFrame, percent: int = 85, size: int = SIZE, fine: bool = True, secret: bytes | None = None) -> DataFrame:
    """Near-duplicates among the rows of ``docs`` (doc_id, text).

    Returns doc_id, n_shingles, component_id, kept, one row per input row. Rows without
    words link with nothing. Rows with an equal doc_id are one node; a row without doc_id
    links with nothing, has a null component and is kept. Very long texts are taken whole.
    An empty table gives an empty result; other columns are ignored. ``secret`` is the key
    of the hashes, drawn anew by default; links do not depend on it.
    """
    least, secret = collisions(percent, size), secret or new_key()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(rows.mapInArrow(sparing(_signed(size, secret)), "doc_id long, n long, key binary, signature binary"), "minhash")
    known = signed.where("key IS NOT NULL AND doc_id IS NOT NULL")
    classes = written(
        known.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "text-classes"
    )

    # Post classes under their coordinates; skip pairs and classes that cannot reach the threshold.
    coordinates = F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.xxhash64(i, F.substring("signature", i * 4 + 1, F.lit(4)))
    )
    posted = classes.select("rep", F.explode(coordinates).alias("token"))
    held = posted.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    shared = posted.join(held, "token").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("held", "token"))).alias("tokens")  # at most one entry per coordinate
    )
    prefix = F.slice("tokens", 1, F.size("tokens") - least + 1)
    # A document is the more central the more others share its coordinates; the hash breaks ties.
    central = F.aggregate("tokens", F.lit(0).cast("long"), lambda a, t: a + t["held"]) * (1 << 20) + F.pmod(F.xxhash64("rep"), F.lit(1 << 20))
    posts = written(
        shared.where(F.size("tokens") >= least)
        .select("rep", central.alias("central"), F.explode(prefix).alias("entry"))
        .select("rep", "central", "entry.token"),
        "postings",
    )
    signatures = classes.select("rep", "signature")

    # Tie large groups together through a few leaders per list.
    leaders = posts.groupBy("token").agg(
        F.count("*").alias("held"),
        F.max_by("rep", "central").alias("leader0"),
        *[F.min_by("rep", F.xxhash64("rep", F.lit(k))).alias(f"leader{k}") for k in range(1, LEADERS)],
    ).where("held > 1")
    led = posts.join(leaders, "token").select("rep", F.explode(F.array(*[f"leader{k}" for k in range(LEADERS)])).alias("leader"))
    stars = _ordered(led.select(F.col("rep").alias("a"), F.col("leader").alias("b")))
    matched = (
        stars.join(signatures.select(F.col("rep").alias("a"), F.col("signature").alias("left")), "a")
        .join(signatures.select(F.col("rep").alias("b"), F.col("signature").alias("right")), "b")
        .select("a", "b", "left", "right")
        .mapInArrow(_matching(least), "a long, b long, same long")
    )
    stars = written(matched.select("a", "b"), "stars")

    # Full sets of the classes that are still candidates.
    wanted = posts.select(F.col("rep").alias("doc_id")).distinct()
    sets = written(rows.join(wanted, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(sparing(_sets(secret)), "rep long, found binary"), "sets")
    links = written(_linked(stars, sets, percent), "links")
    tied = components(links)

    # Every candidate pair that is still apart, list by list.
    placed = posts.join(tied.withColumnRenamed("node", "rep"), "rep", "left").select(
        "token", "rep", F.coalesce("component", "rep").alias("top")
    )
    placed = written(placed, "placed")
    open_posts = placed.join(_mixed(placed).select("token"), "token", "left_semi")
    own_sets = sets.join(open_posts.select("rep").distinct(), "rep", "left_semi")
    own = written(own_sets.mapInArrow(_exploded, "rep long, h long"), "own-shingles")
    common = own.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    counts = own.join(common, "h", "left_semi").groupBy("rep").agg(F.count("*").alias("shared"))
    sizes = sets.select("rep", F.expr("octet_length(found) div 8").alias("n")).join(counts, "rep")
    # A document that shares too few shingles with all others together links with none of them.
    sizes = written(sizes.where(F.col("shared") * 100 >= F.col("n") * percent), "able-sizes")
    able_sets = sets.join(sizes.select("rep"), "rep", "left_semi")
    second = able_sets.mapInArrow(_refined, "rep long, fine binary") if fine else able_sets.select("rep", F.lit(b"").alias("fine"))
    prefixes = placed.groupBy("rep").agg(F.collect_set("token").alias("prefix"))  # at most size - least + 1 each
    able = written(sizes.join(signatures, "rep").join(second, "rep").join(prefixes, "rep"), "able")
    open_posts_table = written(open_posts.join(able.select("rep"), "rep", "left_semi").select("token", "rep", "top"), "open-postings")
    open_posts = open_posts_table.join(_mixed(open_posts_table), "token").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    pieces = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(
            F.least("block", j).alias("i"), F.greatest("block", j).alias("j"),
            F.when(j < F.col("block"), 1).otherwise(0).alias("side"), (j == F.col("block")).alias("own"),
        ),
    )
    work = (
        open_posts.withColumn("piece", F.explode(pieces))
        .select("token", "rep", "top", "piece.i", "piece.j", "piece.side", "piece.own")
        .join(able, "rep")
    )
    rest = _ordered(
        work.groupBy("token", "i", "j").applyInArrow(_apart(least, percent, fine), "a long, b long")
    ).join(stars, ["a", "b"], "left_anti")
    more = written(_linked(rest, sets, percent), "links")
    found = components(links.unionByName(more)) if more.limit(1).count() else tied
    for done in (posts, stars, sets, placed, links, more, own, sizes, able, open_posts_table):
        discard(done)

    ends = classes.select("key", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    ends = ends.select("key", F.coalesce("component", "rep").alias("component"))
    mine = signed.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key"))
    return mine.join(ends, "key", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
