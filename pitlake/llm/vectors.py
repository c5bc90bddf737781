"""Near-duplicate vectors: Euclidean p-stable hashing, then exact cosines.

Vectors are normalised, so Euclidean distance is a function of the cosine. A table's key
is a tuple of quantised Gaussian projections, ``floor((g . x + offset) / width)``. How many
projections a key has follows from the size of a label (:func:`plan`): unrelated vectors of
a label meet a vector in about ``MET`` rows of a bucket at any size, and there are as many
tables as it takes for a pair at the threshold to meet in at least one of them with a
probability of ``1 - MISS``.

What is posted per table is an identifier and a 128-bit sketch (signs of projections), not
the vector. Rows of a bucket whose sketch is near no other one's there cannot have a
partner in it and are set aside (a pair at the threshold fails that with a probability
below ``MISS / 100``); a bucket of more than ``BIG`` rows keeps all. Vectors are fetched for
the rows that remain, and compared by their cosine in double precision, label by label.

Equal vectors of a label form one class and are compared once. A bucket may hold any share
of all classes: it is cut into blocks of ``BLOCK`` rows and each pair of blocks is a piece of
work of its own. A pair counts in the first bucket that its two ends share. What leaves a
block is a count per vector and a spanning forest of the links found, not the pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import discard, written
from pitlake.llm.components import components

BLOCK, BIG = 1024, 8192
MET, MISS, WIDTH, SKETCH = 256, 5e-4, 2.2, 128


def meeting_probability(cosine: float, projections: int, width: float = WIDTH, tables: int = 1) -> float:
    """Probability that two unit vectors share a key in at least one table."""
    t = width / math.sqrt(max(1e-12, 2 - 2 * cosine))
    density = lambda x: math.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    below = 0.5 * (1 + math.erf(t / math.sqrt(2)))
    one = 2 * below - 1 - 2 / t * (density(0) - density(t))
    return 1 - (1 - one**projections) ** tables


def plan(size_class: int, threshold: float, width: float = WIDTH) -> tuple[int, int]:
    """(projections of a key, tables) for a label of ``2 ** size_class`` vectors.

    Vectors without any likeness (cosine 0) are to meet in ``MET`` rows of a bucket.
    """
    apart = meeting_probability(0.0, 1, width)
    projections = max(2, math.ceil(math.log(max(1.0, 2.0**size_class / MET)) / -math.log(apart)))
    tables = math.ceil(math.log(MISS) / math.log1p(-min(1 - 1e-12, meeting_probability(threshold, projections, width))))
    return projections, tables


def sketch_radius(threshold: float, bits: int = SKETCH) -> int:
    """The least distance of sketches that a pair at the threshold exceeds with a probability below MISS / 100."""
    p = math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    chance, left = (1 - p) ** bits, 1.0
    for k in range(bits + 1):
        left -= chance
        if left < MISS / 100:
            return k
        chance *= (bits - k) / (k + 1) * p / (1 - p) if p < 1 else 0
    return bits


def _planes(dims: int, columns: int, seed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([*seed, dims])
    return rng.standard_normal((dims, columns)), rng.random(columns)


def _mix(out: np.ndarray, column: np.ndarray) -> np.ndarray:
    out = (out ^ column.astype(np.int64).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def _usable(values: list | None) -> np.ndarray | None:
    """The vector, if it can have a cosine; as single precision where that loses nothing."""
    if not values or any(v is None for v in values):
        return None
    x = np.asarray(values, np.float64)
    if not np.isfinite(x).all() or not x.any():
        return None
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return short if np.array_equal(short, x) else x


def _unit(x: np.ndarray) -> np.ndarray:
    """Scaled to length one in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max()
    return x / math.sqrt(float(x @ x))


def _packed(x: np.ndarray) -> bytes:
    return (b"f" if x.dtype == np.float32 else b"d") + x.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return _unit(np.frombuffer(data, np.float32 if data[:1] == b"f" else np.float64, offset=1))


def _classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable rows, with the vector as bytes and a 128-bit key of label and vector."""
    for batch in batches:
        found = [_usable(v) for v in batch.column(2).to_pylist()]
        keep = [i for i, x in enumerate(found) if x is not None]
        labels = batch.column(1).take(pa.array(keep, pa.int64()))
        units = [_packed(found[i]) for i in keep]
        keys = [hashlib.blake2b(u + lab.encode(), digest_size=16).digest() for u, lab in zip(units, labels.to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(keep, pa.int64())), labels, pa.array(units, pa.binary()), pa.array(keys, pa.binary())],
            ["vec_id", "label", "unit", "class"],
        )


def _posted(threshold: float, width: float, seed: int):
    """rep, label, unit, size class -> a row per table: bucket, table, rep, two halves of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, ...], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = [_unpacked(x) for x in batch.column(2).to_pylist()]
            reps = batch.column(0).to_numpy()
            marks = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in batch.column(1).to_pylist()], np.uint64)
            shapes = np.array([(len(x), c) for x, c in zip(vectors, batch.column(3).to_pylist(), strict=True)])
            for d, c in np.unique(shapes, axis=0).tolist():
                k, tables = plan(c, threshold, width)
                if (d, c) not in planes:
                    planes[d, c] = _planes(d, k * tables, [seed, c])
                    planes[(d,)] = _planes(d, SKETCH, [seed])
                at = np.flatnonzero((shapes == (d, c)).all(1))
                for part in np.array_split(at, max(1, len(at) * tables // 100_000)):
                    x = np.stack([vectors[i] for i in part])
                    g, offset = planes[d, c]
                    cells = np.floor(x @ g / width + offset)
                    signs = np.packbits(x @ planes[(d,)][0] > 0, axis=1).view(np.int64)
                    for t in range(tables):
                        key = _mix(marks[part], np.full(len(part), (d << 20) + t))
                        for column in cells[:, t * k : (t + 1) * k].T:
                            key = _mix(key, column)
                        yield pa.RecordBatch.from_arrays(
                            # 0 stands for no bucket further on
                            [pa.array((key | np.uint64(1)).view(np.int64)), pa.array(np.full(len(part), t)), pa.array(reps[part]), *(pa.array(signs[:, i]) for i in (0, 1))],
                            ["bucket", "at", "rep", "s0", "s1"],
                        )

    return run


def _near_others(s: np.ndarray, radius: int) -> np.ndarray:
    """Which sketches (n, 2) have another one within the radius."""
    out = np.zeros(len(s), bool)
    s = np.ascontiguousarray(s).view(np.uint64)  # the count of a negative number would be that of its magnitude
    for i in range(0, len(s), 256):
        apart = np.bitwise_count(s[i : i + 256, None, 0] ^ s[None, :, 0]) + np.bitwise_count(s[i : i + 256, None, 1] ^ s[None, :, 1])
        out[i : i + 256] = (apart <= radius).sum(1) > 1  # itself is one
    return out


def _retained(radius: int, big: int):
    """Rows sorted by bucket -> (bucket, at, rep) of those that may have a partner there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, size = None, [], 0  # the bucket that is being read; nothing is held of one of more than ``big`` rows
        out: list[np.ndarray] = []

        def closed() -> None:
            if 1 < size <= big:
                rows = np.concatenate(held)
                out.append(rows[_near_others(rows[:, 3:], radius), :3])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([batch.column(i).to_numpy() for i in range(5)])
            for part in np.split(rows, np.flatnonzero(np.diff(rows[:, 0])) + 1):
                if bucket != part[0, 0]:
                    closed()
                    bucket, held, size = part[0, 0], [], 0
                held.append(part)
                size += len(part)
                if size > big:
                    out.append(np.concatenate(held)[:, :3])
                    held = []
            if out:
                yield _columns(out)
                out.clear()
        closed()
        if out:
            yield _columns(out)

    return run


def _columns(parts: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate(parts)
    return pa.RecordBatch.from_arrays([pa.array(rows[:, i]) for i in range(3)], ["bucket", "at", "rep"])


def _forest(pairs_a: np.ndarray, pairs_b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the pairs."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    kept = []
    for a, b in zip(pairs_a.tolist(), pairs_b.tolist(), strict=True):
        x, y = top(a), top(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


_PIECE = ("bucket", "i", "j", "side", "at", "rep", "copies", "label", "unit", "others")


def _block_links(rows: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """One pair of blocks of a bucket: classes with links, their numbers of links, and a forest of the links."""
    ids, copies, side = (rows[c].to_numpy() for c in ("rep", "copies", "side"))
    at, own = int(rows["at"][0].as_py()), rows["i"][0].as_py() == rows["j"][0].as_py()
    units = [_unpacked(x) for x in rows["unit"].to_pylist()]
    names, labels = np.unique(np.array(rows["label"].to_pylist(), object).astype(str), return_inverse=True)
    before = np.zeros((len(ids), at), np.int64)  # the bucket of every earlier table that a row stayed in
    for n, others in enumerate(rows["others"].to_pylist()):
        for x in others:
            if x["at"] < at:
                before[n, x["at"]] = x["bucket"]
    counts = np.zeros(len(ids), np.int64)
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    dims = np.array([len(u) for u in units])
    for d, label in sorted(set(zip(dims.tolist(), labels.tolist(), strict=True))):
        some = (dims == d) & (labels == label)
        left = np.flatnonzero(some & (side == 0))
        right = left if own else np.flatnonzero(some & (side == 1))
        if not len(left) or not len(right):
            continue
        x = np.stack([units[n] for n in left])
        hit = x @ (x if own else np.stack([units[n] for n in right])).T >= threshold
        a, b = np.nonzero(np.triu(hit, 1) if own else hit)
        a, b = left[a], right[b]
        for t in range(at):  # a pair that shares an earlier bucket counts there
            new = (before[a, t] != before[b, t]) | (before[a, t] == 0)
            a, b = a[new], b[new]
        np.add.at(counts, a, copies[b])
        np.add.at(counts, b, copies[a])
        found_a.append(ids[a])
        found_b.append(ids[b])
    linked = np.flatnonzero(counts)
    return ids[linked], counts[linked], _forest(np.concatenate(found_a), np.concatenate(found_b))


def _compared(threshold: float):
    """Rows sorted by piece of work -> counts per class (a, null, links) and links of a forest (a, b, 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        piece = None

        def closed() -> pa.RecordBatch:
            ids, counts, kept = _block_links(pa.Table.from_batches(held), threshold)
            a = pa.array([*ids.tolist(), *(x for x, _ in kept)], pa.int64())
            b = pa.array([*[None] * len(ids), *(y for _, y in kept)], pa.int64())
            return pa.RecordBatch.from_arrays([a, b, pa.array([*counts.tolist(), *[0] * len(kept)], pa.int64())], ["a", "b", "links"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = [0, *(np.flatnonzero((np.diff(names, axis=0) != 0).any(1)) + 1).tolist(), batch.num_rows]
            for first, end in zip(cuts[:-1], cuts[1:], strict=True):
                now = tuple(names[first].tolist())
                if held and now != piece:
                    yield closed()
                    held = []
                piece = now
                held.append(batch.slice(first, end - first))
        if held:
            yield closed()

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93, width: float = WIDTH, seed: int = 7) -> DataFrame:
    """Links among rows of ``vectors`` (vec_id, embedding, label) with equal labels and cosine >= threshold.

    Returns vec_id, n_links, component_id, kept, one row per input row. Rows whose label is
    null or whose vector is null, empty, zero or holds null or non-finite parts have no
    links and are their own component; so have vectors of different lengths towards each
    other. Rows with an equal vec_id are one node and share links and component; a null
    vec_id stays null and is kept. An empty table gives an empty result; other columns are
    ignored. ``threshold`` must be positive.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    usable = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    members = written(usable.mapInArrow(_classed, "vec_id long, label string, unit binary, class binary"), "vectors")
    classes = written(
        members.groupBy("class").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("unit").alias("unit")
        ),
        "vector-classes",
    )
    # Post every class under each table's key, and set aside what has no near sketch in its bucket.
    sizes = classes.groupBy("label").agg(F.ceil(F.log2(F.count("*").cast("double"))).cast("int").alias("size_class"))
    sized = classes.join(sizes, "label").select("rep", "label", "unit", "size_class")
    posted = sized.mapInArrow(_posted(threshold, width, seed), "bucket long, at long, rep long, s0 long, s1 long")
    stayed = posted.repartition("bucket").sortWithinPartitions("bucket")
    stayed = written(stayed.mapInArrow(_retained(sketch_radius(threshold), BIG), "bucket long, at long, rep long"), "vector-posts")
    # Block i of a bucket meets blocks j >= i: on the left of (i, j), on the right of (j, i).
    held = stayed.groupBy("bucket").agg(F.count("*").alias("held"))
    met = stayed.join(held, "bucket").withColumn("blocks", F.ceil(F.col("held") / BLOCK).cast("int"))
    met = met.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    pieces = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j"), F.when(j < F.col("block"), 1).otherwise(0).alias("side")),
    )
    met = met.select("bucket", "at", "rep", F.explode(pieces).alias("piece")).select("bucket", "piece.*", "at", "rep")
    others = stayed.groupBy("rep").agg(F.collect_list(F.struct("at", "bucket")).alias("others"))  # one entry per table at most
    work = met.join(classes.join(others, "rep").select("rep", "copies", "label", "unit", "others"), "rep").select(*_PIECE)
    work = work.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    found = written(work.mapInArrow(_compared(threshold), "a long, b long, links long"), "vector-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    joined = components(found.where("b IS NOT NULL").select("a", "b"))
    discard(stayed)
    per_class = (
        classes.select("class", "rep", "copies")
        .join(counts, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "class",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    own = members.select("vec_id", "class").join(per_class, "class")
    # A vec_id that occurs once has one class; repeated ids take the sum and the smallest.
    per_id = own.groupBy("vec_id").agg(F.sum("links").alias("links"), F.min("component").alias("component"))
    return (
        rows.select("vec_id")
        .join(per_id, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )
