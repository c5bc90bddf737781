"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

The distinct words of a batch of texts are joined into one index text. Its suffixes are
sorted to the depth of the longest piece by doubling ranks; every piece is looked up by
binary search, which gives the range of suffixes that begin with it; each occurrence is an
edge from its start to its end. Edges are sorted by their end and relaxed in that order:
an edge is taken if the piece that ends at its start and its own piece are what merging
would leave of both together. That holds for exactly one edge per end, so the result is
the merge result without merging.

Words are cut where a blank begins, which no piece spans, and wherever else no occurrence
of a piece spans two signs: what lies between is relaxed by itself. All short stretches are
relaxed together, one length after another; what goes on for more than ``LONG`` signs is
relaxed edge by edge. Characters without a piece fall
back to bytes. Runs of blanks are merged by themselves, as their pieces rank below all
others. Decoding joins pieces, turns blanks and bytes back, and drops the first blank.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import sparing

#: Where the public model lies; a parameter of every entry point.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"

BLANK, GAP = "▁", "\ud800"  # a lone surrogate cannot occur in a text
_NONE, _START = -1, -2
GROUP_CHARS, CACHED_WORDS, CACHED_PAIRS, LONG = 2_000_000, 300_000, 1_000_000, 64


@dataclass
class Vocabulary:
    """Pieces with scores; ``bytes_at`` is the id of byte 0."""

    pieces: list[str]
    scores: list[float]
    normal: list[bool]
    bytes_at: int

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        """Read a model file with byte fallback."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
        pieces = [model.id_to_piece(i) for i in range(n)]
        return cls(pieces, [model.get_score(i) for i in range(n)], plain, pieces.index("<0x00>"))


def merge(signs: list[str], score: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Plain BPE on a list of signs: best score first, leftmost of equals. Also the last pair merged."""
    parts, after, before = list(signs), list(range(1, len(signs) + 1)), list(range(-1, len(signs) - 1))
    queue: list[tuple[float, int, int, str]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(parts) and (s := score.get(parts[i] + parts[j])) is not None:
            heapq.heappush(queue, (-s, i, j, parts[i] + parts[j]))

    for i in range(len(parts)):
        offer(i)
    last = None
    while queue:
        _, i, j, both = heapq.heappop(queue)
        if not parts[i] or not parts[j] or parts[i] + parts[j] != both or after[i] != j:
            continue
        last = (parts[i], parts[j])
        parts[i], parts[j] = both, ""
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [p for p in parts if p], last


@dataclass
class Encoder:
    """Tables of a vocabulary for matching and relaxing; built once, sent to the workers."""

    vocabulary: Vocabulary
    ids: dict[str, int] = field(init=False)
    runs: dict[str, float] = field(init=False)

    def __post_init__(self) -> None:
        v = self.vocabulary
        n = len(v.pieces)
        self.ids = {p: i for i, p in enumerate(v.pieces) if v.normal[i]}
        self.runs = {p: v.scores[i] for p, i in self.ids.items() if len(p) > 1 and not p.strip(BLANK)}
        score = {p: v.scores[i] for p, i in self.ids.items() if len(p) > 1 and p not in self.runs}
        order = sorted(score, key=lambda p: (-score[p], self.ids[p]))
        self.rank = np.full(n, _NONE, np.int64)
        self.rank[[self.ids[p] for p in order]] = np.arange(len(order))
        self.left, self.right = np.full(n, _NONE, np.int64), np.full(n, _NONE, np.int64)
        usable = [p for p in self.ids if len(p) == 1]
        pairs, made = [], []
        for p in order:
            parts, last = merge(list(p), score)
            if len(parts) == 1 and last:  # else merging never makes it
                i = self.ids[p]
                self.left[i], self.right[i] = self.ids[last[0]], self.ids[last[1]]
                pairs.append(self.left[i] * n + self.right[i])
                made.append(self.rank[i])
                usable.append(p)
        at = np.argsort(pairs)
        self.pair_keys, self.pair_ranks = np.array(pairs, np.int64)[at], np.array(made, np.int64)[at]
        self.alphabet = np.array(sorted({ord(c) for p in usable for c in p}), np.uint32)
        self.bits = int(len(self.alphabet) + 2).bit_length()
        self.width = 63 // self.bits
        codes = {int(c): i + 2 for i, c in enumerate(self.alphabet)}  # 0 ends a key, 1 is any other sign
        usable.sort(key=len)
        self.usable = np.array([self.ids[p] for p in usable], np.int64)
        self.lengths = np.array([len(p) for p in usable], np.int64)
        self.doublings = max(1, math.ceil(math.log2(max(1, int(self.lengths.max(initial=1)) / self.width))))
        self.depth = self.width << self.doublings  # signs to which suffixes are sorted, no piece is longer
        self.piece_codes = np.zeros((len(usable), self.depth), np.int64)
        for row, p in enumerate(usable):
            self.piece_codes[row, : len(p)] = [codes[ord(c)] for c in p]
        self.bare = self.ids.get(BLANK, _NONE)
        texts = [p.replace(BLANK, " ").encode() if v.normal[i] else b"" for i, p in enumerate(v.pieces)]
        for b in range(256):
            texts[v.bytes_at + b] = bytes([b])
        self.text_lengths = np.array([len(t) for t in texts], np.int64)
        self.text_starts = np.concatenate([[0], np.cumsum(self.text_lengths)[:-1]])
        self.text_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self._pairs: dict[int, bool] = {}

    # -- matching ---------------------------------------------------------------------------

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, row of ``usable``) of every occurrence of every piece in a text of alphabet codes."""
        w, bits, n, deep = self.width, self.bits, len(codes), self.depth
        padded = np.concatenate([codes, np.zeros(deep, np.int64)])

        def packed(columns: list[np.ndarray]) -> np.ndarray:
            out = np.zeros_like(columns[0])
            for c in columns:
                out = (out << bits) | c
            return out

        # known[k] are the distinct keys of w * 2**k signs, ranks[i] that of the suffix at i; beyond the text all codes are 0.
        found, ranks = np.unique(packed([padded[i : n + deep - w + i] for i in range(w)]), return_inverse=True)
        known = [found]
        for k in range(self.doublings - 1):
            at = w << k
            found, ranks = np.unique(ranks[:-at] * len(known[k]) + ranks[at:], return_inverse=True)
            known.append(found)
        at = w << (self.doublings - 1)
        keys = ranks[:n] * len(known[-1]) + ranks[at : at + n]
        order = np.argsort(keys, kind="stable")
        known.append(keys[order])

        p, length = self.piece_codes, self.lengths

        def span(k: int, offset: int) -> tuple[np.ndarray, np.ndarray]:
            """Places among the keys of w * 2**k signs that begin with the piece's signs from ``offset`` on; all if it has none left."""
            if not k:
                part, held = p[:, offset : offset + w], np.clip(length - offset, 0, w)
                low = packed([part[:, i] for i in range(w)])
                high = low | ((1 << ((w - held) * bits).astype(np.int64)) - 1)
                return np.searchsorted(known[0], low, "left"), np.searchsorted(known[0], high, "right")
            half, m = w << (k - 1), len(known[k - 1])
            a, b = span(k - 1, offset)
            c, d = span(k - 1, offset + half)
            longer = length - offset > half
            low = np.where(longer, a * m + c, a * m)
            high = np.where(longer, np.where(b > a, a * m + d, low), b * m)
            return np.searchsorted(known[k], low, "left"), np.searchsorted(known[k], high, "left")

        low, high = span(self.doublings, 0)
        counts = np.maximum(high - low, 0)
        rows = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return order[np.repeat(low, counts) + within], rows

    # -- relaxing ---------------------------------------------------------------------------

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that a pair merges to; a large number if none."""
        key = left * len(self.rank) + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], np.iinfo(np.int64).max)

    def stays(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the signs of two pieces gives these two: their last merges are undone, latest first."""
        out = np.ones(len(left), bool)
        at = np.arange(len(left))
        limit = np.full(len(left), np.iinfo(np.int64).max)
        left, right = left.copy(), right.copy()
        while len(at):
            bad = self._merged(left, right) < limit
            out[at[bad]] = False
            rl, rr = self.rank[left], self.rank[right]
            go = ~bad & ((rl >= 0) | (rr >= 0))
            at, left, right, rl, rr = at[go], left[go], right[go], rl[go], rr[go]
            undo = rl > rr
            limit = np.where(undo, rl, rr + 1)
            left, right = np.where(undo, self.right[left], left), np.where(undo, right, self.left[right])
        return out

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, each with a blank before it, and the number of ids of each; signs without a piece as bytes."""
        points = np.frombuffer((BLANK + (GAP + BLANK).join(words) + GAP).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        codes = np.where(self.alphabet[at] == points, at + 2, 1).astype(np.int64)
        gaps = np.flatnonzero(points == ord(GAP))
        codes[gaps] = 0
        starts = np.concatenate([[0], gaps[:-1] + 1])
        start, row = self.edges(codes)
        other = np.flatnonzero(codes == 1)
        n = len(self.rank)
        piece = np.concatenate([self.usable[row], n + points[other].astype(np.int64)])
        start = np.concatenate([start, other])
        end = np.concatenate([start[: len(row)] + self.lengths[row], other + 1])
        last = self._relaxed(start, end, piece, len(points), starts)
        spans = np.concatenate([np.ones(0, np.int64), np.zeros(n, np.int64)])
        spans[self.usable] = self.lengths
        lengths = spans.tolist() if len(points) > LONG else []
        ids, owner, place = [], [], gaps.copy()
        alive = np.arange(len(words))
        for _ in range(LONG):
            if not len(alive):
                break
            found = last[place[alive]]
            ids.append(found)
            owner.append(alive)
            place[alive] -= np.where(found >= n, 1, spans[np.minimum(found, n - 1)])
            alive = alive[place[alive] > starts[alive]]
        for word in alive.tolist():  # what is left of long ones
            first, at, found = int(starts[word]), int(place[word] - starts[word]), []
            reached = last[first : first + at + 1].tolist()
            while at > 0:
                found.append(reached[at])
                at -= 1 if reached[at] >= n else lengths[reached[at]]
            ids.append(np.array(found, np.int64))
            owner.append(np.full(len(found), word))
        ids, owner = np.concatenate(ids)[::-1], np.concatenate(owner)[::-1]
        back = np.argsort(owner, kind="stable")
        return self._expanded(ids[back], owner[back], len(words))

    def _relaxed(self, start: np.ndarray, end: np.ndarray, piece: np.ndarray, size: int, words: np.ndarray) -> np.ndarray:
        """The last piece of what ends at each place; ids from ``len(rank)`` on are signs without a piece."""
        n = len(self.rank)
        spanned = np.zeros(size + 2, np.int64)
        wide = end - start > 1
        np.add.at(spanned, start[wide] + 1, 1)
        np.add.at(spanned, end[wide], -1)
        opens = np.cumsum(spanned)[: size + 1] == 0  # no piece goes on over this place
        opens[words] = True
        opened = np.maximum.accumulate(np.where(opens, np.arange(size + 1), 0))[:size]
        step = end - opened[start]
        last = np.full(size + 1, _NONE, np.int64)

        some = np.flatnonzero(step <= LONG)
        some = some[np.argsort(step[some].astype(np.uint8), kind="stable")]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(step[some], minlength=1))])
        for k in range(1, len(cuts) - 1):
            at = some[cuts[k] : cuts[k + 1]]
            if not len(at):
                continue
            good, own = opens[start[at]], piece[at]
            before = np.where(good, _START, last[start[at]])
            free = (before >= n) | ((own >= n) & (before >= 0))
            check = np.flatnonzero((before >= 0) & ~free)
            if len(check):
                good[check] = self._stays_kept(before[check], own[check])
            good |= free
            last[end[at[good]]] = own[good]

        rest = np.flatnonzero(step > LONG)
        rest = rest[np.argsort(end[rest], kind="stable")]
        if len(rest):
            self._one_by_one(start[rest], end[rest], piece[rest], last)
        return last

    def _one_by_one(self, start: np.ndarray, end: np.ndarray, piece: np.ndarray, last: np.ndarray) -> None:
        """The same for the edges of long stretches, in the order of their ends; an end takes one edge."""
        n, kept = len(self.rank), self._pairs
        first = int(start.min())
        reached = last[first : int(end.max()) + 1].tolist()
        for a, b, own in zip((start - first).tolist(), (end - first).tolist(), piece.tolist(), strict=True):
            before = reached[a]
            if before < 0 or reached[b] >= 0:
                continue
            if before < n and own < n:
                pair = before * n + own
                if (good := kept.get(pair)) is None:
                    if len(kept) >= CACHED_PAIRS:
                        kept.clear()
                    good = kept[pair] = bool(self.stays(np.array([before]), np.array([own]))[0])
                if not good:
                    continue
            reached[b] = own
        last[first : first + len(reached)] = reached

    def _stays_kept(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`stays` with remembered answers."""
        if not hasattr(self, "_keys"):
            self._keys, self._answers = np.full(1 << 21, -1, np.int64), np.zeros(1 << 21, bool)
        key = left * len(self.rank) + right
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)).astype(np.int64)
        out = self._answers[slot]
        new = np.flatnonzero(self._keys[slot] != key)
        if len(new):
            out[new] = self.stays(left[new], right[new])
            self._keys[slot[new]] = key[new]
            # Two new pairs may share a slot: the last written key and its answer must belong together.
            mine = self._keys[slot[new]] == key[new]
            self._answers[slot[new][mine]] = out[new][mine]
        return out

    def run(self, length: int) -> list[int]:
        """Ids of a run of blanks."""
        return [self.ids[p] for p in merge([BLANK] * length, self.runs)[0]]

    # -- whole texts ------------------------------------------------------------------------

    def _expanded(self, ids: np.ndarray, owner: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Signs without a piece replaced by their UTF-8 bytes; the number of ids of each word."""
        n = len(self.rank)
        odd = np.flatnonzero(ids >= n)
        if len(odd):
            points = ids[odd] - n
            size = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
            each = np.ones(len(ids), np.int64)
            each[odd] = size
            begin = (np.cumsum(each) - each)[odd]
            ids, owner = np.repeat(ids, each), np.repeat(owner, each)
            lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
            for k in range(4):  # byte k of every sign that has one
                some = np.flatnonzero(size > k)
                rest = points[some] >> (6 * (size[some] - 1 - k))
                value = np.where(size[some] == 1, rest, lead[size[some]] | rest) if k == 0 else 0x80 | (rest & 0x3F)
                ids[begin[some] + k] = value + self.vocabulary.bytes_at
        return ids.astype(np.int32), np.bincount(owner, minlength=words)

    def forget(self) -> None:
        """Drop all that was remembered of texts; the vocabulary's tables stay."""
        self._pairs.clear()
        for name in ("_index", "_flat", "_sizes", "_keys", "_answers"):
            self.__dict__.pop(name, None)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and the offsets at which each text's ids begin and end."""
        if not hasattr(self, "_index") or len(self._index) > CACHED_WORDS:
            self._index: dict[str, int] = {}
            self._flat, self._sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        index = self._index
        known = len(index)
        per_text, runs = [], []
        for text in texts:
            if BLANK in text:
                text = text.replace(BLANK, " ")
            parts = text.split(" ") if text else []
            if "" in parts:  # runs of blanks stand before a word, or at the end
                cut, length = [], 0
                for part in parts:
                    length += 1
                    if part:
                        cut.append(part if length == 1 else (length, part))
                        length = 0
                if length:
                    cut.append((length, ""))
                for x in cut:
                    if isinstance(x, tuple):
                        runs.append(x)
                        if x[1]:
                            index.setdefault(x[1], len(index))
                    else:
                        index.setdefault(x, len(index))
                per_text.append(cut)
            else:
                per_text.append([index.setdefault(p, len(index)) for p in parts])
        if len(index) > known:
            fresh = list(index)[known:]
            found, counts = self.words(fresh)
            self._flat = np.concatenate([self._flat, found])
            self._sizes = np.concatenate([self._sizes, counts])
        flat, sizes = self._flat, self._sizes
        begins = np.cumsum(sizes) - sizes
        special: dict[tuple[int, str], int] = {}
        if runs:
            more, more_sizes = [], []
            for length, word in set(runs):
                ids = flat[begins[index[word]] : begins[index[word]] + sizes[index[word]]] if word else np.zeros(0, np.int32)
                if word and ids[0] != self.bare:
                    own = [*self.run(length - 1), *ids.tolist()]
                else:
                    own = [*self.run(length), *ids[1:].tolist()]
                special[length, word] = len(sizes) + len(more)
                more.append(np.array(own, np.int32))
                more_sizes.append(len(own))
            flat = np.concatenate([flat, *more])
            sizes = np.concatenate([sizes, more_sizes])
            begins = np.cumsum(sizes) - sizes
        chosen = [
            [special[x] if isinstance(x, tuple) else index[x] if isinstance(x, str) else x for x in parts] for parts in per_text
        ] if runs else per_text
        words = np.array([i for parts in chosen for i in parts], np.int64)
        counts = np.array([len(parts) for parts in chosen], np.int64)
        each = sizes[words]
        total = np.concatenate([[0], np.cumsum(each)])
        gather = np.repeat(begins[words] - total[:-1], each) + np.arange(total[-1])
        ends = np.concatenate([[0], np.cumsum(counts)])
        return flat[gather], total[ends]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The texts of ids, as bytes."""
        each = self.text_lengths[ids]
        total = np.concatenate([[0], np.cumsum(each)])
        data = self.text_bytes[np.repeat(self.text_starts[ids] - total[:-1], each) + np.arange(total[-1])].tobytes()
        at = total[offsets]
        return [data[a + 1 : b] if b > a else b"" for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str = MODEL) -> Encoder:
    """The encoder of a model file, built once per process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(Vocabulary.load(path))
    return _ENCODERS[path]


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about GROUP_CHARS characters."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= GROUP_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip for every row of ``docs`` (doc_id, text).

    Null and empty texts have no ids. ``round_trip`` tells whether decoding the ids gives
    the text back; only a text that holds the blank sign U+2581 itself does not. Repeated
    rows are encoded alike; other columns are ignored. The model file must be readable on
    every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        try:
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for a, b in _groups(texts):
                    ids, offsets = coder.encode(texts[a:b])
                    back = coder.decode(ids, offsets)
                    same = [x == t.encode("utf-8") for x, t in zip(back, texts[a:b], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(a, b - a),
                            pa.array(np.diff(offsets), pa.int64()),
                            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                            pa.array(same, pa.bool_()),
                        ],
                        ["doc_id", "n_tokens", "ids", "round_trip"],
                    )
        finally:  # the worker and its encoder stay for later stages
            coder.forget()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(sparing(run), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id and text for every row of ``encoded`` (doc_id, ids); null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            lists = [x or [] for x in batch.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            ids = np.array([i for x in lists for i in x], np.int64)
            texts = [t.decode("utf-8", "replace") for t in coder.decode(ids, offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")
    return rows.mapInArrow(run, "doc_id long, text string")
