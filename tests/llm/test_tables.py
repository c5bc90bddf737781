"""Mixing, token rollups, sharding, vectors and near-duplicates against brute force."""

import hashlib
import itertools
import math
import random
import uuid
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitlake.llm import mixing, near_texts, sharding, token_rollup, vectors
from pitlake.llm.components import components


def find_components(edges):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    return {x: top(x) for x in list(root)}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(999, 999), (1000, 400)]
    df = spark.createDataFrame([*edges, (None, 5)], "a long, b long")
    want = find_components([e for e in edges if e[0] != e[1]])
    assert {r["node"]: r["component"] for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


# -- sharding -------------------------------------------------------------------------------


def test_shards_are_balanced_and_gapless(spark):
    rows = [(i, f"text {i % 50}" * (i % 7)) for i in range(1000)] + [(None, None), (None, "x"), (5, "text 5"), (5, "text 5")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cell", F.lit(1)).withColumn("shard", F.lit("a"))
    got = sharding.shard_documents(df).collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == 1004 and max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 16
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    assert sharding.shard_documents(df.limit(0)).count() == 0
    few = sharding.shard_documents(df.limit(3)).collect()
    assert len({r["shard"] for r in few}) == 3


def test_a_third_of_the_rows_under_one_id(spark):
    rows = [(7, "hot")] * 400 + [(None, "same")] * 400 + [(i, "x") for i in range(400)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == 1200 and set(sizes.values()) == {75}
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(75)) for s in sizes)


def test_overflow_walks_clockwise_and_little_moves():
    rng = random.Random(1)
    counts = Counter(rng.randrange(sharding.CELLS) for _ in range(20_000))
    nodes = sharding.ring(16, 64)
    home = {}
    for cell in counts:
        home[cell] = next((s for c, s in nodes if c >= cell), nodes[0][1])
    placed = sharding.place({(c, 0): n for c, n in counts.items()}, 16, 64)
    assert sum(b - a for _, _, a, b, _, _ in placed) == 20_000
    at_home = sum(b - a for cell, _, a, b, s, _ in placed if home[cell] == s)
    over = sum(max(0, n - 1250) for n in Counter({s: sum(counts[c] for c in counts if home[c] == s) for s in range(16)}).values())
    assert 20_000 - at_home == over  # only the overflow leaves its home


# -- token rollups --------------------------------------------------------------------------


def test_rollup_batches_are_additive_and_idempotent(spark, tmp_path):
    texts = ["a b c", "a b c", " tidy  me ", None, "", "x" * 3000]
    rows = [(i, t, "s" if i % 2 else None, "en") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("tokens", F.lit(1))
    counted = token_rollup.count_documents(docs)
    ledger = token_rollup.Ledger(spark, f"file://{tmp_path}/{uuid.uuid4().hex}")
    assert ledger.totals().count() == 0
    assert ledger.commit("1", token_rollup.changes(counted, 1)) and not ledger.commit("1", token_rollup.changes(counted, 1))
    coder = token_rollup._encoding(token_rollup.RANKS)
    bpe = lambda t: len(coder.encode_ordinary(t or ""))

    def totals():
        return {(r["source"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in ledger.totals().collect()}

    def want(kept):
        out = defaultdict(lambda: [0, 0])
        for i, t in kept:
            for name, n in ((token_rollup.WORDS, len((t or "").split())), (token_rollup.BPE, bpe(t))):
                out["s" if i % 2 else None, name][0] += 1
                out["s" if i % 2 else None, name][1] += n
        return {k: tuple(v) for k, v in out.items()}

    assert totals() == want(enumerate(texts))
    ledger.commit("2", token_rollup.revisions(counted))
    tidy = [(i, token_rollup.tidy(t or "")) for i, t in enumerate(texts)]
    assert totals() == want(tidy)
    ledger.commit("3", token_rollup.changes(token_rollup.later_copies(counted), -1, "revised_words", "revised_tokens"))
    assert totals() == want([x for x in tidy if x[0] not in (1, 4)])
    with pytest.raises(ValueError):
        ledger.commit("../x", token_rollup.changes(counted, 1))
    before = totals()
    assert ledger.compact() and not ledger.compact() and totals() == before
    assert ledger.prune() == 3 and totals() == before
    assert not ledger.commit("2", token_rollup.revisions(counted)) and totals() == before
    assert ledger.commit("4", token_rollup.changes(counted, 1)) and totals() != before
    assert ledger.commit("5", token_rollup.changes(counted, -1)) and ledger.compact() and totals() == before


def test_of_two_writers_of_a_batch_one_wins(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("s", "en", "t", 1, 5)], "source string, lang string, tokenizer string, sign int, tokens long")
    first, second = (token_rollup.Ledger(spark, f"file://{tmp_path}/one") for _ in range(2))
    monkeypatch.setattr(second, "committed", lambda _: False)  # it looked before the first one committed
    assert first.commit("b", rows) and not second.commit("b", rows)
    assert [tuple(r) for r in first.totals().collect()] == [("s", "en", "t", 1, 5)]
    assert len(first._names("data")) == 1


def test_later_copies_of_hot_and_other_texts(spark, monkeypatch):
    monkeypatch.setattr(token_rollup, "HOT", 10)
    rows = [(i, "hot") for i in range(30)] + [(100 + i, f"t{i // 2}") for i in range(40)] + [(None, "hot"), (0, "hot")]
    counted = spark.createDataFrame(rows, "doc_id long, key string").withColumn("first", F.lit(1)).drop("first")
    got = sorted(r["doc_id"] for r in token_rollup.later_copies(counted).collect())
    assert got == [*range(1, 30), *range(101, 140, 2)]


# -- mixing ---------------------------------------------------------------------------------


def fill(children, budget):
    """(weight, capacity) -> integer shares: proportional, capped, shortages to the siblings."""
    left = {i for i, (_, c) in enumerate(children) if c > 0}
    got = [0] * len(children)
    rest = min(budget, sum(c for _, c in children))
    while True:
        weight = sum(children[i][0] for i in left)
        full = [i for i in left if children[i][1] * weight <= rest * children[i][0]]
        if not full:
            break
        i = min(full, key=lambda k: children[k][1] / children[k][0])
        got[i] = children[i][1]
        rest -= got[i]
        left.remove(i)
    for i in left:
        got[i] = rest * children[i][0] / weight
    return got


def test_budgets_follow_weights_and_siblings_absorb_first(spark):
    leaves = [("A", "en", "s1", 100), ("A", "en", "s2", 10_000), ("A", "de", "s3", 10_000), ("B", "en", "s4", 50), ("B", "en", "s5", 60), ("C", "fr", "s6", 5_000)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long").withColumn("leaf", F.xxhash64("source"))
    weights = {"domain": {"A": 2, "B": 2, "C": 1}, "lang": {"en": 1, "de": 1, "fr": 1}, "source": {f"s{i}": 1 for i in range(1, 7)}}
    got = {r["source"]: r["budget"] for r in mixing.leaf_budgets(df, 5000, 2, weights).collect()}
    assert sum(got.values()) == 5000
    assert got["s4"] == 100 and got["s5"] == 120  # all that B has
    domains = fill([(2, 40_200), (2, 220), (1, 10_000)], 5000)
    assert got["s6"] == pytest.approx(domains[2], abs=1)
    assert got["s1"] == 200 and got["s2"] == pytest.approx(domains[0] / 2 - 200, abs=2)  # s2, not s3, makes up for s1


def test_weights_of_zero_and_of_paths(spark):
    leaves = [("A", "en", "s1", 100), ("A", "en", "s2", 100), ("A", "de", "s1", 100), ("B", "en", "s4", 100), ("C", None, "s5", 0)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long").withColumn("leaf", F.xxhash64("domain", "lang", "source"))
    weights = {"domain": {"A": 1, "B": 0}, "lang": {"en": 1, "de": 1}, "source": {"s1": 1, "s2": 1, ("A", "en", "s1"): 0}}
    got = {tuple(r)[1:4]: r["budget"] for r in mixing.leaf_budgets(df, 1000, 1, weights).collect()}
    assert got == {("A", "en", "s1"): 0, ("A", "en", "s2"): 100, ("A", "de", "s1"): 100, ("B", "en", "s4"): 0, ("C", None, "s5"): 0}
    none = {"domain": {"A": 0, "B": 0, "C": 0}}
    assert {r["budget"] for r in mixing.leaf_budgets(df, 1000, 1, none).collect()} == {0}
    with pytest.raises(ValueError):
        mixing.leaf_budgets(df, 10, 1, {"lang": {"en": -1}})
    docs = spark.createDataFrame([(1, "a b", "en", "s"), (2, "c", "de", "s")], "doc_id long, text string, lang string, source string")
    assert {r["taken"] for r in mixing.select_mixture(docs, weights={"source": {"s": 0}}).collect()} == {0}


def plain_selection(rows, share, epochs, seed, budgets):
    """taken per row: whole epochs, then tokens in the order of the last epoch's hash until the leaf's budget is spent."""
    out = {}
    for leaf, own in rows.items():
        tokens = sum(n for _, n, _ in own)
        full, rest = divmod(budgets[leaf], tokens) if tokens else (0, 0)
        order = sorted(own, key=lambda r: hashlib.md5(f"{seed}|{full}|{r[0]}|{r[2]}".encode()).hexdigest()[:15])
        for doc_id, n, _ in order:
            part = min(n, rest)
            rest -= part
            out[doc_id] = full * n + part
    return out


def test_selection_agrees_with_a_plain_one(spark):
    rng = random.Random(12)
    rows = [(i, "w " * rng.randrange(0, 30), rng.choice(["en", "de"]), f"src{rng.randrange(4)}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.select_mixture(df, budget_share=0.7, epochs=2, seed=5).collect()
    leaves, budgets = defaultdict(list), Counter()
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        leaf = (r["domain"], r["lang"], r["source"])
        leaves[leaf].append((r["doc_id"], r["n_tokens"], hashlib.md5(texts[r["doc_id"]].encode()).hexdigest()))
        budgets[leaf] += r["taken"]
    assert sum(budgets.values()) == math.floor(sum(len(t.split()) for t in texts.values()) * 0.7)
    assert {r["doc_id"]: r["taken"] for r in got} == plain_selection(leaves, 0.7, 2, 5, budgets)


def test_selection_takes_token_prefixes(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(0, 40), rng.choice(["en", "de", None]), f"src{rng.randrange(5)}" if i % 3 else "src0") for i in range(600)]
    rows += [(None, "w " * 50, "en", "src0"), (None, "v " * 50, "en", "src0"), (700, None, "en", "src1"), (701, "", "en", None), (702, "w " * 5000, "en", "src2"), (702, "w " * 5000, "en", "src2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("leaf", F.lit(1)).withColumn("_use", F.lit(2)).withColumn("__mixture__", F.lit("m"))
    got = mixing.select_mixture(df, budget_share=0.6, epochs=3).collect()
    total = sum(len((t or "").split()) for _, t, _, _ in rows)
    assert len(got) == len(rows)
    assert abs(sum(r["taken"] for r in got) - math.floor(total * 0.6)) <= 1
    by_leaf = defaultdict(list)
    for r in got:
        by_leaf[r["domain"], r["lang"], r["source"]].append(r)
    for group in by_leaf.values():
        assert len({r["full_epochs"] for r in group}) == 1
        partly = {r["doc_id"] for r in group if 0 < r["partial_tokens"] < r["n_tokens"]}
        assert len(partly) <= 1
    again = mixing.select_mixture(df, budget_share=0.6, epochs=3).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    used = mixing.mixed_documents(df, budget_share=0.6, epochs=3)
    assert used.columns == df.columns and {tuple(r) for r in used.select("_use", "__mixture__").collect()} == {(2, "m")}
    assert sum(len((r["text"] or "").split()) for r in used.collect()) == sum(r["taken"] for r in got)
    assert mixing.select_mixture(df.limit(0)).count() == 0


# -- vectors --------------------------------------------------------------------------------


def test_vectors_agree_with_all_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 64)).astype(np.float32)
    rows = []
    for i in range(300):
        noise = rng.standard_normal(64).astype(np.float32) * rng.choice([0.05, 0.2, 0.38])
        rows.append((i, (base[rng.integers(40)] + noise).tolist(), int(rng.integers(2))))
    rows += [(400 + i, rows[7][1], rows[7][2]) for i in range(5)]
    bad = [(500, None, 1), (501, [0.0] * 64, 1), (502, [float("nan")] * 64, 1), (503, [None] + [1.0] * 63, 1), (504, rows[7][1], None), (505, [], 0), (506, [1.0] * 3, 0), (507, [float("inf")] * 64, 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").withColumn("links", F.lit(0)).withColumn("rep", F.lit("x"))
    links, edges = Counter(), []
    for (i, x, a), (j, y, b) in itertools.combinations(rows, 2):
        x, y = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
        if a == b and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
            links.update((i, j))
            edges.append((i, j))
    want = find_components(edges)
    got = vectors.near_vectors(df).collect()
    assert len(got) == len(rows) + len(bad) and len(edges) > 100
    missed = sum(abs(links[r["vec_id"]] - r["n_links"]) for r in got) / 2
    assert missed <= 0.002 * len(edges)
    if not missed:
        assert all(r["component_id"] == want.get(r["vec_id"], r["vec_id"]) for r in got)
    assert all(r["n_links"] == 0 and r["kept"] for r in got if r["vec_id"] >= 500)
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_both_precisions_meet(spark):
    one = [float(i % 7 - 3) for i in range(32)]
    rows = [(1, one, 1), (2, [x + 1e-9 for x in one], 1), (3, one[:16], 1), (4, [0.1 + x for x in one[:16]], 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3)}


@pytest.mark.parametrize("size_class", [0, 5, 13, 20, 33])
def test_pairs_at_the_threshold_meet(size_class):
    projections, tables = vectors.plan(size_class, 0.93)
    assert vectors.meeting_probability(0.93, projections, tables=tables) >= 1 - vectors.MISS
    met = 2**size_class * vectors.meeting_probability(0.0, projections)
    assert met <= vectors.MET or projections == 2  # unrelated ones per bucket, at any size


def test_sketches_of_close_vectors_are_near():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((20_000, 32))
    y = rng.standard_normal((20_000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (x * y).sum(1)[:, None] * x
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * y / np.linalg.norm(y, axis=1)[:, None]
    planes = rng.standard_normal((32, vectors.SKETCH))
    apart = ((x @ planes > 0) != (y @ planes > 0)).sum(1)
    assert (apart > vectors.sketch_radius(0.93)).sum() <= 1


@pytest.mark.parametrize("big", [4, 8192])
def test_blocks_of_a_hot_bucket(spark, monkeypatch, big):
    monkeypatch.setattr(vectors, "BLOCK", 8)
    monkeypatch.setattr(vectors, "BIG", big)
    rng = np.random.default_rng(4)
    one = rng.standard_normal(16)
    rows = [(i, (one + rng.standard_normal(16) * 0.02).tolist(), 1) for i in range(60)] + [(100, one.tolist(), 2)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert Counter((r["n_links"], r["component_id"]) for r in got) == {(59, 0): 60, (0, 100): 1}


def test_recall_against_all_pairs_of_the_given_vectors(spark):
    """Every link among the vectors of sf0.1 and noisy copies of them, at cosines spread around the threshold."""
    rng = np.random.default_rng(6)
    rows = [(r["vec_id"], np.array(r["embedding"], np.float32), r["label"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    for i, x, label in rows[:1500]:
        unit = x / np.linalg.norm(x)
        noise = rng.standard_normal(len(x)) / math.sqrt(len(x))
        rows.append((100_000 + i, (unit + noise * rng.uniform(0.3, 0.45)).astype(np.float32), label))
    links, edges = Counter(), []
    for label in {r[2] for r in rows}:
        some = [r for r in rows if r[2] == label]
        x = np.stack([r[1] for r in some]).astype(float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.93, 1)), strict=True):
            links.update((some[a][0], some[b][0]))
            edges.append((some[a][0], some[b][0]))
    df = spark.createDataFrame([(i, x.tolist(), label) for i, x, label in rows], "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(df).collect()}
    missed = sum(links[i] - n for i, n in got.items()) / 2
    assert len(edges) > 500 and 0 <= missed <= 0.002 * len(edges)


# -- near texts -----------------------------------------------------------------------------


def corpus():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    texts = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randrange(30, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.randrange(8)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    texts += [" ".join(passage + [rng.choice(words) for _ in range(rng.randrange(2, 40))]) for _ in range(60)]
    texts += ["one two", "ONE  two", "one two three", "", None, "  ", "a b c d e f", "A b\tc d\ne f", "x" * 20_000, "w " * 20_000]
    return texts


def word_tuples(text):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    words = (text or "").encode("utf-8", "surrogatepass").translate(lower).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} - {()}


@pytest.mark.parametrize(("percent", "fine", "block"), [(85, True, 1024), (80, False, 8), (50, True, 1024)])
def test_near_texts_agree_with_all_pairs_of_word_tuples(spark, monkeypatch, percent, fine, block):
    monkeypatch.setattr(near_texts, "BLOCK", block)
    turns = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))  # its polynomial hash modulo 2**64 is its complement's
    other = turns.translate(str.maketrans("ab", "ba"))
    texts = [*corpus(), turns, other, f"w1 w2 {turns} w3 w4 w5", f"w1 w2 {other} w3 w4 w5", "one  two three\x0bfour five " * 3]
    sets = [word_tuples(t) for t in texts]
    edges = []
    for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            edges.append((i, j))
    want = find_components(edges)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("rep", F.lit(1)).withColumn("key", F.lit("k"))
    got = near_texts.near_texts(df, percent=percent, fine=fine).collect()
    assert len(got) == len(texts) and len(edges) > 30
    for r in got:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["component_id"] == want.get(r["doc_id"], r["doc_id"])
        assert r["kept"] == (r["component_id"] == r["doc_id"])


def test_collisions_follow_from_the_threshold():
    assert (near_texts.collisions(85), near_texts.collisions(80)) == (40, 36)
    with pytest.raises(ValueError):
        near_texts.collisions(5)


def test_near_texts_of_odd_tables(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "z")], "doc_id long, text string")
    got = near_texts.near_texts(df).collect()
    assert len(got) == 5 and all(r["kept"] for r in got)
    assert near_texts.near_texts(df.limit(0)).count() == 0
