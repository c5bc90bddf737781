"""Mixing sources to target weights by hierarchical budgeting.

Leaves of the tree are (domain, language, source). A budget of tokens flows from the root
to the leaves: at each node the children get shares in proportion to their weights, but
none more than its subtree can supply, and what one child can't use goes to its siblings.
A subtree as a whole falls short only when all its leaves are spent, so shortages reach an
ancestor's siblings last. A leaf supplies its tokens once per epoch, ``epochs`` times.

A weight belongs to a node's name or, where one is given, to its path. A weight of 0 takes a
node and all below it out of the mixture, whatever falls short elsewhere.

Shares are computed with integers only, by windows over the tree's nodes (as many rows as
there are leaves): children are taken by capacity over weight, the saturated ones form a
prefix, the others share the rest; single tokens left by rounding go to the first ones.

A leaf's budget is met by whole epochs and a token prefix of one more epoch, whose order
is a seeded hash. The prefix is found by two rounds of counting tokens per bucket of that
hash, so only documents of one bucket in a million are ever ranked in one task, however
large a leaf is. All of it is DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitlake.llm.common import discard, written

LEVELS = ("domain", "lang", "source")
BITS = 10  # of each of two levels of hash buckets
_WIDE = "decimal(38,0)"

#: level -> name, or path from the first level on, -> weight
Weights = dict[str, dict[str | tuple[str, ...], int]]


def _number(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of a text's MD5 as a number: a hash that SQL engines share."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def token_count(text: Column) -> Column:
    """Number of blank-separated words, natively."""
    clean = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D\x20]+", " "))
    return F.when(clean == "", 0).otherwise(F.length(clean) - F.length(F.replace(clean, F.lit(" "), F.lit(""))) + 1).cast("long")


def domain_of(source: Column, domains: int = 4) -> Column:
    """The default first level: sources dealt to ``domains`` domains by a hash of their names."""
    return F.concat(F.lit("domain"), (_number(F.coalesce(source, F.lit("")), 8) % domains).cast("string"))


def default_weight(level: str, value: Column) -> Column:
    """Integer weights 1 to 4 by a hash of the node's name, where none are given."""
    return _number(F.concat(F.lit(level + ":"), F.coalesce(value, F.lit(""))), 8) % 4 + 1


def _weight(level: str, weights: Weights) -> Column:
    """The weight of a node: that of its path, else of its name, else the default."""
    chosen = default_weight(level, F.col(level))
    given = weights.get(level, {})
    for name, value in sorted(given.items(), key=lambda x: isinstance(x[0], tuple)):
        if value < 0:
            raise ValueError(f"{level} {name}: a weight can't be negative")
        path = name if isinstance(name, tuple) else (name,)
        levels = LEVELS[: len(path)] if isinstance(name, tuple) else (level,)
        if levels[-1] != level:
            raise ValueError(f"{name} is no path to a {level}")
        hit = F.lit(True)
        for c, one in zip(levels, path, strict=True):
            hit = hit & F.col(c).eqNullSafe(one)
        chosen = F.when(hit, F.lit(int(value)).cast("long")).otherwise(chosen)
    return chosen


def _shared_out(nodes: DataFrame, parent: list[str], own: str) -> DataFrame:
    """nodes (parent columns, own, weight, capacity, given) -> with ``budget``, at most capacity.

    ``given`` is the parent's budget, the same for all its children.
    """
    group = [F.col(c) for c in parent] or [F.lit(0)]
    # Nodes without weight have no capacity, so they come first and get nothing.
    order = [F.coalesce(F.try_divide(F.col("capacity").cast("double"), "weight"), F.lit(0.0)).asc(), F.col(own).asc_nulls_first()]
    upto = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    nodes = (
        nodes.withColumn("_left", (F.col("given") - F.sum("capacity").over(upto) + F.col("capacity")).cast(_WIDE))
        .withColumn("_weights", F.sum("weight").over(after).cast(_WIDE))
        .withColumn("_full", F.col("capacity").cast(_WIDE) * F.col("_weights") <= F.col("_left") * F.col("weight").cast(_WIDE))
    )
    # A child is saturated if it is full and all before it are; the others share what those leave.
    all_full = F.min(F.col("_full").cast("int")).over(upto) == 1
    nodes = nodes.withColumn("_full", all_full)
    everyone = Window.partitionBy(*group)
    nodes = nodes.withColumn(
        "_rest", (F.col("given") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(everyone), F.lit(0))).cast("long")
    ).withColumn("_open", F.coalesce(F.sum(F.when(~F.col("_full"), F.col("weight"))).over(everyone), F.lit(0)))
    share = F.expr(f"cast(_rest as {_WIDE}) * cast(weight as {_WIDE}) div cast(nullif(_open, 0) as {_WIDE})").cast("long")
    nodes = nodes.withColumn("_share", F.when(F.col("_full"), F.col("capacity")).otherwise(share))
    spare = F.col("given") - F.sum("_share").over(everyone)
    room = Window.partitionBy(*group).orderBy(F.col("_full").cast("int"), (F.col("_share") >= F.col("capacity")).cast("int"), F.col(own).asc_nulls_first())
    extra = (F.row_number().over(room) <= spare) & ~F.col("_full") & (F.col("_share") < F.col("capacity"))
    return nodes.withColumn("_spare", extra).withColumn("budget", F.col("_share") + F.col("_spare").cast("long")).drop(
        "_left", "_weights", "_full", "_rest", "_open", "_share", "_spare"
    )


def leaf_budgets(leaves: DataFrame, budget: int, epochs: int, weights: Weights | None = None) -> DataFrame:
    """leaves (leaf, domain, lang, source, tokens) -> with ``budget``; the root's budget is cut to what there is.

    Only one number, the capacity of the whole tree, reaches the driver.
    """
    weights = weights or {}
    some = F.lit(True)
    for level in LEVELS:
        some = some & (_weight(level, weights) > 0)
    tree = leaves.withColumn("capacity", F.when(some, F.col("tokens") * epochs).otherwise(0).cast("long"))
    most = tree.agg(F.sum("capacity").alias("n")).first()["n"] or 0
    given = tree.withColumn("given", F.lit(min(budget, most)).cast("long"))
    for depth, level in enumerate(LEVELS):
        keys = list(LEVELS[: depth + 1])
        nodes = given.groupBy(*keys).agg(F.sum("capacity").alias("capacity"), F.min("given").alias("given"))
        nodes = _shared_out(nodes.withColumn("weight", _weight(level, weights)), keys[:-1], level)
        nodes = nodes.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("budget").alias("_budget"))
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        hit = same[0]
        for more in same[1:]:
            hit = hit & more
        given = given.join(nodes, hit).withColumn("given", F.col("_budget")).drop("_budget", *[f"_{k}" for k in keys])
    return given.select("leaf", *LEVELS, "tokens", F.col("given").alias("budget"))


def _cut(rows: DataFrame, bucket: str, prior: str) -> DataFrame:
    """leaf, bucket -> the bucket in which the leaf's rest is used up, and the rest at its start."""
    sums = rows.groupBy("leaf", bucket).agg(F.sum("n_tokens").alias("n"), F.min(prior).alias("rest"))
    running = Window.partitionBy("leaf").orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("upto", F.sum("n").over(running))
    inside = (F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("n") < F.col("rest"))
    return sums.where(inside).select("leaf", F.col(bucket).alias(f"cut_{bucket}"), (F.col("rest") - F.col("upto") + F.col("n")).alias(f"rest_{bucket}"))


def _needed(lang: Column, source: Column, doc_id: Column, text: Column) -> Column:
    """What the mixture needs of a row."""
    lang, source = lang.cast("string"), source.cast("string")
    leaf = F.xxhash64(domain_of(source), F.coalesce(lang, F.lit("\0")), F.coalesce(source, F.lit("\0")))
    return F.struct(
        doc_id.cast("long").alias("doc_id"), domain_of(source).alias("domain"), lang.alias("lang"), source.alias("source"),
        token_count(text).alias("n_tokens"), F.md5(F.coalesce(text, F.lit(""))).alias("digest"), leaf.alias("leaf"),
    )


def _needed_of(docs: DataFrame) -> DataFrame:
    return docs.select(_needed(F.col("lang"), F.col("source"), F.col("doc_id"), F.col("text")).alias("m")).select("m.*")


def _spotted(rows: DataFrame, seed: int) -> DataFrame:
    """rows with full_epochs -> their place in the order of the leaf's last epoch, and its two bucket numbers."""
    name = F.concat_ws("|", F.lit(seed).cast("string"), F.col("full_epochs").cast("string"), F.col("doc_id").cast("string"), F.col("digest"))
    rows = rows.withColumn("spot", _number(name, 15))
    return rows.withColumns(
        {
            "b1": F.shiftright("spot", 60 - BITS).cast("int"),
            "b2": F.shiftright("spot", 60 - 2 * BITS).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"),
        }
    )


def plan_mixture(
    docs: DataFrame, budget_share: float = 0.8, epochs: int = 4, seed: int = 11, weights: Weights | None = None
) -> tuple[DataFrame, DataFrame]:
    """What a mixture takes: a row per leaf (epochs and cuts), and the documents at the cuts with their partial tokens."""
    base = written(_needed_of(docs), "mixture-base")
    leaves = written(base.groupBy("leaf", *LEVELS).agg(F.sum("n_tokens").alias("tokens")), "mixture-leaves")
    total = leaves.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    budgets = leaf_budgets(leaves, math.floor(total * budget_share), epochs, weights)
    budgets = written(
        budgets.select(
            "leaf",
            F.expr("coalesce((budget - budget % nullif(tokens, 0)) div nullif(tokens, 0), 0)").cast("long").alias("full_epochs"),
            F.expr("coalesce(budget % nullif(tokens, 0), 0)").cast("long").alias("rest"),
        ),
        "mixture-budgets",
    )
    rows = _spotted(base.join(budgets.where("rest > 0"), "leaf"), seed)
    first = written(_cut(rows, "b1", "rest"), "mixture-cut")
    rows = rows.join(first, "leaf").where("b1 = cut_b1")
    second = written(_cut(rows, "b2", "rest_b1"), "mixture-cut")
    rows = rows.join(second, "leaf").where("b2 = cut_b2")
    # Rows equal in doc_id and text share what is left for them alike.
    alike = rows.groupBy("leaf", "spot", "doc_id", "digest").agg(
        F.count("*").alias("k"), F.min("n_tokens").alias("n_tokens"), F.min("rest_b2").alias("rest_b2")
    )
    in_order = Window.partitionBy("leaf").orderBy("spot", "doc_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    prior = F.coalesce(F.sum(F.col("n_tokens") * F.col("k")).over(in_order), F.lit(0))
    fair = F.floor((F.col("rest_b2") - prior) / F.col("k"))
    edge = alike.select(
        F.col("leaf").alias("_leaf"), F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest"),
        F.greatest(F.lit(0), F.least(F.col("n_tokens"), fair)).cast("long").alias("_partial"),
    )
    plan = budgets.join(first, "leaf", "left").join(second, "leaf", "left")
    plan = plan.select(F.col("leaf").alias("_leaf"), "full_epochs", "rest", "cut_b1", "cut_b2")
    plan, edge = written(plan, "mixture-plan"), written(edge, "mixture-edge")
    for done in (base, leaves, budgets, first, second):
        discard(done)
    return plan, edge


def decide(rows: DataFrame, plan: DataFrame, edge: DataFrame, seed: int) -> DataFrame:
    """rows (with doc_id, digest, leaf, n_tokens) -> with full_epochs and partial_tokens."""
    rows = _spotted(rows.join(plan, rows["leaf"] == plan["_leaf"]).drop("_leaf"), seed)
    hit = (rows["leaf"] == edge["_leaf"]) & rows["doc_id"].eqNullSafe(edge["_doc_id"]) & (rows["digest"] == edge["_digest"])
    rows = rows.join(edge, hit, "left")
    before = (F.col("b1") < F.col("cut_b1")) | ((F.col("b1") == F.col("cut_b1")) & (F.col("b2") < F.col("cut_b2")))
    partial = F.when(F.col("_partial").isNotNull(), F.col("_partial")).when(before, F.col("n_tokens")).otherwise(F.lit(0))
    return rows.withColumn("partial_tokens", partial.cast("long")).drop(
        "_leaf", "_doc_id", "_digest", "_partial", "cut_b1", "cut_b2", "rest", "spot", "b1", "b2"
    )


def select_mixture(
    docs: DataFrame, budget_share: float = 0.8, epochs: int = 4, seed: int = 11, weights: Weights | None = None
) -> DataFrame:
    """Which documents, how often and how much of each, make up the mixture.

    ``docs`` has doc_id, text, lang, source. The root's budget is ``budget_share`` of all
    tokens. Returns one row per row: doc_id, domain, lang, source, n_tokens, full_epochs
    (times the whole text is used), partial_tokens (tokens of one more, partial use;
    n_tokens where the last epoch uses it whole) and taken (tokens used in all).

    A null lang or source is a node of its own. Null, empty and blank texts have no tokens.
    Rows with equal doc_id (null or not) and text at a cut share what is left for them
    equally. A node of weight 0 gives nothing; where all weights are 0, nothing is taken.
    An empty table gives an empty result. Other columns are ignored.
    """
    plan, edge = plan_mixture(docs, budget_share, epochs, seed, weights)
    rows = decide(_needed_of(docs), plan, edge, seed)
    taken = F.col("full_epochs") * F.col("n_tokens") + F.col("partial_tokens")
    return rows.select("doc_id", *LEVELS, "n_tokens", "full_epochs", "partial_tokens", taken.alias("taken"))


def mixed_documents(
    docs: DataFrame, budget_share: float = 0.8, epochs: int = 4, seed: int = 11, weights: Weights | None = None
) -> DataFrame:
    """The mixture itself, with all columns of ``docs``, whatever their names: a row per use of a document.

    A partly used document's text is its first words, joined by blanks; its n_chars, where
    there is such a column, is that text's. Documents without tokens are in no mixture.
    Nulls, repeated rows and empty tables are treated as by :func:`select_mixture`.
    """
    plan, edge = plan_mixture(docs, budget_share, epochs, seed, weights)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        _needed(F.col("lang"), F.col("source"), F.col("doc_id"), F.col("text")).alias("m"),
    ).select("row", "m.*")
    rows = decide(rows, plan, edge, seed)
    whole = (F.col("full_epochs") + ((F.col("partial_tokens") == F.col("n_tokens")) & (F.col("n_tokens") > 0)).cast("int")).cast("int")
    part = F.when(F.col("partial_tokens") < F.col("n_tokens"), F.col("partial_tokens")).otherwise(F.lit(0)).cast("int")
    uses = F.concat(F.array_repeat(F.lit(0), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    rows = rows.where((F.col("n_tokens") > 0) & ((whole > 0) | (part > 0))).select("row", F.explode(uses).alias("use"))
    words = F.split(F.trim(F.regexp_replace("row.text", r"[\x09-\x0D\x20]+", " ")), " ")
    cut = F.array_join(F.slice(words, 1, F.greatest(F.col("use"), F.lit(1))), " ")
    rows = rows.select("row", F.when(F.col("use") > 0, cut).otherwise(F.col("row.text")).alias("text"))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[v.alias(k) for k, v in columns.items()])
