"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

Templates are cut into shingles of five words; one of fewer words is a single shingle of its
own word count, looked for among the shingles of that count (``width``). Templates of equal
width and similar length form a class; a class's windows span twice as many shingles as its longest template and start at every
half, so any occurrence lies whole in some window, and its similarity to that window is at
least ``containment / 4``. Every band is one MinHash value: with ``BANDS`` bands a template
that is there shares a band with its window with probability ``1 - (1 - s) ** BANDS``, above
0.9999 at ``s = 0.2`` (:func:`band_probability`). Windows that share a band with a template
are candidates; a candidate counts if the window holds at least ``containment`` of the
template's shingles.

Up to ``MOST_TEMPLATES`` templates travel as constants, so nothing is shuffled at all. A window
that holds fewer shingles of any of them than a match needs is then dropped before it is
signed, which no match survives either way: this keeps the signing cost to a fraction of the
corpus. More templates, or a table of them, are joined by bands instead (:func:`_joined`);
every window is signed then, and the planner decides by size whether to broadcast.
All of it is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import written
from pitlake.llm.notices import TEMPLATES

WORDS, BANDS, CONTAINMENT, MOST_TEMPLATES = 5, 48, 0.8, 500


def band_probability(similarity: float, bands: int = BANDS) -> float:
    """Probability that two sets share at least one of ``bands`` single-value bands."""
    return 1 - (1 - similarity) ** bands


def words_of(text: Column) -> Column:
    """Lower-case words, signs other than letters, digits and points between digits taken as blanks."""
    plain = F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}.]+|\.(?![0-9])", " "))
    return F.filter(F.split(plain, " +"), lambda w: w != "")


def shingles_of(words: Column, width: int = WORDS) -> Column:
    """Hashes of the runs of ``width`` words, in order; a shorter sequence is one shingle, none without words.

    ``words`` must be a column of its own: an expression would be evaluated again for every run.
    """
    n = F.size(words)
    at = F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1)))
    whole = F.transform(at, lambda i: F.xxhash64(F.array_join(F.slice(words, i, width), " ")))
    return F.when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))


def signature(shingles: Column, bands: int = BANDS) -> Column:
    """MinHash values, one per band; hashing the band in keeps the values of different bands apart."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda b: F.xxhash64(b, F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, b)))),
    )


def _cut(rows: DataFrame, bands: int, containment: float) -> DataFrame:
    """(template, notice) -> template, words, words per shingle, own shingles, signature, half a window, shingles needed."""
    rows = rows.select("template", words_of(F.coalesce("notice", F.lit(""))).alias("words")).where(F.size("words") > 0)
    rows = rows.select("template", "words", F.least(F.size("words"), F.lit(WORDS)).alias("width"), shingles_of(F.col("words")).alias("h"))
    rows = rows.select("template", "words", "width", F.array_distinct("h").alias("own"))
    # The least power of two that is not below the template's size.
    half = F.when(F.size("own") == 1, 1).otherwise(F.pow(F.lit(2.0), F.length(F.bin((F.size("own") - 1).cast("long")))).cast("int"))
    return rows.select("*", signature(F.col("own"), bands).alias("lows"), half.alias("half"), F.ceil(F.size("own") * containment - 1e-9).cast("int").alias("need"))


class _Class:
    """Templates of equal width and half a window, as an array constant."""

    def __init__(self, rows: list) -> None:
        self.width, self.half = rows[0]["width"], rows[0]["half"]
        self.wanted = sorted({h for r in rows for h in r["own"]})
        self.least = min(r["need"] for r in rows)
        self.words = {tuple(r["words"]) for r in rows}
        self.notices = F.array(
            *[
                F.struct(F.lit(r["template"]).alias("template"), F.lit(r["own"]).alias("own"), F.lit(r["lows"]).alias("lows"), F.lit(r["need"]).alias("need"))
                for r in rows
            ]
        )


def _may_hold(notices: set[tuple[str, ...]]) -> Column:
    """Whether all words of some notice occur; where they don't, no run of them does."""
    whole = [reduce(and_, [F.array_contains("words", w) for w in sorted(set(n))]) for n in sorted(notices)]
    return reduce(or_, whole)


def _found(known: _Class, bands: int) -> Column:
    """Templates of one class in the windows [k * half, (k + 2) * half) that hold enough of its shingles."""
    h, half = F.col(f"h{known.width}"), known.half
    first = lambda i: F.floor(i / half).cast("int")

    def windows(marks: Column) -> Column:
        starts = F.array_distinct(F.flatten(F.transform(marks, lambda i: F.array(first(i), F.greatest(first(i) - 1, F.lit(0))))))
        inside = lambda s: F.size(F.filter(marks, lambda i: (i >= s * half) & (i < (s + 2) * half)))
        starts = F.filter(starts, lambda s: inside(s) >= known.least)
        return F.transform(starts, lambda s: F.array_distinct(F.slice(h, s * half + 1, 2 * half)))

    marks = F.filter(f"marks{known.width}", lambda i: F.get(h, i).isin(known.wanted))
    signed = F.transform(F.flatten(F.transform(F.array(marks), windows)), lambda w: F.struct(w.alias("w"), signature(w, bands).alias("lows")))

    def held(window: Column, notice: Column) -> Column:
        return F.size(F.array_intersect(window, notice["own"]))

    def matches(x: Column) -> Column:
        some = F.filter(known.notices, lambda t: F.arrays_overlap(x["lows"], t["lows"]) & (held(x["w"], t) >= t["need"]))
        return F.transform(some, lambda t: F.struct(t["template"].alias("template"), (held(x["w"], t) / F.size(t["own"])).alias("part")))

    return F.flatten(F.transform(signed, matches))


def _words(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.coalesce("text", F.lit(""))).alias("words"))


def _constant(docs: DataFrame, classes: list[_Class], bands: int) -> DataFrame:
    """doc_id and what was found, with the templates as constants: one map over the documents."""
    widths = sorted({c.width for c in classes})

    def hashes(width: int) -> Column:
        every = shingles_of(F.col("words"), width)
        # Few rows hold all words of a short notice; the others need no second set of hashes.
        short = {w for c in classes if c.width == width for w in c.words}
        return F.when(_may_hold(short), every).otherwise(F.array().cast("array<bigint>")) if width < WORDS else every

    def marks(width: int) -> Column:
        wanted = sorted({h for c in classes if c.width == width for h in c.wanted})
        return F.filter(F.transform(f"h{width}", lambda x, i: F.when(x.isin(wanted), i)), lambda i: i.isNotNull())

    rows = _words(docs).select("doc_id", *[hashes(w).alias(f"h{w}") for w in widths])
    rows = rows.select("*", *[marks(w).alias(f"marks{w}") for w in widths])
    none = F.array().cast("array<struct<template:string,part:double>>")
    found = [F.when(F.size(f"marks{c.width}") > 0, _found(c, bands)).otherwise(none) for c in classes]
    return rows.select("doc_id", F.concat(none, *found).alias("found"))


def _joined(docs: DataFrame, known: DataFrame, bands: int) -> DataFrame:
    """doc_id and what was found, with windows and templates joined by bands; for template tables of any size."""
    known = written(known.drop("words"), "templates")
    # At most WORDS widths times the powers of two up to the longest template.
    classes = [(r["width"], r["half"]) for r in known.select("width", "half").distinct().collect()]
    rows = written(_words(docs).withColumn("row", F.monotonically_increasing_id()), "license-words")
    none = rows.select("row", "doc_id", F.array().cast("array<struct<template:string,part:double>>").alias("found"))
    if not classes:
        return none.select("doc_id", "found")

    def windows(width: int, half: int) -> DataFrame:
        hashed = rows.where(F.size("words") > 0).select("row", shingles_of(F.col("words"), width).alias("h"))
        starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size("h") / half).cast("int") - 2, F.lit(0)))
        cut = F.transform(starts, lambda s: F.array_distinct(F.slice("h", s * half + 1, 2 * half)))
        return hashed.select("row", F.lit(width).alias("width"), F.lit(half).alias("half"), F.posexplode(cut).alias("k", "w"))

    every = reduce(DataFrame.unionByName, [windows(*c) for c in classes])
    posted = every.select("row", "width", "half", "k", F.explode(signature(F.col("w"), bands)).alias("band"))
    bands_of = known.select("template", "width", "half", F.explode("lows").alias("band"))
    met = posted.join(bands_of, ["width", "half", "band"]).select("row", "width", "half", "k", "template").distinct()
    held = F.size(F.array_intersect("w", "own"))
    hits = every.join(met, ["row", "width", "half", "k"]).join(known.select("template", "width", "half", "own", "need"), ["template", "width", "half"])
    hits = hits.select("row", "template", "need", held.alias("held"), F.size("own").alias("size")).where("held >= need")
    hits = hits.groupBy("row", "template").agg(F.max(F.col("held") / F.col("size")).alias("part"))
    hits = hits.groupBy("row").agg(F.collect_list(F.struct("template", "part")).alias("hit"))
    return none.join(hits, "row", "left").select("doc_id", F.coalesce("hit", "found").alias("found"))


def scan_licenses(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] | DataFrame = TEMPLATES, containment: float = CONTAINMENT, bands: int = BANDS
) -> DataFrame:
    """Templates found in every row of ``docs`` (doc_id, text).

    ``templates`` are (name, notice) pairs or a table (template, notice) of any size.
    Returns doc_id, n_licenses, licenses (template names, sorted, distinct) and best (the
    highest containment, null where nothing was found), one row per input row, also for
    repeated rows and null doc_ids. Null, empty and very long texts are scanned like any
    other; notices without words, and no templates, find nothing. Other columns are ignored.
    """
    spark = docs.sparkSession
    if isinstance(templates, DataFrame):
        found = _joined(docs, _cut(templates.select("template", "notice"), bands, containment), bands)
    else:
        known = _cut(spark.createDataFrame(list(templates), "template string, notice string"), bands, containment)
        if len(templates) > MOST_TEMPLATES:
            found = _joined(docs, known, bands)
        else:
            groups: dict[tuple[int, int], list] = {}
            for r in known.collect():  # bounded by MOST_TEMPLATES
                groups.setdefault((r["width"], r["half"]), []).append(r)
            found = _constant(docs, [_Class(rows) for _, rows in sorted(groups.items())], bands)
    names = F.array_sort(F.array_distinct(F.transform("found", lambda f: f["template"])))
    return found.select(
        "doc_id",
        F.size(names).cast("long").alias("n_licenses"),
        F.array_join(names, ",").alias("licenses"),
        F.array_max(F.transform("found", lambda f: f["part"])).alias("best"),
    )
