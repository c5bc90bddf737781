"""Token counts as delta-maintained rollups.

A ledger holds additive totals of documents and tokens by source, language and tokenizer
version. A batch is a table of signed changes: +1 inserts a document's count, -1 deletes
it, a revision is both. A batch is aggregated before anything is stored. Its data go into a
folder of their own first; what commits it is a small file under its id, created last and
only if there is none, which names that folder. Nothing is renamed, and of two writers of
one id the first to create the file wins. Committing an id again changes nothing, so a job
that died between computing and recording can simply be run again. That takes a store that
can create a file only if it is absent, as HDFS, local disks and most object stores do.

Totals are the sum over committed batches. :meth:`Ledger.compact` adds those up into a base,
so that totals read one folder and the batches since; ids stay known.

Counts per document are made by an Arrow map; sums are partial aggregates, so a source
that holds a third of all rows costs one row per task in the shuffle.
"""

from __future__ import annotations

import base64
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.common import written

#: Where the public vocabulary lies, and its name in the totals; parameters of the entry points.
RANKS, BPE = "/opt/tokenizers/byte_bpe_50k.tiktoken", "byte_bpe_50k"
WORDS = "words_1"

#: A text is hot that makes up more than one in so many rows.
HOT = 1000

KEYS = ("source", "lang", "tokenizer")
_DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

_ENCODINGS: dict[str, object] = {}


def _encoding(path: str):
    """The byte-level encoding of a rank file, built once per process."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def count_words(text: str | None) -> int:
    """Number of words between white space."""
    return len((text or "").split())


def tidy(text: str) -> str:
    """The text a revision counts: runs of blanks and tabs made one blank, none at the ends of the text."""
    return re.sub(r"[ \t]{2,}|\t", " ", text).strip(" ")


def count_documents(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id, source, lang, key, words, tokens, revised_words, revised_tokens per row of ``docs``.

    ``key`` is the MD5 of the text. The revised counts are those of :func:`tidy`. Null texts
    count as empty (no tokens); null sources and languages stay null and form groups of
    their own; rows that repeat are each counted; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoding(path)
        for batch in batches:
            counts: list[tuple[int, int, int, int]] = []
            for text in batch.column(4).to_pylist():
                text = text or ""
                own = (count_words(text), len(coder.encode_ordinary(text)))
                better = tidy(text)
                counts.append((*own, *(own if better == text else (count_words(better), len(coder.encode_ordinary(better))))))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), *columns],
                ["doc_id", "source", "lang", "key", "words", "tokens", "revised_words", "revised_tokens"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.md5(F.coalesce("text", F.lit(""))).alias("key"),
        "text",
    )
    return rows.mapInArrow(
        run, "doc_id long, source string, lang string, key string, words long, tokens long, revised_words long, revised_tokens long"
    )


def changes(counted: DataFrame, sign: int, words: str = "words", tokens: str = "tokens") -> DataFrame:
    """Signed changes (source, lang, tokenizer, sign, tokens) for both tokenizer versions of counted documents."""
    both = F.array(
        F.struct(F.lit(WORDS).alias("tokenizer"), F.col(words).alias("n")), F.struct(F.lit(BPE).alias("tokenizer"), F.col(tokens).alias("n"))
    )
    return counted.select("source", "lang", F.explode(both).alias("one")).select(
        "source", "lang", F.col("one.tokenizer").alias("tokenizer"), F.lit(sign).alias("sign"), F.col("one.n").alias("tokens")
    )


def revisions(counted: DataFrame) -> DataFrame:
    """What a revision of the counts changes: the old count out, the new one in."""
    changed = counted.where("words <> revised_words OR tokens <> revised_tokens")
    return changes(changed, -1).unionByName(changes(changed, 1, "revised_words", "revised_tokens"))


def later_copies(counted: DataFrame) -> DataFrame:
    """The counted rows whose text already occurs under a smaller doc_id.

    Rows without a doc_id, and rows that repeat the first doc_id of their text, are no later
    copies. A text that makes up more than ``1 / HOT`` of all rows is answered from a
    broadcast of its first doc_id (there are fewer than ``HOT`` such texts), so that its rows
    need not meet in one task; all others are joined.
    """
    first = counted.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = written(first, "first-copies")
    total = counted.count()
    hot = first.where(F.col("n") * HOT > total).select("key", "first")
    rest = first.where(F.col("n") * HOT <= total).select("key", "first")
    marked = counted.join(F.broadcast(hot.select("key", F.col("first").alias("_hot"), F.lit(True).alias("_is_hot"))), "key", "left")
    known = marked.where("_is_hot").withColumn("first", F.col("_hot"))
    other = marked.where("_is_hot IS NULL").join(rest, "key")
    return known.unionByName(other).where("doc_id > first").select(*counted.columns)


class Ledger:
    """Additive totals under a folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._files = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    @staticmethod
    def _name(batch_id: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9.-]+", batch_id):
            raise ValueError(f"batch id {batch_id!r} may hold letters, digits, points and hyphens only")
        return f"batch-{batch_id}"

    def _created(self, path: str, text: str) -> bool:
        """Create a small file that was not there; False if it was."""
        try:
            out = self._files.create(self._at(path), False)
        except Py4JJavaError:
            if self._files.exists(self._at(path)):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _text(self, path: str) -> str:
        stream = self._files.open(self._at(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _names(self, folder: str) -> list[str]:
        at = self._at(f"{self.path}/{folder}")
        return sorted(f.getPath().getName() for f in self._files.listStatus(at)) if self._files.exists(at) else []

    def _base(self) -> tuple[int, dict]:
        """Number and content of the newest base."""
        names = self._names("bases")
        return (int(names[-1]), json.loads(self._text(f"{self.path}/bases/{names[-1]}"))) if names else (-1, {"data": None, "batches": []})

    def _folders(self) -> tuple[list[str], dict[str, str]]:
        """The base's folder, if any, and the folders of the batches since."""
        _, base = self._base()
        inside = set(base["batches"])
        since = {name: self._text(f"{self.path}/commits/{name}") for name in self._names("commits") if name not in inside}
        return [base["data"]] if base["data"] else [], since

    def committed(self, batch_id: str) -> bool:
        """Whether a batch is part of the totals."""
        return self._files.exists(self._at(f"{self.path}/commits/{self._name(batch_id)}"))

    def commit(self, batch_id: str, batch: DataFrame) -> bool:
        """Add a batch of signed changes; False, and nothing done, if its id is committed already."""
        name = self._name(batch_id)
        if self.committed(batch_id):
            return False
        delta = batch.groupBy(*KEYS).agg(
            F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("n_tokens")
        )
        folder = f"data/{name}-{uuid.uuid4().hex}"
        delta.write.parquet(f"{self.path}/{folder}")
        if self._created(f"{self.path}/commits/{name}", folder):
            return True
        self._files.delete(self._at(f"{self.path}/{folder}"), True)
        return False

    def _sums(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], _DELTA)
        sums = self.spark.read.schema(_DELTA).parquet(*[f"{self.path}/{f}" for f in folders]).groupBy(*KEYS)
        return sums.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> bool:
        """Add the base and all batches since up into a new base; False if there was nothing to add or another writer was faster.

        Folders of batches stay, as readers may be using them; :meth:`prune` removes those a base holds.
        """
        number, old = self._base()
        base, since = self._folders()
        if not since:
            return False
        folder = f"data/base-{uuid.uuid4().hex}"
        self._sums([*base, *since.values()]).write.parquet(f"{self.path}/{folder}")
        content = json.dumps({"data": folder, "batches": sorted({*old["batches"], *since})})
        if self._created(f"{self.path}/bases/{number + 1:012d}", content):
            return True
        self._files.delete(self._at(f"{self.path}/{folder}"), True)
        return False

    def prune(self) -> int:
        """Remove the folders that neither the newest base nor a batch since it needs; how many there were."""
        base, since = self._folders()
        needed = {f.rsplit("/", 1)[-1] for f in (*base, *since.values())}
        gone = [f for f in self._names("data") if f not in needed]
        for f in gone:
            self._files.delete(self._at(f"{self.path}/data/{f}"), True)
        return len(gone)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over all committed batches; groups that sum to nothing are left out."""
        base, since = self._folders()
        return self._sums([*base, *since.values()])
