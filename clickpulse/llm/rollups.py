"""Token counts as delta-maintained rollups.

The totals by source, language and tokenizer version are additive, so a batch
of changes is a sum of signed rows: an insert adds a document and its tokens, a
delete takes both away, a revised count adds the difference. A commit writes
the new totals to a folder of their own and then publishes them as the next
version: a small file, named by the version's number, that names the folder and
the batch. It is put in place only if no file has that name, so of two writers
that start from one version one finds it taken and starts again from the new
one; no commit is lost. Each batch has a marker file, so committing it again, or
after a run that died, changes nothing twice.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tiktoken import Encoding

from clickpulse.llm.common import put_text, read_text, save
from clickpulse.llm.wordhash import slices
from clickpulse.session import fresh_dir
from clickpulse.sources.storage import exists, names, remove_folder

KEYS = ("source", "lang", "tokenizer")
_TOTALS_DDL = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def inserts(counts: DataFrame) -> DataFrame:
    """Signed rows of new documents: ``counts`` has KEYS and n_tokens."""
    return counts.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), F.col("n_tokens").cast("long").alias("n_tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    return inserts(counts).select(*KEYS, (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(counts: DataFrame, old: str = "old_tokens", new: str = "new_tokens") -> DataFrame:
    """Signed rows of documents whose count changed from ``old`` to ``new``."""
    return counts.select(*KEYS, F.lit(0).cast("long").alias("n_docs"), (F.col(new) - F.col(old)).cast("long").alias("n_tokens"))


class TokenRollup:
    """Totals below ``path``, a folder that the cluster shares and whose store
    renames atomically. Any number of writers and readers; ``keep`` versions
    stay for readers that opened them, older ones are removed."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2) -> None:
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep

    def _numbers(self) -> list[int]:
        return [int(n) for n in names(self.spark, f"{self.path}/_versions") if n.isdigit()]

    def _newest(self) -> tuple[int, str | None, str | None]:
        """(number, folder, batch) of the newest version; -1 if there is none."""
        number = max(self._numbers(), default=-1)
        if number < 0:
            return -1, None, None
        folder, batch = read_text(self.spark, f"{self.path}/_versions/{number}").split("\n", 1)
        return number, folder, batch

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; groups that all changes
        together leave without documents and tokens are gone."""
        folder = self._newest()[1]
        reader = self.spark.read.schema(_TOTALS_DDL)
        return reader.parquet(f"{self.path}/{folder}") if folder else self.spark.createDataFrame([], _TOTALS_DDL)

    def _marker(self, batch: str) -> str:
        return f"{self.path}/_batches/{hashlib.sha256(batch.encode()).hexdigest()}"

    def holds(self, batch: str) -> bool:
        """Whether the totals hold a batch."""
        return self._newest()[2] == batch or exists(self.spark, self._marker(batch))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add signed rows; False, and no change, if the batch is in already.
        ``changes`` is summed by key before it meets the totals, so a source
        with a third of all rows is a few partial sums."""
        sums = changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        while True:
            number, folder, last = self._newest()
            if last is not None:  # its writer may have died before marking it
                put_text(self.spark, self._marker(last), last)
            if self.holds(batch):
                return False
            new = f"totals-{uuid.uuid4().hex}"
            old = self.totals() if folder is None else self.spark.read.schema(_TOTALS_DDL).parquet(f"{self.path}/{folder}")
            (old.unionByName(sums).groupBy(*KEYS)
             .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
             .filter("n_docs <> 0 OR n_tokens <> 0").write.parquet(f"{self.path}/{new}"))
            if put_text(self.spark, f"{self.path}/_versions/{number + 1}", f"{new}\n{batch}"):
                break
            remove_folder(self.spark, f"{self.path}/{new}")  # another writer was first
        put_text(self.spark, self._marker(batch), batch)
        for n in self._numbers():
            if n <= number + 1 - self.keep:
                gone = read_text(self.spark, f"{self.path}/_versions/{n}").split("\n", 1)[0]
                remove_folder(self.spark, f"{self.path}/{gone}")
                remove_folder(self.spark, f"{self.path}/_versions/{n}")
        return True


#: White space of this length makes the library's pattern recurse too deep.
LONG_BLANK = regex.compile(r"\s{1000}")


class Counter:
    """Numbers of tokens of whole texts, by the byte-level BPE ranks of the file
    ``path`` (a token in base64 and its rank a line) over the parts that
    ``pattern`` cuts a text into. Names of special tokens are ordinary text."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.whole = Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.part = Encoding(path, pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)

    def count(self, text: str) -> int:
        if LONG_BLANK.search(text):
            return sum(len(self.part.encode_ordinary(p.group())) for p in self.pattern.finditer(text))
        return len(self.whole.encode_ordinary(text))


@lru_cache(maxsize=None)
def counter(path: str, pattern: str) -> Counter:
    """One counter for each file and worker process, kept from task to task."""
    return Counter(path, pattern)


def _counted(paths: list[str], pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [counter(p, pattern) for p in paths]
        for batch in batches:
            texts, found = batch.column("text"), [[] for _ in counters]
            for first, last in slices(texts):
                own = texts.slice(first, last - first).fill_null("").to_pylist()
                for c, numbers in zip(counters, found):
                    numbers.extend(map(c.count, own))
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), *(pa.array(n, pa.int64()) for n in found)],
                names=[*kept, *(f"n{i}" for i in range(len(found)))])
    return run


def token_numbers(docs: DataFrame, paths: list[str], pattern: str) -> DataFrame:
    """``docs`` without its ``text``, and for each tokenizer file of ``paths`` a
    column ``n0``, ``n1``, ...: the whole text's number of tokens. Null and
    empty texts have none."""
    kept = [f for f in docs.schema.fields if f.name != "text"]
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"n{i} long" for i in range(len(paths)))])
    return docs.mapInArrow(_counted(paths, pattern), ddl)


def rollup_report(docs: DataFrame, tokenizers: dict[str, str], pattern: str) -> DataFrame:
    """The totals of all ``docs`` after a commit for each of ``tokenizers``
    (version: file of ranks; :class:`Counter`) and two more; two are repeated:

    each version: every document, counted by that tokenizer;
    ``copies``: documents whose text has a smaller doc_id elsewhere go, from
    all versions (null ids count as largest; repeated rows of one id all stay);
    ``ends``: the first version counts the end of a text as a token too, in the
    documents that are left.

    Null and empty texts count as documents without tokens but their end;
    sources and languages may be null. An empty table gives no rows.
    """
    numbers = token_numbers(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"), "text"),
        list(tokenizers.values()), pattern)
    rows = save(numbers, "rollup-counts")
    # stored, so that the join below can split the rows of a text with many copies
    firsts = save(rows.groupBy("text_hash").agg(F.min("doc_id").alias("first_id")), "rollup-firsts")
    copy = F.col("first_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    rows = save(rows.join(firsts, "text_hash").withColumn("copy", copy).drop("text_hash"), "rollup-copies")
    rollup = TokenRollup(docs.sparkSession, fresh_dir(docs.sparkSession, "llm-rollup"))
    columns = {name: f"n{i}" for i, name in enumerate(tokenizers)}
    of = lambda frame, name: frame.withColumns({"tokenizer": F.lit(name), "n_tokens": F.col(columns[name])})
    copies, left = rows.filter("copy"), rows.filter("NOT copy")
    batches = {name: inserts(of(rows, name)) for name in tokenizers}
    batches["copies"] = reduce(DataFrame.unionByName, (deletes(of(copies, name)) for name in tokenizers))
    revised = next(iter(tokenizers))
    batches["ends"] = revisions(of(left, revised).withColumn("with_end", F.col("n_tokens") + 1), "n_tokens", "with_end")
    for name in [*tokenizers, "copies", "copies", "ends", revised]:
        rollup.commit(name, batches[name])
    return rollup.totals()
