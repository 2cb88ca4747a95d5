"""Token counts kept as delta-maintained rollups.

A batch of inserts, deletes and revisions becomes signed deltas of documents
and tokens by source, language and tokenizer version. Deltas are written to a
folder of their own; a batch is committed by a marker file that names it and
that can be put in place only once, so a batch that is sent again, sent by two
drivers at a time, or whose job died half-way, counts once. Totals are sums of
committed deltas; ``compact`` adds up what was committed so far.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k"
GROUP = ("source", "lang", "tokenizer")
DELTAS = "source string, lang string, tokenizer string, docs long, tokens long"
CHANGES = "op string, source string, lang string, tokenizer string, n_tokens long, old_source string, old_lang string, old_tokenizer string, old_n_tokens long"


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` of the whole text (null and empty: 0).

    ``path`` names a rank file that every executor has; by default the installed
    public tokenizer's own.
    """

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import public_tokenizers as P

        encode = _encoder(path or P.path(f"{TOKENIZER}.tiktoken"), pattern or P.PATTERN).encode_ordinary
        for texts in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return docs.withColumn("n_tokens", run(F.col(text)))


def signed(changes: DataFrame) -> DataFrame:
    """Deltas of a batch: one row a group.

    op is insert, delete or revise; a revision takes the old_ columns away and
    adds the new ones. Null counts are 0; null sources and languages are groups.
    Rows with another op are an error.
    """
    new = F.struct(*GROUP, F.coalesce("n_tokens", F.lit(0)).alias("n"))
    old = F.struct(*[F.col(f"old_{c}").alias(c) for c in GROUP], F.coalesce("old_n_tokens", F.lit(0)).alias("n"))
    part = lambda s, sign: F.struct(*[s[c].alias(c) for c in GROUP], F.lit(sign).alias("docs"), (s["n"] * sign).alias("tokens"))
    rows = F.when(F.col("op") == "insert", F.array(part(new, 1))).when(F.col("op") == "delete", F.array(part(new, -1))).when(F.col("op") == "revise", F.array(part(old, -1), part(new, 1)))
    rows = F.coalesce(rows, F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null")))))
    x = changes.select(F.explode(rows).alias("d")).select("d.*")
    return x.groupBy(*GROUP).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))


class Rollup:
    """Committed deltas under one folder of the shared store.

    ``<batch>.commit`` names the folder of a batch's deltas; ``<n>.compact``
    that of a sum, and the markers that it holds.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(self._conf)

    def _marker(self, batch: str) -> str:
        return f"{base64.urlsafe_b64encode(batch.encode()).decode().rstrip('=')}.commit"

    def _put(self, name: str, lines: list[str]) -> bool:
        """Put a marker in place whole; False if it is there already, which the file system decides for one of many."""
        staged = self._path(f"{self.path}/_staged-{uuid.uuid4().hex}")
        out = self._fs.create(staged, False)
        out.write(bytearray("\n".join(lines).encode()))
        out.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        try:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
            context.rename(staged, self._path(f"{self.path}/{name}"), self.spark.sparkContext._gateway.new_array(rename, 0))
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            self._fs.delete(staged, False)
            return False
        return True

    def _names(self, suffix: str) -> list[str]:
        if not self._fs.exists(self._path(self.path)):
            return []
        return sorted(n for s in self._fs.listStatus(self._path(self.path)) if (n := s.getPath().getName()).endswith(suffix))

    def _lines(self, names: list[str]) -> dict[str, list[str]]:
        if not names:
            return {}
        rows = self.spark.read.text([f"{self.path}/{n}" for n in names], wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), "value").collect()
        return {r["name"]: r["value"].split("\n") for r in rows}

    def committed(self, batch: str) -> bool:
        return bool(self._fs.exists(self._path(f"{self.path}/{self._marker(batch)}")))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False if it was committed before. What an uncommitted try has written counts nowhere."""
        if self.committed(batch):
            return False
        data = f"data-{uuid.uuid4().hex}"
        signed(changes).write.parquet(f"{self.path}/{data}")
        if self._put(self._marker(batch), [data]):
            return True
        self._fs.delete(self._path(f"{self.path}/{data}"), True)
        return False

    def _state(self) -> tuple[int, set[str], list[str]]:
        """The number of compactions, the markers that the last one holds, and the folders that make up the totals."""
        sums = sorted(self._names(".compact"), key=lambda n: int(n.split(".")[0]))
        last = self._lines(sums[-1:]).get(sums[-1]) if sums else None
        held = set(last[1:]) if last else set()
        rest = self._lines([n for n in self._names(".commit") if n not in held])
        return len(sums), held | set(rest), ([last[0]] if last else []) + [x[0] for _, x in sorted(rest.items())]

    def compact(self) -> bool:
        """Add up all that is committed into one folder; False if another driver was faster. Old folders are left to ``vacuum``."""
        n, markers, folders = self._state()
        data = f"data-{uuid.uuid4().hex}"
        self._sums(folders).coalesce(1).write.parquet(f"{self.path}/{data}")
        return self._put(f"{n + 1}.compact", [data, *sorted(markers)])

    def vacuum(self) -> int:
        """Delete data that the totals no longer need; for a time when no batch is being written."""
        _, _, folders = self._state()
        old = [n for s in self._fs.listStatus(self._path(self.path)) if (n := s.getPath().getName()).startswith("data-") and n not in folders]
        for name in old:
            self._fs.delete(self._path(f"{self.path}/{name}"), True)
        return len(old)

    def _sums(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], DELTAS)
        deltas = self.spark.read.schema(DELTAS).parquet(*[f"{self.path}/{x}" for x in folders])
        sums = deltas.groupBy(*GROUP).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))
        return sums.where("docs <> 0 or tokens <> 0")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens); groups that came to nothing go."""
        return self._sums(self._state()[2])
