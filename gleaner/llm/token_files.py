"""Token ids in ORC: run-length encoded ids, row indexes and Bloom filters on document ids.

``write_tokens`` encodes whole texts with the tokenizers library, range-partitions them by
document id and writes one ORC file for each range, sorted by document id. ORC encodes the ids by
integer run lengths, keeps minima and maxima of doc_id for each stripe and row group, and a Bloom
filter of doc_id; so ``read_tokens`` prunes files, stripes and row groups by their metadata, and one
large file is read by several tasks, stripe by stripe. Each row also keeps its file's number and
the ids that stand before it in that file, so a document's place in the whole stream needs only
the size of each file, from two narrow columns: no task sees all rows.

Null or empty text yields the end id alone. Documents with a null id come first; repeated rows stay,
in any order among themselves. An empty table gives an empty folder of files.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import public_tokenizers

from gleaner.llm.bpe import WORD_BPE
from gleaner.llm.common import documents, fresh_path, parts, slices, text_buffer
from gleaner.llm.pieces import Pieces

#: Document stripes of about this many bytes, row indexes every so many rows.
ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(32 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "compression": "zstd",
}
_TOKENS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("before", T.LongType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)


class Encoder(Pieces):
    """The library's encoding; many words in one call: an id whose vocabulary string ends a word ends it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        import tokenizers

        super().__init__(path)
        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        suffix, vocab = self.spec["model"]["end_of_word_suffix"], self.library.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for name, i in vocab.items() if name.endswith(suffix)]] = True
        del self.spec

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)

    def words(self, words: list[str]) -> list[np.ndarray]:
        if not words:
            return []
        ids = np.array(self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int32)
        at = np.flatnonzero(self.ends[ids]) + 1
        if len(at) != len(words):
            return [self.whole(w) for w in words]
        at = at.tolist()
        return [ids[a:b] for a, b in zip([0, *at], at)]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_tokens(docs: DataFrame, to: str, path: str | None = None, end_id: int = 2) -> None:
    """Writes doc_id, part, before and ids of every document to ORC files at to, in order of doc_id."""
    path = path or public_tokenizers.path(WORD_BPE)

    def run(batches):
        from pyspark import TaskContext

        coder, part, before = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            data, ends = text_buffer(column)
            for i, j in slices(ends):
                got, n = coder.encode_bytes(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i])
                got = np.insert(got, np.cumsum(n), np.int32(end_id))
                at = np.concatenate([[0], np.cumsum(n + 1)])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, j - i),
                        pa.array(np.full(j - i, part, np.int32)),
                        pa.array(before + at[:-1]),
                        pa.array((n + 1).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(got)),
                    ],
                    _TOKENS.names,
                )
                before += int(at[-1])

    spark = docs.sparkSession
    (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .repartitionByRange(parts(spark), "doc_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(run, _TOKENS)
        .write.options(**ORC_OPTIONS)
        .orc(to)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files; filters on doc_id reach the stripes and row groups."""
    return spark.read.schema(_TOKENS).orc(path)


def token_places(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files alone."""
    schema = "doc_id long, part int, before long, n_tokens long, ids_crc32 long"

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            at = lists.offsets.to_numpy()
            values = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False))).cast("B")
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())],
                ["doc_id", "part", "before", "n_tokens", "ids_crc32"],
            )

    rows = read_tokens(spark, path).select("doc_id", "part", "before", "ids").mapInArrow(run, schema)
    # one row for each file: its ids, and the ids of the files before it
    files = read_tokens(spark, path).groupBy("part").agg(F.max(F.col("before") + F.col("size")).alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return rows.join(bases, "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token files of all documents to the shared folder and reads them back."""
    to = fresh_path(spark, "tokens")
    write_tokens(documents(spark, sf_dir), to)
    return token_places(spark, to)
