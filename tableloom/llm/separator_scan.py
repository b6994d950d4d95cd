"""Token counts of documents in flat token files that hold nothing but ids and end-of-document ids.

A file is cut into blocks of fixed size, whatever documents do at their bounds.  A block is searched for the
separator by one vector comparison and tells how many it found and where the last one is.  A prefix scan over the
blocks of a file then gives each block the number of documents before it and the position at which its first
document began, which may be many blocks back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from tableloom.llm import wordscan as ws
from tableloom.llm.files import file_size, read_range, writing
from tableloom.llm.tokens import Vocabulary, encoder
from tableloom.scratch import Scratch


def write_flat(docs: DataFrame, vocabulary: Vocabulary, separator: int, dtype: str, folder: str) -> DataFrame:
    """Writes one flat file per partition of docs (doc_id, text); gives (file, ordinal, doc_id) of what it holds.

    A null text is an empty one: its separator alone.  The separator's own string in a text must be ordinary text
    (a plain vocabulary), or it would end a document; ids that dtype can't hold are refused.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = f"{folder}/part-{TaskContext.get().partitionId():06d}.tokens"
        coder, n, most = encoder(vocabulary), 0, np.iinfo(dtype).max
        if max(coder.size - 1, separator) > most:
            raise ValueError(f"{dtype} holds ids up to {most}; the vocabulary has {coder.size}")
        with writing(file) as out:
            for batch in batches:
                for text in batch.column(1):
                    ids = coder.ids(text.as_py())
                    if (ids == separator).any():
                        raise ValueError("a text has the separator's id")
                    out.write(np.append(ids, separator).astype(dtype).tobytes())
                m = len(batch)
                yield pa.RecordBatch.from_arrays([pa.array([file] * m, pa.string()), pa.array(np.arange(n, n + m)), batch.column(0)], ["file", "ordinal", "doc_id"])
                n += m
                ws.trim()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "file string, ordinal long, doc_id long")


def count_tokens(files: DataFrame, separator: int, dtype: str, scratch: Scratch, block: int = 4 << 20) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of every document of the files in files (file).

    start is the position of its first token, n_tokens counts its tokens without the separator; tokens after the
    last separator are a document that has not ended.  An empty file has no documents.
    """
    spark, width = files.sparkSession, np.dtype(dtype).itemsize
    step = block // width

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([file_size(f) // width for f in batch.column(0).to_pylist()], pa.int64())], ["file", "length"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, k, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size = min(step, length - k * step)
                at = np.flatnonzero(np.frombuffer(read_range(file, k * step * width, size * width), dtype) == separator) + k * step
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([k], pa.int64()), pa.array([length], pa.int64()), pa.array([len(at)], pa.int64()), pa.array([at[-1] if len(at) else None], pa.int64()), pa.array([at], pa.list_(pa.int64()))], ["file", "block", "length", "n", "last", "ends"])

    found = files.select("file").distinct().mapInArrow(sizes, "file string, length long").filter("length > 0")
    blocks = found.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / step))).alias("block"), "length")
    # The file names are few: dealt anew, so that the blocks of one file are read by many tasks.
    blocks = blocks.repartition("file", "block").mapInArrow(scan, "file string, block long, length long, n long, last long, ends array<long>")
    blocks = scratch.save(blocks, "blocks")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carry = blocks.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.coalesce(F.last("last", True).over(before) + 1, F.lit(0)).alias("begin"))
    ends = blocks.join(carry, ["file", "block"]).select("file", "base", "begin", "ends", F.posexplode("ends").alias("i", "end"))
    starts = F.when(F.col("i") == 0, F.col("begin")).otherwise(F.element_at("ends", F.col("i")) + 1)
    closed = ends.select("file", (F.col("base") + F.col("i")).alias("ordinal"), starts.alias("start"), (F.col("end") - starts).alias("n_tokens"), F.lit(True).alias("ended"))
    tail = blocks.groupBy("file").agg(F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"), F.max("length").alias("length")).filter("start < length")
    return closed.unionByName(tail.select("file", "ordinal", "start", (F.col("length") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended")))


def document_tokens(docs: DataFrame, vocabulary: Vocabulary, separator: int, dtype: str = "<u2") -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, file, ordinal, start, n_tokens, by writing flat files and scanning them.

    Rows that repeat a doc_id, or have none, are documents of their own.  No rows give no files and no result.
    """
    scratch = Scratch(docs.sparkSession, "separator-scan")
    ws.small_batches(docs.sparkSession)
    held = scratch.save(write_flat(docs, vocabulary, separator, dtype, scratch.table("flat")), "held")
    counts = count_tokens(held.select("file").distinct(), separator, dtype, scratch)
    return held.join(counts, ["file", "ordinal"]).select("doc_id", F.element_at(F.split("file", "/"), -1).alias("file"), "ordinal", "start", "n_tokens")
