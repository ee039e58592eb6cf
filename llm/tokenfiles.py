"""Token counts by scanning flat token files for the separator.

A flat file is little-endian token numbers and nothing else: no index, no lengths.
Each file is read in blocks; a vectorised search finds the separators of a block,
and a running sum over the blocks of a file (the prefix scan) tells which document
a block begins in, so pieces of a document in neighbouring blocks are added up.

``write_token_files`` makes such files from texts: every token is stored plus one,
so that 0 marks the end of a document, and each document begins with its id in
``KEY`` tokens, which is how counts find their document again.

Defined cases: null and empty texts have 0 tokens; a null id stays null; repeated
ids and rows are counted each; tokens after a file's last separator are a document
that ``closed`` marks as false; empty files and an empty table give no rows. A
file may have up to 2 GB (what Spark reads as one binary value); the writer makes
one for each input partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import as_batch, new_folder, stored
from llm.tokens import word_tokens

#: Tokens that hold a document's id, in base 2^15, lowest first; the whole is 0 for null, else the id plus 2^63 plus 1.
KEY, DIGIT = 5, 15
BLOCK_BYTES = 1 << 20
SEGMENTS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("part", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("closed", pa.bool_()), ("head", pa.binary())])


def key_tokens(doc_id: int | None) -> list[int]:
    value = 0 if doc_id is None else doc_id + (1 << 63) + 1
    return [((value >> (DIGIT * k)) & ((1 << DIGIT) - 1)) + 1 for k in range(KEY)]


def key_value(head: bytes) -> int | None:
    value = sum((int(x) - 1) << (DIGIT * k) for k, x in enumerate(np.frombuffer(head, "<u2")))
    return value - (1 << 63) - 1 if value else None


def write_token_files(docs: DataFrame, tokenizer: str) -> str:
    """Write one flat file per partition into the shared folder; returns the folder."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, schema = word_tokens(tokenizer), pa.schema([("value", pa.binary())])
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tokens.of(text.as_py())
                if len(ids) and int(ids.max()) >= (1 << 16) - 1:
                    raise ValueError("token numbers must stay below 65,535")
                out.append(np.array(key_tokens(doc_id), "<u2").tobytes() + (ids + 1).astype("<u2").tobytes())
            yield as_batch(schema, [out])

    path = new_folder(docs.sparkSession, "tokens")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    flat = narrow.mapInArrow(encode, "value binary").select(F.col("value").cast("string").alias("value"))
    # The text sink writes values as they are; the separator takes the place of its line ends.
    flat.write.option("lineSep", "\0\0").text(path)
    return path


def scan_blocks(separator: int, width: int, head: int):
    """Segments between separators of every block, each with its first tokens."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                file, block, first, data = (batch.column(k)[row].as_py() for k in range(4))
                tokens = np.frombuffer(data, f"<u{width}")
                ends = np.flatnonzero(tokens == separator)
                starts = np.concatenate([[0], ends + 1])
                stops = np.concatenate([ends, [len(tokens)]])
                n = len(starts)
                heads = [tokens[a : min(a + head, b)].tobytes() for a, b in zip(starts, stops)]
                yield as_batch(SEGMENTS, [[file] * n, [block] * n, np.arange(n), first + starts, stops - starts, np.arange(n) < n - 1, heads])

    return scan


def scan_token_files(spark: SparkSession, path: str, separator: int = 0, width: int = 2, head: int = 0, block_bytes: int = BLOCK_BYTES, suffix: str = "*.txt") -> DataFrame:
    """(file, ordinal, start, n_tokens, closed, head): one row per document of the flat files in ``path``.

    ``head`` is the document's first so many tokens. Runs the scan at once; the stitching is lazy.
    """
    if block_bytes % width:
        raise ValueError("a block must hold whole tokens")
    files = spark.read.format("binaryFile").option("pathGlobFilter", suffix).load(path).filter(F.col("length") > 0)
    last = F.floor((F.col("length") - 1) / block_bytes)
    blocks = files.select("path", "content", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    data = F.expr(f"substring(content, cast(block * {block_bytes} + 1 as int), {block_bytes})")
    blocks = blocks.select("path", "block", (F.col("block") * (block_bytes // width)).alias("first"), data.alias("data"))
    segments = stored(blocks.mapInArrow(scan_blocks(separator, width, head), "file string, block long, part long, at long, n long, closed boolean, head binary"), "segments")

    ends = segments.groupBy("file", "block").agg(F.sum(F.col("closed").cast("long")).alias("ends"))
    before = F.sum("ends").over(Window.partitionBy("file").orderBy("block")) - F.col("ends")
    numbered = segments.join(ends.select("file", "block", before.alias("before")), ["file", "block"])
    pieces = numbered.select("file", (F.col("before") + F.col("part")).alias("ordinal"), "block", "at", "n", "closed", "head")
    docs = pieces.groupBy("file", "ordinal").agg(
        F.min("at").alias("start"), F.sum("n").alias("n_tokens"), F.max("closed").alias("closed"),
        F.array_sort(F.collect_list(F.when(F.length("head") > 0, F.struct("block", "head")))).alias("heads"),
    )
    docs = docs.filter("closed OR n_tokens > 0")
    joined = F.aggregate("heads", F.lit(b""), lambda a, x: F.concat(a, x["head"]))
    return docs.withColumn("head", F.substring(joined, 1, head * width)).drop("heads")


def token_counts(docs: DataFrame, tokenizer: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, start): tokens of every text, counted in the flat files written from it."""
    spark = docs.sparkSession
    found = scan_token_files(spark, write_token_files(docs, tokenizer), 0, 2, KEY, block_bytes)
    digit = lambda k: F.conv(F.hex(F.concat(F.substring("head", 2 * k + 2, 1), F.substring("head", 2 * k + 1, 1))), 16, 10).cast("decimal(38,0)") - 1
    value = sum((digit(k) * F.lit(str(1 << (DIGIT * k))).cast("decimal(20,0)") for k in range(KEY - 1)), digit(KEY - 1) * F.lit(str(1 << (DIGIT * (KEY - 1)))).cast("decimal(20,0)"))
    doc_id = F.when(value > 0, (value - F.lit(str((1 << 63) + 1)).cast("decimal(20,0)")).cast("long"))
    return found.select(doc_id.alias("doc_id"), (F.col("n_tokens") - KEY).alias("n_tokens"), "start")
