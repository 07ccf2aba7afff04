"""Packing by power-of-two decomposition.

A document of L tokens (its ids and the closing id) is cut into pieces of the
lengths in L's binary form, the longest first: as many of ``max_tokens`` as fit,
then one for each set bit of the rest. Each piece is a sequence of its own, so no
sequence crosses documents and none is padded.

Pieces of equal length are brought together in buckets. A bucket is dealt over
shards by a hash of the document and the place in it, so that a length that most
pieces have is spread; in a shard pieces lie in the order of (id, start) and are cut
into batches of ``BATCH_TOKENS`` tokens, which a trainer reads whole. A sequence's
id is made of its bucket, its shard and its place there: it depends on the table
alone, not on partitions or retries. The number of shards grows with the documents.

Ids are those of the tokenizer's file: a text that holds one of its added tokens is
left to the file's own library, all others take a faster one that gives the same.

Defined results: a null text counts as empty (one piece: the closing id alone);
repeated rows and null ids are packed like any other row, and pieces that are equal
in all columns are interchangeable; an empty table gives no pieces; extra columns
are ignored.
"""

from __future__ import annotations

import base64
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshwork.llm.common import table, workers_import

MAX_TOKENS = 1024
END_ID = 0
#: Documents for each shard of a bucket, and tokens of a batch.
SHARD_DOCS = 16_384
BATCH_TOKENS = 1 << 16


def binary_lengths(tokens: int, max_tokens: int = MAX_TOKENS) -> list[int]:
    """Piece lengths of a document of so many tokens; max_tokens: a power of two."""
    whole, rest = divmod(tokens, max_tokens)
    return [max_tokens] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class Tokenizer:
    """Byte-level BPE ids of a text as little-endian 32-bit bytes, equal to those of the
    file's library without special tokens added."""

    def __init__(self, json_path: str):
        import public_tokenizers
        import tiktoken

        with open(json_path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(json_path, encoding="utf-8") as f:
            self.added = [t["content"] for t in json.load(f)["added_tokens"]]
        self.path = json_path
        self.whole = None
        self.plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        import numpy as np

        if any(t in text for t in self.added):
            if self.whole is None:
                import tokenizers

                self.whole = tokenizers.Tokenizer.from_file(self.path)
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.plain.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


#: Tokenizers of this process by file.
_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer_of(path: str) -> Tokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """``id_col``, start, length, ids (binary: little-endian unsigned 32-bit),
    doc_tokens, bucket (the length); a row per piece, in one pass without a shuffle."""
    import public_tokenizers
    import pyarrow as pa

    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    workers_import(docs.sparkSession)
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    end = end_id.to_bytes(4, "little")
    names = [id_col, "start", "length", "ids", "doc_tokens"]

    def run(batches):
        encode = tokenizer_of(path)
        for batch in batches:
            kind = batch.column(0).type
            for at in range(0, batch.num_rows, 512):  # bounds what is held at once
                owners, starts, lengths, parts, totals = [], [], [], [], []
                for i, text in zip(batch.column(0).slice(at, 512).to_pylist(), batch.column(1).slice(at, 512).to_pylist(), strict=True):
                    ids = encode(text) + end
                    total, start = len(ids) // 4, 0
                    for n in binary_lengths(total, max_tokens):
                        owners.append(i)
                        starts.append(start)
                        lengths.append(n)
                        parts.append(ids[4 * start : 4 * (start + n)])
                        totals.append(total)
                        start += n
                yield pa.RecordBatch.from_arrays([pa.array(owners, kind), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(parts, pa.binary()), pa.array(totals, pa.int64())], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text_")
    cut = docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, start long, length long, ids binary, doc_tokens long")
    return cut.withColumn("bucket", F.col("length"))


def shards_of(docs: DataFrame) -> int:
    return max(1, -(-docs.count() // SHARD_DOCS))


def bucketed(rows: DataFrame, shards: int, id_col: str = "doc_id", batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """Pieces brought together by bucket, with shard, batch, sequence_id and offset.
    rows: the columns of ``pieces``, ids or not."""
    if shards > 1 << 24:
        raise ValueError("at most 2^24 shards")
    names = rows.columns
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(id_col, "start"), F.lit(shards)))
    order = [id_col, "start", *(c for c in names if c not in (id_col, "start", "bucket"))]
    place = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy(*order)) - 1
    placed = dealt.withColumn("place", place.cast("long"))
    number = F.shiftleft(F.log2("bucket").cast("long"), 56).bitwiseOR(F.shiftleft(F.col("shard"), 32)).bitwiseOR(F.col("place"))
    return placed.select(*names, "shard", F.floor(F.col("place") / F.greatest(F.lit(1), F.lit(batch_tokens) / F.col("bucket"))).alias("batch"), number.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, shards: int | None = None) -> DataFrame:
    """``id_col``, start, length, ids, doc_tokens, bucket, shard, batch, sequence_id,
    offset of every piece; one shuffle, of the pieces."""
    return bucketed(pieces(docs, id_col, text_col, tokenizer, max_tokens, end_id), shards or shards_of(docs), id_col)


def digest(docs: DataFrame) -> DataFrame:
    """The packed pieces with crc32 of their ids in place of the ids, which are so
    left out of the shuffle."""
    small = pieces(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "bucket")
    return bucketed(small, shards_of(docs)).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket", "shard", "batch")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
