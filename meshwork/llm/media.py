"""Media columns with content-defined chunks.

A text's UTF-8 bytes, padded with blanks to a positive multiple of ``FRAME``, are
the samples of an 8-bit mono WAV. A rolling gear hash cuts the samples into chunks
where their content says so. Two tables are written to the shared folder:

* ``manifest``: for each row its id, the digest of its samples, the WAV header and
  the ordered list of chunk digests;
* ``chunks``: each digest once with its compressed bytes, bucketed by digest, so
  that reading back joins it without another shuffle of the bytes.

Reading back joins the distinct lists with the chunks, puts them in order,
compares the digest of the whole and computes features from the stored bytes. A
list of one chunk needs no reassembly.

Defined results: a null text counts as empty (one frame of blanks); equal texts
share one list and one result; repeated rows and null ids are results of their own;
an empty table gives none; extra columns are ignored. Bytes that don't give their
digest again raise an error.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwork.llm.common import fresh_path, release, table, utf8, workers_import

FRAME = 192
SMALLEST, AVERAGE_BITS, LARGEST = 2048, 13, 65536
RATE = 8000
LEVEL = 6
HEADER_BYTES = 44


def gear_table(seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**32, 256, dtype=np.uint32)


_GEAR = gear_table()


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of gear[data[i - k]] << k over the last 32 bytes, by doubling."""
    h = _GEAR[data]
    step = 1
    while step < 32:
        more = h.copy()
        more[step:] += h[:-step] << np.uint32(step)
        h = more
        step *= 2
    return h


def cuts(payload: bytes, smallest: int = SMALLEST, bits: int = AVERAGE_BITS, largest: int = LARGEST) -> list[int]:
    """Ends of the chunks of a payload."""
    n = len(payload)
    if n <= smallest:
        return [n]
    marks = np.flatnonzero(gear_hashes(np.frombuffer(payload, np.uint8)) >> np.uint32(32 - bits) == 0) + 1
    ends, at = [], 0
    while n - at > smallest:
        k = np.searchsorted(marks, at + smallest)
        end = min(int(marks[k]) if k < len(marks) else n, at + largest, n)
        ends.append(end)
        at = end
    if at < n:
        ends.append(n)
    return ends


def payload_of(raw: bytes) -> bytes:
    return raw.ljust(max(FRAME, -(-len(raw) // FRAME) * FRAME), b" ")


def wav_header(samples: int) -> bytes:
    u4, u2 = (lambda x: x.to_bytes(4, "little")), (lambda x: x.to_bytes(2, "little"))
    return b"RIFF" + u4(36 + samples) + b"WAVEfmt " + u4(16) + u2(1) + u2(1) + u4(RATE) + u4(RATE) + u2(1) + u2(8) + b"data" + u4(samples)


def samples_of(media: bytes) -> bytes:
    """The samples of a WAV as written here."""
    if media[:4] != b"RIFF" or media[8:16] != b"WAVEfmt " or media[36:40] != b"data":
        raise ValueError("no such media")
    n = int.from_bytes(media[40:44], "little")
    if len(media) != HEADER_BYTES + n:
        raise ValueError("media cut short")
    return media[HEADER_BYTES:]


def feature(samples: bytes) -> str:
    """Mean, energy and sign changes of the samples, and a 64-bit hash of how the
    loudness rises and falls over 65 equal spans."""
    x = np.frombuffer(samples, np.uint8).astype(np.int64)
    n = len(x)
    centred = x - 128
    changes = int(np.count_nonzero((centred[1:] < 0) != (centred[:-1] < 0)))
    bounds = np.arange(66) * n // 65
    total = np.concatenate([[0], np.cumsum(x)])
    spans = (total[bounds[1:]] - total[bounds[:-1]]) * 1000 // np.maximum(bounds[1:] - bounds[:-1], 1)
    bits = np.packbits(spans[1:] > spans[:-1]).tobytes().hex()
    return f"{int(x.sum()) * 1000 // n}:{int((centred**2).sum()) // n}:{changes}:{bits}"


def digest_of(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=20).digest()


def write_media(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Writes ``path``/manifest and ``path``/chunks; gives the chunk table's name."""
    import pyarrow as pa

    spark = docs.sparkSession
    workers_import(spark)
    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("raw"))
    parts = pa.list_(pa.binary())

    def listed(batches):
        for batch in batches:
            keys, sizes, heads, lists = [], [], [], []
            for x in batch.column(1):
                raw = x.as_py()
                body = payload_of(raw)
                at, own = 0, []
                for end in cuts(body):
                    own.append(digest_of(body[at:end]))
                    at = end
                keys.append(hashlib.sha256(body).digest())
                sizes.append(len(raw))
                heads.append(wav_header(len(body)))
                lists.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(heads, pa.binary()), pa.array(lists, parts)], names=["id", "key", "n_bytes", "header", "digests"])

    def chunked(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=True)
        sent: set[bytes] = set()
        for batch in batches:
            digests, data, held = [], [], 0
            for x in batch.column(0):
                body = payload_of(x.as_py())
                at = 0
                for end in cuts(body):
                    d = digest_of(body[at:end])
                    if d not in sent:
                        if len(sent) >= 200_000:
                            sent.clear()  # later copies only cost a row; the join below removes them
                        sent.add(d)
                        digests.append(d)
                        data.append(pack.compress(body[at:end]))
                        held += len(data[-1])
                    at = end
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(data, pa.binary())], names=["digest", "data"])
                    digests, data, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(data, pa.binary())], names=["digest", "data"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows.mapInArrow(listed, f"id {kind}, key binary, n_bytes long, header binary, digests array<binary>").write.option("compression", "zstd").parquet(f"{path}/manifest")
    name = f"chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unique = rows.select("raw").mapInArrow(chunked, "digest binary, data binary").dropDuplicates(["digest"])
    unique.write.option("compression", "none").bucketBy(buckets, "digest").option("path", f"{path}/chunks").saveAsTable(name)
    del unique
    release(spark)
    return name


def read_media(spark: SparkSession, path: str, chunk_table: str) -> DataFrame:
    """key, media (the whole WAV), once for each distinct list of the manifest."""
    import pyarrow as pa

    lists = spark.read.parquet(f"{path}/manifest").select("key", "header", "digests").dropDuplicates(["key"])
    wanted = lists.select("key", "header", F.size("digests").alias("parts"), F.posexplode("digests").alias("seq", "digest"))
    found = wanted.join(spark.table(chunk_table), "digest", "left").select("key", "header", "parts", "seq", "data")
    out = "key binary, media binary"

    def whole(key: bytes, header: bytes, chunks: list[bytes | None], unpack):
        if any(c is None for c in chunks):
            raise ValueError(f"a chunk of {key.hex()} is missing")
        body = b"".join(map(unpack.decompress, chunks))
        if hashlib.sha256(body).digest() != key:
            raise ValueError(f"the chunks of {key.hex()} don't give its digest")
        return header + body

    def single(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                media = [whole(k, h, [d], unpack) for k, h, d in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(media, pa.binary())], names=["key", "media"])

    def several(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        key, header, chunks = None, b"", []
        for batch in batches:
            keys, media = [], []
            for k, h, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        keys.append(key)
                        media.append(whole(key, header, chunks, unpack))
                    key, header, chunks = k, h, []
                chunks.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(media, pa.binary())], names=["key", "media"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([whole(key, header, chunks, unpack)], pa.binary())], names=["key", "media"])

    one = found.where("parts = 1").select("key", "header", "data").mapInArrow(single, out)
    more = found.where("parts > 1").select("key", "header", "data", "seq").repartition("key").sortWithinPartitions("key", "seq").mapInArrow(several, out)
    return one.unionByName(more)


def features(media: DataFrame) -> DataFrame:
    """media: key, media. Gives the digests and the feature of each."""
    import pyarrow as pa

    names = ["key", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in names[1:]]
            for x in batch.column(1):
                whole = x.as_py()
                body = samples_of(whole)
                for c, v in zip(cols, (len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-16:]), len(whole), hashlib.sha256(whole).hexdigest(), feature(body)), strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=names)

    return media.mapInArrow(run, "key binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "media")
    chunk_table = write_media(table(spark, sf_dir, "documents"), path)
    found = features(read_media(spark, path, chunk_table))
    own = spark.read.parquet(f"{path}/manifest").select(F.col("id").alias("doc_id"), "key", "n_bytes")
    return own.join(found, "key").select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
