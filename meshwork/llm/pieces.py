"""SentencePiece encoding and decoding with a shared-prefix Viterbi.

A text's blanks become marks (U+2581), one is put before the text, and the marked
text is cut into words before each run of marks. The distinct words of a batch are
sorted, which is a depth-first walk of their trie: the forward table of the common
prefix with the word before is kept and only the rest is computed.

For a unigram model the forward table holds the best sum of piece scores and the
piece that ends it. For a BPE model it holds the last piece of the prefix's own
encoding: the encodings of prefixes are prefixes of each other's, so a piece may
follow exactly if the two pieces stay apart when their text is encoded alone.
Either way the back pointers give the pieces, equal to those of the model's own
library. A character without a piece becomes its UTF-8 bytes.

It is one pass without a shuffle; the words a worker remembers are bounded.

Defined results: a null text counts as empty and has no ids; U+2581 in a text is
decoded as a blank, as the format has it; repeated rows are encoded alike; an empty
table gives none; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from struct import pack

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwork.llm.common import table, workers_import

MARK = "▁"
#: Words of each of two generations that a worker remembers, at most.
REMEMBERED = 200_000
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Vocabulary:
    """Pieces and scores of a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        rules = proto.normalizer_spec
        if rules.name != "identity" or not rules.add_dummy_prefix or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that leave texts as they are, with a mark before, are known")
        self.unigram = proto.trainer_spec.model_type == 1
        kinds = [p.type for p in proto.pieces]
        self.texts = [p.piece for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (1, 4)}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type in (1, 4)}
        self.unknown = kinds.index(2)
        self.bytes = {int(self.texts[i][3:5], 16): i for i, k in enumerate(kinds) if k == 6}
        self.raw = [b"" if k == 3 else bytes([int(t[3:5], 16)]) if k == 6 else t.encode() if k != 2 else " ⁇ ".encode() for t, k in zip(self.texts, kinds, strict=True)]
        self.floor = min(self.scores.values(), default=0.0) - 10.0
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces that hold a mark after a letter are not known")


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.apart: dict[tuple[str, str], bool] = {}
        # words met since the last change, and those before it: frequent words outlast it
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # pieces by their letters from the last to the first; "" holds a whole piece
        self.endings: dict = {}
        for piece in vocabulary.ids:
            if len(piece) > 1 and (vocabulary.unigram or len(self.merged(piece)) == 1):
                node = self.endings
                for c in reversed(piece):
                    node = node.setdefault(c, {})
                node[""] = piece

    def merged(self, text: str) -> list[str]:
        """Plain BPE: the adjacent pair with the best score is merged, the first of equals."""
        parts, scores = list(text), self.v.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, a: str, b: str) -> bool:
        key = (a, b)
        got = self.apart.get(key)
        if got is None:
            if len(self.apart) > 2_000_000:
                self.apart.clear()
            got = self.apart[key] = self.merged(a + b) == [a, b]
        return got

    def forward(self, word: str, last: list, value: list, begin: int) -> None:
        """Fills the table for prefixes longer than ``begin``: last[i] is the length
        of the last piece of word[:i]; value[i] is the sum of scores up to there for a
        unigram model, that piece itself for a BPE model."""
        del last[begin + 1 :], value[begin + 1 :]
        endings, scores, unigram, apart = self.endings, self.v.scores, self.v.unigram, self.apart
        for i in range(begin + 1, len(word) + 1):
            node, j, found = endings, i, []
            while j:
                j -= 1
                node = node.get(word[j])
                if node is None:
                    break
                piece = node.get("")
                if piece is not None:
                    found.append(piece)
            size = 1
            if unigram:
                best = value[i - 1] + scores.get(word[i - 1], self.v.floor)
                for piece in found:
                    j = i - len(piece)
                    if value[j] + scores[piece] > best:
                        best, size = value[j] + scores[piece], i - j
            else:
                best = word[i - 1]
                for piece in reversed(found):
                    j = i - len(piece)
                    if j:
                        key = (value[j], piece)
                        stay = apart.get(key)
                        if not (self.may_follow(*key) if stay is None else stay):
                            continue
                    best, size = piece, i - j
                    break
            last.append(size)
            value.append(best)

    def learn(self, words: set[str]) -> None:
        """Remembers the ids of distinct words, walked as a trie."""
        before, last, value = "", [0], [0.0]
        ids, spelled, unknown = self.v.ids, self.v.bytes, self.v.unknown
        for word in sorted(words):
            n = min(len(before), len(word))
            common = 0
            while common < n and before[common] == word[common]:
                common += 1
            self.forward(word, last, value, common)
            out, i = [], len(word)
            while i:
                piece = word[i - last[i] : i]
                k = ids.get(piece)
                if k is not None:
                    out.append(k)
                elif spelled:
                    out += [spelled[b] for b in reversed(piece.encode("utf-8", "replace"))]
                else:
                    out.append(unknown)
                i -= last[i]
            out.reverse()
            self.known[word] = pack(f"<{len(out)}I", *out)
            before = word

    def forget(self) -> None:
        """Lets go of the words."""
        self.known, self.older = {}, {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = [_WORDS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        words = set().union(*cut)
        fresh = words - self.known.keys()
        if len(self.known) + len(fresh) > REMEMBERED:
            self.older, self.known, fresh = self.known, {}, words
        again = fresh & self.older.keys()
        self.known.update((w, self.older[w]) for w in again)
        self.learn(fresh - again)
        get = self.known.__getitem__
        return [b"".join(map(get, part)) for part in cut]


#: Encoders of this process by model file. Words go with the task: a worker may decode
#: next, and what many workers keep adds up.
_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(Vocabulary(path))
    return _ENCODERS[path]


def decode(ids: bytes, vocabulary: Vocabulary) -> str:
    raw = vocabulary.raw
    text = b"".join([raw[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
    return text.replace(MARK, " ").removeprefix(" ")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """``id_col``, ids (binary: little-endian 32-bit), text_crc32 (of the text's UTF-8)."""
    import pyarrow as pa

    workers_import(docs.sparkSession)
    path = model or model_path()

    def run(batches):
        encoder = encoder_of(path)
        for batch in batches:
            texts, at = batch.column(1).to_pylist(), 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size < 1 << 21):
                    size += len(texts[end] or "")
                    end += 1
                part = texts[at:end]
                crcs = [zlib.crc32((t or "").encode("utf-8", "replace")) for t in part]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(encoder.encode(part), pa.binary()), pa.array(crcs, pa.int64())], names=[id_col, "ids", "text_crc32"])
                at = end
        encoder.forget()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary, text_crc32 long")


def decode_column(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The columns of ``encoded`` and decoded, the text of ``ids``."""
    import pyarrow as pa

    workers_import(encoded.sparkSession)
    path = model or model_path()
    place = encoded.columns.index("ids")

    def run(batches):
        vocabulary = encoder_of(path).v
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [decode(x, vocabulary) for x in part.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    spec = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema), "decoded string"])
    return encoded.mapInArrow(run, spec)


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decode_column(encode_column(table(spark, sf_dir, "documents")))
    return found.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), F.length("decoded").cast("long").alias("n_chars"), (F.crc32(F.col("decoded").cast("binary")) == F.col("text_crc32")).alias("round_trip"))
