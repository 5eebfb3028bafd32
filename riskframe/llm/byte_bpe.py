"""Operator 3: byte-level BPE encoding and decoding from a rank file.

The rank file (one base64 byte string and its rank a line) becomes a model of the tokenizers
library: bytes are written as printable characters, every rank of two or more bytes becomes the
merge that makes it, and the library encodes Arrow batches. Decoding turns ids into their byte
strings by the reversed table, so characters that were split over tokens come out whole.

Results: null or empty text gives no ids and no bytes. Rows are handled one by one: repeated rows
give repeated results, null ids stay null, other columns of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import expand, text_slices
from riskframe.llm.units import encode_spaced, library_encoder, worker_memo


#: text bytes encoded at once
SLICE = 1 << 20


def byte_characters() -> list[str]:
    """The character that stands for every byte: bytes that print as Latin-1 stand for
    themselves, the others get the code points from 256 on, in order."""
    def prints(b: int) -> bool:
        return 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF

    spare = iter(range(256, 512))
    return [chr(b) if prints(b) else chr(next(spare)) for b in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_parts(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts that the ranks below a token's own leave of its bytes."""
    parts = [token[i:i + 1] for i in range(len(token))]
    top = ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], top), i) for i in range(len(parts) - 1))
        if rank >= top:
            raise ValueError(f"rank {top} can't be reached by merges")
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


def tokenizer_json(path: str, pattern: str) -> str:
    """The rank file as a serialized model of the tokenizers library."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, chars = load_ranks(path), byte_characters()
    written = lambda token: "".join(chars[b] for b in token)
    merges = [tuple(map(written, merge_parts(t, ranks))) for t, _ in sorted(ranks.items(), key=lambda x: x[1]) if len(t) > 1]
    tok = Tokenizer(models.BPE(vocab={written(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    tok.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tok.to_str()


def byte_table(model_json: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all ids, one after another, with start and length by id: the reversed table."""
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    vocab = json.loads(model_json)["model"]["vocab"]
    tokens = [b""] * (max(vocab.values(), default=-1) + 1)
    for token, i in vocab.items():
        tokens[i] = bytes(byte_of[c] for c in token)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def _list_array(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", offsets: bool = False) -> DataFrame:
    """(id, ids array<int>) of every text; with ``offsets`` also byte_starts and char_starts, the
    place of every token in the text's UTF-8 bytes and in its characters (of a token that begins
    inside a character, the place of that character)."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(tokenizer_json(ranks_path, pattern))  # size of the vocabulary
    id_type = docs.schema[id_col].dataType
    fields = [T.StructField(id_col, id_type), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if offsets:
        fields += [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("byte_starts", "char_starts")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model.value)
        for batch in text_slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), *coder.encode(batch.column("text"), offsets)], [f.name for f in fields])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, T.StructType(fields))


class Coder:
    """Encoding and decoding of Arrow columns by one model."""

    def __init__(self, model: str):
        self.model = model
        self.flat, self.starts, self.lengths = byte_table(model)

    def encode(self, texts: pa.Array, offsets: bool) -> list[pa.Array]:
        """ids, and with ``offsets`` byte_starts and char_starts."""
        key = "bpe" + hashlib.md5(self.model.encode()).hexdigest()
        memo = worker_memo(key, lambda: library_encoder(self.model))
        ids, ends = encode_spaced(memo, texts)
        columns = [_list_array(ids, ends)]
        if offsets:
            n = self.lengths[ids]
            at = np.cumsum(n) - n
            data = self.flat[expand(self.starts[ids], n)]
            heads = np.cumsum((data & 0xC0) != 0x80)  # characters begun up to each byte
            by_doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            total = np.concatenate([at, [len(data)]])
            doc_byte = total[ends[:-1]]
            chars = np.concatenate([[0], heads])
            columns += [_list_array((at - doc_byte[by_doc]).astype(np.int32), ends),
                        _list_array((heads[at] - 1 - chars[doc_byte][by_doc]).astype(np.int32), ends)]
        return columns

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of one document's ids."""
        return self.flat[expand(self.starts[ids], self.lengths[ids])].tobytes() if len(ids) else b""


_CODERS: dict[str, Coder] = {}


def _coder(model: str) -> Coder:
    """One for a Python worker; workers are reused from task to task."""
    if model not in _CODERS:
        _CODERS.clear()
        _CODERS[model] = Coder(model)
    return _CODERS[model]


def _rows(lists: pa.Array) -> Iterator[np.ndarray]:
    values, ends = pc.list_flatten(lists).to_numpy(), np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
    for a, b in zip(ends[:-1], ends[1:]):
        yield values[a:b]


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded binary): the bytes of every row's ids."""
    model = encoded.sparkSession.sparkContext.broadcast(tokenizer_json(ranks_path, pattern))
    schema = T.StructType([encoded.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(coder.decode, _rows(batch.column(1))), pa.binary())], schema.names)

    return encoded.select(id_col, "ids").mapInArrow(run, schema)


def decode_text(pieces: Iterator[bytes]) -> Iterator[str]:
    """Text of byte pieces that may end inside a character: the rest waits for the next piece."""
    import codecs

    reader = codecs.getincrementaldecoder("utf-8")("replace")
    for piece in pieces:
        yield reader.decode(piece)
    yield reader.decode(b"", True)


def round_trip(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The digest columns of operator 3: every text is encoded with offsets and its ids are decoded
    again. Beside them n_inside, the tokens that begin inside a character, and offsets_hold: each token
    lies in the decoded bytes where its offsets say, and split characters join to the text that was read."""
    model = spark.sparkContext.broadcast(tokenizer_json(ranks_path, pattern))  # size of the vocabulary
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType()), T.StructField("n_inside", T.LongType()), T.StructField("offsets_hold", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model.value)
        for batch in text_slices(batches, limit=SLICE):
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
            rows = []
            for text, ids, starts, chars in zip(texts, *map(_rows, coder.encode(batch.column("text"), True))):
                back = coder.decode(ids)
                data = np.frombuffer(back, np.uint8)
                heads = (data & 0xC0) != 0x80
                inside = ~heads[starts]
                holds = (starts == np.cumsum(coder.lengths[ids]) - coder.lengths[ids]).all() and \
                    (chars == np.cumsum(heads)[starts] - 1).all() and back == text.as_py()
                rows.append((len(ids), hashlib.sha256(" ".join(map(str, ids.tolist())).encode()).hexdigest(), hashlib.sha256(back).hexdigest(), int(inside.sum()), bool(holds)))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in columns)], schema.names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
