"""Operator 8: token counts of whole texts by a sentencepiece model.

Arrow batches are cut at safe boundaries: a space whose left neighbour is neither a space nor the
mark that the model writes for one. No piece of a model whose pieces hold that mark in front only
can cross such a place, and the model puts its own mark before every unit, so the lengths of the
units add up to the length of the text. (A model with other pieces is refused.) Equal units are
counted once a worker, in calls of about the same number of bytes.

Results: null or empty text has 0 bytes and 0 tokens; repeated rows give repeated results; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import text_slices
from riskframe.llm.units import UnitMemo, _rows_by_text, worker_memo

MARK = "▁"  # stands for a space in pieces
_ODD = f"  |^ | $|{MARK}"
_RUNS = re.compile(f"[ {MARK}]+[^ {MARK}]*")


def _check(model: bytes) -> None:
    from sentencepiece import sentencepiece_model_pb2 as pb

    spec = pb.ModelProto()
    spec.ParseFromString(model)
    norm = spec.normalizer_spec
    if not norm.add_dummy_prefix or norm.remove_extra_whitespaces or norm.precompiled_charsmap or not norm.escape_whitespaces:
        raise ValueError("cuts at spaces are safe for identity models with a dummy prefix only")
    if any(re.search(f"[^{MARK}]{MARK}", p.piece) for p in spec.pieces):
        raise ValueError("a piece of the model crosses a space")


def _encoder(model: bytes):
    import sentencepiece

    _check(model)
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)

    def lengths(units: list[str]) -> list[range]:
        return [range(len(x)) for x in sp.encode(units, num_threads=1)]

    return lengths


def _cut(text: str) -> list[str]:
    """Units of a text with runs of spaces; the model's own mark replaces the first character of
    each. A run without a word behind it is one token longer than what is left of it."""
    units = _RUNS.findall(" " + text)
    return [u[1:] for u in units]


def _count(memo: UnitMemo, texts: pa.Array) -> np.ndarray:
    odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
    rows, units = _rows_by_text(memo, texts, "", odd, _cut)
    ends = np.concatenate([[0], np.cumsum(units)])
    total = np.concatenate([[0], np.cumsum(memo.lengths[rows])])
    counts = total[ends[1:]] - total[ends[:-1]]
    # the mark alone: sentencepiece gives nothing for an empty unit, but one piece inside a text
    for i in np.flatnonzero(odd):
        units_i = _cut(texts[int(i)].as_py())
        counts[i] += sum(1 for u in units_i if u == "")
    return counts


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes long, n_tokens long) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())  # size of the vocabulary
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = "sp" + hashlib.md5(model.value).hexdigest()
        memo = worker_memo(key, lambda: _encoder(model.value))
        for batch in text_slices(batches):
            texts = pc.fill_null(batch.column("text"), "")
            size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            counts = np.where(size > 0, _count(memo, texts), 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size), pa.array(counts.astype(np.int64))], schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
