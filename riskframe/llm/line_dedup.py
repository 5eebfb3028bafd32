"""Operator 1: line de-duplication over all documents, with DataFrame functions only.

A line's key is the line without white space at its ends and with A-Z lower-cased; keys of at
least ``min_chars`` characters take part, as 128-bit hashes. The (hash, document, position) rows are
range-partitioned by hash and by a block of the document's id, so that one key's rows spread over
as many partitions as they need, and sorted by document and position behind them. Streaming
through that order, the first row of each document is found by comparing neighbours; these first
occurrences are summed by hash, partially in each partition before anything is shuffled. A key
that ``min_docs`` documents hold stays in the largest document only.

The result is a bitmap of kept lines for every document, not text: 64 lines a word, and only the
words that drop a line. Joins on hot hashes are sort-merge joins that adaptive execution splits.

Results: null or empty text is one empty line. Rows with equal id and text share one bitmap; rows
with equal id but other text count as one document and have a bitmap each. A null id counts as a
document below all others. An empty table gives no rows. Other columns are passed on by
:func:`deduplicate` and not read by :func:`keep_bitmaps`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import lower_az, materialize, shielded, strip_ascii

MIN_CHARS, MIN_DOCS, BLOCKS = 20, 3, 1024


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _version(text: Column) -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(hash, doc, version, pos) of every line whose key is long enough."""
    lines = docs.select(F.col(id_col).alias("doc"), _version(F.col(text_col)).alias("version"),
                        F.posexplode(_lines(F.col(text_col))).alias("pos", "line"))
    keys = lines.select("doc", "version", "pos", strip_ascii(lower_az(F.col("line"))).alias("key"))
    return keys.where(F.char_length("key") >= min_chars).select(F.unhex(F.md5("key")).alias("hash"), "doc", "version", "pos")


def repeated_keys(found: DataFrame, min_docs: int = MIN_DOCS, blocks: int = BLOCKS) -> DataFrame:
    """(hash, last_doc) of the keys that at least ``min_docs`` documents hold."""
    block = F.pmod(F.xxhash64("doc"), F.lit(blocks)).cast("int")
    dealt = found.select("hash", block.alias("block"), "doc", "pos").repartitionByRange("hash", "block")
    order = Window.partitionBy("hash", "block").orderBy(F.col("doc").desc(), "pos")
    first = F.row_number().over(order) == 1
    changed = ~F.col("doc").eqNullSafe(F.lag("doc").over(order))
    firsts = dealt.select("hash", "doc", (first | changed).alias("first")).where("first")
    return (firsts.groupBy("hash").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("last_doc"))
            .where(F.col("docs") >= min_docs).select("hash", "last_doc"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, version, n_dropped, words) of the documents that lose lines. ``words`` maps the number
    of a 64-line word to its keep bits (bit i: line 64 * word + i stays); absent words keep all."""
    found = materialize(occurrences(docs, min_chars, id_col, text_col), "lines")
    # written first: a join of two plain shuffles lets adaptive execution split a very frequent hash
    repeated = materialize(repeated_keys(found, min_docs), "repeated")
    lost = (found.join(repeated, "hash")
            .where(~F.col("doc").eqNullSafe(F.col("last_doc"))))
    words = (lost.groupBy("doc", "version", F.shiftright("pos", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("bits")))
    return words.groupBy("doc", "version").agg(
        F.sum(F.bit_count("bits").cast("long")).alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("words"))


def deduplicate(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its text cut to the kept lines, and __n_lines and __n_dropped (which replace
    columns of these names; any other column passes, whatever its name)."""
    return shielded(docs.drop("__n_lines", "__n_dropped"), [id_col, text_col],
                    lambda rows: _deduplicate(rows, min_chars, min_docs, id_col, text_col))


def _deduplicate(docs: DataFrame, min_chars: int, min_docs: int, id_col: str, text_col: str) -> DataFrame:
    maps = keep_bitmaps(docs, min_chars, min_docs, id_col, text_col)
    last = F.array_max(F.map_keys("words"))
    dense = maps.select(F.col("doc").alias("__doc"), F.col("version").alias("__version"), F.col("n_dropped").alias("__n_dropped"),
                        F.transform(F.sequence(F.lit(0), last), lambda w: F.coalesce(F.element_at("words", w), F.lit(-1).cast("long"))).alias("__keep"))
    joined = docs.withColumn("__ver", _version(F.col(text_col))).join(
        dense, F.col(id_col).eqNullSafe(F.col("__doc")) & (F.col("__ver") == F.col("__version")), "left")
    lines = _lines(F.col(text_col))
    kept = F.expr("filter(split(coalesce(`{0}`, ''), '\\n', -1), (x, i) -> "
                  "(shiftrightunsigned(coalesce(get(__keep, cast(i div 64 as int)), -1L), i % 64) & 1L) = 1L)".format(text_col))
    out = joined.withColumn("__n_lines", F.size(lines).cast("long"))
    out = out.withColumn("__n_dropped", F.coalesce("__n_dropped", F.lit(0).cast("long")))
    text = F.when(F.col("__n_dropped") == 0, F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return out.withColumn(text_col, text).select(*docs.columns, "__n_lines", "__n_dropped")


def digests(docs: DataFrame) -> DataFrame:
    """The digest columns of operator 1."""
    return deduplicate(docs).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
