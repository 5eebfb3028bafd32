"""Operator 13: spelling variants of words, by k-d trees over letter counts.

One edit changes the letter counts by at most two: a replaced letter takes one away and adds one,
an inserted one adds one. So the near words of a word lie in a small box search around its letter
counts, among the words of its own length (one up, one down) and of the next length (one up). Each
pair of lengths is searched on its own.

Words are dealt to the cells of one k-d tree per length, and every word is sent as a query to all
cells whose box it may reach. The trees' splits come from a sample of at most about SAMPLE words; they
only decide where words go, so every near pair is found whatever the sample. A cell with more than
CELL words, or very long ones, is dealt into blocks, and its queries go to each. A task builds a
k-d tree with tight boxes over a block and walks it with all queries at once, pruning by the boxes;
what shares a leaf is verified letter by letter.

Results: a null text has no words; a null id counts as an empty string before the colon. Repeated
rows count again. Near words of equal count tie by code points. An empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import materialize, text_slices

#: words sampled for the splits, words of a cell, letters of a block, words of a leaf
SAMPLE, CELL, BLOCK_LETTERS, LEAF = 100_000, 16_384, 32 << 20, 32
#: bytes of a text searched at once; distinct words a task gathers before it sends them; words and letters of queries at once
WINDOW, HELD, QUERIES, QUERY_LETTERS = 1 << 20, 400_000, 8192, 4 << 20
#: dimensions: a-z, U+00C0 to U+00FF, and one for the letters that no indexed word has
DIMS = 26 + 64
#: runs of the letters in lower-cased UTF-8: U+00C0 to U+00FF are 0xC3 and one byte
_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
_NO_RUN = re.compile(rb"[^a-z\x80-\xff]")


def _letter_dims() -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[97:123] = np.arange(26)
    out[192:] = np.arange(26, 90)
    return out


_DIM = _letter_dims()


def runs(data: bytes) -> Iterator[list[bytes]]:
    """The runs of a lower-cased text in UTF-8, by windows that end outside of a run."""
    at = 0
    while at < len(data):
        cut = _NO_RUN.search(data, at + WINDOW) if at + WINDOW < len(data) else None
        end = cut.end() if cut else len(data)
        yield _RUN.findall(data, at, end)
        at = end


def add_words(total: Counter, doc_id: int | None, data: bytes) -> None:
    """Count the words of a text; one in 97 kinds of runs of a document loses a letter."""
    start = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
    for found in runs(data.lower()):
        total.update(found)
        hit = {w: h for w in set(found) if not (h := zlib.crc32(w, start)) % 97}
        if hit:
            for w, n in Counter(filter(hit.__contains__, found)).items():
                total[w] -= n
                letters = w.decode()
                k = hit[w] % len(letters)
                total[(letters[:k] + letters[k + 1:]).encode()] += n


def vocabulary(docs: DataFrame, id_col: str, text_col: str, least_letters: int, least_uses: int) -> DataFrame:
    """(word, n) of the words that count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = [w for w, n in total.items() if n and len(w) - w.count(b"\xc3") >= least_letters]
            counts = [total[w] for w in words]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

        for batch in text_slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), pc.fill_null(batch.column("text").cast(pa.binary()), b"")):
                add_words(total, doc_id, text.as_py())
                if len(total) > HELD:
                    yield out()
        if total:
            yield out()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_uses)


def letters_of(words: list[str]) -> np.ndarray:
    """Words of one length as rows of their code points."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def counts_of(letters: np.ndarray) -> np.ndarray:
    """Letter counts of words of one length."""
    n, length = letters.shape
    flat = (_DIM[letters] + np.arange(n)[:, None] * DIMS).ravel()
    return np.bincount(flat, minlength=n * DIMS).reshape(n, DIMS).astype(np.int32)


@dataclass
class Tree:
    """A k-d tree. Node i splits by count[dim] <= at; a leaf has left = -1 and rows start to stop
    of ``order``. lo and hi are the node's box: of its points, or of the whole cell if ``cells``."""

    points: np.ndarray
    leaf: int
    cells: bool = False
    dim: list = field(default_factory=list)
    at: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    start: list = field(default_factory=list)
    stop: list = field(default_factory=list)
    lo: list = field(default_factory=list)
    hi: list = field(default_factory=list)

    def __post_init__(self) -> None:
        self.order = np.arange(len(self.points))
        dims = self.points.shape[1]
        todo = [(self._node(0, len(self.points)), np.zeros(dims, np.int32), np.full(dims, np.iinfo(np.int32).max, np.int32))]
        while todo:
            node, lo, hi = todo.pop()
            rows = self.order[self.start[node]:self.stop[node]]
            x = self.points[rows]
            if not self.cells and len(x):
                lo, hi = x.min(axis=0), x.max(axis=0)
            self.lo[node], self.hi[node] = lo, hi
            split = _split(x) if len(x) > self.leaf else None
            if split is None:
                continue
            dim, at = split
            below = x[:, dim] <= at
            middle = self.start[node] + int(below.sum())
            self.order[self.start[node]:self.stop[node]] = np.concatenate([rows[below], rows[~below]])
            self.dim[node], self.at[node] = dim, at
            self.left[node], self.right[node] = self._node(self.start[node], middle), self._node(middle, self.stop[node])
            low_hi, high_lo = hi.copy(), lo.copy()
            low_hi[dim], high_lo[dim] = at, at + 1
            todo += [(self.left[node], lo, low_hi), (self.right[node], high_lo, hi)]
        if self.cells:
            self.points = self.order = None

    def _node(self, start: int, stop: int) -> int:
        for values, x in ((self.dim, 0), (self.at, 0), (self.left, -1), (self.right, -1), (self.start, start), (self.stop, stop), (self.lo, None), (self.hi, None)):
            values.append(x)
        return len(self.dim) - 1

    def home(self, counts: np.ndarray) -> np.ndarray:
        """The leaf that each vector lies in."""
        out = np.zeros(len(counts), np.int64)
        todo = [(0, np.arange(len(counts)))]
        while todo:
            node, rows = todo.pop()
            if self.left[node] < 0:
                out[rows] = node
            elif len(rows):
                below = counts[rows, self.dim[node]] <= self.at[node]
                todo += [(self.left[node], rows[below]), (self.right[node], rows[~below])]
        return out

    def reach(self, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves and the vectors that may reach them by at most ``up`` added and ``down`` removed letters."""
        todo = [(0, np.arange(len(counts)))]
        while todo:
            node, rows = todo.pop()
            x = counts[rows]
            fits = np.maximum(self.lo[node] - x, 0).sum(axis=1) <= up
            fits &= np.maximum(x - self.hi[node], 0).sum(axis=1) <= down
            rows = rows[fits]
            if not len(rows):
                continue
            if self.left[node] < 0:
                yield node, rows
            else:
                todo += [(self.left[node], rows), (self.right[node], rows)]


def _split(x: np.ndarray) -> tuple[int, int] | None:
    """The dimension and count that part the points most evenly; None if all are equal."""
    best, choice = 0, None
    middle = np.median(x, axis=0).astype(np.int32)
    for at in (middle, middle - 1):
        below = (x <= at).sum(axis=0)
        even = np.minimum(below, len(x) - below)
        d = int(even.argmax())
        if even[d] > best:
            best, choice = int(even[d]), (d, int(at[d]))
    return choice


def near(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows are one replaced letter apart (equal lengths), or one inserted letter."""
    n = short.shape[1]
    if long.shape[1] == n:
        return (short != long).sum(axis=1) == 1
    head, tail = short == long[:, :n], short == long[:, 1:]
    before = np.where(head.all(axis=1), n, head.argmin(axis=1))
    behind = np.where(tail.all(axis=1), n, tail[:, ::-1].argmin(axis=1))
    return before + behind >= n


def _halves(letters: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the letters before and from a place on: an edit leaves one of two halves as it is."""
    powers = np.power(np.uint64(0x9E3779B97F4A7C15), np.arange(1, letters.shape[1] + 1, dtype=np.uint64))
    x = letters.astype(np.uint64) + np.uint64(1)
    return (x[:, :first] * powers[:first]).sum(axis=1), (x[:, first:] * powers[:letters.shape[1] - first]).sum(axis=1)


class Block:
    """The indexed words of a cell's block (all of one length), searched for the near words of queries."""

    def __init__(self, words: list[str]):
        self.letters = letters_of(words)
        counts = counts_of(self.letters)
        self.used = np.flatnonzero(counts.any(axis=0))
        self.tree = Tree(counts[:, self.used], LEAF)
        self.length = self.letters.shape[1]
        self.halves: dict[int, tuple] = {}

    def search(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(query, indexed word) of the near pairs; the queries have this length or one letter less."""
        letters = letters_of(words)
        shorter = self.length - letters.shape[1]
        counts = counts_of(letters)
        inside = counts[:, self.used]
        foreign = counts.sum(axis=1) - inside.sum(axis=1)  # these letters can only be removed
        down = 0 if shorter else 1
        possible = np.flatnonzero(foreign <= down)
        middle = letters.shape[1] // 2
        h, t = _halves(letters, middle)
        if shorter not in self.halves:
            head = _halves(self.letters, middle)[0]
            self.halves[shorter] = head, _halves(self.letters, middle + shorter)[1]
        heads, tails = self.halves[shorter]
        out_q, out_w = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for leaf, rows in self.tree.reach(inside[possible], 1, down):
            q, w = possible[rows], self.tree.order[self.tree.start[leaf]:self.tree.stop[leaf]]
            i, j = np.nonzero((h[q][:, None] == heads[w]) | (t[q][:, None] == tails[w]))
            sure = near(letters[q[i]], self.letters[w[j]])
            out_q.append(q[i[sure]])
            out_w.append(w[j[sure]])
        return np.concatenate(out_q), np.concatenate(out_w)


def cell_trees(vocab: DataFrame, total: int, cell: int, sample: int) -> dict[int, Tree]:
    """A tree per length, from a sample by the words' hash."""
    share = min(1.0, sample / max(total, 1))
    picked = vocab.where(F.abs(F.xxhash64("word") / float(1 << 63)) < share) if share < 1 else vocab

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows in _by_length(batch.column("word")):
                counts = counts_of(letters_of(batch.column("word").take(pa.array(rows)).to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), length)), pa.array([c.tobytes() for c in counts], pa.binary())], ["length", "counts"])

    found = picked.select("word").mapInArrow(run, "length long, counts binary").toPandas()  # about ``sample`` rows at most
    return {int(k): Tree(np.frombuffer(b"".join(v["counts"]), np.int32).reshape(len(v), DIMS), max(1, int(cell * share)), cells=True)
            for k, v in found.groupby("length")}


def _by_length(words: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    lengths = pc.utf8_length(words).to_numpy()
    for n in np.unique(lengths):
        yield int(n), np.flatnonzero(lengths == n)


def dealt(vocab: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """(length, cell, asks, word, n): every word in its cell, and as a query in the cells it may reach."""
    shared = vocab.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, every in _by_length(batch.column("word")):
                step = max(1, min(QUERIES, QUERY_LETTERS // length))
                for at in range(0, len(every), step):
                    part = every[at:at + step]
                    counts = counts_of(letters_of(batch.column("word").take(pa.array(part)).to_pylist()))
                    found = []
                    for goal, up, down, asks in ((length, 0, 0, False), (length, 1, 1, True), (length + 1, 1, 0, True)):
                        tree = shared.value.get(goal)
                        if tree is None:  # no sampled word of this length: one cell
                            found.append((goal, np.zeros(len(part), np.int64), asks, part))
                        elif not asks:
                            found.append((goal, tree.home(counts), asks, part))
                        else:
                            found += [(goal, np.full(len(rows), leaf), asks, part[rows]) for leaf, rows in tree.reach(counts, up, down)]
                    rows = pa.array(np.concatenate([f[3] for f in found]))
                    sizes = [len(f[3]) for f in found]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat([f[0] for f in found], sizes).astype(np.int32)), pa.array(np.concatenate([f[1] for f in found]).astype(np.int32)),
                        pa.array(np.repeat([f[2] for f in found], sizes)), batch.column("word").take(rows), batch.column("n").take(rows)],
                        ["length", "cell", "asks", "word", "n"])

    return vocab.select("word", "n").mapInArrow(run, "length int, cell int, asks boolean, word string, n long")


def near_pairs(vocab: DataFrame, cell: int = CELL, sample: int = SAMPLE, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """(word, n, other, other_n) of all near words, both ways."""
    trees = cell_trees(vocab, vocab.count(), cell, sample)
    rows = dealt(vocab, trees)
    words = materialize(rows.where("not asks"), "cells")
    size = F.greatest(F.ceil(F.count(F.lit(1)) / (2 * cell)), F.ceil(F.sum("length") / block_letters)).cast("int")
    blocks = words.groupBy("length", "cell").agg(size.alias("blocks"))  # one row a leaf of the trees
    blocks = materialize(blocks, "blocks")
    members = words.join(blocks, ["length", "cell"]).withColumn("block", F.pmod(F.xxhash64("word"), "blocks").cast("int"))
    asking = (rows.where("asks").join(F.broadcast(blocks), ["length", "cell"])
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    cols = ["length", "cell", "block", "asks", "word", "n"]
    met = members.select(cols).union(asking.select(cols)).withColumn("size", F.char_length("word"))
    met = met.repartition("length", "cell", "block").sortWithinPartitions("length", "cell", "block", "asks", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, words, counts, block = None, [], [], None
        for batch in batches:
            where = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "cell", "block", "asks", "size")])
            cuts = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(where)]):
                if a == b:
                    continue
                if here != tuple(where[a, :3]):
                    here, words, counts, block = tuple(where[a, :3]), [], [], None
                part = batch.slice(int(a), int(b - a))
                if not where[a, 3]:
                    words += part.column("word").to_pylist()
                    counts.append(part.column("n").to_numpy())
                    continue
                if not words:
                    continue
                if block is None:
                    block, uses, names = Block(words), np.concatenate(counts), pa.array(words, pa.string())
                step = max(1, min(QUERIES, QUERY_LETTERS // int(where[a, 4])))
                for at in range(0, part.num_rows, step):
                    asked = part.slice(at, step)
                    q, w = block.search(asked.column("word").to_pylist())
                    if not len(q):
                        continue
                    one = [asked.column("word").take(pa.array(q)), asked.column("n").take(pa.array(q))]
                    other = [names.take(pa.array(w)), pa.array(uses[w])]
                    yield pa.RecordBatch.from_arrays([*one, *other], ["word", "n", "other", "other_n"])
                    if where[a, 4] < where[a, 0]:  # longer words are not asked about shorter ones
                        yield pa.RecordBatch.from_arrays([*other, *one], ["word", "n", "other", "other_n"])

    return met.select("length", "cell", "block", "asks", "size", "word", "n").mapInArrow(run, "word string, n long, other string, other_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words that have a form, by pointer jumping. Counts at least double from
    form to form, so a chain is no longer than the logarithm of the largest count."""
    step = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        behind = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step_on = step.join(behind, "root", "left")
        if step_on.where("next is not null").isEmpty():
            return step
        step = materialize(step_on.select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 5, least_uses: int = 3,
             cell: int = CELL, sample: int = SAMPLE, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    vocab = materialize(vocabulary(docs, id_col, text_col, least_letters, least_uses), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("form")))
    found = (near_pairs(vocab, cell, sample, block_letters).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("x"))
             .withColumn("form_n", -F.col("x.n")).withColumn("has", F.col("form_n") >= 2 * F.col("n"))
             .select("word", "n_near", F.when(F.col("has"), F.col("x.form")).alias("form"), F.when(F.col("has"), F.col("form_n")).alias("form_n")))
    found = materialize(found, "near")
    ends = roots(found.where("form is not null"))
    return (vocab.join(found, "word", "left").join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
