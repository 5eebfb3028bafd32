"""Tokenizing by units: a text is cut where its tokenizer can never merge across, equal units are
encoded once by the library, and the ids are gathered back with NumPy.

A unit is a piece of a text that starts at a run of white space. Nothing else is assumed: texts
in which a plain split at single spaces would not give such pieces are cut by a slower rule.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from riskframe.llm.common import expand, spaceless

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: White space in the sense of Unicode's White_Space property (fixed values)
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNITS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_SPACE_RE2 = "[\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}] "

#: units handed to the library at once, and units remembered by a worker
CALL_BYTES, MEMO_UNITS, MEMO_BYTES = 256 << 10, 700_000, 192 << 20


#: kinds of bytes that tell where a unit may be cut again (:func:`cut_parts`); any other byte is 0
_LETTER, _DIGIT, _MARK, _APOSTROPHE, _NEWLINE = 1, 2, 3, 4, 5
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8)] = _LETTER
_KIND[np.frombuffer(b"0123456789", np.uint8)] = _DIGIT
_KIND[ord("'")], _KIND[ord("\n")] = _APOSTROPHE, _NEWLINE
#: by kind << 3 | next kind: no match of the pattern goes from one into the other
_APART = np.zeros(64, bool)
for _a, _next in ((_LETTER, (_DIGIT, _MARK, _APOSTROPHE, _NEWLINE)), (_DIGIT, (_LETTER, _MARK, _APOSTROPHE, _NEWLINE)),
                  (_MARK, (_LETTER, _DIGIT, _NEWLINE)), (_APOSTROPHE, (_NEWLINE,))):
    _APART[[_a << 3 | _b for _b in _next]] = True


class UnitMemo:
    """Ids of the units seen so far. Bounded: it starts anew when it holds ``limit`` units or
    about ``MEMO_BYTES`` bytes of them."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = MEMO_UNITS, joined: Callable | None = None,
                 words: Callable | None = None):
        """``joined``, where the tokenizer allows it, encodes units that end in no white space and begin
        with a space or none as one text and tells them apart again: (ids, ids of each unit). ``words`` gives the ids of the
        units that are words with at most one mark behind (:func:`word_encoder`)."""
        self.encode, self.limit, self.joined, self.words = encode, limit, joined, words
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int32)
        self.room = {"flat": self.flat, "starts": self.starts, "lengths": self.lengths}  # with space to grow
        self.size = 0

    def _append(self, name: str, values: np.ndarray) -> None:
        used = len(getattr(self, name))
        if used + len(values) > len(self.room[name]):
            grown = np.empty((used + len(values)) * 5 // 4, self.room[name].dtype)
            grown[:used] = self.room[name][:used]
            self.room[name] = grown
        self.room[name][used:used + len(values)] = values
        setattr(self, name, self.room[name][:used + len(values)])

    def _known(self, unit: str) -> list[int] | None:
        row = self.rows.get(unit)
        return None if row is None else self.flat[self.starts[row]:self.starts[row] + self.lengths[row]].tolist()

    def lookup(self, units: list[str]) -> np.ndarray:
        """Row of every unit; new ones are encoded in calls of about CALL_BYTES."""
        rows = self.rows
        out = np.fromiter(map(rows.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(out < 0).tolist()
        if not missing:
            return out
        new = list(dict.fromkeys(map(units.__getitem__, missing)))
        at, flats, lengths = 0, [], []
        named: list[str] = []
        if self.words and new:
            found = self.words(new, self._known)
            named, new = list(found), [u for u in new if u not in found]
            n = np.fromiter(map(len, found.values()), np.int64, len(found))
            flats.append(np.fromiter(chain.from_iterable(found.values()), np.int32, int(n.sum())))
            lengths.append(n)
        if self.joined and new:
            whole = [u != "" and (u[0] == " " or not u[0].isspace()) and not u[-1].isspace() for u in new]
            runs = list(compress(new, whole))
            new = runs + [u for u, ok in zip(new, whole) if not ok]
            got, n = self.joined(runs)
            flats.append(got)
            lengths.append(n)
            at = len(runs)
        while at < len(new):
            end, size = at, 0
            while end < len(new) and (end == at or size < CALL_BYTES):
                size += 40 + len(new[end])
                end += 1
            got = self.encode(new[at:end])
            n = np.fromiter(map(len, got), np.int64, len(got))
            flats.append(np.fromiter(chain.from_iterable(got), np.int32, int(n.sum())))
            lengths.append(n)
            at = end
        new = named + new
        base = len(rows)
        rows.update(zip(new, range(base, base + len(new))))
        self.size += sum(map(len, new)) + 100 * len(new)
        n, known = np.concatenate(lengths), len(self.flat)
        self._append("flat", np.concatenate(flats))
        self._append("lengths", n)
        self._append("starts", known + np.cumsum(n) - n)
        out[missing] = np.fromiter(map(rows.__getitem__, map(units.__getitem__, missing)), np.int64, len(missing))
        return out

    def ids(self, rows: np.ndarray) -> np.ndarray:
        return self.flat[expand(self.starts[rows], self.lengths[rows])]

    def start_slice(self) -> None:
        if len(self.rows) > self.limit or self.size > MEMO_BYTES:
            self.clear()


def split_spaces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Pieces between single spaces: offsets by text, dictionary codes, dictionary."""
    parts = pc.split_pattern(texts, " ")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    return offsets - offsets[0], coded.indices.to_numpy(), coded.dictionary


def cut_parts(units: pa.Array, whole: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Units cut again where a byte-level tokenizer's pattern never goes on, and the number of parts of
    each: between ASCII or Latin-1 letters, digits and ASCII marks, and around line feeds.

    A mark run ends at a letter or digit and the other way round; only an apostrophe may go on into
    letters (a contraction), so nothing is cut behind one. White space never goes on from what stands
    before it. Of one or two line feeds between such characters the last stands alone; longer runs, and
    white space or characters of other kinds, are not cut. Units with a text of ``whole`` (tokens that
    are found before the pattern is applied) stay as they are."""
    offsets = np.frombuffer(units.buffers()[1], np.int32)[units.offset:units.offset + len(units) + 1]
    base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    data = np.frombuffer(units.buffers()[2] or b"", np.uint8)[base:base + size]
    starts = (offsets - base).astype(np.int64)
    first = np.zeros(size + 1, bool)
    first[starts] = True
    kind = _KIND[data]
    latin = np.flatnonzero(data == 0xC3)  # a lead byte: U+00C0 to U+00FF, all letters but two
    latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
    kind[latin] = kind[latin + 1] = _LETTER
    cut = np.zeros(size, bool)
    cut[1:] = _APART[kind[:-1] << 3 | kind[1:]]
    # line feeds with a known character behind them and one before the run
    last = np.flatnonzero(kind[:-1] == _NEWLINE)
    last = last[~first[last] & ~first[last + 1] & (kind[last + 1] > 0) & (kind[last + 1] < _NEWLINE)]
    two = kind[last - 1] == _NEWLINE
    two[two] = ~first[last[two] - 1]
    before = last - 1 - two
    known = (kind[before] > 0) & (kind[before] < _NEWLINE)
    cut[last[known] + 1] = True
    cut[last[known & two]] = True
    cut &= ~first[:-1]
    for text in whole:
        for i in np.flatnonzero(pc.match_substring(units, text).to_numpy(zero_copy_only=False)):
            cut[starts[i]:starts[i + 1]] = False
    cuts = np.flatnonzero(cut)
    before = np.searchsorted(cuts, starts)
    bounds = np.empty(len(units) + len(cuts) + 1, np.int32)
    at = np.arange(len(units) + 1) + before
    inner = np.ones(len(bounds), bool)
    inner[at] = False
    bounds[at], bounds[inner] = starts + base, cuts + base
    parts = pa.Array.from_buffers(units.type, len(bounds) - 1, [None, pa.py_buffer(bounds), units.buffers()[2]])
    return parts, np.diff(at)


def _names(texts: pa.Array) -> list[str]:
    """A column of texts as a list, as :func:`spaceless` does it; texts may have spaces."""
    whole = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts)
    names = pc.binary_join(whole, "\0")[0].as_py().split("\0") if len(texts) else []
    return names if len(names) == len(texts) else texts.to_pylist()


def _rows_by_text(memo: UnitMemo, texts: pa.Array, lead: str, odd: np.ndarray,
                  cut: Callable[[str], list[str]], whole: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Memo rows of all units in text order, and the number of units of every text.

    ``lead`` stands before every piece but a text's first; ``odd`` texts are cut by ``cut``. With
    ``whole``, for byte-level tokenizers, pieces are cut into the parts of :func:`cut_parts`.
    """
    memo.start_slice()
    plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
    offsets, codes, words = split_spaces(plain)
    if whole is not None and len(words):
        parts, many = cut_parts(pc.binary_join_element_wise(pa.scalar(lead), words, ""), whole)
        parts = parts.dictionary_encode()
        names, place = _names(parts.dictionary), parts.indices.to_numpy()
        begin, many = (np.cumsum(many) - many)[codes], many[codes]
        place = place[expand(begin, many)]
        rows = memo.lookup(names)[place]
        offsets = np.concatenate([[0], np.cumsum(many)])[offsets]
        firsts = offsets[:-1]
        rows[firsts] = memo.lookup([names[c][len(lead):] for c in place[firsts].tolist()])
    else:
        names = spaceless(words)
        rows = memo.lookup([lead + w for w in names] if lead else names)[codes]
        if lead:
            firsts = offsets[:-1]
            rows[firsts] = memo.lookup([words[int(c)].as_py() for c in codes[firsts]])
    counts = np.diff(offsets)
    if not odd.any():
        return rows, counts
    pieces = np.split(rows, offsets[1:-1])
    for i in np.flatnonzero(odd):
        pieces[i] = memo.lookup(cut(texts[int(i)].as_py()))
    return np.concatenate(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))


def split_ids(memo: UnitMemo, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after another, and the offsets of the texts in them."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    before = np.concatenate([[0], np.cumsum(memo.lengths[rows])])
    return memo.ids(rows), before[ends]


def encode_spaced(memo: UnitMemo, texts: pa.Array, whole: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For tokenizers that keep white space and join one space to the word behind it: units begin
    at a run of white space, which no match of the pattern crosses from the left. ``whole``, for byte-level
    tokenizers: the texts of their added tokens; units are then cut again (:func:`cut_parts`)."""
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, _SPACE_RE2).to_numpy(zero_copy_only=False)
    return split_ids(memo, *_rows_by_text(memo, texts, " ", odd, _UNITS.findall, whole))


def encode_dropped(memo: UnitMemo, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For tokenizers that drop white space: any space is a safe cut."""
    texts = pc.fill_null(texts, "")
    return split_ids(memo, *_rows_by_text(memo, texts, "", np.zeros(len(texts), bool), list))


def load_tokenizer(json_text: str):
    """The tokenizers library's object, without truncation and padding."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(json_text)
    tok.no_truncation()
    tok.no_padding()
    return tok


def library_encoder(tokenizer) -> Callable[[list[str]], list[list[int]]]:
    """encode_batch of the tokenizers library, ids only, without added special tokens. ``tokenizer``: its JSON
    text, or a :func:`load_tokenizer` that others hold too."""
    tok = load_tokenizer(tokenizer) if isinstance(tokenizer, str) else tokenizer
    return lambda units: [e.ids for e in tok.encode_batch_fast(units, add_special_tokens=False)]


#: a word of Latin letters, with the space before it where units have one, and one mark behind
_WORD = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]?)").fullmatch


def word_encoder(tokenizer, lower: bool, spaced: bool) -> Callable:
    """Ids of words by the library's model alone. A pre-tokenizer that takes runs of letters and runs
    of marks apart leaves a word as one piece and the mark behind it as another, and such words are
    the same under NFC, so nothing else of the library would act on them but lower-casing (``lower``).

    The result maps every unit that is a word, and the word of every unit that has a mark behind it, to
    its ids; a word with a mark takes the ids that its word has already. ``tokenizer`` as for :func:`library_encoder`."""
    from tokenizers import pre_tokenizers

    model = (load_tokenizer(tokenizer) if isinstance(tokenizer, str) else tokenizer).model
    byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letter = {b: byte_level.pre_tokenize_str(chr(b))[0][0] for b in range(128)}
    letter |= {b: byte_level.pre_tokenize_str(bytes([0xC3, b]).decode())[0][0][1] for b in range(128, 192)}
    letter[0xC3] = byte_level.pre_tokenize_str("\u00e9")[0][0][0]
    written = str.maketrans(letter)  # of UTF-8 read as Latin-1
    tokenize = model.tokenize

    def ids(word: str) -> list[int]:
        word = word.lower() if lower else word
        return [t.id for t in tokenize(word if word.isascii() and word[0] != " " else word.encode().decode("latin-1").translate(written))]

    marks = {m: ids(m) for m in ".,;:!?"}

    def words(units: list[str], known: Callable[[str], list[int] | None]) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        for unit in units:
            m = _WORD(unit)
            if m and (spaced or unit[0] != " "):
                word, mark = m.groups()
                if not mark:
                    if unit not in out:
                        out[unit] = ids(unit)
                    continue
                first = out.get(word) or known(word)
                if first is None:
                    first = out[word] = ids(word)
                out[unit] = first + marks[mark]
        return out

    return words


def byte_level_joiner(json_text: str, piece_bytes: int = 1 << 10, encode: Callable | None = None) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Encodes units as joined texts, for byte-level models: a token's name has a character for each
    of its bytes, so the bytes before each token say which unit it belongs to. Units end in no white
    space; those that begin without a space get a line feed before them, whose id is left out again.
    ``encode``: a :func:`library_encoder` of the same tokenizer, so that it is held once."""
    parsed, encode = json.loads(json_text), encode or library_encoder(json_text)
    vocab = parsed["model"]["vocab"]
    size = np.zeros(1 + max([*vocab.values(), *(t["id"] for t in parsed["added_tokens"])], default=0), np.int64)
    size[np.fromiter(vocab.values(), np.int64, len(vocab))] = np.fromiter(map(len, vocab), np.int64, len(vocab))
    for t in parsed["added_tokens"]:
        size[t["id"]] = len(t["content"].encode())

    def joined(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not units:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        bare = np.fromiter((u[0] != " " for u in units), bool, len(units))
        if bare.any():
            units = [u if u[0] == " " else "\n" + u for u in units]
        ends = np.cumsum(pc.binary_length(pa.array(units, pa.large_string())).to_numpy())
        cuts = [0, *(np.flatnonzero(np.diff(ends // piece_bytes)) + 1).tolist(), len(units)]
        texts, flats = ["".join(units[a:b]) for a, b in zip(cuts, cuts[1:])], []
        for at in range(0, len(texts), 128):
            flats += [np.array(x, np.int32) for x in encode(texts[at:at + 128])]
        ids = np.concatenate(flats)
        behind = np.cumsum(size[ids])
        last = np.searchsorted(behind, ends)
        if len(ids) != last[-1] + 1 or (behind[last] != ends).any():
            raise ValueError("a token crosses the boundary of a unit")
        n = np.diff(last, prepend=-1)
        if bare.any():
            feeds = (last - n + 1)[bare]
            if (size[ids[feeds]] != 1).any():
                raise ValueError("a token crosses the boundary of a unit")
            ids, n = np.delete(ids, feeds), n - bare
        return ids, n

    return joined


_MEMOS: dict[str, UnitMemo] = {}


def worker_memo(key: str, make: Callable[[], Callable[[list[str]], list[list[int]]]], make_joined: Callable[[Callable], Callable] | None = None,
                limit: int = MEMO_UNITS, make_words: Callable[[], Callable] | None = None) -> UnitMemo:
    """One memo per tokenizer and Python worker; workers are reused from task to task. ``make_joined``
    gets the encoder of ``make``."""
    if key not in _MEMOS:
        _MEMOS.clear()
        encode = make()
        _MEMOS[key] = UnitMemo(encode, limit, make_joined and make_joined(encode), make_words and make_words())
    return _MEMOS[key]
