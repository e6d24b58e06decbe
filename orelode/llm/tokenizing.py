"""Token ids of whole texts by way of their distinct pieces.

A text is cut where every token must end: before a blank or line feed between printing
characters of any script, where ASCII letters, digits and marks meet (but for the apostrophe
and the characters of special tokens), and before a full stop or comma of Chinese text.
Tokens of a piece are then the tokens which the whole text has there, so each distinct
piece is encoded once, and long texts never reach the tokenizer in one go. A stretch in
which nothing can be cut is encoded whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from orelode.llm.arrays import row_blocks, utf8

#: What a worker remembers of one tokenizer: bytes in all (about), and characters of one piece at most.
MEMO_BYTES = 96 << 20
MEMO_PIECE = 64
BLOCK_BYTES = 4 << 20

#: Bytes that an entry of the memo takes besides its piece and ids.
_ENTRY = 130
#: Words that are encoded as one text.
_JOINED = 64

_WHITE, _LETTER, _DIGIT, _MARK, _OTHER = 1, 2, 3, 4, 5
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[[0x20, 0x0A]] = _WHITE
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[list(b"'<|>")] = _OTHER

#: Pairs of kinds between which a token ends.
_PARTED = np.zeros(64, bool)
_PARTED[[8 * a + b for a in (_LETTER, _DIGIT, _MARK) for b in (_LETTER, _DIGIT, _MARK) if a != b]] = True

# Blocks of 64 or 4096 characters, by first and second byte, that hold white space or marks without width.
_DOUBTFUL = {(0xC2, None), (0xCC, None), (0xCD, None), (0xE1, 0x9A), (0xE1, 0xA0), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80), (0xEF, 0xBB)}
_CLEAR = np.zeros((256, 256), bool)
_CLEAR[0xC3:0xF5] = True
for _lead, _second in _DOUBTFUL:
    _CLEAR[_lead, slice(None) if _second is None else _second] = False

_loaded: dict[str, Pieces] = {}


class Pieces:
    """A tokenizer file and the ids of pieces already seen in this worker."""

    def __init__(self, path: str, uncased: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.uncased = Tokenizer.from_file(path), uncased
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u4" if size > 1 << 16 else "<u2")
        # The token that ends a word has a suffix of its own, or the one that begins it holds the blank.
        self.edge = np.zeros(size, bool)
        marked = [i for t, i in self.tokenizer.get_vocab().items() if (t.endswith("</w>") if uncased else t.startswith("Ġ"))]
        self.edge[marked] = True
        self._start_anew()

    def _start_anew(self) -> None:
        self.memo: dict[str, int] = {}
        self.pool, self.used = np.zeros(0, self.dtype), 0
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.size = 0

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and where the ids of each piece begin in it and how many they are."""
        place = list(map(self.memo.get, pieces))
        new = [p for p, known in zip(pieces, place, strict=True) if known is None]
        if self.size + (_ENTRY + 8) * len(new) > MEMO_BYTES and self.memo:
            place = self._keep(pieces, place)
        if new:
            # Long pieces are at the end and forgotten with the next call.
            new.sort(key=lambda p: len(p) > MEMO_PIECE)
            ids, lengths = self._ids(new)
            begin, first = self.used, len(self.memo)
            self.pool = _put(self.pool, begin, ids)
            self.starts = _put(self.starts, first, begin + np.cumsum(lengths) - lengths)
            self.lengths = _put(self.lengths, first, lengths)
            fresh = dict(zip(new, range(first, first + len(new)), strict=True))
            place = [fresh[p] if known is None else known for p, known in zip(pieces, place, strict=True)]
            kept = [p for p in new if len(p) <= MEMO_PIECE]
            self.memo.update((p, fresh[p]) for p in kept)
            self.used += int(lengths[: len(kept)].sum())
            self.size += _ENTRY * len(kept) + sum(map(len, kept)) + int(lengths[: len(kept)].sum()) * self.dtype.itemsize
        where = np.array(place, np.int64)
        pool, starts, lengths = self.pool, self.starts[where], self.lengths[where]
        if pool.nbytes + self.starts.nbytes > MEMO_BYTES:
            self._start_anew()
        return pool, starts, lengths

    def _keep(self, pieces: list[str], place: list[int | None]) -> list[int | None]:
        """Forget all pieces but those asked for now, and tell their new places."""
        old = [(p, i) for p, i in zip(pieces, place, strict=True) if i is not None]
        where = np.array([i for _, i in old], np.int64)
        lengths = self.lengths[where]
        ids = _gather(self.pool, self.starts[where], lengths)
        self._start_anew()
        self.memo = {p: n for n, (p, _) in enumerate(old)}
        self.pool, self.used, self.lengths, self.starts = ids, len(ids), lengths, np.cumsum(lengths) - lengths
        self.size = _ENTRY * len(old) + sum(len(p) for p, _ in old) + ids.nbytes
        return list(map(self.memo.get, pieces))

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after another, and how many each has."""
        ids: list[np.ndarray | None] = [None] * len(pieces)
        # Words of letters are one unit of the tokenizer each, alone or in a row.
        if self.uncased:
            words = [i for i, p in enumerate(pieces) if p.isalpha()]
        else:
            words = [i for i, p in enumerate(pieces) if p[:1] == " " and p[1:].isalpha()]
        for i in range(0, len(words), 64 * _JOINED):
            rows = [words[j : j + _JOINED] for j in range(i, min(i + 64 * _JOINED, len(words)), _JOINED)]
            between = " " if self.uncased else ""
            texts = [between.join([pieces[k] for k in row]) for row in rows]
            for row, e in zip(rows, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                own = np.array(e.ids, self.dtype)
                edges = np.flatnonzero(self.edge[own]) + self.uncased
                # A letter that the tokenizer does not know as one makes more units.
                if len(edges) == len(row):
                    bounds = [0, *edges.tolist()] if self.uncased else [*edges.tolist(), len(own)]
                    for k, a, b in zip(row, bounds, bounds[1:], strict=False):
                        ids[k] = own[a:b]
        rest = [i for i, own in enumerate(ids) if own is None]
        for i in range(0, len(rest), 4096):
            part = rest[i : i + 4096]
            encoded = self.tokenizer.encode_batch_fast([pieces[k] for k in part], add_special_tokens=False)
            for k, e in zip(part, encoded, strict=True):
                ids[k] = np.array(e.ids, self.dtype)
        return np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids))


def pieces_of(path: str, uncased: bool = False) -> Pieces:
    """The worker's copy of a tokenizer."""
    if path not in _loaded:
        _loaded[path] = Pieces(path, uncased)
    return _loaded[path]


def encode_column(column: pa.Array, path: str, uncased: bool = False):
    """For each block of rows: its row range, the ids of its texts one after another, and their offsets.

    ``uncased`` says that the tokenizer ignores case and white space, so that the pieces
    can be folded before they are compared.
    """
    data, offsets = utf8(column)
    for start, stop in row_blocks(offsets, BLOCK_BYTES):
        where = offsets[start : stop + 1]
        yield (start, stop), *_encode_block(data[where[0] : where[-1]], where - where[0], pieces_of(path, uncased))


def count_column(column: pa.Array, path: str) -> np.ndarray:
    """The number of tokens of each text."""
    data, offsets = utf8(column)
    counts = [np.zeros(0, np.int64)]
    tokenizer = pieces_of(path)
    for start, stop in row_blocks(offsets, BLOCK_BYTES):
        where = offsets[start : stop + 1]
        pieces, places, first = _cut(data[where[0] : where[-1]], where - where[0], False)
        lengths = tokenizer.encode(pieces)[2]
        counts.append(_sums(lengths[places], first))
    return np.concatenate(counts)


def _encode_block(data: np.ndarray, offsets: np.ndarray, tokenizer: Pieces) -> tuple[np.ndarray, np.ndarray]:
    pieces, places, first = _cut(data, offsets, tokenizer.uncased)
    pool, starts, lengths = tokenizer.encode(pieces)
    length = lengths[places]
    ids = _gather(pool, starts[places], length)
    return ids, np.concatenate([[0], np.cumsum(length)])[first]


def _gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def _put(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """The array with ``values`` from ``at`` on, longer where it needs to be."""
    if at + len(values) > len(array):
        grown = np.zeros(max(2 * at, at + len(values), 1024), array.dtype)
        grown[:at] = array[:at]
        array = grown
    array[at : at + len(values)] = values
    return array


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def _gaps(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Positions of blanks and line feeds between two printing characters."""
    at = np.flatnonzero(kind[1:-1] == _WHITE) + 1
    before, after = kind[at - 1] > _WHITE, kind[at + 1] > _WHITE
    far = at[~before & (data[at - 1] >= 0x80)]
    if len(far):
        # The first byte of the character before: the nearest that continues none.
        back = np.ones(len(far), np.int64)
        for _ in range(3):
            back += (data[far - back] & 0xC0 == 0x80) & (back < far)
        before[~before & (data[at - 1] >= 0x80)] = _CLEAR[data[far - back], data[far - back + 1]]
    far = at[~after & (data[at + 1] >= 0x80)]
    if len(far):
        second = data[np.minimum(far + 2, len(data) - 1)]
        after[~after & (data[at + 1] >= 0x80)] = _CLEAR[data[far + 1], second]
    return at[before & after]


def _wide_stops(data: np.ndarray) -> np.ndarray:
    """Positions of an ideographic full stop or comma after U+5000 to U+8FFF, all of which are letters."""
    at = np.flatnonzero((data[3:] == 0xE3) | (data[3:] == 0xEF)) + 3
    at = at[(data[at - 3] >= 0xE5) & (data[at - 3] <= 0xE8) & (at + 2 < len(data))]
    stop = (data[at] == 0xE3) & (data[at + 1] == 0x80) & ((data[at + 2] == 0x81) | (data[at + 2] == 0x82))
    return at[stop | (data[at] == 0xEF) & (data[at + 1] == 0xBC) & (data[at + 2] == 0x8C)]


def _cut(data: np.ndarray, offsets: np.ndarray, uncased: bool) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pieces, the piece at each place, and the places before each text."""
    cut, gap = np.zeros(len(data), bool), np.zeros(len(data), bool)
    kind = _KIND[data]
    if len(data) > 2:
        cut[1:] = _PARTED[kind[:-1] * 8 + kind[1:]]
        gap[_gaps(data, kind)] = True
        cut |= gap
        cut[_wide_stops(data)] = True
    edge = offsets[:-1][np.diff(offsets) > 0]
    gap[edge] = False
    cut[edge] = True
    # A blank right before a text's end is no cut: what follows belongs to another text.
    last = offsets[1:][np.diff(offsets) > 0] - 1
    only = gap[last]
    cut[last[only & ~np.isin(last, edge)]] = False
    gap[last] = False
    starts = np.flatnonzero(cut)
    first = np.searchsorted(starts, offsets)
    ends = np.append(starts[1:], len(data))
    if uncased:
        # The white space that a piece begins with makes no token.
        folded = data + np.uint8(32) * ((data >= 65) & (data <= 90))
        lengths = ends - starts - gap[starts]
        data = folded[~gap]
    else:
        lengths = ends - starts
    where = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    column = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(where), pa.py_buffer(np.ascontiguousarray(data))]
    )
    coded = column.dictionary_encode()
    return coded.dictionary.cast(pa.large_string()).to_pylist(), coded.indices.to_numpy(), first
