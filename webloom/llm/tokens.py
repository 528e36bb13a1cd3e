"""Token ids of whole texts, with one call of the tokenizer for each distinct piece.

The default tokenizer lower-cases, drops white space and splits texts into runs
of letters, single digits and runs of other characters before it merges bytes, so
the ids of a text are those of such pieces, one after the other.  Pieces are found
on the bytes of many texts at once, hashed, encoded once a worker if new, and their
ids gathered by number.  A border is only set where both sides are surely of
different kinds (ASCII and Latin letters, digits, other ASCII); next to an
apostrophe, which the tokenizer treats by context, or any other character, the
text stays in one piece for the tokenizer to split.  Texts are never cut.
"""

from __future__ import annotations

import functools
import os
from pathlib import Path

import numpy as np

from webloom.llm.bytewords import LOWER, span_hashes
from webloom.llm.common import WORKER_CACHES

#: The tokenizer file that queries use if none is given.
DEFAULT_TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Bytes before a special token; texts that hold them are only split at white space.
_SPECIAL = b"<|"

_BLANK, _LETTER, _DIGIT, _OTHER, _OPEN = range(5)


def _kind(b: int) -> int:
    if b == 0x20 or 0x09 <= b <= 0x0D:
        return _BLANK
    if 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or 0xC3 <= b <= 0xC9:  # first bytes of the letters U+00C0 to U+024F
        return _LETTER
    if 0x30 <= b <= 0x39:
        return _DIGIT
    return _OPEN if b >= 0x80 or b == 0x27 or b < 0x20 or b == 0x7F else _OTHER


_KIND = np.array([_kind(b) for b in range(256)], np.uint8)


def tokenizer_path(name_or_path: str = DEFAULT_TOKENIZER) -> str:
    """A path as it is, or the place of a file of the installed public tokenizers."""
    if os.path.isabs(name_or_path):
        return name_or_path
    import public_tokenizers

    return str(public_tokenizers.path(name_or_path))


def piece_spans(data: np.ndarray, offsets: np.ndarray, split: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces, and for each row the index of its first piece (one more at the end)."""
    kind = _KIND[data]
    inside = kind != _BLANK
    border = np.ones(len(data) + 1, bool)
    if split:
        lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC9))
        lead = lead[lead + 1 < len(data)]
        pair = data[lead].astype(np.int32) << 8 | data[lead + 1]
        sign = (pair == 0xC397) | (pair == 0xC3B7) | (pair == 0xC4B0)  # two signs, and the dotted I, whose lower case ends in a mark
        kind[lead + 1] = np.where(sign, _OPEN, _LETTER)
        kind[lead[sign]] = _OPEN
        left, right = kind[:-1], kind[1:]
        border[1:-1] = ((left != right) & (left != _OPEN) & (right != _OPEN)) | ((left == _DIGIT) & (right == _DIGIT)) | (left == _BLANK) | (right == _BLANK)
    else:
        border[1:-1] = inside[1:] != inside[:-1]
    border[offsets] = True
    starts = np.flatnonzero(border[:-1] & inside)
    ends = np.flatnonzero(border[1:] & inside) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class PieceTokenizer:
    """Encodes buffers of texts; keeps the ids of up to ``most`` distinct pieces."""

    def __init__(self, path: str, most: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(Path(path).read_text(encoding="utf-8"))
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.keys = np.empty(0, np.uint64)  # ascending
        self.start = np.empty(0, np.int64)
        self.size = np.empty(0, np.int32)
        self.pool = np.empty(1 << 16, np.int32)
        self.used = 0

    def _add(self, at: np.ndarray, keys: np.ndarray, texts: list[str]) -> None:
        ids = [e.ids for k in range(0, len(texts), 4096) for e in self.tokenizer.encode_batch_fast(texts[k : k + 4096], add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.int32, int(size.sum()))
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty(max(len(self.pool), len(flat)), np.int32)])
        self.pool[self.used : self.used + len(flat)] = flat
        begin = self.used + np.cumsum(size, dtype=np.int64) - size
        self.used += len(flat)
        self.keys, self.start, self.size = np.insert(self.keys, at, keys), np.insert(self.start, at, begin), np.insert(self.size, at, size)

    def _numbers(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each piece, and the index of each row's first piece."""
        raw = data.tobytes()
        split = _SPECIAL not in raw
        starts, ends, first = piece_spans(data, offsets, split)
        if not len(starts):
            return np.empty(0, np.int64), first
        form = LOWER[data] if split else data
        keys, one, back = np.unique(span_hashes(form, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        old = at < len(self.keys)
        new[old] = self.keys[at[old]] != keys[old]
        if new.any():
            raw = form.tobytes()
            self._add(at[new], keys[new], [raw[i:j].decode("utf-8", "replace") for i, j in zip(starts[one[new]].tolist(), ends[one[new]].tolist(), strict=True)])
            at = np.searchsorted(self.keys, keys)
        return at[back], first

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Number of ids of each row."""
        number, first = self._numbers(data, offsets)
        return np.diff(np.concatenate([[0], np.cumsum(self.size[number], dtype=np.int64)])[first])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and the offsets of the rows in them."""
        number, first = self._numbers(data, offsets)
        size = self.size[number].astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[number] - bounds[:-1], size) + np.arange(int(bounds[-1]))
        return self.pool[at], bounds[first]


@functools.lru_cache(maxsize=1)
def worker_tokenizer(path: str) -> PieceTokenizer:
    """The tokenizer of this worker process; what it has learnt serves later tasks too."""
    return PieceTokenizer(path)


WORKER_CACHES.append(worker_tokenizer.cache_clear)
