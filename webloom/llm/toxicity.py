"""Toxicity: noisy-channel deobfuscation, then a score of the restored words.

A disguised word (``1d10t``, ``i d i o t``, ``idiooot``, ``id.i.ot``) is read as
the output of a noisy channel.  Every character spans arcs of a lattice: itself, the
letters that it can stand for, nothing (separators) or one or two letters (a run
of one letter).  A Viterbi search finds the path that is likeliest under a
character language model and the costs of the channel.  The language model counts
character trigrams of all documents, with those of the learnt toxic words mixed in.
Only words that look disguised are decoded, each once a worker.

What is toxic is learnt from labels: words and beginnings of words are picked greedily by how well they tell
the labelled toxic documents that no earlier word explains from the others, and a
logistic regression over the picked words gives the score.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.bytewords import _BYTE, _STEP, ALNUM, LOWER, NOT_BLANK, byte_classes, inverse_powers, mix, powers, span_hashes, word_spans
from webloom.llm.common import crc_bucket, lean, row_slices, string_buffers, written
from webloom.llm.quality import sampled

#: Labelled rows that words are picked from, at most.
SAMPLE_ROWS = 20_000
#: A word must be so many times as frequent among toxic documents as among others.
TIMES = 4.0
#: Counts of words that a task holds before it passes them on.
HELD_COUNTS = 200_000
#: Weight of the learnt words in the language model, as a share.
WORDS_SHARE = 0.5

# Letters that other characters can stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "[": "c", "€": "e", "£": "l", "¥": "y", "¢": "c", "§": "s",
    "а": "a", "е": "e", "і": "i", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "ο": "o", "α": "a", "ι": "i",
    "á": "a", "à": "a", "â": "a", "ä": "a", "ã": "a", "å": "a", "é": "e", "è": "e", "ê": "e", "ë": "e", "í": "i", "ì": "i", "î": "i", "ï": "i",
    "ó": "o", "ò": "o", "ô": "o", "ö": "o", "õ": "o", "ø": "o", "ú": "u", "ù": "u", "û": "u", "ü": "u", "ñ": "n", "ç": "c",
}
#: Characters that can be put between letters.
SEPARATORS = " .-_*,'’`~:;/\\­​‌‍·•"

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Symbols of the language model: 0 is the border of a word, 1 to 26 the letters, 27 any other letter.
_SYMBOL = {c: i + 1 for i, c in enumerate(_LETTERS)}
_SIZE = 28
_SYMBOL_OF_BYTE = np.array([_SYMBOL.get(chr(LOWER[b]), 27 if b >= 0x80 else 0) for b in range(256)], np.int64)


def trigram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of trigrams of symbols in all texts; borders are squeezed to two."""
    code = _SYMBOL_OF_BYTE[np.insert(data, offsets, np.uint8(0x20))]
    twin = np.insert(data, offsets, np.uint8(0x20))
    keep = np.ones(len(code), bool)
    keep[1:] = ~((twin[1:] >= 0x80) & (twin[1:] < 0xC0))  # one symbol for each character
    code = code[keep]
    edge = code == 0
    more = np.ones(len(code), bool)
    more[1:] = ~(edge[1:] & edge[:-1])
    code = code[more]
    code = np.repeat(code, np.where(code == 0, 2, 1))
    if len(code) < 3:
        return np.zeros(_SIZE**3, np.int64)
    return np.bincount((code[:-2] * _SIZE + code[1:-1]) * _SIZE + code[2:], minlength=_SIZE**3)


def language_model(corpus: np.ndarray, words: list[str]) -> np.ndarray:
    """Log probability of a symbol after two others: the corpus' trigrams mixed with those of the words."""

    def conditional(counts: np.ndarray) -> np.ndarray:
        three = counts.reshape(_SIZE, _SIZE, _SIZE).astype(np.float64)
        two = three.sum(0)
        one = two.sum(0)
        p1 = (one + 1) / (one.sum() + _SIZE)
        p2 = (two + 3 * p1) / (two.sum(1, keepdims=True) + 3)
        return (three + 3 * p2) / (three.sum(2, keepdims=True) + 3)

    p = conditional(corpus)
    if words:
        text = np.frombuffer(" ".join(words).encode(), np.uint8)
        own = trigram_counts(text, np.array([0, len(text)]))
        q = conditional(own * 50)
        seen = own.reshape(_SIZE, _SIZE, _SIZE).sum(2, keepdims=True) > 0
        p = np.where(seen, (1 - WORDS_SHARE) * p + WORDS_SHARE * q, p)
    return np.log(p)


#: Costs of the channel, as log probabilities.
_AS_IS, _STAND, _SKIP, _KEEP_SIGN, _RUN, _BREAK = 0.0, -1.0, -0.7, -7.0, -0.4, -3.0
#: Costs of a blank between pieces that are not all single letters: there a blank is what it looks like, most often.
_WORD_BLANK = (-6.0, 0.0)


def decode(token: str, model: np.ndarray, blank: tuple[float, float] = (_SKIP, _BREAK)) -> str:
    """The likeliest words behind ``token``, blank-separated: Viterbi over its lattice, on pairs of symbols.

    ``blank`` has the costs of a blank that was put in and of one that parts words.
    """
    spans = [(m[1], len(m[0])) for m in re.finditer(r"(.)\1*", token.lower(), re.S)]
    # the best path to each pair of symbols: its score and its last step, which knows the one before
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    table = model.tolist()
    for char, n in spans:
        arcs: list[tuple[str, float]] = []
        if char in _SYMBOL:
            arcs = [(char, _AS_IS if n == 1 else _RUN), *([(char * 2, _AS_IS if n == 2 else _RUN)] if n > 1 else [])]
        else:
            arcs = [x for c in STANDS_FOR.get(char, "") for x in ((c, _STAND), *([(c * 2, _STAND)] if n > 1 else []))]
            if char in SEPARATORS:
                skip, part = blank if char == " " else (_SKIP, _BREAK)
                arcs += [("", skip), (" ", part)]
            elif char.isalpha():
                arcs.append((char, _KEEP_SIGN if arcs else _AS_IS))
            else:
                arcs += [(" ", _KEEP_SIGN if arcs else _BREAK), *([("", _KEEP_SIGN)] if not arcs else [])]
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, path) in states.items():
            for out, cost in arcs:
                x, y, s = a, b, score + cost
                for c in out:
                    z = 0 if c == " " else _SYMBOL.get(c, 27)
                    if z == 0 and y == 0:
                        continue
                    s += table[x][y][z]
                    x, y = (0, 0) if z == 0 else (y, z)
                known = after.get((x, y))
                if known is None or s > known[0]:
                    after[(x, y)] = (s, (path, out))
        states = after or states
    best = max(states.items(), key=lambda kv: kv[1][0] + (table[kv[0][0]][kv[0][1]][0] if kv[0][1] else 0))
    out, path = [], best[1][1]
    while path is not None:
        path, step = path
        out.append(step)
    return "".join(reversed(out))


#: Lengths in bytes of the beginnings of words that can be picked like whole words, written ``stem*``.
STEMS = (4, 5, 6)
_LETTER = byte_classes(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
_ASCII_LETTER = byte_classes(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)


def _skeleton_of(char: str) -> str:
    """One letter for all that a character can stand for or be mistaken for; empty for separators."""
    char = STANDS_FOR.get(char, char)[0]
    return {"l": "i", "g": "b"}.get(char, char)


def _pair_table() -> np.ndarray:
    """For two-byte characters: the skeleton letter, or 0 if they are letters of their own, or 1 to drop them."""
    out = np.zeros(1 << 16, np.uint8)
    for char in [*STANDS_FOR, *(c.upper() for c in STANDS_FOR if len(c.upper()) == 1), *SEPARATORS]:
        raw = char.encode()
        if len(raw) == 2:
            out[raw[0] << 8 | raw[1]] = ord(_skeleton_of(char.lower())) if char not in SEPARATORS else 1
    for code in range(0x80, 0x800):
        raw = chr(code).encode()
        if not out[raw[0] << 8 | raw[1]] and not chr(code).isalpha():
            out[raw[0] << 8 | raw[1]] = 1
    return out


_PAIR = _pair_table()
#: Marks that stand for no letter go like separators: the lattice can drop them or part words there.
_GONE = {chr(b) for b in range(0x80) if NOT_BLANK[b] and not ALNUM[b] and chr(b) not in STANDS_FOR} | set(SEPARATORS)
_SINGLE = np.array([0x20 if not NOT_BLANK[b] else 1 if b < 0x80 and chr(b) in _GONE else ord(_skeleton_of(chr(LOWER[b]))) if b < 0x80 else b for b in range(256)], np.uint8)


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII letters and the accented capitals U+00C0 to U+00DE in lower case."""
    out = LOWER[data]
    at = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) else np.empty(0, np.int64)
    at = at[(data[at] >= 0x80) & (data[at] <= 0x9E) & (data[at] != 0x97)]
    out[at] += 0x20
    return out


def plain_words(text: str) -> list[str]:
    """Runs of letters (bytes of ASCII letters or of other characters), lower-cased, as the scorer finds them."""
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), _LETTER)
    raw = lowered(data).tobytes()
    return [raw[i:j].decode("utf-8", "replace") for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]


def with_stems(word: str) -> list[str]:
    """A word and its beginnings, but those that would end inside a character."""
    raw = word.encode()
    return [word, *(raw[:k].decode() + "*" for k in STEMS if len(raw) > k and raw[k] & 0xC0 != 0x80)]


def _elements(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Skeleton bytes of a text before runs are squeezed, where each came from and from how many bytes.

    Look-alikes become one letter, separators go; blanks stay.
    """
    form = _SINGLE[data]
    n = len(data)
    pair = np.zeros(n, np.uint8)
    if n > 1:
        pair[:-1] = _PAIR[data[:-1].astype(np.int64) << 8 | data[1:]] * (data[:-1] >= 0xC2)
    two = np.flatnonzero(pair)
    form[two], form[np.minimum(two + 1, n - 1)] = pair[two], 1
    width = 1 + (pair > 1)
    lead = np.flatnonzero(data >= 0xE2)
    lead = lead[lead < n - 2]
    # marks of three bytes: dashes, quotes, characters without width, symbols, CJK punctuation
    wide = lead[((data[lead] == 0xE2) & (data[lead + 1] < 0xB0)) | ((data[lead] == 0xE3) & (data[lead + 1] == 0x80))]
    for k in range(3):
        form[wide + k] = 1
    euro = wide[(data[wide] == 0xE2) & (data[wide + 1] == 0x82) & (data[wide + 2] == 0xAC)]
    form[euro], width[euro] = ord("e"), 3
    pictures = lead[(data[lead] == 0xF0) & (data[lead + 1] == 0x9F)]
    for k in range(4):
        form[np.minimum(pictures + k, n - 1)] = 1
    at = np.flatnonzero(form != 1)
    return form[at], at, width[at]


class _Spans:
    """The skeleton of many texts without blanks, and where words can begin and end in it.

    Elements are the characters that are left, groups are runs of equal elements.  A
    *cut* is a place between two elements that something parts: a blank, a separator, a
    mark or the end of a row.  Cuts part *fragments*, blanks part *pieces*.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        form, at, width = _elements(data)
        solid = form != 0x20
        blanks = np.cumsum(~solid)[solid]
        self.at, form, width = at[solid], form[solid], width[solid]
        self.stop = self.at + width
        n = len(form)
        self.row = np.searchsorted(offsets, self.at, "right") - 1
        self.firm = ALNUM[data[self.at]]
        new_row = np.ones(n, bool)
        new_row[1:] = self.row[1:] != self.row[:-1]
        new_piece = new_row.copy()
        new_piece[1:] |= blanks[1:] != blanks[:-1]
        cut = np.ones(n + 1, bool)
        cut[1:-1] = new_piece[1:] | (self.at[1:] > self.stop[:-1]) | ~self.firm[1:] | ~self.firm[:-1]
        self.cut = cut
        self.piece = np.cumsum(new_piece) - 1
        self.fragment = np.cumsum(cut[:-1]) - 1
        self.letters = np.bincount(self.fragment, self.firm).astype(np.int64)  # of each fragment
        size, letters = np.bincount(self.piece), np.bincount(self.piece, self.firm)
        self.single = ((letters == 1) | (size == 1))[self.piece]  # in a piece of one letter, but for marks
        head = new_row.copy()
        head[1:] |= (form[1:] != form[:-1]) | (form[1:] >= 0x80)
        self.group = np.flatnonzero(head)
        self.edge = np.append(self.group, n)
        self.begins = np.logical_or.reduceat(cut[:-1], self.group) if n else np.empty(0, bool)
        self.ends = np.logical_or.reduceat(cut[1:], self.group) if n else np.empty(0, bool)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[form[self.group]] * powers(len(self.group)), dtype=np.uint64)])
        self.data, self.odd = data, np.concatenate([[0], np.cumsum(~_ASCII_LETTER[data])])

    def hashes(self, start: np.ndarray, size: int) -> np.ndarray:
        """As ``span_hashes`` of the ``size`` groups from each of ``start``."""
        return mix((self.sums[start + size] - self.sums[start]) * inverse_powers(len(self.group))[start] + np.uint64(size * int(_STEP) & (1 << 64) - 1))

    def plain(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Whether the bytes from element ``first`` to ``last`` are ASCII letters only and the bytes around them no others."""
        a, b = self.at[first], self.stop[last]
        return (self.odd[b] == self.odd[a]) & ~self.wide_around(a, b)

    def wide_around(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.data[np.maximum(a - 1, 0)] >= 0x80) | (self.data[np.minimum(b, len(self.data) - 1)] >= 0x80)


def skeletons(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Skeleton bytes of all texts, where each byte came from, which came from letters or digits, and the row offsets.

    Look-alikes become one letter, separators go, runs of one letter are squeezed;
    blanks stay.
    """
    n = len(data)
    form, at, _ = _elements(data)
    same = np.zeros(len(at), bool)
    same[1:] = (form[1:] == form[:-1]) & (form[1:] < 0x80) & (form[1:] != 0x20)
    same[np.searchsorted(at, offsets[(offsets > 0) & (offsets < n)]).clip(max=max(0, len(at) - 1))] = False
    at, form = at[~same], form[~same]
    return form, at, ALNUM[data[at]], np.searchsorted(at, offsets)


def _hash_words(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    size = np.array([len(r) for r in raw], np.int64)
    ends = np.cumsum(size + 1) - 1
    return span_hashes(np.frombuffer(b" ".join(raw) + b" ", np.uint8), ends - size, ends)


def _found(hashes: np.ndarray, keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``hashes`` are among the ascending ``keys``, and the number of each."""
    if not len(keys) or not len(hashes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.searchsorted(keys, hashes).clip(max=len(keys) - 1)
    hit = np.flatnonzero(keys[at] == hashes)
    return hit, order[at[hit]]


class Scorer:
    """Logistic regression over the picked words and stems and whether any occurs, on restored text."""

    def __init__(self, words: list[str], weights: np.ndarray, any_weight: float, bias: float, model: np.ndarray | None):
        self.words, self.weights, self.any_weight, self.bias, self.model = words, weights, any_weight, bias, model
        self.number = {w: i for i, w in enumerate(words)}
        self.memory: dict[bytes, tuple[int, ...]] = {}
        self.plain, self.shapes = {}, {}
        for size in (0, *STEMS):  # 0: whole words
            own = [w for w in words if (not w.endswith("*") if size == 0 else w.endswith("*") and len(w[:-1].encode()) == size)]
            if own:
                keys = _hash_words([w.rstrip("*") for w in own])
                order = np.argsort(keys)
                self.plain[size] = keys[order], np.array([self.number[w] for w in own])[order]
            for shape in {self._shape(w) for w in own} - {b""}:
                self.shapes.setdefault((size > 0, len(shape)), set()).add(shape)
        self.shapes = {k: np.sort(np.unique(_hash_bytes(v))) for k, v in self.shapes.items()}
        # letters at either end of a word that are one in its skeleton, at most
        self.merged = max([1, *(sum(1 for _ in g) for w in words for g in self._edges(w.rstrip("*")))])

    @staticmethod
    def _edges(word: str) -> list[list[str]]:
        groups = [list(g) for _, g in itertools.groupby(_skeleton_of(c) for c in word)]
        return groups[:1] + groups[-1:]

    @staticmethod
    def _shape(word: str) -> bytes:
        raw = np.frombuffer(word.rstrip("*").encode(), np.uint8)
        return skeletons(raw, np.array([0, len(raw)]))[0].tobytes()

    def numbers(self, words: list[str]) -> tuple[int, ...]:
        return tuple({self.number[f] for w in words for f in with_stems(w) if f in self.number})

    def restored(self, piece: bytes, blank: tuple[float, float] = (_SKIP, _BREAK)) -> tuple[int, ...]:
        """Numbers of the picked words behind a disguised piece of text."""
        key = piece, blank
        got = self.memory.get(key)
        if got is None:
            text = piece.decode("utf-8", "replace").lower()
            got = ()
            for t in dict.fromkeys((text, text.rstrip("!|+.,;:?()<>[]{}\"'*"), text.strip("!|+.,;:?()<>[]{}\"'*@$"))):
                got += self.numbers(decode(t, self.model, blank=blank).split())
            got = tuple(set(got))
            if len(self.memory) > 200_000:
                self.memory.clear()
            self.memory[key] = got
        return got

    def features(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, number of a word), each once."""
        pairs: set[tuple[int, int]] = set()
        form = lowered(data)
        starts, ends, first = word_spans(data, offsets, _LETTER)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        for size, (keys, order) in self.plain.items():
            if size:
                longer = np.flatnonzero(ends - starts > size)
                hit, which = _found(span_hashes(form, starts[longer], starts[longer] + size), keys, order)
                hit = longer[hit]
            else:
                hit, which = _found(span_hashes(form, starts, ends), keys, order)
            pairs.update(zip(row[hit].tolist(), which.tolist(), strict=True))
        if self.model is not None and self.words and len(data):
            pairs |= self._disguised(data, offsets)
        got = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        return got[:, 0], got[:, 1]

    def _disguised(self, data: np.ndarray, offsets: np.ndarray) -> set[tuple[int, int]]:
        """Picked words that the texts hide.

        Decoded is every stretch from a cut to a cut (from a cut on, for stems) whose
        skeleton is that of a picked word, blanks or not in between.
        """
        spans = _Spans(data, offsets)
        m = len(spans.group)
        raw = data.tobytes()
        group_row = spans.row[spans.group]
        begins = np.flatnonzero(spans.begins)
        out: set[tuple[int, int]] = set()
        for (stem, size), keys in self.shapes.items():
            s = begins[begins + size + stem <= m]
            s = s[group_row[s] == group_row[s + size + stem - 1]]
            s = s if stem else s[spans.ends[s + size - 1]]
            s = s[_found(spans.hashes(s, size), keys, np.zeros(len(keys), np.int64))[0]]
            first, last = spans.group[s], spans.edge[s + size] - 1
            known = spans.plain(first, last) & (spans.cut[first] & (spans.cut[last + 1] if not stem else _ASCII_LETTER[data[np.minimum(spans.stop[last], len(data) - 1)]]))
            known &= last - first == size - 1
            for i in s[~known].tolist():
                row = int(group_row[i])
                for text, blank in self._readings(spans, raw, i, i + size, stem):
                    out.update((row, x) for x in self.restored(text, blank))
        return out

    def _readings(self, spans: _Spans, raw: bytes, i: int, j: int, stem: bool) -> Iterator[tuple[bytes, tuple[float, float]]]:
        """Texts to decode, with the costs of blanks, for the word or stem in groups ``i`` to ``j - 1``."""
        cut, piece, fragment = spans.cut, spans.piece, spans.fragment
        lows = [k for k in range(int(spans.edge[i + 1]) - 1, int(spans.edge[i]) - 1, -1) if cut[k]][: self.merged]
        highs = [k for k in range(int(spans.edge[j - 1]), int(spans.edge[j])) if cut[k + 1]][: self.merged] if not stem else [int(spans.edge[j])]
        n = len(spans.at)
        for low in lows:
            for high in highs:
                if high < low:
                    continue
                if stem and piece[high] != piece[high - 1] and not (spans.single[high] and spans.single[high - 1]):
                    continue  # the word ends where the stem does
                a, b = low, high
                if stem:  # the rest of the word
                    while b + 1 < n and b < high + 32 and piece[b + 1] == piece[high]:
                        b += 1
                if fragment[low] != fragment[high]:
                    # one letter next to it, parted like the letters in it, belongs to what is read
                    while a > 0 and low - a < 32 and self._beside(spans, a - 1, a):
                        a -= 1
                    while b + 1 < n and b - high < 32 and self._beside(spans, b + 1, b):
                        b += 1
                spaced = piece[a] != piece[b]
                loose = spaced and not (b - a >= 2 and spans.single[a : b + 1].all())
                text = raw[int(spans.at[a]) : int(spans.stop[b])]
                yield b" ".join(text.split()) if spaced else text, _WORD_BLANK if loose else (_SKIP, _BREAK)

    @staticmethod
    def _beside(spans: _Spans, k: int, by: int) -> bool:
        """Whether element ``k`` is a fragment of one letter and neither a mark nor in another piece than ``by``, but for pieces of one letter."""
        if spans.row[k] != spans.row[by] or not spans.firm[k] or spans.letters[spans.fragment[k]] != 1:
            return False
        return spans.piece[k] == spans.piece[by] or bool(spans.single[k] and spans.single[by])

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.full(len(offsets) - 1, self.bias)
        row, word = self.features(data, offsets)
        np.add.at(total, row, self.weights[word])
        total[np.unique(row)] += self.any_weight
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _hash_bytes(words: set[bytes]) -> np.ndarray:
    raw = sorted(words)
    size = np.array([len(r) for r in raw], np.int64)
    ends = np.cumsum(size + 1) - 1
    return span_hashes(np.frombuffer(b" ".join(raw) + b" ", np.uint8), ends - size, ends)


def least_toxic(looked: int, n_bad: int, n_good: int) -> int:
    """In how many toxic documents a word must be so that none of ``looked`` words would be in as many by chance."""
    return max(3, math.ceil((math.log(max(2, looked)) + 1) / math.log((n_bad + n_good) / n_bad)))


def pick_words(names: list[str], doc: np.ndarray, word: np.ndarray, y: np.ndarray, most: int | None = None, times: float = TIMES, cover: int = 3, looked: int | None = None, top: dict[str, int] | None = None) -> list[int]:
    """Numbers of the words that mark toxic documents, picked greedily.

    ``doc`` and ``word`` are pairs of a document and a word in it.  A word must be at
    least ``times`` as frequent among toxic documents as among others, and occur in
    more toxic documents that fewer than ``cover`` earlier words explain than any of
    as many words would by chance.  A stem is left out if a single word accounts
    for most of it, or if it is not far more frequent among toxic documents.
    ``looked`` is the number of words that ``names`` were chosen from, and ``top`` says of
    each stem in how many toxic documents its most frequent word is; by default both
    are taken from ``names``.
    """
    bad, good = y > 0, y <= 0
    n_bad, n_good = int(bad.sum()), int(good.sum())
    if not n_bad or not n_good:
        return []
    in_bad = np.bincount(word[bad[doc]], minlength=len(names))
    in_good = np.bincount(word[good[doc]], minlength=len(names))
    least = least_toxic(looked or len(names), n_bad, n_good)
    able = (in_bad >= least) & (in_bad / n_bad >= times * (in_good + 0.5) / n_good)
    of_stems, top = top is None, top or {}
    for i, w in enumerate(names):
        if of_stems and not w.endswith("*"):
            for stem in with_stems(w)[1:]:
                top[stem] = max(top.get(stem, 0), int(in_bad[i]))
    for i in np.flatnonzero(able).tolist():
        few = in_bad[i] < 1.3 * top.get(names[i], 0) or in_bad[i] / n_bad < 5 * times * (in_good[i] + 0.5) / n_good
        if names[i].endswith("*") and few:
            able[i] = False
    use = bad[doc] & able[word]
    order = np.argsort(word[use], kind="stable")
    d, w = doc[use][order], word[use][order]
    begin = np.searchsorted(w, np.arange(len(names) + 1))
    left = np.where(bad, cover, 0)
    worth = np.log((in_bad + 0.5) / n_bad) - np.log((in_good + 0.5) / n_good)
    picked: list[int] = []
    while most is None or len(picked) < most:
        gain = np.bincount(w[left[d] > 0], minlength=len(names))
        value = np.where((gain >= least) & able, gain * worth, 0)
        best = int(np.argmax(value))
        if value[best] <= 0:
            break
        picked.append(best)
        able[best] = False
        mine = d[begin[best] : begin[best + 1]]
        left[mine] = np.maximum(0, left[mine] - 1)
    return picked


def fit_weights(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Logistic regression with weights that are not negative, by projected Newton-like steps."""
    n, f = x.shape
    w, p = np.zeros(f), float(np.clip(y.mean() if n else 0.5, 0.01, 0.99))
    b = math.log(p / (1 - p))
    if n == 0 or len(np.unique(y)) < 2:
        return w, min(b, -1.0)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        h = np.maximum(q * (1 - q), 1e-3)
        b -= (q - y).sum() / h.sum() * 0.5
        w = np.maximum(0, w - 0.5 * (x.T @ (q - y) + 0.02 * penalty * w) / (x.T @ h + penalty))
    return w, b


def corpus_trigrams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts over all documents; what is gathered has a fixed bound."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE**3, np.int64)
        for batch in batches:
            data, offsets = string_buffers(batch.column(0))
            for i, j in row_slices(offsets):
                total += trigram_counts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(total[slot], pa.int64())], ["slot", "n"])

    got = docs.select(text_col).mapInArrow(lean(count), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(_SIZE**3, np.int64)
    out[got["slot"]] = got["n"]
    return out


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Scorer:
    """Learn words and weights from at most about ``sample_rows`` labelled rows for which ``learn`` holds."""
    known = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("_y")).filter(F.col("_y").isin(0, 1) & learn)
    known = sampled(known, id_col, sample_rows)  # bounded, so that it can be broadcast

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = Counter(), Counter()  # by label

        def passed() -> pa.RecordBatch:
            names = list(held[0] | held[1])
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([held[y][w] for w in names], pa.int64()) for y in (1, 0))], ["w", "bad", "good"])
            for h in held:
                h.clear()
            return out

        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[y].update({f for w in set(plain_words(t or "")) for f in with_stems(w)})
                if len(held[0]) + len(held[1]) > HELD_COUNTS:
                    yield passed()
        yield passed()

    rows = docs.select(id_col, text_col).join(F.broadcast(known), id_col).select("_y", text_col)
    amounts = {r[0]: r[1] for r in rows.groupBy("_y").count().collect()}
    n_bad, n_good = amounts.get(1, 0), amounts.get(0, 0)
    often: list[str] = []
    looked, top = 0, {}
    if n_bad and n_good:
        # a word of fewer than three toxic documents is never picked
        counted = rows.mapInArrow(lean(count), "w string, bad long, good long").groupBy("w").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter("bad >= 3")
        counted = written(counted, "words")
        looked = counted.count()
        telling = counted.filter((F.col("bad") >= least_toxic(looked, n_bad, n_good)) & (F.col("bad") / n_bad >= TIMES * (F.col("good") + 0.5) / n_good)).select("w")
        often = sorted(r[0] for r in telling.collect())
        stems = F.broadcast(docs.sparkSession.createDataFrame([(w,) for w in often if w.endswith("*")], "stem string"))
        parts = F.udf(lambda w: with_stems(w)[1:], "array<string>")
        words = counted.filter(~F.col("w").endswith("*")).select("bad", F.explode(parts("w")).alias("stem"))
        top = {r[0]: r[1] for r in words.join(stems, "stem").groupBy("stem").agg(F.max("bad")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(often)})

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lists = [sorted({known[f] for w in set(plain_words(t or "")) for f in with_stems(w) if f in known}) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32()))], ["y", "words"])

    got = rows.mapInArrow(lean(narrow), "y int, words array<int>").toArrow()
    y = np.asarray(got["y"].combine_chunks()).astype(np.float64)
    lists = got["words"].combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int32()))
    size = np.diff(np.asarray(lists.offsets)) if got.num_rows else np.zeros(0, np.int64)
    doc, word = np.repeat(np.arange(len(y)), size), np.asarray(lists.flatten()).astype(np.int64)
    picked = pick_words(often, doc, word, y, looked=looked, top=top)
    column = np.full(len(often) + 1, -1)
    column[picked] = np.arange(len(picked))
    x = np.zeros((len(y), len(picked) + 1))
    held = column[word] >= 0
    x[doc[held], column[word[held]]] = 1
    x[:, -1] = x.any(1)
    order = np.lexsort((y, *x.T))  # the same weights whatever order the rows came in
    weights, bias = fit_weights(x[order], y[order])
    names = [often[i] for i in picked]
    return Scorer(names, weights[:-1], float(weights[-1]), bias, language_model(corpus_trigrams(docs, text_col), [w.rstrip("*") for w in names]))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """Learn from labelled rows whose crc32(id) modulo 5 is not 0 and score all rows of ``docs``.

    Returns the id, held_out, score and predicted.  Null texts score as empty ones.
    Labels that are null or neither 0 nor 1 are passed over; without labels of both
    kinds every score is the same.  An empty table gives an empty result.
    """
    scorer = train(docs, labels, crc_bucket(id_col, 5) != 0, id_col, text_col, label_col)
    shared = docs.sparkSession.sparkContext.broadcast((scorer.words, scorer.weights, scorer.any_weight, scorer.bias, scorer.model))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*shared.value)
        for batch in batches:
            data, offsets = string_buffers(batch.column(1))
            parts = [own.score(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in row_slices(offsets)]
            score = np.concatenate(parts) if parts else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], ["id", "score", "predicted"])

    out = docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(lean(run), f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)
    return out.select(id_col, (F.coalesce(crc_bucket(id_col, 5), F.lit(1)) == 0).alias("held_out"), "score", "predicted")
