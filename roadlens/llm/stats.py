"""Statistics of whole texts, vectorised over Arrow batches: the inputs of the quality classifier."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from roadlens.llm.common import text_blocks
from roadlens.llm.words import find_words, lower_ascii, word_hashes

BLOCK = 1 << 17  # bytes of text in work at a time: work arrays are many times as large

NAMES = (
    "words", "chars", "word_length", "upper", "digit", "punctuation", "symbol", "bar", "exclaim", "line_words",
    "lines", "short_lines", "repeated_lines", "distinct_words", "top_word", "upper_words", "ends_sentence", "non_ascii",
    "long_words", "short_words", "commas", "comma_ends", "symbol_words", "repeated_pairs",
)

_KINDS = np.zeros((256, 9), bool)
_KINDS[65:91, 0] = True  # upper case
_KINDS[48:58, 1] = True  # digits
_KINDS[[ord(c) for c in ".,;:?'\"()-"], 2] = True  # prose punctuation
_KINDS[[ord(c) for c in "#$%&*+<=>@[]\\^_`{}~/"], 3] = True  # symbols
_KINDS[ord("|"), 4] = True
_KINDS[ord("!"), 5] = True
_KINDS[10, 6] = True  # line ends
_KINDS[128:, 7] = True
_KINDS[ord(","), 8] = True


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(float)


def _distinct(keys: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: how many distinct keys it has, and how often the most frequent one occurs."""
    n = len(bounds) - 1
    text = np.repeat(np.arange(n), np.diff(bounds))
    order = np.lexsort((keys, text))
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(keys)))
    top = np.zeros(n)
    np.maximum.at(top, text[at], runs)
    return np.bincount(text[at], minlength=n).astype(float), top


def text_stats(col: pa.Array) -> Iterator[np.ndarray]:
    """Blocks of rows x ``NAMES``; null and empty texts are all 0."""
    for _, _, data, offsets in text_blocks(col, BLOCK):
        n = len(offsets) - 1
        kinds = [_per_text(_KINDS[:, k][data], offsets) for k in range(9)]
        chars = np.diff(offsets).astype(float) - _per_text((data & 0xC0) == 0x80, offsets)
        s, e, bounds = find_words(data, offsets)
        words = np.diff(bounds).astype(float)
        size = (e - s).astype(float)
        hashes = word_hashes(data, s, e)
        distinct, top = _distinct(word_hashes(low := lower_ascii(data), s, e), bounds)
        pairs = np.append((hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[1:], hashes[-1:]) if len(hashes) else hashes
        distinct_pairs, _ = _distinct(pairs, bounds)
        # lines: runs between line ends
        ls, le, lbounds = find_words(data, offsets, ~_KINDS[:, 6])
        lines = np.diff(lbounds).astype(float)
        distinct_lines, _ = _distinct(word_hashes(data, ls, le), lbounds)
        short = _per_text((le - ls) < 25, lbounds)
        upper_sum = np.append(0, np.cumsum(_KINDS[:, 0][data]))
        all_upper = (upper_sum[e] - upper_sum[s] >= 2) & (upper_sum[e] - upper_sum[s] >= 0.7 * size)
        odd_sum = np.append(0, np.cumsum(_KINDS[:, 3][data] | _KINDS[:, 4][data] | _KINDS[:, 5][data]))
        last = data[e - 1] if len(e) else data[:0]
        line_last = data[le - 1] if len(le) else data[:0]
        b, w, c, ln = np.maximum(np.diff(offsets), 1), np.maximum(words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
        del low
        out = np.zeros((n, len(NAMES)))
        out[:] = np.column_stack(
            [
                np.log1p(words), np.log1p(chars), _per_text(size, bounds) / w, kinds[0] / c, kinds[1] / c, kinds[2] / c, kinds[3] / c,
                kinds[4] / w, kinds[5] / w, words / ln, np.log1p(lines), short / ln, 1 - distinct_lines / ln, distinct / np.sqrt(w), top / w,
                _per_text(all_upper, bounds) / w, _per_text(np.isin(line_last, [46, 33, 63]), lbounds) / ln, kinds[7] / b,
                _per_text(size > 15, bounds) / w, _per_text(size <= 2, bounds) / w, kinds[8] / w, _per_text(last == 44, bounds) / w,
                _per_text(odd_sum[e] - odd_sum[s] >= 2, bounds) / w, 1 - distinct_pairs / w,
            ]
        )
        out[words == 0] = 0
        yield out
