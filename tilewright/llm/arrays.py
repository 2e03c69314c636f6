"""Helpers on Arrow and numpy arrays that several operators use inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(texts: pa.Array, chars: int) -> list[tuple[int, int]]:
    """(start, end) of runs of texts with about so many bytes, or a longer text each."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    run = (np.cumsum(sizes) - 1) // chars
    edges = np.r_[np.flatnonzero(np.diff(run)) + 1, len(sizes)] if len(sizes) else np.empty(0, np.int64)
    return list(zip([0, *edges[:-1].tolist()], edges.tolist(), strict=True)) if len(edges) else []


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each span, one span after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def unique_words(texts: pa.Array, strip: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(different words, which of them stands at each place, where each text's places begin and the last ends) of lower-cased
    texts, cut at white space; characters of strip are taken off both ends of a word, and an empty one is a word."""
    parts = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    each = pc.utf8_trim(parts.flatten(), characters=strip).dictionary_encode()
    return each.dictionary.to_pylist(), each.indices.to_numpy(zero_copy_only=False), parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()


def sums_by_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of values between each place of rows and the next."""
    upto = np.r_[0.0, np.cumsum(values, dtype=np.float64)]
    return upto[rows[1:]] - upto[rows[:-1]]
