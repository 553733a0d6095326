"""Hashed character n-grams of the words of many texts at once."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np

from girder.llm.byte_bpe import LETTER, class_table

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xBF58476D1CE4E5B9)


@cache
def lower_letters() -> np.ndarray:
    """Each code point's lower-case letter, 0 if it is none."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in np.flatnonzero(class_table() == LETTER).tolist():
        low = chr(c).lower()
        out[c] = ord(low) if len(low) == 1 else c
    return out


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts with one 0 around each word, and the text of each symbol."""
    data = b"\n" + b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    letters = lower_letters()[points]
    keep = letters != 0
    keep[1:] |= letters[:-1] != 0
    keep[0] = True
    first = np.flatnonzero((raw & 0xC0) != 0x80)
    if len(first) == len(points):
        starts = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        at = np.searchsorted(first, np.concatenate(([0], starts)))
    else:  # replaced bytes moved the places
        sizes = [len(t.decode("utf-8", "replace")) + 1 for t in texts]
        at = np.concatenate(([0], np.cumsum(sizes)))
    owner = np.zeros(len(points), np.int32)
    owner[at[1:-1]] = 1  # a text's separator stands before it
    owner = np.cumsum(owner, dtype=np.int32)
    return letters[keep].astype(np.uint64), owner[keep]


def grams(
    found: tuple[np.ndarray, np.ndarray], sizes: tuple[int, ...], bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of the n-grams of each size, in the order of the texts.

    A gram lies in a word, whose boundaries count as symbols; it has two symbols at least.
    """
    letters, owner = found
    n = len(letters)
    edges = np.concatenate(([0], np.cumsum(letters == 0, dtype=np.int32)))
    hashed = letters.copy()
    for size in range(2, max(sizes) + 1):
        m = n - size + 1
        if m <= 0:
            return
        hashed = hashed[:m] * _STEP + letters[size - 1 :]
        if size not in sizes:
            continue
        inner = edges[size - 1 : size - 1 + m] == edges[1 : 1 + m]
        if size == 2:
            inner = (letters[:m] != 0) | (letters[1 : 1 + m] != 0)
        at = np.flatnonzero(inner)
        mixed = hashed[at]
        mixed = (mixed ^ (mixed >> np.uint64(31)) ^ np.uint64(size)) * _LAST
        bucket = (mixed >> np.uint64(64 - bits)).astype(np.int64)
        whose = owner[at + 1]
        if size == 2:
            whose = np.where(letters[at] != 0, owner[at], whose)
        yield bucket, whose


def has_letter(found: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Whether each of n texts has a letter."""
    letters, owner = found
    return np.bincount(owner[letters != 0], minlength=n)[:n] > 0
