"""Encoding of the whole corpus with a public tokenizer (problem 7).

Byte-level BPE over a pair occurrence index: all distinct words of a batch are laid out in one array, every
pair that the vocabulary can merge is mapped to all its places, and ranks are applied in ascending order;
a merge touches only the lists of the pairs next to it.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast, SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words whose ids a worker keeps; the store is emptied when full, which costs time only.
KEPT_WORDS = 200_000

DEFAULT_FOLDER = "/opt/tokenizers"


def default_vocabulary() -> str:
    return os.path.join(DEFAULT_FOLDER, "byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable ones for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(hidden)}


#: The words of a text: letters, digits, contractions, other signs, each with a blank before it, and white space.
#: Letters and digits come first, as they are most; they share no first character with contractions.
_SPLIT = regex.compile(r" ?\p{L}+| ?\p{N}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
#: The same for ASCII texts, where it is much faster.
_SPLIT_ASCII = re.compile(
    r" ?[A-Za-z]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
).findall


def split_words(text: str) -> list[str]:
    """The words that are encoded on their own."""
    return (_SPLIT_ASCII if text.isascii() else _SPLIT)(text)


class PairIndexTokenizer:
    """Byte-level BPE by the content of a `tokenizers` JSON file."""

    def __init__(self, content: bytes | str) -> None:
        model = json.loads(content)["model"]
        vocabulary, letters = model["vocab"], _byte_letters()
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocabulary[letter]
        #: Of a pair of ids: its rank. Of a rank: the pair and the id it becomes.
        self.rank: dict[tuple[int, int], int] = {}
        self.merges: list[tuple[int, int, int]] = []
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[vocabulary[a], vocabulary[b]] = len(self.merges)
            self.merges.append((vocabulary[a], vocabulary[b], vocabulary[a + b]))
        self.words: dict[str, list[int]] = {}

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word."""
        encoded = [w.encode() for w in words]
        ends = np.cumsum([len(w) for w in encoded]).tolist()
        ids = [self.byte_ids[b] for w in encoded for b in w]
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        start = 0
        for end in ends:
            if end > start:
                before[start], after[end - 1] = -1, -1
            start = end
        rank_of, merges = self.rank.get, self.merges
        places: dict[int, list[int]] = {}
        for i in range(n - 1):
            if after[i] >= 0 and (r := rank_of((ids[i], ids[i + 1]))) is not None:
                places.setdefault(r, []).append(i)
        active = list(places)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            a, b, new = merges[r]
            for i in sorted(places.pop(r)):
                j = after[i]
                if ids[i] != a or j < 0 or ids[j] != b:
                    continue
                ids[i], ids[j] = new, -1
                k = after[j]
                after[i] = k
                if k >= 0:
                    before[k] = i
                    if (s := rank_of((new, ids[k]))) is not None:
                        if s in places:
                            places[s].append(i)
                        else:
                            places[s] = [i]
                            heapq.heappush(active, s)
                h = before[i]
                if h >= 0 and (s := rank_of((ids[h], new))) is not None:
                    if s in places:
                        places[s].append(h)
                    else:
                        places[s] = [h]
                        heapq.heappush(active, s)
        out, start = [], 0
        for end in ends:
            out.append([x for x in ids[start:end] if x >= 0])
            start = end
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; an empty or null text has none."""
        split = [split_words(t) if t else [] for t in texts]
        known = self.words
        if len(known) > KEPT_WORDS:
            known.clear()
        new = list({w: None for words in split for w in words if w not in known})
        known.update(zip(new, self.encode_words(new), strict=True))
        return [np.fromiter(chain.from_iterable(map(known.__getitem__, words)), np.int32) for words in split]


_TOKENIZERS: dict[str, PairIndexTokenizer] = {}


def tokenizer(path: str, content: Broadcast | None = None) -> PairIndexTokenizer:
    """One tokenizer per process and file; `content` is what the file held on the driver."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = PairIndexTokenizer(content.value if content is not None else Path(path).read_bytes())
    return _TOKENIZERS[path]


#: Bytes of a vocabulary file that is sent to all executors; a larger one is an error.
MOST_BYTES = 256 << 20
_SENT: dict[tuple[str, str], Broadcast] = {}


def _sent(path: str) -> Broadcast:
    """The vocabulary file, read on the driver and sent to every executor once for each application."""
    context = SparkContext.getOrCreate()
    key = (context.applicationId, path)
    if key not in _SENT:
        if os.path.getsize(path) > MOST_BYTES:
            raise ValueError(f"{path} is too large for a vocabulary")
        _SENT[key] = context.broadcast(Path(path).read_bytes())
    return _SENT[key]


#: Characters that are encoded at once, so that memory doesn't grow with the length of texts in a batch.
SLICE = 2_000_000


def _slices(texts: pd.Series) -> Iterator[list[str | None]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size > SLICE:
            yield part
            part, size = [], 0
    yield part


def token_ids(text: Column | str, vocabulary: str | None = None) -> Column:
    """The ids of a text as array<int>, without special tokens; their strings in a text are ordinary text.

    An empty and a null text have the empty list. Texts are encoded whole. Needs no shuffle: one Arrow pass
    over the text column.
    """
    path = vocabulary or default_vocabulary()
    content = _sent(path)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = tokenizer(path, content)
        for texts in batches:
            yield pd.Series([x for part in _slices(texts) for x in bpe.encode(part)], index=texts.index, dtype=object)

    return encode(text)


def token_counts(text: Column | str, vocabulary: str | None = None) -> Column:
    """The number of ids of a text; 0 for an empty or null text."""
    path = vocabulary or default_vocabulary()
    content = _sent(path)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = tokenizer(path, content)
        for texts in batches:
            yield pd.Series([len(x) for part in _slices(texts) for x in bpe.encode(part)], index=texts.index, dtype="int64")

    return count(text)
