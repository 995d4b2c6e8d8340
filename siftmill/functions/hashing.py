"""Shard hashes of ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of BLAKE3: initial words, message permutation, flags.
_IV = (0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19)
_ORDER = (2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8)
_CHUNK_START, _CHUNK_END, _PARENT, _ROOT = 1, 2, 4, 8
_BLOCK, _CHUNK = 64, 1024


def shard_of(key: Column | str, shards: int) -> Column:
    """The shard 0..shards-1 of a key by the first 60 bits of its MD5; null for null.

    Runs inside the JVM and gives the same shard in any SQL engine.
    """
    if shards < 1:
        raise ValueError(f"there must be at least one shard, not {shards}")
    return (F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long") % shards).cast("int")


def _compress(chain: np.ndarray, block: np.ndarray, counter: np.ndarray, length: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """BLAKE3's compression of one block for many messages at once: words along the first axis, messages along the second."""
    n = block.shape[1]
    v = np.empty((16, n), np.uint32)
    v[:8] = chain
    v[8:12] = np.array(_IV[:4], np.uint32)[:, None]
    v[12], v[13], v[14], v[15] = counter.astype(np.uint32), (counter >> 32).astype(np.uint32), length, flags

    def turn(x: np.ndarray, k: int) -> np.ndarray:
        return (x >> np.uint32(k)) | (x << np.uint32(32 - k))

    def quarter(a: int, b: int, c: int, d: int, x: np.ndarray, y: np.ndarray) -> None:
        for word, r, s in ((x, 16, 12), (y, 8, 7)):
            v[a] += v[b] + word
            v[d] = turn(v[d] ^ v[a], r)
            v[c] += v[d]
            v[b] = turn(v[b] ^ v[c], s)

    m = block
    for step in range(7):
        for i in range(4):
            quarter(i, 4 + i, 8 + i, 12 + i, m[2 * i], m[2 * i + 1])
        for i in range(4):
            quarter(i, 4 + (i + 1) % 4, 8 + (i + 2) % 4, 12 + (i + 3) % 4, m[8 + 2 * i], m[9 + 2 * i])
        if step < 6:
            m = m[list(_ORDER)]
    return v[:8] ^ v[8:]


def _chunk_words(chunks: list[bytes], numbers: np.ndarray, root: bool) -> np.ndarray:
    """Chaining values of chunks of up to 1024 bytes, or their root values."""
    n = len(chunks)
    sizes = np.array([len(c) for c in chunks])
    blocks = np.maximum(1, -(-sizes // _BLOCK))
    chain = np.repeat(np.array(_IV, np.uint32)[:, None], n, 1)
    for b in range(int(blocks.max(initial=0))):
        on = np.flatnonzero(blocks > b)
        raw = b"".join(chunks[i][b * _BLOCK : (b + 1) * _BLOCK].ljust(_BLOCK, b"\0") for i in on)
        words = np.frombuffer(raw, "<u4").reshape(len(on), 16).T.astype(np.uint32)
        last = blocks[on] == b + 1
        flags = np.where(b == 0, _CHUNK_START, 0) | np.where(last, _CHUNK_END | (_ROOT if root else 0), 0)
        length = np.clip(sizes[on] - b * _BLOCK, 0, _BLOCK)
        chain[:, on] = _compress(chain[:, on], words, numbers[on], length.astype(np.uint32), flags.astype(np.uint32))
    return chain


def _tree_words(message: bytes) -> np.ndarray:
    """The root of a message of several chunks: a left-heavy binary tree over its chunks."""
    parts = [message[i : i + _CHUNK] for i in range(0, len(message), _CHUNK)]
    leaves = _chunk_words(parts, np.arange(len(parts), dtype=np.uint64), False)

    def join(lo: int, hi: int, flags: int) -> np.ndarray:
        if hi - lo == 1:
            return leaves[:, lo : lo + 1]
        half = 1 << ((hi - lo - 1).bit_length() - 1)
        block = np.concatenate([join(lo, lo + half, 0), join(lo + half, hi, 0)])
        one = np.ones(1, np.uint32)
        return _compress(np.array(_IV, np.uint32)[:, None], block, np.zeros(1, np.uint64), one * np.uint32(_BLOCK), one * np.uint32(_PARENT | flags))

    return join(0, len(parts), _ROOT)[:, 0]


def blake3_words(messages: list[bytes]) -> np.ndarray:
    """The first 32 bytes of BLAKE3 of each message, as eight words a row."""
    out = np.zeros((len(messages), 8), np.uint32)
    short = [i for i, m in enumerate(messages) if len(m) <= _CHUNK]
    if short:
        out[short] = _chunk_words([messages[i] for i in short], np.zeros(len(short), np.uint64), True).T
    for i, m in enumerate(messages):
        if len(m) > _CHUNK:
            out[i] = _tree_words(m)
    return out


def blake3_shard_of(key: Column | str, shards: int) -> Column:
    """The shard of a key by the first eight bytes of BLAKE3 of its UTF-8 bytes, read as an unsigned little-endian number.

    Gives the shards of libraries that were laid out with BLAKE3; null for null. An Arrow pass over the key;
    new layouts are better served by shard_of.
    """
    if shards < 1:
        raise ValueError(f"there must be at least one shard, not {shards}")

    @F.pandas_udf("int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            there = keys.notna().to_numpy()
            words = blake3_words([k.encode() for k in keys[there]]).astype(np.uint64)
            out = pd.Series([None] * len(keys), index=keys.index, dtype="Int32")
            out[there] = ((words[:, 0] | (words[:, 1] << np.uint64(32))) % np.uint64(shards)).astype(np.int32)
            yield out

    return run(key)
