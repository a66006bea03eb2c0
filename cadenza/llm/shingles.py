"""Word shingles of many texts at once, and consistent weighted samples of them, with numpy on Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
#: Bits of a shingle's hash; the upper 12 of a 64-bit key hold the text's place in its group.
BITS = 52
GROUP_TEXTS = 1 << (64 - BITS)
GROUP_BYTES = 1 << 20
BUCKET_BITS = 18
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_NEXT = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as long as the longest group so far."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, GROUP_BYTES * 2)
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            cls.up = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)]))
            cls.down = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, inverse)]))
        return cls.up, cls.down


def groups(column: pa.ChunkedArray | pa.Array):
    """(first row, bytes, offsets) of runs of texts with bounded bytes and count; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + GROUP_BYTES, side="right")) - 1
        end = min(max(end, at + 1), at + GROUP_TEXTS, len(column))
        yield at, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def shingle_keys(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Sorted keys (place of the text, then hash) of every shingle of every text. A text of fewer words is one shingle."""
    texts = len(offsets) - 1
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    up, down = Powers.of(len(data) + 1)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    value = data.astype(np.uint64)
    value += np.uint64(1)
    value *= up[:len(data)]
    value[~inside] = 0
    word = mixed(np.add.reduceat(value, starts) * down[starts])
    edges = np.searchsorted(starts, offsets)
    count = np.diff(edges)
    place = np.repeat(np.arange(texts, dtype=np.uint64), count)
    rolled = word.copy()
    length = len(word) - words + 1
    keys = []
    if length > 0:
        rolled = word[:length].copy()
        for k in range(1, words):
            rolled = rolled * _NEXT + word[k:k + length]
        whole = place[:length] == place[words - 1:]
        keys.append((place[:length][whole] << np.uint64(BITS)) | (mixed(rolled[whole]) >> np.uint64(64 - BITS)))
    for t in np.flatnonzero((count > 0) & (count < words)):
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for w in word[edges[t]:edges[t + 1]]:
                h = h * _NEXT + w
        keys.append((np.array([t], np.uint64) << np.uint64(BITS)) | (mixed(np.array([h], np.uint64)) >> np.uint64(64 - BITS)))
    out = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
    out.sort()
    return out


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each occurs."""
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64)
    change = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[change], np.diff(np.append(change, len(keys)))


def place_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(BITS)).astype(np.int64)


def hash_of(keys: np.ndarray) -> np.ndarray:
    return keys & np.uint64((1 << BITS) - 1)


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(BITS - BUCKET_BITS)).astype(np.int64)


class WeightedSampler:
    """Improved consistent weighted sampling.

    For sample k a shingle has r and c from Gamma(2, 1) and b uniform, taken from one table by a hash of shingle and k.
    With weight S: t = floor(ln S / r + b), ln y = r (t - b), ln a = ln c - ln y - r; the shingle with the smallest
    ln a, with its t, is the sample. Two texts agree on a sample with the probability of their weighted Jaccard
    similarity.
    """

    TABLE_BITS = 16

    def __init__(self, samples: int, seed: int = 20240229):
        rng = np.random.default_rng(seed)
        n = 1 << self.TABLE_BITS
        self.r = rng.gamma(2.0, 1.0, n).astype(np.float32)
        self.inverse_r = (1.0 / self.r.astype(np.float64)).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, n)).astype(np.float32)
        self.b = rng.random(n).astype(np.float32)
        #: ln c - r + r b: what of ln a does not depend on the weight
        self.fixed = (self.log_c - self.r + self.r * self.b).astype(np.float32)
        self.factors = [np.uint64(int(x) | 1) for x in rng.integers(1 << 62, 1 << 63, samples)]

    def samples(self, hashes: np.ndarray, log_weight: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One row per text, one column per sample; ``starts`` and ``counts`` give the texts' runs of shingles."""
        out = np.empty((len(starts), len(self.factors)), dtype=np.uint64)
        owner = np.repeat(np.arange(len(starts)), counts)
        log_weight = log_weight.astype(np.float32)
        shift = np.uint64(64 - self.TABLE_BITS)
        for k, factor in enumerate(self.factors):
            at = ((hashes * factor) >> shift).astype(np.int32)
            t = np.floor(log_weight * self.inverse_r[at] + self.b[at])
            value = self.fixed[at] - self.r[at] * t
            least = np.minimum.reduceat(value, starts)
            hit = np.flatnonzero(value == least[owner])
            own, first = np.unique(owner[hit], return_index=True)
            hit = hit[first]
            out[own, k] = mixed(hashes[hit] * np.uint64(0x9E3779B97F4A7C15) + t[hit].astype(np.int64).astype(np.uint64))
        return out
