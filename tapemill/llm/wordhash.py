"""Words of a text as 64-bit hashes in numpy arrays."""

import numpy as np
import pyarrow as pa
import xxhash

# Fixed values of a well-known mixer of 64-bit integers.
P1, P2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)
# Words kept per worker before its table starts anew; bounds its memory only.
_KEPT_WORDS = 200_000


class _Hashes(dict):
    """Hash of each word, made when the word is first asked for."""

    def __missing__(self, word: bytes) -> int:
        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


_hash_of = _Hashes()


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= P1
    x ^= x >> np.uint64(27)
    x *= P2
    x ^= x >> np.uint64(31)
    return x


def words_of(text: str) -> list[bytes]:
    """Runs of characters other than ASCII white space, A to Z lower-cased."""
    return text.encode().lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_hash_of) > _KEPT_WORDS:
        _hash_of.clear()
    return np.fromiter(map(_hash_of.__getitem__, words), np.uint64, len(words))


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words, by where they begin."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    code = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        code *= STEP
        code += words[k : len(words) - n + 1 + k]
    return mix(code)


_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
# XXH3's constants for short inputs: what it lays over the bytes, by length, and its multipliers.
_FLIP_3, _FLIP_8 = np.uint64(0x87275A9B), np.uint64(0xC73AB174C5ECD5A2)
_FLIP_LOW, _FLIP_HIGH = np.uint64(0x6782737BEA4239B9), np.uint64(0xAF56BC3B0996523A)
_X2, _X3 = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_XMX, _LAST = np.uint64(0x9FB21C651E98DF25), np.uint64(0x165667919E3779F9)
_LOW_HALF = np.uint64(0xFFFFFFFF)
# Texts are hashed in parts of about so many bytes, which bounds the arrays held.
_PART = 1 << 20


def _bits(n: int) -> np.uint64:
    return np.uint64(n)


def _folded(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The two halves of the 128-bit products, laid over each other."""
    a, b, c, d = x & _LOW_HALF, x >> _bits(32), y & _LOW_HALF, y >> _bits(32)
    low, one, other = a * c, b * c, a * d
    middle = (low >> _bits(32)) + (one & _LOW_HALF) + other
    return (x * y) ^ (b * d + (one >> _bits(32)) + (middle >> _bits(32)))


def _short_hashes(content: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH3 of the words at `starts`, as the library gives it; content goes on for 8 bytes beyond them."""
    eight = np.ndarray(len(content) - 7, "<u8", content, strides=(1,))
    four = np.ndarray(len(content) - 7, "<u4", content, strides=(1,))
    made = np.zeros(len(starts), np.uint64)
    i = np.flatnonzero(sizes <= 3)
    at, size = starts[i], sizes[i]
    first, middle, last = (content[at + k].astype(np.uint64) for k in (0, size >> 1, size - 1))
    h = (first << _bits(16) | middle << _bits(24) | last | size.astype(np.uint64) << _bits(8)) ^ _FLIP_3
    h = (h ^ h >> _bits(33)) * _X2
    h = (h ^ h >> _bits(29)) * _X3
    made[i] = h ^ h >> _bits(32)
    i = np.flatnonzero((sizes > 3) & (sizes <= 8))
    at, size = starts[i], sizes[i]
    h = (four[at + size - 4].astype(np.uint64) + (four[at].astype(np.uint64) << _bits(32))) ^ _FLIP_8
    h ^= (h << _bits(49) | h >> _bits(15)) ^ (h << _bits(24) | h >> _bits(40))
    h *= _XMX
    h ^= (h >> _bits(35)) + size.astype(np.uint64)
    h *= _XMX
    made[i] = h ^ h >> _bits(28)
    i = np.flatnonzero((sizes > 8) & (sizes <= 16))
    at, size = starts[i], sizes[i]
    low, high = eight[at] ^ _FLIP_LOW, eight[at + size - 8] ^ _FLIP_HIGH
    h = size.astype(np.uint64) + low.byteswap() + high + _folded(low, high)
    h = (h ^ h >> _bits(37)) * _LAST
    made[i] = h ^ h >> _bits(32)
    for i in np.flatnonzero(sizes > 16).tolist():
        made[i] = xxhash.xxh3_64_intdigest(content[starts[i] : starts[i] + sizes[i]].tobytes())
    return made


def _part_hashes(texts: pa.Array) -> list[np.ndarray]:
    texts = texts.fill_null("") if texts.null_count else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    at = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    content = np.zeros(at[-1] - at[0] + 9, np.uint8)
    if at[-1] > at[0]:
        content[1:-8] = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]]]
    # One byte before the first text, so that each has one before it.
    at = at - at[0] + 1
    word = ~_SPACE[content]
    word[0] = word[-8:] = False
    begins, ends = word[1:] & ~word[:-1], word[:-1] & ~word[1:]
    # Texts touch each other, words of two do not.
    begins[at[:-1] - 1] = word[at[:-1]]
    ends[at[1:] - 1] = word[at[1:] - 1]
    starts = np.flatnonzero(begins) + 1
    hashes = _short_hashes(content, starts, np.flatnonzero(ends) + 1 - starts)
    cuts = np.searchsorted(starts, at)
    return [hashes[i:j] for i, j in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]


def text_hashes(texts: pa.Array) -> list[np.ndarray]:
    """For each text what word_hashes gives of words_of, no words for a null."""
    if not len(texts):
        return []
    rows = max(1, len(texts) * _PART // max(texts.nbytes, 1))
    return [own for start in range(0, len(texts), rows) for own in _part_hashes(texts.slice(start, rows))]
