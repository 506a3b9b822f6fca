"""Hashed character n-grams of whole texts, as numpy arrays."""

from collections.abc import Iterator

import numpy as np

# Texts are worked on in blocks of so many bytes, each with the bytes its last n-grams need.
BLOCK = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_slots(text: str, sizes: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Slots, below 2**bits, of the n-grams of the lower-cased text's UTF-8 bytes; arrays of bounded size."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    for start in range(0, len(data), BLOCK):
        for n in sizes:
            block = data[start : start + BLOCK + n - 1]
            count = len(block) - n + 1
            if count <= 0:
                continue
            code = block[:count].astype(np.uint64)
            for k in range(1, n):
                code = code << np.uint64(8) | block[k : k + count]
            code += np.uint64(n << 56)
            code *= _MIX
            yield (code >> np.uint64(64 - bits)).astype(np.int32)
