"""Words of whole texts as 64-bit hashes, by Arrow's native string kernels and one hash per different word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed values, in RE2's notation: characters that show nothing; clock times with or without their brackets and cue
#: ends; apostrophes, which join the letters beside them.
INVISIBLE = r"[\x{AD}\x{34F}\x{61C}\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}]+"
CLOCKS = r"(?:\d{1,3}:)?\d{1,2}:\d{2}(?:[.,]\d{1,3})?(?:\s*-->\s*(?:\d{1,3}:)?\d{1,2}:\d{2}(?:[.,]\d{1,3})?)?"
APOSTROPHES = r"['’ʼ`´]+"


def worker_state() -> dict:
    """What a worker process keeps between tasks, in a module of this package's own.

    Functions come to workers by value, with new globals for each task; the interpreter's modules stay.
    """
    import sys
    import types

    return vars(sys.modules.setdefault("voxloom_worker_state", types.ModuleType("voxloom_worker_state")))


def plain_texts(texts: pa.Array) -> pa.Array:
    """Lower case, canonically decomposed, without invisible characters; null becomes empty."""
    texts = pc.utf8_lower(pc.fill_null(texts, ""))
    return pc.replace_substring_regex(pc.utf8_normalize(texts, form="NFD"), pattern=INVISIBLE, replacement="")


def split_words(texts: pa.Array, pattern: str = r"[^\p{L}\p{N}\p{M}]+") -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in a row, and the number of words up to each text's end."""
    lists = pc.split_pattern_regex(texts, pattern=pattern)
    words, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(words, "")
    words, owner = words.filter(full), owner.filter(full).to_numpy()
    return words, np.searchsorted(owner, np.arange(len(texts)), "right")


def hash_words(words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """64-bit hash of each word; the different words; the code of each word among them."""
    import xxhash

    coded = words.dictionary_encode()
    each = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return (each[codes] if len(codes) else np.empty(0, np.uint64)), coded.dictionary, codes


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finalizer of a public hash)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` word hashes, by the place of its first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
        return mix(total)


def text_slices(batch: pa.RecordBatch, column: str = "text", most_bytes: int = 4 << 20):
    """``batch`` in slices whose texts sum up to about ``most_bytes``; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)
