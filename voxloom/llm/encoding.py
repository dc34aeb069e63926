"""Encoding of whole texts with a public byte-level BPE, as a monoid reduced over a tree of segments."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voxloom.functions.columns import pick
from voxloom.llm.words import worker_state

#: Where the vocabulary files lie unless a path is given.
TOKENIZERS = os.environ.get("VOXLOOM_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: the public pattern that splits text before the merges of the byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A change from ink to blank.  No piece of the pattern holds ink followed by a blank, and none is decided by what
#: precedes it, so pieces end and begin here whatever the text around; both sides then encode alone as they do together.
#: The class is the pattern's own notion of white space.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SEAM = re.compile(f"(?<=[^{BLANK}])(?=[{BLANK}])")


def read_vocabulary(path: str | None = None) -> dict[bytes, int]:
    """Token bytes to id, from a rank file."""
    with open(path or os.path.join(TOKENIZERS, "byte_bpe_50k.tiktoken"), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def make_encoder(ranks: dict[bytes, int], pattern: str = PATTERN) -> Callable[[str], list[int]]:
    """Function from text to ids; texts that spell special tokens are ordinary text."""
    import tiktoken

    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Segment:
    """Encoded text of an element of the monoid: the text, its ids, and how many text bytes each id covers."""

    __slots__ = ("text", "ids")

    def __init__(self, text: str, ids: np.ndarray):
        self.text, self.ids = text, ids


def _seam_before(text: str, within: int) -> int:
    """The last seam of ``text`` at most ``within`` characters from its end; -1 if there is none."""
    low = max(0, len(text) - within)
    found = [m.start() for m in SEAM.finditer(text, max(0, low - 1))]
    return found[-1] if found else -1


def _seam_after(text: str, within: int) -> int:
    """The first seam of ``text`` within its first ``within`` characters; -1 if there is none."""
    found = SEAM.search(text, 0, min(len(text), within))
    return found.start() if found else -1


def join_segments(left: Segment, right: Segment, encode: Callable[[str], list[int]], widths: np.ndarray, window: int = 64) -> Segment:
    """The encoding of both texts together, from their encodings.

    The window around the border grows until it reaches a seam on either side, or the segment's own end.  Tokens
    outside are then provably those of the whole text, so only the window is encoded again.  ``widths`` gives the
    bytes of each id, which locate a seam among the ids.
    """
    if not left.text or not right.text:
        return right if not left.text else left
    grow = window
    while (a := _seam_before(left.text, grow)) < 0 and grow < len(left.text):
        grow *= 2
    a = max(a, 0)
    grow = window
    while (b := _seam_after(right.text, grow)) < 0 and grow < len(right.text):
        grow *= 2
    b = len(right.text) if b < 0 else b
    middle = encode(left.text[a:] + right.text[:b])
    tail, head = len(left.text[a:].encode()), len(right.text[:b].encode())
    keep = len(left.ids) - int(np.searchsorted(np.cumsum(widths[left.ids[::-1]]), tail)) - 1 if a else 0
    skip = int(np.searchsorted(np.cumsum(widths[right.ids]), head)) + 1 if b < len(right.text) else len(right.ids)
    return Segment(left.text + right.text, np.concatenate([left.ids[:keep], np.asarray(middle, np.int32), right.ids[skip:]]))


def encode_tree(text: str, encode: Callable[[str], list[int]], widths: np.ndarray, leaf: int = 2048) -> np.ndarray:
    """Ids of ``text``: halves are encoded recursively down to ``leaf`` characters and joined upwards."""

    def reduce(a: int, b: int) -> Segment:
        if b - a <= leaf:
            part = text[a:b]
            return Segment(part, np.asarray(encode(part), np.int32))
        middle = (a + b) // 2
        return join_segments(reduce(a, middle), reduce(middle, b), encode, widths)

    return reduce(0, len(text)).ids


def _encoder_mapper(shared, leaf: int):
    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state()  # a reused worker builds the encoder once
        if (made := state.get("encoder")) is None or made[0] != shared.id:
            ranks = shared.value
            widths = np.zeros(max(ranks.values()) + 1, np.int64)
            widths[list(ranks.values())] = [len(token) for token in ranks]
            made = state["encoder"] = (shared.id, make_encoder(ranks), widths)
        _, encode, widths = made
        for batch in batches:
            flat, ends = [], [0]
            for text in batch["text"].to_pylist():
                ids = () if not text else encode(text) if len(text) <= leaf else encode_tree(text, encode, widths, leaf)
                flat.append(np.asarray(ids, np.int32))
                ends.append(ends[-1] + len(ids))
            values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names=["doc_id", "ids"])

    return mapper


class _Shared:
    """A broadcast with an identity that survives pickling."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    @property
    def value(self):
        return self.broadcast.value

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    def __setstate__(self, state):
        self.__dict__.update(state)


def encode_documents(documents: DataFrame, path: str | None = None, leaf: int = 2048) -> DataFrame:
    """``(doc_id, ids)`` of each document by the vocabulary at ``path``, without special tokens.

    Null and empty texts have no ids (an empty list).  Repeated ids stay repeated; an empty table gives an empty one.
    There is no shuffle; the vocabulary is broadcast, its size being that of a file of under 1 MB.  Texts of any
    length go through ``encode_tree``, a text up to ``leaf`` characters being a single leaf.
    """
    ranks = read_vocabulary(path)
    shared = _Shared(documents.sparkSession.sparkContext.broadcast(ranks))
    return pick(documents, "doc_id", "text").mapInArrow(_encoder_mapper(shared, leaf), "doc_id long, ids array<int>")


def decode_ids(ids: list[int], vocabulary: dict[bytes, int]) -> str:
    """The text that ``ids`` spell; decoding concatenates, so it is the monoid's other direction."""
    token = {i: b for b, i in vocabulary.items()}
    return b"".join(token[i] for i in ids).decode(errors="replace")
