"""Evaluation texts inside training documents: size-partitioned MinHash containment, verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.columns import pick
from voxloom.llm.words import APOSTROPHES, CLOCKS, hash_words, plain_texts, shingle_hashes, split_words, text_slices
from voxloom.storage import write_table


@dataclass(frozen=True)
class LeakConfig:
    """What counts as found, and the search for it.

    ``run`` successive words of an item, or ``share`` of its words in order within a passage of which at most
    ``other`` as many words as matched are others.  ``shingle`` words make a shingle; ``bins`` minima make a
    signature; size classes of items grow by ``growth``.  ``block_words`` bounds the items searched for at once, and so
    what is broadcast.
    """

    run: int = 12
    share: float = 2 / 3
    other: float = 0.5
    shingle: int = 5
    bins: int = 256
    growth: float = 1.5
    block_words: int = 1_000_000


def normal_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words free of case, punctuation, blanks, invisible characters, time marks and composition."""
    plain = pc.replace_substring_regex(plain_texts(texts), pattern=CLOCKS, replacement=" ")
    return split_words(pc.replace_substring_regex(plain, pattern=APOSTROPHES, replacement=""))


def bin_minima(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash: the smallest hash of each filled bin, a bin being a range of hash values' top bits."""
    if not len(hashes):
        return hashes
    ordered = np.sort(hashes)
    which = ordered >> np.uint64(64 - (bins.bit_length() - 1))
    return ordered[np.flatnonzero(np.diff(which, prepend=np.uint64(0)) | (np.arange(len(ordered)) == 0))]


def run_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """The MinHash of each window of ``width`` successive shingles (of all, if fewer)."""
    if not len(hashes):
        return hashes
    return np.lib.stride_tricks.sliding_window_view(hashes, min(width, len(hashes))).min(axis=1)


class Lookup:
    """Sorted 64-bit values with their owners, and a bit per value's low bits, to pass most others by without a search."""

    def __init__(self, values: list[np.ndarray], owners: list[int]):
        flat = np.concatenate([np.empty(0, np.uint64), *values])
        of = np.repeat(np.array(owners, np.int64), [len(v) for v in values])
        order = np.argsort(flat, kind="stable")
        self.values, self.owners = flat[order], of[order]
        self.mask = np.uint64((1 << max(16, (8 * len(flat)).bit_length())) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)
        self.bits[(self.values & self.mask).astype(np.int64)] = True

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that are among the values."""
        at = np.flatnonzero(self.bits[(hashes & self.mask).astype(np.int64)])
        if not len(at):
            return at
        place = np.searchsorted(self.values, hashes[at])
        return at[self.values[np.minimum(place, len(self.values) - 1)] == hashes[at]]

    def pairs(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(place, owner)`` of each known hash and each owner of its value."""
        at = self.known(hashes)
        low, high = np.searchsorted(self.values, hashes[at], "left"), np.searchsorted(self.values, hashes[at], "right")
        each = high - low
        return np.repeat(at, each), self.owners[np.repeat(low - (np.cumsum(each) - each), each) + np.arange(each.sum())]


def common_words(item: np.ndarray, passage: np.ndarray) -> list[int]:
    """Places in ``passage`` of a longest sequence of words common with ``item``, in order.

    Bit-parallel: a row of the comparison is one number of as many bits as ``item`` has words, so a passage of m words
    and an item of n take m * n / 8 bytes.
    """
    masks: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        masks[word] = masks.get(word, 0) | (1 << i)
    n = len(item)
    full = (1 << n) - 1
    rows, row = [], full
    for word in passage.tolist():
        met = row & masks.get(word, 0)
        row = ((row + met) | (row - met)) & full
        rows.append(row)
    places, i, j = [], n, len(rows)
    while i and j:
        if rows[j - 1] >> (i - 1) & 1:
            i -= 1
        elif j > 1 and not rows[j - 2] >> (i - 1) & 1:
            j -= 1
        else:
            i, j = i - 1, j - 1
            places.append(j)
    return places[::-1]


class ItemIndex:
    """Signatures of the items by size class, for lookup of the minima of document windows; and seeds for dense changes.

    Class 0 holds the MinHash of every window of ``run`` words of every item: any passage of ``run`` words has the
    same one in a document, so none is missed.  The other classes partition the items by size; their signatures are
    those of whole items, and documents are cut into windows of twice the class's largest size, at steps of half of it.

    A passage whose words are replaced or left out too densely shares no shingle.  If m of an item's n words stay, and
    others come in only where some are gone, at least 2 m - n - 1 pairs of neighbours stay, so documents are searched
    for as many within the reach of a passage; an item's most frequent pairs, up to half of that number, aren't
    searched for and taken off the number.  Items shorter than a shingle are searched for by the fewest words of which
    any passage must have one.
    """

    def __init__(self, ids: list[int], items: list[np.ndarray], config: LeakConfig):
        self.config, self.ids, self.items = config, ids, items
        k = config.shingle
        self.shingles = [shingle_hashes(w, k) for w in items]
        self.seeds = [shingle_hashes(w, 2) if len(w) >= k else w for w in items]
        classes: dict[int, list[tuple[np.ndarray, int]]] = {}
        for i, (words, hashes) in enumerate(zip(items, self.shingles)):
            if not len(hashes):
                continue
            classes.setdefault(0, []).append((np.unique(run_minima(hashes, config.run - k + 1)), i))
            upper = config.run
            while upper < len(words):
                upper = int(upper * config.growth) + 1
            classes.setdefault(upper, []).append((bin_minima(hashes, config.bins), i))
        self.classes = {upper: Lookup([s for s, _ in found], [i for _, i in found]) for upper, found in classes.items()}
        self.all = Lookup([c.values for c in self.classes.values()], [0] * len(self.classes))
        self.needed = np.array([self._needed(i)[1] for i in range(len(items))], np.int64)
        self.reach = np.array([int(len(w) * (1 + config.other)) for w in items], np.int64)
        every = np.concatenate([np.empty(0, np.uint64), *[np.unique(s) for s in self.seeds]])
        values, times = np.unique(every, return_counts=True)
        pairs, words, self.dense = [], [], np.zeros(len(items), np.int64)
        for i, seeds in enumerate(self.seeds):
            seeds = np.unique(seeds)
            rarest = seeds[np.argsort(times[np.searchsorted(values, seeds)], kind="stable")]
            if len(items[i]) >= k:
                gone = int(self.needed[i]) // 2
                self.dense[i] = self.needed[i] - gone
                pairs.append((rarest[: len(rarest) - gone], i))
            elif len(rarest):  # without these, too few words are left
                left = len(items[i]) - np.cumsum([0, *((items[i] == w).sum() for w in rarest)])
                words.append((rarest[: int(np.argmax(left < self._needed(i)[0]))], i))
        self.pairs = Lookup([p for p, _ in pairs], [i for _, i in pairs])
        self.words = Lookup([w for w, _ in words], [i for _, i in words])

    def _needed(self, i: int) -> tuple[int, int]:
        """Words of item ``i`` that a passage must have, and seeds among them."""
        n = len(self.items[i])
        words = int(np.ceil(self.config.share * n - 1e-9))
        # seeds that an item repeats count once, which may leave fewer of them
        return words, max(1, 2 * words - n - 1 - (len(self.seeds[i]) - len(np.unique(self.seeds[i])))) if n >= self.config.shingle else 1

    def candidates(self, hashes: np.ndarray) -> set[int]:
        """Items that share a MinHash value with some window of a document."""
        out: set[int] = set()
        config = self.config
        for upper, lookup in self.classes.items():
            if upper == 0:
                out.update(lookup.pairs(np.unique(run_minima(hashes, config.run - config.shingle + 1)))[1].tolist())
                continue
            step = max(1, upper // 2)
            for a in range(0, max(1, len(hashes) - 3 * step), step):
                out.update(lookup.pairs(bin_minima(hashes[a : a + 4 * step], config.bins))[1].tolist())
        return out

    def dense_candidates(self, words: np.ndarray, doc: np.ndarray) -> set[tuple[int, int]]:
        """``(document, item)`` by seeds that lie close together; ``doc`` numbers the documents of the words."""
        out: set[tuple[int, int]] = set()
        place, owner = self.words.pairs(words)
        out.update(zip(doc[place].tolist(), owner.tolist()))
        couples = shingle_hashes(words, 2)
        place, owner = self.pairs.pairs(couples)
        inside = doc[place] == doc[np.minimum(place + 1, len(doc) - 1)]
        place, owner = place[inside], owner[inside]
        order = np.lexsort((place, owner, doc[place]))
        place, owner = place[order], owner[order]
        last = np.arange(len(place)) + self.dense[owner] - 1
        fits = last < len(place)
        first, last = np.flatnonzero(fits), last[fits]
        close = (owner[first] == owner[last]) & (doc[place[first]] == doc[place[last]]) & (place[last] - place[first] <= self.reach[owner[first]])
        out.update(zip(doc[place[first[close]]].tolist(), owner[first[close]].tolist()))
        return out

    def holds(self, words: np.ndarray, i: int) -> bool:
        """Whether a document holds item ``i``, by exact comparison of their words."""
        config, item = self.config, self.items[i]
        n = len(item)
        if n >= config.run and np.isin(shingle_hashes(item, config.run), shingle_hashes(words, config.run)).any():
            return True
        need, seeds = self._needed(i)
        reach = int(self.reach[i])
        at = np.flatnonzero(np.isin(shingle_hashes(words, 2) if n >= config.shingle else words, self.seeds[i]))
        first = at[: len(at) - seeds + 1] if len(at) >= seeds else at[:0]
        first = first[at[seeds - 1 :][: len(first)] - first <= reach]
        # a passage begins within its reach ahead of such seeds; windows of two reaches at steps of one hold it whole
        starts = np.unique(np.concatenate([np.maximum(first - reach, 0) // reach, first // reach]) * reach) if len(first) else []
        return any(self._in_order(item, words[a : a + 2 * reach], need) for a in starts)

    def _in_order(self, item: np.ndarray, passage: np.ndarray, need: int) -> bool:
        """Whether ``need`` words of ``item`` occur in order in a stretch of ``passage`` with few others."""
        if len(common_words(item, passage)) < need:
            return False
        most, step = int(len(item) * (1 + self.config.other)), max(1, len(item) // 8)
        for a in range(0, max(1, len(passage) - need + 1), step):
            places = np.array(common_words(item, passage[a : a + most + step]))
            for count in range(need, len(places) + 1):
                if (places[count - 1 :] - places[: len(places) - count + 1] + 1 <= count * (1 + self.config.other)).any():
                    return True
        return False


def _search_mapper(shared):
    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: ItemIndex = shared.value
        k = index.config.shingle
        for batch in (part for whole in batches for part in text_slices(whole)):
            docs = batch["doc_id"].to_pylist()
            words, ends = normal_words(batch["text"])
            hashes, _, _ = hash_words(words)
            starts = np.concatenate([[0], ends[:-1]])
            shingles = shingle_hashes(hashes, k)
            hit = index.all.known(shingles)
            of = np.searchsorted(ends, hit, "right")
            of = of[hit + k <= ends[of]]  # not across two documents
            wanted = index.dense_candidates(hashes, np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)))
            for d in np.unique(of).tolist():
                wanted |= {(d, i) for i in index.candidates(shingles[starts[d] : ends[d] - k + 1])}
            found = [(docs[d], index.ids[i]) for d, i in sorted(wanted) if index.holds(hashes[starts[d] : ends[d]], i)]
            columns = list(zip(*found)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id"])

    return mapper


def leaked_items(documents: DataFrame, items: DataFrame, config: LeakConfig = LeakConfig()) -> DataFrame:
    """``(doc_id, item_id)`` of each document and item found in it (see ``LeakConfig``).

    Null, empty and blank texts hold nothing and are found nowhere.  Items with equal texts are found alike.  A repeated
    document row repeats its result rows; extra columns are ignored.

    Documents stay where they are: no shuffle.  Items are a stated query set and searched for in blocks of a bounded
    number of words, whose index (some tens of bytes a word) is broadcast.  Of several blocks one is searched for at a
    time, its rows are written and its broadcast is given up, so memory is that of one block at any number of items; the
    passes over the documents follow the items only.
    """
    spark = items.sparkSession
    known = pick(items, "item_id", "text").filter(F.col("item_id").isNotNull() & (F.length("text") > 0))
    size = known.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (4 * config.block_words)))
    parts = []
    for b in range(blocks):
        rows = known.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        words, ends = normal_words(pa.array([r["text"] for r in rows], pa.string()))
        hashes, _, _ = hash_words(words)
        shared = spark.sparkContext.broadcast(ItemIndex([r["item_id"] for r in rows], np.split(hashes, ends[:-1]) if rows else [], config))
        found = pick(documents, "doc_id", "text").mapInArrow(_search_mapper(shared), "doc_id long, item_id long")
        if blocks > 1:
            found, _ = write_table(found, "found")
            shared.destroy()
        parts.append(found)
    return reduce(DataFrame.unionByName, parts)
