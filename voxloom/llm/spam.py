"""Keyword-stuffed and link-list pages, by pointwise mutual information of neighbouring words in the corpus."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.columns import pick
from voxloom.llm.words import APOSTROPHES, CLOCKS, hash_words, mix, plain_texts, shingle_hashes, text_slices
from voxloom.storage import shuffle_width, write_table


@dataclass(frozen=True)
class SpamConfig:
    """When words count as stuffed, and a document as spam.

    A pair of neighbouring words has its pointwise mutual information in bits, from the counts of all other texts (copies
    are one text), up to ``ceiling``; a repeated collocation has ``repeated``: one that the document holds ``repeats`` times and
    more, at most ``near`` words apart or not as part of a repeated passage of ``passage`` words, with a bursty word.
    A word is bursty if it is there ``repeats`` times and ``burst`` times as often as in the corpus.

    Decided is by the mean over sliding runs.  The pairs within ``salad_reach`` are word salad if their mean is below
    ``salad``: such words meet less often than chance would have it.  A mean about 0 only says that the corpus doesn't
    know the pairs; the pairs within ``reach`` are keywords if their mean is below ``coherent`` and at least ``keywords``
    of them have a bursty word.  A document is spam if more than ``share`` of its words lie in such runs, or are
    hashtags, links or the up to ``anchor`` words of a link's line.
    """

    coherent: float = 0.5
    salad: float = -0.5
    ceiling: float = 1.0
    repeated: float = -0.5
    smoothing: float = 1.0
    keywords: float = 0.7
    reach: int = 8
    salad_reach: int = 16
    repeats: int = 3
    near: int = 8
    passage: int = 8
    burst: float = 4.0
    share: float = 0.5
    anchor: int = 8


#: Packs of a task whose requests are summed before they leave it: some 16 MB of text, 200 MB of working memory.
BUNDLE = 4
#: Words whose requests go to one range of keys: a range's share of all requests stays within some ten megabytes.
RANGE_WORDS = 4_000_000
#: Text that was decoded from UTF-8 as Latin-1.
_MOJIBAKE = re.compile("(?:[Â-ß][\u0080-¿]|[à-ï][\u0080-¿]{2}|[ð-ô][\u0080-¿]{3})+")
#: Private characters that stand for a link and ahead of a hashtag.
_LINK, _TAG = "\ue000", "\ue001"
#: Rewrites ahead of splitting into lines and words, in RE2's notation: anchors with a target, which become lines of
#: their own that begin with a link; breaks, other markup, entities, targets of written links, bare links, hashtags,
#: line ends.
_REWRITES = (
    (r"""(?i)<a\s(?:[^<>]*\s)?href\s*=\s*["']?\s*[^"'#\s<>][^<>]*>""", f"\n {_LINK} "),
    (r"(?i)</a\s*>", "\n"),
    (r"<(?:br|/?p|/?div|/?li|/?tr)\b[^<>]*>", "\n"),
    (r"</?[A-Za-z][^<>]*>", " "),
    (r"&(?:#\d+|#x[0-9A-Fa-f]+|\w+);", " "),
    (r"\]\((?:https?://|www\.)[^\s)]*\)?", f" {_LINK} "),
    (r"(?:https?://|www\.)[^\s<>]+", f" {_LINK} "),
    (r"#([\p{L}\p{N}_]+)", f" {_TAG}\\1 "),
    (r"[\r\n\v\f\x{85}\x{2028}\x{2029}]+", "\n"),
)


def _repair(match: re.Match) -> str:
    try:
        return match.group().encode("latin-1").decode()
    except UnicodeError:
        return match.group()


def page_words(texts: pa.Array, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code per plain word, hash per code, document per plain word, and counts per document.

    The counts are of all words, and of those that are hashtags or links with the words of their lines.  Numbers are
    no words.  Texts in a broken encoding are repaired first, as their bytes would repeat like keywords.
    """
    texts = pc.fill_null(texts, "")
    broken = pc.match_substring_regex(texts, r"[\x{C2}-\x{F4}][\x{80}-\x{BF}]")
    if pc.any(broken).as_py():
        texts = pa.array([_MOJIBAKE.sub(_repair, t) if b else t for t, b in zip(texts.to_pylist(), broken.to_pylist())], pa.string())
    for pattern, replacement in _REWRITES:
        texts = pc.replace_substring_regex(texts, pattern=pattern, replacement=replacement)
    texts = pc.replace_substring_regex(plain_texts(texts), pattern=CLOCKS, replacement=" ")
    texts = pc.replace_substring_regex(texts, pattern=APOSTROPHES, replacement="")
    n = len(texts)
    lines = pc.split_pattern(texts, "\n")
    line_doc = pc.list_parent_indices(lines).to_numpy()
    split = pc.split_pattern_regex(pc.list_flatten(lines), pattern=rf"[^\p{{L}}\p{{N}}\p{{M}}_{_LINK}{_TAG}]+")
    line, words = pc.list_parent_indices(split).to_numpy(), pc.list_flatten(split)
    hashes, unique, codes = hash_words(words)
    kind = np.array([0 if not w or w.replace("_", "").isdigit() or not w.strip("_") else 2 if w[0] == _LINK else 3 if w[0] == _TAG else 1 for w in unique.to_pylist()], np.int8)
    kinds = kind[codes] if len(codes) else np.empty(0, np.int8)
    real = kinds > 0
    codes, line, kinds = codes[real], line[real], kinds[real]
    doc = line_doc[line] if len(line) else np.empty(0, np.int64)
    per_line = np.bincount(line, minlength=len(line_doc))
    links = np.bincount(line, weights=kinds == 2, minlength=len(line_doc))
    linked = (kinds == 2) | (links[line] > 0) & ((per_line - links)[line] <= anchor)
    special = linked | (kinds == 3)
    each = np.zeros(len(unique), np.uint64)
    each[codes] = hashes[real]
    plain = ~special
    counts = np.stack([np.bincount(doc, minlength=n), np.bincount(doc, weights=special, minlength=n).astype(np.int64)])
    return codes[plain].astype(np.int64), each, doc[plain], counts


def neighbours(codes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs' first words, their pair codes, and their order by document, pair and place."""
    at = np.flatnonzero(doc[1:] == doc[:-1])
    pair = codes[at] * size + codes[at + 1]
    return at, pair, np.lexsort((pair, doc[at]))


def text_keys(codes: np.ndarray, each: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """128-bit hash of each document's plain words in order: equal for copies."""
    import xxhash

    words = each[codes]
    return [xxhash.xxh3_128_digest(words[x:y].tobytes()) for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())]


def count_requests(codes: np.ndarray, each: np.ndarray, doc: np.ndarray, counted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What a pack asks of the corpus: sorted keys with its own counts; and the places of its pairs and words there.

    Keys are the pairs' hashes, each word's as a left and as a right neighbour, and one for the total.  A pair counts
    once in a document, so a page can't make its keywords common.  ``counted`` flags the documents that count (all by
    default); the others, copies of texts that count elsewhere, only ask.
    """
    size = len(each)
    at, pair, order = neighbours(codes, doc, size)
    sorted_pair, sorted_doc = pair[order], doc[at][order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_pair[1:] != sorted_pair[:-1]) | (sorted_doc[1:] != sorted_doc[:-1])
    pairs, which = np.unique(sorted_pair[new], return_inverse=True)
    weights = np.ones(len(which), np.int64) if counted is None else counted[sorted_doc[new]].astype(np.int64)
    df = np.bincount(which, weights=weights, minlength=len(pairs)).astype(np.int64)
    left = np.bincount(pairs // size, weights=df, minlength=size).astype(np.int64)
    right = np.bincount(pairs % size, weights=df, minlength=size).astype(np.int64)
    with np.errstate(over="ignore"):
        a, b = each[pairs // size], each[pairs % size]
        keys = np.concatenate([mix(a * np.uint64(0x9E3779B97F4A7C15) + b), mix(each + np.uint64(0x51ED270B)), mix(each + np.uint64(0x2545F491)), np.zeros(1, np.uint64)])
    unique, place = np.unique(keys, return_inverse=True)
    total = np.bincount(place, weights=np.concatenate([df, left, right, [int(weights.sum())]]), minlength=len(unique)).astype(np.int64)
    return unique, total, pairs, place[: len(pairs)], place[len(pairs) :]


def _pack_mapper(config: SpamConfig):
    """Arrow mapper: texts to packs of words, with a key for each text."""

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in (s for whole in batches for s in text_slices(whole)):
            codes, each, doc, counts = page_words(batch["text"], config.anchor)
            pack = (part << 32) + number
            number += 1
            small = codes.astype(np.uint16 if len(each) < 1 << 16 else np.uint32)
            ends = np.searchsorted(doc, np.arange(batch.num_rows), "right")
            ids = batch["doc_id"]
            present = ids.is_valid().to_numpy(zero_copy_only=False)
            blobs = [small, each, ends.astype(np.int64), counts, pc.fill_null(ids, 0).to_numpy(), present]
            row = {"pack": pack, "bundle": (part << 32) + (number - 1) // BUNDLE, **{f"b{i}": x.tobytes() for i, x in enumerate(blobs)}, "texts": text_keys(codes, each, ends)}
            schema = pa.schema([("pack", pa.int64()), ("bundle", pa.int64()), *((f"b{i}", pa.binary()) for i in range(len(blobs))), ("texts", pa.list_(pa.binary()))])
            yield pa.RecordBatch.from_pylist([row], schema)

    return mapper


def _pack_words(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Word codes, hash per code, document per word and number of documents of a pack."""
    each = np.frombuffer(row["b1"], np.uint64)
    codes = np.frombuffer(row["b0"], np.uint16 if len(each) < 1 << 16 else np.uint32).astype(np.int64)
    ends = np.frombuffer(row["b2"], np.int64)
    return codes, each, np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)), len(ends)


def _bundle_keys(asked: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the requests of several packs, and the sums of their counts."""
    if not asked:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keys, place = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
    return keys, np.bincount(place, weights=np.concatenate([a[1] for a in asked]), minlength=len(keys)).astype(np.int64)


def _request_pieces(ranges: int):
    """Requests of a bundle of packs, summed and cut by ranges of the keys; ``firsts`` has the texts that count."""
    schema = pa.schema([("bundle", pa.int64()), ("piece", pa.int32()), ("keys", pa.binary()), ("own", pa.binary())])

    def request(packs: pa.Table, firsts: pa.Table) -> pa.Table:
        rows, asked = [], []
        first_pack, first_place = firsts["pack"].to_numpy(), firsts["place"].to_numpy()
        for row in packs.to_pylist():
            codes, each, doc, n = _pack_words(row)
            counted = np.zeros(n, bool)
            counted[first_place[first_pack == row["pack"]]] = True
            asked.append(count_requests(codes, each, doc, counted)[:2])
        keys, own = _bundle_keys(asked)
        of = (keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
        cuts = np.searchsorted(of, np.arange(ranges + 1))
        for r in np.flatnonzero(np.diff(cuts)).tolist():
            x, y = cuts[r], cuts[r + 1]
            rows.append({"bundle": packs["bundle"][0].as_py(), "piece": r, "keys": keys[x:y].tobytes(), "own": own[x:y].astype(np.uint32).tobytes()})
        return pa.Table.from_pylist(rows, schema)

    return request


def _sum_piece(table: pa.Table) -> pa.Table:
    """Corpus counts of one range of keys, as replies to the bundles that asked."""
    keys = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
    own = [np.frombuffer(k, np.uint32) for k in table["own"].to_pylist()]
    unique, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate(own)).astype(np.int64)
    total = total.astype(np.uint32 if total.max() < 1 << 32 else np.int64)[place]
    replies = np.split(total, np.cumsum([len(k) for k in keys])[:-1])
    return pa.table({"bundle": table["bundle"], "piece": table["piece"], "width": pa.array([total.itemsize] * len(replies), pa.int32()), "total": pa.array([r.tobytes() for r in replies], pa.binary())})


def _run_means(values: np.ndarray, doc: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of the values within ``reach`` places in the same document, and their number."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    i = np.arange(len(values))
    low = np.maximum(i - reach, np.searchsorted(doc, doc, "left"))
    high = np.minimum(i + reach + 1, np.searchsorted(doc, doc, "right"))
    return (sums[high] - sums[low]) / np.maximum(high - low, 1), high - low


def _nearest(order: np.ndarray, same: np.ndarray, length: int) -> np.ndarray:
    """Distance of each place to the nearest one with the same value; ``same`` tells neighbours in ``order``."""
    nearest = np.full(length, 1 << 40)
    step = np.abs(order[1:] - order[:-1])[same]
    np.minimum.at(nearest, order[1:][same], step)
    np.minimum.at(nearest, order[:-1][same], step)
    return nearest


def stuffed_words(codes: np.ndarray, each: np.ndarray, doc: np.ndarray, totals: np.ndarray, config: SpamConfig, docs: int, asked: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Stuffed plain words and mean mutual information per document.  ``totals`` answers ``asked``, of ``count_requests``."""
    size = len(each)
    at, pair, order = neighbours(codes, doc, size)
    if not len(at):
        return np.zeros(docs, np.int64), np.full(docs, np.nan)
    _, _, pairs, pair_place, word_place = asked or count_requests(codes, each, doc)
    corpus = float(totals[word_place[-1]])
    left, right = totals[word_place[:size]].astype(float), totals[word_place[size : 2 * size]].astype(float)
    a, b, of = codes[at], codes[at + 1], doc[at]
    others = totals[pair_place[np.searchsorted(pairs, pair)]] - 1.0
    expected = left[a] * right[b] / corpus
    pmi = np.log2((others + config.smoothing) / (expected + config.smoothing))

    same = (pair[order][1:] == pair[order][:-1]) & (of[order][1:] == of[order][:-1])
    group = np.cumsum(np.concatenate([[True], ~same])) - 1
    times = np.empty(len(pair), np.int64)
    times[order] = np.bincount(group)[group]
    repeated = times >= config.repeats
    near = _nearest(order, same, len(pair)) <= config.near

    # words within a passage that the document repeats at some distance
    k = config.passage
    passages = shingle_hashes(each[codes], k)
    inside = doc[: len(passages)] == doc[k - 1 :]
    starts = np.flatnonzero(inside & np.isin(doc[: len(passages)], np.unique(of[repeated])))
    by_value = starts[np.lexsort((passages[starts], doc[starts]))]
    equal = (passages[by_value][1:] == passages[by_value][:-1]) & (doc[by_value][1:] == doc[by_value][:-1])
    distance = _nearest(by_value, equal, len(codes))
    far = np.flatnonzero((distance >= k) & (distance < 1 << 40))
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, far, 1)
    np.add.at(cover, far + k, -1)
    covered = np.cumsum(cover)[:-1] > 0
    passage = covered[at] & covered[at + 1]

    word = doc * size + codes
    _, who, tf = np.unique(word, return_inverse=True, return_counts=True)
    tf, length = tf[who], np.bincount(doc, minlength=docs)[doc]
    bursty = (tf >= config.repeats) & (tf >= config.burst * length * (left[codes] + right[codes]) / (2 * corpus))

    keyword = bursty[at] | bursty[at + 1]
    coherence = np.where(repeated & (near | ~passage) & keyword, config.repeated, np.minimum(pmi, config.ceiling))
    mean_here, _ = _run_means(coherence, of, config.reach)
    mean_salad, pairs_around = _run_means(np.minimum(pmi, config.ceiling), of, config.salad_reach)
    dense = (mean_here < config.coherent) & (_run_means(keyword, of, config.reach)[0] >= config.keywords)
    dense |= (mean_salad < config.salad) & (pairs_around >= config.salad_reach)
    stuffed = np.zeros(len(codes), bool)
    stuffed[at] |= dense
    stuffed[at + 1] |= dense
    mean = np.bincount(of, weights=pmi, minlength=docs) / np.maximum(1, np.bincount(of, minlength=docs))
    return np.bincount(doc, weights=stuffed, minlength=docs).astype(np.int64), mean


def _score_pack(config: SpamConfig):
    def score(packs: pa.Table, replies: pa.Table) -> pa.Table:
        out, order, asked = [], np.argsort(replies["piece"].to_numpy()), []
        blobs, widths = replies["total"].to_pylist(), replies["width"].to_pylist()
        totals = np.concatenate([np.frombuffer(blobs[i], np.uint32 if widths[i] == 4 else np.int64).astype(np.int64) for i in order]) if len(order) else np.empty(0, np.int64)
        packs = packs.to_pylist()
        for row in packs:
            codes, each, doc, _ = _pack_words(row)
            asked.append(count_requests(codes, each, doc))
        keys, _ = _bundle_keys(asked)
        for row, ask in zip(packs, asked):
            codes, each, doc, n = _pack_words(row)
            words, special = np.frombuffer(row["b3"], np.int64).reshape(2, n)
            ids, present = np.frombuffer(row["b4"], np.int64), np.frombuffer(row["b5"], bool)
            stuffed, mean = stuffed_words(codes, each, doc, totals[np.searchsorted(keys, ask[0])], config, n, ask)
            share = (stuffed + special) / np.maximum(words, 1)
            out.append(pa.table({"doc_id": pa.array(ids, pa.int64(), mask=~present), "words": words, "special": special, "stuffed": stuffed, "mean_pmi": pa.array(mean, from_pandas=True), "share": share}))
        return pa.concat_tables(out) if out else pa.table({"doc_id": pa.array([], pa.int64()), "words": pa.array([], pa.int64()), "special": pa.array([], pa.int64()), "stuffed": pa.array([], pa.int64()), "mean_pmi": pa.array([], pa.float64()), "share": pa.array([], pa.float64())})

    return score


def stuffing_scores(documents: DataFrame, config: SpamConfig = SpamConfig(), ranges: int | None = None) -> DataFrame:
    """``(doc_id, words, special, stuffed, mean_pmi, share)`` per document.

    ``special`` counts hashtags and links with their anchors, ``stuffed`` the other words found stuffed, ``share``
    both among all words (0 where there are none, as in null, empty and blank texts).  Rows stay one for one.

    Texts are split into words once, in packs of some megabytes that are written in compact form.  Of texts with the
    same plain words only the first counts, so copies don't make each other's pairs common; all get a verdict.  Each
    bundle of packs asks for the corpus counts of its own pairs and words only, summed ahead of the shuffle: requests
    meet by ranges of the pairs' hashes, where a pair that all documents hold is one entry a bundle, and the replies go
    back.  Ranges are as many as the corpus has words for (``RANGE_WORDS`` each), so that one stays within some
    ten megabytes.  No corpus-wide table is collected or broadcast and no key is hot.
    """
    spark = documents.sparkSession
    blobs = ", ".join(f"b{i} binary" for i in range(6))
    packed, _ = write_table(pick(documents, "doc_id", "text").mapInArrow(_pack_mapper(config), f"pack long, bundle long, {blobs}, texts array<binary>"), "packs")
    if ranges is None:
        words = packed.agg(F.sum(F.octet_length("b0"))).first()[0] or 0
        ranges = max(shuffle_width(spark), -(-words // (2 * RANGE_WORDS)))
    texts = packed.select("bundle", "pack", F.posexplode("texts").alias("place", "text"))
    firsts = texts.groupBy("text").agg(F.min(F.struct("bundle", "pack", "place")).alias("first")).select("first.bundle", "first.pack", "first.place")
    packs = packed.drop("texts").groupBy("bundle")
    requests = packs.cogroup(firsts.groupBy("bundle")).applyInArrow(_request_pieces(ranges), "bundle long, piece int, keys binary, own binary").repartition(ranges, "piece")
    replies = requests.groupBy("piece").applyInArrow(_sum_piece, "bundle long, piece int, width int, total binary")
    return packs.cogroup(replies.groupBy("bundle")).applyInArrow(_score_pack(config), "doc_id long, words long, special long, stuffed long, mean_pmi double, share double")


def stuffed_pages(documents: DataFrame, config: SpamConfig = SpamConfig()) -> DataFrame:
    """``doc_id`` of the documents more than ``config.share`` of whose words are stuffed, links or tags."""
    return stuffing_scores(documents, config).filter(F.col("share") > config.share).select("doc_id")
