"""Turns, canonical forms, encodings, leaks and stuffing: cases, brute force and round trips."""

import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxloom.llm import canonical, encoding, leakage, spam, turns
from voxloom.llm.words import text_slices

ALIASES = {"host": "SPK00", "co-host": "SPK04", "guest": "SPK01", "المذيع": "SPK00"}
FILLERS = ["um", "hmm", "you know", "يعني", "آآ"]


@pytest.fixture(scope="module")
def parser():
    return turns.make_parser(ALIASES, FILLERS)


@pytest.mark.parametrize(("text", "want"), [
    ("Host: Hello, UMMM... world!", [("SPK00", "hello world")]),
    ("spk 1 : a\nSPEAKER_01： b\n(Guest) c\n<v S2>d [background noise] e", [("SPK01", "a b c"), ("SPK02", "d e")]),
    ("[00:00:09] Guest: two\n(0:00:05) Host: one\n[00:00:12] three", [("SPK00", "one"), ("SPK01", "two three")]),
    ("00:00:09,000 --> 00:00:10,000 Guest: two\nHost: one", [("SPK01", "two"), ("SPK00", "one")]),
    ("0:09 Guest: b\n0:09 Host: c\n0:01 Guest: a", [("SPK01", "a b"), ("SPK00", "c")]),
    ("- co-host: x &gt;&gt; [Host] um, [Guest] you, know y &nbsp; <00:00:01.000> <c>z</c> *laugh* {cough} ♪ ♪", [("SPK04", "x"), ("SPK01", "y z")]),
    ("lead Host: a", [(None, "lead"), ("SPK00", "a")]),
    ("المذيع： مرحبا؟ يعععني... بكم", [("SPK00", "مرحبا بكم")]),
    ("Host: umbrella hmm hm\r\nGuest: [noise] um\r\nhost: again", [("SPK00", "umbrella hm again")]),
])
def test_turns(parser, text, want):
    has, _, clean = parser
    assert has(text) and clean(text) == want


def test_no_label(parser):
    assert not any(map(parser[0], ["", "the host said", "ghost: x", "[music] a", "channels 2 : no"]))
    assert parser[2]("") == []


def test_order_segments():
    lines = lambda times, labels=(): turns.order_segments(len(times), *turns.line_constraints(times, list(labels) or [False] * len(times)))
    assert lines([3.0, 1.0, 1.0, 2.0]) == ([1, 2, 3, 0], [(0, 1)])  # the cue contradicts the times
    assert lines([3.0, None, 1.0]) == ([0, 1, 2], []) and lines([]) == ([], [])
    assert lines([2.0, 1.0, 1.0], [True, False, False])[1] == [(0, 1), (0, 1), (0, 2)]
    # a cycle loses its weakest edge; edges across a level that say the same are kept
    assert turns.order_segments(3, [], [(0, 1), (1, 2), (2, 0)]) == ([0, 1, 2], [(2, 0)])
    assert turns.order_segments(4, [[1, 0, 1, 0]], [(3, 1), (2, 0), (0, 2), (1, 0)]) == ([3, 1, 2, 0], [(0, 2)])
    # words: places hold against times
    assert turns.order_segments(4, *turns.word_constraints([1.0, 3.0, None, 2.0])) == ([0, 1, 2, 3], [(3, 1)])


@pytest.mark.parametrize("text", ["[" + "noise " * 80 + "]", "(" + "x" * 300 + ")", "{" + "a b " * 90 + "}", "*" + "laughs " * 30 + "on*", "<font color='" + "y" * 200 + "'>"])
def test_long_annotations_are_no_words(parser, text):
    assert parser[2](f"Host: a {text} b") == [("SPK00", "a b")]


def stream(spark, words, kind="video_id string, pos int, text string, start double"):
    return spark.createDataFrame([(*w, None if w[1] is None else -float(w[1])) for w in words], kind)


def held_against_whole(spark, parser, words, size):
    got = turns.stream_turns(stream(spark, words), ALIASES, FILLERS, size).collect()
    for video in {v for v, _, t in words if v is not None}:
        unique = {}
        for v, pos, t in words:
            if v == video and pos is not None and t is not None:
                unique[pos] = min(t, unique.get(pos, t))
        want = [(k, *t) for k, t in enumerate(parser[2](" ".join(unique[k] for k in sorted(unique))))]
        assert sorted((r["turn_index"], r["speaker"], r["clean_text"]) for r in got if r["video_id"] == video) == want


@pytest.mark.parametrize("size", [8, 64, 4096])
def test_streams_in_blocks(spark, parser, size):
    rng = random.Random(size)
    pieces = ["Host:", "guest :", "Speaker", "2:", "[background", "noise]", "um", "you", "know", "a", "b", "<v", "S1>", "c.", "hmm", "plain", "words", "here"]
    words = [("v", i, rng.choice(pieces)) for i in range(900)] + [("w", i, rng.choice(pieces)) for i in range(5)]
    held_against_whole(spark, parser, words + words[:50] + [("v", None, "x"), (None, 1, "x"), ("v", 901, None)], size)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sparse_streams_with_open_brackets(spark, parser, seed):
    rng = random.Random(seed)
    odd = ["(", ")", "[", "]", "{x", "y}", "*laughs*", "*", "*a", "b*", "<", ">", "<b>", "00:01", "-->", "00:02", "Speaker", "2:", "- -", "Guest:", "you", "know", "&nbsp;"]
    pos, words = 0, []
    for _ in range(1200):
        pos += rng.choice([1, 1, 7, 60])
        words.append(("v", pos, rng.choice(odd) if rng.random() < 0.1 else rng.choice(["plain", "words", "here", "again"])))
    words += [("long", i, "w") for i in range(20)] + [("long", 20, "[open")] + [("long", 21 + 60 * i, "w") for i in range(60)] + [("long", 9000, "end]"), ("long", 9001, "Host:"), ("long", 9002, "x")]
    words += [("far", 4090, "Speaker"), ("far", 4150, "2:"), ("far", 5000, "hello"), ("far", 1, "Host:"), ("far", 2, "hi")]
    held_against_whole(spark, parser, words, 8)


def test_clean_turns_tables(spark):
    chunks = spark.createDataFrame([("v", 0, "Host: hi"), ("v", 1, None), ("v", 2, ""), ("v", 3, "no label"), ("v", 4, "Host: " + "word " * 20000)], "video_id string, chunk_index int, text_yt string").withColumn("words", F.lit(1)).withColumn("block", F.lit(2))
    alias = spark.createDataFrame(list(ALIASES.items()), "alias string, speaker string")
    filler = spark.createDataFrame([(f, "en") for f in FILLERS] + [(None, None)], "term string, lang string")
    words = stream(spark, [("v", 0, "Host:"), ("v", 1, "x")])
    got = turns.clean_turns(chunks, words, alias, filler)
    assert sorted((r["field"], r["chunk_index"], len(r["clean_text"])) for r in got.collect()) == [("sub_word", -1, 1), ("text_yt", 0, 2), ("text_yt", 4, 99999)]
    assert turns.clean_turns(chunks.limit(0), words.limit(0), alias.limit(0), filler.limit(0)).count() == 0


@pytest.fixture(scope="module")
def same():
    return canonical.make_canonical()


@pytest.mark.parametrize(("a", "b"), [("ｗｈｉｌｅ", "while"), ("café", "café"), ("a​b­c", "abc"), ("a   b ", "a b"), ("Тhе", "The"), ("كيت", "کیت"), ("أ", "أ"), ("ﻣت", "مت"), ("ﬁne", "fine"), ("Νοte", "Note"), ("", " ​"), ("ȩ́", "ȩ́")])
def test_same_look(same, a, b):
    assert same(a) == same(b)


@pytest.mark.parametrize(("a", "b"), [("cafe", "café"), ("Case", "case"), ("a b", "ab"), ("ا", "أ"), ("x²", "x2"), ("في", "فی"), ("a.", "a"), ("½", "1⁄2")])
def test_other_look(same, a, b):
    assert same(a) != same(b)


def test_foreign_words_stay(same):
    assert same("мир и дом") == "мир и дом" and same(None) is None


@given(st.text(alphabet="aȩ́́  ​кٔاａﬁ각가\n\x00z", max_size=30))
@settings(max_examples=300, deadline=None)
def test_canonical_is_stable_and_composed(text):
    form = _SAME(text)
    assert _SAME(form) == form and unicodedata.is_normalized("NFC", form) and _SAME(unicodedata.normalize("NFD", text)) == form


@pytest.mark.parametrize(("text", "want"), [
    ("кот и кит", "кот и кит"), ("και τα", "και τα"), ("привет", "привет"), ("сор", "cop"), ("tоkеn", "token"), ("Ꭰоg", "Dog"),
    ("а\u0301b", "\u00e1b"), ("ى\u0654 ", "ى\u0654".replace("ى", "ى")), ("ی\u0654ا", unicodedata.normalize("NFC", "ي\u0654ا")), ("e\u200b\u0301", "\u00e9"),
])
def test_words_of_other_scripts_stay(text, want):
    got = canonical.make_canonical()(text)
    assert got == want.strip() and unicodedata.is_normalized("NFC", got)


_SAME = canonical.make_canonical()


def test_look_alike_fields(spark, rows):
    kind = "video_id string, chunk_index int, text string, text_yt string, text_cohere string"
    df = spark.createDataFrame([("v", 0, "a b", "a b", "a b"), ("v", 1, "a", None, ""), ("v", 2, None, "a", "b"), ("v", 3, "a", "A", "а"), ("v", 4, "x " * 9000, "x " * 9000, None), ("v", 0, "a b", "a b", "a b")], kind)
    got = canonical.look_alike_fields(df.withColumn("text_canonical", F.lit("z")))
    assert rows(got) == [("v", 0, "text_yt"), ("v", 0, "text_yt"), ("v", 3, "text_cohere"), ("v", 4, "text_yt")]
    assert canonical.look_alike_fields(df.limit(0)).count() == 0
    assert canonical.canonical_texts(df.withColumn("text_canonical", F.lit(1)), ["text"]).count() == 6


@pytest.fixture(scope="module")
def coder():
    ranks = encoding.read_vocabulary()
    widths = np.zeros(max(ranks.values()) + 1, np.int64)
    widths[list(ranks.values())] = [len(t) for t in ranks]
    return ranks, encoding.make_encoder(ranks), widths


@given(st.lists(st.sampled_from(["a", "'", "ve", "'ll", " ", "  ", "\n", " ", "　", "é", "é", "1", "!", "\x1c", "ب", "\U0001f600", "don't", "word"]), max_size=60), st.integers(1, 9))
@settings(max_examples=400, deadline=None)
def test_tree_equals_whole(parts, leaf):
    text = "".join(parts)
    assert encoding.encode_tree(text, _CODER[1], _CODER[2], leaf).tolist() == _CODER[1](text)


_RANKS = encoding.read_vocabulary()
_WIDTHS = np.zeros(max(_RANKS.values()) + 1, np.int64)
_WIDTHS[list(_RANKS.values())] = [len(t) for t in _RANKS]
_CODER = _RANKS, encoding.make_encoder(_RANKS), _WIDTHS


def test_encode_documents(spark, coder):
    ranks, encode, _ = coder
    texts = ["", None, "hello world", "<|endoftext|>", "x" * 50_000, "a b\n" * 20_000, "مرحبا " * 3000, "hello world"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("TEXT_", F.lit("q"))
    got = {r["doc_id"]: r["ids"] for r in encoding.encode_documents(df).collect()}
    assert all(got[i] == (encode(t) if t else []) for i, t in enumerate(texts))
    assert all(encoding.decode_ids(got[i], ranks) == (t or "") for i, t in enumerate(texts))
    assert encoding.encode_documents(df.limit(0)).count() == 0


def test_equals_other_library(spark):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(f"{encoding.TOKENIZERS}/byte_bpe_50k.json")
    other.encode_special_tokens = True
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r["ids"] for r in encoding.encode_documents(docs, leaf=100).collect()}
    assert all(got[r["doc_id"]] == other.encode(r["text"] or "", add_special_tokens=False).ids for r in docs.collect())


def naive_found(words, item, config):
    """Brute force: a common run, or the best alignment of every stretch of the document."""
    n = len(item)
    runs = {tuple(item[i : i + config.run]) for i in range(n - config.run + 1)}
    if any(tuple(words[i : i + config.run]) in runs for i in range(len(words) - config.run + 1)):
        return True
    need = int(np.ceil(config.share * n - 1e-9))
    for a in range(len(words)):
        row = [0] * (n + 1)
        for b in range(a, min(len(words), a + int(n * (1 + config.other)) + 1)):
            above = 0
            for j, w in enumerate(item, 1):
                above, row[j] = row[j], max(row[j], row[j - 1], above + (w == words[b]))
            if row[n] >= need and b - a + 1 <= row[n] * (1 + config.other):
                return True
    return False


def test_leaks_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [say(rng.randrange(14, 60)) for _ in range(12)]
    items.append(items[0][:20])
    docs = []
    for k in range(120):
        item = rng.choice(items)
        way = k % 6
        if way == 0:
            cut = rng.randrange(max(1, len(item) - 12))
            inner = item[cut : cut + 12]
        elif way == 1:
            cut = rng.randrange(max(1, len(item) - 11))
            inner = item[cut : cut + 11]
        elif way == 2:
            inner = [w if i % 8 else rng.choice(vocabulary) for i, w in enumerate(item)]
        elif way == 3:
            inner = [w for i, w in enumerate(item) if i % 7]
        elif way == 4:
            inner = [x for w in item[: len(item) // 2] for x in (w,)]
        else:
            inner = say(20)
        docs.append(say(rng.randrange(60)) + inner + say(rng.randrange(60)))
    loud = [" ".join(w.upper() + rng.choice(["", ",", "​", " - "]) for w in d) for d in docs]
    df = spark.createDataFrame(list(enumerate(loud)), "doc_id long, text string")
    found = leakage.leaked_items(df, spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"))
    want = {(d, i) for d, words in enumerate(docs) for i, item in enumerate(items) if naive_found(words, item, leakage.LeakConfig())}
    assert {tuple(r) for r in found.collect()} == want and len(want) > 40


@pytest.mark.parametrize("block_words", [30, 1_000_000])
def test_short_items_and_dense_changes(spark, block_words):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [say(n) for n in (1, 2, 3, 3, 4, 4, 5, 6, 7, 9, 18, 30, 60)] + [["w1", "w1", "w2"], ["w3", "w3"], ["w4", "w5", "w4", "w5", "w4", "w5"]]
    docs = []
    for item in items:
        for every in (3, 4, 5, 7):
            docs.append(say(20) + [rng.choice(vocabulary) if i % every == every - 1 else w for i, w in enumerate(item)] + say(20))
            docs.append(say(9) + [w for i, w in enumerate(item) if i % every] + say(9))
        docs.append(say(5) + [x for w in item for x in ([w] if rng.random() < 0.8 else [w, "w299"])] + say(5))
    docs += [["w1", "w1"], ["w2"], ["w3"], ["w4", "w5", "w4", "x", "w5"], [], say(400)]
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {tuple(r) for r in leakage.leaked_items(df, table, leakage.LeakConfig(block_words=block_words)).collect()}
    want = {(d, i) for d, words in enumerate(docs) for i, item in enumerate(items) if naive_found(words, item, leakage.LeakConfig())}
    assert got == want and len(want) > 120


def test_common_words():
    rng = random.Random(2)
    for _ in range(200):
        item, passage = (np.array([rng.randrange(6) for _ in range(rng.randrange(12))], np.uint64) for _ in range(2))
        best = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
        for i, a in enumerate(item):
            for j, b in enumerate(passage):
                best[i + 1][j + 1] = best[i][j] + 1 if a == b else max(best[i][j + 1], best[i + 1][j])
        places = leakage.common_words(item, passage)
        assert len(places) == best[-1][-1] and places == sorted(set(places))
        rest = iter(item.tolist())
        assert all(int(passage[p]) in rest for p in places)


def test_leak_dirt(spark, rows):
    item = " ".join(f"word{i} l'été" for i in range(10))
    kind = "doc_id long, text string, item_id int, words int"
    docs = spark.createDataFrame([(1, None, 0, 0), (2, "", 0, 0), (3, "[00:01] " + unicodedata.normalize("NFD", item).replace(" ", " ﻿ 00:10 ").upper(), 0, 0), (None, item, 0, 0), (4, "x " * 50_000 + item + " y" * 50_000, 0, 0), (4, item, 0, 0)], kind)
    items = spark.createDataFrame([(7, item), (8, item), (9, None), (None, item), (10, "too short"), (11, "")], "item_id long, text string")
    got = rows(leakage.leaked_items(docs, items))
    assert got == sorted([(3, 7), (3, 8), (4, 7), (4, 7), (4, 8), (4, 8), (None, 7), (None, 8)], key=repr)
    assert leakage.leaked_items(docs.limit(0), items).count() == 0 and leakage.leaked_items(docs, items.limit(0)).count() == 0
    in_blocks = leakage.leaked_items(docs, items, leakage.LeakConfig(block_words=20))
    assert rows(in_blocks) == got


def corpus():
    """Sentences of function and content words, and stuffed pages of content words."""
    rng = random.Random(2)
    small = "the a every this that our their each and but".split()
    noun = [f"noun{i}" for i in range(60)]
    verb = [f"verb{i}" for i in range(30)]
    sentence = lambda: f"{rng.choice(small)} {rng.choice(noun)} {rng.choice(verb)} {rng.choice(small)} {rng.choice(noun)} {rng.choice(small)} {rng.choice(noun)}."
    prose = lambda n: " ".join(sentence() for _ in range(n))
    pool = lambda: [" ".join(rng.sample(noun, rng.randrange(1, 3))) for _ in range(5)]
    good = [prose(12) for _ in range(200)] + [prose(10) + "\n#one #two #three" for _ in range(10)] + [prose(10) + "\nsee https://a.test/x" for _ in range(10)]
    line = prose(1)
    good += [" ".join([line] * 4) + " " + prose(8) for _ in range(5)]
    bad = []
    for _ in range(8):
        p = pool()
        bad += [", ".join(rng.choice(p) for _ in range(60)), " ".join([p[0]] * 60), "\n".join(f"{w} - https://x{i}.test/q" for i, w in enumerate(p * 5)), " ".join("#" + rng.choice(noun) for _ in range(40)), prose(4) + " " + "; ".join(rng.choice(p) for _ in range(80)), ", ".join(f"{p[0]} in place{rng.randrange(50)}" for _ in range(40))]
    return good, bad


def test_stuffed_pages(spark):
    good, bad = corpus()
    texts = good + bad + [bad[0], None, "", " \n", "one two", "12 34", "x" * 100_000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, pack int").repartition(3)
    got = {r["doc_id"] for r in spam.stuffed_pages(df).collect()}
    want = set(range(len(good), len(good) + len(bad) + 1))
    assert len(got ^ want) <= 2
    scores = spam.stuffing_scores(df)
    assert scores.count() == len(texts)
    assert {r["words"] for r in scores.filter(F.col("doc_id").between(len(good) + len(bad) + 1, len(good) + len(bad) + 3)).collect()} == {0}
    assert spam.stuffed_pages(df.limit(0)).count() == 0


def test_word_salad_is_found(spark):
    """Pages of different words in random order, none of them repeated as a keyword; sentences of the same words are none."""
    rng = random.Random(8)
    nouns, verbs, others = [[f"{kind}{i}" for i in range(12)] for kind in ("noun", "verb", "other")]
    follows = {n: [rng.choice(verbs) for _ in range(2)] for n in nouns} | {v: [rng.choice(others) for _ in range(2)] for v in verbs} | {o: [rng.choice(nouns) for _ in range(2)] for o in others}

    def prose(n):
        words = [rng.choice(nouns)]
        while len(words) < n:
            words.append(rng.choice(follows[words[-1]]))
        return " ".join(words)

    every = nouns + verbs + others
    salads = [" ".join(rng.choice(every) for _ in range(n)) for n in (40, 120, 300)]
    texts = [prose(rng.randrange(60, 200)) for _ in range(300)] + salads
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in spam.stuffed_pages(df).collect()) == [300, 301, 302]


@pytest.mark.parametrize("packs", [1, 3])
def test_bundles_change_nothing(spark, monkeypatch, packs):
    good, bad = corpus()
    df = spark.createDataFrame(list(enumerate((good + bad)[:60] + bad[:2])), "doc_id long, text string").repartition(2)
    want = sorted(map(tuple, spam.stuffing_scores(df).collect()))
    monkeypatch.setattr(spam, "BUNDLE", packs)
    monkeypatch.setattr(spam, "text_slices", lambda batch: text_slices(batch, most_bytes=300))
    assert sorted(map(tuple, spam.stuffing_scores(df, ranges=3).collect())) == want


def test_counts_are_those_of_the_corpus(spark):
    """The replies of the exchange equal counts made at once, however the texts are packed."""
    good, bad = corpus()
    texts = (good + bad)[:80]
    config = spam.SpamConfig()
    whole = pa.array(texts)
    codes, each, doc, _ = spam.page_words(whole, config.anchor)
    _, totals, *_ = spam.count_requests(codes, each, doc)
    stuffed, mean = spam.stuffed_words(codes, each, doc, totals, config, len(texts))
    for parts, ranges in ((1, 1), (7, 5)):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
        got = {r["doc_id"]: (r["stuffed"], r["mean_pmi"]) for r in spam.stuffing_scores(df, ranges=ranges).collect()}
        assert all(got[i][0] == stuffed[i] and got[i][1] == pytest.approx(mean[i]) for i in range(len(texts)))


def test_broken_encoding_is_no_keyword():
    text = "Cette fête précise mesure déjà un côté."
    broken = text.encode().decode("latin-1")
    a, b = (spam.page_words(pa.array([t]), 8) for t in (text, broken))
    assert len(a[0]) == len(b[0]) and set(a[1].tolist()) == set(b[1].tolist())


def test_html_links_are_links(spark):
    """Anchors count by their targets, in lines or side by side; sentences with a few of them are no case."""
    good, _ = corpus()
    link = lambda i: f'<a class="x" href="https://x{i}.test/q{i}">noun{i} verb{i}</a>'
    lists = ["<ul>" + "".join(f"<li>{link(i)}</li>" for i in range(30)) + "</ul>", " | ".join(link(i) for i in range(30)), "\n".join(f"<A HREF='/page{i}'>noun{i}</A>" for i in range(30))]
    sentences = [good[0] + f" see {link(1)} and {link(2)}.", good[1] + ' <a href="#top">back</a> <abbr title="href=x">a</abbr>']
    df = spark.createDataFrame(list(enumerate(lists + sentences + good[2:])), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in spam.stuffed_pages(df).collect()) == [0, 1, 2]
    special = spam.page_words(pa.array([sentences[1], sentences[0]]), 8)[3][1]
    assert special.tolist() == [0, 6]


def test_text_slices():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 5, None, "b" * 9, "", "c", "d" * 30, "e"]})
    assert [s.num_rows for s in text_slices(batch, most_bytes=10)] == [2, 3, 1, 1]
    assert list(text_slices(batch.slice(0, 0))) == []


def test_copies_count_as_one_text(spark):
    """A page and its copies get the verdict of the page alone, in one pack or in several."""
    good, bad = corpus()
    rng = random.Random(4)
    rare = [f"rare{i}" for i in range(30)]
    page = " ".join(w for _ in range(3) for w in rng.sample(rare, len(rare)))
    texts = good + bad + [page]
    last = len(texts) - 1
    schema = "doc_id long, text string"

    def scores(extra, parts):
        df = spark.createDataFrame(list(enumerate(texts + extra)), schema).repartition(parts, "doc_id")
        return {r["doc_id"]: (r["stuffed"], r["mean_pmi"], r["share"]) for r in spam.stuffing_scores(df).collect()}

    alone = scores([], 1)
    assert alone[last][2] > 0.5
    copies = [page, page.upper(), page.replace(" ", ",  "), bad[0], bad[0]]
    for parts in (1, 5):
        got = scores(copies, parts)
        assert all(got[i][0] == alone[i][0] and got[i][1] == pytest.approx(alone[i][1], nan_ok=True) for i in alone)
        assert all(got[len(texts) + i][:2] == got[last][:2] for i in range(3))
        assert all(got[len(texts) + i][:2] == got[len(good)][:2] for i in (3, 4))
