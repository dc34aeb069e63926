"""Caption texts and word streams into ordered speaker turns, by precedence constraints over their segments."""

from __future__ import annotations

import bisect
import heapq
import html
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.columns import pick
from voxloom.storage import shuffle_width, write_table

#: Fixed value: a clock time, of hours (optional), minutes and seconds.
CLOCK = r"(?:(?:(\d{1,3}):)?(\d{1,2}):(\d{2})(?:[.,](\d{1,3}))?)"
#: A time that stands for itself or in brackets, with the end of its cue if that is given.
STAMP = rf"[\[(<{{]?\s*{CLOCK}\s*(?:-->\s*{CLOCK})?\s*[\])>}}]?"
#: Fixed value: the words that name a speaker by number.
NUMBERED = ("speaker", "spk", "s")
#: Places a block of a word stream that are tried as cuts.
CUTS = 8


def _drawn_out(term: str) -> str:
    """Pattern of ``term`` with any letter lengthened."""
    return r"\s+".join("".join(re.escape(c) + "+" for c in word) for word in term.split())


def order_segments(count: int, levels: list[list], edges: list[tuple[int, int]]) -> tuple[list[int], list[tuple[int, int]]]:
    """Order of ``count`` segments under precedence constraints, and the edges dropped because stronger ones contradict them.

    ``levels`` are the strongest constraints: in each list, a segment of a smaller value precedes all of a greater one;
    where two lists disagree the former holds.  ``edges`` ``(a, b)``, the strongest first, say that ``a`` precedes
    ``b``; an edge that would close a cycle with what holds already is dropped.  The rest is sorted topologically, of
    segments that may come next the first one goes.
    """
    rank = [0] * count
    for values in levels:
        keys = list(zip(rank, values))
        place = {k: i for i, k in enumerate(sorted(set(keys)))}
        rank = [place[k] for k in keys]
    after: list[list[int]] = [[] for _ in range(count)]
    dropped = []

    def reaches(a: int, b: int) -> bool:
        seen, todo = {a}, [a]
        while todo:
            x = todo.pop()
            if x == b:
                return True
            for y in after[x]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        return False

    for a, b in edges:
        if rank[a] < rank[b]:
            continue  # the levels say so already
        if rank[a] > rank[b] or reaches(b, a):
            dropped.append((a, b))
        else:
            after[a].append(b)
    waits = [0] * count
    for bs in after:
        for b in bs:
            waits[b] += 1
    ready = [(rank[i], i) for i in range(count) if not waits[i]]
    heapq.heapify(ready)
    order = []
    by_rank = [0] * (max(rank, default=-1) + 1)
    for r in rank:
        by_rank[r] += 1
    # edges lie within a rank, so a rank is finished before the next one begins
    while ready:
        _, i = heapq.heappop(ready)
        order.append(i)
        for b in after[i]:
            waits[b] -= 1
            if not waits[b]:
                heapq.heappush(ready, (rank[b], b))
    return order, dropped


def line_constraints(times: list[float | None], labelled: list[bool]) -> tuple[list[list], list[tuple[int, int]]]:
    """Constraints of the lines of a text, for ``order_segments``.

    Timing: if every line has a time, an earlier time precedes a later one, whatever stands first.  Cues: a line
    precedes the one captioned after it.  Dialogue: a label precedes the lines up to the next one, which go on with it.
    """
    n = len(times)
    cues = [(i, i + 1) for i in range(n - 1)]
    dialogue, head = [], None
    for i, has in enumerate(labelled):
        if has:
            head = i
        elif head is not None:
            dialogue.append((head, i))
    return ([times] if n and all(t is not None for t in times) else []), cues + dialogue


def word_constraints(starts: list[float | None]) -> tuple[list[list], list[tuple[int, int]]]:
    """Constraints of the words of a stream: their places, and weaker, the order of the times that they start at."""
    timed = sorted((s, i) for i, s in enumerate(starts) if s is not None and s == s)
    return [list(range(len(starts)))], [(a, b) for (_, a), (_, b) in zip(timed, timed[1:])]


def make_parser(aliases: dict[str, str], fillers: list[str]) -> tuple[Callable[[str], bool], Callable[[list[str], list], list], Callable[[str], list]]:
    """``(has_label, turns_of_words, turns_of_text)`` for label ``aliases`` (lower case) and ``fillers``.

    Remarks and markup end where their bracket does, at whatever length; a bracket that isn't closed ahead of another
    one of its kind is none.  A starred remark has no blanks inside its stars.
    """
    named = "|".join(r"\s+".join(map(re.escape, a.split())) for a in sorted(aliases, key=lambda a: (-len(a), a))) or r"(?!)"
    label = rf"(?:(?:speaker|spk|s)[\s_#-]*0*(\d{{1,4}})|({named}))"
    label_again = label.replace("(\\d", "(?:\\d").replace(f"({named})", f"(?:{named})")
    master = re.compile(
        rf"(?P<voice><v(?:\.[\w.]+)?\s+(?P<v>{label_again})\s*>)"
        rf"|(?P<boxed>[\[({{]\s*(?P<b>{label_again})\s*[:：]?\s*[\])}}]\s*[:：]?)"
        rf"|(?P<colon>(?<![\w-])(?P<c>{label_again})\s*[:：](?!\d))"
        rf"|(?P<stamp>{STAMP.replace('(\\d', '(?:\\d')})"
        r"|(?P<remark>\[[^\[\]]*\]|\([^()]*\)|\{[^{}]*\}|\*(?=[^\s*])[^*\n]*(?<=\S)\*)"
        r"|(?P<markup></?[A-Za-z][^<>]*>)",
        re.I,
    )
    which = re.compile(label, re.I)
    marks = r"̀-ͯؐ-ًؚ-ٰٟ"
    spoken = re.compile(rf"(?:[^\W_]|[{marks}])+")
    filler = re.compile(r"(?<!\S)(?:" + "|".join(_drawn_out(f) for f in sorted(fillers, key=lambda f: (-len(f), f))) + r")(?!\S)") if fillers else re.compile(r"(?!)")
    lead = re.compile(rf"^[\s\-–—>]*{STAMP}")

    def speaker(text: str) -> str:
        m = which.fullmatch(text.strip())
        if m.group(1):
            return f"SPK{int(m.group(1)):02d}"
        return aliases[" ".join(m.group(2).lower().split())]

    def settled(text: str) -> str:
        return unicodedata.normalize("NFC", html.unescape(html.unescape(text)))

    def has_label(text: str) -> bool:
        return any(m.group("v") or m.group("b") or m.group("c") for m in master.finditer(settled(text)))

    def events(text: str) -> list[tuple[int, str | None, list[str]]]:
        """``(position, speaker, words)``: spoken words by the label that opens them; words ahead of any have None."""
        out: list[tuple[int, str | None, list[str]]] = []
        at, who, start, words = 0, None, 0, []

        def speech(a: int, b: int) -> None:
            words.extend(w.lower() for w in spoken.findall(text, a, b))

        for m in master.finditer(text):
            speech(at, m.start())
            at = m.end()
            name = m.group("v") or m.group("b") or m.group("c")
            if name:
                out.append((start, who, words))
                who, start, words = speaker(name), m.start(), []
        speech(at, len(text))
        out.append((start, who, words))
        return [e for e in out if e[1] is not None or e[2]]

    def without_fillers(words: list[str]) -> str:
        return " ".join(filler.sub(" ", " ".join(words)).split())

    def clean(opened: list[tuple[str | None, list[str]]]) -> list[tuple[str | None, str]]:
        """Turns of one speaker after another: fillers cut, empty turns gone, neighbours of one speaker joined."""
        turns: list[list] = []
        for who, words in opened:
            text = without_fillers(words)
            if not text:
                continue
            if turns and turns[-1][0] == who:
                turns[-1][1] += " " + text
            else:
                turns.append([who, text])
        return [(w, t) for w, t in turns]

    def opened(lines: list[str]) -> list[tuple[str | None, list[str]]]:
        """Label by label over ``lines``; words without a label go on with the turn before them."""
        out: list[tuple[str | None, list[str]]] = []
        for line in lines:
            for _, who, words in events(line):
                if who is None and out:
                    out[-1][1].extend(words)
                else:
                    out.append((who, list(words)))
        return out

    def seconds(line: str) -> float | None:
        m = lead.match(line)
        if not m:
            return None
        h, mi, s, ms = m.groups()[:4]
        return int(h or 0) * 3600 + int(mi) * 60 + int(s) + (int(ms.ljust(3, "0")) / 1000 if ms else 0)

    def turns(text: str) -> list[tuple[str | None, str]]:
        lines = [line for line in settled(text).splitlines() if line.strip()]
        order, _ = order_segments(len(lines), *line_constraints([seconds(line) for line in lines], [has_label(line) for line in lines]))
        return clean(opened([lines[i] for i in order]))

    def of_words(words: list[str], starts: list[float | None]) -> list[tuple[str | None, str]]:
        """Turns of words that are settled already; words ahead of any label, or a label without words, stay."""
        order, _ = order_segments(len(words), *word_constraints(starts))
        return [(who, without_fillers(said)) for who, said in opened([" ".join(words[i] for i in order)])]

    return has_label, of_words, turns


#: Kinds of brackets, the characters that open and close them.
BRACKETS = (("[", "]"), ("(", ")"), ("{", "}"), ("<", ">"), ("*", "*"))


def bracket_codes(text: str, chars: tuple[str, str]) -> list[tuple[int, int, int]]:
    """``(place, as_last, as_next)`` of each bracket of a kind: 1 opens, 2 closes, for what follows and what precedes it.

    A star opens if ink follows and closes if ink precedes it; so it may do either, or both.
    """
    out = []
    for m in re.finditer("[" + re.escape("".join(dict.fromkeys(chars))) + "]", text):
        i = m.start()
        if chars[0] == chars[1]:
            opens, closes = text[i + 1 : i + 2].strip() != "", i > 0 and not text[i - 1].isspace()
            out.append((i, 1 if opens else 2, 2 if closes else 1))
        else:
            code = 1 if m.group() == chars[0] else 2
            out.append((i, code, code))
    return out


def make_cutter(aliases: dict[str, str], fillers: list[str]) -> Callable[[list[str]], dict]:
    """Function that finds places of a block of words where it may be cut without any pattern spanning the cut.

    On either side stands a plain word; the left one is no word of a label's name nor of a filler that goes on.  So
    only a remark or markup can span the cut: it does if, of its kind, the last bracket ahead opens and the next one
    behind closes.  Both are told as far as the block knows them (0 where it has none).
    """
    of_labels = {w for a in [*aliases, *NUMBERED] for w in a.split()} | {"v"}
    going_on = re.compile("|".join(_drawn_out(w) for f in fillers for w in f.split()[:-1]) or r"(?!)")
    plain = re.compile(r"[^\W\d_]+")

    def cut(words: list[str]) -> dict:
        text = " ".join(words)
        codes = [bracket_codes(text, chars) for chars in BRACKETS]
        at, cuts, step = 0, [], max(1, len(words) // (CUTS + 1))
        places = [[c[0] for c in kind] for kind in codes]
        quiet = step
        for i, word in enumerate(words):
            left = words[i - 1].lower() if i else ""
            if i >= quiet and len(cuts) < CUTS and plain.fullmatch(word) and plain.fullmatch(left) and left not in of_labels and not going_on.fullmatch(left):
                k = [bisect.bisect_left(p, at) for p in places]
                cuts.append({"i": i, "last": [c[n - 1][1] if n else 0 for c, n in zip(codes, k)], "next": [c[n][2] if n < len(c) else 0 for c, n in zip(codes, k)]})
                quiet = i + step
            at += len(word) + 1
        return {"cuts": cuts, "lasts": [c[-1][1] if c else 0 for c in codes], "firsts": [c[0][2] if c else 0 for c in codes]}

    return cut


def _chunk_mapper(aliases: dict[str, str], fillers: list[str]):
    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has_label, _, turns = make_parser(aliases, fillers)
        for batch in batches:
            rows = []
            for video, index, text in zip(batch["video_id"].to_pylist(), batch["chunk_index"].to_pylist(), batch["text_yt"].to_pylist()):
                if text and has_label(text):
                    rows += [(video, index, k, who, said) for k, (who, said) in enumerate(turns(text))]
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["video_id", "chunk_index", "turn_index", "speaker", "clean_text"])

    return mapper


_CUT = pa.struct([("i", pa.int32()), ("last", pa.list_(pa.int32())), ("next", pa.list_(pa.int32()))])
_BLOCK = pa.schema([("video_id", pa.string()), ("block", pa.int64()), ("words", pa.list_(pa.string())), ("starts", pa.list_(pa.float64())), ("cuts", pa.list_(_CUT)), ("lasts", pa.list_(pa.int32())), ("firsts", pa.list_(pa.int32()))])
_BLOCK_KIND = "video_id string, block long, words array<string>, starts array<double>, cuts array<struct<i:int,last:array<int>,next:array<int>>>, lasts array<int>, firsts array<int>"


def _block_mapper(aliases: dict[str, str], fillers: list[str], size: int):
    """Arrow mapper: words sorted by video and place to blocks of up to ``size`` words, one word a place."""

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = make_cutter(aliases, fillers)
        video, first, last, words, starts = None, None, None, [], []

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"video_id": video, "block": first, "words": words, "starts": starts, **cut(words)}], _BLOCK)

        for batch in batches:
            for v, pos, text, start in zip(*(batch[c].to_pylist() for c in ("video_id", "pos", "text", "start"))):
                if (v, pos) == last:
                    continue
                last = v, pos
                if words and (v != video or len(words) >= size):
                    yield block()
                    words, starts = [], []
                held = unicodedata.normalize("NFC", html.unescape(html.unescape(text))).split()
                if held:
                    if not words:
                        video, first = v, pos
                    words += held
                    starts += [start] * len(held)
        if words:
            yield block()

    return mapper


_PART = pa.schema([("video_id", pa.string()), ("block", pa.int64()), ("lead", pa.string()), ("carry", pa.string()), ("turns", pa.list_(pa.struct([("speaker", pa.string()), ("said", pa.string())])))])


def _part_mapper(aliases: dict[str, str], fillers: list[str]):
    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, of_words, _ = make_parser(aliases, fillers)
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                opened = of_words([w for p in row["pieces"] for w in p["words"]], [t for p in row["pieces"] for t in p["starts"]])
                lead = " ".join(said for who, said in opened if who is None and said)
                labelled = [(who, said) for who, said in opened if who is not None]
                joined: list[dict] = []
                for who, said in labelled:
                    if said and joined and joined[-1]["speaker"] == who:
                        joined[-1]["said"] += " " + said
                    elif said:
                        joined.append({"speaker": who, "said": said})
                rows.append({"video_id": row["video_id"], "block": row["home"], "lead": lead, "carry": labelled[-1][0] if labelled else None, "turns": joined})
            yield pa.RecordBatch.from_pylist(rows, _PART)

    return mapper


def stream_parts(words: DataFrame, aliases: dict[str, str], fillers: list[str], size: int) -> DataFrame:
    """Word streams in parts that no label, time, remark, markup or filler spans: ``(video_id, home, pieces)``.

    Words are range-partitioned by video and place, so a video with a third of all words lies in many tasks, and come
    out in blocks of ``size`` words.  Each block names places for a cut and the brackets around them; which brackets
    are open there follows from one small row per block, ordered per video.  The words of a block ahead of its cut
    belong to the part that the last block with a cut began; a block without any belongs there as a whole, so a part
    grows until nothing is open at its ends.
    """
    known = pick(words, "video_id", "pos", "text", "start").filter("video_id IS NOT NULL AND pos IS NOT NULL AND text IS NOT NULL").select("video_id", F.col("pos").cast("long").alias("pos"), "text", F.col("start").cast("double").alias("start"))
    placed = known.repartitionByRange(2 * shuffle_width(words.sparkSession), "video_id", "pos").sortWithinPartitions("video_id", "pos", "text", "start")
    blocks, _ = write_table(placed.mapInArrow(_block_mapper(aliases, fillers, size), _BLOCK_KIND), "blocks")
    ahead = Window.partitionBy("video_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("video_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    known_code = lambda c, t: F.when(F.get(c, F.lit(t)) > 0, F.get(c, F.lit(t)))
    kinds = range(len(BRACKETS))
    small = blocks.select("video_id", "block", "cuts", *[F.last(known_code("lasts", t), True).over(ahead).alias(f"last{t}") for t in kinds], *[F.last(known_code("firsts", t), True).over(behind).alias(f"next{t}") for t in kinds], F.count("*").over(ahead).alias("n"))

    def spanned(cut: Column) -> Column:
        out = F.lit(False)
        for t in kinds:
            code = lambda c, far: F.coalesce(F.when(c > 0, c), F.col(far), F.lit(0))
            out = out | ((code(F.get(cut["last"], F.lit(t)), f"last{t}") == 1) & (code(F.get(cut["next"], F.lit(t)), f"next{t}") == 2))
        return out

    place = F.when(F.col("n") == 0, F.lit(0)).otherwise(F.get(F.filter("cuts", lambda c: ~spanned(c)), F.lit(0))["i"])
    homes = small.select("video_id", "block", place.alias("cut")).withColumn("home", F.last(F.when(F.col("cut").isNotNull(), F.col("block")), True).over(ahead))
    piece = lambda home, a, n: F.struct(home.alias("home"), F.col("block"), F.slice("words", a, n).alias("words"), F.slice("starts", a, n).alias("starts"))
    size_, cut = F.size("words"), F.coalesce("cut", F.size("words"))
    parts = blocks.select("video_id", "block", "words", "starts").join(homes, ["video_id", "block"]).select("video_id", F.explode(F.array(piece(F.col("home"), F.lit(1), cut), piece(F.col("block"), cut + 1, size_ - cut))).alias("p")).filter(F.size("p.words") > 0)
    return parts.groupBy("video_id", F.col("p.home").alias("home")).agg(F.sort_array(F.collect_list(F.struct("p.block", "p.words", "p.starts"))).alias("pieces"))


def small_table(df: DataFrame, column: str, value: str | None = None, most: int = 100_000) -> list:
    """Rows of a lookup table whose size is checked: more than ``most`` raise."""
    rows = pick(df, column, *([value] if value else [])).filter(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows of {column}")
    return [(r[column], r[value]) if value else r[column] for r in rows]


def chunk_turns(chunks: DataFrame, aliases: dict[str, str], fillers: list[str]) -> DataFrame:
    """Turns of the chunks whose ``text_yt`` carries a speaker label, a chunk being a row; no shuffle.

    Null and empty texts and texts without label have no turns.  Words ahead of the first label have a null speaker.
    """
    return pick(chunks, "video_id", "chunk_index", "text_yt").filter(F.length("text_yt") > 0).mapInArrow(_chunk_mapper(aliases, fillers), "video_id string, chunk_index int, turn_index int, speaker string, clean_text string")


def stream_turns(words: DataFrame, aliases: dict[str, str], fillers: list[str], size: int = 4096) -> DataFrame:
    """Turns of word streams (``video_id``, ``pos``, ``text``, ``start``), one word per ``pos``, in order of ``pos``.

    Repeated rows count once; of different texts at one ``pos`` the first by code point counts; null texts, positions
    and videos are left out.  A stream is parsed in parts (see ``stream_parts``) by many tasks, and comes out as if it
    were read whole, whatever ``size`` is.  What a part's first words belong to, whether its first turn goes on with one
    of an earlier part, and how many turns lie ahead of it follow from one small row per part, so only those rows are
    ordered per video.
    """
    kind = "video_id string, block long, lead string, carry string, turns array<struct<speaker:string,said:string>>"
    parsed, _ = write_table(stream_parts(words, aliases, fillers, size).mapInArrow(_part_mapper(aliases, fillers), kind), "parts")

    order = Window.partitionBy("video_id").orderBy("block")
    n, first, last = F.size("turns"), F.get("turns", 0)["speaker"], F.get("turns", F.size("turns") - 1)["speaker"]
    small = parsed.select("video_id", "block", (F.col("lead") != "").alias("led"), "carry", n.alias("n"), first.alias("first"), last.alias("last"))
    carried = small.withColumn("owner", F.last("carry", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    # with the words ahead of its labels, a block's turns begin with their owner, who may be its first speaker as well
    same = F.col("led") & (F.col("n") > 0) & F.col("owner").eqNullSafe(F.col("first"))
    whole = carried.select("video_id", "block", "owner", "led", same.alias("same"), (F.col("n") + F.when(F.col("led") & ~same, 1).otherwise(0)).alias("n"), F.when(F.col("led"), F.col("owner")).otherwise(F.col("first")).alias("first"), F.when(F.col("n") > 0, F.col("last")).otherwise(F.col("owner")).alias("last"))
    spoken = whole.filter("n > 0")
    goes_on = (F.row_number().over(order) > 1) & F.lag("last").over(order).eqNullSafe(F.col("first"))
    linked = spoken.withColumn("goes_on", F.when(goes_on, 1).otherwise(0))
    ahead = F.sum(F.col("n") - F.col("goes_on")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    placed = linked.select("video_id", "block", "owner", "led", "same", ahead.alias("ahead"))

    lead = F.when(F.col("led"), F.array(F.struct(F.col("owner").alias("speaker"), F.col("lead").alias("said")))).otherwise(F.array().cast("array<struct<speaker:string,said:string>>"))
    shift = F.when(F.col("led") & F.col("same"), 1).otherwise(0)
    turn = lambda k: F.col("ahead") + k - F.when(k > 0, shift).otherwise(0)
    rows = parsed.join(placed, ["video_id", "block"]).select("video_id", "block", "ahead", "led", "same", F.posexplode(F.concat(lead, F.col("turns"))).alias("k", "t"))
    numbered = rows.select("video_id", turn(F.col("k")).alias("turn"), "block", "k", "t.speaker", "t.said")
    joined = numbered.groupBy("video_id", "turn").agg(F.first("speaker").alias("speaker"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "k", "said"))), lambda x: x["said"]), " ").alias("clean_text"))
    return joined.select("video_id", F.lit(-1).alias("chunk_index"), F.col("turn").cast("int").alias("turn_index"), "speaker", "clean_text")


def clean_turns(chunks: DataFrame, words: DataFrame, label_aliases: DataFrame, filler_terms: DataFrame) -> DataFrame:
    """``(field, video_id, chunk_index, turn_index, speaker, clean_text)`` of caption texts and word streams."""
    aliases = {" ".join(a.lower().split()): s for a, s in small_table(label_aliases, "alias", "speaker")}
    fillers = [" ".join(unicodedata.normalize("NFC", t).lower().split()) for t in small_table(filler_terms, "term") if t.strip()]
    of_chunks = chunk_turns(chunks, aliases, fillers).select(F.lit("text_yt").alias("field"), "*")
    of_words = stream_turns(words, aliases, fillers).select(F.lit("sub_word").alias("field"), "*")
    return of_chunks.unionByName(of_words)
