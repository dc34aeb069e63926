"""One consistent form for texts that look the same, normalizing only the segments that are not stable."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from voxloom.functions.columns import pick
from voxloom.llm.words import worker_state

#: Letters of other scripts that the public table of confusable characters takes for Latin ones, in
#: Unicode order, with those.  Letters that only resemble one, as the small Greek and Cyrillic k and t, aren't among them.
LOOK_ALIKES = {
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i",
    "Ϳ": "J", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "γ": "y", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "υ": "u", "ϲ": "c", "ϳ": "j", "Ϲ": "C",
    "Ѕ": "S", "І": "I", "Ј": "J", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ѵ": "v", "Ү": "Y", "ү": "y", "һ": "h", "Ӏ": "I", "ӏ": "l", "ԁ": "d", "Ԛ": "Q", "ԛ": "q", "Ԝ": "W", "ԝ": "w",
    "զ": "q", "հ": "h", "ո": "n", "ս": "u", "ց": "g", "օ": "o",
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮐ": "G", "Ꮓ": "Z", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ᏼ": "B",
    "Ⲏ": "H", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "ⲟ": "o", "Ⲣ": "P", "ⲣ": "p", "Ⲥ": "C", "ⲥ": "c", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X",
}
#: Arabic letters that look like another where they join the next letter (their dots then agree).
JOINED_ALIKES = {"ی": "ي", "ک": "ك", "ى": "ي", "ہ": "ه", "ە": "ه"}
#: Arabic letters that look like another where no letter follows.
FINAL_ALIKES = {"ی": "ى", "ە": "ه", "ہ": "ه"}
#: Characters that show nothing, beside those of category Cf.
INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍᠎ㅤﾠ"
#: Tags of compatibility decompositions that keep the look (wide and narrow forms, contextual forms,
#: ligatures); superscripts, circles, fractions and fonts look different and stay.
LOOK_KEEPING = ("<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>", "<compat>")


def _drops(char: str) -> bool:
    """Whether ``char`` shows nothing: format controls, control characters that are no blanks, variation selectors."""
    category = unicodedata.category(char)
    return char in INVISIBLE or "\ufe00" <= char <= "\ufe0f" or category == "Cf" and char not in "؀؁؂؃؄؅۝࣢" or category == "Cc" and not char.isspace()


def _unfold(char: str) -> str:
    """``char`` with look-keeping compatibility decompositions applied, to the end."""
    tag, _, rest = unicodedata.decomposition(char).partition(" ")
    if tag in LOOK_KEEPING:
        parts = [chr(int(x, 16)) for x in rest.split()]
        if tag != "<compat>" or not parts[0].isspace():
            return "".join(map(_unfold, parts))
    return char


def unstable_class() -> str:
    """Regular expression class of the characters that normalization may change or that join those before them.

    Derived from the Unicode database: normalization quick check not plainly yes, a combining class, a look-keeping
    decomposition, an invisible character, a blank other than a space, or an entry of the tables above.
    """
    tabled = {*LOOK_ALIKES, *JOINED_ALIKES, *FINAL_ALIKES}
    spans: list[list[int]] = []
    for code in range(0x80, 0x30000):
        char = chr(code)
        if 0xD800 <= code < 0xE000 or 0x3400 <= code < 0xA000 or 0xAC00 <= code < 0xD7A4:
            continue
        if not (unicodedata.combining(char) or _drops(char) or char.isspace() or char in tabled or not unicodedata.is_normalized("NFC", char) or _unfold(char) != char or 0x1160 <= code < 0x1200):
            continue
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    ranges = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)
    return f"\\x00-\\x1f\\x7f{ranges}\\U000e0000-\\U000e0fff"


def make_canonical():
    """Function from a text to its consistent form (null for null).

    A segment is a run of unstable characters with the character before it, which a combining one may join; only
    segments are normalized and spliced into the text.  Letters of mixed-script words are then resolved word by word,
    and blanks last: runs become one space, none remains at the ends.
    """
    unstable = unstable_class()
    segment = re.compile(f".?[{unstable}]+", re.S)
    foreign = re.compile("[" + "".join(LOOK_ALIKES) + "]")
    word = re.compile(r"[^\W\d_](?:[^\W\d_]|[̀-ͯ])*")
    marked = r"([ؐ-ًؚ-ٰٟۖ-ۜ]*)"
    arabic = re.compile("([" + "".join({*JOINED_ALIKES, *FINAL_ALIKES}) + "])" + marked + r"(?=([ؠ-يٮ-ۓەۺ-ۼ])?)")
    blanks = re.compile(r"\s+")
    plain = re.compile(r"[!-~]+(?: [!-~]+)*")
    cache: dict[str, str] = {}

    def settle(match: re.Match) -> str:
        """A segment in canonical form: invisible characters gone, look-keeping forms unfolded, composed."""
        held = match.group()
        if (known := cache.get(held)) is None:
            known = unicodedata.normalize("NFC", "".join("" if _drops(c) else " " if c.isspace() else _unfold(c) for c in held))
            if len(cache) < 50_000:
                cache[held] = known
        return known

    def latin(match: re.Match) -> str:
        """A word whose foreign letters all look like Latin ones, or that holds Latin letters, in Latin letters."""
        held = match.group()
        if not foreign.search(held):
            return held
        others = foreign.sub("", unicodedata.normalize("NFD", held))
        if others and not re.search(r"[A-Za-z\u00c0-\u024f]", others) and any(c.isalpha() for c in others):
            return held  # a word of another script
        return unicodedata.normalize("NFC", foreign.sub(lambda m: LOOK_ALIKES[m.group()], unicodedata.normalize("NFD", held)))

    def shape(match: re.Match) -> str:
        """An Arabic letter as it looks before what follows, composed with its marks."""
        letter, marks, joins = match.groups()
        known = (JOINED_ALIKES if joins else FINAL_ALIKES).get(letter, letter)
        return unicodedata.normalize("NFC", known + marks) if marks else known

    def canonical(text: str | None) -> str | None:
        if text is None or plain.fullmatch(text):
            return text
        if not text.isascii():
            # a segment begins with the character that its first mark may join, and what follows a run of unstable
            # characters joins nothing, so its ends are its own; letters that are resolved take their marks along
            text = segment.sub(settle, text)
            if foreign.search(text):
                text = word.sub(latin, text)
            if arabic.search(text):
                text = arabic.sub(shape, text)
        elif re.search(r"[\x00-\x08\x0e-\x1b\x7f]", text):
            text = segment.sub(settle, text)
        return blanks.sub(" ", text).strip()

    return canonical


def _worker_canonical():
    """``make_canonical`` once per worker process."""
    state = worker_state()
    if "canonical" not in state:
        state["canonical"] = make_canonical()
    return state["canonical"]


def _canonical_mapper(columns: list[str], suffix: str):
    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = _worker_canonical()
        for batch in batches:
            forms = [pa.array(map(canonical, batch[c].to_pylist()), pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *forms], names=[*batch.schema.names, *(c + suffix for c in columns)])

    return mapper


def canonical_texts(table: DataFrame, columns: list[str], suffix: str = "_canonical") -> DataFrame:
    """``table`` with the consistent form of each of ``columns`` as ``column + suffix``.

    Null stays null and an empty or invisible text becomes empty.  Texts of any length are processed whole; rows,
    repeated ones included, stay as they are; columns that have the new names already are replaced.  No shuffle.
    """
    table = table.drop(*(c + suffix for c in columns))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    return table.mapInArrow(_canonical_mapper(columns, suffix), fields + "".join(f", `{c}{suffix}` string" for c in columns))


def look_alike_fields(chunks: DataFrame, fields: tuple[str, ...] = ("text_yt", "text_cohere")) -> DataFrame:
    """``(video_id, chunk_index, field)`` where a field is not its chunk's ``text`` but looks the same.

    Null and empty fields are no case, nor is a chunk without text.  Rows whose fields all equal the text character
    by character are left out ahead of Python by a native filter.
    """
    from pyspark.sql import functions as F

    wanted = [(F.col(f) != "") & (F.col(f) != F.col("text")) for f in fields]
    differs = wanted[0]
    for w in wanted[1:]:
        differs = F.coalesce(differs, F.lit(False)) | F.coalesce(w, F.lit(False))
    forms = canonical_texts(pick(chunks, "video_id", "chunk_index", "text", *fields).filter(differs), ["text", *fields])
    case = [F.when((F.col(f) != "") & (F.col(f) != F.col("text")) & (F.col(f"{f}_canonical") == F.col("text_canonical")), F.lit(f)) for f in fields]
    return forms.select("video_id", "chunk_index", F.explode(F.array_compact(F.array(*case))).alias("field"))
