"""Text functions on columns: cleaning, normal forms, script shares, vowel marks, edit distances.

Everything is native except Unicode normal forms and word-level distances, which run as Arrow UDFs.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as S

#: Fixed values, as classes for regular expressions: Arabic vowel marks; Arabic letters and digits for script shares;
#: letters that can end a word; letters of running Arabic text.
MARKS = r"\u0610-\u061A\u064B-\u065F\u0670\u06D6-\u06ED"
ARABIC = r"\u0621-\u064A\u0660-\u0669\u066E-\u06FF"
WORD_LETTERS = r"\u0621-\u064A\u066E\u066F\u0671-\u06D5\u06EE\u06EF\u06FA-\u06FF"
PLAIN_ARABIC = r"\u0621-\u064A"
#: Punctuation that comparisons ignore, with bidirectional and zero-width controls.
PUNCTUATION = r"!-/:-@\[-`{-~\u00AB\u00BB\u060C\u061B\u061F\u066A-\u066D\u06D4\u2000-\u206F\u2E00-\u2E7F\uFEFF"
#: Letters and digits that comparisons take as others, and those; the lengthening stroke goes.
FOLDED_FROM = "\u0622\u0623\u0625\u0671\u0649\u0629\u06A9\u06CC\u06BE" + "".join(chr(0x660 + i) for i in range(10)) + "".join(chr(0x6F0 + i) for i in range(10)) + "\u0640"
FOLDED_TO = "\u0627\u0627\u0627\u0627\u064A\u0647\u0643\u064A\u0647" + "0123456789" * 2
#: A bracketed caption remark, and the mark of a new speaker at a line's start.
REMARK = r"[\[(][^\])]{0,40}[\])]"
REMARK_OR_CHANGE = rf"(?m){REMARK}|^>>+\s*"
#: Emoji, and invisible characters including the lengthening stroke.
EMOJI = r"[\x{1F000}-\x{1FAFF}\u2600-\u27BF\u2B00-\u2BFF\uFE0F\u20E3]"
INVISIBLE = r"[\u0640\u00AD\u200B-\u200F\u202A-\u202E\u2060\u2066-\u2069\uFEFF]"


@F.arrow_udf(S.StringType())
def nfc(texts: pa.Array) -> pa.Array:
    """Composed form; Arrow's kernel leaves it decomposed, hence Python's."""
    return pa.array([t if t is None or t.isascii() else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(S.StringType())
def nfkc(texts: pa.Array) -> pa.Array:
    """Composed form of the compatibility decomposition."""
    return pa.array([t if t is None or t.isascii() else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()], pa.string())


def present(text: Column) -> Column:
    """``text`` with null as empty."""
    return F.coalesce(text, F.lit(""))


def squeeze(text: Column) -> Column:
    """One space for any run of Unicode white space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def words(text: Column) -> Column:
    """Array of the words between white space; empty for null."""
    return F.filter(F.split(squeeze(present(text)), " "), lambda w: w != "")


def strip_annotations(text: Column) -> Column:
    """Without bracketed remarks of up to 40 characters and marks of a new speaker."""
    return squeeze(F.regexp_replace(text, REMARK_OR_CHANGE, " "))


def normalize(text: Column) -> Column:
    """Form for comparisons: no remarks, marks or punctuation, letters and digits folded, lower case."""
    bare = F.regexp_replace(strip_annotations(nfkc(present(text))), f"[{MARKS}]", "")
    return F.lower(squeeze(F.regexp_replace(F.translate(bare, FOLDED_FROM, FOLDED_TO), f"[{PUNCTUATION}]", " ")))


def clean_for_output(text: Column) -> Column:
    """Form for the dataset: composed, no remarks, no lengthening strokes."""
    return squeeze(F.replace(strip_annotations(nfc(present(text))), F.lit("\u0640"), F.lit("")))


def clean_text(text: Column) -> Column:
    """Form for export: also without emoji, invisible characters and stranded punctuation at the ends."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(nfc(present(text)), REMARK_OR_CHANGE, " "), EMOJI, " "), INVISIBLE, "")
    return F.trim(squeeze(bare), F.lit(" -–—،,;:"))


def _share(text: Column, inner: str) -> Column:
    letters = F.regexp_count(present(text), F.lit(r"[\p{L}\p{N}]"))
    return F.when(letters > 0, F.regexp_count(present(text), F.lit(inner)) / letters).otherwise(0.0)


def arabic_ratio(text: Column) -> Column:
    """Share of letters and digits that are Arabic; 0 without any."""
    return _share(text, rf"[{ARABIC}&&[\p{{L}}\p{{N}}]]")


def latin_ratio(text: Column) -> Column:
    """Share of letters and digits that are Latin without accents; 0 without any."""
    return _share(text, "[A-Za-z0-9]")


def script_ratio(text: Column, language: Column) -> Column:
    """Share in the script of the language; of an unknown one, the greater of both."""
    return F.when(language == "ar", arabic_ratio(text)).when(language == "en", latin_ratio(text)).otherwise(F.greatest(arabic_ratio(text), latin_ratio(text)))


def strip_marks(text: Column) -> Column:
    """Without vowel marks."""
    return F.regexp_replace(present(text), f"[{MARKS}]", "")


def has_marks(text: Column) -> Column:
    """Whether there are vowel marks."""
    return F.regexp_count(present(text), F.lit(f"[{MARKS}]")) > 0


def marks_ratio(text: Column) -> Column:
    """Vowel marks per Arabic letter; 0 without letters."""
    letters = F.regexp_count(strip_marks(text), F.lit(f"[{ARABIC}]"))
    return F.when(letters > 0, F.regexp_count(present(text), F.lit(f"[{MARKS}]")) / letters).otherwise(0.0)


def strip_final_marks(text: Column) -> Column:
    """Without marks on each word's last letter, nor tanwin before the silent alef that ends a word."""
    any_ = WORD_LETTERS + MARKS
    bare = F.regexp_replace(present(text), f"(?<=[{WORD_LETTERS}])[{MARKS}]+(?![{any_}])", "")
    return F.regexp_replace(bare, f"(?<=[{any_}])\\u064B(?=[\\u0627\\u0649](?![{any_}]))", "")


def same_skeleton(a: Column, b: Column) -> Column:
    """Whether texts differ by vowel marks only."""
    return words(strip_marks(a)) == words(strip_marks(b))


def same_words(a: Column, b: Column) -> Column:
    """Whether texts are the same words, and some, under the folding of ``normalize``."""
    left, right = words(normalize(a)), words(normalize(b))
    return (left == right) & (F.size(left) > 0)


def cer_of_normal(ref: Column, hyp: Column) -> Column:
    """Character error rate of normalized texts: both empty 0, one empty 1; may exceed 1."""
    r, h = F.replace(ref, F.lit(" "), F.lit("")), F.replace(hyp, F.lit(" "), F.lit(""))
    return F.when((r == "") & (h == ""), 0.0).when((r == "") | (h == ""), 1.0).otherwise(F.levenshtein(r, h) / F.char_length(r))


def cer(ref: Column, hyp: Column) -> Column:
    """Character error rate of two texts."""
    return cer_of_normal(normalize(ref), normalize(hyp))


def cer_within(ref: Column, hyp: Column, most: float) -> Column:
    """Whether the character error rate of normalized texts is at most ``most``; stops counting beyond it."""
    r, h = F.replace(ref, F.lit(" "), F.lit("")), F.replace(hyp, F.lit(" "), F.lit(""))
    bound = F.floor(F.char_length(r) * most).cast("int")
    return F.when((r == "") | (h == ""), r == h).otherwise(F.levenshtein(r, h) <= bound)


_CODED = pa.struct([("ref", pa.string()), ("hyp", pa.string())])


@F.arrow_udf(S.StructType().add("ref", S.StringType()).add("hyp", S.StringType()))
def coded_words(refs: pa.Array, hyps: pa.Array) -> pa.Array:
    """Two texts with each word as one character, the same for the same word, so that characters stand for words."""

    def code(ref: str, hyp: str) -> dict:
        a, b = ref.split(), hyp.split()
        # characters other than surrogates, as many as different words
        codes = {w: chr(i + 0x100 if i < 0xD700 else i + 0x900) for i, w in enumerate(dict.fromkeys(a + b))}
        return {"ref": "".join(codes[w] for w in a), "hyp": "".join(codes[w] for w in b)}

    return pa.array([None if r is None or h is None else code(r, h) for r, h in zip(refs.to_pylist(), hyps.to_pylist())], _CODED)


def wer_of_normal(refs: Column, hyps: Column) -> Column:
    """Word error rate of normalized texts, with the edge cases of the character error rate."""
    coded = coded_words(refs, hyps)
    r, h = coded["ref"], coded["hyp"]
    return F.when((r == "") & (h == ""), 0.0).when((r == "") | (h == ""), 1.0).otherwise(F.levenshtein(r, h) / F.char_length(r))


def wer(ref: Column, hyp: Column) -> Column:
    """Word error rate of two texts."""
    return wer_of_normal(normalize(ref), normalize(hyp))


def alignment_words(text: Column) -> Column:
    """Words to align: composed, without remarks."""
    return words(strip_annotations(nfc(present(text))))


def lexical_markers(text: Column, lexicon: list[str]) -> Column:
    """Sorted words of the text that are in the lexicon, both normalized by ``normalize`` beforehand."""
    return F.array_sort(F.array_intersect(F.split(text, " "), F.array(*map(F.lit, lexicon)) if lexicon else F.array().cast("array<string>")))


def fill_template(template: str, **values: Column) -> Column:
    """``template`` with each ``{name}`` replaced by a column."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def chars_per_second(text: Column, duration: Column) -> Column:
    """Characters other than spaces per second, a second being at least a microsecond."""
    return F.char_length(F.replace(text, F.lit(" "), F.lit(""))) / F.greatest(F.coalesce(duration, F.lit(0.0)), F.lit(1e-6))


def clock_seconds(stamp: Column) -> Column:
    """Seconds of ``H:MM:SS.mmm`` or with a comma; null for anything else."""
    parts = F.split(F.replace(stamp, F.lit(","), F.lit(".")), ":")
    ok = stamp.rlike(r"^\d{1,2}:\d{2}:\d{2}[.,]\d{3}$")
    at = lambda i: F.get(parts, i)
    return F.when(ok, at(0).try_cast("int") * 3600 + at(1).try_cast("int") * 60 + at(2).try_cast("double"))


@F.arrow_udf(S.StringType())
def unescape(texts: pa.Array) -> pa.Array:
    """Character entities decoded, one time."""
    import html

    return pa.array([t if t is None or "&" not in t else html.unescape(t) for t in texts.to_pylist()], pa.string())


def strip_tags(text: Column) -> Column:
    """Without markup tags."""
    return F.regexp_replace(text, r"</?[a-zA-Z][^>]*>", "")
