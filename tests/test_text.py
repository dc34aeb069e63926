"""Text functions: case tables, and edit distances against plain ones."""

import pytest
from pyspark.sql import functions as F

from voxloom.functions import sources as U
from voxloom.functions import text as T


def one(spark, *values, f):
    names = [f"x{i}" for i in range(len(values))]
    df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return df.select(f(*map(F.col, names)).alias("y")).first()["y"]


@pytest.mark.parametrize(("a", "b"), [("أحمد", "احمد"), ("فتاة", "فتاه"), ("٥", "5"), ("a​b", "a b"), ("[Music] Hello,  WORLD", "hello world"), (">> hi", "hi"), ("مــرحبا", "مرحبا"), ("كَتَبَ", "كتب"), (None, "")])
def test_normalize(spark, a, b):
    assert one(spark, a, f=T.normalize) == one(spark, b, f=T.normalize)


def test_cleaning(spark):
    assert one(spark, " (applause) é ـx [a]  ", f=T.clean_for_output) == "é x"
    assert one(spark, "- hello \U0001f600 wor​ld, [noise]", f=T.clean_text) == "hello world"
    assert one(spark, None, f=T.clean_text) == ""


@pytest.mark.parametrize(("ref", "hyp", "rate"), [("", "", 0.0), ("a", "", 1.0), ("", "a", 1.0), ("abcde", "abxde", 0.2), ("ab", "xyzwv", 2.5)])
def test_cer(spark, ref, hyp, rate):
    assert one(spark, ref, hyp, f=T.cer) == pytest.approx(rate)


def test_wer(spark):
    assert one(spark, "one two three four", "one two x four", f=T.wer) == 0.25
    assert one(spark, "", "", f=T.wer) == 0.0
    assert one(spark, None, "a", f=T.wer) == 1.0


def test_cer_within(spark):
    assert one(spark, "abcdefghij", "abcdefgxyz", f=lambda a, b: T.cer_within(a, b, 0.3))
    assert not one(spark, "abcdefghij", "abcdefxxyz", f=lambda a, b: T.cer_within(a, b, 0.3))


def test_scripts(spark):
    arabic = "مرحبا"
    assert one(spark, arabic + " abc", f=T.arabic_ratio) == 5 / 8
    assert one(spark, arabic + " abc", f=T.latin_ratio) == 3 / 8
    assert one(spark, "...", f=T.arabic_ratio) == 0.0
    assert one(spark, arabic + " abc", "xx", f=T.script_ratio) == 5 / 8


@pytest.mark.parametrize(("marked", "bare_end"), [("كَتَبَ", "كَتَب"), ("مرحبًا", "مرحبا"), ("فَا", "فَا"), ("بُ،", "ب،"), ("abc", "abc"), ("", "")])
def test_final_marks(spark, marked, bare_end):
    assert one(spark, marked, f=T.strip_final_marks) == bare_end


def test_skeletons(spark):
    assert one(spark, "كَتب", "كتب", f=T.same_skeleton)
    assert one(spark, "اصوات", "أصوات", f=T.same_words)
    assert not one(spark, "", "", f=T.same_words)
    assert one(spark, "كَتَب", f=T.marks_ratio) == 2 / 3


@pytest.mark.parametrize(("url", "video"), [("https://video.example/watch?v=abc&t=1", "abc"), ("https://m.video.example/watch?t=2&v=abc", "abc"), ("https://v.example/abc?x=1", "abc"), ("https://www.video.example/shorts/abc", "abc"), ("https://video.example/embed/abc/", "abc"), ("https://video.example/live/abc", "abc"), ("https://video.example/", None), ("https://other.test/watch?v=abc", None), ("file:///a/My file!.mp3", "My_file"), ("/x/2.mp3", "2"), ("::", "local"), (None, None)])
def test_source_ids(spark, url, video):
    assert one(spark, url, f=lambda u: U.source_id(u, ("video.example",), ("v.example",))) == video


def test_natural_order(spark):
    names = ["10.mp3", "2.mp3", "a10b", "A2b", "02.mp3"]
    df = spark.createDataFrame([(n,) for n in names], "n string").orderBy(U.natural_key(F.col("n")), "n")
    assert [r["n"] for r in df.collect()] == ["02.mp3", "2.mp3", "10.mp3", "A2b", "a10b"]


def test_path_codes(spark):
    for path in ("a/b_c.wav", "x.y/z.wav"):
        assert one(spark, path, f=lambda p: U.path_decode(U.path_code(p, "pre/"), "pre/")) == path


def test_languages(spark):
    df = spark.createDataFrame([(["en-orig", "en-GB", "ar"],)], "x array<string>")
    assert df.select(U.preferred_language(F.col("x"), ["fr", "en*", "ar"])).first()[0] == "en-GB"
    assert df.select(U.preferred_language(F.col("x"), ["de"])).first()[0] is None
