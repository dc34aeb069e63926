"""Gates: order, missing values, scales of confidence, and verdicts."""

import pytest
from pyspark.sql import functions as F

from voxloom.config import Config, Limits
from voxloom.operators import gates

CHUNK = "id int, start double, end double, text string, text_yt string, text_cohere string, text_source string, asr_language string, asr_confidence double, align_score double, boundary_clipped boolean"
AR = "مرحبا بكم جميعا"


def chunk(i, text=AR, start=0.0, end=1.5, source="yt", lang="ar", conf=None, align=None, clipped=False):
    return (i, start, end, text, text, text, source, lang, conf, align, clipped)


def codes(df):
    return [r["reject_code"] for r in df.orderBy("id").collect()]


def test_text_gates(spark):
    nan = float("nan")
    data = [chunk(0), chunk(1, ""), chunk(2, None), chunk(3, "a"), chunk(4, "one two three"), chunk(5, "one two three", lang="en"), chunk(6, source="cohere", conf=-2.0), chunk(7, conf=-2.0), chunk(8, source="google", conf=0.4), chunk(9, end=10.0), chunk(10, end=0.5), chunk(11, clipped=True), chunk(12, align=-6.0), chunk(13, align=-6.0, source="cohere"), chunk(14, conf=nan, source="cohere")]
    got = gates.text_gates(spark.createDataFrame(data, CHUNK))
    assert codes(got) == [None, "text:empty", "text:empty", "text:too_short", "text:script", None, "text:asr_confidence", None, "text:asr_confidence", "text:cps_low", "text:cps_high", "text:boundary_clipped", "align:score", None, None]
    short = got.filter("id = 3").first()
    assert short["script_ratio"] is None and short["reject_value"] == 1.0
    assert gates.text_gates(spark.createDataFrame([], CHUNK)).count() == 0


@pytest.mark.parametrize(("pace", "passes"), [(5.4, True), (9.5, True), (12.8, True), (40.0, False), (2.0, False)])
def test_pace(spark, pace, passes):
    n = len(AR.replace(" ", ""))
    assert (codes(gates.text_gates(spark.createDataFrame([chunk(0, end=n / pace)], CHUNK))) == [None]) == passes


def test_first_reason_sticks(spark):
    held = spark.createDataFrame([chunk(0, "")], CHUNK).withColumn("reject_code", F.lit("music:score")).withColumn("reject_value", F.lit(0.5))
    row = gates.text_gates(held).first()
    assert (row["reject_code"], row["reject_value"]) == ("music:score", 0.5)


def test_resolve(spark):
    rows = [(0, AR, AR), (1, AR, "xyz abc def"), (2, "", AR), (3, AR, None), (4, None, ""), (5, "[x] " + AR, AR)]
    got = gates.resolve_text(spark.createDataFrame(rows, "id int, text_yt string, text_cohere string"))
    assert [(r["text_source"], r["reject_code"]) for r in got.orderBy("id").collect()] == [("yt", None), ("yt", "text:cer"), ("cohere", None), ("yt", "text:asr_empty"), ("none", "text:empty"), ("yt", None)]


def test_row_gates_leave_pending(spark):
    kind = "id int, text string, text_cohere string, text_source string, asr_language string, asr_confidence double, duration double, cer_yt_vs_cohere double"
    marked = "مَرَحَبَا بَكَمَ"
    rows = [(0, "x", None, "pending", "ar", None, 1.0, None), (1, "x", AR, "google_batch", "ar", 0.9, 1.5, 0.3), (2, "x", "", "google_batch", "ar", 0.9, 1.5, 0.3), (3, "x", AR, "cohere", "ar", 0.2, 1.5, None), (4, "x", marked, "cohere", "ar", None, 0.6, None)]
    got = {r["id"]: r for r in gates.row_gates(spark.createDataFrame(rows, kind)).collect()}
    assert [got[i]["reject_code"] for i in range(5)] == [None, None, "text:empty", "text:asr_confidence", None]
    assert got[0]["text"] == "x" and got[1]["text"] == AR and got[1]["cer_yt_vs_cohere"] is None


def test_quality_and_music(spark):
    nan, inf = float("nan"), float("inf")
    kind = "id int, clipping_ratio double, peak_dbfs double, snr_db double, squim_stoi double, squim_pesq double, squim_mos double, accompaniment_ratio double, music_score double"
    rows = [(0, None, None, None, None, None, None, None, None), (1, 0.01, -50.0, 1.0, 0.1, 1.0, 1.0, 0.2, 0.9), (2, 0.0, -inf, 30.0, 0.9, 3.0, 4.0, 0.0, 0.9), (3, nan, nan, nan, nan, nan, nan, nan, nan), (4, 0.0, -0.1, 30.0, 0.9, 3.0, 4.0, 0.1, 0.2), (5, 0.0, -3.0, 30.0, 0.9, 3.0, 2.9, 0.0, 0.0)]
    df = spark.createDataFrame(rows, kind)
    assert codes(gates.apply(df, gates.quality_cascade())) == [None, "quality:clipping", "quality:too_quiet", None, "quality:too_hot", "quality:mos"]
    assert codes(gates.apply(df, gates.music_cascade(Limits(reject_music=True)))) == [None, "music:accompaniment", "music:score", None, None, None]
    assert set(codes(gates.apply(df, gates.music_cascade()))) == {None}


def test_summary(spark, rows):
    df = spark.createDataFrame([("text:empty",), ("text:cer",), (None,)], "reject_code string")
    assert rows(gates.summarize(df)) == [("kept", 1), ("text", 2)]
    kept, rejected = gates.split_kept(df.withColumn("reject_value", F.lit(0.0)))
    assert (kept.count(), rejected.count()) == (1, 2)


def test_diacritized(spark):
    src = "اصوات"
    cases = [(src, "أَصوات", None, "ok_orthography_fixed"), (src, src, None, "no_marks"), (src, "اَصوات", None, "ok"), (src, "x", None, "words_changed"), (src, "", None, "empty"), (src, None, "timeout", "timeout")]
    df = spark.createDataFrame([c[:3] for c in cases], "a string, b string, e string")
    assert [r[0] for r in df.select(gates.diacritized_status(F.col("a"), F.col("b"), F.col("e"))["status"]).collect()] == [c[3] for c in cases]


def test_batch_entries(spark, rows):
    kind = "clips array<string>, items array<struct<i:int,text:string>>, error string"
    data = [(["a", "b"], [(1, "x"), (2, "")], None), (["c", "d"], [(1, "x"), (3, "y")], None), (["e", "f"], [(2, "z")], None), (["g"], None, "batch:quota"), (["h"], None, None)]
    got = rows(gates.batch_entries(spark.createDataFrame(data, kind)))
    assert got == [("a", "x", "ok"), ("b", "", "ok"), ("c", None, "index_mismatch"), ("d", None, "index_mismatch"), ("e", None, "missing_index"), ("f", "z", "ok"), ("g", None, "batch:quota"), ("h", None, "no_response")]


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"pieces": {"margin": 0.1}}')
    config = Config.load(str(path), {"limits.words": 3, "limits.pace": [1, 2]})
    assert (config.pieces.margin, config.limits.words, config.limits.mos, config.limits.pace) == (0.1, 3, 3.0, (1, 2))
    with pytest.raises(KeyError, match="pieces.padding"):
        Config.load(None, {"pieces.padding": 1})
