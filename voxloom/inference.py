"""Pluggable model inference: a contract for batches, and deterministic stand-ins.

A model is a picklable factory: called once per Python worker task, it gives a function from a batch of payloads to
results.  A result is ``(value, confidence, status)``; failures become a status, never an exception.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

Result = tuple[str | None, float | None, str]
Model = Callable[[list], list[Result]]
RESULT = pa.struct([("value", pa.string()), ("confidence", pa.float64()), ("status", pa.string())])


def unit_hash(*parts: object) -> float:
    """A number in [0, 1) that depends on the parts only."""
    return int.from_bytes(hashlib.blake2b("\x01".join(map(str, parts)).encode(), digest_size=6).digest()) / 2**48


def run_model(table: DataFrame, factory: Callable[[], Model], inputs: list[str], out: str = "result", batch: int = 64, retries: int = 2) -> DataFrame:
    """``table`` with the struct ``out`` = (value, confidence, status) of each row.

    The model is made once per task and sees lists of up to ``batch`` dictionaries of ``inputs``.  A failing batch is
    tried again row by row, so that one bad row costs itself only; what fails then has its message as status.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)

    def attempt(model: Model, rows: list[dict]) -> list[Result]:
        try:
            return model(rows)
        except Exception as whole:  # noqa: BLE001 - the status tells
            if len(rows) > 1:
                return [r for row in rows for r in attempt(model, [row])]
            for _ in range(retries):
                try:
                    return model(rows)
                except Exception as again:  # noqa: BLE001
                    whole = again
            return [(None, None, f"error:{str(whole)[:60]}")]

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for part in batches:
            rows = part.select(inputs).to_pylist()
            results = [r for a in range(0, len(rows), batch) for r in attempt(model, rows[a : a + batch])]
            column = pa.array([dict(zip(("value", "confidence", "status"), r)) for r in results], RESULT)
            yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, out])

    return table.mapInArrow(mapper, f"{fields}, `{out}` struct<value:string,confidence:double,status:string>")


def stand_in_recognizer(shortest: float = 0.1) -> Callable[[], Model]:
    """Recognizer that repeats a given text with a confidence by hash; shorter clips aren't sent."""

    def factory() -> Model:
        def model(rows: list[dict]) -> list[Result]:
            return [(None, None, "not_sent") if (r["duration"] or 0) < shortest else (r["text"] or "", unit_hash("asr", r["text"]), "ok") for r in rows]

        return model

    return factory


#: Backends by name; a backend that only fills rows later isn't dispatched here.
BACKENDS: dict[str, Callable[[], Callable[[], Model]]] = {"google": stand_in_recognizer, "cohere": stand_in_recognizer}


def recognize(clips: DataFrame, backend: str) -> DataFrame:
    """Clips (``text``, ``duration``) through a backend; an unknown one is an error."""
    if backend not in BACKENDS:
        raise ValueError(f"unknown backend {backend}; there are {sorted(BACKENDS)}")
    return run_model(clips, BACKENDS[backend](), ["text", "duration"])


@F.arrow_udf(S.ArrayType(S.DoubleType()))
def stand_in_embedding(key: pa.Array, duration: pa.Array) -> pa.Array:
    """Unit vector of 16 numbers by hash of the key; zeros for clips under 0.8 s."""

    def vector(k: str, d: float) -> list[float]:
        if (d or 0) < 0.8:
            return [0.0] * 16
        v = np.array([unit_hash(k, i) - 0.5 for i in range(16)])
        return (v / np.linalg.norm(v)).tolist()

    return pa.array([vector(k, d) for k, d in zip(key.to_pylist(), duration.to_pylist())], pa.list_(pa.float64()))


_SCORES = ("music_score", "speech_score", "vocal_ratio", "accompaniment_ratio", "squim_stoi", "squim_pesq", "squim_mos")


@F.arrow_udf(S.StructType([S.StructField(s, S.DoubleType()) for s in _SCORES]))
def stand_in_scores(key: pa.Array) -> pa.Array:
    """Scores of a clip by hash of its key, in the ranges of the true ones."""
    span = {"squim_pesq": (1.0, 3.5), "squim_mos": (1.0, 4.0)}
    low = {s: span.get(s, (0.0, 1.0)) for s in _SCORES}
    return pa.array([{s: low[s][0] + low[s][1] * unit_hash(s, k) for s in _SCORES} for k in key.to_pylist()], pa.struct([(s, pa.float64()) for s in _SCORES]))


def reference_clip(clips: DataFrame, group: str = "video_id", score: str = "squim_stoi") -> DataFrame:
    """Per group the clip of the greatest score, against which others are judged; ties by file name."""
    return clips.filter(F.col(score).isNotNull() & ~F.isnan(score)).groupBy(group).agg(F.max_by("audio_file", F.struct(F.col(score), F.col("audio_file"))).alias("reference"))


@F.arrow_udf(S.ArrayType(S.StructType().add("start", S.DoubleType()).add("end", S.DoubleType())))
def energy_regions(samples: pa.Array, rate: pa.Array, floor_db: pa.Array) -> pa.Array:
    """Regions above a level, of frames of 20 ms: a stand-in for voice detection."""

    def regions(x: list, sr: int, floor: float) -> list[dict]:
        frame = max(1, int(0.02 * sr))
        n = len(x) // frame
        if not n:
            return []
        level = 20 * np.log10(np.maximum(np.sqrt((np.asarray(x[: n * frame]).reshape(n, frame) ** 2).mean(axis=1)), 1e-10))
        loud = np.concatenate([[0], (level > floor).astype(int), [0]])
        edges = np.flatnonzero(np.diff(loud)).reshape(-1, 2) * frame / sr
        return [{"start": float(a), "end": float(b)} for a, b in edges]

    kind = pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64())]))
    return pa.array([regions(*r) for r in zip(samples.to_pylist(), rate.to_pylist(), floor_db.to_pylist())], kind)


def single_speaker(videos: DataFrame, label: str = "SPEAKER_00") -> DataFrame:
    """One turn over each recording, for where diarization is missing."""
    return videos.select("video_id", F.lit(0.0).alias("start"), F.col("duration").alias("end"), F.lit(label).alias("speaker"))


def diarized_or_single(turns: DataFrame, videos: DataFrame) -> DataFrame:
    """Turns, and ``single_speaker`` for recordings without any."""
    return turns.select("video_id", "start", "end", "speaker").unionByName(single_speaker(videos.join(turns.select("video_id").distinct(), "video_id", "left_anti")))


def halving(size: int, least: int = 2) -> list[int]:
    """Batch sizes to try after running out of memory."""
    out = [size]
    while out[-1] // 2 >= least:
        out.append(out[-1] // 2)
    return out


def is_out_of_memory(message: str) -> bool:
    """Whether a failure calls for a smaller batch."""
    return any(m in message.lower() for m in ("memoryerror", "out of memory", "batch_size"))


def checked_isolation(durations: DataFrame, most: float = 0.25) -> DataFrame:
    """Adds ``isolated``: whether separated audio kept its length to within ``most`` seconds; drifted audio is refused."""
    return durations.withColumn("isolated", F.coalesce(F.abs(F.col("separated_duration") - F.col("duration")) <= most, F.lit(False)))
