"""Audio features: any payload of bytes stored as 8-bit samples, and log-mel tensors and segments of what is stored.

encode: the payload becomes a mono WAV file of unsigned 8-bit samples, one sample a byte; nothing is lost.
decode: reads the file's own header and gives back the samples.
features: samples (RATE a second) are resampled to UP / DOWN of that rate by a polyphase filter, cut into overlapped
frames, and each frame's power spectrum is summed into MELS log-mel bands. Frames come as tensors of the fixed shape
(FRAMES, MELS), zero-padded at the end, each with its time span. Segments are found by hysteresis on a frame's energy:
one begins where it passes the upper level and lasts until it falls below the lower one; levels are quantiles of the
file's own energies. A worker holds one file and a few thousand of its frames at a time.

Cases: null or empty text: 64 zero bytes. Very long text: one file, in memory that grows with it. Equal texts, equal
values: numbers are rounded before they are kept. Repeated rows: a row each. Null doc_id: carried along. Extra columns,
whatever their names: left out. Empty table: no rows.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrata.llm import common

RATE, UP, DOWN = 16_000, 1, 2
TAPS = 32
FRAME, HOP, FFT = 200, 80, 256
MELS, FRAMES = 24, 64
ENTER, LEAVE = 0.6, 0.4

SCHEMA = "doc_id long, n_bytes long, media binary, features binary, spans array<struct<start_s: double, end_s: double>>, segments array<struct<start_s: double, end_s: double>>"


def payload(text: bytes) -> bytes:
    """The text with zero bytes up to a positive multiple of 64."""
    return text + bytes(-len(text) % 64 if text else 64)


def encode(samples: bytes, rate: int = RATE) -> bytes:
    """A WAV file of unsigned 8-bit mono samples."""
    odd = len(samples) % 2
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples) + odd, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(samples))
    return head + samples + bytes(odd)


def decode(media: bytes) -> tuple[bytes, int]:
    """The samples and the rate of a WAV file that encode made (other chunks are passed over)."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate = 12, 0
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("not 8-bit mono samples")
        elif name == b"data":
            return media[at + 8 : at + 8 + size], rate
        at += 8 + size + size % 2
    raise ValueError("no samples")


def _lowpass() -> np.ndarray:
    """A windowed sinc at the rate after upsampling, which passes what both rates can hold."""
    n = np.arange(TAPS * UP) - (TAPS * UP - 1) / 2
    cut = 1 / max(UP, DOWN)
    h = cut * np.sinc(cut * n) * np.hamming(TAPS * UP)
    return (h / h.sum() * UP).astype(np.float32)


_H = _lowpass()


def resample(x: np.ndarray) -> np.ndarray:
    """x at UP / DOWN of its rate. Output m takes phase (m * DOWN) mod UP of the filter; the products of a phase are correlations of every DOWN-th sample with every DOWN-th tap."""
    n = -(-len(x) * UP // DOWN)
    padded = np.zeros(len(x) + TAPS + TAPS // 2 + DOWN, dtype=np.float32)
    padded[TAPS // 2 : TAPS // 2 + len(x)] = x
    out = np.empty(n, dtype=np.float32)
    for phase in range(min(UP, n)):
        taps, base, count = _H[phase * DOWN % UP :: UP][::-1], phase * DOWN // UP, len(range(phase, n, UP))
        total = np.zeros(count, dtype=np.float32)
        for d in range(DOWN):
            own = np.ascontiguousarray(taps[d::DOWN])
            total += np.correlate(np.ascontiguousarray(padded[base + d :: DOWN][: count + len(own) - 1]), own, "valid")
        out[phase::UP] = total
    return out


def _mel_bank() -> np.ndarray:
    rate = RATE * UP / DOWN
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(0, mel(rate / 2), MELS + 2) / 2595) - 1)
    freq = np.arange(FFT // 2 + 1) * rate / FFT
    up = (freq[None, :] - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    down = (edges[2:, None] - freq[None, :]) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(up, down)).T.astype(np.float32)


_MEL, _WINDOW = _mel_bank(), np.hanning(FRAME).astype(np.float32)


def log_mel(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frames, MELS) log energies, rounded to 0.01, and each frame's energy in decibels, rounded to 0.01."""
    n = max(1, -(-max(0, len(x) - FRAME) // HOP) + 1)
    padded = np.zeros(FRAME + (n - 1) * HOP, dtype=np.float32)
    padded[: len(x)] = x[: len(padded)]
    frames = np.lib.stride_tricks.sliding_window_view(padded, FRAME)[::HOP]
    mels, energy = np.empty((n, MELS), np.float32), np.empty(n, np.float32)
    for i in range(0, n, 4096):
        part = frames[i : i + 4096] * _WINDOW
        spectrum = np.fft.rfft(part, FFT, axis=1)
        power = (spectrum.real**2 + spectrum.imag**2).astype(np.float32)
        mels[i : i + 4096] = np.log10(power @ _MEL + 1e-6)
        energy[i : i + 4096] = 10 * np.log10((part * part).mean(axis=1) + 1e-9)
    return np.round(mels, 2) + np.float32(0), np.round(energy, 2) + np.float32(0)


def hysteresis(energy: np.ndarray) -> np.ndarray:
    """(first, last + 1) frames of the segments."""
    enter, leave = np.quantile(energy, [ENTER, LEAVE])
    state = np.where(energy >= enter, 1, np.where(energy < leave, -1, 0))
    told = np.where(state != 0, np.arange(len(state)), -1)
    last = np.maximum.accumulate(told)
    on = (last >= 0) & (state[np.maximum(last, 0)] == 1)
    edges = np.diff(np.concatenate([[0], on.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], axis=1)


def features(samples: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tensors (k, FRAMES, MELS), their spans and the segments, both in seconds."""
    x = (np.frombuffer(samples, dtype=np.uint8).astype(np.float32) - 128) / 128
    mel, energy = log_mel(resample(x))
    seconds = HOP * DOWN / (UP * RATE)
    k = -(-len(mel) // FRAMES)
    tensors = np.zeros((k * FRAMES, MELS), np.float32)
    tensors[: len(mel)] = mel
    begin = np.arange(k) * FRAMES * seconds
    end = np.minimum((np.arange(k) + 1) * FRAMES, len(mel)) * seconds
    return tensors.reshape(k, FRAMES, MELS), np.round(np.stack([begin, end], axis=1), 4), np.round(hysteresis(energy) * seconds, 4)


def tensor_type() -> pa.DataType:
    return pa.fixed_shape_tensor(pa.float32(), [FRAMES, MELS], dim_names=["frame", "mel"])


def to_arrow(tensors: np.ndarray) -> bytes:
    """An Arrow stream with one column of fixed-shape tensors."""
    array = pa.FixedShapeTensorArray.from_numpy_ndarray(np.ascontiguousarray(tensors), dim_names=["frame", "mel"])
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([array], names=["log_mel"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_arrow(data: bytes) -> np.ndarray:
    """The tensors of to_arrow."""
    column = pa.ipc.open_stream(data).read_all().column("log_mel").combine_chunks()
    return column.to_numpy_ndarray()


def _spans(rows: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.zeros((0, 2))
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["start_s", "end_s"]))


def audio(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text): the stored file (media), its tensors as an Arrow stream (features), their time spans, and the segments; n_bytes: of the text."""
    common.small_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch):
        rows, size = [], 0
        ids = batch.column("doc_id")
        done = 0
        for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            media = encode(payload(text))
            tensors, spans, segments = features(decode(media)[0])
            rows.append((len(text), media, to_arrow(tensors), spans, segments))
            size += len(media) + len(rows[-1][2])
            if size > common.BATCH_BYTES or i + 1 == batch.num_rows:
                yield pa.RecordBatch.from_arrays([ids.slice(done, len(rows)), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary()), _spans([r[3] for r in rows]), _spans([r[4] for r in rows])], names=["doc_id", "n_bytes", "media", "features", "spans", "segments"])
                done, rows, size = i + 1, [], 0

    return common.mapped(common.texts(docs), run, SCHEMA)


def audio_digest(docs: DataFrame) -> DataFrame:
    """What audio stores, read back, as digests."""
    made = audio(docs)
    # the samples begin after the 44 bytes of the header, whose last four, the lowest first, tell how many they are
    length = sum((F.conv(F.hex(F.substring("media", 41 + k, 1)), 16, 10).cast("long") * 256**k for k in range(1, 4)), F.conv(F.hex(F.substring("media", 41, 1)), 16, 10).cast("long"))
    read = made.withColumn("payload_bytes", length).withColumn("payload", F.expr("substring(media, 45, int(payload_bytes))"))
    brief = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start_s"].cast("string"), s["end_s"].cast("string"))), ",")
    return read.select(
        "doc_id",
        "n_bytes",
        "payload_bytes",
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -64, 64)")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(":", F.lit("logmel"), F.size("spans").cast("string"), F.size("segments").cast("string"), F.md5("features"), F.md5(F.concat_ws("|", brief("spans"), brief("segments")).cast("binary"))).alias("feature"),
    )
