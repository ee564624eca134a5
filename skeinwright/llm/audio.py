"""Media columns: audio features of 8-bit sample payloads.

``media_table`` stores a payload losslessly as a mono 8-bit WAV value, and ``audio_features`` reads
such values back, resamples them with a polyphase filter bank, takes overlapped log-mel frames and
segments the signal by energy with hysteresis. Features are kept as an Arrow IPC stream whose column
``logmel`` has the extension type ``arrow.fixed_shape_tensor`` (``TENSOR_FRAMES`` x ``MELS``), with the
time span of each tensor beside it.

Defined results: a null or empty text has the payload of 64 zero bytes; the last tensor is padded with
zeros and ``valid`` counts its real frames; a media value that is null gives null features. Rows are
independent, so ties, repeated rows and empty tables need nothing special; only the named columns are
read, so columns with clashing names don't matter.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, once

PAD = 64
STORED_RATE, RATE = 12_000, 8_000
WINDOW, HOP, FFT, MELS = 200, 80, 256, 40
TENSOR_FRAMES = 32
ENTER_DB, LEAVE_DB = 0.0, -3.0
BLOCK = 1 << 15
GRID = 256
HEADER = 44

FEATURES = (
    "struct<n_samples:bigint,n_frames:bigint,tensors:binary,"
    "segments:array<struct<start_ms:double,end_ms:double>>>"
)


def wav_encode(payload: bytes, rate: int = STORED_RATE) -> bytes:
    """A canonical RIFF/WAVE value: PCM, one channel, 8 bits."""
    return struct.pack(
        "<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload)
    ) + payload


def wav_decode(media: bytes) -> tuple[int, memoryview]:
    """Rate and samples, by walking the chunks."""
    view, at, rate = memoryview(media), 12, 0
    if bytes(view[:4]) != b"RIFF" or bytes(view[8:12]) != b"WAVE":
        raise ValueError("not a WAVE value")
    while at + 8 <= len(view):
        kind, size = struct.unpack_from("<4sI", view, at)
        if kind == b"fmt ":
            form, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", view, at + 8)
            if (form, channels, bits) != (1, 1, 8):
                raise ValueError("only mono 8-bit PCM is read")
        elif kind == b"data":
            return rate, view[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no data chunk")


@lru_cache
def filter_bank(up: int, down: int, crossings: int = 6) -> tuple[np.ndarray, int]:
    """The phases (up x taps) of a windowed-sinc low-pass, and the prototype's centre."""
    wide = max(up, down)
    centre = crossings * wide
    t = np.arange(-centre, centre + 1) / wide
    h = np.sinc(t) * np.kaiser(2 * centre + 1, 6.0)
    h *= up / h.sum()
    h = np.concatenate([h, np.zeros(-len(h) % up)])
    return h.reshape(-1, up).T, centre


def resample(x: np.ndarray, up: int, down: int) -> np.ndarray:
    """y[n] is the sum over j of h[j] * v[n*down + centre - j], v being x with up-1 zeros between."""
    phases, centre = filter_bank(up, down)
    taps = phases.shape[1]
    count = -(-len(x) * up // down)
    y = np.empty(count)
    reach = (count * down + centre) // up + 1
    padded = np.zeros(taps - 1 + max(reach, len(x)))
    padded[taps - 1 : taps - 1 + len(x)] = x
    windows = sliding_window_view(padded, taps)
    for first in range(min(up, count)):
        at = first * down + centre
        kernel = np.ascontiguousarray(phases[at % up][::-1])
        rows = windows[at // up :: down][: -(-(count - first) // up)]
        for k in range(0, len(rows), BLOCK):
            y[first + up * k : first + up * (k + BLOCK) : up] = rows[k : k + BLOCK] @ kernel
    return y


@lru_cache
def mel_weights() -> np.ndarray:
    """Triangles of equal width on the mel scale, (FFT/2+1) x MELS."""
    mel = lambda hz: 2595 * np.log10(1 + hz / 700)
    edges = 700 * (10 ** (np.linspace(mel(0), mel(RATE / 2), MELS + 2) / 2595) - 1)
    bins = np.arange(FFT // 2 + 1) * RATE / FFT
    rise = (bins[:, None] - edges[:-2]) / (edges[1:-1] - edges[:-2])
    fall = (edges[2:] - bins[:, None]) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(rise, fall))


@lru_cache
def hann() -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(WINDOW) / WINDOW)


def on_grid(x: np.ndarray) -> np.ndarray:
    """Rounded to 1/GRID, so that the last bits, in which processors differ, don't reach stored values."""
    return np.round(x * GRID) / GRID


def log_mel(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-mel frames (n x MELS) and each frame's energy in dB; the last frame is padded with zeros."""
    count = 1 + max(0, -(-(len(y) - WINDOW) // HOP))
    padded = np.zeros(WINDOW + (count - 1) * HOP)
    padded[: len(y)] = y[: len(padded)]
    frames = sliding_window_view(padded, WINDOW)[::HOP]
    mels, energy = np.empty((count, MELS)), np.empty(count)
    step = max(1, BLOCK // WINDOW)
    for k in range(0, count, step):
        part = frames[k : k + step]
        energy[k : k + step] = on_grid(10 * np.log10(np.einsum("ij,ij->i", part, part) / WINDOW + 1e-10))
        spectrum = np.fft.rfft(part * hann(), FFT)
        power = spectrum.real**2 + spectrum.imag**2
        mels[k : k + step] = on_grid(np.log(power @ mel_weights() + 1e-6))
    return mels, energy


def hysteresis(energy: np.ndarray, enter: float, leave: float) -> list[tuple[int, int]]:
    """Runs of frames that begin at energy >= enter and last until energy < leave."""
    mark = np.where(energy >= enter, 1, np.where(energy < leave, -1, 0))
    last = np.maximum.accumulate(np.where(mark != 0, np.arange(len(mark)), 0))
    on = np.concatenate([[False], mark[last] == 1, [False]])
    edges = np.flatnonzero(on[1:] != on[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def features_of(media: bytes) -> dict:
    """The features of one stored value."""
    rate, samples = wav_decode(media)
    x = (np.frombuffer(samples, np.uint8).astype(np.float64) - 128) / 128
    step = np.gcd(rate, RATE)
    mels, energy = log_mel(resample(x, int(RATE // step), int(rate // step)))
    mean = float(energy.mean(dtype=np.float64))
    ms = 1000 / RATE
    spans = [
        {"start_ms": a * HOP * ms, "end_ms": ((b - 1) * HOP + WINDOW) * ms}
        for a, b in hysteresis(energy, mean + ENTER_DB, mean + LEAVE_DB)
    ]
    count = -(-len(mels) // TENSOR_FRAMES)
    cells = np.zeros((count * TENSOR_FRAMES, MELS), np.float32)
    cells[: len(mels)] = mels
    first = np.arange(count) * TENSOR_FRAMES
    valid = np.minimum(len(mels) - first, TENSOR_FRAMES)
    batch = pa.record_batch(
        [
            pa.array(first * HOP * ms),
            pa.array(((first + valid - 1) * HOP + WINDOW) * ms),
            pa.array(valid.astype(np.int32)),
            pa.FixedShapeTensorArray.from_numpy_ndarray(cells.reshape(count, TENSOR_FRAMES, MELS)),
        ],
        ["start_ms", "end_ms", "valid", "logmel"],
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return {"n_samples": len(x), "n_frames": len(mels), "tensors": sink.getvalue().to_pybytes(), "segments": spans}


def read_tensors(stored: bytes) -> pa.Table:
    """start_ms, end_ms, valid and the tensor column of one row."""
    return pa.ipc.open_stream(stored).read_all()


_FEATURE_TYPE = pa.struct(
    [
        ("n_samples", pa.int64()),
        ("n_frames", pa.int64()),
        ("tensors", pa.binary()),
        ("segments", pa.list_(pa.struct([("start_ms", pa.float64()), ("end_ms", pa.float64())]))),
    ]
)


def _features(media: pa.Array) -> pa.Array:
    return pa.array([None if m is None else features_of(m) for m in media.to_pylist()], _FEATURE_TYPE)


def payload(text: Column) -> Column:
    """UTF-8 of the text (null: empty), with zero bytes up to a positive multiple of PAD."""
    raw = F.coalesce(text.cast("binary"), F.lit(b""))
    size = F.octet_length(raw)
    pad = F.when(size == 0, F.lit(PAD)).otherwise(F.pmod(-size, F.lit(PAD)))
    return F.concat(raw, F.substring(F.lit(bytes(PAD)), F.lit(1), pad))


def _le32(value: Column) -> Column:
    """Four bytes, the lowest first."""
    hexed = F.lpad(F.hex(value.cast("long")), 8, "0")
    return F.unhex(F.concat(*[F.substring(hexed, i, 2) for i in (7, 5, 3, 1)]))


def wav_value(samples: Column, rate: int = STORED_RATE) -> Column:
    """``wav_encode`` as a built-in expression."""
    head = wav_encode(b"", rate)
    size = F.octet_length(samples)
    return F.concat(
        F.lit(head[:4]), _le32(size + 36), F.lit(head[8:40]), _le32(size), samples
    )


def wav_payload(media: Column) -> Column:
    """The samples of a canonical value, by the size that its header states."""
    size = F.conv(F.hex(F.concat(*[F.substring(media, i, 1) for i in (44, 43, 42, 41)])), 16, 10).cast("int")
    return F.substring(media, F.lit(HEADER + 1), size)


def media_table(df: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """Adds the stored form of each text's payload."""
    return df.withColumn(media, wav_value(payload(df[text])))


def audio_features(df: DataFrame, media: str = "media", out: str = "features") -> DataFrame:
    """Adds a FEATURES struct computed from the stored media values."""
    bound_batches(df.sparkSession)
    return df.withColumn(out, once(_features, FEATURES)(F.col(media)))
