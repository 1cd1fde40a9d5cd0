"""Telephony audio columns: companded and ADPCM speech to resampled PCM.

``store`` wraps a payload of 8-bit samples losslessly in a WAV container (mu-law,
A-law) or IMA ADPCM blocks; ``decode`` adds the sound itself, 16-bit PCM at
twice the rate, as a second stored column; ``features`` reads both back, and
``save`` writes them as a table. Companded samples
expand through 256-entry tables computed from the G.711 rule. ADPCM is a
recurrence along a block's samples but independent between blocks, so the
decoder runs one step for all blocks of a batch at a time. PCM is resampled by
an integer factor with a fixed windowed-sinc filter, a polyphase dot product.

Documents become telephony payloads as their UTF-8 bytes, padded with 255
(mu-law silence) to a positive multiple of 576, a block that every rate and
frame size in use divides.

Edge cases: a null text is the empty text (one padding block); equal texts give
equal stored bytes; a null or damaged media value reads as a null payload;
texts of any length are handled a text at a time; repeated rows are separate
rows; an empty table gives no rows; other columns of any name go.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, pick, slices, stored
from .exchange import packed_rows

#: Bytes of a padded payload come in multiples of this.
UNIT = 576
RATE = 8000
#: Samples of stored PCM for each sample of speech.
UP = 2
#: WAV format tags (fixed values).
PCM, A_LAW, MU_LAW, IMA_ADPCM = 1, 6, 7, 17
#: IMA ADPCM index changes by the low three bits of a code (fixed values).
INDEX_STEP = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)
#: IMA ADPCM quantiser steps (fixed values).
STEPS = np.array(
    [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
    np.int32,
)

STORED = "doc_id long, n_bytes long, media binary"
SOUNDS = STORED + ", sound binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, rate int, pcm_samples long, pcm_sha256 string"


@lru_cache(maxsize=1)
def mu_law_table() -> np.ndarray:
    """16-bit value of each mu-law byte: bits inverted; sign, 3-bit exponent, 4-bit mantissa, bias 132."""
    code = ~np.arange(256) & 0xFF
    size = (((code & 15) << 3) + 132 << (code >> 4 & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


@lru_cache(maxsize=1)
def a_law_table() -> np.ndarray:
    """16-bit value of each A-law byte: even bits inverted; the lowest segment is linear."""
    code = np.arange(256) ^ 0x55
    part, segment = (code & 15) << 4, code >> 4 & 7
    size = np.where(segment == 0, part + 8, (part + 264) << np.maximum(segment - 1, 0))
    return np.where(code & 128, size, -size).astype(np.int16)


@lru_cache(maxsize=8)
def _kernel(up: int) -> np.ndarray:
    """Hann-windowed sinc, 8 taps for each of ``up`` phases, each phase summing to one."""
    half = 4 * up
    at = np.arange(-half, half + 1)[:-1]
    taps = np.sinc(at / up) * (0.5 + 0.5 * np.cos(np.pi * at / half))
    phases = taps.reshape(8, up).T[:, ::-1]
    return (phases / phases.sum(1, keepdims=True)).astype(np.float32)


def resample(pcm: np.ndarray, up: int = UP) -> np.ndarray:
    """``up`` times as many samples; both ends are held."""
    if up == 1 or not len(pcm):
        return pcm.astype(np.int16)
    padded = np.concatenate([np.full(3, pcm[0]), pcm, np.full(4, pcm[-1])]).astype(np.float32)
    out = np.empty((len(pcm), up), np.int16)
    for phase, taps in enumerate(_kernel(up)):
        out[:, phase] = np.clip(np.rint(np.correlate(padded, taps, "valid")), -32768, 32767)
    return out.reshape(-1)


@lru_cache(maxsize=1)
def _adpcm_moves() -> tuple[np.ndarray, np.ndarray]:
    """Change of value, and 16 times the next step index, by 16 * index + code."""
    step, code = STEPS[:, None], np.arange(16)[None, :]
    size = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
    following = np.clip(np.arange(len(STEPS))[:, None] + INDEX_STEP[code & 7], 0, len(STEPS) - 1)
    return np.where(code & 8, -size, size).astype(np.int32).reshape(-1), (16 * following).astype(np.int32).reshape(-1)


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """IMA ADPCM mono blocks (n, bytes) to samples (n, 1 + 2 * (bytes - 4)).

    A block: first sample (16 bits), step index, a reserved byte, then codes,
    low half first. An index beyond the table is held at its end.
    """
    n, wide = blocks.shape
    head = np.ascontiguousarray(blocks[:, :2]).view("<i2")[:, 0].astype(np.int32)
    index = 16 * np.minimum(blocks[:, 2], len(STEPS) - 1).astype(np.int32)
    data = blocks[:, 4:].T  # a row a step, so that each step reads one stretch
    codes = np.empty((2 * (wide - 4), n), np.uint8)
    codes[0::2], codes[1::2] = data & 15, data >> 4
    out = np.empty((1 + len(codes), n), np.int16)
    out[0] = value = head
    change, following = _adpcm_moves()
    for k, code in enumerate(codes, 1):
        at = index + code
        value = value + change.take(at)
        np.minimum(value, 32767, out=value)
        np.maximum(value, -32768, out=value)
        index = following.take(at)
        out[k] = value
    return out.T


def encode_adpcm(pcm: np.ndarray, block: int = 256) -> np.ndarray:
    """16-bit samples to IMA ADPCM blocks of ``block`` bytes; the last one is filled with its last sample."""
    per = 1 + 2 * (block - 4)
    n = max(1, -(-len(pcm) // per))
    last = pcm[-1] if len(pcm) else 0
    samples = np.concatenate([pcm, np.full(n * per - len(pcm), last)]).astype(np.int32).reshape(n, per)
    value, index = samples[:, 0].copy(), np.zeros(n, np.int32)
    codes = np.empty((n, per - 1), np.uint8)
    for k in range(1, per):
        step, gap = STEPS[index], samples[:, k] - value
        size, code = np.abs(gap), np.where(gap < 0, 8, 0)
        change = step >> 3
        for bit, part in ((4, step), (2, step >> 1), (1, step >> 2)):
            on = size >= part
            code, change, size = code + bit * on, change + part * on, size - part * on
        value = np.clip(value + np.where(code & 8, -change, change), -32768, 32767)
        index = np.clip(index + INDEX_STEP[code & 7], 0, len(STEPS) - 1)
        codes[:, k - 1] = code
    out = np.zeros((n, block), np.uint8)
    out[:, :2] = samples[:, :1].astype("<i2").view(np.uint8)
    out[:, 4:] = codes[:, 0::2] | codes[:, 1::2] << 4
    return out


def wav(payload: bytes | memoryview, form: int, rate: int = RATE, align: int = 1, bits: int = 8) -> bytes:
    """A one-channel RIFF container around ``payload``."""
    fmt = struct.pack("<HHIIHHH", form, 1, rate, rate * align if form != IMA_ADPCM else rate // 2, align, bits, 0)
    pad = b"\0" * (len(payload) % 2)
    size = 20 + len(fmt) + len(payload) + len(pad)
    return b"".join([b"RIFF", struct.pack("<I", size), b"WAVEfmt ", struct.pack("<I", len(fmt)), fmt, b"data", struct.pack("<I", len(payload)), payload, pad])


def unwav(media: bytes) -> tuple[int, int, int, memoryview] | None:
    """Format, rate, block size and payload of a RIFF container; None if it is damaged."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        return None
    at, form = 12, None
    view = memoryview(media)
    while at + 8 <= len(media):
        name, size = bytes(view[at : at + 4]), struct.unpack_from("<I", media, at + 4)[0]
        if at + 8 + size > len(media):
            return None
        if name == b"fmt " and size >= 16:
            form = struct.unpack_from("<HHIIHH", media, at + 8)
        elif name == b"data" and form:
            return form[0], form[2], form[4], view[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    return None


def expand(form: int, payload: np.ndarray, align: int) -> np.ndarray:
    """16-bit PCM of a payload of any of the stored forms."""
    if form == MU_LAW:
        return mu_law_table()[payload]
    if form == A_LAW:
        return a_law_table()[payload]
    if form == IMA_ADPCM:
        return decode_adpcm(payload[: len(payload) // align * align].reshape(-1, align)).reshape(-1)
    return payload[: len(payload) // 2 * 2].view("<i2")


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Bytes of the text, and the text padded to a positive multiple of UNIT."""
    raw = (text or "").encode()
    return len(raw), raw + b"\xff" * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))


def store(docs: DataFrame, form: int = MU_LAW) -> DataFrame:
    """Each text's payload in a WAV container (``STORED``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 8 << 20):
                n, padded = zip(*map(payload_of, batch.column("text").to_pylist()))
                media = [wav(x, form) for x in padded]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return pick(docs, doc_id="long", text="string").mapInArrow(run, STORED)


def sound_of(media: bytes | None, up: int) -> bytes | None:
    """The resampled 16-bit PCM of a stored sound, in a container of its own; None if it is null or damaged."""
    found = unwav(media) if media else None
    if found is None:
        return None
    form, rate, align, payload = found
    pcm = resample(expand(form, np.frombuffer(payload, np.uint8), align), up).astype("<i2")
    return wav(memoryview(pcm).cast("B") if len(pcm) else b"", PCM, rate * up, 2, 16)


def decode(media: DataFrame, up: int = UP) -> DataFrame:
    """The stored sounds with ``sound``: each one as ``up`` times as many samples of PCM (``SOUNDS``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "media", 4 << 20):
                sounds = pa.array([sound_of(x, up) for x in batch.column("media").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_bytes", "media")), sounds], names=["doc_id", "n_bytes", "media", "sound"])

    return pick(media, doc_id="long", n_bytes="long", media="binary").mapInArrow(run, SOUNDS)


def save(docs: DataFrame, path: str, form: int = MU_LAW, up: int = UP) -> None:
    """Write each text's telephony form and its resampled PCM as a Parquet table."""
    decode(store(docs, form), up).write.parquet(path)


#: Texts that go through a worker at once where sounds are stored, and parts of the corpus whose sounds are stored at a time.
SOUND_ROWS, SOUND_PARTS = 200, 8


def stored_features(docs: DataFrame, form: int = MU_LAW, up: int = UP, parts: int = SOUND_PARTS) -> DataFrame:
    """Every text's telephony form and resampled PCM written to the shared folder, read back and described (``FEATURES``).

    Sounds are about four times the corpus as it lies compressed, so a part of the
    documents, told by a hash of the row, is stored at a time; its files go when it
    has been read back and described. ``save`` is for sounds that are to stay. Rows
    go through a worker SOUND_ROWS at a time, so its memory does not grow either.
    """
    rows = pick(docs, doc_id="long", text="string")
    done = []
    with packed_rows(docs.sparkSession, SOUND_ROWS):
        for part in range(parts):
            mine = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) == part)
            sounds = stored(decode(store(mine, form), up), "telephony-sounds", packed=True)
            done.append(stored(features(sounds), "telephony-features"))
            discard(sounds)
    return reduce(DataFrame.unionByName, done)


def _levels(payloads: list[np.ndarray], sounds: list[np.ndarray]) -> list[str]:
    """A feature text for each payload and its resampled sound.

    Read as mu-law and as A-law: root mean square; as mu-law, zero crossings;
    the sound's peak; as ADPCM blocks of UNIT bytes: root mean square. The ADPCM
    blocks of all payloads are decoded together.
    """
    if not payloads:
        return []
    blocks = np.concatenate([p[: len(p) // UNIT * UNIT].reshape(-1, UNIT) for p in payloads])
    power = np.concatenate([(decode_adpcm(blocks[i : i + 2048]).T.astype(np.float64) ** 2).sum(0).astype(np.int64) for i in range(0, len(blocks), 2048)]) if len(blocks) else np.zeros(0, np.int64)
    out, at = [], 0
    for p, sound in zip(payloads, sounds):
        words = []
        counts = np.bincount(p, minlength=256)
        for name, table in (("mu", mu_law_table()), ("a", a_law_table())):
            # Energy by the byte histogram, an exact integer.
            energy = int(counts @ (table.astype(np.int64) ** 2))
            words.append(f"{name}_rms={round((energy / max(1, len(p))) ** 0.5)}")
        pcm = mu_law_table()[p]
        negative = pcm < 0
        words.append(f"zero_crossings={int((negative[1:] != negative[:-1]).sum())};peak={max(int(sound.max(initial=0)), -int(sound.min(initial=0)))}")
        n = len(p) // UNIT
        total = int(power[at : at + n].sum())
        at += n
        words.append(f"adpcm_rms={round((total / max(1, n * (2 * UNIT - 7))) ** 0.5)}")
        out.append(";".join(words))
    return out


def features(sounds: DataFrame) -> DataFrame:
    """Read both stored columns back; digests of what was read and of the stored form, and levels (``FEATURES``).

    A table without ``sound`` gets it here, the same column as ``decode`` makes, a
    few megabytes at a time: sounds are four times the payload, and batches of
    ten thousand of them between two operators would fill an executor.
    """
    made = "sound" not in sounds.columns
    names = [x.split()[0] for x in FEATURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = lambda x: None if x is None else hashlib.sha256(x).hexdigest()
        for whole in batches:
            for batch in slices(whole, "media", 2 << 20):
                kept = pa.array([sound_of(x, UP) for x in batch.column("media").to_pylist()], pa.binary()) if made else batch.column("sound")
                stored = [x or b"" for x in batch.column("media").to_pylist()]
                payloads = [x and bytes(x[3]) for x in map(unwav, stored)]
                heard = [unwav(x) if x else None for x in kept.to_pylist()]
                both = [(np.frombuffer(p, np.uint8), expand(h[0], np.frombuffer(h[3], np.uint8), h[2])) for p, h in zip(payloads, heard) if p is not None and h]
                levels = iter(_levels([p for p, _ in both], [h for _, h in both]))
                columns = [
                    pa.array([None if p is None else len(p) for p in payloads], pa.int64()),
                    pa.array(map(digest, payloads), pa.string()),
                    pa.array([None if p is None else zlib.crc32(p[-32:]) for p in payloads], pa.int64()),
                    pa.array(map(len, stored), pa.int64()),
                    pa.array(map(digest, stored), pa.string()),
                    pa.array([next(levels) if p is not None and h else None for p, h in zip(payloads, heard)], pa.string()),
                    pa.array([h and h[1] for h in heard], pa.int32()),
                    pa.array([h and len(h[3]) // 2 for h in heard], pa.int64()),
                    pa.array([h and digest(h[3]) for h in heard], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *columns], names=names)

    rows = pick(sounds, doc_id="long", n_bytes="long", media="binary", **({} if made else {"sound": "binary"}))
    return rows.mapInArrow(run, FEATURES)
