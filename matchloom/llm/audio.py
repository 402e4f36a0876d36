"""Media columns: telephony audio.

Eight-bit mu-law and A-law samples are expanded by lookup tables and IMA ADPCM blocks are decoded
with numpy, one step for all blocks at once. Decoded PCM is resampled to 16 kHz by integer
interpolation, so results don't depend on batches or machines.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ragged, slices, text_parts

PCM, ALAW, MULAW, IMA_ADPCM = 1, 6, 7, 17
RATE, TARGET_RATE, UNIT, PORTION = 8000, 16000, 64, 1 << 22
CODECS = {"alaw": ALAW, "mulaw": MULAW, "ima_adpcm": IMA_ADPCM}

# Fixed values of the IMA ADPCM standard.
IMA_STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494,
    544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487,
    12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
IMA_INDEX = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def _mulaw_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    size = (((code & 0x0F) << 3) + 0x84 << (code >> 4 & 7)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def _alaw_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int32) ^ 0x55
    low, segment = (code & 0x0F) << 4, code >> 4 & 7
    size = np.where(segment == 0, low + 8, low + 0x108 << np.maximum(segment - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


MULAW_TABLE, ALAW_TABLE = _mulaw_table(), _alaw_table()


def _ima_tables() -> tuple[np.ndarray, np.ndarray]:
    """Difference and next index for each (index, nibble)."""
    step, nibble = IMA_STEPS[:, None], np.arange(16, dtype=np.int32)[None, :]
    size = (step >> 3) + np.where(nibble & 4, step, 0) + np.where(nibble & 2, step >> 1, 0) + np.where(nibble & 1, step >> 2, 0)
    after = np.clip(np.arange(len(IMA_STEPS))[:, None] + IMA_INDEX[nibble & 7], 0, len(IMA_STEPS) - 1)
    return np.where(nibble & 8, -size, size).astype(np.int32).ravel(), (after * 16).astype(np.int32).ravel()


IMA_DIFF, IMA_AFTER = _ima_tables()


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """IMA ADPCM blocks (n, size) of bytes to samples (n, 1 + 2 * (size - 4)), stepping through all blocks together.

    A step index beyond the table's end counts as its last.
    """
    n, size = blocks.shape
    out = np.empty((1 + 2 * (size - 4), n), np.int16)
    value = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    state = np.minimum(blocks[:, 2], len(IMA_STEPS) - 1).astype(np.int32) * 16
    out[0] = value
    codes = np.ascontiguousarray(blocks[:, 4:].T)
    for k in range(size - 4):
        for half, nibble in enumerate((codes[k] & 15, codes[k] >> 4)):
            at = state + nibble
            value += IMA_DIFF.take(at)
            np.clip(value, -32768, 32767, out=value)
            state = IMA_AFTER.take(at)
            out[1 + 2 * k + half] = value
    return np.ascontiguousarray(out.T)


def resample(samples: np.ndarray, offsets: np.ndarray, rate: int = RATE, target: int = TARGET_RATE) -> tuple[np.ndarray, np.ndarray]:
    """Recordings, one after another, at another rate by linear interpolation in whole numbers: samples and offsets. A recording's last sample holds to its end."""
    sizes = np.diff(offsets)
    wanted = -(-sizes * target // rate)
    ends = np.concatenate(([0], np.cumsum(wanted)))
    if rate == target or not len(samples):
        return samples, offsets
    place = ragged(np.zeros(len(sizes), np.int64), wanted) * rate
    at, part = place // target + np.repeat(offsets[:-1], wanted), place % target
    after = np.minimum(at + 1, np.repeat(offsets[1:] - 1, wanted))
    low = samples[at].astype(np.int64)
    return (low + (samples[after] - low) * part // target).astype(np.int16), ends


def wav_header(codec: int, n_bytes: int, rate: int = RATE, unit: int = UNIT) -> bytes:
    """Header of a one-channel WAVE file whose data chunk has so many bytes."""
    if codec == IMA_ADPCM:
        per_block = 1 + 2 * (unit - 4)
        form = struct.pack("<HHIIHHHH", codec, 1, rate, rate * unit // per_block, unit, 4, 2, per_block)
    elif codec == PCM:
        form = struct.pack("<HHIIHH", codec, 1, rate, rate * 2, 2, 16)
    else:
        form = struct.pack("<HHIIHHH", codec, 1, rate, rate, 1, 8, 0)
    return b"RIFF" + struct.pack("<I", 4 + 8 + len(form) + 8 + n_bytes) + b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", n_bytes)


def read_wav(media: bytes) -> tuple[int, int, int, memoryview]:
    """Codec, rate, block size and data of a WAVE file; ValueError if it isn't one."""
    view, at, form, body = memoryview(media), 12, None, None
    if len(view) < 12 or view[:4] != b"RIFF" or view[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    while at + 8 <= len(view):
        size = struct.unpack_from("<I", view, at + 4)[0]
        if view[at : at + 4] == b"fmt ":
            form = struct.unpack_from("<HHIIH", view, at + 8)
        elif view[at : at + 4] == b"data":
            body = view[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    if form is None or body is None:
        raise ValueError("a WAVE file without a format or data")
    return form[0], form[2], form[4], body


def to_pcm(media: bytes) -> tuple[np.ndarray, int]:
    """Samples at their own rate of a WAVE file in a telephony codec, and that rate."""
    codec, rate, unit, body = read_wav(media)
    raw = np.frombuffer(body, np.uint8)
    if codec == IMA_ADPCM:
        return decode_adpcm(raw[: len(raw) // unit * unit].reshape(-1, unit)).reshape(-1), rate
    if codec == PCM:
        return raw[: len(raw) // 2 * 2].view("<i2"), rate
    return {MULAW: MULAW_TABLE, ALAW: ALAW_TABLE}[codec].take(raw), rate


def decode_media(df: DataFrame, media_col: str = "media", id_col: str = "doc_id") -> DataFrame:
    """Decoded and resampled recordings: id, codec, sample_rate, n_samples, pcm (16-bit little-endian at 16 kHz, from any rate).

    A null or unreadable recording keeps its row with null results. Other columns, whatever their
    names, are not carried.
    """
    schema = df.select(F.col(id_col).alias(id_col)).schema.add("codec", "integer").add("sample_rate", "integer").add("n_samples", "long").add("pcm", "binary")

    def run(batches):
        for batch in batches:
            media, at = text_parts(batch.column(1))
            for i, j in slices(at, 1 << 20):
                out = []
                for a, b in zip(at[i:j].tolist(), at[i + 1 : j + 1].tolist()):
                    found = decoded(media[a:b].tobytes())
                    out.append((found[0], TARGET_RATE, len(found[1]), found[1].tobytes()) if found else (None, None, None, None))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *(pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.binary())))], names=[f.name for f in schema])

    return df.select(F.col(id_col), F.col(media_col).cast("binary")).mapInArrow(lean(run), schema)


def decoded(media: bytes) -> tuple[int, np.ndarray] | None:
    """Codec and samples at 16 kHz of a WAVE file; None if it can't be read."""
    try:
        pcm, rate = to_pcm(media)
        return read_wav(media)[0], resample(pcm, np.array([0, len(pcm)]), rate)[0]
    except (ValueError, KeyError, ZeroDivisionError, struct.error):
        return None


def store_media(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", codec: str = "mixed") -> DataFrame:
    """Whole texts as recordings: id, n_bytes (UTF-8, unpadded), media (WAVE whose data is the text padded with zero bytes).

    The data chunk has a positive multiple of 64 bytes, mu-law or A-law samples or IMA ADPCM blocks, so a null or empty
    text gives 64 zero bytes. The codec "mixed" takes one of the three by the data's CRC-32. Equal texts give equal
    media; repeated rows stay. Other columns are not carried.
    """
    tags = [CODECS[codec]] if codec != "mixed" else list(CODECS.values())
    schema = df.select(F.col(id_col)).schema.add("n_bytes", "long").add("media", "binary")

    def run(batches):
        for batch in batches:
            body, at = text_parts(batch.column(1))
            for i, j in slices(at, PORTION):
                raw, base, media = body[at[i] : at[j]].tobytes(), int(at[i]), []
                for a, b in zip((at[i:j] - base).tolist(), (at[i + 1 : j + 1] - base).tolist()):
                    size = max(1, -(-(b - a) // UNIT)) * UNIT
                    data = raw[a:b] + bytes(size - (b - a))
                    media.append(wav_header(tags[zlib.crc32(data) % len(tags)], size) + data)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(at[i : j + 1])), pa.array(media, pa.binary())], names=[f.name for f in schema])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(lean(run), schema)


def media_features(df: DataFrame, id_col: str = "doc_id", most: int = 1 << 20) -> DataFrame:
    """What stored recordings hold, from their bytes alone, and their resampled PCM.

    Returns id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, pcm (16-bit
    little-endian at 16 kHz). The feature names the codec and has the number of samples at 16 kHz, the peak, the sum of absolute
    samples and a CRC-32 of the PCM. A recording that is no WAVE file in a known codec keeps its row: null payload, feature
    and pcm, and for a null one null media_bytes and media_sha256 too. Rows keep their number. Telephony recordings at 8 kHz
    are decoded in groups of about `most` bytes, a longer one alone; ADPCM blocks of a group are decoded together.
    """
    schema = df.select(F.col(id_col)).schema
    for name, kind in (("n_bytes", "long"), ("payload_bytes", "long"), ("payload_sha256", "string"), ("tail_crc32", "long"), ("media_bytes", "long"), ("media_sha256", "string"), ("feature", "string"), ("pcm", "binary")):
        schema = schema.add(name, kind)
    names = {v: k for k, v in CODECS.items()} | {PCM: "pcm"}

    def all_pcm(whole: list[memoryview], read: list) -> list[np.ndarray | None]:
        """Samples at 16 kHz of each recording; those of one codec are decoded together if they are as store_media writes them."""
        out: list[np.ndarray | None] = [None] * len(read)
        for codec in CODECS.values():
            own = [k for k, r in enumerate(read) if r and r[0] == codec and r[1] == RATE and len(r[3]) and len(r[3]) % UNIT == 0 and (codec != IMA_ADPCM or r[2] == UNIT)]
            if not own:
                continue
            data = np.concatenate([np.frombuffer(read[k][3], np.uint8) for k in own])
            sizes = np.array([len(read[k][3]) for k in own])
            if codec == IMA_ADPCM:
                blocks = decode_adpcm(data.reshape(-1, UNIT))
                samples, sizes = blocks.reshape(-1), sizes // UNIT * blocks.shape[1]
            else:
                samples = {MULAW: MULAW_TABLE, ALAW: ALAW_TABLE}[codec].take(data)
            samples, cuts = resample(samples, np.concatenate(([0], np.cumsum(sizes))))
            for k, a, b in zip(own, cuts[:-1].tolist(), cuts[1:].tolist()):
                out[k] = samples[a:b]
        for k, r in enumerate(read):
            if r and out[k] is None and (found := decoded(bytes(whole[k]))):
                out[k] = found[1]
        return out

    def told(media: memoryview | None, read, pcm: np.ndarray | None) -> tuple:
        if media is None:
            return (None,) * 7
        own = len(media), hashlib.sha256(media).hexdigest()
        if pcm is None:
            return (None, None, None, *own, None, None)
        body, size = read[3], np.abs(pcm.astype(np.int32))
        feature = f"{names[read[0]]}@{TARGET_RATE}:{len(pcm)},{int(size.max(initial=0))},{int(size.sum(dtype=np.int64))},{zlib.crc32(pcm):08x}"
        return len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-UNIT:]), *own, feature, pcm.tobytes()

    def wav(media: memoryview | None):
        try:
            return read_wav(media) if media is not None else None
        except (ValueError, struct.error):
            return None

    def run(batches):
        for batch in batches:
            media, at = text_parts(batch.column(2))
            nulls = batch.column(2).is_null().to_pylist()
            for i, j in slices(at, most):
                whole = [None if n else memoryview(media)[a:b] for n, a, b in zip(nulls[i:j], at[i:j].tolist(), at[i + 1 : j + 1].tolist())]
                read = [wav(x) for x in whole]
                rows = [told(*x) for x in zip(whole, read, all_pcm(whole, read))]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names=[f.name for f in schema])

    return df.select(F.col(id_col), F.col("n_bytes"), F.col("media")).mapInArrow(lean(run), schema)
