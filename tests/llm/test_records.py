"""WARC, mixing, token ids, BPE and audio."""

import base64
import hashlib
import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from matchloom.llm import audio, bpe, dac, mixing, warc
from matchloom.llm.common import Scratch
from matchloom.llm.queries import vocabulary
from pyspark.sql import functions as F

from .conftest import ODD

PAGES = "page_id long, url string, html string, digest string, payload string"


def test_warc_round_trip(spark):
    rows = [(1, "u1", "same"), (2, "u2", "same"), (3, None, "same"), (4, "u4", None), (5, "u5", ""), (None, "u6", "other"), (7, "u7", "é" * 5000), (8, "a", "twice"), (8, "a", "twice"), (9, "u9", "a\r\n\r\nWARC/1.1\r\nWARC-Type: x")]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)
    path = f"{Scratch(spark, 'test').root}/a"
    warc.write_archive(pages, path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({r[2] or "" for r in rows})
    got = sorted(map(tuple, warc.parse_records(warc.read_archive(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    want = []
    for i, (page, _, html) in enumerate(rows):
        body = (html or "").encode()
        peers = [j for j, r in enumerate(rows) if (r[2] or "") == (html or "")]
        first = max(peers, key=lambda j: (rows[j][0] is not None, rows[j][0] or 0, -j))
        want.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if i == first else "revisit", None if i == first else rows[first][0]))
    assert got == sorted(want, key=str)
    whole = warc.record_bytes(warc.read_archive(spark, path)).collect()
    assert len(whole) == len(rows) and all(bytes(r.record).startswith(b"WARC/1.1\r\n") and bytes(r.record).endswith(b"\r\n\r\n") for r in whole)


def test_warc_urls_forge_no_headers(spark):
    path, urls = f"{Scratch(spark, 'test').root}/f", ["http://a\nX-Page: 777", "b\r\nWARC-Type: x\r\n\r\n", "http://c/%20?q=a+b", "d\x00\x7f%0A", "é"]
    warc.write_archive(spark.createDataFrame([(i, u, "same", "", "") for i, u in enumerate(urls)], PAGES), path)
    got = {r.page_id: r for r in warc.parse_records(warc.read_archive(spark, path)).collect()}
    assert [got[i].url for i in range(len(urls))] == urls and {r.refers_to for r in got.values()} == {4, None}
    heads = [bytes(r.header) for r in warc.read_archive(spark, path).collect()]
    assert all(h.count(b"\r\n\r\n") == 1 and h.endswith(b"\r\n\r\n") and b"\n" not in h.replace(b"\r\n", b"") for h in heads)


def test_warc_small_payloads_and_no_pages(spark):
    path = f"{Scratch(spark, 'test').root}/b"
    warc.write_archive(spark.createDataFrame([(1, "u", "ab", "", ""), (2, "u", "ab", "", "")], PAGES), path, min_revisit_bytes=3)
    assert {r.record_type for r in warc.parse_records(warc.read_archive(spark, path)).collect()} == {"response"}
    path = f"{Scratch(spark, 'test').root}/c"
    warc.write_archive(spark.createDataFrame([], PAGES), path)
    assert warc.parse_records(warc.read_archive(spark, path)).count() == 0


def test_mix(spark, odd, none):
    docs = spark.createDataFrame([(i, "w " * (1 + i * 7 % 50), f"s{i % 5}" if i % 3 else "hot") for i in range(3000)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    assert len(rows) == 3000 and sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))
    total, by = sum(r.size for r in rows), {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 2 * r.size
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(by))}
    sizes, fixed = {s: sum(r.size for r in rs) for s, rs in by.items()}, {}
    while True:  # reshare by weight until none is above its limit
        free = {s: w for s, w in weights.items() if s not in fixed}
        level = (1.5 * total - sum(fixed.values())) / sum(free.values())
        over = {s for s, w in free.items() if level * w > 2 * sizes[s]}
        if not over:
            break
        fixed |= {s: 2.0 * sizes[s] for s in over}
    for s, rs in by.items():
        assert rs[0].target == pytest.approx(fixed.get(s, level * weights[s])) and rs[0].source_size == sizes[s]
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(r.size for r in rs) / 2
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(none).count() == 0
    assert all(r.taken == 0 for r in mixing.mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")).collect())


def _library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_library(spark, odd, none):
    t = _library()
    got = sorted(map(tuple, bpe.bpe_round_trip(odd.withColumn("ids_sha256", F.lit("clash")), vocabulary()).collect()), key=str)
    want = []
    for name, text, *_ in ODD:
        ids = t.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((name, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=str)
    assert bpe.bpe_round_trip(none, vocabulary()).count() == 0
    kept = bpe.bpe_round_trip(odd.where("doc_id = 6"), vocabulary(), keep=True).first()
    assert kept.ids == t.encode(ODD[7][1], add_special_tokens=False).ids


def test_bpe_random_strings():
    t, table = _library(), bpe._Words(bpe.WordBpe(vocabulary()), 30_000)
    rnd, letters = random.Random(3), [*"aAbHTJ'sSrRe  EÍ̱̊éÉ İΣσ1٣<|>가\n\t", "<|endoftext|>", "<|ENDOFTEXT|>", "'ll"]
    for _ in range(3000):
        s = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 14)))
        found = [table[w] for w in bpe.split_words(s.encode())]
        ids = [int(x) for x in b" ".join(x[0] for x in found if x[0]).split()]
        assert ids == t.encode(s, add_special_tokens=False).ids and table.bpe.decode(ids) == t.decode(ids, skip_special_tokens=False)


def test_bpe_splits_code_points_like_the_library():
    t, table = _library(), bpe.WordBpe(vocabulary())
    points = [c for c in [*range(0, 0x32000, 7), *range(0xA7C0, 0xA800), *range(0x10D40, 0x10D90), *range(0x16EA0, 0x16ED8)] if not 0xD800 <= c < 0xE000]
    texts = [f"{a}{chr(c)}{a}" for c in points for a in "a1!"]
    assert [x.ids for x in t.encode_batch(texts, add_special_tokens=False)] == [table.tokens(x) for x in texts]
    assert table.tokens("ab" * 20000) == t.encode("ab" * 20000, add_special_tokens=False).ids


def test_codes_random_access():
    rnd = np.random.default_rng(0)
    for n in (0, 1, 7, 8, 511, 512, 513, 3000):
        ids = (2 ** rnd.uniform(0, 32, n)).astype(np.uint32)
        reader = dac.Reader(dac.pack(ids))
        assert [reader.get(i) for i in range(n)] == ids.tolist()
        for _ in range(30):
            a = int(rnd.integers(0, n + 1))
            k = int(rnd.integers(0, n - a + 1))
            assert (reader.range(a, k) == ids[a : a + k]).all()
    with pytest.raises(IndexError):
        dac.Reader(dac.pack(np.zeros(3))).get(3)


def test_token_files(spark, odd, none):
    t, scratch = _library(), Scratch(spark, "test")
    for size in (50, 1 << 20):
        written = scratch.cut(dac.write_segments(odd, vocabulary(), segment_tokens=size), f"s{size}")
        got, at = sorted(map(tuple, dac.read_segments(written).collect()), key=lambda r: r[1]), 0
        for row, (name, text, *_) in zip(got, sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0)), strict=True):
            ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
            assert row == (name, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            at += len(ids)
    assert dac.read_segments(scratch.cut(dac.write_segments(none, vocabulary()), "none")).count() == 0


def test_audio(spark, odd, none):
    stored = audio.store_media(odd.withColumn("media", F.lit("clash")))
    rows = {(r.doc_id, r.payload_sha256): r for r in audio.media_features(stored).collect()}
    for name, text, *_ in ODD:
        raw = (text or "").encode()
        body = raw + bytes(max(1, -(-len(raw) // 64)) * 64 - len(raw))
        r = rows[name, hashlib.sha256(body).hexdigest()]
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(raw), len(body), zlib.crc32(body[-64:]))
        media = audio.wav_header(list(audio.CODECS.values())[zlib.crc32(body) % 3], len(body)) + body
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
        samples, rate = audio.to_pcm(media)
        wide = [int(v) for k, a in enumerate(samples.tolist()) for v in (a, (a + samples.tolist()[min(k + 1, len(samples) - 1)]) >> 1)] if len(samples) < 5000 else np.frombuffer(r.pcm, "<i2").tolist()
        raw = np.array(wide, "<i2").tobytes()
        name = {v: k for k, v in audio.CODECS.items()}[audio.read_wav(media)[0]]
        assert rate == 8000 and bytes(r.pcm) == raw and r.feature == f"{name}@16000:{len(wide)},{max(map(abs, wide))},{sum(map(abs, wide))},{zlib.crc32(raw):08x}"
    one = {r.doc_id: r.feature for r in audio.media_features(stored, most=1).collect()}
    assert one == {r.doc_id: r.feature for r in rows.values()}
    assert audio.media_features(audio.store_media(none)).count() == 0
    for codec in audio.CODECS:
        pcm = audio.decode_media(audio.store_media(odd, codec=codec)).collect()
        assert len(pcm) == len(ODD) and all(len(r.pcm) == 2 * r.n_samples for r in pcm)
    bad = audio.decode_media(spark.createDataFrame([(1, bytearray(b"junk")), (2, None)], "doc_id long, media binary")).collect()
    assert [r.pcm for r in bad] == [None, None]
    pcm = np.arange(-300, 300, dtype="<i2").tobytes()
    odd_media = [(1, 1, bytearray(b"junk")), (2, 1, None), (3, 1, bytearray(audio.wav_header(audio.PCM, len(pcm), 48000) + pcm)), (4, 1, bytearray(audio.wav_header(99, 4) + b"1234")), (5, 1, bytearray()), (6, 1, bytearray(audio.wav_header(audio.IMA_ADPCM, 64) + bytes(64)))]
    found = {r.doc_id: r for r in audio.media_features(spark.createDataFrame(odd_media, "doc_id long, n_bytes long, media binary")).collect()}
    assert [k for k, r in found.items() if r.pcm is None] == [1, 2, 4, 5] and found[2].media_bytes is None and found[1].media_bytes == 4
    assert np.frombuffer(found[3].pcm, "<i2").tolist() == list(range(-300, 300, 3)) and found[3].feature.startswith("pcm@16000:200,")
    assert found[6].feature.startswith("ima_adpcm@16000:242,0,0,")


def test_resample_against_fractions():
    from fractions import Fraction
    from math import floor

    rnd = np.random.default_rng(4)
    for rate in (8000, 11025, 16000, 22050, 44100):
        parts = [rnd.integers(-32768, 32768, n).astype(np.int16) for n in (0, 1, 5, 40)]
        got, at = audio.resample(np.concatenate(parts), np.cumsum([0, *map(len, parts)]), rate)
        for k, own in enumerate(parts):
            want = []
            for n in range(-(-len(own) * 16000 // rate)):
                place = Fraction(n * rate, 16000)
                a, b = int(own[floor(place)]), int(own[min(floor(place) + 1, len(own) - 1)])
                want.append(a + floor((b - a) * (place - floor(place))))
            assert got[at[k] : at[k + 1]].tolist() == want


def test_expansion_tables():
    assert audio.MULAW_TABLE[[0, 0x7F, 0x80, 0xFF]].tolist() == [-32124, 0, 32124, 0]
    assert audio.ALAW_TABLE[[0x55, 0xD5, 0x2A, 0xAA]].tolist() == [-8, 8, -32256, 32256]
    block, steps, follow = np.random.default_rng(1).integers(0, 256, 64, np.uint8), audio.IMA_STEPS.tolist(), audio.IMA_INDEX.tolist()
    block[2] = 40
    value, index = int(block[:2].view("<i2")[0]), 40
    want = [value]
    for code in [c for b in block[4:].tolist() for c in (b & 15, b >> 4)]:
        step = steps[index]
        size = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
        value = max(-32768, min(32767, value - size if code & 8 else value + size))
        index = max(0, min(88, index + follow[code & 7]))
        want.append(value)
    assert audio.decode_adpcm(block[None]).tolist() == [want]


def test_bpe_tables_take_little_memory_to_make():
    code = "import resource; from matchloom.llm import bpe, queries; before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; bpe.WordBpe(queries.vocabulary()); print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True).stdout
    assert int(out) < 120 << 10  # KB; 300 MB when all code points were split at once
