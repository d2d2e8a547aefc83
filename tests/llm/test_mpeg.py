"""MPEG audio: round trips, resynchronisation, tables, checksums."""

import hashlib
import struct
import zlib

import numpy as np
import pytest

from tablebridge.llm import mpeg


def plain_crc(data):
    crc = 0xFFFF
    for byte in data:
        for k in range(7, -1, -1):
            bit = (crc >> 15 & 1) ^ (byte >> k & 1)
            crc = (crc << 1 & 0xFFFF) ^ (0x8005 if bit else 0)
    return crc


@pytest.mark.parametrize("n", [0, 1, 191, 192, 193, 5000])
def test_round_trip(n):
    data = bytes(np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8))
    stream = mpeg.encode(data)
    m = mpeg.parse(stream)
    assert m["payload"] == data + b" " * (max(1, -(-n // 192)) * 192 - n)
    assert m["tags"]["TXXX:payload_bytes"] == str(n) and m["table"]["frames"] == len(m["offsets"]) == max(1, -(-n // 192))
    assert m["crc_bad"] == 0 and m["crc_good"] == len(m["offsets"]) and m["skipped"] == 0 and m["samples"] == 1152 * len(m["offsets"])
    assert all(stream[o : o + 4] == mpeg.PROTECTED for o in m["offsets"]) and len(m["table"]["toc"]) == 100


def test_checksum_equals_bitwise_one():
    rows = np.random.default_rng(0).integers(0, 256, (5, 19), dtype=np.uint8)
    assert mpeg.crc16(rows).tolist() == [plain_crc(r.tolist()) for r in rows]


def test_resynchronises_over_junk_and_counts_bad_checksums():
    stream = mpeg.encode(b"x" * 192 * 6)
    offsets = mpeg.parse(stream)["offsets"]
    hurt = bytearray(stream)
    hurt[offsets[2] + 8] ^= 1
    cut = int(offsets[4])
    junk = b"\xff\xfa\x38\xc0junk\xff\xff\xe0" * 3
    m = mpeg.parse(bytes(hurt[:cut]) + junk + bytes(hurt[cut:]))
    assert len(m["offsets"]) >= 5 and m["crc_bad"] == 1 and m["skipped"] >= len(junk)


def test_variable_rates_layers_and_vbri():
    frames = []
    for k, rate in enumerate([3, 9, 14, 5] * 5):
        h = bytes([0xFF, 0xFB, rate << 4 | 1 << 2, 0xC0])
        size = mpeg.header(h)["size"]
        body = h + bytes([k + 1]) * (size - 4)
        frames.append(body)
    m = mpeg.parse(b"".join(frames))
    assert m["offsets"].tolist() == np.cumsum([0] + [len(f) for f in frames])[:-1].tolist() and m["samples"] == 1152 * 20 and m["hz"] == 48000
    first = bytearray(frames[0])
    first[36:62] = b"VBRI" + struct.pack(">HHHIIHHHH", 1, 0, 75, 1000, 20, 2, 1, 2, 10)
    first[62:66] = struct.pack(">HH", 300, 400)
    m = mpeg.parse(bytes(first) + b"".join(frames[1:]))
    assert m["table"] == {"kind": "VBRI", "bytes": 1000, "frames": 20, "toc": [300, 400], "frames_per_entry": 10} and len(m["offsets"]) == 19
    assert mpeg.header(b"\xff\xff\x90\x00")["layer"] == 1 and mpeg.header(b"\xff\xf3\x90\xc0")["samples"] == 576
    assert mpeg.header(b"\xff\xfb\xf0\x00") is None and mpeg.header(b"\xff\xfb\x9c\x00") is None


def test_stored_features(spark):
    texts = ["", None, "é" * 300, "one", "one", "x" * 3_000_000]
    df = spark.createDataFrame([(i if i else None, t, b"z") for i, t in enumerate(texts)], "doc_id long, text string, media binary")
    got = {x.doc_id or 0: x for x in mpeg.stored_features(df).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        padded = raw + b" " * (max(1, -(-len(raw) // 192)) * 192 - len(raw))
        assert got[i].n_bytes == len(raw) and got[i].payload_bytes == len(padded) and got[i].payload_sha256 == hashlib.sha256(padded).hexdigest()
        assert got[i].tail_crc32 == zlib.crc32(padded[-16:]) and got[i].frames == len(padded) // 192 == len(got[i].frame_offsets)
    assert got[3].media_sha256 == got[4].media_sha256
    assert mpeg.features(spark.createDataFrame([(1, None), (2, b"\xff" * 50), (3, b"ID3")], "doc_id long, media binary")).where("frames = 0 and payload_bytes = 0").count() == 3
    assert mpeg.stored_features(df.limit(0)).count() == 0


def test_frame_offsets_are_stored_beside_the_media(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b" * 1000), (3, None)], "doc_id long, text string")
    table = mpeg.stored_features(df)
    assert table.inputFiles() and all("frames" in x for x in table.inputFiles())
    streams = {x.doc_id: bytes(x.media) for x in mpeg.media(df).collect()}
    for x in spark.read.parquet(*table.inputFiles()).select("doc_id", "frame_offsets", "samples", "hz").collect():
        found = [mpeg.header(streams[x.doc_id][o : o + 4]) for o in x.frame_offsets]
        assert found and all(found) and x.samples == sum(h["samples"] for h in found) and x.hz == found[0]["hz"]
