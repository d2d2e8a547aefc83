"""Media columns: MPEG audio streams that carry bytes, and a parser of such streams."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablebridge.llm.staging import rows_of, stage

#: kbit/s by (first version or later one, layer), then by index 1-14. Fixed values of the format.
KBPS = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
#: Hz by version bits (3: 1, 2: 2, 0: 2.5). Fixed values of the format.
HERTZ = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
#: Bytes that one frame of the writer carries, and the frame: version 1, layer III, 48 kbit/s, 32 kHz, mono, protected.
UNIT, FRAME, SIDE = 192, 216, 17
PROTECTED, PLAIN = b"\xff\xfa\x38\xc0", b"\xff\xfb\x38\xc0"


@lru_cache(1)
def crc_table() -> np.ndarray:
    """CRC-16 with polynomial 0x8005, as the format has it."""
    out = np.arange(256, dtype=np.uint32) << 8
    for _ in range(8):
        out = np.where(out & 0x8000, out << 1 ^ 0x8005, out << 1) & 0xFFFF
    return out


def crc16(rows: np.ndarray) -> np.ndarray:
    """The checksum of each row of bytes, all rows at once."""
    crc = np.full(len(rows), 0xFFFF, np.uint32)
    for k in range(rows.shape[1]):
        crc = (crc << 8 ^ crc_table()[(crc >> 8 ^ rows[:, k]) & 0xFF]) & 0xFFFF
    return crc


def header(four: bytes) -> dict | None:
    """The fields of a frame header, or None if it can't be one."""
    if len(four) < 4 or four[0] != 0xFF or four[1] & 0xE0 != 0xE0:
        return None
    version, layer = four[1] >> 3 & 3, 4 - (four[1] >> 1 & 3)
    rate, hertz, padding, mode = four[2] >> 4, four[2] >> 2 & 3, four[2] >> 1 & 1, four[3] >> 6
    if version == 1 or layer == 4 or rate in (0, 15) or hertz == 3:
        return None
    first = version == 3
    kbps, hz = KBPS[1 if first else 2, layer][rate - 1], HERTZ[version][hertz]
    samples = 384 if layer == 1 else 1152 if layer == 2 or first else 576
    size = (12 * kbps * 1000 // hz + padding) * 4 if layer == 1 else samples // 8 * kbps * 1000 // hz + padding
    side = (32 if mode != 3 else 17) if first else (17 if mode != 3 else 9)
    return {"version": version, "layer": layer, "kbps": kbps, "hz": hz, "samples": samples, "size": size, "side": side if layer == 3 else 0, "protected": not four[1] & 1}


def id3(kind: bytes, body: bytes) -> bytes:
    return kind + struct.pack(">IH", len(body), 0) + body


def encode(data: bytes) -> bytes:
    """A stream that carries the bytes, filled up with spaces to a positive multiple of 192.

    An ID3v2.3 tag with the true length, an information frame with frame count, byte count and table
    of contents, then silent frames whose ancillary bytes are the payload, and an ID3v1 tag. Players
    skip ancillary bytes; every frame has the checksum of its header and side information.
    """
    payload = data + b" " * (-len(data) % UNIT or (0 if data else UNIT))
    count = len(payload) // UNIT
    frames = np.zeros((count, FRAME), np.uint8)
    frames[:, :4] = np.frombuffer(PROTECTED, np.uint8)
    guarded = np.frombuffer(PROTECTED[2:] + bytes(SIDE), np.uint8)[None]
    crc = int(crc16(guarded)[0])
    frames[:, 4], frames[:, 5] = crc >> 8, crc & 0xFF
    frames[:, 6 + SIDE : 6 + SIDE + UNIT] = np.frombuffer(payload, np.uint8).reshape(count, UNIT)
    whole = FRAME * (count + 1)
    toc = bytes(min(255, (FRAME * (1 + count * i // 100)) * 256 // whole) for i in range(100))
    info = PLAIN + bytes(SIDE) + b"Info" + struct.pack(">III", 7, count, whole) + toc
    tags = id3(b"TXXX", b"\x00payload_bytes\x00" + str(len(data)).encode()) + id3(b"TSSE", b"\x00tablebridge")
    size = len(tags)
    synchsafe = bytes(size >> s & 0x7F for s in (21, 14, 7, 0))
    return b"ID3\x03\x00\x00" + synchsafe + tags + info.ljust(FRAME, b"\x00") + frames.tobytes() + b"TAG" + b"tablebridge".ljust(30, b"\x00") + bytes(94) + b"\xff"


def id3_tags(data: bytes) -> tuple[dict[str, str], int]:
    """Text frames of an ID3v2.3 or 2.4 tag at the start, and where the tag ends. A broken tag ends at its last whole frame."""
    if len(data) < 10 or data[:3] != b"ID3":
        return {}, 0
    size = sum((data[6 + i] & 0x7F) << 7 * (3 - i) for i in range(4))
    end, at, tags = min(len(data), 10 + size), 10, {}
    while at + 10 <= end and data[at : at + 4].strip(b"\x00"):
        raw = data[at + 4 : at + 8]
        n = sum((b & 0x7F) << 7 * (3 - i) for i, b in enumerate(raw)) if data[3] == 4 else int.from_bytes(raw, "big")
        body = data[at + 10 : at + 10 + n]
        if at + 10 + n > end or not n:
            break
        text = body[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1"), "replace")
        name = data[at : at + 4].decode("latin-1")
        key, _, value = text.partition("\x00")
        tags[f"TXXX:{key}" if name == "TXXX" else name] = value if name == "TXXX" else key
        at += 10 + n
    return tags, end


def vbr_table(frame: bytes, h: dict) -> dict | None:
    """Frame count, byte count and table of contents of a Xing, Info or VBRI header in the first frame."""
    at = 4 + 2 * h["protected"] + h["side"]
    if frame[at : at + 4] in (b"Xing", b"Info") and len(frame) >= at + 8:
        (flags,), where, out = struct.unpack_from(">I", frame, at + 4), at + 8, {"kind": frame[at : at + 4].decode()}
        for bit, name in ((1, "frames"), (2, "bytes")):
            if flags & bit and where + 4 <= len(frame):
                (out[name],) = struct.unpack_from(">I", frame, where)
                where += 4
        if flags & 4 and where + 100 <= len(frame):
            out["toc"] = list(frame[where : where + 100])
        return out
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        size, frames, entries, scale, width, each = struct.unpack_from(">IIHHHH", frame, 46)
        if width not in (1, 2, 4):
            return {"kind": "VBRI", "bytes": size, "frames": frames}
        toc = [int.from_bytes(frame[62 + i * width : 62 + (i + 1) * width], "big") * scale for i in range(entries) if 62 + (i + 1) * width <= len(frame)]
        return {"kind": "VBRI", "bytes": size, "frames": frames, "toc": toc, "frames_per_entry": each}
    return None


def parse(data: bytes) -> dict:
    """What a stream holds: tags, table, frame offsets, samples, hertz, checksums, ancillary payload, skipped bytes.

    A frame counts if its header is valid and another header of the same version, layer and rate (or
    the end of the audio) stands where it ends; else the search goes on one byte later. Frames with
    one header are checked together.
    """
    tags, at = id3_tags(data)
    end = len(data) - 128 if len(data) >= 128 + at and data[-128:-125] == b"TAG" else len(data)
    bytes_, offsets, samples, good, bad, skipped, payload, table, first = np.frombuffer(data, np.uint8), [], [], 0, 0, 0, [], None, None
    while at + 4 <= end:
        h = header(data[at : at + 4])
        after = at + h["size"] if h else 0
        n = header(data[after : after + 4]) if h and after + 4 <= end else None
        same = h and (after == end or n and all(n[k] == h[k] for k in ("version", "layer", "hz")))
        if not same or first and h["hz"] != first["hz"]:
            to = data.find(b"\xff", at + 1, end)
            to = end if to < 0 else to
            skipped, at = skipped + to - at, to
            continue
        size = h["size"]
        if first is None:
            first = h
            table = vbr_table(data[at : at + size], h)
            if table:
                at = after
                continue
        rows = bytes_[at : at + (end - at) // size * size].reshape(-1, size)
        run = (rows[:, :4] == rows[0, :4]).all(axis=1)
        count = len(run) if run.all() else int(run.argmin())
        if count > 1 and at + count * size != end and header(data[at + count * size : at + count * size + 4]) is None:
            count -= 1  # the last one has no follower: it is looked at by itself
        rows = rows[:count]
        offsets.append(at + size * np.arange(count, dtype=np.int64))
        samples.append(np.full(count, h["samples"], np.int64))
        start = 4
        if h["protected"] and h["layer"] == 3:
            found = crc16(np.concatenate([rows[:, 2:4], rows[:, 6 : 6 + h["side"]]], axis=1))
            ok = int((found == (rows[:, 4].astype(np.uint32) << 8 | rows[:, 5])).sum())
            good, bad, start = good + ok, bad + count - ok, 6
        elif h["protected"]:
            start = 6
        begin = start + h["side"]
        payload.append(rows[:, begin : begin + UNIT].tobytes())
        at += count * size
    skipped += end - at
    total = int(sum(int(s.sum()) for s in samples))
    return {
        "tags": tags, "table": table, "offsets": np.concatenate(offsets) if offsets else np.zeros(0, np.int64), "samples": total,
        "hz": first["hz"] if first else 0, "layer": first["layer"] if first else 0, "crc_good": good, "crc_bad": bad, "skipped": skipped, "payload": b"".join(payload),
    }


def media(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, media): the text's UTF-8 bytes as an MPEG audio stream; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches, chars=4_000_000):
            made = [encode((x or "").encode("utf-8", "surrogatepass")) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], ["doc_id", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, media binary")


FEATURES = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
    "frames long, samples long, hz int, crc_good long, crc_bad long, skipped_bytes long, vbr string, feature string, frame_offsets array<long>"
)


def features(streams: DataFrame) -> DataFrame:
    """(doc_id, media) -> what the stored streams hold: `FEATURES`; samples / hz is the exact duration in seconds.

    A null or broken stream has no frames and an empty payload. n_bytes is the length in the tag, else the payload's.
    """

    def one(doc: int | None, data: bytes | None) -> tuple:
        data = data or b""
        m = parse(data)
        p, n = m["payload"], m["tags"].get("TXXX:payload_bytes", "")
        kind = m["table"]["kind"] if m["table"] else "none"
        told = f"layer={m['layer']};frames={len(m['offsets'])};duration={m['samples']}/{m['hz']};crc={m['crc_good']}/{m['crc_good'] + m['crc_bad']};vbr={kind};skipped={m['skipped']}"
        sha = lambda x: hashlib.sha256(x).hexdigest()
        return (doc, int(n) if n.isdigit() else len(p), len(p), sha(p), zlib.crc32(p[-16:]), len(data), sha(data), len(m["offsets"]), m["samples"], m["hz"], m["crc_good"], m["crc_bad"], m["skipped"], kind, told, m["offsets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64())]
        names = [x.split()[0] for x in FEATURES.split(", ")]
        for b in rows_of(batches, chars=4_000_000):
            cols = list(zip(*map(one, b.column(0).to_pylist(), b.column(1).to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(cols, kinds, strict=True)], names)

    return streams.select("doc_id", "media").mapInArrow(run, FEATURES)


def stored_features(docs: DataFrame) -> DataFrame:
    """Store each text as a stream in a table, read it back, store what it holds beside it and return that table, one row per row.

    The second table has the exact duration (samples / hz) and `frame_offsets`, where each frame begins, to seek by.

    Equal texts give equal streams. Null doc_ids and repeated rows stay; other columns are not read;
    an empty table gives an empty one.
    """
    return stage(features(stage(media(docs), "media")), "frames")
