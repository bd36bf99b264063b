"""Motion-JPEG in AVI: write and parse the container, code and decode intra frames, find shots.

Frames are 8-bit grey and coded by lossless JPEG (SOF3, predictor 1, one scan,
one Huffman table), so a payload laid into samples comes back bit for bit.  All
frames of a step are coded, and decoded, side by side in numpy: one symbol of
every frame at a time.

Shots: the distance of two frames' histograms is compared with a threshold that
follows the video, the mean of the preceding distances plus a multiple of their
deviation (and a floor).  ``clips`` gives one row per shot with its times.

Defined cases: a null or empty payload is one frame of padding; bytes 255 fill
the last frame; equal payloads give equal files and features; frames that are
not of this kind (other sizes than the first, colour, lossy) raise ValueError;
repeated rows and extra columns are fine, an empty table gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraledger.llm.common import steps

SIDE, FPS = 24, 24
SAMPLES = SIDE * SIDE
#: Our Huffman table: the lengths of codes 1 to 16, and the categories in the order of their codes.
LENGTHS = bytes([0, 2, 2, 3, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0])
CATEGORIES = bytes([5, 6, 4, 7, 0, 2, 3, 1, 8])
BINS, LOOK_BACK, DEVIATIONS, FLOOR = 16, 8, 2.0, 0.08
#: Characters of text worked on at once: the samples of a step are held several times over.
STEP = 1 << 20


def codes(lengths: bytes, categories: bytes) -> dict[int, tuple[int, int]]:
    """Category -> (code, length), as the JPEG standard derives codes from a table."""
    out, code, at = {}, 0, 0
    for bits, n in enumerate(lengths, 1):
        for _ in range(n):
            out[categories[at]] = (code, bits)
            code, at = code + 1, at + 1
        code <<= 1
    return out


def _coding_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each difference from -255 to 255, its bits and how many they are."""
    table = codes(LENGTHS, CATEGORIES)
    value, count = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        category = abs(d).bit_length()
        code, bits = table[category]
        value[d + 255] = code << category | (d if d >= 0 else d + (1 << category) - 1)
        count[d + 255] = bits + category
    return value, count


def _decoding_table(lengths: bytes, categories: bytes) -> np.ndarray:
    """For each 16 bits ahead, the difference (shifted by 8) and the bits taken."""
    out = np.zeros(1 << 16, np.int32)
    for category, (code, bits) in codes(lengths, categories).items():
        if bits + category > 16 or category > 15:
            raise ValueError("codes of over 16 bits with their differences are not supported")
        for extra in range(1 << category):
            d = extra if not category or extra >> (category - 1) else extra - (1 << category) + 1
            first = (code << category | extra) << (16 - bits - category)
            out[first : first + (1 << (16 - bits - category))] = d * 256 + bits + category
    return out


def _head() -> bytes:
    sof = struct.pack(">HBHHBBBB", 11, 8, SIDE, SIDE, 1, 1, 0x11, 0)
    dht = struct.pack(">HB", 19 + len(CATEGORIES), 0) + LENGTHS + CATEGORIES
    sos = struct.pack(">HBBBBBB", 8, 1, 1, 0, 1, 0, 0)
    return b"\xff\xd8\xff\xc3" + sof + b"\xff\xc4" + dht + b"\xff\xda" + sos


def encode_frames(frames: np.ndarray) -> list[bytes]:
    """Lossless JPEG files of grey frames ``(n, SIDE, SIDE)``."""
    n = len(frames)
    own = frames.astype(np.int16)
    diff = np.empty_like(own)
    diff[:, :, 1:] = own[:, :, 1:] - own[:, :, :-1]
    diff[:, 1:, 0] = own[:, 1:, 0] - own[:, :-1, 0]
    diff[:, 0, 0] = own[:, 0, 0] - 128
    values, counts = _coding_tables()
    at = diff.reshape(n, -1) + 255
    count = counts[at]
    total = count.sum(1)
    size = (total + 7) // 8
    ends = np.cumsum(size)
    start = np.cumsum(count, 1) - count + ((ends - size) * 8)[:, None]
    word = values[at] << (24 - count - (start & 7))
    byte = (start >> 3).ravel()
    word = word.ravel()
    packed = np.zeros(int(ends[-1]) + 2, np.int64)
    for k in range(3):
        packed += np.bincount(byte + k, word >> (16 - 8 * k) & 255, len(packed)).astype(np.int64)
    spare = size * 8 - total
    packed[ends - 1] |= (1 << spare) - 1
    packed = packed[:-2].astype(np.uint8)
    full = np.flatnonzero(packed == 255)
    stuffed = np.insert(packed, full + 1, 0).tobytes()
    cuts = [0, *(ends + np.searchsorted(full, ends)).tolist()]
    head = _head()
    return [head + stuffed[a:b] + b"\xff\xd9" for a, b in zip(cuts, cuts[1:], strict=False)]


def _parse(jpeg: bytes) -> tuple[tuple, int]:
    """What the frame's headers say (size, table), and where its scan begins."""
    if jpeg[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    at, size, table = 2, None, None
    while True:
        mark, n = jpeg[at + 1], int.from_bytes(jpeg[at + 2 : at + 4], "big")
        body = jpeg[at + 4 : at + 2 + n]
        at += 2 + n
        if mark == 0xC3:
            bits, height, width, parts = struct.unpack(">BHHB", body[:6])
            if bits != 8 or parts != 1:
                raise ValueError("only 8-bit grey frames are supported")
            size = height, width
        elif mark == 0xC4:
            table = body[1:17], body[17 : 17 + sum(body[1:17])]
        elif mark == 0xDA:
            if body[3] != 1 or size is None or table is None:
                raise ValueError("only lossless frames with predictor 1 are supported")
            return (size, table), at
        elif 0xC0 <= mark <= 0xCF:
            raise ValueError("only lossless frames are supported")


def decode_frames(jpegs: list[bytes]) -> np.ndarray:
    """The grey frames ``(n, height, width)`` of lossless JPEG files that share their headers."""
    kind, at = _parse(jpegs[0])
    head = jpegs[0][:at]
    if any(not j.startswith(head) for j in jpegs):
        for j in jpegs:
            if _parse(j)[0] != kind:
                raise ValueError("the frames differ in size or table")
    (height, width), (lengths, categories) = kind
    scans = [j[(at if j.startswith(head) else _parse(j)[1]) : -2].replace(b"\xff\x00", b"\xff") for j in jpegs]
    size = np.array([len(x) for x in scans], np.int64)
    b = np.frombuffer(b"".join(scans) + b"\0\0\0\0", np.uint8).astype(np.uint32)
    ahead = b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]
    table = _decoding_table(lengths, categories)
    at_bit = (np.cumsum(size) - size) * 8
    out = np.empty((height * width, len(jpegs)), np.int16)
    for k in range(height * width):
        window = ahead[at_bit >> 3] << (at_bit & 7).astype(np.uint32) >> np.uint32(16)
        got = table[window]
        out[k] = got >> 8
        at_bit += got & 255
    frames = out.T.reshape(len(jpegs), height, width)
    frames[:, 0, 0] += 128
    frames[:, :, 0] = np.cumsum(frames[:, :, 0], 1)
    return np.cumsum(frames, 2, dtype=np.int16).astype(np.uint8)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def write_avi(jpegs: list[bytes], width: int = SIDE, height: int = SIDE, fps: int = FPS) -> bytes:
    """One AVI file: headers, the frames as chunks ``00dc``, and the index ``idx1``."""
    n, largest = len(jpegs), max(map(len, jpegs), default=0)
    avih = struct.pack("<14I", 1_000_000 // fps, largest * fps, 0, 0x10, n, 0, 1, largest, width, height, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, fps, 0, n, largest, 0xFFFFFFFF, 0, 0, 0, width, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 8, b"MJPG", width * height, 0, 0, 0, 0)
    header = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    body, index, at = [b"movi"], [], 4
    for j in jpegs:
        body.append(_chunk(b"00dc", j))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(j)))
        at += len(body[-1])
    return _chunk(b"RIFF", b"AVI " + header + _chunk(b"LIST", b"".join(body)) + _chunk(b"idx1", b"".join(index)))


def read_avi(data: bytes) -> tuple[list[bytes], float]:
    """The frames that the index lists (without one, the chunks of ``movi``), and frames a second."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    movi, index, rate = 0, None, float(FPS)
    chunks: list[tuple[int, int]] = []

    def walk(at: int, end: int) -> None:
        nonlocal movi, index, rate
        while at + 8 <= end:
            name, n = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
            if name == b"LIST":
                if data[at + 8 : at + 12] == b"movi":
                    movi = at + 8
                walk(at + 12, at + 8 + n)
            elif name == b"idx1":
                index = at + 8, n
            elif name == b"strh" and data[at + 8 : at + 12] == b"vids":
                scale, per = struct.unpack("<II", data[at + 28 : at + 36])
                rate = per / max(1, scale)
            elif name[2:] in (b"dc", b"db") and movi:
                chunks.append((at + 8, n))
            at += 8 + n + (n & 1)

    walk(12, len(data))
    if index is not None:
        at, n = index
        entries = struct.iter_unpack("<4sIII", data[at : at + n // 16 * 16])
        chunks = [(movi + offset + 8, size) for name, _, offset, size in entries if name[2:] in (b"dc", b"db")]
    return [data[a : a + n] for a, n in chunks], rate


def shot_starts(frames: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a shot starts at each frame, and its histogram distance to the frame before; ``of`` tells the frames' videos, in order."""
    n = len(frames)
    flat = frames.reshape(n, -1)
    bins = np.bincount((np.arange(n)[:, None] * BINS + (flat // (256 // BINS))).ravel(), minlength=n * BINS).reshape(n, BINS)
    first = np.r_[True, of[1:] != of[:-1]] if n else np.zeros(0, bool)
    moved = np.zeros(n, np.int64)  # whole numbers: what other videos share the step changes nothing
    moved[1:] = np.abs(bins[1:] - bins[:-1]).sum(1)
    moved[first] = 0
    at = np.arange(n)
    place = at - np.maximum.accumulate(np.where(first, at, 0))
    seen = np.clip(place - 1, 0, LOOK_BACK)
    sums, squares = np.r_[0, np.cumsum(moved)], np.r_[0, np.cumsum(moved**2)]
    count = np.maximum(seen, 1)
    mean = (sums[at] - sums[at - seen]) / count
    spread = np.sqrt(np.maximum((squares[at] - squares[at - seen]) / count - mean**2, 0))
    whole = 2 * flat.shape[1] if n else 1
    limit = np.where(seen > 0, mean + np.maximum(DEVIATIONS * spread, FLOOR * whole), 2 * FLOOR * whole)
    return first | (moved > limit), moved / whole


def payload_frames(data: bytes) -> np.ndarray:
    size = max(1, -(-len(data) // SAMPLES)) * SAMPLES
    return np.frombuffer(data.ljust(size, b"\xff"), np.uint8).reshape(-1, SIDE, SIDE)


def store_texts(texts: list[str | None]) -> list[bytes]:
    """One AVI file for each text's UTF-8 bytes."""
    parts = [payload_frames((t or "").encode()) for t in texts]
    jpegs = encode_frames(np.concatenate(parts))
    ends = np.cumsum([len(p) for p in parts]).tolist()
    return [write_avi(jpegs[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


def stored(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_media: bool = True) -> DataFrame:
    """Texts as media columns: the file, what is read back from it, and its shots.

    Each row's payload is coded, laid into a file, and everything after that is
    computed from the file's bytes alone.  ``keep_media=False`` leaves the file out.
    """
    schema = "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames int, starts array<int>, seconds double" + (", media binary" if keep_media else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, limit=STEP):
            sizes = [len((t or "").encode()) for t in texts]
            media = store_texts(texts)
            read = [read_avi(m) for m in media]
            count = np.array([len(j) for j, _ in read])
            frames = decode_frames([x for j, _ in read for x in j])
            of = np.repeat(np.arange(len(read)), count)
            start, distance = shot_starts(frames, of)
            ends = np.cumsum(count).tolist()
            rows = []
            for k, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
                payload = frames[a:b].tobytes()
                at = np.flatnonzero(start[a:b]).tolist()
                feature = f"shots={len(at)};frames={b - a};cuts={','.join(map(str, at[1:]))};mean={frames[a:b].mean():.4f};moved={distance[a:b].sum():.4f}"
                rows.append((len(payload), sha256(payload).hexdigest(), crc32(payload[-32:]), len(media[k]), sha256(media[k]).hexdigest(), feature, b - a, at, (b - a) / read[k][1]))
            a = list(zip(*rows, strict=True))
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(a[0], pa.int64()), pa.array(a[1]), pa.array(a[2], pa.int64()), pa.array(a[3], pa.int64()), pa.array(a[4]), pa.array(a[5]), pa.array(a[6], pa.int32()), pa.array(a[7], pa.list_(pa.int32())), pa.array(a[8], pa.float64())]
            names = ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_frames", "starts", "seconds"]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(media, pa.binary())] * keep_media, names=names + ["media"] * keep_media)

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def clips(media: DataFrame) -> DataFrame:
    """One row per shot of ``stored`` rows: ``(id, clip, first_frame, n_frames, start_s, end_s)``."""
    cut = media.select("id", "n_frames", "starts", (F.col("n_frames") / F.col("seconds")).alias("fps"), F.posexplode("starts").alias("clip", "first_frame"))
    stop = F.coalesce(F.get("starts", F.col("clip") + 1), F.col("n_frames"))
    return cut.select("id", "clip", "first_frame", (stop - F.col("first_frame")).alias("n_frames"), (F.col("first_frame") / F.col("fps")).alias("start_s"), (stop / F.col("fps")).alias("end_s"))
