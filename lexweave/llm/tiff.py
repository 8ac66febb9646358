"""Operator 7: TIFF media columns: directories walked, strips and tiles decoded, one row a page.

Reads classic and big TIFF of either byte order, 8, 16 and 32-bit unsigned samples,
chunky or planar, in strips or tiles, stored plainly or by PackBits, LZW or deflate,
with or without horizontal differencing.  Writes pages of 8-bit samples by the same
schemes; `store` chooses each page's by its content.

Defined results: a null or empty column value has no pages.  A value that isn't a
well-formed TIFF of these kinds gives one row with `error` set and no samples; pages
before a damaged one are kept.  Directories that point back end the walk.  For
`store`, a null text is the empty text, and its payload is one unit of padding.
Rows are handled one by one, so equal rows give equal results, and an empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm.common import append_columns

PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
# Bytes of each field type, and its struct code.
FIELD_TYPES = {1: (1, "B"), 3: (2, "H"), 4: (4, "I"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 13: (4, "I"), 16: (8, "Q"), 17: (8, "q"), 18: (8, "Q")}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_AT, SAMPLES, STRIP_ROWS, STRIP_BYTES = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_BYTES, FORMAT = 284, 317, 322, 323, 324, 325, 339
MOST_SAMPLES = 1 << 31


class Malformed(ValueError):
    """The bytes are no TIFF that this module reads."""


@dataclass
class Page:
    number: int
    pixels: np.ndarray  # (height, width, samples)
    compression: int
    predictor: int
    tiled: bool


def unpack_bits(data: bytes, size: int) -> bytes:
    out, at, n = bytearray(), 0, len(data)
    while at < n and len(out) < size:
        head = data[at]
        if head < 128:
            out += data[at + 1 : at + 2 + head]
            at += head + 2
        elif head > 128:
            out += data[at + 1 : at + 2] * (257 - head)
            at += 2
        else:
            at += 1
    return bytes(out[:size])


def pack_bits(data: bytes) -> bytes:
    """Runs of three or more equal bytes as repeats, the rest as literals."""
    values = np.frombuffer(data, np.uint8)
    if not len(values):
        return b""
    edge = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    sizes = np.diff(np.append(edge, len(values)))
    out, literal = bytearray(), 0
    long = np.flatnonzero(sizes >= 3)

    def plain(a: int, b: int) -> None:
        for at in range(a, b, 128):
            part = data[at : min(b, at + 128)]
            out.append(len(part) - 1)
            out.extend(part)

    for i in long.tolist():
        at, left = int(edge[i]), int(sizes[i])
        plain(literal, at)
        literal = at + left
        while left:
            n = min(left, 128)
            if n == 1:
                out.extend((0, data[at]))
            else:
                out.extend((257 - n, data[at]))
            left -= n
    plain(literal, len(data))
    return bytes(out)


def lzw_decode(data: bytes, size: int) -> bytes:
    """Most significant bit first; codes widen one code early."""
    out, table = [], [bytes([i]) for i in range(256)] + [b"", b""]
    got, width, held, bits, last = 0, 9, 0, 0, None
    for byte in data:
        held = (held << 8) | byte
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            del table[258:]
            width, last = 9, None
            continue
        if last is None:
            if code > 255:
                raise Malformed("LZW starts with no byte")
            entry = table[code]
        elif code < len(table):
            entry = table[code]
            table.append(last + entry[:1])
        elif code == len(table):
            entry = last + last[:1]
            table.append(entry)
        else:
            raise Malformed("LZW code out of range")
        out.append(entry)
        got += len(entry)
        last = entry
        n = len(table)
        width = 9 if n < 511 else 10 if n < 1023 else 11 if n < 2047 else 12
        if got >= size:
            break
    return b"".join(out)[:size]


def lzw_encode(data: bytes) -> bytes:
    out, held, bits = bytearray(), 0, 0
    table: dict[bytes, int] = {}
    following, width = 258, 9

    def put(code: int) -> None:
        nonlocal held, bits
        held = (held << width) | code
        bits += width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits)
            held &= (1 << bits) - 1

    put(256)
    have = b""
    code_of = lambda s: s[0] if len(s) == 1 else table[s]
    for i in range(len(data)):
        more = have + data[i : i + 1]
        if len(more) == 1 or more in table:
            have = more
            continue
        put(code_of(have))
        table[more] = following
        following += 1
        if following == 4094:
            put(256)
            table, following, width = {}, 258, 9
        else:
            width = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12
        have = data[i : i + 1]
    if have:
        put(code_of(have))
        following += 1
        width = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12
    put(257)
    if bits:
        out.append((held << (8 - bits)) & 255)
    return bytes(out)


def decoded(data: bytes, compression: int, size: int) -> bytes:
    if compression == PLAIN:
        return data[:size]
    if compression == PACKBITS:
        return unpack_bits(data, size)
    if compression == LZW:
        return lzw_decode(data, size)
    if compression in (DEFLATE, OLD_DEFLATE):
        try:
            return zlib.decompressobj().decompress(data, size)
        except zlib.error as error:
            raise Malformed(str(error)) from None
    raise Malformed(f"compression {compression}")


def coded(data: bytes, compression: int) -> bytes:
    return {PLAIN: bytes, PACKBITS: pack_bits, LZW: lzw_encode, DEFLATE: lambda d: zlib.compress(d, 6)}[compression](data)


class Reader:
    """One file's header and directories."""

    def __init__(self, data: bytes):
        self.data = data
        order = {b"II": "<", b"MM": ">"}.get(data[:2])
        if order is None or len(data) < 8:
            raise Malformed("no TIFF header")
        self.order = order
        magic = self.one("H", 2)
        if magic == 42:
            self.big, self.first = False, self.one("I", 4)
        elif magic == 43:
            self.big, self.first = True, self.one("Q", 8)
        else:
            raise Malformed("no TIFF magic number")

    def one(self, code: str, at: int) -> int:
        try:
            return struct.unpack_from(self.order + code, self.data, at)[0]
        except struct.error:
            raise Malformed("a value lies outside the file") from None

    def directories(self) -> Iterator[dict[int, tuple]]:
        at, seen = self.first, set()
        while at and at not in seen:
            seen.add(at)
            n = self.one("Q" if self.big else "H", at)
            at += 8 if self.big else 2
            step, count, inline = (20, "Q", 8) if self.big else (12, "I", 4)
            tags: dict[int, tuple] = {}
            if n * step > len(self.data):
                raise Malformed("a directory lies outside the file")
            for i in range(n):
                entry = at + i * step
                tag, kind = self.one("H", entry), self.one("H", entry + 2)
                size, code = FIELD_TYPES.get(kind, (0, ""))
                many = self.one(count, entry + 4)
                if not size:
                    continue
                place = entry + step - inline
                if many * size > inline:
                    place = self.one(count, place)
                if place + many * size > len(self.data):
                    raise Malformed("a field lies outside the file")
                tags[tag] = struct.unpack_from(f"{self.order}{many}{code}", self.data, place)
            yield tags
            at = self.one(count, at + n * step)

    def page(self, number: int, tags: dict[int, tuple]) -> Page:
        one = lambda tag, default=None: tags[tag][0] if tags.get(tag) else default
        width, height, samples = one(WIDTH), one(HEIGHT), one(SAMPLES, 1)
        if not width or not height or not samples or width * height * samples > MOST_SAMPLES:
            raise Malformed("no usable size")
        bits = set(tags.get(BITS, (1,)))
        if len(bits) != 1 or next(iter(bits)) not in (8, 16, 32) or set(tags.get(FORMAT, (1,))) != {1}:
            raise Malformed("only 8, 16 and 32-bit unsigned samples are read")
        depth = next(iter(bits)) // 8
        compression, predictor = one(COMPRESSION, 1), one(PREDICTOR, 1)
        if predictor not in (1, 2):
            raise Malformed(f"predictor {predictor}")
        apart = one(PLANAR, 1) == 2 and samples > 1
        within, planes = (1, samples) if apart else (samples, 1)
        tiled = TILE_AT in tags
        if tiled:
            wide, tall = one(TILE_WIDTH), one(TILE_HEIGHT)
            places, sizes = tags[TILE_AT], tags.get(TILE_BYTES, ())
        else:
            wide, tall = width, min(one(STRIP_ROWS, height), height)
            places, sizes = tags.get(STRIP_AT, ()), tags.get(STRIP_BYTES, ())
        if not wide or not tall:
            raise Malformed("no usable strip or tile size")
        across, down = -(-width // wide), -(-height // tall)
        if len(places) < across * down * planes or len(sizes) < across * down * planes:
            raise Malformed("strips or tiles are missing")
        dtype = np.dtype(f"{self.order}u{depth}")
        out = np.zeros((planes, height, width, within), dtype.newbyteorder("="))
        for i in range(across * down * planes):
            plane, cell = divmod(i, across * down)
            y, x = cell // across * tall, cell % across * wide
            rows = tall if tiled else min(tall, height - y)
            need = rows * wide * within * depth
            if places[i] + sizes[i] > len(self.data):
                raise Malformed("a strip or tile lies outside the file")
            raw = decoded(self.data[places[i] : places[i] + sizes[i]], compression, need)
            if len(raw) < need:
                raise Malformed("a strip or tile is short")
            block = np.frombuffer(raw, dtype).reshape(rows, wide, within).astype(out.dtype)
            if predictor == 2:
                block = np.cumsum(block, axis=1, dtype=out.dtype)
            out[plane, y : y + rows, x : x + wide] = block[: height - y, : width - x]
        pixels = np.moveaxis(out[..., 0], 0, 2) if apart else out[0]
        return Page(number, pixels, compression, predictor, tiled)


def read_pages(data: bytes | None) -> Iterator[Page | Malformed]:
    """The pages in order; a damaged one ends them with the error."""
    if not data:
        return
    try:
        reader = Reader(data)
        for number, tags in enumerate(reader.directories()):
            yield reader.page(number, tags)
    except Malformed as error:
        yield error


@dataclass(frozen=True)
class Scheme:
    """How a page is stored: codec, differencing (2) or none (1), square tiles of a size or strips."""

    compression: int
    predictor: int = 1
    tile: int | None = None


def write_pages(
    pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, rows: int = 64, tile: int | None = None, order: str = "<", big: bool = False, schemes: list[Scheme] | None = None
) -> bytes:
    """A TIFF of pages of 8-bit samples, (height, width) or (height, width, samples), in strips of `rows` or square tiles; `schemes`: of each page."""
    wide, pointer, count = ("Q", 16, 8) if big else ("I", 4, 4)
    out = bytearray((b"II" if order == "<" else b"MM") + (struct.pack(order + "HHHQ", 43, 8, 0, 0) if big else struct.pack(order + "HI", 42, 0)))
    link = 8 if big else 4
    for number, pixels in enumerate(pages):
        if schemes:
            compression, predictor, tile = schemes[number].compression, schemes[number].predictor, schemes[number].tile
        pixels = pixels.reshape(*pixels.shape[:2], -1)
        height, width, samples = pixels.shape
        cut_w, cut_h = (tile, tile) if tile else (width, min(rows, height))
        places, sizes = [], []
        for y in range(0, height, cut_h):
            for x in range(0, width, cut_w):
                block = pixels[y : y + cut_h, x : x + cut_w]
                if tile:
                    block = np.pad(block, ((0, tile - block.shape[0]), (0, tile - block.shape[1]), (0, 0)))
                if predictor == 2:
                    block = np.diff(block, axis=1, prepend=np.zeros_like(block[:, :1]))
                body = coded(np.ascontiguousarray(block).tobytes(), compression)
                places.append(len(out)), sizes.append(len(body))
                out += body + b"\0" * (len(body) % 2)
        fields = {WIDTH: [width], HEIGHT: [height], BITS: [8] * samples, COMPRESSION: [compression], PHOTOMETRIC: [2 if samples == 3 else 1], SAMPLES: [samples], PREDICTOR: [predictor]}
        fields |= {TILE_WIDTH: [tile], TILE_HEIGHT: [tile], TILE_AT: places, TILE_BYTES: sizes} if tile else {STRIP_AT: places, STRIP_ROWS: [cut_h], STRIP_BYTES: sizes}
        entries = b""
        for tag, values in sorted(fields.items()):
            kind = pointer if tag in (STRIP_AT, STRIP_BYTES, TILE_AT, TILE_BYTES) else 3 if max(values) < 65536 else 4
            body = struct.pack(f"{order}{len(values)}{FIELD_TYPES[kind][1]}", *values)
            if len(body) > count:
                out += b"\0" * (-len(out) % 8)
                place = struct.pack(order + wide, len(out))
                out += body
                body = place
            entries += struct.pack(order + "HH" + wide, tag, kind, len(values)) + body.ljust(count, b"\0")
        out += b"\0" * (-len(out) % 8)
        out[link : link + count] = struct.pack(order + wide, len(out))
        out += struct.pack(order + ("Q" if big else "H"), len(fields)) + entries
        link = len(out)
        out += b"\0" * count
    return bytes(out)


#: A payload is padded to a positive multiple of this; one row of samples.
UNIT = 576
#: Rows of a stored page at most.
PAGE_ROWS = 512
#: Pages up to this height are stored by LZW.
SHORT_ROWS = 2
#: Pages from this height on are stored in square tiles of this size.
TALL_ROWS, TILE = 256, 64
#: Bytes of samples in a batch of page rows; a larger page is a batch of its own.
PIXEL_BYTES = 4 << 20


def payload_of(text: str | None) -> bytes:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + b"\xff" * (-len(data) % UNIT if data else UNIT)


def entropy_of(samples: np.ndarray) -> float:
    share = np.bincount(samples.ravel(), minlength=256) / max(1, samples.size)
    real = share[share > 0]
    return -float(real @ np.log2(real))


def scheme_of(samples: np.ndarray) -> Scheme:
    """By content: differencing where it leaves less entropy; then PackBits for runs, LZW for short pages, deflate for others, tall ones in tiles."""
    steps = np.diff(samples, axis=1, prepend=np.zeros_like(samples[:, :1]))
    predictor = 2 if entropy_of(steps) < entropy_of(samples) else 1
    stored = steps if predictor == 2 else samples
    if (stored[:, 1:] == stored[:, :-1]).mean() >= 0.5:
        return Scheme(PACKBITS, predictor)
    if len(samples) <= SHORT_ROWS:
        return Scheme(LZW, predictor)
    return Scheme(DEFLATE, predictor, TILE if len(samples) >= TALL_ROWS else None)


def media_of(payload: bytes) -> bytes:
    samples = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    pages = [samples[at : at + PAGE_ROWS] for at in range(0, len(samples), PAGE_ROWS)]
    return write_pages(pages, schemes=[scheme_of(p) for p in pages])


class Features:
    """Pages, height, mean, deviation, share of steps between neighbours over 32, and entropy in bits of all samples, page by page."""

    def __init__(self):
        self.counts, self.steps, self.pages, self.height = np.zeros(256, np.int64), 0, 0, 0

    def add(self, pixels: np.ndarray) -> None:
        self.counts += np.bincount(pixels.ravel(), minlength=256)
        self.steps += int((np.abs(np.diff(pixels.astype(np.int16), axis=1)) > 32).sum())
        self.pages += 1
        self.height += pixels.shape[0]

    def text(self) -> str:
        n = int(self.counts.sum())
        if not n:
            return "pages=0"
        share = self.counts / n
        mean = float(share @ np.arange(256))
        spread = float(np.sqrt(max(0.0, share @ np.arange(256) ** 2 - mean * mean)))
        real = share[share > 0]
        return f"pages={self.pages};height={self.height};mean={mean:.4f};deviation={spread:.4f};edges={self.steps / n:.4f};entropy={-float(real @ np.log2(real)):.4f}"


def feature_of(pages: list[Page]) -> str:
    found = Features()
    for page in pages:
        found.add(page.pixels)
    return found.text()


def store(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds n_bytes (long: of the text's UTF-8) and media (binary: the padded bytes as a TIFF)."""

    def run(texts: pa.Array) -> list[pa.Array]:
        sizes, media = [], []
        for t in texts.to_pylist():
            sizes.append(len((t or "").encode("utf-8", "surrogatepass")))
            media.append(media_of(payload_of(t)))
        return [pa.array(sizes, pa.int64()), pa.array(media, pa.binary())]

    keep = [c for c in (keep if keep is not None else df.columns) if c not in ("n_bytes", "media")]
    return append_columns(df, run, text, keep, [("n_bytes", T.LongType(), pa.int64()), ("media", T.BinaryType(), pa.binary())])


PAGE_FIELDS = [("page", "int"), ("width", "int"), ("height", "int"), ("samples", "int"), ("bits", "int"), ("compression", "int"), ("predictor", "int"), ("tiled", "boolean"), ("pixels", "binary"), ("error", "string")]
PIXELS = [n for n, _ in PAGE_FIELDS].index("pixels")
_ARROW = {"int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}


def _page_row(page: Page | Malformed, number: int) -> tuple:
    if isinstance(page, Malformed):
        return (number, None, None, None, None, None, None, None, None, str(page))
    height, width, samples = page.pixels.shape
    return (page.number, width, height, samples, 8 * page.pixels.dtype.itemsize, page.compression, page.predictor, page.tiled, page.pixels.astype(page.pixels.dtype.newbyteorder("<")).tobytes(), None)


def pages(df: DataFrame, media: str = "media", keep: list[str] | None = None) -> DataFrame:
    """One row a page of a binary column: kept columns, then page, width, height, samples, bits, compression, predictor, tiled, pixels (rows, then columns, then samples, little-endian), error."""
    names = [n for n, _ in PAGE_FIELDS]
    keep = [c for c in (keep if keep is not None else df.columns) if c not in names and c != media]
    slim = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{media}`").alias("__media"))
    schema = T.StructType([slim.schema[c] for c in keep] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in PAGE_FIELDS])

    def made(batch: pa.RecordBatch, owners: list[int], rows: list[tuple]) -> pa.RecordBatch:
        kept = [batch.column(c).take(pa.array(owners, pa.int64())) for c in range(len(keep))]
        return pa.RecordBatch.from_arrays(kept + [pa.array(v, _ARROW[t]) for v, (_, t) in zip(zip(*rows), PAGE_FIELDS)], names=keep + names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, rows, size = [], [], 0
            for i, data in enumerate(batch.column(len(keep))):
                for number, page in enumerate(read_pages(data.as_py())):
                    owners.append(i), rows.append(_page_row(page, number))
                    size += len(rows[-1][PIXELS] or b"")
                    if size > PIXEL_BYTES:
                        yield made(batch, owners, rows)
                        owners, rows, size = [], [], 0
            if rows:
                yield made(batch, owners, rows)

    return slim.mapInArrow(run, schema)


DIGESTS = [("payload_bytes", "long"), ("payload_sha256", "string"), ("tail_crc32", "long"), ("feature", "string"), ("schemes", "string")]


def digests(found: DataFrame, keep: list[str]) -> DataFrame:
    """One row a value from the rows of `pages`, which must come straight from it: kept columns, then payload_bytes, payload_sha256, tail_crc32, feature, schemes.

    A value's page rows stand one after another in one partition, so they are added up
    as they pass, without a shuffle and without the whole payload being held.  schemes
    has each page's codec number, "d" for differencing and "t" for tiles, runs of equal ones once.
    A page with an error is raised.
    """
    slim = found.select(*[F.col(f"`{c}`") for c in keep], "page", "width", "height", "compression", "predictor", "tiled", "pixels", "error")
    schema = T.StructType([slim.schema[c] for c in keep] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in DIGESTS])
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row, first = None, None
        for batch in batches:
            done, kept = [], []
            facts = [batch.column(at + i).to_pylist() for i in (0, 1, 2, 3, 4, 5, 7)]
            for i, (page, width, height, compression, predictor, tiled, error) in enumerate(zip(*facts)):
                if error is not None:
                    raise Malformed(error)
                if page == 0:
                    if open_row is not None:
                        done.append(open_row.row()), kept.append(first)
                    open_row, first = _Digest(), batch.slice(i, 1).select(range(at))
                open_row.add(batch.column(at + 6)[i].as_py(), height, width, f"{compression}{'d' if predictor == 2 else ''}{'t' if tiled else ''}")
            if first is not None:
                first = pa.RecordBatch.from_pylist(first.to_pylist(), schema=first.schema)  # holds no longer on to the batch
            if done:
                yield made(kept, done)
        if open_row is not None:
            yield made([first], [open_row.row()])

    def made(kept: list[pa.RecordBatch], done: list[tuple]) -> pa.RecordBatch:
        own = pa.Table.from_batches(kept).combine_chunks().to_batches()[0].columns if keep else []
        types = {"long": pa.int64(), "string": pa.string()}
        return pa.RecordBatch.from_arrays([*own, *(pa.array(v, types[t]) for v, (_, t) in zip(zip(*done), DIGESTS))], names=keep + [n for n, _ in DIGESTS])

    return slim.mapInArrow(run, schema)


class _Digest:
    """What the pages of one value add up to."""

    def __init__(self):
        self.size, self.hash, self.tail, self.features, self.schemes = 0, hashlib.sha256(), b"", Features(), []

    def add(self, pixels: bytes, height: int, width: int, scheme: str) -> None:
        self.size += len(pixels)
        self.hash.update(pixels)
        self.tail = (self.tail + pixels[-32:])[-32:]
        self.features.add(np.frombuffer(pixels, np.uint8).reshape(height, width, -1))
        if self.schemes[-1:] != [scheme]:
            self.schemes.append(scheme)

    def row(self) -> tuple:
        return (self.size, self.hash.hexdigest(), zlib.crc32(self.tail), self.features.text(), ",".join(self.schemes))


def payloads(df: DataFrame, media: str = "media", keep: list[str] | None = None) -> DataFrame:
    """Adds payload (binary: all pages' samples in order, read back from the media) and feature (string)."""

    def run(column: pa.Array) -> list[pa.Array]:
        data, features = [], []
        for value in column.to_pylist():
            found = list(read_pages(value))
            if found and isinstance(found[-1], Malformed):
                raise found[-1]
            data.append(b"".join(p.pixels.tobytes() for p in found))
            features.append(feature_of(found))
        return [pa.array(data, pa.binary()), pa.array(features, pa.string())]

    keep = [c for c in (keep if keep is not None else df.columns) if c not in ("payload", "feature")]
    return append_columns(df, run, media, keep, [("payload", T.BinaryType(), pa.binary()), ("feature", T.StringType(), pa.string())])

