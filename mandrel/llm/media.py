"""Media columns: Netpbm and BMP images decoded to numpy arrays, stored as NPY tiles, with difference hashes.

An image column of bytes becomes a struct column's worth of fields: its format, its size, a difference hash of the whole
and its tiles, each a complete NPY file of at most TILE by TILE samples with a hash of its own. Tiles hold the decoded samples as
they are, in row order, so `read_back` gives them again exactly.

A difference hash resizes to nine by eight cells by area: the integral image (sums of all samples above and to the left) is
read at the edges of the cells, between samples by linear interpolation, which is exact in integers; a cell's
sum is four of its values. The integral image is kept for those rows alone and is summed up band by band, so an image
of any height takes the memory of a band. A bit says whether a cell is lighter on its right.

Formats: Netpbm P1 to P7, of 8 or 16 bits a sample; BMP of 1, 4, 8, 16, 24 and 32 bits, by palette or bit fields, of either
row order, plain or run-length encoded with 8 bits. Samples are lighter where greater, those of bitmaps too. One
channel is gray, two have alpha, three are red, green and blue, four these and alpha.

Defined results: null or broken media, and formats that aren't listed, have a null format and no tiles; of an image that ends
early nothing is guessed, it is broken; images without a row or column are broken; equal media have equal results;
repeated rows are read each on its own; very large images are read whole; an empty table gives no rows; other columns pass
through where they are named, whatever they are called.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandrel.llm.common import OWN, fields, named, sliced

TILE = 256
#: Cells of a difference hash, and rows that are summed up at a time.
ACROSS, DOWN, BAND = 9, 8, 2048
#: Parts by which red, green and blue make up gray.
GRAY = (299, 587, 114)

_FIELD = rb"(?:[ \t\r\n\v\f]|#[^\r\n]*[\r\n])*([0-9]+)"


class Broken(ValueError):
    """Bytes that are no image of a known format."""


def _netpbm_header(data: bytes, fields: int) -> tuple[list[int], int]:
    """The numbers of a header and where its one white space ends."""
    m = re.compile(rb"P[1-6]" + _FIELD * fields + rb"(?:#[^\r\n]*)?[ \t\r\n\v\f]").match(data)
    if not m:
        raise Broken("header")
    return [int(x) for x in m.groups()], m.end()


def _pam_header(data: bytes) -> tuple[list[int], int]:
    end = data.find(b"ENDHDR\n")
    lines = dict(x.split(None, 1) for x in data[3:end].split(b"\n") if len(x.split(None, 1)) == 2 and not x.startswith(b"#"))
    try:
        found = [int(lines[k]) for k in (b"WIDTH", b"HEIGHT", b"DEPTH", b"MAXVAL")]
    except (KeyError, ValueError):
        raise Broken("header") from None
    if end < 0:
        raise Broken("header")
    return found, end + len(b"ENDHDR\n")


def _samples(data: bytes, at: int, shape: tuple[int, int, int], depth: int) -> np.ndarray:
    if not 0 < depth < 65536:
        raise Broken("depth")
    kind = np.dtype(">u2" if depth > 255 else "u1")
    n = int(np.prod(shape, dtype=object))
    if len(data) - at < n * kind.itemsize:
        raise Broken("ends early")
    return np.frombuffer(data, kind, n, at).reshape(shape).astype(kind.newbyteorder("="), copy=False)


def _netpbm(data: bytes) -> np.ndarray:
    kind = data[1] - ord("0")
    if kind == 7:
        (width, height, channels, depth), at = _pam_header(data)
    else:
        fields, at = _netpbm_header(data, 2 if kind in (1, 4) else 3)
        (width, height), depth, channels = fields[:2], fields[2] if len(fields) > 2 else 1, 3 if kind in (3, 6) else 1
    shape = (height, width, channels)
    if min(shape) < 1 or channels > 4 or height * width * channels > 8 * len(data):
        raise Broken("size")
    if kind >= 5:
        return _samples(data, at, shape, depth)
    if kind == 4:  # rows of bits, 1 is black
        row = -(-width // 8)
        bits = np.unpackbits(_samples(data, at, (height, row, 1), 255).reshape(height, row), axis=1)[:, :width]
        return (1 - bits).reshape(shape)
    rest = re.sub(rb"#[^\r\n]*", b"", data[at:])
    if kind == 1:  # digits may stand side by side
        digits = np.frombuffer(bytes(rest.translate(None, b" \t\r\n\v\f")), np.uint8)[: height * width]
        if len(digits) < height * width or not np.isin(digits, (48, 49)).all():
            raise Broken("digits")
        return (49 - digits).reshape(shape)
    try:
        values = np.array(rest.split()[: height * width * channels], dtype=np.int64)
    except ValueError:
        raise Broken("digits") from None
    if len(values) < height * width * channels or not 0 < depth < 65536 or (values > depth).any():
        raise Broken("ends early")
    return values.astype(np.uint16 if depth > 255 else np.uint8).reshape(shape)


def _run_lengths(data: bytes, width: int, height: int) -> np.ndarray:
    """Pixels of run-length encoding with 8 bits: pairs of count and value; 0 begins an escape."""
    out = np.zeros((height, width), dtype=np.uint8)
    at = x = y = 0
    while at + 1 < len(data) and y < height:
        n, v = data[at], data[at + 1]
        at += 2
        if n:
            out[y, x : x + n] = v
            x += n
        elif v == 0:
            x, y = 0, y + 1
        elif v == 1:
            return out
        elif v == 2:
            if at + 1 >= len(data):
                break
            x, y, at = x + data[at], y + data[at + 1], at + 2
        else:
            plain = np.frombuffer(data[at : at + v], np.uint8)
            out[y, x : x + v] = plain[: max(width - x, 0)]
            x, at = x + v, at + v + v % 2
    raise Broken("ends early") if y < height else Broken("no end")


def _field(values: np.ndarray, mask: int) -> np.ndarray:
    """A bit field as 8 bits a sample."""
    if not mask:
        return np.zeros(values.shape, dtype=np.uint8)
    low = (mask & -mask).bit_length() - 1
    top = mask >> low
    return (((values & np.uint32(mask)) >> np.uint32(low)).astype(np.uint64) * np.uint64(255) // np.uint64(top)).astype(np.uint8)


def _bmp(data: bytes) -> np.ndarray:
    try:
        at, size = struct.unpack_from("<I", data, 10)[0], struct.unpack_from("<I", data, 14)[0]
        if size == 12:
            (width, height), bits, packing, colours = struct.unpack_from("<HH", data, 18), struct.unpack_from("<H", data, 24)[0], 0, 0
        else:
            width, height, _, bits, packing = struct.unpack_from("<iiHHI", data, 18)
            colours = struct.unpack_from("<I", data, 46)[0]
        masks = struct.unpack_from("<4I" if size >= 56 else "<3I", data, 54) if packing in (3, 6) else {16: (0x7C00, 0x3E0, 0x1F), 32: (0xFF0000, 0xFF00, 0xFF)}.get(bits, ())
    except struct.error:
        raise Broken("header") from None
    upside, height = height > 0, abs(height)
    if width < 1 or height < 1 or bits not in (1, 4, 8, 16, 24, 32) or packing not in (0, 1, 3, 6) or (packing == 1 and bits != 8):
        raise Broken("form")
    if packing == 1:
        if height * width > 256 * len(data):
            raise Broken("size")
        pixels = _run_lengths(data[at:], width, height)
    else:
        row = -(-width * bits // 32) * 4
        if len(data) - at < row * height:
            raise Broken("ends early")
        rows = np.frombuffer(data, np.uint8, row * height, at).reshape(height, row)
        if bits == 24:
            pixels = rows[:, : 3 * width].reshape(height, width, 3)[:, :, ::-1]
        elif bits > 8:
            values = np.ascontiguousarray(rows[:, : width * bits // 8]).view("<u2" if bits == 16 else "<u4").astype(np.uint32)
            pixels = np.stack([_field(values, m) for m in (masks if len(masks) == 4 and masks[3] else masks[:3])], axis=2)
        elif bits == 8:
            pixels = rows[:, :width]
        else:
            each = 8 // bits
            parts = [(rows >> np.uint8(8 - bits * (k + 1))) & np.uint8((1 << bits) - 1) for k in range(each)]
            pixels = np.stack(parts, axis=2).reshape(height, -1)[:, :width]
    if pixels.ndim == 2:
        entry, first = (3, 26) if size == 12 else (4, 14 + size)
        n = colours or 1 << bits
        table = np.frombuffer(data[first : first + entry * n], np.uint8)
        table = table[: len(table) // entry * entry].reshape(-1, entry)[:, 2::-1]
        if pixels.max() >= len(table):
            raise Broken("palette")
        gray = bool((table == table[:, :1]).all())
        pixels = table[:, :1][pixels] if gray else table[pixels]
    return np.ascontiguousarray(pixels[::-1] if upside else pixels)


def decode(data: bytes) -> tuple[str, np.ndarray]:
    """The format and the samples, rows by columns by channels; Broken if it is no image."""
    if len(data) > 2 and data[:1] == b"P" and data[1:2] in b"1234567":
        return f"P{data[1:2].decode()}", _netpbm(data)
    if data[:2] == b"BM":
        return "BMP", _bmp(data)
    raise Broken("format")


def _edges(size: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the edges of equal cells lie: the sample before, and the part of it, in 1/cells."""
    at = np.arange(cells + 1, dtype=np.int64) * size
    return at // cells, at % cells


def cell_sums(image: np.ndarray, down: int = DOWN, across: int = ACROSS) -> np.ndarray:
    """Sums of a gray image over down by across cells of equal area, exact, times down * across."""
    height, width = image.shape[:2]
    y, part_y = _edges(height, down)
    x, part_x = _edges(width, across)
    wanted = np.unique(np.concatenate([y, np.minimum(y + 1, height)]))
    rows = np.zeros((len(wanted), width), dtype=np.int64)  # of the integral image, not yet summed from the left
    above = np.zeros(width, dtype=np.int64)
    for at in range(0, height, BAND):
        band = image[at : at + BAND]
        inside = np.flatnonzero((wanted > at) & (wanted <= at + len(band)))
        begin = 0
        for k in inside:
            end = int(wanted[k]) - at
            above = above + gray(band[begin:end]).sum(axis=0)
            rows[k], begin = above, end
        above = above + gray(band[begin:]).sum(axis=0)
    table = np.concatenate([np.zeros((len(wanted), 1), dtype=np.int64), rows.cumsum(axis=1)], axis=1)
    low, high = np.searchsorted(wanted, y), np.searchsorted(wanted, np.minimum(y + 1, height))
    lines = table[low] * (down - part_y)[:, None] + table[high] * part_y[:, None]
    right = np.minimum(x + 1, width)
    corners = lines[:, x] * (across - part_x) + lines[:, right] * part_x
    return np.diff(np.diff(corners, axis=0), axis=1)


def gray(image: np.ndarray) -> np.ndarray:
    """One channel as it is, three weighed by GRAY; alpha is left out."""
    if image.shape[2] < 3:
        return image[:, :, 0].astype(np.int64)
    return image[:, :, :3].astype(np.int64) @ np.array(GRAY, dtype=np.int64)


def area_resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """The mean of every channel over each cell of a new size."""
    sums = np.stack([cell_sums(image[:, :, k : k + 1], height, width) for k in range(image.shape[2])], axis=2)
    return sums / (image.shape[0] * image.shape[1])


def difference_hash(image: np.ndarray) -> str:
    """64 bits in hex: whether a cell is darker than its right neighbour, row by row."""
    cells = cell_sums(image)
    return np.packbits(cells[:, :-1] < cells[:, 1:]).tobytes().hex()


def tiles(image: np.ndarray, size: int = TILE) -> list[dict]:
    """NPY tiles of an image, row by row, with their hashes."""
    out = []
    for row in range(0, image.shape[0], size):
        for col in range(0, image.shape[1], size):
            part = np.ascontiguousarray(image[row : row + size, col : col + size])
            file = io.BytesIO()
            np.lib.format.write_array(file, part, version=(1, 0), allow_pickle=False)
            out.append({"row": row, "col": col, "hash": difference_hash(part), "npy": file.getvalue()})
    return out


def bands(found: Sequence[dict]) -> Iterator[np.ndarray]:
    """The rows of an image from its stored tiles, one row of tiles at a time."""
    at: list[np.ndarray] = []
    for k, tile in enumerate(found):
        at.append(np.lib.format.read_array(io.BytesIO(tile["npy"]), allow_pickle=False))
        if k + 1 == len(found) or found[k + 1]["row"] != tile["row"]:
            yield np.concatenate(at, axis=1)
            at = []


_TILE_TYPE = fields(row="integer", col="integer", hash="string", npy="binary")
STORED = fields(format="string", height="integer", width="integer", channels="integer", hash="string").add("tiles", T.ArrayType(_TILE_TYPE))
_ARROW_TILE = pa.struct([("row", pa.int32()), ("col", pa.int32()), ("hash", pa.string()), ("npy", pa.binary())])
_ARROW = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(_ARROW_TILE)]


def _stored_row(data: bytes | None) -> tuple:
    try:
        kind, image = decode(data or b"")
    except Broken:
        return None, None, None, None, None, []
    return kind, *image.shape, difference_hash(image), tiles(image)


def _mapped(df: DataFrame, keep: Sequence[str], column: str, row: Callable, schema: T.StructType, types: list, most: int = 8 << 20) -> DataFrame:
    """keep and the fields that row gives for a column, some bytes at a time."""
    # Names of the caller's are put back afterwards: mapInArrow takes no dots.
    inside = [f"{OWN}{k}" for k in range(len(keep) + 1)]
    names = [*inside[:-1], *schema.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, len(keep), most):
                rows = [row(x) for x in part.column(len(keep)).to_pylist()]
                made = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *made], names=names)

    given = df.select(*[named(c).alias(x) for c, x in zip((*keep, column), inside, strict=True)])
    return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], *schema.fields])).toDF(*keep, *schema.names)


def stored(media: DataFrame, keep: Sequence[str], column: str = "media") -> DataFrame:
    """keep, format, height, width, channels, hash and tiles (row, col, hash, npy) of a column of image bytes. No shuffle."""
    return _mapped(media, keep, column, _stored_row, STORED, _ARROW)


READ = fields(payload_bytes="long", payload_sha256="string", tail_crc32="long", media_bytes="long", media_sha256="string")


def _read_row(found: list[dict] | None) -> tuple:
    samples, files, tail = hashlib.sha256(), hashlib.sha256(), b""
    n = size = 0
    for tile in found or ():
        files.update(tile["npy"])
        size += len(tile["npy"])
    for rows in bands(found or ()):
        data = rows.tobytes()
        samples.update(data)
        n, tail = n + len(data), (tail + data[-64:])[-64:]
    return n, samples.hexdigest(), zlib.crc32(tail), size, files.hexdigest()


def read_back(found: DataFrame, keep: Sequence[str]) -> DataFrame:
    """keep, and size and digests of the samples as read from the tiles, of their last 64 bytes, and of the tiles' files one after another."""
    return _mapped(found, keep, "tiles", _read_row, READ, [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()])


def each_tile(found: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row for each tile: keep, row, col, hash, npy; a table of files to be written."""
    quoted = [named(c) for c in keep]
    return found.select(*quoted, F.explode("tiles").alias("t")).select(*quoted, "t.*")


def as_graymap(payload: Column, width: int = 64) -> Column:
    """Bytes, a multiple of width, as a raw Netpbm graymap of that width."""
    head = F.concat(F.lit(f"P5\n{width} "), (F.octet_length(payload) / width).cast("long").cast("string"), F.lit("\n255\n"))
    return F.concat(head.cast("binary"), payload)


def padded(text: Column, block: int = 64) -> Column:
    """UTF-8 of a text, null as empty, with bytes 0 up to a positive multiple of block."""
    raw = F.coalesce(text, F.lit("")).cast("binary")
    n = F.octet_length(raw)
    size = F.greatest(F.ceil(n / F.lit(block)) * block, F.lit(block)).cast("int")
    return F.rpad(raw, size, F.lit(b"\x00"))
