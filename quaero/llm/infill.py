"""Fill-in-the-middle samples, put together by a secondary sort of text pieces.

A text is cut into chunks of code-point-safe units (lines), each a piece of at most
``PIECE`` bytes where a unit allows no longer one. A document has two cuts between
units; prefix, middle and suffix change places with marks before them. Pieces are keyed
by row and output position, and ``repartition`` with ``sortWithinPartitions`` (the
DataFrame form of repartitionAndSortWithinPartitions) brings them to one task in output
order, which streams them into an incremental digest and never holds a document.

For the restoration the streamed output is read again: its marks tell the parts, the
parts give the original positions, and the task sorts its pieces once more (spilling
where they do not fit) and streams the texts back together. A document's pieces are in
one partition by then, so the text moves once.

Pieces travel compressed. A document goes through one task, piece by piece; documents
are spread by hash of a row number, so rows of one id do not meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 64 << 10
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
#: The place of a part in the original text.
PLACES = {"prefix": 0, "middle": 1, "suffix": 2}

_SCHEMA = "row long, id long, n long, form string, prefix_chars long, middle_chars long, seq long, piece binary"
_NAMES = ["row", "id", "n", "form", "prefix_chars", "middle_chars", "seq", "piece"]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def hash_groups(id_col: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the SHA-256 of ``seed:id`` as numbers; a null id counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    digest = F.sha2(name, 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _pack(data: bytes) -> bytes:
    """Size and content, compressed."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack(raw: pa.Buffer) -> bytes:
    size = int.from_bytes(raw[:8].to_pybytes(), "little")
    return pa.decompress(raw[8:], decompressed_size=size, codec="zstd", asbytes=True)


def bounds_of(data: np.ndarray) -> np.ndarray:
    """Where the lines of a text end: behind each newline, and at the end."""
    ends = np.flatnonzero(data == 10) + 1
    return ends if not len(data) or (len(ends) and ends[-1] == len(data)) else np.append(ends, len(data))


def chunks(data: np.ndarray, begin: int, end: int, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole units between two bounds, of at most ``PIECE`` bytes; a longer unit is cut as it comes."""
    while begin < end:
        stop = begin + PIECE
        if stop >= end:
            stop = end
        else:
            k = int(np.searchsorted(ends, stop, side="right")) - 1
            if k >= 0 and ends[k] > begin:
                stop = int(ends[k])
        yield begin, stop
        begin = stop


def arrange(text: bytes, h: tuple[int, int, int, int], plain_percent: int, spm_percent: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, pieces in output order) of one text."""
    data = np.frombuffer(text, dtype=np.uint8)
    ends = bounds_of(data)
    n = len(ends)
    if not n or h[2] % 100 >= 100 - plain_percent or any(m in text for m in MARKS.values()):
        return n, "plain", None, None, [text[a:b] for a, b in chunks(data, 0, len(data), ends)] or [b""]
    first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (first, last))
    spans = {"prefix": (0, a), "middle": (a, b), "suffix": (b, len(data))}
    chars = [int(np.count_nonzero((data[x:y] & 0xC0) != 0x80)) for x, y in (spans["prefix"], spans["middle"])]
    form = "spm" if h[3] % 100 < spm_percent else "psm"
    pieces = []
    for part in ORDERS[form]:
        pieces.append(MARKS[part])
        pieces += [text[x:y] for x, y in chunks(data, *spans[part], ends)]
    return n, form, *chars, pieces


def emit_pieces(rows: DataFrame, plain_percent: int, spm_percent: int) -> DataFrame:
    """The pieces, in output positions ``seq``, of rows(row, id, h, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, size = [], 0
            for k in range(batch.num_rows):
                row, name, h = (batch.column(c)[k].as_py() for c in ("row", "id", "h"))
                text = batch.column("text")[k].as_buffer().to_pybytes()
                n, form, prefix, middle, pieces = arrange(text, h, plain_percent, spm_percent)
                # a mark travels with the piece behind it
                joined, mark = [], b""
                for piece in pieces:
                    if piece in MARKS.values() and form != "plain":
                        joined += [mark] if mark else []
                        mark = piece
                    else:
                        joined.append(mark + piece)
                        mark = b""
                joined += [mark] if mark else []
                for seq, piece in enumerate(joined):
                    made.append((row, name, n, form, prefix, middle, seq, _pack(piece)))
                    size += len(piece)
                if size > PIECE * 64:
                    yield _batch(made)
                    made, size = [], 0
            if made:
                yield _batch(made)

    return rows.mapInArrow(run, _SCHEMA)


def _batch(made: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(*made), _TYPES)], names=_NAMES)


class Parts:
    """Reads an output as it streams by and says which part each byte of text belongs to.

    Between marks the text holds none, and a mark can begin only at its own first
    character, so a mark found is a mark set. A tail that may begin one is held back.
    """

    def __init__(self, form: str) -> None:
        self.form, self.part, self.held = form, None, b""

    def feed(self, data: bytes, last: bool) -> list[tuple[str, bytes]]:
        if self.form == "plain":
            return [("prefix", data)]
        data, found = self.held + data, []
        while True:
            at, part = min(((data.find(m), p) for p, m in MARKS.items() if m in data), default=(-1, ""))
            if at < 0:
                break
            found.append((self.part, data[:at]))
            self.part, data = part, data[at + 3 :]
        keep = 0 if last else next((k for k in (2, 1) if any(m[:k] == data[-k:] for m in MARKS.values())), 0)
        self.held = data[len(data) - keep :]
        found.append((self.part, data[: len(data) - keep]))
        return [x for x in found if x[1]]


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """(row's columns, its pieces) of batches in the order of row and seq; pieces are read as they are asked for."""
    rows = ((b, k) for b in batches for k in range(b.num_rows))
    ahead = next(rows, None)

    while ahead is not None:
        batch, k = ahead
        head = {c: batch.column(c)[k].as_py() for c in _NAMES[:-2]}

        def pieces(name: int = head["row"]) -> Iterator[bytes]:
            nonlocal ahead
            while ahead is not None and ahead[0].column("row")[ahead[1]].as_py() == name:
                yield _unpack(ahead[0].column("piece")[ahead[1]].as_buffer())
                ahead = next(rows, None)

        yield head, pieces()


def assemble(pieces: DataFrame) -> DataFrame:
    """The outputs streamed in order: their digest (seq -1), and their text cut by parts in original positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size = [], 0
        for head, stream in _streamed(batches):
            fixed = tuple(head[c] for c in _NAMES[:-2])
            digest, parts, seq, ahead = hashlib.sha256(), Parts(head["form"]), 0, next(stream, None)
            while ahead is not None:
                piece, ahead = ahead, next(stream, None)
                digest.update(piece)
                for part, text in parts.feed(piece, ahead is None):
                    made.append((*fixed, (PLACES[part] << 48) | seq, _pack(text)))
                    seq, size = seq + 1, size + len(text)
                if size > PIECE * 64:
                    yield _batch(made)
                    made, size = [], 0
            made.append((*fixed, -1, digest.digest()))
        if made:
            yield _batch(made)

    return pieces.repartition("row").sortWithinPartitions("row", "seq").mapInArrow(run, _SCHEMA)


def restore(assembled: DataFrame) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of each row.

    ``assembled`` is partitioned by row already.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = []
        names = [*_NAMES[1:-2], "output_sha256", "restored_sha256"]
        types = [*_TYPES[1:-2], pa.string(), pa.string()]

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(*made), types)], names=names)

        for head, digest, stream in _with_digest(batches):
            text = hashlib.sha256()
            for piece in stream:
                text.update(piece)
            made.append((*(head[c] for c in _NAMES[1:-2]), digest.hex(), text.hexdigest()))
            if len(made) >= 4096:
                yield rows()
                made.clear()
        if made:
            yield rows()

    schema = "id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return assembled.sortWithinPartitions("row", "seq").mapInArrow(run, schema)


def _with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes, Iterator[bytes]]]:
    """As ``_streamed``; the first entry of a row is its digest."""
    rows = ((b, k) for b in batches for k in range(b.num_rows))
    ahead = next(rows, None)
    while ahead is not None:
        batch, k = ahead
        head = {c: batch.column(c)[k].as_py() for c in _NAMES[:-2]}
        digest = batch.column("piece")[k].as_py()
        ahead = next(rows, None)

        def pieces(name: int = head["row"]) -> Iterator[bytes]:
            nonlocal ahead
            while ahead is not None and ahead[0].column("row")[ahead[1]].as_py() == name:
                yield _unpack(ahead[0].column("piece")[ahead[1]].as_buffer())
                ahead = next(rows, None)

        yield head, digest, pieces()


def outputs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, plain_percent: int = 0, spm_percent: int = 50
) -> DataFrame:
    """The pieces of every output, to be read in the order of (row, seq): row, id, n, form, ..., piece.

    See :func:`fill_in_middle`; :func:`piece_text` decodes a piece.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        F.array(*hash_groups(F.col(id_col).cast("long"), seed)).alias("h"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return emit_pieces(rows, plain_percent, spm_percent)


def piece_text(raw: bytes) -> bytes:
    return _unpack(pa.py_buffer(raw))


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, plain_percent: int = 0, spm_percent: int = 50
) -> DataFrame:
    """One row per document: id, n (lines), form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    Two numbers from the hash of ``seed`` and id choose the cuts. A text that is empty or
    null, holds a mark, or falls in ``plain_percent`` stays plain: its output is itself and
    the two lengths are null. Others are ``spm`` in ``spm_percent`` of 100 cases, else
    ``psm``. The restored digest is that of the text read back from the output. Repeated
    rows repeat in the result; a null id hashes as an empty one. Other columns are ignored,
    an empty table gives no rows.
    """
    pieces = outputs(docs, id_col, text_col, seed, plain_percent, spm_percent)
    return restore(assemble(pieces)).withColumnRenamed("id", id_col)
