"""Word and shingle arithmetic on Arrow batches, vectorised with numpy.

A batch's texts are one byte buffer with offsets.  Words are runs of bytes other
than space and ``\\x09-\\x0D``; these are ASCII, so byte spans in UTF-8 are word
spans.  Work goes in chunks of about a megabyte, whole documents each, so memory
depends on the longest document only.
"""

import numpy as np
import pyarrow as pa

from uttersieve.functions.memory import hand_back

CHUNK_BYTES = 1 << 20
_U = np.uint64
_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD6E8FEB86659FD93 | 1
_blank = np.zeros(256, dtype=bool)
_blank[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_tables: dict = {}
_kept: dict = {}


def kept(name: str) -> dict:
    """What an operator's tasks leave in a worker for its next tasks, see :func:`lean`."""
    return _kept.setdefault(name, {})


def lean(run, keeps: str = ""):
    """``run`` for ``mapInArrow``, handing its memory back when the task ends.

    A Python worker outlives its task and waits for another one.  What allocators then
    still hold, a few hundred megabytes, is missing in every later stage on the machine.
    What is :func:`kept` stays until a task comes that does not name it in ``keeps``.
    """

    def task(batches):
        # a task is sent by value: only functions of the module see the module's tables
        _leave_only(keeps)
        try:
            yield from run(batches)
        finally:
            _leave_only(keeps)
            hand_back()

    return task


def _leave_only(keeps: str):
    _tables.clear()
    for name, held in _kept.items():
        if name != keeps:
            held.clear()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(n: int):
    """Powers of the byte base and of its inverse modulo 2**64, at least ``n`` of each."""
    have = _tables.get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        out = []
        for base in (_BYTE_BASE, pow(_BYTE_BASE, -1, 1 << 64)):
            p = np.full(size, base, dtype=_U)
            p[0] = 1
            out.append(np.cumprod(p, dtype=_U))
        have = tuple(out)
        if size <= 8 * CHUNK_BYTES:
            _tables["powers"] = have
    return have


def column_bytes(array: pa.Array):
    """``(bytes, offsets)`` of a string or binary Arrow array; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    n = len(array)
    buffers = array.buffers()
    if n == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[array.offset : array.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def chunks(array: pa.Array, limit: int = CHUNK_BYTES):
    """Cut a column into runs of whole documents: ``(first, last, bytes, offsets)``."""
    data, offsets = column_bytes(array)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


class Words:
    """The words of a run of documents.

    ``starts``/``ends`` are byte spans, ``first`` has for each document the index
    of its first word (one entry more than documents).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        self.data, self.offsets = data, offsets
        n = len(data)
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = ~_blank[data]
        opens = inside[1:-1] & ~inside[:-2]
        shuts = inside[1:-1] & ~inside[2:]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < n)]
        opens[edge] = inside[1:-1][edge]
        shuts[edge - 1] = inside[1:-1][edge - 1]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(shuts) + 1
        self.first = np.searchsorted(self.starts, offsets, side="left")
        self.first[-1] = len(self.starts)

    def _sums(self):
        """Running sums of the bytes times powers, and the inverse powers."""
        n = len(self.data)
        up, down = _powers(n + 1)
        total = np.zeros(n + 1, dtype=_U)
        np.cumsum((self.data.astype(_U) + _U(1)) * up[:n], out=total[1:])
        return total, down

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word."""
        total, down = self._sums()
        return mix((total[self.ends] - total[self.starts]) * down[self.starts])

    def beginnings(self, lengths) -> list:
        """For each length ``(words, hashes)``: words longer than it in bytes, and a hash
        of their first bytes."""
        total, down = self._sums()
        out = []
        for k in lengths:
            at = np.flatnonzero(self.ends - self.starts > k)
            begin = self.starts[at]
            out.append((at, mix((total[begin + k] - total[begin]) * down[begin] + _U(k))))
        return out

    def shingles(self, hashes: np.ndarray, k: int, keep_short: bool = True):
        """``(values, first)``: a hash for each run of ``k`` words of one document, in
        order; with ``keep_short`` a document of fewer words has one for all of them."""
        n = len(hashes)
        count = np.diff(self.first)
        per = np.maximum(count - k + 1, 0)
        long_enough = window_hashes(hashes, k)
        first = np.zeros(len(per) + 1, np.int64)
        np.cumsum(per, out=first[1:])
        at = np.repeat(self.first[:-1] - first[:-1], per) + np.arange(first[-1])
        values = long_enough[at] if n >= k else np.zeros(0, _U)
        if keep_short:
            short = np.flatnonzero((count > 0) & (count < k))
            if len(short):
                extra = np.array(
                    [
                        window_hashes(hashes[self.first[d] : self.first[d + 1]], int(count[d]))[0]
                        for d in short
                    ],
                    dtype=_U,
                )
                values = np.insert(values, first[short], extra)
                per[short] = 1
                np.cumsum(per, out=first[1:])
        return values, first


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` consecutive words, document ends ignored."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.full(n, k, dtype=_U)
    for j in range(k):
        total = total * _U(_WORD_BASE) + hashes[j : j + n]
    return mix(total)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5, lower: bool = True) -> list:
    """Sorted distinct shingle hashes of each document."""
    words = Words(data, offsets, lower)
    values, first = words.shingles(words.hashes(), k)
    return [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:])]


def word_codes(words: Words) -> np.ndarray:
    """A number per word, equal for equal words and only for those (their bytes decide)."""
    ends = np.zeros(len(words.starts) + 1, np.int64)
    np.cumsum(words.ends - words.starts, out=ends[1:])
    packed = np.ascontiguousarray(words.data[~_blank[words.data]])
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(words.starts), [None, pa.py_buffer(ends), pa.py_buffer(packed)]
    )
    return array.dictionary_encode().indices.to_numpy().astype(np.int64)


def joined(words: Words, keep: np.ndarray) -> pa.Array:
    """A text per document: its words chosen by ``keep``, joined by one blank."""
    at = np.flatnonzero(keep)
    first = np.searchsorted(at, words.first)
    blank = np.ones(len(at), np.int64)
    blank[first[1:][np.diff(first) > 0] - 1] = 0  # none after a document's last word
    size = words.ends[at] - words.starts[at] + blank
    ends = np.zeros(len(at) + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    take = np.repeat(words.starts[at] - ends[:-1], size) + np.arange(ends[-1])
    out = words.data[np.minimum(take, max(len(words.data) - 1, 0))]
    out[ends[1:][blank > 0] - 1] = 0x20
    return pa.LargeStringArray.from_buffers(
        len(first) - 1, pa.py_buffer(ends[first]), pa.py_buffer(out)
    ).cast(pa.string())


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)
