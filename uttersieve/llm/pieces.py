"""Encoding into pieces and back (operator 10), by suffix-array matching.

The vocabulary is that of a byte-fallback BPE model file.  For a batch of texts:

1. The distinct chunks of the texts are concatenated.  A text is cut between two
   characters that stand side by side in no piece: no piece spans such a cut, so
   chunks encode independently.
2. A suffix array of that text is built over the longest piece's length.
3. Every piece's range of suffixes is found by binary search, all pieces at once;
   each suffix in the range is an edge (start, end, piece).
4. Edges are sorted by their end and relaxed from left to right.  In BPE the pieces
   of a prefix do not depend on what follows, and a piece may follow another
   exactly if the two alone would encode to themselves.  So each position has one
   valid last piece: the edge that fits the last piece at its start.  All chunks
   are relaxed together, one position at a time.
5. A text's ids are its chunks' ids, joined.

A character without a piece becomes its UTF-8 bytes' pieces.  Decoding puts pieces
and bytes together again; it is exact but for the blank's own mark in a text, which
comes back as a blank.  A batch is worked in slices of about ``_AT_ONCE`` characters,
so memory depends on the longest text only.

Null or empty text: no ids.  Repeated rows are each encoded.  Extra columns are not
looked at.
"""

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from uttersieve.llm.registry import documents, query

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
_AT_ONCE = 1 << 18  # characters of distinct new chunks in a slice
_REMEMBERED = 300_000  # chunks whose ids a worker keeps, then it starts anew
_NEVER = 1 << 40
_loaded: dict = {}


class Vocabulary:
    """Pieces with their merge order, and which pieces may stand side by side."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        special = [
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
            for i in range(n)
        ]
        self.seen: dict = {}
        self.byte = np.array([i for i in range(n) if model.is_byte(i)])
        if len(self.byte) != 256:
            raise ValueError("the model needs a piece for every byte")
        self.unknown = model.unk_id()
        self.is_byte = np.zeros(n, bool)
        self.is_byte[self.byte] = True
        self.special = np.array(special)
        self.id = {p: i for i, p in enumerate(self.text) if not special[i]}
        # a lower rank merges first; equal scores merge from the left like one rank
        score = np.array([model.get_score(i) for i in range(n)])
        order = np.unique(-score, return_inverse=True)[1]
        self.rank = order.astype(np.int64)
        self._split()
        self.longest = max((len(p) for p in self.id), default=1)
        listed = [(i, p) for p, i in self.id.items() if self.usable[i]]
        self.table_ids = np.array([i for i, _ in listed], np.int32)
        self.sizes = np.array([len(p) for _, p in listed], np.int32)
        self.table = np.zeros((len(listed), self.longest), np.int64)
        for row, (_, p) in zip(self.table, listed):
            row[: len(p)] = [ord(c) for c in p]
        pairs = {(a, b) for p in self.id for a, b in zip(p, p[1:])}
        self.glued = np.array(
            sorted((ord(a) << 21) | ord(b) for a, b in pairs), np.int64
        )

    def _split(self):
        """The last merge of every piece, and the table of merges."""
        n = len(self.text)
        self.left, self.right = np.full(n, -1), np.full(n, -1)
        self.usable = np.zeros(n, bool)
        merges = []
        for p, i in sorted(self.id.items(), key=lambda x: len(x[0])):
            for k in range(1, len(p)):
                a, b = self.id.get(p[:k]), self.id.get(p[k:])
                if a is not None and b is not None:
                    merges.append((a, b, i))
            if len(p) == 1:
                self.usable[i] = True
                continue
            parts = self._merge([self.id.get(c, -1) for c in p], stop_at=i)
            if parts is not None:
                self.left[i], self.right[i] = parts
                self.usable[i] = True
        key = np.array([a * n + b for a, b, _ in merges], np.int64)
        order = np.argsort(key)
        self.merge_key = key[order]
        self.merge_rank = self.rank[np.array([m[2] for m in merges], np.int64)[order]]

    def _merge(self, parts, stop_at):
        """Merge characters as BPE does; the last two parts if they end in ``stop_at``."""
        if -1 in parts:
            return None
        last = None
        while len(parts) > 1:
            best = None
            for k in range(len(parts) - 1):
                i = self.id.get(self.text[parts[k]] + self.text[parts[k + 1]])
                if i is not None and (best is None or self.rank[i] < best[0]):
                    best = (self.rank[i], k, i)
            if best is None:
                return None
            _, k, i = best
            last = (parts[k], parts[k + 1])
            parts = [*parts[:k], i, *parts[k + 2 :]]
        return last if parts == [stop_at] else None

    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether piece ``b`` may follow piece ``a``: whether no merge across the border
        comes before the merges that made them.

        Undoes the later of the two last merges again and again; at each stage the
        pair at the border must not merge earlier than what was undone.
        """
        a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        ok = np.ones(len(a), bool)
        todo = np.arange(len(a))
        # merges from here on (rank, and side: the left piece's come first at one rank)
        limit = np.full(len(a), _NEVER)
        n = len(self.text)
        while len(todo):
            x, y, top = a[todo], b[todo], limit[todo]
            at = np.searchsorted(self.merge_key, x * n + y)
            at = np.minimum(at, len(self.merge_key) - 1)
            there = self.merge_key[at] == x * n + y
            # the border pair is right of the left piece's merges and left of the right's:
            # at one rank it comes after the former and before the latter
            border = self.merge_rank[at] * 4 + 1
            bad = there & (border < top)
            ok[todo[bad]] = False
            whole_x, whole_y = self.left[x] < 0, self.left[y] < 0
            when_x = np.where(whole_x, -1, self.rank[x] * 4)
            when_y = np.where(whole_y, -1, self.rank[y] * 4 + 2)
            go = ~bad & ~(whole_x & whole_y)
            undo_x = go & (when_x > when_y)
            undo_y = go & ~undo_x
            a[todo[undo_x]] = self.right[x[undo_x]]
            limit[todo[undo_x]] = when_x[undo_x]
            b[todo[undo_y]] = self.left[y[undo_y]]
            limit[todo[undo_y]] = when_y[undo_y]
            todo = todo[go]
        return ok


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def suffix_array(codes: np.ndarray, longest: int):
    """``(order, keys)``: suffixes sorted by their first ``longest`` symbols, and those
    symbols packed into words of 63 bits, most significant first."""
    bits = max(int(codes.max()).bit_length(), 1) if len(codes) else 1
    per = 63 // bits
    padded = np.concatenate([codes, np.zeros(longest + per, np.int64)])
    n, keys = len(codes), []
    for at in range(0, longest, per):
        key = np.zeros(n, np.int64)
        for j in range(at, at + per):
            key = (key << bits) | (padded[j : j + n] if j < longest else 0)
        keys.append(key)
    order = np.lexsort(keys[::-1]).astype(np.int32)
    return order, [k[order] for k in keys], bits, per


def _ranges(keys, low, high):
    """Binary search of all patterns at once: first and past-last suffix of each."""

    def search(pattern, right):
        lo = np.zeros(len(pattern[0]), np.int64)
        hi = np.full(len(pattern[0]), len(keys[0]), np.int64)
        while (lo < hi).any():
            mid = (lo + hi) >> 1
            probe = np.minimum(mid, len(keys[0]) - 1)
            before = np.zeros(len(lo), bool)
            equal = np.ones(len(lo), bool)
            for key, p in zip(keys, pattern):
                k = key[probe]
                before |= equal & (k < p)
                equal &= k == p
            if right:
                before |= equal
            active = lo < hi
            lo = np.where(active & before, mid + 1, lo)
            hi = np.where(active & ~before, mid, hi)
        return lo

    return search(low, False), search(high, True)


def _edges(codes, vocab: Vocabulary):
    """``(start, length, piece)`` of every occurrence of a usable piece."""
    alphabet = np.flatnonzero(np.bincount(codes))
    number = np.zeros(int(alphabet[-1]) + 1, np.int64)
    number[alphabet] = np.arange(1, len(alphabet) + 1)  # 0 is past the end
    order, keys, bits, per = suffix_array(number[codes], vocab.longest)
    # the pieces in the same numbers; one with a character that the text lacks is out
    table, size = vocab.table, vocab.sizes
    known = table < len(number)
    there = np.where(known, number[np.where(known, table, 0)], 0)
    used = np.arange(vocab.longest) < size[:, None]
    mine = np.flatnonzero(~(used & (there == 0)).any(axis=1))
    there, used, size = there[mine], used[mine], size[mine]
    top = (1 << bits) - 1
    low, high = [], []
    for at in range(0, vocab.longest, per):
        x, y = np.zeros(len(mine), np.int64), np.zeros(len(mine), np.int64)
        for k in range(at, at + per):
            if k < vocab.longest:
                x = (x << bits) | np.where(used[:, k], there[:, k], 0)
                y = (y << bits) | np.where(used[:, k], there[:, k], top)
            else:
                x, y = x << bits, y << bits
        low.append(x)
        high.append(y)
    first, last = _ranges(keys, low, high)
    count = last - first
    at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    return order[at], np.repeat(size, count), np.repeat(vocab.table_ids[mine], count)


def encode_chunks(chunks: list, vocab: Vocabulary) -> list:
    """Ids of each chunk as little-endian unsigned 32-bit bytes."""
    if not chunks:
        return []
    codes = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64)
    size = np.fromiter(map(len, chunks), np.int32, len(chunks))
    begin = (np.cumsum(size) - size).astype(np.int32)
    chunk = np.repeat(np.arange(len(chunks), dtype=np.int32), size)
    opens = begin[chunk]  # of each character: where its chunk begins
    left = opens + size[chunk]  # and ends
    start, length, piece = _edges(codes, vocab)
    inside = start + length <= left[start]
    start, length, piece = start[inside], length[inside], piece[inside]
    # characters without a usable piece stand for themselves, numbered below 0
    single = np.zeros(len(codes), bool)
    single[start[length == 1]] = True
    bare = np.flatnonzero(~single).astype(np.int32)
    start = np.concatenate([start, bare])
    length = np.concatenate([length, np.ones(len(bare), np.int32)])
    piece = np.concatenate([piece, np.full(len(bare), -1, np.int32)])
    # relax by the place of the end within the chunk
    end = start + length - opens[start]
    small = np.uint16 if int(size.max()) < 1 << 16 else np.int32
    order = np.argsort(end.astype(small), kind="stable")
    start, length, piece = start[order], length[order], piece[order]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(end, minlength=int(size.max()) + 1)[1:])])
    last = np.full(len(codes), -2, np.int32)  # the valid last piece of the prefix to here
    back = np.zeros(len(codes), np.int32)
    for a, b in zip(bounds[:-1], bounds[1:]):
        s, ln, p = start[a:b], length[a:b], piece[a:b]
        opening = s == opens[s]
        before = np.where(opening, -3, last[s - 1])
        ok = opening | ((before == -1) | (p == -1)) & (before != -2)
        ask = np.flatnonzero((before >= 0) & (p >= 0))
        if len(ask):
            ok[ask] = vocab.fit(before[ask], p[ask])
        s, ln, p = s[ok], ln[ok], p[ok]
        last[s + ln - 1] = p
        back[s + ln - 1] = ln
    # walk back from the ends of all chunks together
    at = begin + size - 1
    who = np.flatnonzero(size > 0)
    at = at[who]
    found_chunk, found_at, found_piece = [], [], []
    while len(who):
        found_chunk.append(who)
        found_at.append(at)
        found_piece.append(last[at])
        at = at - back[at]
        on = at >= begin[who]
        who, at = who[on], at[on]
    chunk_of, place, ids = (
        np.concatenate(x) for x in (found_chunk, found_at, found_piece)
    )
    order = np.lexsort((place, chunk_of))
    chunk_of, place, ids = chunk_of[order], place[order], ids[order]
    bare = np.flatnonzero(ids < 0)
    if len(bare):  # bytes in the place of the character
        spelled = [chr(c).encode() for c in codes[place[bare]]]
        more = np.array([len(x) for x in spelled])
        repeat = np.ones(len(ids), np.int64)
        repeat[bare] = more
        to = np.cumsum(repeat) - repeat
        ids, chunk_of = np.repeat(ids, repeat), np.repeat(chunk_of, repeat)
        for i, x in zip(to[bare], spelled):
            ids[i : i + len(x)] = vocab.byte[list(x)]
    bounds = np.searchsorted(chunk_of, np.arange(len(chunks) + 1)) * 4
    body = ids.astype("<u4").tobytes()
    return [body[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def cut(text: str, vocab: Vocabulary) -> list:
    """Chunks of a text: blanks are marked, one is put in front, and the text is cut
    where no piece spans two characters."""
    body = BLANK + text.replace(" ", BLANK)
    codes = np.frombuffer(body.encode("utf-32-le"), np.uint32).astype(np.int64)
    pair = (codes[:-1] << 21) | codes[1:]
    at = np.minimum(np.searchsorted(vocab.glued, pair), len(vocab.glued) - 1)
    cuts = np.flatnonzero(vocab.glued[at] != pair) + 1
    bounds = [0, *cuts.tolist(), len(body)]
    return [body[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _splitter(vocab: Vocabulary):
    """A pattern that cuts where :func:`cut` does for nearly all texts, much faster: before
    a blank that follows something else.  Finer cuts change nothing but speed."""
    before_blank = [c >> 21 for c in vocab.glued.tolist() if c & 0x1FFFFF == ord(BLANK)]
    if any(c != ord(BLANK) for c in before_blank):
        return None
    return re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n+")


def encode(texts: list, path: str):
    """Ids of each text as little-endian unsigned 32-bit bytes."""
    vocab = vocabulary(path)
    newline = ord("\n")
    lone = not any(newline in (c >> 21, c & 0x1FFFFF) for c in vocab.glued.tolist())
    pattern = _splitter(vocab) if lone else None
    table = vocab.seen
    at = 0
    while at < len(texts):
        if len(table) > _REMEMBERED:
            table.clear()
        end, size, wanted, parts = at, 0, {}, []
        while end < len(texts) and size < _AT_ONCE:
            text = texts[end] or ""
            if not text:
                mine = []
            elif pattern:
                mine = pattern.findall(BLANK + text.replace(" ", BLANK))
            else:
                mine = cut(text, vocab)
            for chunk in mine:
                if chunk not in table and chunk not in wanted:
                    wanted[chunk] = None
                    size += len(chunk)
            parts.append(mine)
            end += 1
        names = list(wanted)
        table.update(zip(names, encode_chunks(names, vocab)))
        for mine in parts:
            yield b"".join(map(table.__getitem__, mine))
        at = end


def decode(ids, path: str) -> str:
    """The text of a list of ids."""
    vocab = vocabulary(path)
    body = b"".join(
        bytes([i - int(vocab.byte[0])]) if vocab.is_byte[i] else vocab.text[i].encode()
        for i in ids
        if vocab.is_byte[i] or not vocab.special[i]
    )
    text = body.decode("utf-8", "replace").replace(BLANK, " ")
    return text[1:] if text.startswith(" ") else text


def _decode_many(bodies: list, vocab: Vocabulary) -> list:
    """Texts of many id lists; every id is looked up once per slice."""
    shown = getattr(vocab, "shown", None)
    if shown is None:
        shown = vocab.shown = [
            bytes([i - int(vocab.byte[0])]) if vocab.is_byte[i]
            else b"" if vocab.special[i] else t.replace(BLANK, " ").encode()
            for i, t in enumerate(vocab.text)
        ]
    out = []
    for body in bodies:
        ids = np.frombuffer(body, "<u4").tolist()
        text = b"".join([shown[i] for i in ids])
        out.append(text[1:] if text[:1] == b" " else text)
    return out


def encoded(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, decoded_crc32, round_trip`` (and ``ids``) per row.

    ``round_trip``: whether the decoded text equals the text.
    """

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(1).to_pylist()
                bodies = list(encode(texts, path))
                decoded = _decode_many(bodies, vocab)
                same = [d == (t or "").encode() for d, t in zip(decoded, texts)]
                columns = [
                    part.column(0),
                    pa.array([len(b) // 4 for b in bodies], pa.int64()),
                    pa.array([zlib.crc32(b) for b in bodies], pa.int64()),
                    pa.array([zlib.crc32(d) for d in decoded], pa.int64()),
                    pa.array(same),
                ]
                names = ["doc_id", "n_ids", "ids_crc32", "decoded_crc32", "round_trip"]
                if with_ids:
                    lists = [np.frombuffer(b, "<i4") for b in bodies]
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, n_ids bigint, ids_crc32 bigint, decoded_crc32 bigint, round_trip boolean"
    return docs.select("doc_id", "text").mapInArrow(
        run, schema + (", ids array<int>" if with_ids else "")
    )


def model(name: str = MODEL) -> str:
    """Where the public model file lies; each machine has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op10_suffix_pieces")
def op10(spark, folder):
    """Pieces of every document, as ids and decoded again."""
    return encoded(documents(spark, folder), model())
