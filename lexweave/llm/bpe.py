"""Operator 1: byte-level BPE encoding and decoding without regular expressions.

Pre-tokenisation is a finite automaton over code-point classes.  Each class is a
function from states to states; those functions form a small monoid, so all the
states of a batch come from an associative scan over a monoid multiplication
table: block products, a scan over the blocks, then a vectorised replay.  A
token starts where the automaton leaves a run.  The byte slices between starts
feed a cache of pair merges; slice offsets are kept, and decoding is a gather
from the vocabulary's bytes.

Defined results: a null text is the empty text, which has no ids and decodes to
no bytes.  Ties of equal ranks merge leftmost first.  Repeated rows give equal
results; rows are handled one by one, so an empty table gives an empty table.
Added columns replace input columns of the same names.
"""

from __future__ import annotations

import base64
import functools
import heapq
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexweave.llm.common import append_columns, text_chunks

LETTER, NUMBER, OTHER, CONTRACT2, CONTRACT3, LAST_BLANK, LAST_SPACE, MID_SPACE, END = range(9)
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_SPACES, ONE_LEFT, TWO_LEFT = range(8)

# The code points with the White_Space property.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# First and last of the letters and numbers that Unicode 16 adds to 15.1.
NEW_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]

#: Characters that one vectorised pass takes at most (a longer text is one pass by itself, in segments).
PASS_CHARS = 1 << 20
#: Distinct slices whose merges a worker remembers.
CACHE_SLICES = 200_000


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The automaton: next state, and whether a token starts at this character."""
    if symbol == END:
        return START, True
    if state == TWO_LEFT:
        return ONE_LEFT, False
    if state == ONE_LEFT:
        return START, False
    if symbol == LETTER:
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_BLANK)
    if symbol == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_BLANK)
    if symbol in (OTHER, CONTRACT2, CONTRACT3):
        if state in (IN_OTHERS, AFTER_BLANK):
            return IN_OTHERS, False
        return {OTHER: IN_OTHERS, CONTRACT2: ONE_LEFT, CONTRACT3: TWO_LEFT}[symbol], True
    if symbol == MID_SPACE:
        return IN_SPACES, state != IN_SPACES
    return (AFTER_BLANK if symbol == LAST_BLANK else START), True


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(monoid product table, element of each symbol, element x START -> state, state x symbol -> 2*next+starts)."""
    symbols, states = range(9), range(8)
    functions = [tuple(step(s, y)[0] for s in states) for y in symbols]
    elements = list(dict.fromkeys([tuple(states), *functions]))
    seen = {f: i for i, f in enumerate(elements)}
    for f in elements:  # grows while it is read, until it is closed under composition
        for g in functions:
            h = tuple(g[x] for x in f)
            if h not in seen:
                seen[h] = len(elements)
                elements.append(h)
    product = np.zeros((len(elements), len(elements)), np.uint16)
    for i, f in enumerate(elements):
        for j, g in enumerate(elements):
            product[i, j] = seen[tuple(g[x] for x in f)]
    of_symbol = np.array([seen[f] for f in functions], np.uint16)
    from_start = np.array([f[START] for f in elements], np.uint8)
    replay = np.zeros((8, 16), np.uint8)
    for s in states:
        for y in symbols:
            after, starts = step(s, y)
            replay[s, y] = after * 2 + starts
    return product, of_symbol, from_start, replay.ravel()


@functools.cache
def code_point_classes() -> np.ndarray:
    """Class of each code point: 0 letter, 1 number, 2 other, 3 blank, 4 other white space."""
    classes = np.full(0x110000, 2, np.uint8)
    category = unicodedata.category
    for cp in range(0x110000):
        first = category(chr(cp))[0]
        if first == "L":
            classes[cp] = 0
        elif first == "N":
            classes[cp] = 1
    for kind, added in enumerate((NEW_LETTERS, NEW_NUMBERS)):
        for first, last in added:
            classes[first : last + 1] = kind
    classes[WHITE_SPACE] = 4
    classes[32] = 3
    return classes


def scan_elements(elements: np.ndarray, block: int = 256) -> np.ndarray:
    """Exclusive product of each block's predecessors, by an associative scan; one value a block."""
    product, _, _, _ = automaton()
    size = len(product)
    flat = product.ravel()
    total = elements.reshape(-1, block)
    columns = np.ascontiguousarray(total.T)
    acc = columns[0].astype(np.intp)
    for column in columns[1:]:
        acc = flat[acc * size + column].astype(np.intp)
    if len(acc) <= block:
        before, out = 0, np.zeros(len(acc), np.uint16)  # element 0 is the identity
        for i, x in enumerate(acc.tolist()):
            out[i] = before
            before = int(product[before, x])
        return out
    pad = -len(acc) % block
    padded = np.concatenate([acc.astype(np.uint16), np.zeros(pad, np.uint16)])
    outer = scan_elements(padded, block)
    rows = np.ascontiguousarray(padded.reshape(-1, block).T)
    out = np.zeros_like(rows)
    acc = outer.astype(np.intp)
    for i in range(block):
        out[i] = acc
        acc = flat[acc * size + rows[i]].astype(np.intp)
    return np.ascontiguousarray(out.T).ravel()[: len(elements) // block]


def token_starts(code_points: np.ndarray, ends: np.ndarray, block: int = 256) -> np.ndarray:
    """True where a token starts. ends: positions of the end marks, one after each text."""
    product, of_symbol, from_start, replay = automaton()
    n = len(code_points)
    symbols = code_point_classes()[code_points]
    symbols[ends] = 5
    space = (symbols == 3) | (symbols == 4)
    solid_next = np.zeros(n, bool)
    solid_next[:-1] = symbols[1:] < 3
    at = np.flatnonzero(space)
    kind = symbols[at]
    symbols[at] = np.where(solid_next[at], np.where(kind == 3, LAST_BLANK, LAST_SPACE), MID_SPACE)
    symbols[ends] = END
    quotes = np.flatnonzero(code_points == 39)
    quotes = quotes[~np.isin(quotes, ends)] if len(quotes) else quotes
    if len(quotes):
        padded = np.concatenate([code_points, np.zeros(2, code_points.dtype)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        symbols[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = CONTRACT2
        three = (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        symbols[quotes[three]] = CONTRACT3
    pad = -n % block
    if pad:
        symbols = np.concatenate([symbols, np.full(pad, END, np.uint8)])
    before = scan_elements(of_symbol[symbols], block)
    state = from_start[before].astype(np.intp)
    columns = np.ascontiguousarray(symbols.reshape(-1, block).T)
    starts = np.empty(columns.shape, bool)
    for i in range(block):
        both = replay[state * 16 + columns[i]]
        starts[i] = both & 1
        state = (both >> 1).astype(np.intp)
    return np.ascontiguousarray(starts.T).ravel()[:n]


class Vocabulary:
    """Ranks by bytes, and the bytes of each id laid end to end for decoding."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        size = max(self.ranks.values()) + 1
        by_id = [b""] * size
        for piece, rank in self.ranks.items():
            by_id[rank] = piece
        self.lengths = np.array([len(x) for x in by_id], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.single_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)

        self.none = size
        self._pair_table()

    def _pair_table(self) -> None:
        """Open-addressed table: the ids of two neighbours -> the id (rank) of their union."""
        ranks = self.ranks
        left, right, union = array("q"), array("q"), array("q")
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), union.append(rank)
        keys = np.frombuffer(left, np.int64) * self.none + np.frombuffer(right, np.int64)
        values = np.frombuffer(union, np.int64)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.slot_key = np.full(1 << self.bits, -1, np.int64)
        self.slot_value = np.full(1 << self.bits, self.none, np.int32)
        todo, self.probes = np.arange(len(keys)), 0
        while len(todo):
            at = self._slot(keys[todo], self.probes)
            free = self.slot_key[at] < 0
            self.slot_key[at[free]] = keys[todo[free]]
            won = self.slot_key[at] == keys[todo]
            self.slot_value[at[won]] = values[todo[won]]
            todo = todo[~won]
            self.probes += 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)
        return (mixed.astype(np.int64) + probe) & ((1 << self.bits) - 1)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; `none` where they don't merge."""
        keys = left.astype(np.int64) * self.none + right
        at = self._slot(keys, 0)
        found = self.slot_key[at]
        out = np.where(found == keys, self.slot_value[at], self.none)
        todo = np.flatnonzero((found != keys) & (found >= 0))
        for probe in range(1, self.probes):
            if not len(todo):
                break
            at = self._slot(keys[todo], probe)
            found = self.slot_key[at]
            hit = found == keys[todo]
            out[todo[hit]] = self.slot_value[at[hit]]
            todo = todo[~hit & (found >= 0)]
        return out

    def merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all slices end to end, and how many each has: one merge in each unfinished slice a round."""
        n = len(pieces)
        answers: dict[int, list[int]] = {}
        short = []
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                answers[i] = [whole]
            elif len(piece) > 96:
                answers[i] = self._merge_long(piece)
            else:
                short.append(i)
        counts = np.zeros(n, np.int64)
        if short:
            which = np.array(short, np.int64)
            sizes = np.array([len(pieces[i]) for i in short], np.int64)
            ids = self.single_ids[np.frombuffer(b"".join([pieces[i] for i in short]), np.uint8)]
            done_ids, done_which = [], []
            while len(which):
                begin = np.cumsum(sizes) - sizes
                ranks = np.full(len(ids), self.none, np.int32)
                ranks[:-1] = self.pair_ranks(ids[:-1], ids[1:])
                ranks[begin + sizes - 1] = self.none  # no pair across slices
                low = np.minimum.reduceat(ranks, begin)
                active = low < self.none
                over = np.flatnonzero(~active)
                if len(over):
                    done_which.append(np.repeat(which[over], sizes[over]))
                    done_ids.append(gather_runs(ids, begin[over], sizes[over]))
                    counts[which[over]] = sizes[over]
                hit = np.flatnonzero((ranks == np.repeat(low, sizes)) & np.repeat(active, sizes))
                owner = np.repeat(np.arange(len(which)), sizes)[hit]
                first = hit[np.concatenate([[True], owner[1:] != owner[:-1]])] if len(hit) else hit
                ids[first] = ranks[first]
                keep = np.repeat(active, sizes)
                keep[first + 1] = False
                ids = ids[keep]
                which, sizes = which[active], sizes[active] - 1
        else:
            done_ids, done_which = [], []
        for i, got in answers.items():
            counts[i] = len(got)
        if answers:
            done_which.append(np.repeat(np.fromiter(answers, np.int64, len(answers)), counts[np.fromiter(answers, np.int64, len(answers))]))
            done_ids.append(np.array([x for got in answers.values() for x in got], np.int64))
        owner = np.concatenate(done_which)
        return np.concatenate(done_ids)[np.argsort(owner, kind="stable")].astype(np.uint32), counts

    def _merge_long(self, piece: bytes) -> list[int]:
        """Ids of one slice of any length, by a heap over a linked list: lowest rank first, leftmost of equals."""
        n, get = len(piece), self.ranks.get
        stop, following, previous = [i + 1 for i in range(n)], [i + 1 for i in range(n)], [i - 1 for i in range(n)]
        heap = []

        def offer(i: int) -> None:
            j = following[i]
            if j < n:
                rank = get(piece[i : stop[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, stop[i], stop[j]))

        for i in range(n - 1):
            offer(i)
        alive = bytearray(b"\1") * n
        while heap:
            _, i, middle, end = heapq.heappop(heap)
            j = following[i] if alive[i] else n
            if not alive[i] or stop[i] != middle or j >= n or stop[j] != end:
                continue
            alive[j] = 0
            stop[i] = end
            following[i] = following[j]
            if following[i] < n:
                previous[following[i]] = i
            offer(i)
            if previous[i] >= 0:
                offer(previous[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : stop[i]]])
            i = following[i]
        return out


class MergeCache(dict):
    """Slice -> row of a table of ids.  Unseen slices of a pass are noted and merged together after it."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.flat, self.offsets, self.pending = np.zeros(0, np.uint32), np.zeros(1, np.int64), []

    def __missing__(self, piece: bytes) -> int:
        row = len(self.offsets) - 1 + len(self.pending)
        self.pending.append(piece)
        self[piece] = row
        return row

    def settle(self) -> None:
        """Merge what is pending, so that every row has its ids."""
        if self.pending:
            ids, counts = self.vocabulary.merge_all(self.pending)
            self.flat = np.concatenate([self.flat, ids])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(counts)])
            self.pending = []

    def trim(self) -> None:
        if len(self) > CACHE_SLICES or len(self.flat) > 8 * CACHE_SLICES:
            self.forget()


@functools.lru_cache(2)
def _tools(path: str) -> tuple[Vocabulary, MergeCache]:
    vocabulary = Vocabulary(path)
    return vocabulary, MergeCache(vocabulary)


def gather_runs(values: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[begin[i] : begin[i] + lengths[i]] for all i, end to end."""
    total = int(lengths.sum())
    shift = begin - (np.cumsum(lengths) - lengths)
    return values[np.repeat(shift, lengths) + np.arange(total)]


def encode_texts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, first id of each text and the total, byte offset of each id's slice start in the texts' bytes)."""
    _, cache = _tools(path)
    cache.trim()
    joined = "\0".join(texts) + "\0"
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    code_points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    data = joined.encode("utf-8", "surrogatepass")
    at = np.flatnonzero(token_starts(code_points, ends))
    if len(data) == len(code_points):
        byte_at, byte_ends = at, ends
    else:
        width = 1 + (code_points >= 0x80).view(np.int8) + (code_points >= 0x800) + (code_points >= 0x10000)
        position = np.cumsum(width) - width
        byte_at, byte_ends = position[at], position[ends]
    follow = np.append(byte_at[1:], len(data))
    real = np.ones(len(at), bool)
    real[np.searchsorted(at, ends)] = False
    starts, stops = byte_at[real], follow[real]
    get = cache.__getitem__
    rows = np.fromiter((get(data[a:b]) for a, b in zip(starts.tolist(), stops.tolist())), np.int64, len(starts))
    cache.settle()
    begin, counts = cache.offsets[rows], cache.offsets[rows + 1] - cache.offsets[rows]
    ids = gather_runs(cache.flat, begin, counts)
    slices_before = np.searchsorted(starts, byte_ends)
    ids_before = np.concatenate([[0], np.cumsum(counts)])
    return ids, np.concatenate([[0], ids_before[slices_before]]), np.repeat(starts, counts)


def decode_ids(ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offset of each id's bytes and the total)."""
    vocabulary, _ = _tools(path)
    lengths = vocabulary.lengths[ids]
    return gather_runs(vocabulary.bytes, vocabulary.begin[ids], lengths), np.concatenate([[0], np.cumsum(lengths)])


def split_long(text: str, limit: int, path: str) -> list[np.ndarray]:
    """A text over the limit, encoded in segments that are cut where a token starts."""
    parts, at, width = [], 0, limit
    while at < len(text):
        piece = text[at : at + width]
        if at + width < len(text):
            points = np.frombuffer((piece + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
            starts = np.flatnonzero(token_starts(points, np.array([len(piece)])))
            starts = starts[(starts > 0) & (starts < len(piece) - 3)]
            starts = starts[code_point_classes()[points[starts - 1]] < 3]  # cut no run of spaces
            if not len(starts):
                width *= 2
                continue
            piece = piece[: int(starts[-1])]
        parts.append(encode_texts([piece], path)[0])
        at, width = at + len(piece), limit
    return parts


def encode_column(texts: pa.Array, path: str, decoded: bool) -> list[pa.Array]:
    """Ids of each text as little-endian unsigned 32-bit integers and, if asked for, the bytes decoded from them."""
    out, back = [], []
    for chunk in text_chunks(texts, PASS_CHARS):
        if len(chunk) == 1 and len(chunk[0]) > 2 * PASS_CHARS:
            parts = split_long(chunk[0], PASS_CHARS, path)
            out.append(b"".join(p.astype("<u4").tobytes() for p in parts))
            if decoded:
                back.append(b"".join(decode_ids(p, path)[0].tobytes() for p in parts))
            continue
        ids, first, _ = encode_texts(chunk, path)
        data = ids.astype("<u4").tobytes()
        first = first.tolist()
        out += [data[4 * a : 4 * b] for a, b in zip(first, first[1:])]
        if decoded:
            plain, offsets = decode_ids(ids, path)
            data, cuts = plain.tobytes(), offsets[first].tolist()
            back += [data[a:b] for a, b in zip(cuts, cuts[1:])]
    return [pa.array(out, pa.binary())] + ([pa.array(back, pa.binary())] if decoded else [])


def _path(tokenizer: str | None) -> str:
    if tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode(df: DataFrame, text: str = "text", tokenizer: str | None = None, decoded: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Adds token_ids (binary, little-endian unsigned 32-bit) and, if asked, decoded (binary: ids turned back).

    tokenizer: a rank file; by default the public 50k byte-level vocabulary of each worker's installation.
    """
    added = [("token_ids", T.BinaryType(), pa.binary())] + ([("decoded", T.BinaryType(), pa.binary())] if decoded else [])
    keep = [c for c in (keep if keep is not None else df.columns) if c not in {a[0] for a in added}]
    return append_columns(df, lambda texts: encode_column(texts, _path(tokenizer), decoded), text, keep, added)


def decode(df: DataFrame, ids: str = "token_ids", tokenizer: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Adds decoded (binary) from a column of ids as `encode` writes them; null ids decode to no bytes."""

    def back(column: pa.Array) -> list[pa.Array]:
        path = _path(tokenizer)
        return [pa.array([decode_ids(np.frombuffer(x or b"", "<u4"), path)[0].tobytes() for x in column.to_pylist()], pa.binary())]

    keep = [c for c in (keep if keep is not None else df.columns) if c != "decoded"]
    return append_columns(df, back, ids, keep, [("decoded", T.BinaryType(), pa.binary())])
