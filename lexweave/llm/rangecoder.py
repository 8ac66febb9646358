"""Operator 5: token ids in binary files, by an adaptive context-mixing range coder.

Ids are cut into blocks of `BLOCK` ids.  Every block starts from the same model
state and carries its own checksum, so it can be read or lost by itself; many
blocks are coded side by side as the lanes of numpy arrays.

Model of an id, given the ids before it in its block: the order-2 and order-1
contexts each propose the id they last saw, with a confidence.  Whether a proposal
holds is coded with a mixture of two adaptive probabilities (one by the context's
own confidence, one by the other order's), whose weight adapts too.  An id that
no context proposed is coded by order 0: ids are ranked by their frequency in the
file and dealt to classes of about equal weight, so that each of the most frequent
ones has a class to itself.  The class has adaptive frequencies in its block, the id
has its frequency within the class.  All arithmetic is in integers, so files read
back alike anywhere.

File: magic, header, documents (ids and token counts) and the ids' rounded
frequencies (both deflated), block table (ids, digits, CRC-32 of the payload),
CRC-32 of everything so far, payloads.  The frequencies are the state that every
block starts from; they are read with the header, so a block needs no other block.

Defined results: a null text is the empty text, which has only the end id.
Documents are written in ascending order of their id, null ids first, equal ids
by their text; a damaged block raises ValueError.  An empty table writes no file
and reads as no rows.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexweave.llm.bpe import gather_runs
from lexweave.llm.common import file_system, fresh_dir, put_file

MAGIC = b"IDMIX02\n"
#: Ids in a block; blocks coded side by side.
BLOCK, LANES = 2048, 8192
SLOTS = 256  # places for each order's proposals
#: Order-0 classes of equal weight; ids in a class at most (more make further classes).
EQUAL, WIDEST = 32, 2048
CLASSES = EQUAL + (1 << 16) // WIDEST
#: Bits of the frequencies of classes, and of ids within a class.
CLASS_BITS, ID_BITS = 14, 14
#: Weight of a block's first frequencies, and of each id that comes, in its class's count.
START, GAIN = 3072, 24
#: Chunks whose ids a worker remembers.
CACHE_CHUNKS = 600_000
#: Text bytes for one file, about.
FILE_BYTES = 40 << 20
#: Text bytes that are tokenised at a time.
PASS_BYTES = 4 << 20
END_ID = 2


class Order0:
    """Ranks, classes and frequencies of ids within classes, from rounded frequencies that the file carries."""

    def __init__(self, ids: np.ndarray, levels: np.ndarray):
        """ids: distinct, ascending; levels: their rounded frequencies (see `level`)."""
        order = np.argsort(-levels.astype(np.int64), kind="stable")
        ids = ids.astype(np.int64)[order]
        level = levels.astype(np.int64)[order]
        weight = (8 + (level & 7)) << (level >> 3)
        before = np.cumsum(weight) - weight
        rank = np.arange(len(ids))
        own = before * EQUAL // max(1, int(weight.sum())) + rank // WIDEST
        first = np.flatnonzero(np.diff(own, prepend=-1))
        size = np.diff(np.append(first, len(ids)))
        number = np.repeat(np.arange(len(first)), size)
        mass = np.add.reduceat(weight, first) if len(ids) else np.zeros(0, np.int64)
        nth = rank - first[number]
        start = (before - before[first][number]) * ((1 << ID_BITS) - size[number]) // mass[number] + nth
        ends = np.append(start[1:], 1 << ID_BITS)
        ends[np.append(first[1:], len(ids))[: len(first)] - 1] = 1 << ID_BITS
        self.class_of, self.start_of, self.size_of = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.class_of[ids], self.start_of[ids], self.size_of[ids] = number, start, ends - start
        self.id_at = np.repeat(ids.astype(np.uint16), ends - start)  # by class and place within it
        self.counts = np.ones(CLASSES, np.int32)
        self.counts[: len(mass)] += (mass * START // max(1, int(mass.sum()))).astype(np.int32)


def level(counts: np.ndarray) -> np.ndarray:
    """Rounded frequencies: eight steps to each doubling, one byte."""
    counts = counts.astype(np.int64) * 8
    exponent = np.maximum(np.frexp(counts.astype(np.float64))[1] - 4, 0)
    return (exponent * 8 + ((counts >> exponent) & 7)).astype(np.uint8)


@functools.lru_cache(1)
def even() -> Order0:
    """Every id as frequent as the others."""
    return Order0(np.arange(1 << 16), np.zeros(1 << 16, np.uint8))


class Lanes:
    """Model of each lane; `odds` says how an id is coded next, `learn` takes the id in.

    An id's share of the interval is counted in 2^40 parts: 2^12 parts are dealt
    among the proposals and the rest, and the rest (2^28) is dealt by order 0.
    """

    def __init__(self, n: int, order0: Order0):
        self.n = n
        self.lane = np.arange(n)
        self.cells = [np.zeros(n * SLOTS, np.int32) for _ in range(2)]  # proposed id * 16 + confidence
        self.slot_base = self.lane * SLOTS
        self.own = [np.full(n * 16, 2048, np.int32) for _ in range(2)]
        self.other = [np.full(n * 32, 2048, np.int32) for _ in range(2)]
        self.weight = [np.full(n * 16, 128, np.int32) for _ in range(2)]
        self.counts = np.tile(order0.counts, n)
        self.count_base = self.lane * CLASSES
        self.class_base = self.lane * (CLASSES + 1)
        self.steps, self.since = 0, []
        self.refresh()
        self.last = [np.zeros(n, np.int64), np.zeros(n, np.int64)]

    def refresh(self) -> None:
        """Cumulative frequencies of classes from the counts so far."""
        for places in self.since:
            self.counts[places] += GAIN
        self.since = []
        total = np.cumsum(self.counts.reshape(self.n, CLASSES), axis=1, dtype=np.int64)
        cum = np.zeros((self.n, CLASSES + 1), np.int16)
        cum[:, 1:] = total * ((1 << CLASS_BITS) - CLASSES) // total[:, -1:] + np.arange(1, CLASSES + 1)
        self.cum = cum.ravel()

    def odds(self) -> None:
        """Sets, for order 2 and 1: slots, guesses, lanes where the proposal is used, their chances; and the parts of each."""
        one, two = self.last
        mixed = one * 40503
        self.slots = [self.slot_base + (((mixed + two * 60493) >> 4) & (SLOTS - 1)), self.slot_base + ((mixed >> 5) & (SLOTS - 1))]
        self.cell = [c.take(s) for c, s in zip(self.cells, self.slots)]
        self.guess = [c >> 4 for c in self.cell]
        trust = [c & 15 for c in self.cell]
        same = self.guess[0] == self.guess[1]
        first = (trust[0] > 1) | ((trust[0] == 1) & same)
        second = (trust[1] > 1) & ~(first & same)
        self.use = [np.flatnonzero(first), np.flatnonzero(second)]
        self.parts = [np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)]
        self.seen = []
        for k in (0, 1):
            at = self.use[k]
            a = at * 16 + trust[k].take(at)
            b = at * 32 + trust[1 - k].take(at) * 2 + same.take(at)
            x, y, w = self.own[k].take(a), self.other[k].take(b), self.weight[k].take(a)
            p = np.minimum(np.maximum((w * x + (256 - w) * y) >> 8, 32), 4064)
            self.seen.append((a, b, x, y, w))
            self.parts[k][at] = p if k == 0 else ((4096 - self.parts[0].take(at)) * p) >> 12
        self.proposed = self.parts[0] + self.parts[1]

    def learn(self, ids: np.ndarray, classes: np.ndarray, hit: list[np.ndarray]) -> None:
        """hit[k]: whether proposal k was the one that held."""
        for k in (0, 1):
            at, (a, b, x, y, w) = self.use[k], self.seen[k]
            good = hit[k].take(at)
            if k:  # not asked where the first held
                asked = np.flatnonzero(~hit[0].take(at))
                a, b, x, y, w, good = (v.take(asked) for v in (a, b, x, y, w, good))
            goal = good * np.int32(4095)
            self.own[k][a] = x + ((goal - x) >> 4)
            self.other[k][b] = y + ((goal - y) >> 5)
            better = np.where(good, x > y, x < y).view(np.int8)
            self.weight[k][a] = np.minimum(np.maximum(w + (better * np.int8(4) - np.int8(2)), 8), 248)
        fresh = ids.astype(np.int32) * 16 + 1
        for k in (0, 1):
            cell = self.cell[k]
            self.cells[k][self.slots[k]] = np.where(self.guess[k] == ids, cell + ((cell & 15) < 15), fresh)
        self.since.append(self.count_base + classes)
        self.last = [ids, self.last[0]]
        self.steps += 1
        if self.steps in _REFRESH or not self.steps % 256:
            self.refresh()


_REFRESH = frozenset((8, 16, 32, 64, 128, 192))
REST = CLASS_BITS + ID_BITS
#: The interval is at least 2^48 of 2^64 wide; what leaves it goes out in 16-bit digits.
TOTAL, LEAST, DIGIT = np.uint64(12 + REST), np.uint64(1 << 48), np.uint64(16)
TOP = np.uint64(48)


def encode_lanes(ids: np.ndarray, order0: Order0 | None = None) -> list[bytes]:
    """ids: (steps, lanes), one block a lane. Payload of each block: big-endian 16-bit digits."""
    steps, n = ids.shape
    order0 = order0 or even()
    state = Lanes(n, order0)
    low, width = np.zeros(n, np.uint64), np.full(n, 2**64 - 1, np.uint64)
    place = np.zeros(n, np.int64)
    out = np.zeros((steps // 2 + 69, n), np.int32)
    for step in range(steps):
        now = ids[step].astype(np.int64)
        state.odds()
        classes = order0.class_of.take(now)
        at = state.class_base + classes
        begin = state.cum.take(at).astype(np.int64)
        size = state.cum.take(at + 1) - begin
        rest = 4096 - state.proposed
        cum = (state.proposed << REST) + ((begin << ID_BITS) + order0.start_of.take(now) * size) * rest
        size *= rest * order0.size_of.take(now)
        hit = [np.zeros(n, bool), np.zeros(n, bool)]
        at = state.use[0]
        won = at.take(np.flatnonzero(state.guess[0].take(at) == now.take(at)))
        hit[0][won] = True
        cum[won], size[won] = 0, state.parts[0].take(won) << REST
        at = state.use[1]
        won = at.take(np.flatnonzero((state.guess[1].take(at) == now.take(at)) & ~hit[0].take(at)))
        hit[1][won] = True
        cum[won], size[won] = state.parts[0].take(won) << REST, state.parts[1].take(won) << REST
        r = width >> TOTAL
        moved = low + r * cum.view(np.uint64)
        carry = np.flatnonzero(moved < low)
        if len(carry):
            out[place[carry] - 1, carry] += 1
        low = moved
        width = r * size.view(np.uint64)
        need = np.flatnonzero(width < LEAST)
        while len(need):
            at, begin, size = place.take(need), low.take(need), width.take(need) << DIGIT
            if int(at.max()) >= len(out) - 5:  # the last digits have room too
                out = np.concatenate([out, np.zeros((steps // 2 + 64, n), np.int32)])
            out.reshape(-1)[at * n + need] = begin >> TOP
            place[need] = at + 1
            low[need] = begin << DIGIT
            width[need] = size
            need = need.take(np.flatnonzero(size < LEAST))
        state.learn(now, classes, hit)
    for _ in range(4):
        out[place, state.lane] = (low >> TOP).astype(np.int32)
        low <<= DIGIT
        place += 1
    for row in range(int(place.max()) - 1, 0, -1):  # carries
        out[row - 1] += out[row] >> 16
        out[row] &= 0xFFFF
    digits = np.ascontiguousarray(out[: int(place.max())].astype(">u2").T)
    return [digits[i, : place[i]].tobytes() for i in range(n)]


def decode_lanes(payloads: list[bytes], steps: int, order0: Order0 | None = None) -> np.ndarray:
    """(steps, lanes) of ids: encode_lanes undone."""
    n = len(payloads)
    longest = max(len(p) for p in payloads) // 2
    digits = np.zeros((longest + 4, n), np.uint16)
    for i, p in enumerate(payloads):
        digits[: len(p) // 2, i] = np.frombuffer(p, ">u2")
    order0 = order0 or even()
    state = Lanes(n, order0)
    offset = np.zeros(n, np.uint64)
    for k in range(4):
        offset = (offset << DIGIT) | digits[k].astype(np.uint64)
    width = np.full(n, 2**64 - 1, np.uint64)
    place = np.full(n, 4, np.int64)
    out = np.empty((steps, n), np.uint16)
    for step in range(steps):
        state.odds()
        r = width >> TOTAL
        value = np.minimum(offset // r, np.uint64((1 << (12 + REST)) - 1)).view(np.int64)
        top = value >> REST
        hit = [top < state.parts[0], None]
        hit[1] = ~hit[0] & (top < state.proposed)
        rest = 4096 - state.proposed
        inner = np.maximum(value - (state.proposed << REST), 0) // rest
        part = (inner >> ID_BITS).astype(np.int16)
        at = state.class_base.copy()
        half = CLASSES >> 1
        while half:
            at += half * (state.cum.take(at + half) <= part)
            half >>= 1
        begin = state.cum.take(at).astype(np.int64)
        size = state.cum.take(at + 1) - begin
        classes = at - state.class_base
        now = order0.id_at.take((classes << ID_BITS) + (inner - (begin << ID_BITS)) // size, mode="clip").astype(np.int64)
        won = np.flatnonzero(hit[0])
        now[won] = state.guess[0].take(won)
        other = np.flatnonzero(hit[1])
        now[other] = state.guess[1].take(other)
        cum = (state.proposed << REST) + ((begin << ID_BITS) + order0.start_of.take(now) * size) * rest
        size *= rest * order0.size_of.take(now)
        cum[won], size[won] = 0, state.parts[0].take(won) << REST
        cum[other], size[other] = state.parts[0].take(other) << REST, state.parts[1].take(other) << REST
        classes = order0.class_of.take(now)
        offset = offset - r * cum.view(np.uint64)
        width = r * size.view(np.uint64)
        need = np.flatnonzero(width < LEAST)
        while len(need):
            at, size = place.take(need), width.take(need) << DIGIT
            offset[need] = (offset.take(need) << DIGIT) | digits.reshape(-1).take(np.minimum(at, longest + 3) * n + need).astype(np.uint64)
            place[need] = at + 1
            width[need] = size
            need = need.take(np.flatnonzero(size < LEAST))
        out[step] = now
        state.learn(now, classes, hit)
    return out


def pack_file(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """One file: documents in the given order, their numbers of ids, and all ids end to end."""
    if len(ids) and int(ids.max()) >= 1 << 16:
        raise ValueError("ids must be under 65536")
    known = np.array([x is not None for x in doc_ids], np.uint8)
    numbers = np.array([x or 0 for x in doc_ids], "<i8")
    counts = np.bincount(ids, minlength=1 << 16)
    present = np.flatnonzero(counts)
    levels = level(counts[present])
    order0 = Order0(present, levels)
    documents = zlib.compress(known.tobytes() + numbers.tobytes() + sizes.astype("<i8").tobytes() + np.diff(present, prepend=0).astype("<u2").tobytes() + levels.tobytes(), 6)
    blocks = -(-len(ids) // BLOCK)
    padded = np.full(blocks * BLOCK, present[0] if len(present) else 0, np.uint16)
    padded[: len(ids)] = ids
    padded = padded.reshape(blocks, BLOCK)
    payloads: list[bytes] = []
    for at in range(0, blocks, LANES):
        payloads += encode_lanes(np.ascontiguousarray(padded[at : at + LANES].T), order0)
    counts = [min(BLOCK, len(ids) - at) for at in range(0, len(ids), BLOCK)]
    table = b"".join(struct.pack("<III", n, len(p), zlib.crc32(p)) for n, p in zip(counts, payloads))
    head = MAGIC + struct.pack("<QQIII", len(doc_ids), len(ids), BLOCK, blocks, len(documents)) + documents + table
    return b"".join([head, struct.pack("<I", zlib.crc32(head)), *payloads])


def unpack_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """pack_file undone; a damaged head or block raises ValueError."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a file of this format")
    at = len(MAGIC) + struct.calcsize("<QQIII")
    docs, total, block, blocks, packed = struct.unpack("<QQIII", data[len(MAGIC) : at])
    end = at + packed + 12 * blocks
    if len(data) < end + 4 or struct.unpack("<I", data[end : end + 4])[0] != zlib.crc32(data[:end]):
        raise ValueError("the head is damaged")
    body = zlib.decompress(data[at : at + packed])
    known = np.frombuffer(body, np.uint8, docs)
    numbers = np.frombuffer(body, "<i8", docs, docs)
    sizes = np.frombuffer(body, "<i8", docs, 9 * docs).astype(np.int64)
    distinct = (len(body) - 17 * docs) // 3
    present = np.cumsum(np.frombuffer(body, "<u2", distinct, 17 * docs).astype(np.int64))
    order0 = Order0(present, np.frombuffer(body, np.uint8, distinct, 17 * docs + 2 * distinct))
    out = np.empty(blocks * block, np.uint16)
    payloads, place = [], end + 4
    for i in range(blocks):
        _, length, crc = struct.unpack_from("<III", data, at + packed + 12 * i)
        payload = data[place : place + length]
        if len(payload) != length or zlib.crc32(payload) != crc:
            raise ValueError(f"block {i} is damaged")
        payloads.append(payload)
        place += length
    for first in range(0, blocks, LANES):
        part = payloads[first : first + LANES]
        out[first * block : (first + len(part)) * block] = decode_lanes(part, block, order0).T.ravel()
    return [int(x) if k else None for k, x in zip(known, numbers)], sizes, out[:total]


#: Characters whose class is the same in every Unicode version, and that normalising leaves alone.
PLAIN = [chr(c) for c in [*range(0x21, 0x7F), *range(0xA1, 0x130)]]
LETTERS = "".join(c for c in PLAIN if unicodedata.category(c)[0] == "L")
DIGITS = "".join(c for c in PLAIN if unicodedata.category(c)[0] == "N")
_PLAIN = re.compile("[!-~\xa1-\u012f]+")
#: PIECE for chunks of plain characters, which line breaks end.
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|\n|[^{LETTERS}{DIGITS}\n]+")

# Fixed value: the pattern by which this tokenizer parts a text.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# How such a tokenizer prepares a text before its merges.
LAYOUT = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": PIECE}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself if it is printable, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [x for x in range(256) if x not in set(shown)]
    return {**{x: chr(x) for x in shown}, **{x: chr(256 + i) for i, x in enumerate(other)}}


class Chunks:
    """Ids of texts from the tokenizers library, which is asked once for what comes again.

    A tokenizer of the known `LAYOUT` folds case, drops white space and joins nothing
    across it.  So a text is split into chunks without white space, a plain chunk into
    the pieces of the layout's pattern, and the library's model merges each distinct
    piece once while it is remembered; other chunks go through the whole tokenizer.
    Texts that hold a special token's string, and all texts of another tokenizer, are
    encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        self.known = all(made[k] == v for k, v in LAYOUT.items()) and made["post_processor"] is None and not made["truncation"] and not made["padding"]
        self.special = [t["content"].lower().encode() for t in made["added_tokens"]]
        self.known &= not any(t.split() != [t] for t in self.special)
        self.model = self.tokenizer.model
        self.characters = byte_characters()
        self.forget()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def forget(self) -> None:
        """Drops what is remembered: chunk -> row, and the rows' ids end to end."""
        self.rows: dict[str, int] = {}
        self.flat, self.offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.pieces: dict[str, int] = {"\n": 0}  # ends a chunk and has no ids
        self.piece_ids, self.piece_sizes = array("I"), array("q", [0])

    def _learn(self, pieces: list[str]) -> None:
        """Numbers and ids of pieces that come first."""
        first = len(self.pieces)
        self.pieces.update(zip(pieces, range(first, first + len(pieces))))
        shown = "\n".join(pieces).lower().encode().decode("latin-1").translate(self.characters)
        tokenize, ids, sizes = self.model.tokenize, self.piece_ids, self.piece_sizes
        for piece in shown.split(self.characters[10]) if pieces else ():
            own = [t.id for t in tokenize(piece)]
            ids.extend(own)
            sizes.append(len(own))

    def _add(self, chunks: list[str]) -> None:
        """New rows for these chunks, in their order."""
        if not chunks:
            return
        plain = [c.isascii() and c.isprintable() or _PLAIN.fullmatch(c) is not None for c in chunks]
        # a plain chunk's pieces, up to the line break that ends it
        found = _PIECE.findall("\n".join([c for c, p in zip(chunks, plain) if p] + [""]))
        self._learn([p for p in dict.fromkeys(found) if p not in self.pieces])
        numbers = np.fromiter(map(self.pieces.__getitem__, found), np.int64, len(found))
        table, sizes = np.array(self.piece_ids, np.uint32), np.array(self.piece_sizes, np.int64)
        begin = np.cumsum(sizes) - sizes
        upto = np.cumsum(sizes[numbers])
        counts = np.zeros(len(chunks), np.int64)
        counts[np.flatnonzero(plain)] = np.diff(upto[numbers == 0], prepend=0)
        flat = gather_runs(table, begin[numbers], sizes[numbers])
        odd = np.flatnonzero(~np.array(plain, bool))
        if len(odd):
            own = self._ids([chunks[i] for i in odd])
            counts[odd] = [len(x) for x in own]
            whole = np.empty(int(counts.sum()), np.uint32)
            of_odd = np.repeat(~np.array(plain, bool), counts)
            whole[~of_odd], whole[of_odd] = flat, np.fromiter(chain.from_iterable(own), np.uint32)
            flat = whole
        first = len(self.offsets) - 1
        self.rows.update(zip(chunks, range(first, first + len(chunks))))
        self.flat = np.concatenate([self.flat, flat])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(counts)])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; ids of each text)."""
        if len(self.rows) > CACHE_CHUNKS or len(self.pieces) > CACHE_CHUNKS:
            self.forget()
        lower = pc.ascii_lower(pa.array(texts, pa.binary()).cast(pa.string()))
        whole = np.ones(len(texts), bool)
        if self.known:
            whole[:] = False
            for token in self.special:
                whole |= pc.match_substring(lower, token.decode()).to_numpy(zero_copy_only=False)
        parts = pc.ascii_split_whitespace(pc.if_else(pa.array(whole), "", lower))
        words = parts.values.dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        rows = np.fromiter(map(self.rows.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(rows < 0)
        rows[new] = len(self.offsets) - 1 + np.arange(len(new))
        self._add([distinct[i] for i in new.tolist()])
        rows = rows[words.indices.to_numpy()] if len(rows) else np.zeros(0, np.int64)
        begin, counts = self.offsets[rows], np.diff(self.offsets)[rows]
        ids = gather_runs(self.flat, begin, counts)
        upto = np.concatenate([[0], np.cumsum(counts)])[parts.offsets.to_numpy()]
        own = np.diff(upto)
        if whole.any():
            at = np.flatnonzero(whole)
            made = self._ids([texts[i].decode("utf-8", "replace") for i in at])
            ids = np.insert(ids, np.repeat(upto[at], [len(x) for x in made]), np.fromiter(chain.from_iterable(made), np.uint32))
            own[at] = [len(x) for x in made]
        return np.insert(ids, np.cumsum(own), END_ID), own + 1


@functools.lru_cache(2)
def chunks_of(path: str) -> Chunks:
    return Chunks(path)


def _path(tokenizer: str | None) -> str:
    if tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write(df: DataFrame, spark: SparkSession, text: str = "text", doc_id: str = "doc_id", tokenizer: str | None = None, folder: str | None = None, file_bytes: int = FILE_BYTES) -> str:
    """Writes the documents' ids as files of the folder, in ascending order of doc_id; returns the folder.

    A task writes its file under the name of its range, complete or not at all, so
    a repeated attempt replaces it by an equal one.
    """
    folder = folder or fresh_dir(spark, "token-ids")
    slim = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = slim.repartitionByRange(max(1, -(-size // file_bytes)), "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cache, number = chunks_of(_path(tokenizer)), TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        sizes, ids = [], []
        for batch in batches:
            doc_ids += batch.column(0).to_pylist()
            part, room = [], 0
            for t in batch.column(1).cast(pa.binary()).to_pylist():
                part.append(t)
                room += len(t)
                if room > PASS_BYTES:
                    add(cache, part, sizes, ids)
                    part, room = [], 0
            if part:
                add(cache, part, sizes, ids)
        if doc_ids:
            own, flat = np.concatenate(sizes), np.concatenate(ids)
            sizes.clear(), ids.clear()
            pa.default_memory_pool().release_unused()  # room for the coder
            name = f"ids-{number:06d}.mix"
            put_file(f"{folder}/{name}", pack_file(doc_ids, own, flat))
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([name]), pa.array([len(doc_ids)], pa.int64()), pa.array([len(flat)], pa.int64())], names=["number", "name", "docs", "ids"])

    def add(cache: Chunks, part: list[bytes], sizes: list, ids: list) -> None:
        flat, own = cache.encode(part)
        if len(flat) and int(flat.max()) >= 1 << 16:
            raise ValueError("ids must be under 65536")
        sizes.append(own), ids.append(flat.astype(np.uint16))

    ranges.mapInArrow(run, "number int, name string, docs long, ids long").write.parquet(f"{folder}/files")
    return folder


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row a document from the files: doc_id, start (ids of all documents before it), n_tokens, token_ids (binary, little-endian unsigned 32-bit)."""
    files = spark.read.schema("number int, name string, docs long, ids long").parquet(f"{folder}/files")
    n = max(1, files.count())
    # one small row a file
    placed = files.select("number", "name", (F.sum("ids").over(W.orderBy("number")) - F.col("ids")).alias("start"), (F.row_number().over(W.orderBy("number")) - 1).alias("nth"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, path = file_system(f"{folder}/{name}")
                with system.open_input_stream(path) as source:
                    doc_ids, sizes, ids = unpack_file(source.read())
                ends = np.cumsum(sizes)
                for a in range(0, len(doc_ids), 4096):
                    first = int(ends[a - 1]) if a else 0
                    here = ends[a : a + 4096]
                    data = ids[first : int(here[-1])].astype("<u4").tobytes()
                    cuts = [4 * (int(x) - first) for x in [first, *here]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids[a : a + 4096], pa.int64()),
                            pa.array(start + here - sizes[a : a + 4096], pa.int64()),
                            pa.array(sizes[a : a + 4096], pa.int64()),
                            pa.array([data[x:y] for x, y in zip(cuts, cuts[1:])], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "token_ids"],
                    )

    return placed.repartitionById(n, F.col("nth")).select("name", "start").mapInArrow(run, "doc_id long, start long, n_tokens long, token_ids binary")
