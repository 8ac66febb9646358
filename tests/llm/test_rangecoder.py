import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from lexweave.llm import rangecoder as rc

PATH = P.path("word_bpe_49k.json")


def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def texts():
    rnd = random.Random(2)
    alphabet = list("abcDE's1.!é ñ\n\t中\U0001F600") + ["́", "İ", "Σ", "\xa0", " ", "\x1c"]
    out = [None, "", " ", "Hello it's 'The 123 end.", "x" * 3000, "Ｆｕｌｌ ﬁ"]
    return out + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 120))) for _ in range(400)] + ["the same line\n" * 200] * 2


def test_blocks_round_trip():
    rnd = np.random.default_rng(3)
    for ids in (rnd.integers(0, 65536, (700, 5)), np.full((600, 3), 65535), np.zeros((300, 2), int), np.minimum(rnd.zipf(1.3, (900, 7)), 65535), np.tile(np.arange(50), 12).reshape(-1, 1)):
        payloads = rc.encode_lanes(ids)
        assert (rc.decode_lanes(payloads, len(ids)) == ids).all()
        again = rc.encode_lanes(ids[:, :1])
        assert again[0] == payloads[0]  # a block is coded by itself


def test_repetition_is_learnt():
    ids = np.tile(np.random.default_rng(1).integers(0, 49000, 40), 50).reshape(-1, 1)
    assert len(rc.encode_lanes(ids)[0]) * 8 / len(ids) < 4


def test_file_round_trip_and_damage():
    rnd = np.random.default_rng(4)
    sizes = rnd.integers(1, 900, 30)
    ids = rnd.integers(0, 49408, int(sizes.sum()))
    doc_ids = [None, *range(-3, 26)]
    data = rc.pack_file(doc_ids, sizes, ids)
    d, s, i = rc.unpack_file(data)
    assert d == doc_ids and (s == sizes).all() and (i == ids).all()
    for at in (3, 30, len(data) // 2, len(data) - 1):
        with pytest.raises(ValueError):
            rc.unpack_file(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    assert rc.unpack_file(rc.pack_file([], np.zeros(0, int), np.zeros(0, int)))[0] == []


def test_chunks_agree_with_the_library_on_whole_texts():
    t = library()
    sample = [x or "" for x in texts()]
    ids, sizes = rc.Chunks(PATH).encode([x.encode() for x in sample])
    ends = np.cumsum(sizes)
    for x, a, b in zip(sample, ends - sizes, ends):
        assert ids[a:b].tolist() == t.encode(x, add_special_tokens=False).ids + [2]


def test_query_rows(spark):
    t = library()
    sample = texts()
    rows = [(1000 - i // 2 if i % 50 else None, x, "s") for i, x in enumerate(sample)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    want, start = [], 0
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    for file_bytes in (rc.FILE_BYTES, 4000):
        got = rc.read(spark, rc.write(df, spark, file_bytes=file_bytes)).collect()
        assert sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.token_ids)) for r in got), key=lambda r: r[1]) == want
    empty = rc.read(spark, rc.write(df.limit(0), spark))
    assert empty.collect() == []


def test_special_tokens_are_the_library_s(spark):
    """The library as it is, without any flag: its special tokens' strings are those tokens."""
    t = Tokenizer.from_file(PATH)
    sample = ["hello <|endoftext|> there", "<|startoftext|>x<|endoftext|>", "<|ENDOFTEXT|> is no token", "a<|endoftext |>", "<|endoftext|>" * 3, "plain", "É<|endoftext|>é \x85\xa0 İx"]
    ids, sizes = rc.Chunks(PATH).encode([x.encode() for x in sample])
    ends = np.cumsum(sizes)
    for x, a, b in zip(sample, ends - sizes, ends):
        assert ids[a:b].tolist() == t.encode(x, add_special_tokens=False).ids + [2]
    rows = rc.read(spark, rc.write(spark.createDataFrame(list(enumerate(sample)), "doc_id long, text string"), spark)).collect()
    assert {r.doc_id: np.frombuffer(r.token_ids, "<u4").tolist() for r in rows} == {i: t.encode(x, add_special_tokens=False).ids + [2] for i, x in enumerate(sample)}


def test_other_tokenizers_are_asked_for_whole_texts():
    path = P.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    sample = ["A  b\n c's", "", " x y", "É ü"]
    ids, sizes = rc.Chunks(path).encode([x.encode() for x in sample])
    assert ids.tolist() == [i for x in sample for i in [*t.encode(x, add_special_tokens=False).ids, 2]] and sizes.sum() == len(ids)


def test_every_plain_character_is_parted_as_by_the_library():
    t = Tokenizer.from_file(PATH)
    every = [chr(c) for c in range(1, 0x300)]
    sample = [f"a{c}b {c} {c}{c}1" for c in every]
    ids, sizes = rc.Chunks(PATH).encode([x.encode() for x in sample])
    ends = np.cumsum(sizes)
    for x, a, b in zip(sample, ends - sizes, ends):
        assert ids[a:b].tolist() == t.encode(x, add_special_tokens=False).ids + [2], x


def test_order_0_predicts_whole_ids():
    rnd = np.random.default_rng(5)
    ids = rnd.choice(np.arange(100, 40000, 97), 60000, p=(w := 1 / np.arange(1, 413) ** 1.2) / w.sum())
    p = np.bincount(ids) / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum()
    data = rc.pack_file([1], np.array([len(ids)]), ids)
    assert len(data) * 8 / len(ids) < entropy + 0.6
    assert (rc.unpack_file(data)[2] == ids).all()


def test_digits_beyond_the_first_room():
    """Ids that nothing predicts need more digits than there is room for at first, the last four included."""
    for steps in (1, 130, 256, 300):
        ids = np.random.default_rng(steps).integers(0, 1 << 16, (steps, 300)).astype(np.uint16)
        assert np.array_equal(rc.decode_lanes(rc.encode_lanes(ids), steps), ids)
