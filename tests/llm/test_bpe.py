import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from lexweave.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(1)
    alphabet = list("ab1 2'  \n\t.!stmdrevlé中\U0001F600́ \x1c\x85\xa0''")
    out = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 80))) for _ in range(2000)]
    return out + ["", "'s", "'re'll'x", " 's", "\n's", "a" * 300 + " " * 200, "x\n\n  y", "\0\0 \0", "<|endoftext|>", "ab" * 500]


def test_ids_and_round_trip(library):
    sample = texts()
    ids, first, offsets = bpe.encode_texts(sample, PATH)
    assert len(offsets) == len(ids)
    for i, t in enumerate(sample):
        mine = ids[first[i] : first[i + 1]]
        assert mine.tolist() == library.encode_ordinary(t)
        assert bpe.decode_ids(mine, PATH)[0].tobytes() == t.encode()


def test_segments_of_a_long_text(library):
    text = "".join(texts())
    parts = bpe.split_long(text, 500, PATH)
    assert np.concatenate(parts).tolist() == library.encode_ordinary(text)
    one_run = "x" * 5000
    assert np.concatenate(bpe.split_long(one_run, 500, PATH)).tolist() == library.encode_ordinary(one_run)


def test_columns_rows_and_clashes(spark, library):
    rows = [(1, None, "old"), (2, "", None), (2, "it's a day", "x"), (None, "it's a day", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    got = bpe.encode(df, decoded=True).collect()
    assert [r.doc_id for r in got] == [1, 2, 2, None]
    assert [np.frombuffer(r.token_ids, "<u4").tolist() for r in got] == [library.encode_ordinary(r[1] or "") for r in rows]
    assert [bytes(r.decoded) for r in got] == [(r[1] or "").encode() for r in rows]
    again = bpe.decode(bpe.encode(df)).collect()
    assert [bytes(r.decoded) for r in again] == [(r[1] or "").encode() for r in rows]
    assert bpe.encode(df.limit(0)).collect() == []
