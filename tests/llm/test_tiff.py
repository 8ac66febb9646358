import random
import struct
import zlib

import numpy as np
import pytest

from lexweave.llm import tiff


def images():
    rnd = np.random.default_rng(5)
    flat = np.repeat(rnd.integers(0, 256, (37, 1)), 53, axis=1).astype(np.uint8)
    noisy = rnd.integers(0, 256, (40, 70)).astype(np.uint8)
    colour = rnd.integers(0, 4, (21, 33, 3)).astype(np.uint8)
    return [flat, noisy, colour, np.zeros((1, 1), np.uint8), np.full((600, 9), 255, np.uint8)]


@pytest.mark.parametrize("compression", [tiff.PLAIN, tiff.PACKBITS, tiff.LZW, tiff.DEFLATE])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("layout", [{"rows": 16}, {"tile": 16}, {"rows": 7, "order": ">"}, {"tile": 32, "big": True, "order": ">"}])
def test_round_trip(compression, predictor, layout):
    pages = images()
    found = list(tiff.read_pages(tiff.write_pages(pages, compression, predictor, **layout)))
    assert len(found) == len(pages)
    for n, (page, want) in enumerate(zip(found, pages)):
        assert page.number == n and page.compression == compression and page.predictor == predictor and page.tiled == ("tile" in layout)
        assert (page.pixels == want.reshape(*want.shape[:2], -1)).all()


def test_codecs_on_many_strings():
    rnd = random.Random(7)
    for n in [0, 1, 2, 3, 127, 128, 129, 300, 5000, 70_000]:
        for data in (bytes(rnd.choice(b"ab") for _ in range(n)), rnd.randbytes(n), bytes(n)):
            assert tiff.unpack_bits(tiff.pack_bits(data), n) == data
            assert tiff.lzw_decode(tiff.lzw_encode(data), n) == data


def test_a_known_lzw_string():
    # the worked example of the TIFF 6.0 specification, page 59: codes 256 7 258 8 8 258 6 6 257 in nine bits
    bits = "".join(f"{c:09b}" for c in (256, 7, 258, 8, 8, 258, 6, 6, 257))
    data = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    want = bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    assert tiff.lzw_decode(data, 9) == want and tiff.lzw_encode(want) == data


def test_sixteen_bits_planar_and_loop():
    samples = np.arange(2 * 3 * 4, dtype="<u2").reshape(2, 3, 4) * 999  # planes, rows, columns
    steps = np.diff(samples, axis=2, prepend=np.zeros((2, 3, 1), "<u2"))
    body = steps.astype("<u2").tobytes()
    fields = [(256, 3, [4]), (257, 3, [3]), (258, 3, [16, 16]), (259, 3, [1]), (262, 3, [1]), (273, 4, None), (277, 3, [2]), (278, 3, [3]), (279, 4, None), (284, 3, [2]), (317, 3, [2])]
    at = 8 + 2 + 12 * len(fields) + 4
    extra = {273: [at + 16, at + 16 + 24], 279: [24, 24]}
    entries, tail = b"", b""
    for tag, kind, values in fields:
        values = values or extra[tag]
        data = struct.pack(f"<{len(values)}{'H' if kind == 3 else 'I'}", *values)
        if len(data) > 4:
            tail += data
            data = struct.pack("<I", at + len(tail) - len(data))
        entries += struct.pack("<HHI", tag, kind, len(values)) + data.ljust(4, b"\0")
    for following, pages in ((0, 1), (8, 1)):  # the second points back at itself
        file = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(fields)) + entries + struct.pack("<I", following) + tail + body
        found = list(tiff.read_pages(file))
        assert len(found) == pages and (found[0].pixels == np.moveaxis(samples, 0, 2)).all()


def test_damage_gives_an_error_row(spark):
    good = tiff.write_pages(images()[:2])
    values = [(1, good), (1, good), (2, None), (3, b""), (4, b"no tiff"), (5, good[: len(good) // 2]), (None, good)]
    rows = tiff.pages(spark.createDataFrame(values, "doc_id long, media binary").selectExpr("doc_id", "media", "'x' as page", "1 as width")).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.page, r.width, r.error is None))
    assert sorted(by[1]) == [(0, 53, True), (0, 53, True), (1, 70, True), (1, 70, True)]
    assert 2 not in by and 3 not in by and by[4] == [(0, None, False)] and not by[5][-1][2]
    assert len(by[None]) == 2
    rnd = random.Random(1)
    for _ in range(300):  # any damage is either an error or some page
        at = rnd.randrange(len(good))
        for page in tiff.read_pages(good[:at] + bytes([rnd.randrange(256)]) + good[at + 1 :]):
            assert isinstance(page, (tiff.Page, tiff.Malformed))


def test_query_columns(spark):
    from lexweave.llm import queries  # noqa: F401  the query's shape is tested on the rows below

    texts = [None, "", "a", "x" * 576, "é" * 300_000, "plain text", "plain text"]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, media string")
    got = {r.doc_id: r for r in tiff.payloads(tiff.store(df, keep=["doc_id"])).collect()}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        want = data + b"\xff" * (576 if not data else -len(data) % 576)
        assert bytes(got[i].payload) == want and got[i].n_bytes == len(data)
        assert zlib.crc32(want[-32:]) == zlib.crc32(bytes(got[i].payload)[-32:])
    assert "pages=3;" in got[4].feature and got[5].feature == got[6].feature and got[5].media == got[6].media
    assert tiff.payloads(tiff.store(df.limit(0))).collect() == []


def test_pages_add_up_to_the_payload_by_all_schemes(spark):
    import hashlib

    rnd = random.Random(3)
    ramp = "".join(chr(i % 128) for i in range(576 * 4))  # differencing leaves a run
    texts = [None, "", "short text of a few words", "x" * 5000, ramp, "".join(rnd.choice("abcdefgh ") for _ in range(400_000)), "".join(rnd.choice("abcdefgh ") for _ in range(9000)), "\U0001f600" * 700, "x" * 5000]
    df = spark.createDataFrame([(i % 8, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, page int").repartition(2)
    stored = tiff.store(df, keep=["doc_id", "text"])
    rows = tiff.digests(tiff.pages(stored, keep=["doc_id", "text"]), ["doc_id", "text"]).collect()
    assert sorted(r.doc_id for r in rows) == [0, 0, 1, 2, 3, 4, 5, 6, 7]
    plain = {r.text: r.feature for r in tiff.payloads(stored, keep=["text"]).collect()}
    schemes = {}
    for r in rows:
        data = (r.text or "").encode()
        want = data + b"\xff" * (576 if not data else -len(data) % 576)
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-32:]))
        assert r.feature == plain[r.text]
        schemes[r.text] = r.schemes
    assert schemes[texts[2]] == f"{tiff.PACKBITS}" or schemes[texts[2]] == f"{tiff.LZW}"
    assert schemes[texts[3]].startswith(f"{tiff.PACKBITS}") and schemes[ramp].endswith("d") and schemes[texts[6]] == f"{tiff.DEFLATE}"
    assert schemes[texts[5]].startswith(f"{tiff.DEFLATE}t")
    used = [tiff.scheme_of(np.frombuffer("".join(rnd.choice("abcdefgh ") for _ in range(576 * n)).encode(), np.uint8).reshape(-1, 576)) for n in (1, 9, 300)]
    assert [(s.compression, s.tile) for s in used] == [(tiff.LZW, None), (tiff.DEFLATE, None), (tiff.DEFLATE, 64)]
    assert tiff.digests(tiff.pages(stored.limit(0), keep=["doc_id"]), ["doc_id"]).collect() == []
    bad = spark.createDataFrame([(1, bytearray(b"no tiff"))], "doc_id long, media binary")
    with pytest.raises(Exception, match="Malformed|TIFF|tiff"):
        tiff.digests(tiff.pages(bad), ["doc_id"]).collect()
