import hashlib
import io
import random
import zipfile

import pytest

from lexweave.llm import warczip as wz


def test_our_archives_by_the_standard_library():
    members = [("a.txt", b"alpha" * 100), ("dir/é.bin", bytes(range(256))), ("empty", b"")]
    for zip64 in (False, True):
        with zipfile.ZipFile(io.BytesIO(wz.pack_zip(members, zip64))) as z:
            assert z.testzip() is None and [(n, z.read(n)) for n in z.namelist()] == members


def test_library_archives_by_our_reader():
    for force in (False, True):
        for comment, prefix in ((b"", b""), (b"c" * 300 + b"PK\x05\x06", b""), (b"", b"#!stub\n")):
            raw = io.BytesIO()
            with zipfile.ZipFile(raw, "w") as z:
                for name, method in (("s", zipfile.ZIP_STORED), ("d", zipfile.ZIP_DEFLATED)):
                    info = zipfile.ZipInfo(name)
                    info.compress_type = method
                    with z.open(info, "w", force_zip64=force) as out:
                        out.write(b"0123456789" * 50)
                z.comment = comment
            archive = wz.open_bytes(prefix + raw.getvalue())
            assert archive.read_range("s", 15, 7) == b"5678901" and archive.read("d") == b"0123456789" * 50
            with pytest.raises(wz.BadArchive):
                archive.read_range("d", 0, 4)
            with pytest.raises(wz.BadArchive):
                archive.read_range("s", 499, 2)


def test_damage_is_found():
    good = wz.pack_archive([(1, "http://a/ b\n", b"<p>" * 90, hashlib.sha256(b"<p>" * 90).hexdigest(), None, False)], zip64=True)
    archive = wz.open_bytes(good)
    assert [r.payload for r in wz.read_records(archive, wz.index_of(archive))] == [b"<p>" * 90]
    for data in (b"", good[:-30], good[: len(good) // 2]):
        with pytest.raises(wz.BadArchive):
            wz.open_bytes(data)
    at = archive.begin(wz.WARC_MEMBER) + 40
    bad = wz.open_bytes(good[:at] + bytes([good[at] ^ 8]) + good[at + 1 :])
    with pytest.raises(wz.BadArchive):
        list(wz.read_records(bad, wz.index_of(bad)))


def expected(rows):
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        same = [p for p, _, h, *_ in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        revisit = len(data) >= 100 and first is not None and page != first
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_rows_match_brute_force(spark):
    rnd = random.Random(3)
    bodies = [None, "", "x" * 99, "x" * 100, "é" * 50, "<html>" * 500, "\0\r\n\r\nbody" * 30]
    rows = [(i, rnd.choice([None, "http://x/%d" % i, "bad url\n"]), rnd.choice(bodies), "c", 1) for i in range(120)]
    rows += [(3, None, "<html>" * 500, "c", 1), (3, None, "<html>" * 500, "c", 1), (None, "u", "<html>" * 500, "c", 1), (None, "u", "only null ids" * 20, "c", 1), (None, "u", "only null ids" * 20, "c", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, first int").repartition(4)
    for size in (wz.ARCHIVE_BYTES, 3000):
        got = wz.read(spark, wz.write(df, spark, archive_bytes=size)).collect()
        assert sorted((tuple(r)[:5] for r in got), key=str) == expected(rows)
    assert wz.read(spark, wz.write(df.limit(0), spark)).collect() == []
