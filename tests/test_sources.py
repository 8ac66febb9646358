import sqlite3
import zipfile

from lexweave.sources import lists


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_csv_lists(spark, tmp_path):
    (tmp_path / "bsl.csv").write_text('﻿Word,BSL Rank,x\nprofit,1,a\n ,2,b\n"loss, net",n/a,c\n', encoding="utf-8")
    c, e = lists.read(spark, "bsl", str(tmp_path / "bsl.csv"))
    assert rows(c, "headword", "freq_rank", "source") == [("loss, net", None, "bsl"), ("profit", 1, "bsl")] and e.count() == 0
    (tmp_path / "oct.csv").write_text("headword,pos,CEFR,notes\nanalyze/analyse / anal,verb,C1,look closely\n/,noun,A1,\nbank,Noun,a2,\n", encoding="utf-8")
    c, e = lists.read(spark, "octanove", str(tmp_path / "oct.csv"))
    assert rows(c, "headword", "raw_pos", "cefr") == [("analyze", "verb", "C1"), ("bank", "Noun", "a2")]
    assert rows(e, "headword", "kind", "payload") == [("analyze", "definition", "look closely"), ("analyze", "form", "anal"), ("analyze", "form", "analyse")]
    c, e = lists.read(spark, "cefrj", str(tmp_path / "oct.csv"))
    assert rows(e, "kind") == [("form",), ("form",)]


def test_lines_and_readings(spark, tmp_path):
    (tmp_path / "dolch.csv").write_text("﻿be,am, is ,be\n\n,x\ngo,goes,,went\n", encoding="utf-8")
    c, e = lists.read(spark, "new_dolch", str(tmp_path / "dolch.csv"))
    assert rows(c, "headword", "freq_rank") == [("be", 1), ("go", 2)]
    assert rows(e, "headword", "payload") == [("be", "am"), ("be", "is"), ("go", "goes"), ("go", "went")]
    (tmp_path / "ipa.txt").write_text("bank\t/baenk/, /bank/\nnotab\nempty\t , \n", encoding="utf-8")
    _, e = lists.read(spark, "ipa_dict", str(tmp_path / "ipa.txt"))
    assert rows(e, "headword", "payload", "kind") == [("bank", "/baenk/", "ipa"), ("bank", "/bank/", "ipa")]


def test_workbook(spark, tmp_path):
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cell = lambda at, v: f'<c r="{at}" t="s"><v>{v}</v></c>'
    sheet = f"<worksheet {space}><sheetData><row>{cell('A1', 0)}</row><row>{cell('A2', 1)}{cell('B2', 2)}<c r=\"C2\"><v>1</v></c></row><row><c r=\"A3\" t=\"inlineStr\"><is><t>abroad</t></is></c>{cell('B3', 3)}</row><row>{cell('B4', 2)}</row></sheetData></worksheet>"
    shared = f"<sst {space}><si><t>Lemma</t></si><si><r><t>ba</t></r><r><t>nk</t></r></si><si><t>1 - NGSL</t></si><si><t>3 - NAWL</t></si></sst>"
    with zipfile.ZipFile(tmp_path / "ngsl.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", shared)
    assert rows(lists.read(spark, "ngsl", str(tmp_path / "ngsl.xlsx"))[0], "headword", "freq_rank") == [("bank", 1)]
    assert rows(lists.read(spark, "nawl", str(tmp_path / "ngsl.xlsx"))[0], "headword", "freq_rank", "source") == [("abroad", None, "nawl")]


def test_sqlite(spark, tmp_path):
    core, text = tmp_path / "core.sqlite", tmp_path / "text.sqlite"
    con = sqlite3.connect(core)
    con.execute("CREATE TABLE items (item_id, headword, pos, ipa)")
    con.execute("INSERT INTO items VALUES (1, 'bank', 'noun', '/b/'), (2, 'run', 'verb', NULL)")
    con.commit()
    con.close()
    con = sqlite3.connect(text)
    con.execute("CREATE TABLE item_text (item_id, definition, examples_json, synonyms_json, antonyms_json)")
    con.execute("INSERT INTO item_text VALUES (1, 'a place', '[\"one \", \"\", \"two\"]', 'broken', NULL), (3, 'x', '[]', '[]', '[]')")
    con.commit()
    con.close()
    a = lists.sqlite_table(spark, str(core), "items", ["item_id", "headword", "pos", "ipa"])
    b = lists.sqlite_table(spark, str(text), "item_text", ["item_id", "definition", "examples_json", "synonyms_json", "antonyms_json"])
    _, e = lists.legacy_evidence(a, b)
    assert rows(e, "headword", "kind", "payload") == [("bank", "definition", "a place"), ("bank", "example", "one"), ("bank", "example", "two"), ("bank", "ipa", "/b/"), ("bank", "pos", "noun")]
    assert rows(lists.is_sqlite(spark, str(tmp_path)), "sqlite") == [(True,), (True,)]


def test_stream_of_answers(spark, tmp_path):
    from lexweave.streaming.answers import VersionedStore, gated_stream

    schema = "key string, tier int, status string, model string"
    store = VersionedStore(spark, str(tmp_path / "store"), schema, ["key"])
    source = tmp_path / "in"
    answers = "key string, tier int, status string, model string, attempt int"
    batches = [[("a", 3, "rejected", "local:qwen3:8b", 1), ("b", 0, "approved", "", 1)], [("a", 3, "approved", "local:qwen3:8b", 1), ("a", 3, "rejected", "openai:x", 2), ("b", 3, "approved", "openai:x", 1)], [("a", 3, "approved", "gemini:gemini-2.5-pro", 1)]]
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, answers).coalesce(1).write.parquet(str(source / str(i)))
        stream = spark.readStream.schema(answers).parquet(str(source / "*"))
        query = gated_stream(stream, store, str(tmp_path / "check"))
        query.awaitTermination()
        assert query.exception() is None
    got = [rows(store.read(v), "key", "status", "model") for v in (1, 2, 3)]
    assert got[0] == [("a", "rejected", "local:qwen3:8b"), ("b", "approved", "")]
    assert got[1] == [("a", "rejected", "openai:x"), ("b", "approved", "")]
    assert got[2] == [("a", "approved", "gemini:gemini-2.5-pro"), ("b", "approved", "")]
