import pyarrow.parquet as pq

from lexweave.plans.registry import QUERIES


def test_mojibake_repair_has_a_row_for_every_document(spark, tmp_path):
    rows = [(1, "café naïve"), (2, "it’s “quoted” – 5 €"), (3, "中文 é"), (4, "\U0001F600"), (5, None), (6, ""), (7, "plain")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.changed, r.as_before) for r in QUERIES["mojibake_repair"](spark, str(tmp_path)).collect()}
    # 2 and 4 have no marker of the reference once broken, so they stay as they were read
    assert got == {1: (True, True), 2: (False, False), 3: (True, True), 4: (False, False), 5: (False, True), 6: (False, True), 7: (False, True)}


def test_card_detail_all_has_every_order(spark, sf):
    orders = {r["o_orderkey"]: r["o_orderstatus"] for r in pq.read_table(f"{sf}/orders.parquet").to_pylist()}
    lines = {}
    for r in pq.read_table(f"{sf}/lineitem.parquet").to_pylist():
        lines.setdefault(r["l_orderkey"], []).append((r["l_linenumber"], r["l_partkey"]))
    want = {k: (status, ",".join(f"{n}:{p}" for n, p in sorted(lines.get(k, [])))) for k, status in orders.items()}
    rows = QUERIES["card_detail_all"](spark, sf).collect()
    assert {r.o_orderkey: (r.o_orderstatus, r.lines) for r in rows} == want and len(rows) == len(orders)
