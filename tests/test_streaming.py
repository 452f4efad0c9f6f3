"""Incremental landing: pages are consumed once, new pages on the next run."""

import json
import os

from tillwork.streaming.landing import land_change_log


def _page(path, entries):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"data": entries}, f)


def _entry(i, n_items):
    items = [{"item_name": f"m{j}", "quantity": j + 1} for j in range(n_items)]
    return {"tran_id": f"T{i}", "tran_no": f"N{i}", "tran_date": 1709607600000 + i, "log_type": "SALE_CHANGE",
            "change_data": json.dumps({"sale_detail": items})}


def test_land_change_log_incremental(spark, tmp_path):
    landed, table, ckpt = str(tmp_path / "landed"), str(tmp_path / "table"), str(tmp_path / "ckpt")
    _page(f"{landed}/report_date=2024-03-05/store=u-a/page=1.json", [_entry(1, 2), _entry(2, 0)])
    land_change_log(spark, landed, table, ckpt).awaitTermination()
    first = spark.read.parquet(table)
    assert first.count() == 3  # 2 items + 1 entry without items
    _page(f"{landed}/report_date=2024-03-06/store=u-a/page=1.json", [_entry(3, 1)])
    land_change_log(spark, landed, table, ckpt).awaitTermination()
    again = spark.read.parquet(table)
    assert again.count() == 4  # only the new page was added
    assert sorted(r["report_date"].isoformat() if hasattr(r["report_date"], "isoformat") else r["report_date"]
                  for r in again.select("report_date").distinct().collect()) == ["2024-03-05", "2024-03-06"]


def test_compact_page_lines(spark, tmp_path):
    from tillwork.sources.pages import flatten_change_log, read_page_lines

    lines = [{"store_uid": "u-a", "report_date": "2024-03-05", "page_no": p,
              "body": json.dumps({"data": {"items": [_entry(p * 10 + i, 1) for i in range(3)]}})} for p in range(4)]
    lines.append({"store_uid": "u-a", "report_date": "2024-03-05", "page_no": 9, "body": ""})
    path = tmp_path / "pages.jsonl"
    path.write_text("\n".join(json.dumps(x) for x in lines), encoding="utf-8")
    flat = flatten_change_log(read_page_lines(spark, str(path)))
    assert flat.count() == 12
    assert sorted(r["entry_pos"] for r in flat.filter("page_no = 2").collect()) == [0, 1, 2]
