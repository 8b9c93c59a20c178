"""Small literal rows in the shapes of the operators, and feeding them to streams."""

from __future__ import annotations

from tidemill import schemas

LOG_ROW = schemas.LOG + ", place BIGINT"


def page(mid, ts, last=None, place=0, page_id="home", is_new="0", displays=None, item=None,
         item_type=None, during=1, **common):
    common = {"ar": "1", "ba": "b", "ch": "c", "is_new": is_new, "md": "m", "mid": mid,
              "os": "o", "uid": "1", "vc": "v"} | common
    return {"common": common, "start": None,
            "page": {"during_time": during, "item": item, "item_type": item_type,
                     "last_page_id": last, "page_id": page_id},
            "displays": displays, "ts": ts, "place": place}


def display(item, item_type="sku_id", order=1):
    return {"display_type": "query", "item": item, "item_type": item_type, "order": order,
            "pos_id": 1}


def pages(spark, rows):
    return spark.createDataFrame(rows, LOG_ROW)


def stream_of(spark, df, folder, parts):
    """A stream over ``df`` that arrives as the given row lists, one file per micro-batch."""
    for rows in parts:
        spark.createDataFrame(rows, df).coalesce(1).write.mode("append").parquet(folder)
    return (spark.readStream.schema(spark.createDataFrame([], df).schema)
            .option("maxFilesPerTrigger", "1").parquet(folder))


def split_evenly(rows, n):
    size = -(-len(rows) // n)
    return [rows[i:i + size] for i in range(0, len(rows), size)]
