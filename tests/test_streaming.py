"""Feed folder pick-up: new files only, same rules as the batch path."""

import os

from tallyhouse import constants as C
from tallyhouse.plans.extracts import ADJUSTMENTS_CSV_SCHEMA, extract_adjustments
from tallyhouse.plans.validate import validate_adjustments
from tallyhouse.session import scratch_path
from tallyhouse.streaming import ingest_feed

HEADER = "year,month,store_id,store_name,product_id,physical_stock,system_stock,adjustment,reason\n"


def test_feed_picks_up_new_files_once(spark):
    base = scratch_path(spark, "feed")
    folder = base.replace("file:", "") + "/in"
    os.makedirs(folder)
    stores = spark.createDataFrame([(1,)], "store_id int")
    products = spark.createDataFrame([(7,)], "product_id long")

    def transform(df):
        return validate_adjustments(extract_adjustments(df, "2024-01-01 00:00:00"), stores, products)

    with open(f"{folder}/a.csv", "w") as f:
        f.write(HEADER + "2024,1,1,S,7,5,3,2,Merma\n2024,1,1,S,7,3,3,0,Nada\n")
    target, ckpt = f"{base}/stg", f"{base}/ckpt"
    assert ingest_feed(spark, folder, ADJUSTMENTS_CSV_SCHEMA, transform, target, ckpt) == 1
    with open(f"{folder}/b.csv", "w") as f:
        f.write(HEADER + "2024,2,9,S,7,1,2,-1,error\n")
    assert ingest_feed(spark, folder, ADJUSTMENTS_CSV_SCHEMA, transform, target, ckpt) == 1
    # nothing new: no batch
    assert ingest_feed(spark, folder, ADJUSTMENTS_CSV_SCHEMA, transform, target, ckpt) == 0
    rows = spark.read.parquet(target).collect()
    got = sorted((r["adjustment"], r["stg_status"], r["stg_message"]) for r in rows)
    assert got == sorted([(2, C.VALID, None), (0, C.REJECTED, C.MSG_ADJ_ZERO),
                          (-1, C.REJECTED, C.MSG_ADJ_STORE)])
