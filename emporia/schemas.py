"""Fixed schemas of the raw (ODS) tables, as Spark DDL strings.

Fixed values: column names, order and types of the source system's tables.
Column order matters for the tab-delimited snapshots. ``dt`` (``yyyy-MM-dd``
string) is the partition column of every table and is not listed here.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

MONEY = "DECIMAL(16,2)"

# ---------------------------------------------------------------- app log
LOG = (
    "common STRUCT<ar: STRING, ba: STRING, ch: STRING, is_new: STRING, md: STRING, mid: STRING, os: STRING,"
    " uid: STRING, vc: STRING>,"
    " page STRUCT<during_time: STRING, item: STRING, item_type: STRING, last_page_id: STRING, page_id: STRING,"
    " source_type: STRING>,"
    " actions ARRAY<STRUCT<action_id: STRING, item: STRING, item_type: STRING, ts: BIGINT>>,"
    " displays ARRAY<STRUCT<display_type: STRING, item: STRING, item_type: STRING, `order`: STRING, pos_id: STRING>>,"
    " `start` STRUCT<entry: STRING, loading_time: BIGINT, open_ad_id: BIGINT, open_ad_ms: BIGINT,"
    " open_ad_skip_ms: BIGINT>,"
    " err STRUCT<error_code: BIGINT, msg: STRING>,"
    " ts BIGINT"
)

# ------------------------------------------------------- daily full snapshots
SNAPSHOTS = {
    "activity_info": "id STRING, activity_name STRING, activity_type STRING, activity_desc STRING, start_time STRING, end_time STRING, create_time STRING",
    "activity_rule": f"id STRING, activity_id STRING, activity_type STRING, condition_amount {MONEY}, condition_num BIGINT, benefit_amount {MONEY}, benefit_discount {MONEY}, benefit_level STRING",
    "base_category1": "id STRING, name STRING",
    "base_category2": "id STRING, name STRING, category1_id STRING",
    "base_category3": "id STRING, name STRING, category2_id STRING",
    "base_dic": "dic_code STRING, dic_name STRING, parent_code STRING, create_time STRING, operate_time STRING",
    "base_province": "id STRING, name STRING, region_id STRING, area_code STRING, iso_code STRING, iso_3166_2 STRING",
    "base_region": "id STRING, region_name STRING",
    "base_trademark": "id STRING, tm_name STRING, logo_url STRING",
    "cart_info": f"id STRING, user_id STRING, sku_id STRING, cart_price {MONEY}, sku_num BIGINT, img_url BIGINT, sku_name STRING, is_checked STRING, create_time STRING, operate_time STRING, is_ordered STRING, order_time STRING, source_type STRING, source_id STRING",
    "coupon_info": f"id STRING, coupon_name STRING, coupon_type STRING, condition_amount {MONEY}, condition_num BIGINT, activity_id STRING, benefit_amount {MONEY}, benefit_discount {MONEY}, create_time STRING, range_type STRING, limit_num BIGINT, taken_count BIGINT, start_time STRING, end_time STRING, operate_time STRING, expire_time STRING",
    "sku_attr_value": "id STRING, attr_id STRING, value_id STRING, sku_id STRING, attr_name STRING, value_name STRING",
    "sku_info": f"id STRING, spu_id STRING, price {MONEY}, sku_name STRING, sku_desc STRING, weight {MONEY}, tm_id STRING, category3_id STRING, sku_default_igm STRING, is_sale STRING, create_time STRING",
    "sku_sale_attr_value": "id STRING, sku_id STRING, spu_id STRING, sale_attr_value_id STRING, sale_attr_id STRING, sale_attr_name STRING, sale_attr_value_name STRING",
    "spu_info": "id STRING, spu_name STRING, description STRING, category3_id STRING, tm_id STRING",
}

# Staging table of the calendar (prepared TSV, no dt partition).
DATE_INFO = ("date_id STRING, week_id STRING, week_day STRING, day STRING, month STRING, quarter STRING, "
             "year STRING, is_workday STRING, holiday_id STRING")

# ------------------------------------------------- row changes: ``data`` struct
CHANGE_DATA = {
    "cart_info": f"id STRING, user_id STRING, sku_id STRING, cart_price {MONEY}, sku_num BIGINT, img_url STRING, sku_name STRING, is_checked STRING, create_time STRING, operate_time STRING, is_ordered STRING, order_time STRING, source_type STRING, source_id STRING",
    "comment_info": "id STRING, user_id STRING, nick_name STRING, head_img STRING, sku_id STRING, spu_id STRING, order_id STRING, appraise STRING, comment_txt STRING, create_time STRING, operate_time STRING",
    "coupon_use": "id STRING, coupon_id STRING, user_id STRING, order_id STRING, coupon_status STRING, get_time STRING, using_time STRING, used_time STRING, expire_time STRING",
    "favor_info": "id STRING, user_id STRING, sku_id STRING, spu_id STRING, is_cancel STRING, create_time STRING, cancel_time STRING",
    "order_detail": f"id STRING, order_id STRING, sku_id STRING, sku_name STRING, img_url STRING, order_price {MONEY}, sku_num BIGINT, create_time STRING, source_type STRING, source_id STRING, split_total_amount {MONEY}, split_activity_amount {MONEY}, split_coupon_amount {MONEY}",
    "order_detail_activity": "id STRING, order_id STRING, order_detail_id STRING, activity_id STRING, activity_rule_id STRING, sku_id STRING, create_time STRING",
    "order_detail_coupon": "id STRING, order_id STRING, order_detail_id STRING, coupon_id STRING, coupon_use_id STRING, sku_id STRING, create_time STRING",
    "order_info": f"id STRING, consignee STRING, consignee_tel STRING, total_amount {MONEY}, order_status STRING, user_id STRING, payment_way STRING, delivery_address STRING, order_comment STRING, out_trade_no STRING, trade_body STRING, create_time STRING, operate_time STRING, expire_time STRING, process_status STRING, tracking_no STRING, parent_order_id STRING, img_url STRING, province_id STRING, activity_reduce_amount {MONEY}, coupon_reduce_amount {MONEY}, original_total_amount {MONEY}, freight_fee {MONEY}, freight_fee_reduce {MONEY}, refundable_time {MONEY}",
    "order_refund_info": f"id STRING, user_id STRING, order_id STRING, sku_id STRING, refund_type STRING, refund_num BIGINT, refund_amount {MONEY}, refund_reason_type STRING, refund_reason_txt STRING, refund_status STRING, create_time STRING",
    "order_status_log": "id STRING, order_id STRING, order_status STRING, operate_time STRING",
    "payment_info": f"id STRING, out_trade_no STRING, order_id STRING, user_id STRING, payment_type STRING, trade_no STRING, total_amount {MONEY}, subject STRING, payment_status STRING, create_time STRING, callback_time STRING, callback_content STRING",
    "refund_payment": f"id STRING, out_trade_no STRING, order_id STRING, sku_id STRING, payment_type STRING, trade_no STRING, total_amount {MONEY}, subject STRING, refund_status STRING, create_time STRING, callback_time STRING, callback_content STRING",
    "user_info": "id STRING, login_name STRING, nick_name STRING, passwd STRING, name STRING, phone_num STRING, email STRING, head_img STRING, user_level STRING, birthday STRING, gender STRING, create_time STRING, operate_time STRING, status STRING",
}


def change_schema(table: str) -> str:
    """``type, ts (seconds), data STRUCT<...>, old MAP<STRING,STRING>`` for one change table."""
    fields = ", ".join(f"{f.split(' ', 1)[0]}: {f.split(' ', 1)[1]}" for f in CHANGE_DATA[table].split(", "))
    return f"type STRING, ts BIGINT, data STRUCT<{fields}>, old MAP<STRING, STRING>"


def struct_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
