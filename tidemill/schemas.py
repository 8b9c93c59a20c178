"""Record layouts, as Spark DDL text. Money is DECIMAL(16,2)."""

LOG = """
    common STRUCT<ar: STRING, ba: STRING, ch: STRING, is_new: STRING, md: STRING,
                  mid: STRING, os: STRING, uid: STRING, vc: STRING>,
    start STRUCT<entry: STRING, loading_time: BIGINT, open_ad_id: BIGINT,
                 open_ad_ms: BIGINT, open_ad_skip_ms: BIGINT>,
    page STRUCT<during_time: BIGINT, item: STRING, item_type: STRING,
                last_page_id: STRING, page_id: STRING>,
    displays ARRAY<STRUCT<display_type: STRING, item: STRING, item_type: STRING,
                          `order`: BIGINT, pos_id: BIGINT>>,
    ts BIGINT
"""

PAGE_VIEW = "common MAP<STRING, STRING>, page MAP<STRING, STRING>, ts BIGINT"

CHANGE = """
    op STRING, source STRUCT<db: STRING, `table`: STRING>,
    before MAP<STRING, STRING>, after MAP<STRING, STRING>, ts_ms BIGINT
"""

RULE = """
    sourceTable STRING, operateType STRING, sinkType STRING, sinkTable STRING,
    sinkColumns STRING, sinkPk STRING, sinkExtend STRING
"""

ORDER_INFO = """
    id BIGINT, province_id BIGINT, order_status STRING, user_id BIGINT,
    total_amount DECIMAL(16,2), activity_reduce_amount DECIMAL(16,2),
    coupon_reduce_amount DECIMAL(16,2), original_total_amount DECIMAL(16,2),
    feight_fee DECIMAL(16,2), expire_time STRING, create_time STRING, operate_time STRING
"""

ORDER_DETAIL = """
    id BIGINT, order_id BIGINT, sku_id BIGINT, order_price DECIMAL(16,2), sku_num BIGINT,
    sku_name STRING, create_time STRING, split_total_amount DECIMAL(16,2),
    split_activity_amount DECIMAL(16,2), split_coupon_amount DECIMAL(16,2)
"""

PAYMENT_INFO = """
    id BIGINT, order_id BIGINT, user_id BIGINT, total_amount DECIMAL(16,2), subject STRING,
    payment_type STRING, create_time STRING, callback_time STRING
"""

CART_OR_FAVOR = "sku_id BIGINT, create_time STRING"
REFUND = "order_id BIGINT, sku_id BIGINT, refund_amount DECIMAL(16,2), create_time STRING"
COMMENT = "sku_id BIGINT, appraise STRING, create_time STRING"

ORDER_WIDE = """
    detail_id BIGINT, order_id BIGINT, sku_id BIGINT, order_price DECIMAL(16,2),
    sku_num BIGINT, sku_name STRING, province_id BIGINT, order_status STRING, user_id BIGINT,
    total_amount DECIMAL(16,2), activity_reduce_amount DECIMAL(16,2),
    coupon_reduce_amount DECIMAL(16,2), original_total_amount DECIMAL(16,2),
    feight_fee DECIMAL(16,2), split_feight_fee DECIMAL(16,2),
    split_activity_amount DECIMAL(16,2), split_coupon_amount DECIMAL(16,2),
    split_total_amount DECIMAL(16,2), expire_time STRING, create_time STRING,
    operate_time STRING, create_date STRING, create_hour STRING, province_name STRING,
    province_area_code STRING, province_iso_code STRING, province_3166_2_code STRING,
    user_age INT, user_gender STRING, spu_id BIGINT, tm_id BIGINT, category3_id BIGINT,
    spu_name STRING, tm_name STRING, category3_name STRING
"""

# The statistics in the column order of their target tables.
VISITOR_STATS = ["stt", "edt", "vc", "ch", "ar", "is_new",
                 "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts"]
PRODUCT_STATS = ["stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name",
                 "tm_id", "tm_name", "category3_id", "category3_name", "display_ct",
                 "click_ct", "favor_ct", "cart_ct", "order_sku_num", "order_amount",
                 "order_ct", "payment_amount", "paid_order_ct", "refund_order_ct",
                 "refund_amount", "comment_ct", "good_comment_ct", "ts"]
PROVINCE_STATS = ["stt", "edt", "province_id", "province_name", "province_area_code",
                  "province_iso_code", "province_3166_2_code", "order_amount",
                  "order_count", "ts"]
KEYWORD_STATS = ["stt", "edt", "keyword", "source", "ct", "ts"]
PAYMENT_WIDE = ["payment_id", "subject", "payment_type", "payment_create_time",
                "callback_time", "detail_id", "order_id", "sku_id", "order_price", "sku_num",
                "sku_name", "province_id", "order_status", "user_id", "total_amount",
                "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
                "feight_fee", "split_feight_fee", "split_activity_amount",
                "split_coupon_amount", "split_total_amount", "order_create_time",
                "province_name", "province_iso_code", "province_3166_2_code", "user_age",
                "user_gender", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name",
                "category3_name"]
