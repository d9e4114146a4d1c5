"""Column names, types and fixed label values of the behaviour log."""

from pyspark.sql import types as T

BEHAVIOR_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType(), False),
    T.StructField("user_log_acct", T.StringType(), True),
    T.StructField("item_sku_id", T.LongType(), True),
    T.StructField("action_time", T.TimestampNTZType(), True),
    T.StructField("action_type", T.IntegerType(), True),
    T.StructField("brand_code", T.StringType(), True),
    T.StructField("shop_id", T.LongType(), True),
    T.StructField("item_third_cate_cd", T.StringType(), True),
    T.StructField("vender_id", T.LongType(), True),
    T.StructField("shop_score", T.DoubleType(), True),
    T.StructField("age", T.DoubleType(), True),
    T.StructField("sex", T.IntegerType(), True),
    T.StructField("user_level", T.IntegerType(), True),
    T.StructField("province", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("county", T.StringType(), True),
])

BEHAVIOR_COLUMNS = [f.name for f in BEHAVIOR_SCHEMA.fields]

# Fixed values that must equal the reference's for equal results.
# The 22 model features, in model order.
FEATURES = [
    "brand_code", "shop_id", "item_third_cate_cd", "vender_id", "shop_score",
    "age", "sex", "user_level", "province", "city", "county", "hour", "day",
    "month", "dayofweek", "user_item_count", "user_action_mean", "user_shop_nunique",
    "user_brand_nunique", "user_cate_nunique", "item_user_count", "item_action_mean",
]
# Label-encoded columns of the 22-feature path.
CATEGORICALS = ["brand_code", "shop_id", "item_third_cate_cd", "vender_id", "province", "city", "county"]
# Label-encoded columns of the rich path (adds the hour bucket).
RICH_CATEGORICALS = CATEGORICALS + ["hour_category"]
# Identifier columns left out of the rich feature matrix (plus our label columns).
RICH_EXCLUDED = ["user_log_acct", "item_sku_id", "action_time", "action_type"]
# Zero-based class -> action name (class k is action_type k+1).
ACTION_NAMES = {0: "浏览", 1: "购买", 2: "收藏", 3: "加购物车", 4: "其他行为"}
# Name used for a class outside ACTION_NAMES.
UNKNOWN_ACTION = "未知行为"
# Hour buckets: bins (0,6], (6,12], (12,18], (18,24]; hour 0 falls in none.
HOUR_BUCKET_EDGES = [0, 6, 12, 18, 24]
HOUR_BUCKET_LABELS = ["凌晨", "上午", "下午", "晚上"]
# Binary confidence: very high, high, medium.  Multi-class adds low.
CONFIDENCE_LABELS = ["非常高", "高", "中等", "低"]
# Binary outcome text: will purchase / will not purchase.
BINARY_OUTCOME_LABELS = ["购买", "不会购买"]
# Time text format of the log.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Fill values for missing data: text and everything else.
TEXT_FILL = "unknown"
OTHER_FILL = -1
NUM_CLASSES = 5
PURCHASE_ACTION = 2
