"""Schemas of the input tables."""

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


LOG = _schema(
    user_id=T.LongType(),
    item_id=T.LongType(),
    cat_id=T.LongType(),
    seller_id=T.LongType(),
    brand_id=T.IntegerType(),
    time_stamp=T.IntegerType(),
    action_type=T.IntegerType(),
)
USER_INFO = _schema(user_id=T.LongType(), age_range=T.IntegerType(), gender=T.IntegerType())
LABELLED_PAIRS = _schema(user_id=T.LongType(), merchant_id=T.LongType(), label=T.IntegerType())
UNLABELLED_PAIRS = _schema(user_id=T.LongType(), merchant_id=T.LongType())
FORMAT2 = LABELLED_PAIRS
SCORES = _schema(user_id=T.LongType(), seller_id=T.LongType(), prob=T.DoubleType())
ID_MAPPING = _schema(raw_id=T.LongType(), dense_id=T.LongType())
EMBEDDING = _schema(entity=T.StringType(), id=T.LongType(), embedding=T.ArrayType(T.FloatType()))

# Action codes (fixed values).
CLICK, CART, BUY, LIKE = 0, 1, 2, 3
