"""Explicit schemas; nothing is inferred."""

from pyspark.sql import types as T

# Raw record as text, the way it arrives in CSV files.
RAW_TEXT = T.StructType(
    [
        T.StructField("transition_date", T.StringType()),
        T.StructField("transition_hour", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("line_name", T.StringType()),
        T.StructField("town", T.StringType()),
        T.StructField("number_of_passenger", T.StringType()),
        T.StructField("number_of_passage", T.StringType()),
    ]
)

# Raw record after casting.
RAW = T.StructType(
    [
        T.StructField("transition_date", T.DateType()),
        T.StructField("transition_hour", T.IntegerType()),
        T.StructField("line", T.StringType()),
        T.StructField("line_name", T.StringType()),
        T.StructField("town", T.StringType()),
        T.StructField("number_of_passenger", T.DoubleType()),
        T.StructField("number_of_passage", T.DoubleType()),
    ]
)

RAW_COLUMNS = tuple(f.name for f in RAW.fields)

# Isolation-tree node table: one row per node, heap numbering (root 1,
# children 2i and 2i+1).  Leaves carry their path length in integer units
# of 1e-9 so that sums over trees are exact and order independent.
NODES = T.StructType(
    [
        T.StructField("tree_id", T.IntegerType(), False),
        T.StructField("node_id", T.LongType(), False),
        T.StructField("depth", T.IntegerType(), False),
        T.StructField("size", T.LongType(), False),
        T.StructField("is_leaf", T.BooleanType(), False),
        T.StructField("feature", T.IntegerType()),
        T.StructField("split", T.DoubleType()),
        T.StructField("path_units", T.LongType()),
    ]
)

PATH_UNIT = 1_000_000_000  # path lengths are stored as round(path * 1e9)
