"""Explicit schemas of every table the library reads or writes."""

from pyspark.sql import types as T

# A vocabulary beyond this is refused: it would no longer be a small constant in every task.
MAX_VOCAB = 2_000_000


def _table(*fields):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


DOCUMENTS = _table(
    ("doc_id", T.LongType(), True),
    ("text", T.StringType(), True),
    ("lang", T.StringType(), True),
    ("source", T.StringType(), True),
    ("n_chars", T.LongType(), True),
)

VOCAB = _table(("token_id", T.IntegerType(), False), ("token", T.BinaryType(), False))

# Merges as the trainer commits them: hex symbols and the count each pair had.
HEX_MERGES = _table(
    ("rank", T.IntegerType(), False),
    ("l", T.StringType(), False),
    ("r", T.StringType(), False),
    ("n", T.LongType(), False),
)

NAMED_TOKENS = _table(("token_id", T.IntegerType(), False), ("t", T.StringType(), False))

COMMITTED = _table(
    ("step", T.IntegerType(), False),
    ("tables", T.ArrayType(T.StringType()), False),
    ("fingerprint", T.StringType(), False),
)

# Nodes of a digest tree.
DIGESTS = _table(
    ("level", T.IntegerType(), True),
    ("node", T.LongType(), True),
    ("n_rows", T.LongType(), True),
    ("total", T.DecimalType(38, 0), True),
    ("mixed", T.LongType(), True),
)

# Runs of running sums, oldest first.
RUNS = _table(("place", T.IntegerType(), False), ("path", T.StringType(), False), ("n_rows", T.LongType(), False))

TRACE = _table(
    ("step", T.IntegerType(), False),
    ("rate", T.DoubleType(), False),
    ("loss", T.DoubleType(), False),
    ("grad_norm", T.DoubleType(), False),
)

STATE = _table(
    ("name", T.StringType(), False),
    ("idx", T.IntegerType(), False),
    ("value", T.DoubleType(), False),
)
