"""Small awkward tables that every operator must take."""


SCHEMA = "doc_id long, text string, source string, lang string"
# extra columns with names that operators use themselves
CLASHING = ["id", "key", "host", "hash", "digest", "label", "size", "n", "kept", "lost", "norm", "piece", "bands", "bucket", "band", "leader", "line", "mix_size", "shard", "slot", "score", "keep_id", "group_size", "class_id", "kept_text", "n_lines"]

LONG_LINE = "this line is long enough to be a boilerplate line of many documents"
BODY = " ".join(f"word{k}" for k in range(60))
ROWS = [
    (1, BODY, "a", "en"),
    (2, None, "a", None),
    (3, "", None, "en"),
    (4, BODY.replace(" ", "  \t"), "a", "en"),
    (5, BODY + " tail", "b", "en"),
    (5, BODY + " tail", "b", "en"),  # a repeated row
    (None, BODY, "b", "en"),
    (None, None, None, None),
    (6, " \n\t ", "c", "en"),
    (7, "one two", "c", "en"),
    (8, "x" * 200_000 + " " + "y " * 50_000, "c", "en"),
    (9, "naïve 日本語 😀 \ud83d".encode("utf-8", "ignore").decode(), "c", "en"),
    (10, "a\n\n" + LONG_LINE + "\n" + LONG_LINE.upper() + "\n", "a", "en"),
]


def awkward(spark, extra: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING}) if extra else df


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def all_null(spark):
    return spark.createDataFrame([(None, None, None, None)] * 3, SCHEMA)
