"""Small frames with the awkward rows that every operator must take."""

import re

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
EXTRA = ["key", "size", "score", "rank", "block", "row", "n", "value", "label", "start", "length", "__text", "__chunk", "shard", "to", "rule"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in EXTRA]
)
LONG = " ".join(f"word{k % 997} runs on" for k in range(20_000))
ENGLISH = "The river runs past the old mill and the children play there every day of the long summer."
ROWS = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "123 456 !!", "de"), (5, "a", None), (6, LONG, "en"),
    (7, ENGLISH, "en"), (8, ENGLISH, "en"), (9, ENGLISH + " Again.", "en"), (9, ENGLISH + " Again.", "en"), (None, "No id here, and some more words.", "en"),
    (10, "Größe über alles, niñé ça va 東京 ok", None), (11, "\U0001f600 smile \u00a0 twice", "en"), (-3, ENGLISH.upper(), "en"),
]


def awkward(spark):
    return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in ROWS], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def ascii_lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
