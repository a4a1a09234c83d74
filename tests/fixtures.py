"""Small inline inputs."""

GOOD = ["harika film çok güzel", "güzel ve harika oyun", "çok iyi film harika", "iyi güzel müzik harika"]
BAD = ["kötü film berbat", "berbat ve sıkıcı oyun", "çok kötü müzik berbat", "sıkıcı berbat kötü"]


def sentiment_rows():
    """Separable rows of two classes, with a missing and an empty text."""
    rows = []
    for i in range(24):
        good = i % 2 == 0
        texts = GOOD if good else BAD
        rows.append((i, texts[(i // 2) % 4] + f" kelime{i % 3}", 1 if good else 0, "a" if i < 8 else "b"))
    return rows + [(24, None, 1, "a"), (25, "", 0, None)]


def sentiment(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(sentiment_rows(), "doc_id bigint, text string, label int, dataset string")
    return df.withColumn("split", F.when(F.col("doc_id") % 5 == 3, "test").otherwise("train"))
