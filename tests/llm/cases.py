"""Small document tables with the awkward cases that every operator must take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{k % 997}" for k in range(20_000))
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + k * k + k * seed) % len(WORDS)] + str((seed * 31 + k) % 9973) for k in range(n))


ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n ", "en", "a", 4),
    (4, "One word", "en", "b", 8),
    (4, "One word", "en", "b", 8),
    (5, "ONE WORD", "en", "b", 8),
    (None, "one word", None, "b", 8),
    (None, None, None, None, None),
    (6, "İstanbul ÉCOLE straße", "tr", "c", 21),
    (7, LONG, "en", "c", len(LONG)),
    (8, "x" * 30_000, "en", "c", 30_000),
    (-9, "a\x00b \x1f c d 😀", "en", "a", 9),
]
PLAIN = [(100 + k, sentence(k, 60 + k), "en", "abc"[k % 3], 0) for k in range(40)]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def odd(spark):
    return table(spark, ODD + PLAIN)


def empty(spark):
    return table(spark, [])


def clashing(spark):
    """Documents whose further columns have names that operators use inside."""
    from pyspark.sql import functions as F

    names = ["row", "copy", "kept", "level", "name", "root", "score", "draw", "node"]
    return table(spark, PLAIN).select("*", *(F.lit(k).alias(n) for k, n in enumerate(names)))


def on_disk(frame, folder, more=None):
    """A folder that queries can read: ``documents`` and, if given, ``labels``."""
    frame.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    if more is not None:
        more.write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return str(folder)
