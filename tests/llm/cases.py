"""Documents that operators must survive: nulls, empty and very long texts, ties, repeated rows, clashing names."""

LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(40_000))
LINE = "a line that stands in many documents"
CLASH = ("found", "kept", "n_words", "n_lines", "score", "row", "c", "piece", "_row", "lang_pred")

ROWS = [
    (0, None, "en"), (1, "", "en"), (2, "   \n\t \n", None), (3, LONG, "en"), (4, f"{LINE}\nThe cat sat on the mat today", "en"),
    (5, f"  {LINE.upper()}\t\nDer Hund lief durch den tiefen Wald", "de"), (6, f"{LINE}\n{LINE}\nx", "en"), (6, f"{LINE}\n{LINE}\nx", "en"),
    (7, "The cat sat on the mat today", "en"), (8, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.", None),
    (9, "été naïve ① ² über ñandú ІΣς " * 3, "fr"), (10, LONG, "en"), (11, "a  b\x1c\tc\r\nd e  \n\n e <|endoftext|>", "en"),
    (None, "no id but a text that is long enough to count", "en"),
]


def documents(spark, rows=ROWS, clash=True):
    df = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({name: F.lit("clash") for name in CLASH})
    return df


def tables(folder, **frames):
    """Writes tables where a query can read them."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
