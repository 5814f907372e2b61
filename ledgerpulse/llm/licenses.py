"""License scans with DataFrame functions only.

A block is a window of consecutive words anywhere in the text, line breaks and signs ignored; a template is
a license notice. Both are sets of words. A block may be longer than the template by as many words as the
template may miss, and matches when it holds at least `CONTAINMENT` of the template's words. Words are
ordered by their number in the whole corpus, rarest first. A match must hold a word within the prefix of the
template's order (prefix filter), so only the words around such a place are looked at. They must hold enough
template words at all (length filter), and a window must begin with a template word from which that place
is in reach (positional filter). What is left is counted exactly.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import stored, table

CONTAINMENT = 0.9
# fixed values: words of the phrases and their labels
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# fixed values: notices in common use and their labels
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _BETWEEN), "")


def _array(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def needed(template: str, containment: float = CONTAINMENT) -> int:
    """Words of the template that a block must hold."""
    return ceil(containment * len(set(template.split())) - 1e-9)


def window(template: str, containment: float = CONTAINMENT) -> int:
    """Words of a block for the template: as many more as the template may miss."""
    return ceil(len(template.split()) / containment - 1e-9)


def word_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """Template words by their number over all documents, rarest first; ties by word."""
    found = (docs.select(F.explode(_words(F.translate("text", _UPPER, _LOWER))).alias("word"))
             .filter(F.col("word").isin(vocabulary)).groupBy("word").count())
    counts = dict(found.collect())  # a row per template word
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _surroundings(words: Column, prefix: list[str], vocabulary: list[str], most: int) -> Column:
    """For each prefix word: its place, where the words around it begin, and those (empty if in no template)."""
    places = F.filter(F.transform(words, lambda w, i: F.when(w.isin(prefix), i)), lambda i: i.isNotNull())

    def around(i: Column) -> Column:
        begin = F.greatest(i - (most - 1), F.lit(0))
        held = F.transform(F.slice(words, begin + 1, i - begin + most), lambda w: F.when(w.isin(vocabulary), w).otherwise(""))
        return F.struct(i.alias("at"), begin.alias("begin"), held.alias("words"))

    return F.transform(places, around)


def _held(words: Column, begin: Column, size: Column) -> Column:
    """Number of template words among `size` words from `begin` on."""
    return F.size(F.array_intersect(F.slice(words, begin + 1, size), F.col("t_words")))


def _windows() -> Column:
    """Matching windows around a place: the shortest end that matches, first word and words held in the whole window."""
    words, wide, at = F.col("words"), F.col("wide"), F.col("at") - F.col("begin")
    starts = F.filter(F.sequence(F.greatest(at - wide + 1, F.lit(0)), at), lambda i: F.array_contains("t_words", F.get(words, i)))
    found = F.filter(F.transform(starts, lambda i: F.struct(i.alias("i"), _held(words, i, wide).alias("held"))),
                     lambda s: s["held"] >= F.col("least"))
    return F.transform(found, lambda s: F.struct(
        (F.col("begin") + s["i"] + F.array_min(F.filter(F.sequence(F.col("least"), wide), lambda n: _held(words, s["i"], n) >= F.col("least")))).alias("end"),
        (F.col("begin") + s["i"]).alias("start"), s["held"].alias("held")))


def _apart(windows: Column) -> Column:
    """The largest number of windows (end, start), sorted, that share no word."""
    return F.reduce(windows, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
                    lambda s, w: F.when(w["start"] >= s["end"], F.struct((s["n"] + 1).alias("n"), w["end"].alias("end"))).otherwise(s),
                    lambda s: s["n"])


def phrase_places(words: Column, text: Column) -> Column:
    """Starts and labels of the phrases; looks only where the text holds the word license."""
    def at(i: Column, back: int) -> Column:
        return F.get(words, i - back)

    last = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i) == "license")
    found = F.flatten(F.transform(last, lambda i: F.array(*[
        F.when(F.reduce(_array(phrase.split()[::-1][1:]), F.struct(F.lit(1).alias("k"), F.lit(True).alias("ok")),
                        lambda s, w: F.struct((s["k"] + 1).alias("k"), (s["ok"] & F.coalesce(at(i, s["k"]) == w, F.lit(False))).alias("ok")),
                        lambda s: s["ok"]),
               F.struct((i - (len(phrase.split()) - 1)).cast("long").alias("start"), F.lit(label).alias("label")))
        for phrase, label in PHRASES])))
    none = F.array().cast("array<struct<start: bigint, label: string>>")
    return F.when(F.contains(text, F.lit("license")) & (F.size(words) > 0), F.filter(found, lambda x: x.isNotNull())).otherwise(none)


def scan_licenses(docs: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks.

    `score` is the highest containment of a matching block, else 0; n_blocks is the largest number of matching
    blocks without a common word. A null or empty text has no words and no labels. Rows with the same doc_id are separate.
    """
    spark = docs.sparkSession
    templates = [(i, label, sorted(set(text.split())), needed(text, containment), window(text, containment))
                 for i, (text, label) in enumerate(TEMPLATES)]
    vocabulary = sorted({w for _, _, words, *_ in templates for w in words})
    rank = {w: k for k, w in enumerate(word_order(docs, vocabulary))}
    # the index of template prefixes is as small as the list of templates
    prefixes = [(w, label, words, n, wide) for _, label, words, n, wide in templates
                for w in sorted(words, key=rank.get)[:len(words) - n + 1]]
    index = spark.createDataFrame(prefixes, "word string, label string, t_words array<string>, least int, wide int")

    lower = docs.select("doc_id", F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER).alias("text"))
    split = lower.withColumn("words", _words(F.col("text")))
    around = _surroundings(F.col("words"), sorted({w for w, *_ in prefixes}), vocabulary, max(wide for *_, wide in templates))
    rows = stored(split.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"),
        phrase_places(F.col("words"), F.col("text")).alias("places"), around.alias("around")), "license-blocks")

    at, wide = F.col("at") - F.col("begin"), F.col("wide")
    low = F.greatest(at - wide + 1, F.lit(0))
    matches = (rows.select("row", F.inline("around")).withColumn("word", F.get("words", at))
               .join(F.broadcast(index), "word")
               .filter(_held(F.col("words"), low, at - low + wide) >= F.col("least"))
               .select("row", "label", F.size("t_words").alias("t_size"), F.inline(_windows())))
    found = matches.groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max(F.col("held") / F.col("t_size")).alias("score"),
        _apart(F.array_sort(F.collect_set(F.struct("end", "start")))).alias("n_blocks"))
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    starts = F.transform("places", lambda p: p["start"])
    none = F.array().cast("array<string>")
    return rows.join(found, "row", "left").select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("found", none))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"))


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
