"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept. All but the last
return the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.llm import decontaminate, line_dedup, ngram_join, packing, quality
from ledgerpulse.llm.common import held_out, likely_in, stored, table
from ledgerpulse.llm.tokens import tokenizer_path


def _apart(docs: DataFrame) -> DataFrame:
    """doc_id, text and everything else in one column, so that no name can clash."""
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("doc_id"), *others).alias("_others"))


def _whole(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[c if c in ("doc_id", "text") else F.col(f"_others.`{c}`") for c in columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents the quality classifier rejects; learns from the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").filter(~held_out(4, 2))
    model = quality.fit(quality.training_rows(docs, labels, "quality"))
    scored = _apart(docs).withColumn("_score", quality.quality_score(spark, model))
    return _whole(scored.filter(F.col("_score") >= quality.THRESHOLD), docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that stand in many documents from all but one of them; n_chars follows the text, null stays null."""
    index = line_dedup.LineIndex(spark).insert(docs)
    rows = index.dedup(_apart(docs)).withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept")))
    out = _whole(rows, docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by similarity the one with the smallest doc_id stays.

    Rows with the same doc_id stay or go together; of equal rows among them one stays. Rows without
    words or doc_id belong to no group and stay.
    """
    groups = stored(ngram_join.similarity_components(docs.select("doc_id", "text")), "groups")
    dropped = groups.filter("component_id <> doc_id").select("doc_id").distinct()
    repeated = groups.filter("n_shingles > 0 and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    touched = stored(dropped.unionByName(repeated).distinct(), "touched")
    test = F.col("doc_id").isNotNull() & likely_in(touched, "doc_id")(F.col("doc_id"))
    rows = _apart(docs)
    some = rows.filter(test).join(dropped, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"])
    return _whole(rows.filter(~test).unionByName(some), docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold too much of the benchmark."""
    found = decontaminate.match_benchmark(_apart(docs), table(spark, sf_dir, "benchmark"))
    return _whole(found.filter(~decontaminate.contaminated()), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their sequence and their place there."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: The classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
