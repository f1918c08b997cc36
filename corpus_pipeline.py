"""From raw documents to packed training sequences, in five stages.

Every stage takes what its predecessor kept and is written before the next one starts,
so a lost executor costs at most one stage's running tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.llm import divergence, line_dedup, ngram_join, packing, suffix_decontam
from gaugeline.llm.queries import table, tokenizer_path
from gaugeline.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or diverge from their language."""
    return divergence.keep(docs)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops boilerplate lines of a source; ``n_chars`` follows the text.

    Copies count as one page: their lines stay, and the next stage keeps one of them.
    """
    rows = line_dedup.cleaned(docs, copies_once=True)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group of linked documents."""
    # Written, so that Spark broadcasts the ids only if they are few.
    dropped = materialise(ngram_join.linked(docs).where(
        F.col("doc_id") != F.col("component_id")).select("doc_id"), "near-copies")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark passages."""
    return suffix_decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows with the ids of their pieces."""
    return packing.packed(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", without_boilerplate),
    ("n-gram join", without_near_copies),
    ("decontamination", decontaminated),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The join by connected components and the packing have no SQL; the tests hold ``run``
#: against a brute-force version.
ORACLE_SQL = None
