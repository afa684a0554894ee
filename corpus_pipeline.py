"""The corpus pipeline: quality filter, line dedup, near-dedup, decontamination, mixing.

Every stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.llm import decontaminate, line_dedup, mixing, quality, simhash
from shopmart.llm._store import stored


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(rows: DataFrame, columns: list[str], text=None) -> DataFrame:
    """The columns of documents from ``row``, with another text if given (``n_chars`` follows it)."""
    made = {} if text is None else {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[made.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score 0.3 or more); it learns from the labelled rows outside the test fold."""
    train = quality.training_rows(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0), _read(spark, sf_dir, "labels"))
    return _documents(quality.score(docs, quality.fit(train), docs.columns).filter("score >= 0.3"), docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of runs of two lines or more, and of lines of 20 words or more."""
    return _documents(line_dedup.remove_repeated_runs(docs, min_lines=2, long_words=20), docs.columns, F.col("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id."""
    return _documents(simhash.near_duplicates(docs, docs.columns, shingle=3, max_bits=3).filter("kept"), docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; hits in the others are cut out of their texts."""
    found = decontaminate.find_benchmark(docs, _read(spark, sf_dir, "benchmark"), docs.columns, window=13)
    return _documents(found.filter(~decontaminate.contaminated()), docs.columns, F.coalesce("clean", F.col("row.text")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in the target weights, with the probability each document had."""
    drawn = mixing.mix(docs).filter("kept")
    return drawn.select("row.*", F.col("topic"), F.round("probability", 6).alias("probability"))


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing", mix),
]

#: A trained classifier and 64-bit fingerprints: not for SQL (tests/llm/test_pipeline.py has a brute-force version).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents, each written and read again."""
    docs = _read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
