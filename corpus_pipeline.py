"""From raw documents to token ids: quality rules, near-copies, personal data, the mix, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read back as the next one's docs.

Cases that all stages define: a null text counts as an empty one, and a null id or source is a value of its own; texts are read whole,
however long; a row that is there twice is two documents until near_duplicates leaves one; an empty table gives an empty one; columns
that are not read, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import stage, table
from quayside.shipping import shipped


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. Row for row: nothing is joined or moved. Null, empty and very short texts fail the rules and
    go; repeated rows are judged alike, so all of them stay or none."""
    from quayside.llm.quality_rules import kept_documents

    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: the one of least doc_id, null last, of equal ids the least hash of the text. Null and
    empty texts are copies of each other; of rows that are there twice one stays."""
    from quayside.llm.near_copies import one_of_each

    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with protected values and the terms that disclose them taken out of its text. A null text stays null; an id
    may be null or there twice."""
    from quayside.llm.pii import sanitise

    return sanitise(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it: up to three times, or not at all. A null source is a source of its own,
    the last one; texts without words weigh nothing. Reruns take the same rows."""
    from quayside.llm.mixing import mix_documents

    return mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_pieces, ids, round_trip for every row of the mix. Null and empty texts have no ids; a row that the mix holds
    twice is encoded twice."""
    from quayside.llm.pieces import encode_documents

    return encode_documents(docs, "doc_id", "source")


STAGES = [(f.__name__, shipped(f)) for f in (quality_rules, near_duplicates, personal_data, mixing, token_ids)]

#: Near-copies, corpus statistics and token ids have no SQL. In tests/llm the rules, the near-copies and the ids are held against
#: plain versions stage by stage; run() is held against the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
