"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and is judged on what its predecessor kept:
quality rules drop documents, of near duplicates one stays, repeated passages and
personal data go from the texts (``n_chars`` follows), and the rest is packed.
"""

from uttersieve.llm import circulant, hostrules, pii, powerpack, repeats
from uttersieve.session import materialize, ship_package

# similarity joins, automata and tokenizers are beyond SQL
ORACLE_SQL = None


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the host-level rules."""
    return hostrules.keep_good(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates."""
    return circulant.keep_one(docs)


def substring_dedup(spark, docs, sf_dir):
    """Texts without passages that an earlier document has."""
    return repeats.without_repeats(docs)


def mask_pii(spark, docs, sf_dir):
    """Texts with personal data masked."""
    return pii.masked(docs)


def packing(spark, docs, sf_dir):
    """Pieces of binary lengths with their ids."""
    return powerpack.pack(docs, powerpack.vocabulary(), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("pii", mask_pii),
    ("packing", packing),
]


def run(spark, sf_dir):
    """All stages over ``documents``; each one's rows are written before the next reads."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
