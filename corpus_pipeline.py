"""From raw documents to training sequences: toxic texts, near copies and secrets go, the rest is packed."""

from labflow.llm import stages
from labflow.llm.common import Scratch, read_table

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("minhash_near_dedup", stages.drop_near_copies),
    ("secret_scan", stages.redact_secrets),
    ("packing", stages.pack_sequences),
]

# A trained network decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on the documents below ``sf_dir``; what a stage returns is written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs, _ = scratch.table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
