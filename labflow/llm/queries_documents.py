"""Queries on near-duplicate documents."""

from labflow.llm import bagminhash
from labflow.llm.common import read_table

LEAST_SIMILARITY = 0.8


def op5_bag_minhash_duplicates(spark, folder):
    """The class of near-duplicates of every document."""
    return bagminhash.near_duplicates(read_table(spark, folder, "documents"), LEAST_SIMILARITY)
