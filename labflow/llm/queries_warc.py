"""Query on web archives."""

from labflow.llm import warc
from labflow.llm.common import read_table


def op10_dictionary_archives(spark, folder):
    """All pages written as archives and read back."""
    found = warc.round_trip(read_table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Base32 by rule: each letter stands for five bits, taken from the hex digits' forty-bit groups.
OP10_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM payloads)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM firsts
"""
