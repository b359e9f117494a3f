"""Query on the Merkle manifest of documents."""

from pyspark.sql import functions as F

from labflow.llm import merkle
from labflow.llm.common import read_table

TAMPERED = 7


def op11_interval_manifest(spark, folder):
    """Leaf, proof and root of every document, and the root that a tampered row leads to."""
    docs = read_table(spark, folder, "documents")
    number = F.col("n_chars").cast("decimal(20,0)")

    def leaf(n_chars):
        return merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    leaves = docs.select("doc_id", "lang", leaf(number).alias("leaf"), F.when(touched, leaf(number + 1)).alias("tampered"))
    built = merkle.manifest(leaves)
    proven = built.rows.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return proven.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _field(c):
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


def _leaf(n_chars):
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", n_chars, "text"])) + ")"


# Levels as lists of digests; a sibling is the other one of two. CRC-32 by its rule, a byte at a time.
OP11_SQL = f"""
WITH RECURSIVE remainders AS (
  SELECT list(r ORDER BY n) AS table_of FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)),
      lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) AS r
    FROM range(256) t(n))),
leaves AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf, {_leaf('(n_chars::HUGEINT + 1)')} AS tampered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS nth,
    xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(strlen(doc_id::VARCHAR)),
        lambda i: ord(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT)),
      lambda r, b: xor(r >> 8, table_of[1 + xor(r & 255, b)]))) AS crc
  FROM documents, remainders),
levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY nth) AS l FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, level + 1,
    list_transform(range((len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], '')))
  FROM levels WHERE len(l) > 1),
subroots AS (
  SELECT lang, l[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS nth FROM levels WHERE len(l) = 1),
over_levels AS (
  SELECT 0 AS level, list(subroot ORDER BY nth) AS l FROM subroots
  UNION ALL
  SELECT level + 1,
    list_transform(range((len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], '')))
  FROM over_levels WHERE len(l) > 1),
steps AS (
  SELECT doc_id, nth AS own, level, l, nth >> level AS place
  FROM leaves JOIN levels ON leaves.lang IS NOT DISTINCT FROM levels.lang AND len(l) > 1
  UNION ALL
  SELECT doc_id, leaves.nth, 100 + level, l, subroots.nth >> level
  FROM leaves JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang JOIN over_levels ON len(l) > 1),
paths AS (
  SELECT doc_id, own, list({{'b': CASE WHEN place & 1 = 1 THEN l[place] ELSE '' END, 'd': '',
    'a': CASE WHEN place & 1 = 0 THEN coalesce(l[place + 2], '') ELSE '' END}} ORDER BY level) AS path
  FROM steps GROUP BY doc_id, own),
folded AS (
  SELECT leaves.doc_id, leaf, subroot, (SELECT l[1] FROM over_levels WHERE len(l) = 1) AS root,
    sha256(coalesce(array_to_string(list_transform(path, lambda s: s.b || s.a), ''), '')) AS proof_sha256,
    list_reduce(list_prepend({{'b': '', 'd': CASE WHEN crc % {TAMPERED} = 0 THEN tampered ELSE leaf END, 'a': ''}},
      coalesce(path, [])), lambda x, y: {{'b': '', 'd': sha256(y.b || x.d || y.a), 'a': ''}}).d AS folded_root
  FROM leaves JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang
  LEFT JOIN paths ON paths.doc_id = leaves.doc_id AND paths.own = leaves.nth)
SELECT *, folded_root = root AS verified FROM folded
"""
