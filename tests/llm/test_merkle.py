import hashlib
import random
import zlib

import pytest

from labflow.llm import merkle, queries_merkle
from labflow.llm.common import Scratch

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, ROOT string, extra map<string,string>"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    doc, source, lang, n, text = row[:5]
    n = n if n is None else n + more
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc, source, lang, n, text)])


def tree(level, fan):
    """All levels of a tree."""
    levels = [level]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + fan]) for i in range(0, len(below), fan)])
    return levels


def proof(levels, at, fan):
    found = []
    for level in levels[:-1]:
        run = at // fan * fan
        found.append(("".join(level[run:at]), "".join(level[at + 1 : run + fan])))
        at //= fan
    return found


def brute(rows, fan=2):
    """(sorted results, root) by plain Python."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = tree([leaf_of(r) for r in own], fan)
    over = tree([trees[g][-1][0] for g in order], fan) if rows else [[None]]
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            path = proof(trees[g], i, fan) + proof(over, k, fan)
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = leaf_of(r, int(touched))
            for before, after in path:
                folded = h(before, folded, after)
            out.append((r[0], leaf_of(r), trees[g][-1][0], h(*[b + a for b, a in path]), folded))
    return sorted(out, key=repr), over[-1][0]


def made(n, seed=1):
    rng = random.Random(seed)
    langs = ["en"] * 12 + ["de", None, "", "é", "zz", "fr"]
    odd = [None, "", "é😀\n", "x" * 200_000]
    return [
        (
            rng.choice([None, i, i, i, i, 5]),
            rng.choice([None, "web", "1:a"]),
            rng.choice(langs),
            rng.choice([None, i, -1, 2**63 - 1]),
            rng.choice(odd) if i % 50 == 0 else f"text {i}",
            "clash",
            {"a": "b"},
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 64, 65, 1000])
def test_query_by_brute_force(spark, tmp_path, n):
    rows = made(n) if n > 3 else [(i, "s", "en", 1, "t", None, None) for i in range(n)]
    rows += rows[:20]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries_merkle.op11_interval_manifest(spark, str(tmp_path)).collect()
    expected, root = brute(rows)
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.proof_sha256, r.folded_root) for r in got), key=repr) == expected
    assert all(r.root == root and r.verified == (r.folded_root == root) for r in got)
    assert n < 100 or {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("fan,n", [(2, 5000), (3, 800), (5, 26)])
def test_intervals_and_proofs(spark, fan, n):
    rows = [(i, None, "a" if i % 9 else f"g{i % 4}", 1, "t", "clash", None) for i in range(n)]
    digests = [(r[0], r[2], leaf_of(r), "clash") for r in rows]
    scratch = Scratch(spark, "test")
    built = merkle.manifest(
        spark.createDataFrame(digests, "doc_id long, lang string, leaf string, Proof string"), fan=fan, scratch=scratch
    )
    expected, root = brute(rows, fan)
    assert built.root == root
    got = built.rows.withColumn("p", merkle.proof_digest(built.rows.proof)).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.p) for r in got), key=repr) == [x[:4] for x in expected]
    # Children's intervals make up their parent's, and their digests make its digest.
    nodes = {}
    for x in built.nodes.where("not over_groups").collect():
        nodes.setdefault(x.lang, {}).setdefault(x.level, []).append((x.lo, x.hi, x.digest))
    for levels in nodes.values():
        for level in range(1, len(levels)):
            for lo, hi, digest in levels[level]:
                inside = sorted(x for x in levels[level - 1] if lo <= x[0] and x[1] <= hi)
                assert inside[0][0] == lo and inside[-1][1] == hi and len(inside) <= fan
                assert all(a[1] + 1 == b[0] for a, b in zip(inside, inside[1:]))
                assert digest == h(*[x[2] for x in inside])
    scratch.clear()
