"""Merkle manifest against a plain restatement and SQL; multiproofs of partial choices."""

import hashlib
import zlib

from pyspark.sql import functions as F

from hitlens.llm import merkle
from tests.llm.data import against_sql, as_rows, awkward_documents, small_documents, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def climb(nodes, at):
    """Root of ``nodes`` and the proof of node ``at``: per level (siblings before, siblings after)."""
    proof = []
    while len(nodes) > 1:
        run = at // 16 * 16
        proof.append((nodes[run:at], nodes[at + 1 : run + 16]))
        nodes = [digest(nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        at //= 16
    return nodes[0], proof


def restated(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for group in groups.values():
        group.sort(key=lambda x: x[:3])
    subroots = [climb([x[2] for x in groups[s]], 0)[0] for s in order]
    out = []
    for k, source in enumerate(order):
        leaves = [x[2] for x in groups[source]]
        root, upper = climb(subroots, k)
        for i, (_, _, leaf, row) in enumerate(groups[source]):
            proof = climb(leaves, i)[1] + upper
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
            cur = leaf_of((*row[:4], row[4].translate(LOWER))) if tampered else leaf
            for before, after in proof:
                cur = digest([*before, cur, *after])
            out.append((row[0], leaf, subroots[k], root, digest(h for b, a in proof for h in b + a), cur, cur == root))
    return out


def test_manifest_matches_restatement_and_sql(spark):
    for docs in (awkward_documents(spark), small_documents(spark)):
        rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
        got = merkle.manifest_digest(docs)
        want = spark.createDataFrame(restated(rows), "a long, b string, c string, d string, e string, f string, g boolean")
        assert as_rows(got, *COLUMNS) == as_rows(want)
        plain = docs.select("doc_id", "source", "lang", "n_chars", "text")
        ours, theirs = against_sql(got, merkle.MERKLE_SQL, documents=plain.toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}))
        assert ours == theirs


def test_large_group_many_groups_and_one_row(spark):
    ids = spark.range(9000)
    docs = ids.select(F.col("id").alias("doc_id"), F.when(F.col("id") < 8700, "hot").otherwise(F.col("id").cast("string")).alias("source"),
                      F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.concat(F.lit("T"), "id").alias("text"))
    got = as_rows(merkle.manifest_digest(with_clashes(docs)), *COLUMNS)
    want = restated([tuple(r) for r in docs.collect()])
    assert got == as_rows(spark.createDataFrame(want, "a long, b string, c string, d string, e string, f string, g boolean"))
    one = merkle.manifest_digest(docs.limit(1)).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == digest([])
    assert merkle.manifest_digest(docs.limit(0)).count() == 0


def test_partial_choice_lacks_the_minimal_union(spark):
    docs = spark.range(700).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("string").alias("source"), F.lit("x").alias("text"))
    made = merkle.manifest(docs, ["doc_id", "text"])
    wanted = made.leaves.where("pos IN (3, 4, 200)")
    whole = {r.key: r for r in merkle.proofs(made, made.leaves, keep_proof=True).collect()}
    some = merkle.proofs(made, wanted, keep_proof=True).collect()
    assert len(some) == 6 and all(r.verified and r == whole[r.key] for r in some)
    # Levels of 350, 22, 2 and 1 nodes: 14 in the run of 3 and 4, 15 in that of 200, 14 beside their parents, 1 beside the parents' parent.
    lacked = merkle.missing([3, 4, 200], 350)
    assert [sum(level == k for level, _ in lacked) for k in range(3)] == [14 + 15, 14, 1] and len(lacked) == 44
    assert (1, 0) not in lacked and (1, 12) not in lacked


def test_any_change_of_a_field_is_found(spark):
    docs = small_documents(spark).limit(40)
    other = merkle.leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")])
    made = merkle.manifest(docs, claim=F.when(F.col("doc_id") % 2 == 0, other))
    assert {r.key % 2 == 1 for r in merkle.proofs(made, made.leaves).where("verified").collect()} <= {True}
    assert merkle.proofs(made, made.leaves).where("NOT verified").count() == docs.where("doc_id % 2 = 0").count()
