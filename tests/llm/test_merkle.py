"""Merkle manifest: against a plain tree built in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from llm.helpers import awkward, docs
from tablestats.llm import merkle, queries
from tablestats.llm.common import written


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def plain_leaf(values):
    texts = [None if v is None else str(v).encode() for v in values]
    return sha(b"".join(b"-" if t is None else str(len(t)).encode() + b":" + t for t in texts))


def plain_tree(digests, arity):
    """The top digest, and for each leaf what stands left and right of it on every level."""
    level, at, paths = list(digests), list(range(len(digests))), [[] for _ in digests]
    while len(level) > 1:
        for path, i in zip(paths, at, strict=True):
            first = i // arity * arity
            path.append(("".join(level[first:i]), "".join(level[i + 1:first + arity])))
        level = [sha("".join(level[i:i + arity])) for i in range(0, len(level), arity)]
        at = [i // arity for i in at]
    return level[0], paths


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_manifest(rows, arity=16):
    """``rows``: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), r))
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees.append(plain_tree([x[2] for x in groups[name]], arity))
    if not names:
        return []
    root, tops = plain_tree([t[0] for t in trees], arity)
    out = []
    for name, (subroot, paths), top in zip(names, trees, tops, strict=True):
        for (_, _, leaf, r), path in zip(groups[name], paths, strict=True):
            path, found = path + top, leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                found = plain_leaf((*r[:4], lowered(r[4])))
            for left, right in path:
                found = sha(left + found + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((r[0], leaf, subroot, root, proof, found, found == root, name))
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def fields_of(df):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]


def test_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    got = queries.QUERIES["op11_merkle"](spark, SF001).collect()
    assert in_order(got) == in_order(plain_manifest(fields_of(df)))
    assert 0 < sum(not r.verified for r in got) < len(got)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_sizes_of_one_group(spark, n):
    df = docs(spark, [(i, f"Text {i}") for i in range(n)])
    assert in_order(merkle.documents_manifest(df).collect()) == in_order(plain_manifest(fields_of(df)))


def awkward_documents(spark):
    rows = [(*r, None if i % 3 else f"s{i % 40}") for i, r in enumerate(awkward())]
    rows += [(100 + i, "One Text", f"g{i:02d}é" if i % 2 else "") for i in range(60)]
    rows += [(7, "Same Row", "hot")] * 300
    return docs(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))


def test_awkward_rows_and_many_groups(spark):
    df = awkward_documents(spark)
    assert in_order(merkle.documents_manifest(df).collect()) == in_order(plain_manifest(fields_of(df)))


def test_registered_sql(spark, tmp_out):
    import duckdb
    df = awkward_documents(spark)
    df.write.parquet(f"{tmp_out}/documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_out}/documents/*.parquet'")
    rel = con.sql(queries.ORACLE_SQL["op11_merkle"])
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "source"]
    assert sorted(rel.columns) == sorted(columns)
    got = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL['op11_merkle']})").fetchall()
    assert in_order(got) == in_order(plain_manifest(fields_of(df)))


def test_binary_tree_and_empty_table(spark):
    df = docs(spark, [(i, f"T{i}", f"s{i % 3}") for i in range(21)])
    got = merkle.manifest(df, ["doc_id", "source", "lang", "n_chars", "text"], "source", "doc_id", arity=2)
    want = plain_manifest(fields_of(df), arity=2)
    assert {(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got.collect()} == {w[:5] for w in want}
    assert all(r.verified and r.folded_root == r.root for r in got.collect())
    assert merkle.documents_manifest(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(df, ["doc_id"], "source", "doc_id", arity=1)


def test_repeated_row_is_dealt_over_partitions(spark):
    df = docs(spark, [(7, "same")] * 4000 + [(i, "other") for i in range(2000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = merkle.positioned(written(df.select("doc_id").repartition(4), "rows"), ["doc_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = placed.select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 4000
    assert sorted(r["at"] for r in placed.collect()) == list(range(6000))


def test_setting_is_put_back(spark):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), merkle.runs_together(spark):
        assert spark.conf.get(key) == "false"
        raise RuntimeError
    assert spark.conf.get(key) == before


def test_no_plan_holds_the_joins_of_several_levels(spark, monkeypatch):
    joins, whole = [], merkle.written

    def watched(df, name, by=()):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return whole(df, name, by)

    monkeypatch.setattr(merkle, "written", watched)
    df = docs(spark, [(i, f"text {i}", f"s{i % 3}") for i in range(60)])
    got = merkle.manifest(df, ["doc_id", "source", "lang", "n_chars", "text"], "source", "doc_id", arity=2)
    assert got.where("not verified").count() == 0 and got.count() == 60
    assert max(joins) <= 4
