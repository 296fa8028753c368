import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from skyfare.llm import oracle
from skyfare.llm.merkle_manifest import build_manifest, folded, hex_text, leaf_digest, proof_text, proofs

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def leaf_of(row) -> str:
    parts = [b"-" if v is None else b"%d:%s" % (len(str(v).encode()), str(v).encode()) for v in row]
    return sha(b"".join(parts))


def tree(level: list[str], fanout: int) -> list[list[str]]:
    levels = [level]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + fanout])) for i in range(0, len(last), fanout)])
    return levels


def way(levels, at, fanout):
    out = []
    for level in levels[:-1]:
        first = at // fanout * fanout
        out.append((level[first:first + fanout], at - first))
        at //= fanout
    return out


def brute(rows, fanout):
    """Sorted (doc_id, leaf, subroot, root, hash of the proof) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r[0]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])], fanout) for s in names]
    top = tree([t[-1][0] for t in trees], fanout)
    out = []
    for i, s in enumerate(names):
        for k, (_, _, leaf, doc_id) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            steps = way(trees[i], k, fanout) + way(top, i, fanout)
            proof = sha("".join(d for run, at in steps for j, d in enumerate(run) if j != at))
            out.append((doc_id, leaf, trees[i][-1][0], top[-1][0], proof))
    return sorted(out, key=str)


def found(df, fanout, keep=()):
    manifest = build_manifest(df, "doc_id", "source", FIELDS, keep, fanout)
    rows = proofs(manifest, manifest.leaves.drop("group")).select(
        "doc_id", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
        F.sha2(proof_text(F.col("path")), 256).alias("proof"), hex_text(folded(F.col("leaf"), F.col("path"))).alias("back"))
    return manifest, rows.collect()


def edge_table(n_hot=100):
    rows = [(i, "hot", "en", i, f"text {i}") for i in range(n_hot)]
    rows += [(1000 + i, f"s{i % 23}", None, None, "x" * i) for i in range(60)]
    rows += [(2000 + i, None, "de", 1, None) for i in range(5)] + [(2100 + i, "", "de", 1, "") for i in range(3)]
    rows += [(3000, "same", "en", 1, "a")] * 20 + [(3000, "same", "en", 1, "b"), (None, "same", "en", 1, "c"), (None, "same", "en", 1, "c")]
    rows += [(4000, "Éa", "fr", 2, "é" * 50_000), (4001, "lone", "en", 3, "A\nB:3")]
    return rows


@pytest.mark.parametrize("fanout", [3, 16])
def test_against_brute_force(spark, fanout):
    rows = edge_table()
    df = (spark.createDataFrame(rows, SCHEMA).repartition(5)
          .withColumns({n: F.lit(7) for n in ("tree", "rank", "leaf", "at", "digest", "size", "path", "group", "place")}))
    manifest, got = found(df, fanout)
    want = brute(rows, fanout)
    assert sorted([(r.doc_id, r.leaf, r.subroot, manifest.root.hex(), r.proof) for r in got], key=str) == want
    assert {r.back for r in got} == {manifest.root.hex()}
    # the store is content-addressed: a digest is one record
    assert manifest.records.count() == manifest.records.select("digest").distinct().count()


def test_one_row_one_source_and_chains_of_single_children(spark):
    for rows in ([(5, "a", "en", 1, "t")], [(i, "a", "en", 1, "t") for i in range(17)],
                 [(i, f"s{i}", "en", 1, "t") for i in range(17)]):
        manifest, got = found(spark.createDataFrame(rows, SCHEMA), 16)
        want = brute(rows, 16)
        assert sorted([(r.doc_id, r.leaf, r.subroot, manifest.root.hex(), r.proof) for r in got], key=str) == want
        assert {r.back for r in got} == {manifest.root.hex()}


def test_empty_table(spark):
    manifest, got = found(spark.createDataFrame([], SCHEMA), 16)
    assert manifest.root is None and got == [] and manifest.records.count() == 0


def test_some_requests_and_tampered_rows(spark):
    rows = edge_table()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("bad", leaf_digest([F.lit("other")]))
    manifest = build_manifest(df, "doc_id", "source", FIELDS, ["bad"], 4)
    asked = manifest.leaves.filter("doc_id in (3, 99, 1001, 4001) or doc_id = 2002")
    got = proofs(manifest, asked).select("doc_id", hex_text(folded(F.col("leaf"), F.col("path"))).alias("good"),
                                         hex_text(folded(F.col("bad"), F.col("path"))).alias("bad")).collect()
    assert sorted(r.doc_id for r in got) == [3, 99, 1001, 2002, 4001]
    assert all(r.good == manifest.root.hex() != r.bad for r in got)
    none = spark.createDataFrame([(0, 10_000), (10_000, 0)], "tree long, rank long")
    assert proofs(manifest, none).count() == 0


def test_a_lost_record_is_an_error(spark):
    manifest = build_manifest(spark.createDataFrame(edge_table(), SCHEMA), "doc_id", "source", FIELDS, [], 4)
    manifest.records = manifest.records.limit(3)
    with pytest.raises(Exception, match="no record for"):
        proofs(manifest, manifest.leaves).collect()


def test_invalid_utf8_is_digested_by_bytes(spark, tmp_dir):
    df = spark.sql("select 1L doc_id, 's' source, 'en' lang, 1L n_chars, cast(X'61FF2062' as string) text "
                   "union all select 2L, 's', 'en', 1L, cast(X'61FE2062' as string)")
    df.write.parquet(f"{tmp_dir}/d")
    manifest, got = found(spark.read.parquet(f"{tmp_dir}/d"), 16)
    want = {sha(b"%d:%d1:s2:en1:14:" % (1, i) + t) for i, t in ((1, b"a\xff b"), (2, b"a\xfe b"))}
    assert {r.leaf for r in got} == want and {r.back for r in got} == {manifest.root.hex()}


def test_sql_against_brute_force():
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, source varchar, lang varchar, n_chars bigint, text varchar)")
    rows = [r for r in edge_table(40) if r[0] is not None and r[1] != "Éa"]
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", rows)
    got = con.execute(f"select doc_id, leaf, subroot, root, proof_sha256 from ({oracle._merkle(3)})").fetchall()
    assert sorted(got, key=str) == brute(rows, 16)
