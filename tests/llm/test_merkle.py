import hashlib
import zlib

import duckdb
from pyspark.sql import functions as F

from strata.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path_of(levels, i):
    steps = []
    for level in levels[:-1]:
        a = i // 8 * 8
        steps.append((level[a:i], level[i + 1:a + 8]))
        i //= 8
    return steps


def plain(rows):
    """(doc_id, leaf, subroot, root, siblings) of rows of FIELDS, by the definition."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_of([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    top = levels_of([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (_, _, leaf, doc_id) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = path_of(trees[g], i) + path_of(top, k)
            out.append((doc_id, leaf, trees[g][-1][0], top[-1][0], [("".join(a), "".join(b)) for a, b in steps]))
    return sorted(out, key=str)


def found(df):
    out = merkle.manifest(df, FIELDS, keep=["doc_id"])
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof"]
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.proof]) for r in out.collect()), key=str)


def test_trees_of_every_depth(spark):
    # 1, 2, 8, 9, 64, 65, 512 and 513 leaves; the last needs a second tier of blocks
    rows = [(1000 * k + i, f"s{i % 3}", f"l{k:02}", i, f"Text {i} of {k}") for k, n in enumerate((1, 2, 8, 9, 64, 65, 512, 513)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert found(df) == plain(rows)


def test_many_groups(spark):
    rows = [(i, None, f"lang {i // 2}", None, "x" * i) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(df) == plain(rows)


def test_edge_rows(edge, edge_rows):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in edge_rows]
    assert found(edge) == plain(rows)
    out = merkle.manifest(edge, FIELDS)
    assert out.columns == edge.columns + ["leaf", "subroot", "root", "proof"] and out.count() == len(edge_rows)
    good = out.select(merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).collect()
    assert all(r[0] for r in good)


def test_one_row_and_none(spark, edge, empty):
    one = found(edge.where("doc_id = 3"))
    assert len(one) == 1 and one[0][1] == one[0][2] == one[0][3] and one[0][4] == []
    assert found(empty) == []


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", "b", "c", "d", "e")], "doc_id long, text string, lang string, root string, _g string, rank string")
    out = merkle.manifest(df, ["doc_id", "text"])
    assert out.columns == ["doc_id", "text", "lang", "_g", "rank", "leaf", "subroot", "root", "proof"]
    assert out.first().root == leaf_of([1, "a"]) and out.first()._g == "d"


def test_query_against_plain_and_sql(spark, document_rows):
    sf = "/root/testdata/sf0.001"
    got = queries.op12_merkle_manifest(spark, sf).toPandas().sort_values("doc_id")
    want = {x[0]: x for x in plain([tuple(r[c] for c in FIELDS) for r in document_rows])}
    text = {r.doc_id: r for r in document_rows}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = 0
    for r in got.itertuples():
        doc_id, leaf, subroot, root, steps = want[r.doc_id]
        assert (r.leaf, r.subroot, r.root) == (leaf, subroot, root)
        assert r.proof_sha256 == digest(*[a + b for a, b in steps])
        at = leaf
        if zlib.crc32(str(doc_id).encode()) % 3 == 0:
            d = text[doc_id]
            at = leaf_of([doc_id, d.source, d.lang, d.n_chars, d.text and d.text.translate(lower)])
            changed += at != leaf
        for a, b in steps:
            at = digest(a, at, b)
        assert r.folded_root == at and r.verified == (at == root)
    assert changed and (~got.verified).sum() == changed
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    sql = con.execute(queries.ORACLE["op12_merkle_manifest"]).df().sort_values("doc_id")[list(got.columns)]
    assert got.values.tolist() == sql.values.tolist()
