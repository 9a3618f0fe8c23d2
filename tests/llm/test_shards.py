import zlib

from courtside.llm import queries, shards
from tests.llm.cases import edge_docs, edge_rows, no_docs


def check(rows, out, n):
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == \
        sorted((str(i), size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    sums = [sum(r["size"] for r in out if r["shard"] == k) for k in range(n)]
    assert max(sums) - min(sums) <= 2 * max(size(t) for _, t in rows)
    for k in range(n):
        slots = sorted(r["slot"] for r in out if r["shard"] == k)
        assert slots == list(range(len(slots)))
    line = sorted(out, key=lambda r: (r["shard"], r["slot"]))
    order = [(r["text_key"], r["doc_id"] is not None, r["doc_id"] or 0) for r in line]
    assert order == sorted(order)


def test_edge_rows(spark):
    check([r[:2] for r in edge_rows()], shards.assign_shards(edge_docs(spark), 4).collect(), 4)


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    check(rows, shards.assign_shards(docs, 16).collect(), 16)
    assert set(queries.QUERIES["op10_byte_shards"](spark, sf_dir).columns) == {
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}


def test_written_shards(spark, tmp_path):
    docs = edge_docs(spark)
    want = {(r["shard"], r["doc_id"]) for r in shards.assign_shards(docs.drop("shard"), 3).collect()}
    shards.write_shards(docs.drop("shard"), 3, f"file://{tmp_path}/s")
    back = spark.read.parquet(f"file://{tmp_path}/s")
    assert back.count() == docs.count() and {(r["shard"], r["doc_id"]) for r in back.collect()} == want


def test_no_documents(spark):
    assert shards.assign_shards(no_docs(spark), 16).count() == 0
