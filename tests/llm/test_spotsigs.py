import hashlib
import re

from courtside.llm import queries, spotsigs
from tests.llm.cases import edge_docs, edge_rows, no_docs


def spots(text):
    """Chains by the definition: an anchor right before a content word, that word and the next one."""
    words = [w for w in re.split(r"[\s!-/:-@\[-`{-~\x0b\x1c-\x1f]+", (text or "").lower(), flags=re.A) if w]
    content = [k for k, w in enumerate(words) if w not in spotsigs.ANCHORS]
    return {(words[a - 1], words[a], words[b]) for a, b in zip(content, content[1:], strict=False)
            if a > 0 and words[a - 1] in spotsigs.ANCHORS}


def parts(fingerprint):
    return {fingerprint[k:k + 8] for k in range(0, len(fingerprint), 8)}


def ratio(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, out):
    texts = {i: t or "" for i, t in rows}
    ids = sorted([i for i in texts if i is not None], reverse=True) + ([None] if None in texts else [])
    after = dict(zip(ids, [*ids[1:], ids[0]], strict=True))
    marks = {r["doc_id"]: parts(r["fingerprint"]) for r in out}
    assert len(out) == len(rows)
    for r in out:
        own, other = texts[r["doc_id"]], texts[after[r["doc_id"]]]
        half = len(own) // 2
        edited = own[:len(own) - half] + other[:half]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r["near_edited"] - ratio(marks[r["doc_id"]], parts(r["edited_fingerprint"]))) < 1e-12
        assert abs(r["near_next"] - ratio(marks[r["doc_id"]], marks[after[r["doc_id"]]])) < 1e-12
        want = spots(own)
        assert len(marks[r["doc_id"]]) == (len(want) if want else bool(own)), r["doc_id"]
    by_text = {}
    for r in out:
        assert by_text.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]


def test_edge_rows(spark):
    check([r[:2] for r in edge_rows()], spotsigs.compare_edited(edge_docs(spark)).collect())


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check([(r["doc_id"], r["text"]) for r in docs.collect()], queries.QUERIES["op4_spotsigs"](spark, sf_dir).collect())


def test_one_document_and_none(spark):
    one = spark.createDataFrame([(4, "the river and the stone")], "doc_id long, text string")
    check([(4, "the river and the stone")], spotsigs.compare_edited(one).collect())
    assert spotsigs.compare_edited(no_docs(spark)).count() == 0


def test_plan_has_no_python(spark, sf_dir):
    plan = queries.QUERIES["op4_spotsigs"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "NestedLoop" not in plan and "Cartesian" not in plan


def test_near_duplicates_by_all_pairs(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    marks = [(r["doc_id"], parts(r["fingerprint"])) for r in spotsigs.fingerprints(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    root = {i: i for i, _ in marks}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(marks):
        for j, b in marks[k + 1:]:
            if a and b and ratio(a, b) >= 0.8:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    got = spotsigs.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 0.8).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: find(i) for i, _ in marks}
