import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.compare import duck, duck_table, spark_table, table
from tests.llm.frames import PROSE, awkward, none
from vacanta.llm import line_dedup, queries


def brute(rows):
    """The rule, read line by line with plain Python text."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def key(line):
        return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(lower)

    held = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10 and doc_id is not None:
                held.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stay = [
            x for x in lines
            if doc_id is None or len(held.get(key(x), ())) < 2 or min(held[key(x)]) == doc_id
        ]
        out.append((doc_id, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["doc_id", "kept_text", "n_lines", "n_dropped"]
    return sorted(map(tuple, df.collect()), key=repr)


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_awkward_rows(spark):
    long = "\n".join(f"line number {i}" for i in range(40_000))
    docs = awkward(spark, [
        (20, "a shared line\r\nown words here\n\tA Shared Line \n"), (21, "\n\na SHARED line\x0b"), (19, "a shared lin"),
        (22, "ÄÖÜ und straße\nÄÖÜ UND STRAßE"), (23, "äöü und straße\nÄÖÜ und straße"), (24, "日本語の長い行です。\n日本語の長い行"),
        (25, "日本語の長い行です。"), (26, long), (27, long + "\nand one more line"), (None, long), (2, "a shared line"),
    ])
    assert got(line_dedup.dedupe_lines(docs)) == brute(pairs(docs))
    assert got(line_dedup.dedupe_lines(none(spark))) == []


def test_threshold_and_length_are_parameters(spark):
    docs = spark.createDataFrame([(1, "one\ntwo"), (2, "one\ntwo"), (3, "one")], "doc_id long, text string")
    rows = got(line_dedup.dedupe_lines(docs, min_chars=3, min_documents=3))
    assert rows == [(1, "one\ntwo", 2, 0), (2, "two", 2, 1), (3, "", 1, 1)]


def test_a_line_that_nearly_all_documents_hold(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "concat('All rights reserved.\n', if(id % 3 = 0, 'the same text\n', ''), 'words of document ', id % 2900) as text"
    )
    assert got(line_dedup.dedupe_lines(docs.repartition(4))) == brute(pairs(docs))


def test_frequent_keys_are_dealt_over_parts(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'All rights reserved.' as text")
    shared = line_dedup.shared_lines(docs)
    row = shared.first()
    key = row["h1"].to_bytes(8, "little", signed=True) + row["h2"].to_bytes(8, "little", signed=True)
    parts = line_dedup._explode(docs, 10, {key: 50}).groupBy("part").count().collect()
    assert len(parts) == 50 and max(r["count"] for r in parts) < 120


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.text(alphabet="aA é\n\t\r", max_size=60)), max_size=30))
def test_random_texts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert got(line_dedup.dedupe_lines(docs)) == brute(rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    assert spark_table(queries.QUERIES["op12_line_dedup"](spark, sf_dir)) == duck_table(
        duck(sf_dir), queries.ORACLES["op12_line_dedup"]
    )


def test_sql_and_query_on_awkward_rows(spark, tmp_path):
    docs = awkward(spark, [(31, PROSE + "\nown"), (32, " " + PROSE.upper() + "\t\n\n")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = duck_table(con, queries.ORACLES["op12_line_dedup"])
    assert spark_table(queries.QUERIES["op12_line_dedup"](spark, str(tmp_path))) == want
    rows = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in brute(pairs(docs))]
    assert table(["doc_id", "n_lines", "n_dropped", "kept_sha256"], rows) == want
