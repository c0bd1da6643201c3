import json

import pytest
from pyspark.sql import functions as F

from vacanta.operators import envelope, listings
from vacanta.schemas import RESPONSE
from vacanta.sources.areas import area_dimension
from vacanta.sources.responses import read_responses


def page(items, status="1"):
    return json.dumps({"status": status, "resultbody": {"job": {"items": items}}})


def responses(spark, bodies, code=200):
    rows = [
        (i, 0, "kw", "010000", i + 1, b[0] if isinstance(b, tuple) else code,
         b[1] if isinstance(b, tuple) else b)
        for i, b in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, RESPONSE)


def test_classes(spark):
    bodies = [
        (200, "<script>var arg1='A1B2';</script>"), (403, "var arg1='FF';"), (200, '{"status":"1"}'),
        (200, "  \n "), (200, "an Error here"), (429, "x"), (521, "error"), (500, "x"), (302, ""),
        (200, "var arg1='zz';"), (200, None),
    ]
    df = responses(spark, bodies)
    got = [r[0] for r in envelope.classify_responses(df).orderBy("page_id").select("response_class").collect()]
    assert got == [
        "challenge", "challenge", "ok", "invalid", "invalid", "blocked", "blocked", "http_error",
        "http_error", "ok", "invalid",
    ]
    lenient = envelope.classify_responses(df, reject_error_word=False).where("page_id = 4")
    assert lenient.first()["response_class"] == "ok"
    usable = {r[0] for r in envelope.usable_responses(df).select("page_id").collect()}
    assert usable == {2, 9}


CASES = [
    page([{"jobId": "a"}]),
    "not json",
    page([{"jobId": "a"}], status="0"),
    page([{"jobId": "a"}], status=1),
    '{"status":"1"}',
    page([]),
    '{"status":"1","resultbody":{"job":{}}}',
    page([{"jobId": "a"}, {"jobId": "b"}])[:-6],
    '["status"]',
    '{"status":"1","resultbody":null}',
]


def test_only_whole_good_pages_pass(spark):
    df = responses(spark, CASES)
    assert [r[0] for r in envelope.valid_pages(df).select("page_id").collect()] == [0]
    lenient = envelope.valid_pages(df, strict_status=False).select("page_id").collect()
    assert sorted(r[0] for r in lenient) == [0, 3]
    assert [r["jobId"] for r in envelope.explode_items(df, ["jobId"]).collect()] == ["a"]


def test_postings_that_mention_an_error(spark):
    df = responses(spark, [page([{"jobId": "a", "jobDescribe": "Error handling"}])])
    assert envelope.explode_items(df, ["jobId"]).count() == 0
    assert envelope.valid_pages(df).count() == 0
    assert envelope.explode_items(df, ["jobId"], reject_error_word=False).count() == 1
    assert envelope.valid_pages(df, reject_error_word=False).count() == 1


def test_quality_counts(spark):
    counted = envelope.page_quality(responses(spark, CASES)).collect()
    # Plain text, the text that breaks off, and the array: none is a JSON object.
    assert {r["rule"]: r["rejected"] for r in counted} == {
        "not_json": 3, "wrong_shape": 0, "no_status": 3, "no_resultbody": 5, "bad_status": 5, "too_few_items": 7,
    }
    assert {r["pages"] for r in counted} == {10}


GOOD = page([{"jobId": "a"}])


def test_only_one_whole_strict_object_is_a_page(spark):
    refused = [
        GOOD + " garbage", GOOD + GOOD, GOOD + "," + GOOD, GOOD + "]", GOOD.replace('"', "'"),
        GOOD.replace('"a"', "NaN"), "[" + GOOD + "]", "/*c*/" + GOOD, "", "null", "5",
    ]
    assert envelope.valid_pages(responses(spark, refused)).count() == 0
    assert envelope.valid_pages(responses(spark, [GOOD + " \n", "\n " + GOOD])).count() == 2
    counted = {r["rule"]: r["rejected"] for r in envelope.page_quality(responses(spark, refused)).collect()}
    assert counted["not_json"] == len(refused) - 1  # the empty one is no usable response


def test_shapes_that_are_no_result(spark):
    shapes = ['[]', '{"job":[]}', '{"job":{"items":{"a":1}}}', '{"job":{"items":[{"jobId":"a"},"text"]}}', '{"job":5}']
    fine = ["null", "{}", '{"job":null}', '{"job":{}}', '{"job":{"items":null}}', '{"job":{"items":[]}}']
    bodies = [f'{{"status":"1","resultbody":{x}}}' for x in shapes + fine]
    counted = {r["rule"]: r["rejected"] for r in envelope.page_quality(responses(spark, bodies)).collect()}
    assert counted["not_json"] == 0 and counted["wrong_shape"] == len(shapes)
    assert envelope.valid_pages(responses(spark, bodies)).count() == 0


def test_null_items_are_no_listings(spark):
    df = responses(spark, [page([None, {"jobId": "a"}, None]), page([None])])
    assert [r["jobId"] for r in envelope.explode_items(df, ["jobId"]).collect()] == ["a"]
    assert [r["jobs_count"] for r in envelope.page_counts(df).collect()] == [1]


def test_listing_rows_from_json(spark):
    items = [
        {"jobId": "1", "jobTags": ["a", "b"], "jobSalaryMin": "", "jobSalaryMax": " 3 ", "odd": 1},
        {"jobId": 2, "jobTags": [], "jobSalaryMin": "1万", "jobSalaryMax": 5000},
        {"jobId": "3", "jobTags": "t", "hrLabels": 5, "jobSalaryMin": "1d"},
        {"jobId": "4", "jobTags": None, "jobDescribe": 'line\n"quoted" 中'},
        {"jobId": "5", "jobTags": ["a", None, "b"]},
    ]
    df = envelope.explode_items(responses(spark, [page(items)]))
    rows = listings.clean_items(df, area_dimension(spark)).orderBy("pos").collect()
    assert len(rows[0]) == 51 and "odd" not in rows[0].asDict()
    assert [r["jobId"] for r in rows] == ["1", "2", "3", "4", "5"]
    assert [r["jobTags"] for r in rows] == ["a,b", "", "t", None, "a,b"]
    assert [r["hrLabels"] for r in rows] == [None, None, "5", None, None]
    assert [r["jobSalaryMin"] for r in rows] == [None] * 5
    assert [r["jobSalaryMax"] for r in rows] == [3.0, 5000.0, None, None, None]
    assert rows[3]["jobDescribe"] == 'line\n"quoted" 中'
    assert {r["search_kw"] for r in rows} == {"kw"} and {r["search_city"] for r in rows} == {"北京"}
    rejects = listings.cast_salary_rejects(df).select("pos", "column_name", "value").collect()
    assert sorted(map(tuple, rejects)) == [(1, "jobSalaryMin", "1万"), (2, "jobSalaryMin", "1d")]


def test_salary_cast_by_page(spark):
    bodies = [
        page([{"jobSalaryMin": "1", "jobSalaryMax": "2"}, {"jobSalaryMin": "x", "jobSalaryMax": ""}]),
        page([{"jobSalaryMin": "3"}]),
    ]
    columns = ["jobSalaryMin", "jobSalaryMax"]
    df = envelope.explode_items(responses(spark, bodies), columns, page_flags=True)
    rows = listings.cast_salary_by_page(df).orderBy("page_id", "pos").select(
        "jobSalaryMin", "jobSalaryMin_text", "jobSalaryMax", "jobSalaryMax_text"
    ).collect()
    assert [tuple(r) for r in rows] == [
        (None, "1", 2.0, None), (None, "x", None, None), (3.0, None, None, None),
    ]


@pytest.mark.parametrize("fmt", ["json", "parquet", "orc"])
def test_landed_formats(spark, tmp_path, fmt):
    df = responses(spark, CASES)
    df.write.format(fmt).save(f"{tmp_path}/landed")
    back = read_responses(spark, f"{tmp_path}/landed", fmt)
    assert back.schema == RESPONSE
    assert sorted(back.collect()) == sorted(df.collect())


def test_whitelist_keeps_what_exists_in_order(spark):
    df = spark.createDataFrame([("c", "j", "x", 1)], "coId string, jobId string, zzz string, page_id int")
    assert listings.select_expected(df).columns == ["jobId", "coId"]


def test_union_of_different_columns(spark, tmp_path):
    from vacanta.sources.store import read_merged

    a = spark.createDataFrame([("1", "x")], "jobId string, term string")
    b = spark.createDataFrame([("2", "y")], "jobId string, coId string")
    got = listings.union_pages([a, b])
    want = {("1", "x", None), ("2", None, "y")}
    assert {tuple(r) for r in got.select("jobId", "term", "coId").collect()} == want
    a.write.parquet(f"{tmp_path}/t/p=1")
    b.write.parquet(f"{tmp_path}/t/p=2")
    merged = read_merged(spark, f"{tmp_path}/t")
    assert {tuple(r) for r in merged.select("jobId", "term", "coId").collect()} == want


def test_declared_form(spark):
    row = {
        "jobId": "1", "jobName": "n", "companyName": "c", "jobAreaCode": "030200",
        "jobAreaString": "广州·天河区·x", "jobSalaryMin": 1999.9, "jobSalaryMax": 1e12,
        "issueDateString": "2024-01-02", "updateDateTime": "3天前",
    }
    columns = {c: F.lit(None).cast("string") for c in listings.LISTING_COLUMNS}
    columns |= {k: F.lit(v) for k, v in row.items()}
    view = listings.listing_view(spark.range(1).select(*[v.alias(k) for k, v in columns.items()]))
    got = view.first()
    assert len(view.columns) == 20
    assert (got["company_name"], got["province_code"]) == ("c", "030000")
    assert (got["city_name"], got["district"]) == ("广州", "天河区·x")
    assert (got["salary_min"], got["salary_max"]) == (1999, None)
    assert str(got["publish_date"]) == "2024-01-02 00:00:00" and got["update_date"] is None
    assert got["created_at"] is not None


def test_columns_and_schemas_of_page_groups(spark):
    def page(number, status, items):
        body = '{"status":%s,"resultbody":{"job":{"items":[%s]}}}' % (status, items)
        return (number, 0, "k", "c", number % 2, 200, body)

    rows = [
        page(1, '"1"', '{"jobId":"a","n":1},{"jobId":null,"n":2.5},null,7'), page(3, '"1"', '{"x":["y"],"n":"t"}'),
        page(2, '"1"', '{"jobId":"b"}'), page(4, "1", '{"numeric":1}'), page(6, '"0"', '{"refused":1}'),
        (8, 0, "k", "c", 0, 200, "{broken"), (10, 0, "k", "c", 0, 404, page(1, '"1"', '{"z":1}')[-1]), (12, 0, "k", "c", 0, 200, None),
    ]
    pages = spark.createDataFrame(rows, RESPONSE)
    got = {tuple(r) for r in envelope.item_columns(pages, "page").collect()}
    assert got == {(1, "jobId", 1), (1, "n", 3), (1, "x", 1), (0, "jobId", 1)}
    schemas = {r["page"]: r["item_schema"] for r in envelope.item_schemas(pages.where("page_id <> 1"), "page").collect()}
    assert schemas == {1: "OBJECT<n: STRING, x: ARRAY<STRING>>", 0: "OBJECT<jobId: STRING>"}
    plan = envelope.item_columns(pages, "page")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1
