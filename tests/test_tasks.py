from vacanta.fixed_values import AREAS
from vacanta.operators import tasks
from vacanta.sources.areas import area_dimension, city_code, city_codes, read_city_text

KEYS = ["kw", "city"]


def test_grid(spark):
    configs = spark.createDataFrame(
        [(1, "a, b", "010000,020000", 2), (2, "c", "010000,000000", None), (3, "d", "1", 0)],
        "id int, kws string, cities string, max_page bigint",
    )
    rows = tasks.task_grid(configs).collect()
    first = sorted(tuple(r)[1:] for r in rows if r["id"] == 1)
    assert first == sorted(
        (kw, city, p) for kw in ("a", " b") for city in ("010000", "020000") for p in (1, 2)
    )
    second = [r for r in rows if r["id"] == 2]
    assert len(second) == 32 * 10 and {r["city"] for r in second} == set(AREAS)
    assert [tuple(r) for r in rows if r["id"] == 3] == [(3, "d", "1", 1)]


def outcomes(spark, rows):
    return spark.createDataFrame(
        rows, "page_id long, kw string, city string, page long, good boolean"
    )


def test_pages_stop_at_the_first_bad_or_missing_one(spark):
    rows = [
        (1, "a", "x", 1, True), (2, "a", "x", 2, True), (3, "a", "x", 3, False), (4, "a", "x", 4, True),
        (5, "a", "y", 1, True), (6, "a", "y", 3, True),           # page 2 never landed
        (7, "b", "x", 1, False), (8, "b", "x", 2, True),
        (9, "b", "y", 2, True),                                   # no page 1
        *[(100 + i, "c", "x", 1, i == 7) for i in range(50)],     # copies, one of them good
        *[(200 + i, "d", "x", i, True) for i in range(1, 15)],    # more than ten pages
    ]
    taken = tasks.pages_until_bad(outcomes(spark, rows), KEYS)
    got = sorted(r["page_id"] for r in taken.collect())
    assert got == [1, 2, 5, 107, *range(201, 215)]
    limits = spark.createDataFrame([("d", "x", None), ("a", "x", 1)], "kw string, city string, max_page long")
    limited = tasks.pages_until_bad(outcomes(spark, rows), KEYS, limits)
    assert sorted(r["page_id"] for r in limited.collect()) == [1, 5, 107, *range(201, 211)]


    wanted = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("c", "x"), ("e", "x")], "kw string, city string"
    )
    done = {(r["kw"], r["city"]): (r["pages"], r["completed"])
            for r in tasks.task_completion(wanted, taken, KEYS).collect()}
    assert done == {
        ("a", "x"): (2, True), ("a", "y"): (1, True), ("b", "x"): (0, False), ("b", "y"): (0, False),
        ("c", "x"): (1, True), ("e", "x"): (0, False),
    }
    failed = {tuple(r) for r in tasks.failed_tasks(wanted, taken, KEYS).collect()}
    assert failed == {k for k, v in done.items() if not v[1]}


def test_city_codes(spark, tmp_path):
    (tmp_path / "a.js").write_text(
        'var area={"010000":"北京","020000":"上海",\n"0200":"上海","x1":"no","030200":"广州"};', "utf-8"
    )
    lines = read_city_text(spark, str(tmp_path))
    assert {tuple(r) for r in city_codes(lines).collect()} == {
        ("北京", "010000"), ("上海", "020000"), ("广州", "030200")
    }
    assert [r["code"] for r in city_code(lines, "上海").collect()] == ["020000"]
    assert city_code(lines, "nowhere").count() == 0


def test_area_dimension(spark):
    assert dict(map(tuple, area_dimension(spark).collect())) == AREAS


def test_a_long_task_is_read_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(tasks, "CHUNK_PAGES", 3)
    rows = [(p, "a", "x", p, True) for p in range(1, 41)]
    rows += [(100 + p, "b", "x", p, p != 8) for p in range(1, 41)]
    rows += [(200 + p, "c", "x", p, True) for p in range(1, 41) if not 4 <= p <= 9]
    rows += [(300 + p, "d", None, p, True) for p in range(1, 8)]
    taken = tasks.pages_until_bad(outcomes(spark, rows), KEYS)
    got = sorted(r["page_id"] for r in taken.collect())
    assert got == [*range(1, 41), *range(101, 108), *range(201, 204), *range(301, 308)]
