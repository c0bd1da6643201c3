"""Small documents with every awkward case, and columns that clash with results."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, keep long"

PROSE = "The ship was on its way to the old harbour and the crew sang a song that nobody at home had heard before"


def awkward(spark, extra=()):
    rows = [
        (1, PROSE), (2, PROSE), (2, PROSE), (3, PROSE.replace("old", "new")),
        (4, ""), (5, None), (6, "   \n\t "), (None, "no id here"), (None, None),
        (7, "word"), (8, " ".join(f"w{i}" for i in range(30_000))),
        (9, "ÄÖÜ straße 日本 語 テスト 😀\u00a0x"), (10, "a\x00b c"), *extra,
    ]
    return spark.createDataFrame(
        [(i, t, None if i == 4 else "en", None if i in (3, 7) else f"s{(i or 0) % 3}", 0, "mine", "own", 5) for i, t in rows],
        DOCS,
    ).repartition(3)


def none(spark):
    return spark.createDataFrame([], DOCS)
