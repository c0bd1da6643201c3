"""From landed response text to item rows: classify, parse, validate, explode.

Bodies are large and parsing them is the main cost, so every function here
keeps to one ``from_json`` per body. A ``where`` on a parsed field would be
pushed below the parsing projection and parse each body again; validity is
therefore tested inside the generator (``inline``/``posexplode`` of NULL gives
no rows).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacanta.fixed_values import (
    BLOCKED_CODES,
    CHALLENGE_PATTERN,
    ERROR_WORD,
    MIN_ITEMS_PER_PAGE,
    SALARY_COLUMNS,
    SUCCESS_STATUS,
)
from vacanta.functions.text import contains_ci, has_ink, is_bad_number
from vacanta.schemas import envelope_schema

STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _is_challenge() -> Column:
    # The plain search is cheaper and rules out nearly every page.
    words = F.lit(CHALLENGE_PATTERN.split("(")[0])
    return F.contains("body", words) & F.col("body").rlike(CHALLENGE_PATTERN)


def _is_usable(reject_error_word: bool) -> Column:
    usable = has_ink(F.col("body"))
    if reject_error_word:
        usable = usable & ~contains_ci(F.col("body"), ERROR_WORD, rare_pair="rr")
    return usable


def response_class(reject_error_word: bool = True) -> Column:
    """Class of a response; the first rule that holds names it.

    ``reject_error_word=False`` keeps pages whose postings merely mention the
    word "error".
    """
    good_code = F.col("status_code") == 200
    return (
        F.when(_is_challenge(), "challenge")
        .when(good_code & _is_usable(reject_error_word), "ok")
        .when(good_code, "invalid")
        .when(F.col("status_code").isin(BLOCKED_CODES), "blocked")
        .otherwise("http_error")
    )


def classify_responses(responses: DataFrame, reject_error_word: bool = True) -> DataFrame:
    return responses.withColumn("response_class", response_class(reject_error_word))


def count_classes(responses: DataFrame, *by: str) -> DataFrame:
    return (
        classify_responses(responses)
        .groupBy(*by, "response_class")
        .agg(F.count("*").alias("responses"))
    )


def usable_responses(responses: DataFrame, reject_error_word: bool = True) -> DataFrame:
    """Responses of class ``ok``: status 200, not blank, no challenge.

    Written as a conjunction, so that the status test reaches the scan.
    """
    return responses.where(
        (F.col("status_code") == 200) & _is_usable(reject_error_word) & ~_is_challenge()
    )


def parse_envelope(responses: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace ``body`` by ``status_json``, ``items``, ``has_result``, ``is_json``
    and ``wrong_shape``.

    ``columns`` limits the item fields that are decoded. ``status_json`` is the
    status as JSON text, so that ``"1"`` and ``1`` stay apart. A body is taken
    only as one whole JSON object: it is parsed as the single element of an
    array, which text after the object breaks. NULL items are left out.
    ``wrong_shape`` tells JSON whose result is no ``{job: {items: [{...}]}}``;
    it looks at the text again, and only where no items were found.
    """
    text = F.concat(F.lit("["), F.col("body"), F.lit("]"))
    closed = F.endswith(F.rtrim("body", F.lit(" \t\r\n")), F.lit("}"))
    parsed = F.from_json(text, T.ArrayType(envelope_schema(columns)), STRICT_JSON)
    kept = [c for c in responses.columns if c != "body"]
    one = F.when(F.size("parsed") == 1, F.get("parsed", F.lit(0)))
    results = [F.get_json_object("body", f"$.{path}") for path in ("resultbody", "resultbody.job")]
    wrong = F.get_json_object("body", "$.resultbody.job.items").isNotNull()
    for found in results:
        wrong = wrong | F.coalesce(~F.startswith(found, F.lit("{")), F.lit(False))
    return (
        responses.select(*kept, "body", F.when(closed, parsed).alias("parsed"))
        .select(*kept, "body", one.alias("envelope"))
        .select(
            *kept,
            F.to_json("envelope.status").alias("status_json"),
            F.array_compact("envelope.resultbody.job.items").alias("items"),
            F.col("envelope.resultbody").isNotNull().alias("has_result"),
            F.col("envelope").isNotNull().alias("is_json"),
            F.when(F.col("envelope").isNull() | F.col("envelope.resultbody.job.items").isNotNull(), False)
            .otherwise(wrong)
            .alias("wrong_shape"),
        )
    )


def is_valid(strict_status: bool = True, min_items: int = MIN_ITEMS_PER_PAGE) -> Column:
    """Success status and at least ``min_items`` items.

    With ``strict_status`` a numeric 1 is refused as the status is text.
    """
    status = F.col("status_json") == f'"{SUCCESS_STATUS}"'
    if not strict_status:
        status = status | (F.col("status_json") == SUCCESS_STATUS)
    return F.coalesce(status, F.lit(False)) & (
        F.coalesce(F.size("items"), F.lit(0)) >= min_items
    )


def page_outcomes(
    responses: DataFrame, strict_status: bool = True, reject_error_word: bool = True
) -> DataFrame:
    """One narrow row per landed page with ``good`` and ``jobs_count``."""
    usable = response_class(reject_error_word) == "ok"
    checked = responses.withColumn("body", F.when(usable, F.col("body")))
    kept = [c for c in responses.columns if c not in ("body", "status_code")]
    return parse_envelope(checked, columns=[]).select(
        *kept,
        is_valid(strict_status).alias("good"),
        F.coalesce(F.size("items"), F.lit(0)).alias("jobs_count"),
    )


def valid_pages(
    responses: DataFrame, strict_status: bool = True, reject_error_word: bool = True
) -> DataFrame:
    """Pages that pass; ``inline`` of NULL drops the others."""
    outcome = page_outcomes(responses, strict_status, reject_error_word)
    kept = [c for c in outcome.columns if c != "good"]
    return outcome.select(F.inline(F.when(F.col("good"), F.array(F.struct(*kept)))))


def page_counts(responses: DataFrame) -> DataFrame:
    """Number of items of every valid page."""
    return valid_pages(responses).select("page_id", "jobs_count")


def page_quality(responses: DataFrame) -> DataFrame:
    """Per rule, how many usable responses break it.

    ``not_json`` counts bodies that are no whole JSON object, ``wrong_shape``
    objects whose result has another form than items in a job.
    """
    parsed = parse_envelope(usable_responses(responses), columns=[])
    rules = {
        "not_json": ~F.col("is_json"),
        "wrong_shape": F.col("wrong_shape"),
        "no_status": F.col("status_json").isNull(),
        "no_resultbody": ~F.col("has_result"),
        "bad_status": F.coalesce(F.col("status_json") != f'"{SUCCESS_STATUS}"', F.lit(True)),
        "too_few_items": F.coalesce(F.size("items"), F.lit(0)) < MIN_ITEMS_PER_PAGE,
    }
    counted = parsed.agg(
        F.count("*").alias("pages"),
        *[F.count_if(broken).alias(rule) for rule, broken in rules.items()],
    )
    return counted.select(
        "pages",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("rejected"))
                    for rule in rules
                ]
            )
        ),
    )


def _field(name: str):
    return lambda item: item[name]


def explode_items(
    responses: DataFrame,
    columns: list[str] | None = None,
    strict_status: bool = True,
    reject_error_word: bool = True,
    page_flags: bool = False,
) -> DataFrame:
    """One row per item of every valid page.

    Keeps the page columns, adds ``pos`` (0-based place in the page), the item
    columns as text and the list columns as VARIANT. ``page_flags`` adds
    ``<salary column>_page_bad``: whether any item of the page has an unreadable
    value, found while the page is still one row.
    """
    parsed = parse_envelope(usable_responses(responses, reject_error_word), columns)
    kept = [c for c in parsed.columns if c not in ("status_json", "items", "has_result", "is_json", "wrong_shape")]
    if page_flags:
        parsed = parsed.withColumns({
            f"{c}_page_bad": F.exists(F.transform("items", _field(c)), is_bad_number)
            for c in SALARY_COLUMNS
        })
        kept += [f"{c}_page_bad" for c in SALARY_COLUMNS]
    good_items = F.when(is_valid(strict_status), F.col("items"))
    return parsed.select(*kept, F.posexplode(good_items).alias("pos", "item")).select(
        *kept, "pos", "item.*"
    )


def _variant_items(responses: DataFrame, group: tuple[str, ...]) -> DataFrame:
    """Items of valid pages as VARIANT, each body parsed once."""

    def items(pages: Column) -> Column:
        status = F.try_variant_get(pages, "$[0].status", "variant")
        named = F.try_variant_get(pages, "$[0].status", "string") == SUCCESS_STATUS
        alone = F.try_variant_get(pages, "$[1]", "variant").isNull()
        valid = (F.schema_of_variant(status) == "STRING") & named & alone
        return F.when(valid, F.try_variant_get(pages, "$[0].resultbody.job.items", "array<variant>"))

    # In brackets, so that text after the object is no JSON; as the one element of
    # an array, so that what was parsed once is looked at several times.
    parsed = F.try_parse_json(F.concat(F.lit("["), F.col("body"), F.lit("]")))
    listed = F.transform(F.array(parsed), items)[0]
    return usable_responses(responses).select(*group, F.explode(listed).alias("item"))


def item_columns(responses: DataFrame, *group: str) -> DataFrame:
    """Per group of pages the columns its items have: ``column_name`` and ``items``,
    the number of items with a value other than null.

    Keys that no schema declares are found as well.
    """
    keys = F.try_variant_get("item", "$", "map<string, variant>")
    return (
        _variant_items(responses, group)
        .select(*group, F.explode(keys).alias("column_name", "value"))
        .where(~F.is_variant_null("value"))
        .groupBy(*group, "column_name")
        .agg(F.count("*").alias("items"))
    )


def item_schemas(responses: DataFrame, *group: str) -> DataFrame:
    """Per group of pages ``item_schema``, the merged schema of its items as text."""
    items = _variant_items(responses, group)
    return items.groupBy(*group).agg(F.schema_of_variant_agg("item").alias("item_schema"))
