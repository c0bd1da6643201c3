"""URL verdicts: rules by host and path, else a logistic regression on character n-grams.

The regression reads hashed n-grams of host and path. A gram's bucket is a
polynomial of its bytes' code points, which any SQL engine computes alike, and
weights are whole numbers, so a score does not depend on the order of a sum.
Training looks at a small table of labelled URLs only (``MOST_LABELLED`` at
most); scoring is one projection of built-in functions, without any shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.llm.common import UPPER, ascii_lower

GRAM = 4
BUCKETS = 1 << 12
UNIT = 1_000_000  # weights and scores are whole millionths
MOST_LABELLED = 1000
BLOCK_ABOVE = 700_000  # of the score: block at a probability of two thirds

# Fixed values: (verdict, host, path); hosts with a label more are covered too.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

# Labelled URLs to learn from, 1: block.
LABELLED = [
    (1, "http://casino-bonus.example.com/en/play.html"),
    (1, "https://www.casino-win.example.com/en/jackpot"),
    (1, "http://best-casino.example.com/slots/free"),
    (1, "https://m.online-casino.example.com/win?id=3"),
    (1, "http://free-bets.example.com/en/odds.html"),
    (1, "https://www.free-bets24.example.com/sport/bet"),
    (1, "http://betting-tips.example.com/bets/win"),
    (1, "http://cheap-pills.example.com/en/order"),
    (1, "https://www.cheap-pills.example.com/fr/buy"),
    (1, "http://pills-online.example.com/cheap/viagra"),
    (1, "http://buy-cheap-meds.example.com/pharmacy"),
    (1, "https://spam-farm.example.com/en/links.html"),
    (1, "http://link-farm.example.com/seo/spam"),
    (1, "http://www.spam-farm.example.com/es/page?ref=x"),
    (1, "http://porn-tube.example.com/xxx/free"),
    (1, "https://xxx-cams.example.com/adult/live"),
    (1, "http://win-prizes.example.com/free-money"),
    (1, "http://payday-loans.example.com/fast-cash"),
    (1, "https://replica-watches.example.com/buy-cheap"),
    (1, "http://poker-rooms.example.com/casino/bonus"),
    (1, "http://ads.example.com/track/click?id=3"),
    (1, "https://ad-server.example.com/pixel"),
    (1, "http://banner-ads.example.com/track"),
    (1, "https://www.ads-tracker.example.com/en/banner.html"),
    (1, "http://track-clicks.example.com/ads"),
    (0, "https://www.example.com/en/about.html"),
    (0, "https://blog.example.com/en/2021/notes"),
    (0, "http://news.example.com/world/article/123"),
    (0, "https://docs.example.com/guide/install.html"),
    (0, "http://m.example.com/fr/recette/4411"),
    (0, "https://www.theater.example.com/es/programa/"),
    (0, "https://library.example.com/books/9911?page=2"),
    (0, "http://forum.example.com/thread/1021#top"),
    (0, "https://wiki.example.com/de/artikel/1234"),
    (0, "http://university.example.com/en/research/77"),
    (0, "https://museum.example.com/collection/404.html"),
    (0, "https://www.weather.example.com/en/today"),
    (0, "http://recipes.example.com/en/bread/2121"),
    (0, "https://history.example.com/fr/siecle/18"),
    (0, "http://blog.travel.example.com/en/6142?utm_source=feed"),
    (0, "https://m.science.example.com/en/5570?page=2&ref=x"),
    (0, "http://health.example.com/en/advice/8123/"),
    (0, "https://garden.example.com/plants/4402#top"),
    (0, "http://www.station.example.com/en/3314.html"),
    (0, "https://other.example.com/en/9056"),
    (0, "http://thing.example.com/de/7121/"),
    (0, "https://nation.example.com/es/1188?utm_source=feed"),
    (0, "http://blog.mother.example.com/fr/2570.html"),
    (0, "https://these.example.com/en/845"),
    (0, "http://m.ration.example.com/en/3021?page=2&ref=x"),
    (0, "https://theshore.example.org/en/4120.html"),
    (0, "http://www.thous.example.org/en/777/"),
    (0, "https://those.example.com/en/6402#top"),
    (0, "http://m.ethesis.example.org/es/99"),
    (0, "https://house.example.com/en/1410?utm_source=feed"),
]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty without ``://``."""
    rest = F.regexp_extract(url, r"^(?s:.*?)://((?s:.*))$", 1)
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.coalesce(host, empty), F.coalesce(path, empty)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name (like ``net/``) and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


# --- the regression ---------------------------------------------------------------

def _buckets(text: str, space: int) -> list[int]:
    codes = [ord(c) for c in text]
    found = []
    for i in range(len(codes) - GRAM + 1):
        bucket = space
        for code in codes[i : i + GRAM]:
            bucket = (bucket * 257 + code) % 1_000_003
        found.append(bucket % BUCKETS)
    return found


def _marked(host: str, path: str) -> list[str]:
    return [f"^{host}$", f"{path}$"]


def train(labelled=LABELLED, rounds: int = 300, rate: float = 0.5, decay: float = 1e-3) -> tuple[list[int], int]:
    """(weight per bucket, bias) in whole millionths, by gradient descent.

    Grams weigh by their share of their URL's grams, so long URLs count no
    more than short ones. Empty URLs have the bias alone.
    """
    if len(labelled) > MOST_LABELLED:
        raise ValueError(f"at most {MOST_LABELLED} labelled URLs")
    examples = []
    for label, url in labelled:
        _, _, rest = url.partition("://")
        ends = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = rest[:ends].lower()
        path = rest[ends:].split("?")[0].split("#")[0]
        grams = [b for space, part in enumerate(_marked(host, path)) for b in _buckets(part, space + 1)]
        examples.append((label, grams))
    weights, bias = [0.0] * BUCKETS, 0.0
    for _ in range(rounds):
        for label, grams in examples:
            score = bias + sum(weights[g] for g in grams) / max(1, len(grams)) * 10
            error = label - 1 / (1 + math.exp(-score))
            bias += rate * error * 0.1
            for g in grams:
                weights[g] += rate * (error * 10 / len(grams) - decay * weights[g])
    return [round(w * UNIT) for w in weights], round(bias * UNIT)


def _gram_sum(text: Column, space: int, weights: Column) -> Column:
    """Sum of the weights of all grams of one marked text."""

    def weight(start):
        bucket = F.lit(space).cast("long")
        for k in range(GRAM):
            bucket = (bucket * 257 + F.ascii(F.substring(text, start + k, 1))) % 1_000_003
        return F.element_at(weights, (bucket % BUCKETS + 1).cast("int"))

    starts = F.when(
        F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - GRAM + 1)
    ).otherwise(F.array().cast("array<int>"))
    return F.aggregate(starts, F.lit(0).cast("long"), lambda total, start: total + weight(start))


def logit_millionths(host: Column, path: Column, model: tuple[list[int], int]) -> Column:
    """Score of the regression in whole millionths; block above ``BLOCK_ABOVE``."""
    weights, bias = model
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<long>")  # folded once
    parts = [F.concat(F.lit("^"), host, F.lit("$")), F.concat(path, F.lit("$"))]
    total, grams = F.lit(0).cast("long"), F.lit(0)
    for space, part in enumerate(parts):
        total = total + _gram_sum(part, space + 1, table)
        grams = grams + F.greatest(F.length(part) - (GRAM - 1), F.lit(0))
    return F.floor(total * 10 / F.greatest(grams, F.lit(1))).cast("long") + F.lit(bias)


def judge(pages: DataFrame, model: tuple[list[int], int] | None = None, rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule, logit and verdict.

    Null URLs and texts without ``://`` have an empty host and path and get
    the regression's verdict on those. Repeated rows are judged alike, no rows
    give no rows, and columns named like the results are replaced.
    """
    host, path = url_parts(F.col("url"))
    parted = pages.withColumns({"host": host, "path": path})
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    scored = parted.withColumns(
        {"rule": rule, "logit": logit_millionths(F.col("host"), F.col("path"), model or train())}
    )
    learned = F.when(F.col("logit") > BLOCK_ABOVE, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("verdict", F.coalesce(verdict, learned))


def oracle(model: tuple[list[int], int] | None = None) -> str:
    """The verdicts in SQL; the model's weights stand in it as numbers."""
    weights, bias = model or train()
    known = ", ".join(f"({b}, {w})" for b, w in enumerate(weights) if w)
    gram = "{space}"
    for k in range(GRAM):
        gram = f"(({gram}) * 257 + ascii(substr(t, i + {k}, 1))) % 1000003"
    best = "null"
    said = "null"
    for what, host, path in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}')"
        best = f"case when {fits} then '{host}{path}' else {best} end"
        said = f"case when {fits} then '{what}' else {said} end"
    spaces = "\n  union all\n".join(
        f"  select page_id, url, i, ({gram.format(space=n)}) % {BUCKETS} as bucket "
        f"from (select page_id, url, {t} as t from parted) p, "
        f"lateral (select unnest(generate_series(1, length(t) - {GRAM - 1})) as i) g"
        for n, t in ((1, "'^' || host || '$'"), (2, "path || '$'"))
    )
    return f"""
with rest as (
  select page_id, url, case when strpos(coalesce(url, ''), '://') > 0
    then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), parted as (
  select page_id, url,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', lower('{UPPER}')) as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from rest
), weights(bucket, weight) as (values {known}),
grams as (
{spaces}
), sums as (
  select g.page_id, sum(coalesce(w.weight, 0)) as total, count(*) as n
  from grams g left join weights w using (bucket) group by 1
), scored as (
  select p.page_id, p.host, p.path, {best} as rule, {said} as said,
    cast(floor(cast(coalesce(s.total, 0) * 10 as double) / greatest(coalesce(s.n, 0), 1)) as bigint) + {bias} as logit
  from parted p left join sums s on s.page_id = p.page_id
)
select page_id, host, path, rule,
  coalesce(said, case when logit > {BLOCK_ABOVE} then 'block' else 'allow' end) as verdict, logit
from scored
"""
