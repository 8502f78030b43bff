"""Query op5: a verdict for every page's url."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickhouse.llm import urls
from tickhouse.llm.registry import register, table

# The rules of this query.
RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


def found(term: str) -> str:
    return f"regexp_matches(lower(coalesce(url, '')), '(^|[^\\p{{L}}\\p{{N}}]){term}([^\\p{{L}}\\p{{N}}]|$)')"


def fitting() -> str:
    cases = []
    for rule in sorted(RULES, key=lambda r: (-len(r), r)):
        host, path = urls.split_rule(rule)
        cases.append(
            f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}')"
            f" then '{rule}'"
        )
    return "case " + " ".join(cases) + " end"


SQL = f"""
with parts as (
  select page_id, url,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path,
    cast({" + ".join(f"cast({found(t)} as int)" for t in urls.STRICT)} as bigint) as n_strict,
    cast({" + ".join(f"cast({found(t)} as int)" for t in urls.SOFT)} as bigint) as n_soft,
    cast({" + ".join(f"{w} * cast({found(t)} as int)" for t, w in urls.SOFT.items())} as double) as soft_weight
  from pages
), ruled as (select *, {fitting()} as rule from parts)
select page_id, host, path, rule,
  case {" ".join(f"when rule = '{r}' then '{v}'" for r, v in RULES.items())}
    when n_strict > 0 or (n_soft >= {urls.MIN_SOFT} and soft_weight >= {urls.SOFT_LIMIT}) then 'block'
    else 'allow' end as verdict, n_strict, n_soft, soft_weight
from ruled
"""


@register("op5_url_vocabulary", SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(pages, RULES).select(
        "page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight"
    )
