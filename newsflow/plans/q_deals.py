"""Named queries for the deals parser and load (step 6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.functions import deals as DF
from newsflow.operators.deals import DEAL_COLUMNS, new_deals, parse_deals
from newsflow.plans import fixtures as fx
from newsflow.plans import sql_text as S
from newsflow.plans.registry import query

_N = "CAST(floor(o_totalprice / 1000) AS INTEGER)"
_N_SQL = f"CAST({_N} AS VARCHAR)"

DEALS_SQL = f"""deals_raw AS (
  SELECT o_orderkey,
         concat('Co', CAST(o_custkey AS VARCHAR)) AS company,
         CAST(o_orderdate AS DATE) AS pubDate,
         concat('Investor ', o_orderpriority) AS investors,
         CASE o_orderkey % 9
           WHEN 0 THEN NULL
           WHEN 1 THEN concat('$', {_N_SQL}, ' million')
           WHEN 2 THEN concat('€', {_N_SQL}, ' million')
           WHEN 3 THEN concat('£', {_N_SQL}, ' billion')
           WHEN 4 THEN concat('CDN$', {_N_SQL}, ' million')
           WHEN 5 THEN concat('AUS$', {_N_SQL}, ',250.5 million')
           WHEN 6 THEN concat('¥', {_N_SQL}, ' billion')
           WHEN 7 THEN concat('US$', {_N_SQL}, ' million')
           ELSE '$undisclosed' END AS deal_size,
         o_orderstatus AS type,
         o_orderpriority AS series_round
  FROM orders)"""


def deals_raw(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    n = F.floor(F.col("o_totalprice") / 1000).cast("int").cast("string")
    k = F.col("o_orderkey") % 9
    size = (
        F.when(k == 0, F.lit(None).cast("string"))
        .when(k == 1, F.concat(F.lit("$"), n, F.lit(" million")))
        .when(k == 2, F.concat(F.lit("€"), n, F.lit(" million")))
        .when(k == 3, F.concat(F.lit("£"), n, F.lit(" billion")))
        .when(k == 4, F.concat(F.lit("CDN$"), n, F.lit(" million")))
        .when(k == 5, F.concat(F.lit("AUS$"), n, F.lit(",250.5 million")))
        .when(k == 6, F.concat(F.lit("¥"), n, F.lit(" billion")))
        .when(k == 7, F.concat(F.lit("US$"), n, F.lit(" million")))
        .otherwise(F.lit("$undisclosed"))
    )
    return o.select(
        "o_orderkey",
        F.concat(F.lit("Co"), F.col("o_custkey").cast("string")).alias("company"),
        F.col("o_orderdate").cast("date").alias("pubDate"),
        F.concat(F.lit("Investor "), F.col("o_orderpriority")).alias("investors"),
        size.alias("deal_size"),
        F.col("o_orderstatus").alias("type"),
        F.col("o_orderpriority").alias("series_round"),
    )


_S = "coalesce(deal_size, 'None')"
_CURRENCY = (
    f"CASE WHEN contains({_S}, 'None') THEN 'None' WHEN contains({_S}, '¥') THEN 'JPY' "
    f"WHEN contains({_S}, '£') THEN 'GBP' WHEN contains({_S}, 'AUS$') THEN 'AUS' "
    f"WHEN contains({_S}, 'CDN$') THEN 'CDN' WHEN contains({_S}, '€') THEN 'EUR' "
    f"WHEN contains({_S}, '$') THEN 'USD' END"
)
_TRIM = _S
for a, b in DF.AMOUNT_REMOVALS:
    _TRIM = f"replace({_TRIM}, {S.q(a)}, {S.q(b)})"
_TRIM = S.strip(_TRIM)


def _unit_strip(x: str, unit: str) -> str:
    chars = "".join(sorted(set(" " + unit)))
    return f"regexp_replace({x}, '^[{chars}]+|[{chars}]+$', '', 'g')"


_COMPAT = (
    f"CASE WHEN contains(x, '0') THEN CAST(0 AS DECIMAL(20,2)) "
    f"WHEN contains(x, 'million') THEN CAST(TRY_CAST({_unit_strip('x', 'million')} AS DECIMAL(38,6)) * 1000000 AS DECIMAL(20,2)) "
    f"WHEN contains(x, 'billion') THEN CAST(TRY_CAST({_unit_strip('x', 'billion')} AS DECIMAL(38,6)) * 1000000000 AS DECIMAL(20,2)) END"
)
_NUM = "TRY_CAST(regexp_extract(replace(x, ',', ''), '([0-9]+(\\.[0-9]+)?)', 1) AS DECIMAL(38,6))"
_VALUE = (
    "CASE WHEN deal_size IS NULL THEN CAST(0 AS DECIMAL(20,2)) "
    f"WHEN contains(x, 'million') THEN CAST({_NUM} * 1000000 AS DECIMAL(20,2)) "
    f"WHEN contains(x, 'billion') THEN CAST({_NUM} * 1000000000 AS DECIMAL(20,2)) END"
)
PARSED_SQL = f"""{DEALS_SQL},
trimmed AS (SELECT *, {_CURRENCY} AS deal_currency, {_TRIM} AS x FROM deals_raw),
parsed AS (SELECT *, {_COMPAT} AS deal_value_compat, {_VALUE} AS deal_value FROM trimmed)"""


@query("deal_currency", f"WITH {PARSED_SQL} SELECT o_orderkey, deal_size, deal_currency, x AS deal_trim FROM parsed")
def q_deal_currency(spark, sf_dir):
    d = deals_raw(spark, sf_dir)
    return d.select("o_orderkey", "deal_size", DF.deal_currency("deal_size").alias("deal_currency"), DF.deal_trim("deal_size").alias("deal_trim"))


@query("deal_value_compat", f"WITH {PARSED_SQL} SELECT o_orderkey, deal_size, deal_value_compat AS deal_value FROM parsed")
def q_deal_value_compat(spark, sf_dir):
    d = parse_deals(deals_raw(spark, sf_dir), compat=True)
    return d.select("o_orderkey", "deal_size", "deal_value")


@query("deal_value", f"WITH {PARSED_SQL} SELECT o_orderkey, deal_size, deal_value FROM parsed")
def q_deal_value(spark, sf_dir):
    d = parse_deals(deals_raw(spark, sf_dir))
    return d.select("o_orderkey", "deal_size", "deal_value")


@query(
    "new_deals",
    f"""WITH {PARSED_SQL},
existing AS (SELECT company, pubDate, deal_size FROM parsed WHERE o_orderkey % 4 = 0)
SELECT {", ".join(DEAL_COLUMNS)} FROM parsed p
WHERE NOT EXISTS (
  SELECT 1 FROM existing e
  WHERE e.company IS NOT DISTINCT FROM p.company AND e.pubDate IS NOT DISTINCT FROM p.pubDate
    AND e.deal_size IS NOT DISTINCT FROM p.deal_size)""",
)
def q_new_deals(spark, sf_dir):
    parsed = parse_deals(deals_raw(spark, sf_dir))
    existing = parsed.where(F.col("o_orderkey") % 4 == 0)
    return new_deals(parsed, existing)


@query(
    "new_deals_filled",
    f"""WITH {PARSED_SQL},
filled AS (SELECT * REPLACE (coalesce(deal_size, 'None') AS deal_size) FROM parsed),
existing AS (SELECT company, pubDate, deal_size FROM filled WHERE o_orderkey % 4 = 0)
SELECT {", ".join(DEAL_COLUMNS)} FROM filled p
WHERE NOT EXISTS (
  SELECT 1 FROM existing e
  WHERE e.company = p.company AND e.pubDate = p.pubDate AND e.deal_size = p.deal_size)""",
)
def q_new_deals_filled(spark, sf_dir):
    """Against a table that stores missing sizes as text."""
    parsed = parse_deals(deals_raw(spark, sf_dir), fill_missing=True)
    return new_deals(parsed, parsed.where(F.col("o_orderkey") % 4 == 0))
