"""The brand table, derived from the delivered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# One SELECT that Spark and the oracle both run, one row per part, with every
# kind of dirt the cleaning rules have to handle. Table names are filled in by the caller.
BRANDS_SQL = """
with li as (
  select l_partkey, count(*) as n_li, cast(round(sum(l_quantity)) as bigint) as qty
  from {lineitem} group by l_partkey),
pk as (
  select p_partkey, p_name, p_brand, p_size,
         p_partkey % (select count(*) from {supplier}) as supp_ref,
         p_partkey % (select count(*) from {documents}) as doc_ref
  from {part}),
b as (
  select p.p_partkey as k, p.p_name, p.p_brand, p.p_size,
         n.n_name, d.text, coalesce(li.n_li, 0) as n_li, coalesce(li.qty, 0) as qty
  from pk p
  left join li on li.l_partkey = p.p_partkey
  left join {supplier} s on s.s_suppkey = p.supp_ref
  left join {nation} n on n.n_nationkey = s.s_nationkey
  left join {documents} d on d.doc_id = p.doc_ref)
select k as row_id,
 case when k % 41 = 0 then null when k % 7 = 0 then concat('ООО «', p_name, '»')
      when k % 7 = 1 then concat(upper(p_name), ' ', p_name)
      else concat(p_name, '  ', p_brand) end as name,
 case k % 13 when 0 then null when 1 then ' Росия ' when 2 then 'USA'
      when 3 then 'Беларусь!' when 4 then '***' else n_name end as contry_origin,
 case when k % 29 = 0 then null when k % 29 = 1 then 'Неизвестно'
      when k % 499 = 5 then concat('rare-', cast(k as varchar(20)))
      else concat(' ', p_brand, ' ') end as domain,
 case when k % 17 = 0 then null when k % 17 = 1 then 'неизвестно'
      when k % 5 = 0 then 'Средний, дисконт:средний' when k % 5 = 1 then 'ниже среднего'
      when k % 5 = 2 then 'выше среднего; люкс / премиум'
      when k % 5 = 3 then 'средний;неизвестно' else 'дисконт' end as price_category,
 case when k % 19 = 0 then null when k % 19 = 1 then '1700' when k % 19 = 2 then '2090'
      when k % 19 = 3 then 'около 1990'
      else cast(1900 + p_size * 2 as varchar(20)) end as founded,
 case when k % 23 = 0 then '-5' when k % 23 = 1 then 'abc'
      else cast(n_li * 40 as varchar(20)) end as presence_world,
 case k % 6 when 0 then null when 1 then '21'
      when 2 then concat(cast(p_size as varchar(20)), ' и ', cast(n_li as varchar(20)), ' франчайзинговых')
      when 3 then concat(cast(p_size as varchar(20)), ' Франчайзинговых')
      when 4 then 'нет данных' else 'франчайзинг' end as presence_russia,
 case k % 4 when 0 then null when 1 then 'Москва; ; Казань'
      when 2 then concat('Москва;', n_name, ';Уфа;') else ' ; ' end as presence_regions,
 case when k % 31 = 0 then null when k % 31 = 1 then '   '
      when k % 3 = 0 then concat(text, ' Основана в 1998 году, 2012г.') else text end as description,
 case when k % 37 = 0 then null else cast(p_size as varchar(20)) end as plans,
 case when k % 8 = 0 then cast(qty * 25 as varchar(20)) when k % 8 = 1 then '0' end as total_rented_area
from b
"""
BRAND_TABLES = ["lineitem", "supplier", "documents", "part", "nation"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty brand table with its misspelled country column and a row id."""
    tables = {t: table(spark, sf_dir, t) for t in BRAND_TABLES}
    return spark.sql(BRANDS_SQL, **tables)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def brands_oracle() -> str:
    """The same SELECT over plain table names."""
    return BRANDS_SQL.format(**{t: t for t in BRAND_TABLES})
