"""Fixture views over the driver tables (FIXTURES.md section 2).

The same SQL text is registered in Spark (as temp views) and inlined as CTEs in the DuckDB oracles,
so both engines see identical inputs. Views only reshape the driver tables; every view scans its whole
base table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

VIEWS: dict[str, str] = {
    "cars_raw": """
select o_orderkey as car_id,
  'model_' || cast(o_orderkey % 40 as string) as car_name,
  case when o_orderkey % 29 = 0 then null else extract(year from o_orderdate) + (o_orderkey % 20) end as year,
  case when o_orderkey % 31 = 0 then null else o_totalprice / 45000 end as selling_price,
  case when o_orderkey % 17 = 0 then null else o_totalprice / 41000 end as present_price,
  case when o_orderkey % 37 = 0 then null else (o_orderkey * 7919) % 1100000 - 1000 end as kms_driven,
  case when o_orderkey % 23 = 0 then null when o_orderstatus = 'F' then 'Petrol' when o_orderstatus = 'O' then 'Diesel' else 'CNG' end as fuel_type,
  case when o_orderkey % 19 = 0 then null when o_orderpriority in ('1-URGENT', '2-HIGH') then 'Dealer' else 'Individual' end as seller_type,
  case when o_orderkey % 4 = 0 then 'Automatic' else 'Manual' end as transmission,
  o_orderkey % 3 as owner
from orders""",
    "tx_raw": """
with base as (
  select event_id,
    cast(event_id as string) as tranaction_id,
    case when event_id % 41 = 0 then 'not-a-date' else cast(date_trunc('second', ts) as string) end as tx_datetime,
    case when event_id % 11 = 0 then '0' when event_id % 43 = 0 then null else cast(user_id + 1 as string) end as customer_id,
    case when event_id % 7 = 0 then '0' when event_id % 47 = 0 then 'bad' else cast(event_id % 100 + 1 as string) end as terminal_id,
    case when event_id % 53 = 0 then null else cast(cast(floor(value * 100) as bigint) as string) end as tx_amount,
    cast(event_id * 60 as string) as tx_time_seconds,
    cast(cast(floor(event_id / cast(1440 as double)) as bigint) as string) as tx_time_days,
    case when event_type = 'error' then '1' else '0' end as tx_fraud,
    '0' as tx_fraud_scenario
  from events)
select tranaction_id, tx_datetime, customer_id, terminal_id, tx_amount, tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario from base
union all
select tranaction_id, tx_datetime, customer_id, terminal_id, tx_amount, tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario from base where event_id % 50 = 0""",
    "url_raw": """
select page_id, url, case when page_id % 17 = 0 then 'unknown' when url like 'http://%' then 'bad' else 'good' end as label
from pages""",
    "temps": """
select cast(cast(o_orderdate as date) as string) as dt,
  case when o_custkey % 13 = 0 then null else o_orderpriority end as country,
  case when o_orderpriority = '5-LOW' or o_orderkey % 9 = 0 then null else o_totalprice / 9700 - 15 end as average_temperature
from orders""",
    "preds": """
select doc_id, quality as y, 1 - toxic as yhat_prod,
  case when doc_id % 5 = 0 then quality else 1 - toxic end as yhat_cand
from labels""",
    "scored": """
select car_id, selling_price as y, present_price * 8.5e-1 + (car_id % 7 - 3) * 1e-1 as yhat
from cars_raw where selling_price is not null and present_price is not null""",
    "pred_log": """
select event_id, ts, user_id as source, event_type <> 'error' as ok, value / 100 as latency_s
from events""",
    "cpu_samples": """
select ts, user_id % 5 as pod, 2.5e-1 as cpu_limit,
  ((extract(hour from ts) % 2) * 3600 + extract(minute from ts) * 60 + cast(floor(extract(second from ts)) as int))
    * (user_id % 5 + 1) / 1024e0 as cpu_seconds
from events""",
    "requests": """
select car_id,
  case when car_id % 61 = 0 then 'not json' else '{'
    || case when year is null then '' else '"Year":' || cast(year as string) || ',' end
    || case when present_price is null then '' else '"Present_Price":' || cast(cast(floor(present_price) as bigint) as string) || ',' end
    || case when kms_driven is null then '' else '"Kms_Driven":' || cast(kms_driven as string) || ',' end
    || '"Owner":' || cast(owner as string) || ',"Car_Age":5,"Kms_Per_Year":1000,'
    || case when fuel_type is null then '' else '"Fuel_Type":"' || fuel_type || '",' end
    || case when seller_type is null then '' else '"Seller_Type":"' || seller_type || '",' end
    || '"Transmission":"' || transmission || '"}' end as value
from cars_raw""",
    "alerts": """
select event_id, case when event_id % 3 = 0 then '{"title":"t' || cast(event_id as string) || '","state":"alerting"}'
  else '{"message":"m' || cast(event_id as string) || '"}' end as value
from events where event_type = 'error'""",
    "model_versions": """
select 'm' || cast(s_nationkey % 3 as string) as model_name, s_suppkey as version, s_acctbal / 10000 as r2,
  case when s_suppkey % 4 = 0 then 'Production' when s_suppkey % 4 = 1 then 'Staging' when s_suppkey % 4 = 2 then 'Archived' else 'None' end as stage
from supplier""",
}

# Which views a view body reads (so oracles inline dependencies first).
VIEW_DEPS = {"scored": ["cars_raw"], "requests": ["cars_raw"]}
# Which driver table each view scans.
VIEW_BASE = {"cars_raw": "orders", "tx_raw": "events", "url_raw": "pages", "temps": "orders", "preds": "labels",
             "scored": "orders", "pred_log": "events", "cpu_samples": "events", "requests": "orders",
             "alerts": "events", "model_versions": "supplier"}

# Base-table DataFrame definitions per (session, directory, table): resolving a Parquet schema reads
# file footers, which is worth doing once per session rather than once per query.
_BASE_CACHE: dict[tuple[int, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (id(spark), sf_dir.rstrip("/"), name)
    df = _BASE_CACHE.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _BASE_CACHE[key] = df
    return df


def register_base(spark: SparkSession, sf_dir: str, tables: list[str] | None = None) -> None:
    for t in tables or BASE_TABLES:
        table(spark, sf_dir, t).createOrReplaceTempView(t)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Register the base table the view scans, its view dependencies and the view; return it."""
    register_base(spark, sf_dir, [VIEW_BASE[name]])
    for dep in VIEW_DEPS.get(name, []):
        spark.sql(VIEWS[dep]).createOrReplaceTempView(dep)
    df = spark.sql(VIEWS[name])
    df.createOrReplaceTempView(name)
    return df


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with CTEs for the named views (dependencies first)."""
    order: list[str] = []
    for n in names:
        for dep in VIEW_DEPS.get(n, []):
            if dep not in order:
                order.append(dep)
        if n not in order:
            order.append(n)
    ctes = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in order)
    return f"with {ctes}\n{sql.strip()}"
