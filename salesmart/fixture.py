"""Staging rows derived from the TPC-H-like test tables, one per lineitem.

The text below runs in Spark and in DuckDB, its tables being filled in. It injects the irregularities that the
cleaning rules, the deduplication and the joins have to deal with (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import BROADCAST_ROWS
from salesmart.schemas import STAGING_COLUMNS
from salesmart.workspace import Workspace, shuffles_removed

#: Line items that are joined at a time: what the shuffles of a slice write, some 130 bytes a row,
#: is on disk until the slice is stored.
SLICE_ROWS = 120_000_000

#: The stored rows are text alone. Columns of many values gain nothing by large dictionaries.
STORED = {"compression": "zstd", "parquet.dictionary.page.size": str(2**18)}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

STAGING_SQL = """
select
  concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))            as id,
  concat('First', cast(c_custkey % 200 as string))                                 as customer_first_name,
  c_name                                                                           as customer_last_name,
  case when c_custkey % 53 = 0 then 'unknown'
       else cast(18 + c_custkey % 60 as string) end                                as customer_age,
  case when c_custkey % 211 = 0 then null when c_custkey % 223 = 0 then ''
       else concat('c', cast(c_custkey as string), '@example.com') end             as customer_email,
  cn.n_name                                                                        as customer_country,
  case when c_custkey % 7 = 0 then null
       else cast(10000 + c_custkey % 900 as string) end                            as customer_postal_code,
  c_mktsegment                                                                     as customer_pet_type,
  concat('Pet', cast(c_custkey % 40 as string))                                    as customer_pet_name,
  concat('Breed', cast(c_custkey % 12 as string))                                  as customer_pet_breed,
  concat('SellerF', cast(o_custkey % 37 as string))                                as seller_first_name,
  concat('SellerL', cast(o_custkey % 37 as string))                                as seller_last_name,
  case when o_custkey % 37 = 36 then null
       else concat('s', cast(o_custkey % 37 as string), '@example.com') end        as seller_email,
  sr.r_name                                                                        as seller_country,
  cast(20000 + o_custkey % 5 as string)                                            as seller_postal_code,
  case when p_partkey % 199 = 0 then null else p_name end                          as product_name,
  case when p_type = 'SMALL' then null else p_type end                             as product_category,
  case when p_partkey % 101 = 0 then 'free'
       else cast(cast(p_retailprice as decimal(10,2)) as string) end               as product_price,
  cast(p_size as string)                                                           as product_quantity,
  case when l_orderkey % 499 = 0 then '' when l_orderkey % 503 = 0 then '13/45/2001'
       else concat(cast(month(l_shipdate) as string), '/', cast(day(l_shipdate) as string),
                   '/', cast(year(l_shipdate) as string)) end                      as sale_date,
  cast(o_custkey as string)                                                        as sale_customer_id,
  cast(o_custkey % 37 as string)                                                   as sale_seller_id,
  cast(l_partkey as string)                                                        as sale_product_id,
  case when l_orderkey % 307 = 0 then 'n/a' when l_orderkey % 311 = 0 then '12.7'
       when l_orderkey % 313 = 0 then ' 7 '
       else cast(cast(l_quantity as int) as string) end                            as sale_quantity,
  case when l_orderkey % 401 = 0 then '-1.00'
       else cast(cast(l_extendedprice as decimal(12,2)) as string) end             as sale_total_price,
  case when l_suppkey % 100 = 3 then null
       else concat('Store', cast(l_suppkey % 10 as string)) end                    as store_name,
  concat('Loc', cast(l_suppkey % 10 as string))                                    as store_location,
  sn.n_name                                                                        as store_city,
  l_linestatus                                                                     as store_state,
  sr.r_name                                                                        as store_country,
  concat('p', cast(l_suppkey % 10 as string))                                      as store_phone,
  concat('st', cast(l_suppkey % 10 as string), '@example.com')                     as store_email,
  o_orderpriority                                                                  as pet_category,
  cast(cast(p_size as decimal(10,2)) as string)                                    as product_weight,
  case when p_size % 5 = 0 then null else 'red' end                                as product_color,
  cast(p_size % 4 as string)                                                       as product_size,
  case when p_partkey % 89 = 0 then null else p_brand end                          as product_brand,
  'steel'                                                                          as product_material,
  p_name                                                                           as product_description,
  case when p_partkey % 61 = 0 then ''
       else cast(cast(1 + (p_partkey % 41) * 0.1 as decimal(3,1)) as string) end   as product_rating,
  cast((p_partkey * 37) % 1000 as string)                                          as product_reviews,
  '1/2/2019'                                                                       as product_release_date,
  case when p_size % 3 = 0 then '' when p_size % 3 = 1 then null
       else '12/31/2030' end                                                       as product_expiry_date,
  s_name                                                                           as supplier_name,
  concat('Contact', cast(s_suppkey as string))                                     as supplier_contact,
  case when s_suppkey % 100 = 5 then null
       else concat('sup', cast(s_suppkey as string), '@example.com') end           as supplier_email,
  concat('sp', cast(s_suppkey as string))                                          as supplier_phone,
  concat('Addr', cast(s_suppkey % 9 as string))                                    as supplier_address,
  sn.n_name                                                                        as supplier_city,
  sr.r_name                                                                        as supplier_country
from {lineitem}
join {orders}    on o_orderkey = l_orderkey
join {customer}  on c_custkey  = o_custkey
join {nation} cn on cn.n_nationkey = c_nationkey
join {part}      on p_partkey  = l_partkey
join {supplier}  on s_suppkey  = l_suppkey
join {nation} sn on sn.n_nationkey = s_nationkey
join {region} sr on sr.r_regionkey = sn.n_regionkey
"""


def joined(tables: dict[str, DataFrame]) -> DataFrame:
    """The joins of the text above, with ``cn``, ``sn`` and ``sr`` as structs, so that its columns
    can be taken from this one table.

    Customers join the orders and nations the suppliers, before either meets the line items, so
    the long side is moved once by order, still short, and once more only for parts that Spark
    does not broadcast. Suppliers are broadcast up to a fixed number.
    """
    named = F.struct("n_name").alias
    customers = tables["customer"].join(F.broadcast(tables["nation"]), F.expr("n_nationkey = c_nationkey"))
    customers = customers.select("c_custkey", "c_name", "c_mktsegment", named("cn"))
    places = tables["nation"].join(tables["region"], F.expr("r_regionkey = n_regionkey"))
    places = places.select("n_nationkey", named("sn"), F.struct("r_name").alias("sr"))
    suppliers = tables["supplier"].join(F.broadcast(places), F.expr("n_nationkey = s_nationkey"))
    suppliers = suppliers.select("s_suppkey", "s_name", "sn", "sr")
    if tables["supplier"].count() <= BROADCAST_ROWS:
        suppliers = F.broadcast(suppliers)
    orders = tables["orders"].join(customers, F.expr("c_custkey = o_custkey"))
    return (
        tables["lineitem"]
        .join(orders, F.expr("o_orderkey = l_orderkey"))
        .join(tables["part"], F.expr("p_partkey = l_partkey"))
        .join(suppliers, F.expr("s_suppkey = l_suppkey"))
    )


def staging(spark: SparkSession, folder: str, slices: int = 1, number: int = 0) -> DataFrame:
    """The staging rows, or those of the orders whose hash falls into one of several slices."""
    tables = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in TABLES}
    # A tiny file is read by fewer tasks than there are cores, and the joins below keep its
    # partitions. At scale the scan has far more tasks and nothing is moved.
    cores = spark.sparkContext.defaultParallelism
    if tables["lineitem"].rdd.getNumPartitions() < cores:
        tables["lineitem"] = tables["lineitem"].repartition(cores)
    if slices > 1:
        for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
            place = F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(slices))
            tables[name] = tables[name].where(place == number)
    columns = STAGING_SQL.partition("from {lineitem}")[0]
    return spark.sql(columns + "from {rows}", rows=joined(tables)).select(*STAGING_COLUMNS)


def store_staging(spark: SparkSession, folder: str, workspace: Workspace) -> DataFrame:
    """The staging rows, joined and stored in slices of orders, so that the shuffle files on disk do not
    grow with the table: those of a slice are deleted before the next one."""
    slices = max(1, -(-spark.read.parquet(f"{folder}/lineitem.parquet").count() // SLICE_ROWS))
    with shuffles_removed(spark):
        for number in range(slices):
            mode = "append" if number else "overwrite"
            rows = staging(spark, folder, slices, number)
            stored = workspace.store("staging", rows, mode=mode, options=STORED)
    return stored
