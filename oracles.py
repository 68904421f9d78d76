"""The expected results in DuckDB SQL, stated apart from the Spark code.

Each oracle is one query over the base tables: the common table expressions it needs, put in
front of a final SELECT.
"""

from __future__ import annotations

import re

from salesmart.fixture import STAGING_SQL, TABLES


def gint(x):
    return f"case when regexp_full_match({x}, '[0-9]+') then try_cast({x} as integer) end"


def gdec(x, p, s):
    return (f"case when regexp_full_match({x}, '[0-9]+([.][0-9]+)?') "
            f"then try_cast({x} as decimal({p},{s})) end")


def usdate(x):
    return f"cast(try_strptime({x}, '%m/%d/%Y') as date)"


def lint(x):
    pattern = r"'\s*([+-]?)([0-9]*)([.][0-9]*)?\s*'"
    sign, whole, fraction = (f"regexp_extract({x}, {pattern}, {g})" for g in (1, 2, 3))
    return (f"case when regexp_full_match({x}, {pattern}) and {whole} || {fraction} <> '' "
            f"then try_cast({sign} || '0' || {whole} as integer) end")


def ldbl(x):
    return f"try_cast({x} as double)"


def cash(x):
    return f"try_cast({x} as decimal(28,8))"


def dense(*keys):
    order = ", ".join(f"{key} asc nulls first" for key in keys)
    return f"row_number() over (order by md5(concat_ws('|', {', '.join(keys)})), {order})"


def first(keys, columns):
    """QUALIFY clause that keeps the representative row of each key."""
    order = ", ".join(f"{c} asc nulls first" for c in ["rid", *columns.split()])
    return f"qualify row_number() over (partition by {keys} order by {order}) = 1"


CTES = {"staging": STAGING_SQL.format(**{name: name for name in TABLES})}

# ------------------------------------------------------------------ snowflake profile

CTES["a_addr_c"] = f"""
select {dense('country', 'postal_code')} as address_id, * from (
  select distinct coalesce(customer_country, '') as country,
         coalesce(customer_postal_code, '') as postal_code from staging)"""

CTES["a_pet"] = f"""
select {dense('type', 'name', 'breed', 'category')} as pet_id, * from (
  select distinct coalesce(customer_pet_type, '') as type, coalesce(customer_pet_name, '') as name,
         coalesce(customer_pet_breed, '') as breed, coalesce(pet_category, '') as category
  from staging)"""

CTES["a_addr_s"] = f"""
select {dense('country', 'postal_code')} as address_id, * from (
  select distinct coalesce(seller_country, '') as country,
         coalesce(seller_postal_code, '') as postal_code from staging)"""

CTES["a_addr_st"] = f"""
select {dense('city', 'state', 'country')} as address_id, * from (
  select distinct coalesce(store_city, '') as city, coalesce(store_state, '') as state,
         coalesce(store_country, '') as country from staging)"""

CTES["a_addr_su"] = f"""
select {dense('address_line', 'city', 'country')} as address_id, * from (
  select distinct coalesce(supplier_address, '') as address_line,
         coalesce(supplier_city, '') as city, coalesce(supplier_country, '') as country
  from staging)"""

CTES["a_cat"] = f"""
select {dense('name')} as category_id, * from (
  select distinct coalesce(product_category, '') as name from staging)"""

CTES["a_customer"] = f"""
select c.id, c.first_name, c.last_name, {gint('c.age')} as age, c.email, a.address_id, p.pet_id
from (
  select {dense('email')} as id, * from (
    select id as rid, customer_first_name as first_name, customer_last_name as last_name,
           customer_age as age, customer_email as email,
           coalesce(customer_country, '') as country,
           coalesce(customer_postal_code, '') as postal_code,
           coalesce(customer_pet_type, '') as pet_type, coalesce(customer_pet_name, '') as pet_name,
           coalesce(customer_pet_breed, '') as pet_breed, coalesce(pet_category, '') as pet_category
    from staging where customer_email is not null
    {first('email', 'first_name last_name age email country postal_code pet_type pet_name pet_breed pet_category')})
) c
join a_addr_c a on a.country = c.country and a.postal_code = c.postal_code
join a_pet p on p.type = c.pet_type and p.name = c.pet_name and p.breed = c.pet_breed
            and p.category = c.pet_category"""

CTES["a_seller"] = f"""
select s.id, s.first_name, s.last_name, s.email, a.address_id
from (
  select {dense('email')} as id, * from (
    select id as rid, seller_first_name as first_name, seller_last_name as last_name,
           seller_email as email, coalesce(seller_country, '') as country,
           coalesce(seller_postal_code, '') as postal_code
    from staging where seller_email is not null
    {first('email', 'first_name last_name email country postal_code')})
) s
join a_addr_s a on a.country = s.country and a.postal_code = s.postal_code"""

CTES["a_product"] = f"""
select p.id, p.name, {gdec('p.price', 10, 2)} as price, {gint('p.quantity')} as quantity, p.brand,
       {gdec('p.weight', 10, 2)} as weight, p.color, p.size, p.material, p.description,
       {gdec('p.rating', 3, 1)} as rating, {gint('p.reviews')} as reviews_count,
       {usdate('p.released')} as released_on, {usdate('p.expires')} as expires_on, c.category_id
from (
  select {dense('name', 'category', 'brand')} as id, * from (
    select id as rid, product_name as name, coalesce(product_category, '') as category,
           coalesce(product_brand, '') as brand, product_price as price,
           product_quantity as quantity, product_weight as weight,
           coalesce(product_color, '') as color, coalesce(product_size, '') as size,
           coalesce(product_material, '') as material,
           coalesce(product_description, '') as description, product_rating as rating,
           product_reviews as reviews, product_release_date as released,
           product_expiry_date as expires
    from staging
    {first('name, category, brand', 'name category brand price quantity weight color size material description rating reviews released expires')})
) p
join a_cat c on c.name = p.category"""

CTES["a_store"] = f"""
select s.id, s.name, s.location_detail, s.phone, s.email, a.address_id
from (
  select {dense('name', 'city', 'country')} as id, * from (
    select id as rid, store_name as name, coalesce(store_location, '') as location_detail,
           store_phone as phone, store_email as email, coalesce(store_city, '') as city,
           coalesce(store_state, '') as state, coalesce(store_country, '') as country
    from staging
    {first('name, city, country', 'name location_detail phone email city state country')})
) s
join a_addr_st a on a.city = s.city and a.state = s.state and a.country = s.country"""

CTES["a_supplier"] = f"""
select s.id, s.name, s.contact, s.email, s.phone, a.address_id
from (
  select {dense('email')} as id, * from (
    select id as rid, supplier_name as name, supplier_contact as contact,
           supplier_email as email, supplier_phone as phone,
           coalesce(supplier_address, '') as address_line, coalesce(supplier_city, '') as city,
           coalesce(supplier_country, '') as country
    from staging where supplier_email is not null
    {first('email', 'name contact email phone address_line city country')})
) s
join a_addr_su a on a.address_line = s.address_line and a.city = s.city
                and a.country = s.country"""

# Every staging row with its links, by way of the outrigger ids; NULL where there is none.
CTES["a_linked"] = """
select r.*, dc.id as customer_id, ds.id as seller_id, dp.id as product_id, dst.id as store_id,
       dsu.id as supplier_id
from staging r
left join a_customer dc on dc.email = r.customer_email
left join a_seller ds on ds.email = r.seller_email
left join a_cat cat on cat.name = coalesce(r.product_category, '')
left join a_product dp on dp.name = r.product_name and dp.brand = coalesce(r.product_brand, '')
                      and dp.category_id = cat.category_id
left join a_addr_st adr on adr.city = coalesce(r.store_city, '')
                       and adr.state = coalesce(r.store_state, '')
                       and adr.country = coalesce(r.store_country, '')
left join a_store dst on dst.name = r.store_name and dst.address_id = adr.address_id
left join a_supplier dsu on dsu.email = r.supplier_email"""

CTES["a_fact"] = f"""
select {usdate('sale_date')} as sale_date, {gint('sale_quantity')} as quantity,
       {gdec('sale_total_price', 12, 2)} as total_price,
       customer_id, seller_id, product_id, store_id, supplier_id
from a_linked
where customer_id is not null and seller_id is not null and product_id is not null
  and store_id is not null and supplier_id is not null"""

# ----------------------------------------------------------------------- star profile

CTES["b_customer"] = f"""
select * exclude (rid), {dense('email')} as customer_id from (
  select id as rid, customer_first_name as first_name, customer_last_name as last_name,
         {lint('customer_age')} as age, customer_email as email, customer_country as country,
         customer_postal_code as postal_code, customer_pet_type as pet_type,
         customer_pet_name as pet_name, customer_pet_breed as pet_breed, pet_category
  from staging
  {first('email', 'first_name last_name age email country postal_code pet_type pet_name pet_breed pet_category')})"""

CTES["b_seller"] = f"""
select * exclude (rid), {dense('email')} as seller_id from (
  select id as rid, seller_first_name as first_name, seller_last_name as last_name,
         seller_email as email, seller_country as country, seller_postal_code as postal_code
  from staging
  {first('email', 'first_name last_name email country postal_code')})"""

CTES["b_product"] = f"""
select * exclude (rid), {dense('name', 'category', 'brand')} as product_id from (
  select id as rid, product_name as name, product_category as category,
         {ldbl('product_price')} as price, {lint('product_quantity')} as quantity,
         {ldbl('product_weight')} as weight, product_color as color, product_size as size,
         product_brand as brand, product_material as material,
         product_description as description, {ldbl('product_rating')} as rating,
         {lint('product_reviews')} as reviews, product_release_date as release_date,
         product_expiry_date as expiry_date
  from staging
  {first('name, category, brand', 'name category price quantity weight color size brand material description rating reviews release_date expiry_date')})"""

CTES["b_store"] = f"""
select * exclude (rid), {dense('name', 'city')} as store_id from (
  select id as rid, store_name as name, store_location as location, store_city as city,
         store_state as state, store_country as country, store_phone as phone,
         store_email as email
  from staging
  {first('name, city', 'name location city state country phone email')})"""

CTES["b_supplier"] = f"""
select * exclude (rid), {dense('name', 'email')} as supplier_id from (
  select id as rid, supplier_name as name, supplier_contact as contact,
         supplier_email as email, supplier_phone as phone, supplier_address as address,
         supplier_city as city, supplier_country as country
  from staging
  {first('name, email', 'name contact email phone address city country')})"""

CTES["b_linked"] = """
select r.*, c.customer_id, s.seller_id, p.product_id, st.store_id, su.supplier_id
from staging r
left join b_customer c on c.email = r.customer_email
left join b_seller s on s.email = r.seller_email
left join b_product p on p.name = r.product_name and p.category = r.product_category
                     and p.brand = r.product_brand
left join b_store st on st.name = r.store_name and st.city = r.store_city
left join b_supplier su on su.name = r.supplier_name and su.email = r.supplier_email"""

CTES["b_fact"] = f"""
select customer_id, seller_id, product_id, store_id, supplier_id,
       {usdate('sale_date')} as sale_date, {lint('sale_quantity')} as quantity,
       {cash('sale_total_price')} as total_price
from b_linked"""

ONCE = {"staging", "a_linked", "b_linked"}  # large and used several times


def sql(final: str) -> str:
    """``final`` with the common table expressions it refers to, directly or not."""
    needed, todo = set(), [final]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    parts = [
        f"{name} as {'materialized ' if name in ONCE else ''}({CTES[name].strip()})"
        for name in CTES if name in needed
    ]
    return f"with {', '.join(parts)}\n{final.strip()}" if parts else final.strip()


# ---------------------------------------------------------------------------- reports

TOTAL = "cast(sum(f.total_price) as decimal(38,8))"
UNITS = "cast(sum(f.quantity) as bigint)"
CHECK = ("cast(sum(f.total_price) as double) / nullif(count(f.total_price), 0)")
PRODUCT = "from b_fact f join b_product d on d.product_id = f.product_id"
CUSTOMER = "from b_fact f join b_customer d on d.customer_id = f.customer_id"
STORE = "from b_fact f join b_store d on d.store_id = f.store_id"
SUPPLIER = "from b_fact f join b_supplier d on d.supplier_id = f.supplier_id"
YEAR = "cast(year(f.sale_date) as integer)"
MONTH = "cast(month(f.sale_date) as integer)"


def top(column: str, ties: str, limit: int) -> str:
    order = ", ".join(f"{c} asc nulls first" for c in ties.split())
    return f"order by {column} desc nulls last, {order} limit {limit}"


REPORTS = {
    "products_top10": f"""
        select d.name, d.category, {UNITS} as total_quantity, {TOTAL} as total_revenue
        {PRODUCT} group by d.name, d.category {top('total_quantity', 'd.name d.category', 10)}""",
    "products_revenue_by_category": f"""
        select d.category, {TOTAL} as total_revenue {PRODUCT} group by d.category""",
    "products_avg_rating": f"""
        select d.name, d.category, cast(sum(cast(d.rating as decimal(24,12))) as double)
               / nullif(count(d.rating), 0) as avg_rating
        {PRODUCT} group by d.name, d.category""",
    "customers_top10": f"""
        select d.first_name, d.last_name, d.email, {TOTAL} as total_spent
        {CUSTOMER} group by d.first_name, d.last_name, d.email
        {top('total_spent', 'd.first_name d.last_name d.email', 10)}""",
    "customers_by_country": f"""
        select d.country, count(distinct d.customer_id) as num_customers, {TOTAL} as total_revenue
        {CUSTOMER} group by d.country""",
    "customers_avg_check": f"""
        select d.first_name, d.last_name, d.email, {CHECK} as avg_check
        {CUSTOMER} group by d.first_name, d.last_name, d.email""",
    "time_monthly": f"""
        select {YEAR} as "year", {MONTH} as "month", {TOTAL} as total_revenue,
               count(*) as num_orders
        from b_fact f where f.sale_date is not null group by 1, 2""",
    "time_yearly": f"""
        select {YEAR} as "year", {TOTAL} as total_revenue, count(*) as num_orders
        from b_fact f where f.sale_date is not null group by 1""",
    "time_avg_by_month": f"""
        select {YEAR} as "year", {MONTH} as "month", {CHECK} as avg_order_size
        from b_fact f where f.sale_date is not null group by 1, 2""",
    "stores_top5": f"""
        select d.name, d.city, d.country, {TOTAL} as total_revenue
        {STORE} group by d.name, d.city, d.country
        {top('total_revenue', 'd.name d.city d.country', 5)}""",
    "stores_by_location": f"""
        select d.city, d.country, count(*) as sales_count, {TOTAL} as total_revenue
        {STORE} group by d.city, d.country""",
    "stores_avg_check": f"""
        select d.name, d.city, {CHECK} as avg_check {STORE} group by d.name, d.city""",
    "suppliers_top5": f"""
        select d.name, d.country, {TOTAL} as total_revenue
        {SUPPLIER} group by d.name, d.country {top('total_revenue', 'd.name d.country', 5)}""",
    "suppliers_avg_price": f"""
        select d.name, cast(sum(cast(p.price as decimal(24,12))) as double)
               / nullif(count(p.price), 0) as avg_product_price
        {SUPPLIER} join b_product p on p.product_id = f.product_id group by d.name""",
    "suppliers_by_country": f"""
        select d.country, {TOTAL} as total_revenue,
               count(distinct d.supplier_id) as num_suppliers
        {SUPPLIER} group by d.country""",
    "quality_top_rated": f"""
        select name, category, rating from b_product where rating is not null
        {top('rating', 'name category', 10)}""",
    "quality_rating_vs_sales": f"""
        select d.name, d.category, d.rating, {UNITS} as total_quantity_sold,
               {TOTAL} as total_revenue
        {PRODUCT} group by d.name, d.category, d.rating""",
    "quality_most_reviewed": f"""
        select name, category, reviews from b_product where reviews is not null
        {top('reviews', 'name category', 10)}""",
}

# ----------------------------------------------------------------------------- audits

SNOWFLAKE = {
    "dim_address_customer": "a_addr_c", "dim_pet_info": "a_pet", "dim_address_seller": "a_addr_s",
    "dim_address_store": "a_addr_st", "dim_address_supplier": "a_addr_su",
    "dim_category_product": "a_cat", "dim_customer": "a_customer", "dim_seller": "a_seller",
    "dim_product": "a_product", "dim_store": "a_store", "dim_supplier": "a_supplier",
}
STAR = {
    "customer_dim": "b_customer", "seller_dim": "b_seller", "product_dim": "b_product",
    "store_dim": "b_store", "supplier_dim": "b_supplier", "sales_fact": "b_fact",
}

COUNTS = " union all ".join(
    f"select '{name}' as \"table\", count(*) as n from {cte}"
    for name, cte in {
        "staging_raw": "staging", **SNOWFLAKE, "fact_sales": "a_fact", **STAR
    }.items()
)

EDGES = [
    ("dim_customer", "a_customer", "address_id", "a_addr_c", "address_id"),
    ("dim_customer", "a_customer", "pet_id", "a_pet", "pet_id"),
    ("dim_seller", "a_seller", "address_id", "a_addr_s", "address_id"),
    ("dim_product", "a_product", "category_id", "a_cat", "category_id"),
    ("dim_store", "a_store", "address_id", "a_addr_st", "address_id"),
    ("dim_supplier", "a_supplier", "address_id", "a_addr_su", "address_id"),
    ("fact_sales", "a_fact", "customer_id", "a_customer", "id"),
    ("fact_sales", "a_fact", "seller_id", "a_seller", "id"),
    ("fact_sales", "a_fact", "product_id", "a_product", "id"),
    ("fact_sales", "a_fact", "store_id", "a_store", "id"),
    ("fact_sales", "a_fact", "supplier_id", "a_supplier", "id"),
    ("sales_fact", "b_fact", "customer_id", "b_customer", "customer_id"),
    ("sales_fact", "b_fact", "seller_id", "b_seller", "seller_id"),
    ("sales_fact", "b_fact", "product_id", "b_product", "product_id"),
    ("sales_fact", "b_fact", "store_id", "b_store", "store_id"),
    ("sales_fact", "b_fact", "supplier_id", "b_supplier", "supplier_id"),
]
FK = " union all ".join(
    f"select '{child}.{column}' as edge, count(*) as n from {c} where {column} is not null "
    f"and {column} not in (select {key} from {p})"
    for child, c, column, p, key in EDGES
)

KEYS = {
    "dim_address_customer": "address_id", "dim_pet_info": "pet_id",
    "dim_address_seller": "address_id", "dim_address_store": "address_id",
    "dim_address_supplier": "address_id", "dim_category_product": "category_id",
    "dim_customer": "id", "dim_seller": "id", "dim_product": "id", "dim_store": "id",
    "dim_supplier": "id", "customer_dim": "customer_id", "seller_dim": "seller_id",
    "product_dim": "product_id", "store_dim": "store_id", "supplier_dim": "supplier_id",
}
PK = " union all ".join(
    f"select '{name}' as \"table\", count({key}) - count(distinct {key}) as surplus_ids, "
    f"count(*) - count({key}) as null_ids from {(SNOWFLAKE | STAR)[name]}"
    for name, key in KEYS.items()
)
# The id of the fact is a position: any numbering of its rows is as good.
PK += """ union all select 'fact_sales', count(id) - count(distinct id), count(*) - count(id)
from (select row_number() over () as id from a_fact)"""

#: Dimensions whose ids are also ranked by the natural key: id, order of the key.
RANKED = {
    "customer_dim": ("customer_id", "email nulls first"),
    "seller_dim": ("seller_id", "email nulls first"),
    "product_dim": ("product_id", "name nulls first, category nulls first, brand nulls first"),
}

LIMITS = {
    "dim_address_customer": {"country": 200, "postal_code": 50},
    "dim_pet_info": {"type": 100, "name": 200, "breed": 200, "category": 100},
    "dim_address_seller": {"country": 200, "postal_code": 50},
    "dim_address_store": {"city": 200, "state": 200, "country": 200},
    "dim_address_supplier": {"address_line": 300, "city": 200, "country": 200},
    "dim_category_product": {"name": 200},
    "dim_customer": {"first_name": 200, "last_name": 200, "email": 300},
    "dim_seller": {"first_name": 200, "last_name": 200, "email": 300},
    "dim_product": {"name": 300, "brand": 200, "color": 100, "size": 50, "material": 200},
    "dim_store": {"name": 300, "location_detail": 300, "phone": 50, "email": 300},
    "dim_supplier": {"name": 300, "contact": 300, "email": 300, "phone": 50},
}
LENGTHS = " union all ".join(
    f"select '{name}' as \"table\", '{column}' as \"column\", cast({limit} as integer) as max_length, "
    f"count(case when length({column}) > {limit} then 1 end) as n from {SNOWFLAKE[name]}"
    for name, columns in LIMITS.items() for column, limit in columns.items()
)


def rejects(linked: str, parsers: dict[str, str]) -> str:
    """One row per staging row and rule it breaks."""
    rules = [
        f"select id, 'no_{name}' as rule from {linked} where {name}_id is null"
        for name in ["customer", "seller", "product", "store", "supplier"]
    ]
    rules += [
        f"select id, 'bad_{source}' as rule from {linked} where {source} <> '' "
        f"and ({parsed}) is null"
        for source, parsed in parsers.items()
    ]
    return " union all ".join(rules)


SNOWFLAKE_REJECTS = rejects("a_linked", {
    "sale_date": usdate("sale_date"),
    "sale_quantity": gint("sale_quantity"),
    "sale_total_price": gdec("sale_total_price", 12, 2),
    "customer_age": gint("customer_age"),
    "product_price": gdec("product_price", 10, 2),
    "product_quantity": gint("product_quantity"),
    "product_weight": gdec("product_weight", 10, 2),
    "product_rating": gdec("product_rating", 3, 1),
    "product_reviews": gint("product_reviews"),
    "product_release_date": usdate("product_release_date"),
    "product_expiry_date": usdate("product_expiry_date"),
})
STAR_REJECTS = rejects("b_linked", {
    "sale_date": usdate("sale_date"),
    "sale_quantity": lint("sale_quantity"),
    "sale_total_price": cash("sale_total_price"),
    "customer_age": lint("customer_age"),
    "product_price": ldbl("product_price"),
    "product_quantity": lint("product_quantity"),
    "product_weight": ldbl("product_weight"),
    "product_rating": ldbl("product_rating"),
    "product_reviews": lint("product_reviews"),
})

# ------------------------------------------------------------------------ all queries


def oracle_sql() -> dict[str, str]:
    finals = {
        "staging_rows": "select * from staging",
        "csv_roundtrip": "select * from staging",
        "csv_several_files": "select *, true as from_file from staging",
        "clean_guarded": f"""
            select id, {gint('customer_age')} as age, {gdec('product_price', 10, 2)} as price,
                   {gdec('product_rating', 3, 1)} as rating, {gint('sale_quantity')} as quantity,
                   {gdec('sale_total_price', 12, 2)} as total_price,
                   {usdate('sale_date')} as sale_date,
                   {usdate('product_expiry_date')} as expires_on
            from staging""",
        "clean_permissive": f"""
            select id, {lint('customer_age')} as age, {ldbl('product_price')} as price,
                   {ldbl('product_rating')} as rating, {lint('sale_quantity')} as quantity,
                   {cash('sale_total_price')} as total_price, {usdate('sale_date')} as sale_date
            from staging""",
    }
    finals |= {f"snow_{name}": f"select * from {cte}" for name, cte in SNOWFLAKE.items()}
    finals["snow_fact_sales"] = "select * from a_fact"
    finals["snow_fact_sales_ids"] = """
        select count(*) as n, count(*) as ids, cast(1 as bigint) as first_id,
               count(*) as last_id from a_fact"""
    finals |= {f"star_{name}": f"select * from {cte}" for name, cte in STAR.items()}
    finals |= {
        f"star_{name}_by_key": f"select * replace (row_number() over (order by {keys}) as {key}) from {STAR[name]}"
        for name, (key, keys) in RANKED.items()
    }
    finals |= {
        f"rpt_{i:02d}_{name}": text for i, (name, text) in enumerate(REPORTS.items(), start=1)
    }
    finals["reports_job"] = " union all ".join(
        f"select '{name}' as report, count(*) as n, cast(0 as bigint) as out_of_order from ({text})"
        for name, text in REPORTS.items()
    )
    finals |= {
        "audit_table_counts": COUNTS,
        "audit_fk": FK,
        "audit_pk": PK,
        "audit_lengths": LENGTHS,
        "audit_rejects_snowflake": SNOWFLAKE_REJECTS,
        "audit_rejects_star": STAR_REJECTS,
        "audit_reject_counts": f"""
            select 'snowflake' as profile, rule, count(*) as n from ({SNOWFLAKE_REJECTS})
            group by rule union all
            select 'star' as profile, rule, count(*) as n from ({STAR_REJECTS}) group by rule""",
        "sink_roundtrip": "select * from b_fact",
        "published_sales_fact": "select * from b_fact",
        "jdbc_text_split": """
            select cast(1 as bigint) as conditions_met, count(*) as n from staging
            having count(*) > 0""",
        "typed_table_roundtrip": "select * from a_product",
        "views_sql": f"""
            select d.country, d.state, count(*) as sales, {UNITS} as units, {TOTAL} as revenue
            {STORE} group by d.country, d.state""",
    }
    return {name: sql(text) for name, text in finals.items()}
