"""The source tables, extracts and dimensions as SQL, for comparison with Spark.

Each entry is a common table expression; :func:`with_tables` puts in front of a
statement the ones it names.
"""

from __future__ import annotations

import re

_CODE = "substr(r_name, 1, 3)"
_MONEY_CODE = f"case when r_name = 'AMERICA' then 'USD' else {_CODE} end"
_CATEGORY = "cast(ascii(p_type) + length(p_type) as integer)"
_SUBCATEGORY = f"cast(cast(substr(p_brand, 7) as integer) * 100 + {_CATEGORY} as integer)"
_STORE = "(2 * (c_custkey // 15) + 1)"
_SURVEYED = "(c_mktsegment <> 'FURNITURE' or c_acctbal >= 1000)"


def _if_surveyed(value: str) -> str:
    return f"case when {_SURVEYED} then {value} end"


def _fact_lines(online: bool) -> str:
    extra = "customer_id as customer_alternate_key" if online else (
        "store_id as reseller_alternate_key, sales_person as employee_alternate_key"
    )
    stores = "" if online else (
        "join s_customer using (customer_id) join s_store on s_customer.store_id = s_store.entity_id"
    )
    return f"""
        select sales_order_detail_id, part_key as product_alternate_key, order_date, due_date, ship_date,
               {extra}, offer as promotion_alternate_key, coalesce(code, 'USD') as currency_alternate_key,
               territory as sales_territory_alternate_key, order_number as sales_order_number, revision_number,
               order_quantity, unit_price, extended_amount, unit_price_discount_pct,
               standard_cost as product_standard_cost, tax_amt, freight, carrier_tracking_number
        from s_header join s_detail using (order_id) join s_product using (part_key) {stores}
        left join s_rate using (rate_id)
        where online = {str(online).lower()}"""


DEFINITIONS = {
    # -- source tables ----------------------------------------------------
    "s_place": f"""
        select n_nationkey as province_id, lpad(cast(n_nationkey as varchar), 3, '0') as province_code,
               n_name as province, {_CODE} as country_code, r_name as country, {_MONEY_CODE} as money_code
        from nation join region on n_regionkey = r_regionkey""",
    "s_territory": "select province_id + 1 as territory, country_code from s_place",
    "s_rate": "select province_id as rate_id, money_code as code from s_place",
    "s_customer": f"""
        select c_custkey as customer_id, case when c_mktsegment <> 'MACHINERY' then 2 * c_custkey end as person_id,
               case when c_mktsegment <> 'HOUSEHOLD' then {_STORE} end as store_id
        from customer""",
    "s_person": """
        select 2 * c_custkey as entity_id, case when c_nationkey < 12 then 'Mr.' end as title,
               substr(c_name, 1, 8) as first_name,
               case when c_acctbal > 5000 then substr(c_mktsegment, 1, 1) end as middle_name,
               substr(c_name, 10) as last_name, c_acctbal < 0 as name_style,
               case when c_mktsegment = 'BUILDING' then 'Jr.' end as suffix
        from customer""",
    "s_survey": f"""
        select 2 * c_custkey as entity_id,
               {_if_surveyed("cast(date '1950-01-01' + c_nationkey * 300 as date)")} as birth_date,
               {_if_surveyed("case when c_nationkey < 10 then 'M' else 'S' end")} as marital_status,
               {_if_surveyed("case when c_nationkey % 2 = 0 then 'F' else 'M' end")} as gender,
               {_if_surveyed("substr(concat(c_nationkey * 1000, '-', c_nationkey * 1000 + 25000, ' per year'), 1, 20)")}
                   as yearly_income,
               cast(case when {_SURVEYED} and c_mktsegment <> 'BUILDING' then c_nationkey % 6 end as smallint)
                   as total_children,
               cast(case when {_SURVEYED} and c_nationkey <= 20 then c_nationkey % 4 end as smallint)
                   as number_children_at_home,
               {_if_surveyed("concat(c_mktsegment, ' school')")} as education,
               {_if_surveyed("case when c_acctbal > 3000 then '1' else '0' end")} as house_owner_flag,
               cast({_if_surveyed("c_nationkey % 5")} as smallint) as number_cars_owned,
               {_if_surveyed("cast(date '1994-01-01' + c_nationkey as date)")} as date_first_purchase,
               {_if_surveyed("substr(concat(c_nationkey, ' miles and some more'), 1, 20)")} as commute_distance
        from customer""",
    "s_email": """
        select 2 * c_custkey as entity_id, concat('c', c_custkey, '@mail.example') as email from customer
        union all
        select 2 * c_custkey, case when c_mktsegment = 'BUILDING' then concat('b', c_custkey, '@site.example')
               else concat('a', c_custkey, '@mail.example') end from customer""",
    "s_phone": """
        select 2 * c_custkey as entity_id, concat(c_nationkey, '-', c_custkey) as phone from customer
        union all
        select 2 * c_custkey, concat(case when c_acctbal > 5000 then '800-' else '0-' end, c_custkey) from customer""",
    "s_address": """
        select 2 * c_custkey as address_id, concat(c_custkey, ' Main St') as address_line1,
               case when c_mktsegment = 'AUTOMOBILE' then concat('Apt ', c_nationkey) end as address_line2,
               case when c_acctbal >= 0 then concat('City ', c_nationkey, substr(c_mktsegment, 1, 1)) end as city,
               c_nationkey as province_id,
               case when c_mktsegment <> 'FURNITURE' or c_nationkey <> 3
                    then concat('P', c_nationkey, '-', substr(c_mktsegment, 1, 2)) end as postal_code
        from customer
        union all
        select 2 * s_suppkey + 1, concat('Dock ', s_suppkey), null,
               case when s_acctbal >= 500 then concat('City ', s_nationkey, 'B') end, s_nationkey,
               concat('P', s_nationkey, '-BU')
        from supplier""",
    "s_entity_address": f"""
        select 2 * c_custkey as entity_id, 2 * c_custkey as address_id from customer
        union all
        select 2 * c_custkey, case when c_mktsegment = 'BUILDING' then {_STORE} else 2 * c_custkey end from customer
        union all
        select 2 * s_suppkey + 1, case when s_acctbal <= 9000 then 2 * s_suppkey + 1 else -s_suppkey end from supplier""",
    "s_located": """
        select address_id, address_line1, address_line2, city, province_code as state_province_code, postal_code
        from s_address left join s_place using (province_id)""",
    "s_store": """
        select 2 * s_suppkey + 1 as entity_id, s_name as reseller_name,
               case when s_nationkey = 7 then 'Value Added Reseller'
                    when s_nationkey % 6 = 0 then 'Bike Manufacturer' when s_nationkey % 6 = 1 then 'Bike Shop'
                    when s_nationkey % 6 = 2 then 'Online Store' when s_nationkey % 6 = 3 then 'Warehouse Store'
                    when s_nationkey % 6 = 4 then 'Value Added Reseller' else 'Kiosk and market stall' end
                   as business_type,
               s_nationkey * 3 + 1 as number_employees,
               cast(s_acctbal as decimal(19,4)) as annual_sales,
               concat('Bank of ', s_nationkey) as bank_name,
               case when s_nationkey <> 9 then cast(s_acctbal as decimal(19,4)) end as annual_revenue,
               case when s_nationkey <> 5 then 1950 + s_nationkey end as year_opened
        from supplier""",
    "s_store_contact": f"""
        select {_STORE} as entity_id, case when c_acctbal >= -900 then concat('+', c_custkey) end as phone from customer""",
    "s_employee": """
        select 2 * user_id as entity_id, cast(min(ts) as date) as hire_date,
               cast(cast(min(ts) as date) - 10000 as date) as birth_date, concat('login-', user_id) as login_id,
               case when max(value) > 100 then 'M' else 'S' end as marital_status, count(*) > 60 as salaried_flag,
               case when count(*) filter (event_type = 'error') > 10 then 'F' else 'M' end as gender,
               cast(count(*) as smallint) as vacation_hours,
               cast(count(*) filter (event_type = 'error') as smallint) as sick_leave_hours,
               count(*) filter (event_type = 'error') < 20 as current_flag
        from events group by user_id""",
    "s_department_history": """
        select 2 * user_id as entity_id, event_type as department_name, cast(min(ts) as date) as start_date,
               case when event_type <> 'signup' then cast(max(ts) as date) end as end_date
        from events group by user_id, event_type""",
    "s_pay": """
        select 2 * user_id as entity_id, date_trunc('day', ts) as changed, cast(value as decimal(19,4)) as rate,
               cast(case when value < 20 then 1 else 2 end as smallint) as frequency
        from events""",
    "s_product": """
        select p_partkey as part_key, cast(p_retailprice * 0.5 as decimal(19,4)) as standard_cost from part""",
    "s_header": """
        select o_orderkey as order_id, o_orderdate as order_date, o_orderdate + interval 12 day as due_date,
               case when o_orderpriority <> '5-LOW' then o_orderdate + interval 7 day end as ship_date,
               o_custkey as customer_id,
               case when o_custkey % 25 <> 12 then cast(o_custkey % 25 + 1 as integer) end as territory,
               concat('SO', o_orderkey) as order_number,
               cast(substr(o_orderpriority, 1, 1) as smallint) as revision_number,
               o_totalprice * 0.08 as tax_amt, o_totalprice * 0.025 as freight,
               case when o_custkey % 25 <> 7 then cast(o_custkey % 25 as integer) end as rate_id,
               case when o_orderstatus = 'F' then true
                    when o_orderstatus = 'O' or o_orderpriority <> '5-LOW' then false end as online,
               2 * (o_custkey // 10) as sales_person
        from orders""",
    "s_detail": """
        select l_orderkey as order_id, l_linenumber as sales_order_detail_id, l_partkey as part_key,
               l_linenumber as offer, cast(l_quantity as smallint) as order_quantity,
               l_extendedprice / l_quantity as unit_price, l_extendedprice as extended_amount,
               l_discount as unit_price_discount_pct,
               case when l_returnflag <> 'N' then concat(l_returnflag, '-', l_linestatus, '-', l_orderkey) end
                   as carrier_tracking_number
        from lineitem""",
    # -- extracts -----------------------------------------------------------
    "x_currency": f"""
        select {_MONEY_CODE} as currency_alternate_key, concat(r_name, ' money') as currency_name from region""",
    "x_geography": """
        select distinct city, province_code as state_province_code, province as state_province_name,
               s_place.country_code as country_region_code, country as country_region_name, postal_code,
               territory as sales_territory_key
        from s_address join s_place using (province_id)
        left join s_territory on s_territory.country_code = s_place.country_code
        where city is not null and postal_code is not null""",
    "x_contacts": """
        select entity_id, max(email) as email_address, max(phone) as phone
        from s_person left join s_email using (entity_id) left join s_phone using (entity_id) group by entity_id""",
    "x_addresses": """
        select entity_id, max(address_line1) as address_line1, max(address_line2) as address_line2,
               max(city) as city, max(state_province_code) as state_province_code, max(postal_code) as postal_code
        from s_entity_address left join s_located using (address_id) group by entity_id""",
    "x_customer": """
        select customer_id as customer_alternate_key, s_person.* exclude (entity_id),
               x_contacts.* exclude (entity_id), x_addresses.* exclude (entity_id), s_survey.* exclude (entity_id)
        from s_customer join s_person on person_id = s_person.entity_id
        left join x_contacts on person_id = x_contacts.entity_id
        left join x_addresses on person_id = x_addresses.entity_id
        left join s_survey on person_id = s_survey.entity_id""",
    "x_category": f"""
        select distinct {_CATEGORY} as product_category_alternate_key, p_type as product_category_name from part""",
    "x_subcategory": f"""
        select distinct {_SUBCATEGORY} as product_subcategory_alternate_key,
               concat(p_brand, ' ', p_type) as product_subcategory_name,
               case when p_type <> 'SMALL' then {_CATEGORY} end as product_category_alternate_key
        from part""",
    "x_description": """
        select doc_id // 3 as model,
               case when count(*) filter (lang = 'en') > 0
                    then arg_min(text, doc_id) filter (lang = 'en') else arg_min(text, doc_id) end as description
        from documents group by 1""",
    "x_product": f"""
        select p_partkey as product_alternate_key, p_name as product_name,
               cast(p_retailprice * 0.5 as decimal(19,4)) as standard_cost,
               cast(p_retailprice as decimal(19,4)) as list_price, split_part(p_name, ' ', 1) as color,
               cast(p_size as varchar) as size,
               case when p_size <> 50 then cast(p_size as double) * 0.25 end as weight,
               p_size as days_to_manufacture,
               case when p_type <> 'PROMO' then substr(p_type, 1, 1) end as product_line,
               case when p_size > 10 then 'H' end as class, case when p_size > 20 then 'U' end as style,
               cast(p_size * 10 as smallint) as safety_stock_level, cast(p_size * 5 as smallint) as reorder_point,
               p_type <> 'PROMO' as finished_goods_flag,
               timestamp '1995-01-01' + to_days(p_size) as sell_start_date,
               case when p_size > 40 then timestamp '2001-01-01' end as sell_end_date,
               case when p_size <> 7 then {_SUBCATEGORY} end as product_subcategory_key,
               case when p_size <> 50 then 'KG' end as weight_unit_measure_code,
               case when p_size < 25 then 'CM' end as size_unit_measure_code,
               case when p_size <> 13 then concat('Model ', p_partkey // 3) end as model_name,
               coalesce(description, 'No description available') as description
        from part left join x_description on p_size <> 13 and model = p_partkey // 3""",
    "x_promotion": """
        select distinct cast(substr(o_orderpriority, 1, 1) as integer) as promotion_alternate_key,
               substr(o_orderpriority, 3) as promotion_name,
               cast(substr(o_orderpriority, 1, 1) as double) * 0.02 as discount_pct,
               case when substr(o_orderpriority, 1, 1) < '3' then 'Rush' else 'Normal' end as promotion_type,
               case when substr(o_orderpriority, 1, 1) < '4' then 'Customer' end as promotion_category,
               timestamp '1995-01-01' as start_date,
               case when o_orderpriority <> '5-LOW' then timestamp '2002-01-01' end as end_date,
               cast(substr(o_orderpriority, 1, 1) as integer) as min_qty,
               case when substr(o_orderpriority, 1, 1) > '2'
                    then cast(substr(o_orderpriority, 1, 1) as integer) * 10 end as max_qty
        from orders""",
    "x_reason": """
        select distinct ascii(l_returnflag) * 1000 + ascii(l_linestatus) as sales_reason_alternate_key,
               concat('Reason ', l_returnflag) as sales_reason_name,
               concat('Type ', l_linestatus) as sales_reason_reason_type
        from lineitem""",
    "x_reseller": """
        select s_store.entity_id as reseller_alternate_key, s_store.* exclude (entity_id),
               s_store_contact.phone, s_located.* exclude (address_id)
        from s_store left join s_entity_address using (entity_id) left join s_located using (address_id)
        left join s_store_contact on s_store_contact.entity_id = s_store.entity_id""",
    "x_department": """
        select * from s_department_history where end_date is null or end_date > date '2024-01-29'""",
    "x_pay": """
        select entity_id, rate, frequency from s_pay p
        where changed = (select max(changed) from s_pay q where q.entity_id = p.entity_id)""",
    "x_employee": """
        select e.entity_id as employee_alternate_key, first_name, last_name, middle_name, name_style, title,
               hire_date, birth_date, login_id, email as email_address, phone, marital_status, salaried_flag, gender,
               frequency as pay_frequency, rate as base_rate, vacation_hours, sick_leave_hours, current_flag,
               department_name, start_date, end_date
        from s_employee e join s_person using (entity_id) left join s_email using (entity_id)
        left join s_phone using (entity_id) left join x_department using (entity_id)
        left join x_pay using (entity_id)""",
    "x_internet": _fact_lines(True),
    "x_reseller_sales": _fact_lines(False),
    # -- dimensions with keys -------------------------------------------------
    "d_date": """
        select cast(strftime(d, '%Y%m%d') as integer) as date_key, d as full_date_alternate_key,
               cast(dayofweek(d) + 1 as smallint) as day_number_of_week, dayname(d) as day_name_of_week,
               cast(day(d) as smallint) as day_number_of_month, cast(dayofyear(d) as smallint) as day_number_of_year,
               cast(floor((dayofyear(d) + dayofweek(date_trunc('year', d)) - 1) / 7) + 1 as smallint)
                   as week_number_of_year,
               monthname(d) as month_name, cast(month(d) as smallint) as month_number_of_year,
               cast(quarter(d) as smallint) as calendar_quarter, cast(year(d) as smallint) as calendar_year,
               cast(case when month(d) <= 6 then 1 else 2 end as smallint) as calendar_semester,
               cast(case when month(d) >= 7 then quarter(d) - 2 else quarter(d) + 2 end as smallint) as fiscal_quarter,
               cast(case when month(d) >= 7 then year(d) + 1 else year(d) end as smallint) as fiscal_year,
               cast(case when month(d) >= 7 then 1 else 2 end as smallint) as fiscal_semester
        from (select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date) as d
              from orders)""",
    "d_currency": """
        select row_number() over (order by currency_alternate_key, currency_name) as currency_key, * from x_currency""",
    "d_territory": """
        select n_nationkey + 1 as sales_territory_key, n_nationkey + 1 as sales_territory_alternate_key,
               n_name as sales_territory_region, r_name as sales_territory_country,
               case when r_name <> 'ASIA' then concat('Group ', substr(r_name, 1, 1)) end as sales_territory_group
        from nation join region on n_regionkey = r_regionkey""",
    "d_geography": """
        select row_number() over (order by country_region_code nulls first, state_province_code nulls first,
                   city nulls first, postal_code nulls first, sales_territory_key nulls first) as geography_key, *
        from (select * from x_geography
              union all select 'Unknown', '---', 'Unknown', '---', 'Unknown', 'Unknown', null)""",
    "d_unknown": "select min(geography_key) as unknown_key from d_geography where postal_code = 'Unknown'",
    "d_category": """
        select row_number() over (order by product_category_alternate_key) as product_category_key, *
        from x_category""",
    "d_subcategory": """
        select row_number() over (order by product_subcategory_alternate_key) as product_subcategory_key,
               product_subcategory_alternate_key, product_subcategory_name, product_category_key
        from x_subcategory left join d_category using (product_category_alternate_key)""",
    "d_product": """
        select row_number() over (order by cast(product_alternate_key as varchar)) as product_key,
               cast(product_alternate_key as varchar) as product_alternate_key,
               d_subcategory.product_subcategory_key,
               x_product.* exclude (product_alternate_key, product_subcategory_key)
        from x_product
        left join d_subcategory on x_product.product_subcategory_key = product_subcategory_alternate_key""",
    "d_promotion": """
        select row_number() over (order by promotion_alternate_key) as promotion_key, * from x_promotion""",
    "d_reason": """
        select row_number() over (order by sales_reason_alternate_key) as sales_reason_key, * from x_reason""",
    "d_postal": "select postal_code, min(geography_key) as geography_key from d_geography group by postal_code",
    "d_customer": """
        select row_number() over (order by cast(customer_alternate_key as varchar)) as customer_key,
               cast(customer_alternate_key as varchar) as customer_alternate_key,
               coalesce(geography_key, (select unknown_key from d_unknown)) as geography_key,
               x_customer.* exclude (customer_alternate_key, city, state_province_code, postal_code)
        from x_customer left join d_postal on coalesce(x_customer.postal_code, 'Unknown') = d_postal.postal_code""",
    "d_first_reseller": """
        select * from x_reseller qualify row_number() over (
            partition by reseller_alternate_key
            order by phone nulls first, address_line1 nulls first, address_line2 nulls first, city nulls first,
                     state_province_code nulls first, postal_code nulls first) = 1""",
    "d_place": """
        select city, state_province_code, postal_code, min(geography_key) as geography_key
        from d_geography group by all""",
    "d_reseller": """
        select row_number() over (order by cast(reseller_alternate_key as varchar)) as reseller_key,
               coalesce(geography_key, (select unknown_key from d_unknown)) as geography_key,
               cast(reseller_alternate_key as varchar) as reseller_alternate_key,
               r.* exclude (reseller_alternate_key, city, state_province_code, postal_code)
        from d_first_reseller r left join d_place p
          on coalesce(r.city, 'Unknown') = p.city and coalesce(r.postal_code, 'Unknown') = p.postal_code
         and coalesce(r.state_province_code, 'Unknown') = p.state_province_code""",
    "d_employee": """
        select row_number() over (order by employee_alternate_key nulls first, department_name nulls first,
                   start_date nulls first, end_date nulls first, base_rate nulls first, pay_frequency nulls first,
                   email_address nulls first, phone nulls first) as employee_key,
               * replace (cast(employee_alternate_key as integer) as employee_alternate_key)
        from x_employee""",
    # -- facts ------------------------------------------------------------------
    "k_product": "select product_alternate_key as alt, min(product_key) as product_key from d_product group by 1",
    "k_customer": "select customer_alternate_key as alt, min(customer_key) as customer_key from d_customer group by 1",
    "k_reseller": "select reseller_alternate_key as alt, min(reseller_key) as reseller_key from d_reseller group by 1",
    "k_employee": "select employee_alternate_key as alt, min(employee_key) as employee_key from d_employee group by 1",
    "f_internet": """
        select x.* exclude (product_alternate_key, customer_alternate_key, promotion_alternate_key,
                            currency_alternate_key, sales_territory_alternate_key, order_date, due_date, ship_date),
               product_key, customer_key, promotion_key, currency_key, sales_territory_key,
               od.date_key as order_date_key, dd.date_key as due_date_key, sd.date_key as ship_date_key,
               unit_price * unit_price_discount_pct as discount_amount,
               cast(product_standard_cost * order_quantity as decimal(25,4)) as total_product_cost,
               extended_amount - unit_price * unit_price_discount_pct as sales_amount
        from x_internet x
        left join k_product on cast(x.product_alternate_key as varchar) = k_product.alt
        left join k_customer on cast(x.customer_alternate_key as varchar) = k_customer.alt
        left join d_promotion using (promotion_alternate_key)
        left join d_currency using (currency_alternate_key)
        left join d_territory using (sales_territory_alternate_key)
        left join d_date od on od.full_date_alternate_key = cast(x.order_date as date)
        left join d_date dd on dd.full_date_alternate_key = cast(x.due_date as date)
        left join d_date sd on sd.full_date_alternate_key = cast(x.ship_date as date)""",
    "f_internet_kept": """
        select * from f_internet
        where product_key is not null and customer_key is not null and order_date_key is not null""",
    "f_reseller": """
        select x.* exclude (product_alternate_key, reseller_alternate_key, employee_alternate_key,
                            promotion_alternate_key, currency_alternate_key, sales_territory_alternate_key,
                            order_date, due_date, ship_date),
               product_key, reseller_key, employee_key, promotion_key, currency_key, sales_territory_key,
               od.date_key as order_date_key, dd.date_key as due_date_key, sd.date_key as ship_date_key,
               unit_price * unit_price_discount_pct as discount_amount,
               cast(product_standard_cost * order_quantity as decimal(25,4)) as total_product_cost,
               extended_amount - unit_price * unit_price_discount_pct as sales_amount
        from x_reseller_sales x
        left join k_product on cast(x.product_alternate_key as varchar) = k_product.alt
        left join k_reseller on cast(x.reseller_alternate_key as varchar) = k_reseller.alt
        left join k_employee on x.employee_alternate_key = k_employee.alt
        left join d_promotion using (promotion_alternate_key)
        left join d_currency using (currency_alternate_key)
        left join d_territory using (sales_territory_alternate_key)
        left join d_date od on od.full_date_alternate_key = cast(x.order_date as date)
        left join d_date dd on dd.full_date_alternate_key = cast(x.due_date as date)
        left join d_date sd on sd.full_date_alternate_key = cast(x.ship_date as date)""",
    "f_reseller_kept": """
        select * from f_reseller where product_key is not null and reseller_key is not null
          and employee_key is not null and order_date_key is not null""",
}

# Target table -> the entry that states its loaded rows.
LOADED = {
    "dim_date": "d_date",
    "dim_currency": "d_currency",
    "dim_sales_territory": "d_territory",
    "dim_geography": "d_geography",
    "dim_promotion": "d_promotion",
    "dim_sales_reason": "d_reason",
    "dim_product_category": "d_category",
    "dim_product_subcategory": "d_subcategory",
    "dim_product": "d_product",
    "dim_customer": "d_customer",
    "dim_reseller": "d_reseller",
    "dim_employee": "d_employee",
    "fact_internet_sales": "f_internet_kept",
    "fact_reseller_sales": "f_reseller_kept",
}


def with_tables(statement: str) -> str:
    """Prefix a statement with the definitions it names, and those they name."""
    needed: set[str] = set()
    pending = [statement]
    while pending:
        for word in set(re.findall(r"\w+", pending.pop())) & DEFINITIONS.keys() - needed:
            needed.add(word)
            pending.append(DEFINITIONS[word])
    parts = [f"{name} as ({sql})" for name, sql in DEFINITIONS.items() if name in needed]
    return f"with {', '.join(parts)}\n{statement}" if parts else statement
