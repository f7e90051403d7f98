"""Building blocks of the oracle SQL: the domains of ``domain.py`` written for DuckDB."""

from __future__ import annotations

ORDERS = """
orders_ev as (
  select concat('ORD-', l_orderkey, '-', l_linenumber) as order_id,
    case when o_orderpriority = '5-LOW' then 'CUST-GUEST' else concat('CUST-', o_custkey) end as customer_id,
    case when l_linenumber = 7 then 'PROD-GIFT' else concat('PROD-', l_partkey) end as product_id,
    cast(l_quantity as int) as quantity,
    cast(l_extendedprice as decimal(10,2)) as unit_price,
    cast(case when l_quantity = 1 then -cast(l_extendedprice as decimal(10,2))
              when l_discount = 0 then 0
              else cast(l_extendedprice as decimal(10,2)) * cast(l_quantity as int) end as decimal(12,2)) as total_amount,
    case when l_returnflag = 'R' then ' Cancelled ' when o_orderstatus = 'F' then 'DELIVERED'
         when o_orderstatus = 'O' then 'shipped' else 'pending' end as status,
    case when l_linestatus = 'O' then 'credit_card' else 'paypal' end as payment_method,
    o_orderdate as event_ts, 'order_created' as event_type
  from lineitem join orders on l_orderkey = o_orderkey)"""

CUSTOMERS = """
customer_ev as (
  select concat('CUST-', c_custkey) as customer_id, concat('c', c_custkey, '@example.com') as email,
    c_name as name,
    case when v = 2 and c_mktsegment in ('BUILDING', 'MACHINERY') then 'International'
         when v = 2 then 'Central'
         when c_mktsegment = 'FURNITURE' and c_acctbal < 0 then null else r_name end as region,
    case when c_acctbal < 0 then '18-25' else '26-35' end as age_group,
    cast(date '1994-01-01' + cast(c_nationkey
      + case when v = 2 and c_mktsegment in ('BUILDING', 'MACHINERY') then 100 else 0 end as int) as timestamp) as created_at
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    cross join (values (1), (2)) versions(v)
  where v = 1 or c_mktsegment in ('BUILDING', 'MACHINERY', 'HOUSEHOLD')),
dim_customer as (
  select * exclude (rn) from (
    select *, row_number() over (partition by customer_id
      order by created_at desc, email desc, name desc, region desc nulls last, age_group desc) rn
    from customer_ev) where rn = 1)"""

PRODUCTS = """
product_ev as (
  select concat('PROD-', p_partkey) as product_id, p_name as name,
    case when v = 2 then 'CLEARANCE' else p_type end as category,
    cast(p_retailprice as decimal(10,2)) as price, p_size as stock_quantity,
    cast(date '1994-01-01' + cast(p_size + case when v = 2 then 100 else 0 end as int) as timestamp) as created_at
  from part cross join (values (1), (2)) versions(v) where v = 1 or p_brand = 'Brand#1'),
dim_product as (
  select * exclude (rn) from (
    select *, row_number() over (partition by product_id
      order by created_at desc, name desc, category desc, price desc, stock_quantity desc) rn
    from product_ev) where rn = 1)"""

EV = """
ev as (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events)"""

_SITE = "case when event_type = 'signup' then 0 else user_id % 5 end"


def _readings(name: str, repeats: bool) -> str:
    copies = ("cross join (values (0), (1)) copies(c) "
              "where c = 0 or event_type in ('click', 'purchase')" if repeats
              else "cross join (values (0)) copies(c)")
    return f"""
{name} as (
  select case when not (event_type = 'error' and value < 0.5) then concat('RD-', event_id) end as reading_id,
    (['LOC-001','LOC-002','LOC-003','LOC-004','LOC-005'])[site + 1] as location_id,
    (['Warehouse A','Factory B','Office C','Depot D','Plant E'])[site + 1] as site_name,
    cast(case when not (event_type = 'view' and value < 1) then 22 + value % 8
      + case when hour(ts) = 13 and site = 2 and day(ts) % 7 = 0 then 40
             when event_type = 'error' and value >= 150 then 60 else 0 end
      + case when c = 1 and event_type = 'click' then 1 else 0 end end as float) as temperature,
    cast(case when k = 99 then 800 when k = 0 then 870 when k = 1 then 1085 else k + 963 end as float) as pressure,
    cast(case when k = 98 then -1 when value > 480 then 100.5 else k + c / 2.0 end as float) as humidity,
    cast(value / 1000 as float) as vibration,
    cast(([3.1390, 1.3521, 13.7563, 22.3193, 37.5665])[site + 1] as float) as lat,
    cast(([101.6869, 103.8198, 100.5018, 114.1694, 126.9780])[site + 1] as float) as lon,
    event_type = 'error' as is_anomaly,
    cast(k as float) as battery_pct,
    case when not (event_type = 'purchase' and value < 0.5)
      then ts + to_seconds(case when c = 1 and event_type = 'click' then 1 else 0 end) end as event_ts
  from (select *, cast({_SITE} as int) as site from ev) {copies})"""


READINGS = _readings("readings", repeats=False)
REPEATED_READINGS = _readings("raw_readings", repeats=True)

FACT_SENSORS = """
fact_sensors as (
  select reading_id, location_id, cast(strftime(event_ts, '%Y%m%d') as int) as date_key,
    temperature, pressure, humidity, lat, lon, event_ts
  from readings where reading_id is not null and event_ts is not null)"""

STG_SENSORS = """
stg_sensors as (
  select *, temperature between -50 and 85 as temp_in_range, pressure between 870 and 1085 as pressure_in_range,
    humidity between 0 and 100 as humidity_in_range
  from fact_sensors where reading_id is not null and location_id is not null),
ok as (select * from stg_sensors where temp_in_range and pressure_in_range and humidity_in_range)"""

HOURLY = """
day_stats as (
  select location_id, date_trunc('day', event_ts) as day_ts, avg(temperature) as avg_temp_day,
    stddev_pop(temperature) as std_temp_day, avg(pressure) as avg_pressure_day, stddev_pop(pressure) as std_pressure_day
  from ok group by 1, 2),
hourly as (
  select location_id, date_trunc('hour', event_ts) as hour_ts, avg(temperature) as avg_temp,
    avg(pressure) as avg_pressure, avg(humidity) as avg_humidity, count(*) as reading_count
  from ok group by 1, 2),
annotated as (
  select h.*, st.avg_temp_day, st.std_temp_day, st.avg_pressure_day, st.std_pressure_day,
    abs(h.avg_temp - st.avg_temp_day) > 3 * st.std_temp_day as temp_anomaly
  from hourly h left join day_stats st
    on h.location_id = st.location_id and date_trunc('day', h.hour_ts) = st.day_ts),
agg_hourly_sensor as (
  select location_id, hour_ts, avg_temp, avg_pressure, avg_humidity, reading_count,
    cast(temp_anomaly as int) as anomaly_flag from annotated)"""

TRADES = """
trade_ev as (
  select case when event_type <> 'signup' then concat('TR-', event_id) end as trade_id,
    case when k % 3 = 0 then concat(' ', lower(a), ' ') else a end as asset,
    (['buy',' BUY ','sell','Sell','hold'])[k % 5 + 1] as side,
    cast(k / 4.0 as float) as quantity,
    cast(case when k = 7 then 0 else cast(value as decimal(10,2)) * 4 end as decimal(18,8)) as price,
    cast(cast(value as decimal(10,2)) * k as decimal(18,4)) as total_value,
    case when k % 2 = 0 then 'NYSE' else 'LSE' end as exchange, ts as event_ts,
    case when event_type = 'signup' then 'transfer' else 'trade_executed' end as event_type
  from (select *, (['BTC','ETH','AAPL','GOOGL','TSLA','MSFT','AMZN','SPY','QQQ','GLD'])[user_id % 10 + 1] as a from ev)),
fact_trades as (
  select trade_id, asset, side, quantity, price, total_value,
    cast(strftime(event_ts, '%Y%m%d') as int) as date_key, event_ts
  from trade_ev where event_type = 'trade_executed'),
stg_trades as (
  select * replace (upper(trim(asset)) as asset, lower(trim(side)) as side) from fact_trades
  where trade_id is not null and quantity > 0 and price > 0 and lower(trim(side)) in ('buy', 'sell'))"""

POSTS = """
post_ev as (
  select concat('PO-', event_id) as post_id, concat('U-', user_id) as user_id,
    case when k % 4 = 0 then concat(' ', upper(p)) when k <> 13 then p end as platform,
    (['Post','Reel','Story','Comment','Share','Review'])[event_id % 6 + 1] as content_type,
    cast(floor(value) as int) as likes, k % 10 as shares, k as comments,
    (['positive','neutral','negative'])[event_id % 3 + 1] as sentiment, ts as event_ts
  from (select *, (['twitter','instagram','facebook','tiktok','linkedin','reddit'])[user_id % 6 + 1] as p from ev)),
fact_social as (
  select post_id, user_id, platform, content_type, likes, shares, comments,
    cast(strftime(event_ts, '%Y%m%d') as int) as date_key, event_ts from post_ev),
stg_social as (
  select * replace (lower(trim(platform)) as platform, lower(trim(content_type)) as content_type),
    likes + shares * 3 + comments * 2 as weighted_engagement
  from fact_social where platform is not null)"""

_FACT_SALES = """
{name} as (
  select md5(concat_ws('-', order_id, product_id, strftime(event_ts, '%Y%m%d'))) as sale_id, order_id, customer_id,
    product_id, cast(strftime(event_ts, '%Y%m%d') as int) as date_key, quantity, unit_price, total_amount, status,
    event_ts from {rows})"""
# Sales as the events bring them, repeats included.
REPEATED_SALES = _FACT_SALES.format(name="sales_rows", rows="orders_ev")
FACT_SALES = """
latest_orders as (select * exclude (rn) from (
  select *, row_number() over (partition by order_id, cast(event_ts as date) order by event_ts desc, customer_id desc,
    product_id desc, quantity desc, unit_price desc, total_amount desc, status desc) as rn from orders_ev) where rn = 1),
""" + _FACT_SALES.format(name="fact_sales", rows="latest_orders") + """,
stg_sales as (
  select * replace (lower(trim(status)) as status) from fact_sales
  where customer_id is not null and product_id is not null and total_amount > 0)"""


def average(column: str, scale: int, digits: int, final: int | None = None) -> str:
    """Exact mean of a decimal, rounded half up to ``digits`` (then to ``final``) places."""
    cents = f"cast(round(cast({column} as decimal(38,{scale})) * {10 ** scale}) as hugeint)"
    total, n = f"sum({cents})", f"count({column})"
    scaled = f"(2 * abs({total}) * {10 ** (digits - scale)} + {n}) // (2 * {n})"
    places = digits
    if final is not None:
        step = 10 ** (digits - final)
        scaled, places = f"({scaled} + {step // 2}) // {step}", final
    return f"cast(sign({total}) * ({scaled}) as double) / {float(10 ** places)!r}"


DAILY_REVENUE = f"""
daily_revenue as (
  select date_key, cast(event_ts as date) as full_date, coalesce(region, 'unknown') as region,
    coalesce(category, 'unknown') as category, count(*) as total_orders,
    cast(sum(total_amount) as double) as total_revenue,
    {average('total_amount', 2, 6)} as avg_order_value, cast(sum(quantity) as bigint) as total_units
  from stg_sales s left join dim_product p on s.product_id = p.product_id
    left join dim_customer c on s.customer_id = c.customer_id
  where status <> 'cancelled' group by 1, 2, 3, 4)"""

TRADING_VOLUME = f"""
trading_volume as (
  select date_key, cast(event_ts as date) as full_date, asset, cast(sum(quantity) as double) as total_volume,
    count(*) as trade_count, {average('price', 8, 12)} as avg_price, cast(sum(total_value) as double) as total_value,
    count(*) filter (where side = 'buy') as buy_count, count(*) filter (where side = 'sell') as sell_count
  from stg_trades group by 1, 2, 3)"""

SALES = (ORDERS, FACT_SALES)
DIMS = (CUSTOMERS, PRODUCTS)
REVENUE = (*SALES, *DIMS, DAILY_REVENUE)
SENSORS = (EV, READINGS, FACT_SENSORS)
ANOMALIES = (*SENSORS, STG_SENSORS, HOURLY)
TRADING = (EV, TRADES, TRADING_VOLUME)
SOCIAL = (EV, POSTS)


def sql(parts: tuple[str, ...], body: str) -> str:
    return "with " + ",".join(parts).strip() + "\n" + body.strip()


# --- text

SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

def word_match(text: str, words: str, middle: str = "") -> str:
    """A RE2 test for whole words in any script, with ``middle`` after them."""
    pattern = rf"(^|[^\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}])({words})" + (
        middle or rf"($|[^\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}])")
    return f"regexp_matches({text}, '(?i){pattern}')"


QUESTIONS_CTE = """
questions as (
  select conv_id, turn, concat_ws(' ', (['What is the TOTAL of all revenue?', 'Show the best selling product',
    'Any unusual spike today?', 'crypto trade please', 'Which platform do people like?',
    'humidity and temperature now', 'Is the pipeline status fine?', concat('Sum up', chr(10), 'the sales'),
    'Good morning'])[conv_id % 9 + 1], text) as question
  from conversations)"""


def _rule(first: str, second: str | None = None) -> str:
    if second is None:
        return word_match("question", first)
    # The first word may run on; anything on the same line; the second ends as a word.
    return word_match("question", first, rf"[^\n]*({second})($|[^\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}])")


ROUTED_CTE = f"""
routed as (
  select *, case
    when {_rule('total|sum', 'revenue|sales|amount')} then 1
    when {_rule('top|best|highest', 'product|item|sku')} then 2
    when {_rule('anomal|spike|outlier|unusual')} then 3
    when {_rule('trade|volume|asset|crypto|stock')} then 4
    when {_rule('social|engagement|like|share|platform')} then 5
    when {_rule('sensor|temperature|humidity|pressure|iot')} then 6
    when {_rule('pipeline|status|health|lag|kafka')} then 7 else 8 end as n
  from questions)"""

STATEMENTS_CTE = """
statements as (
  select conv_id, turn, case conv_id % 6
    when 0 then concat('```sql', chr(10), 'select ''', t, ''' as t;', chr(10), '```')
    when 1 then concat('  SELECT created_at, ''', t, '''; DROP TABLE x;')
    when 2 then concat('```', chr(10), 'DROP TABLE t -- ', t, chr(10), '```')
    when 3 then concat('select 1 /* ', t, ' */ union delete from t')
    when 4 then concat('```SQL select updated_at from t where a = ''', t, ''' ```')
    else text end as answer
  from (select *, replace(text, '''', '''''') as t from conversations))"""


def stripped(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{SPACE}+', ''), '{SPACE}+$', '')"


CLEAN_SQL = (
    "concat(" + stripped(
        "split_part(regexp_replace(regexp_replace(" + stripped("answer")
        + f", '^```(?:sql)?{SPACE}*', '', 'i'), '{SPACE}*```$', ''), ';', 1)")
    + ", ';')")
