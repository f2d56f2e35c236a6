"""The test tables in the five roles, and the features on them, as common table expressions."""

from __future__ import annotations

CTES = {
    "products": """
        select p_partkey as product_id, p_type as product_category_name,
               cast(length(p_name) as integer) as product_name_lenght,
               cast(length(p_brand) as integer) as product_description_lenght,
               p_size % 6 as product_photos_qty,
               cast(nullif(p_size % 11, 0) as double) as product_weight_g,
               cast(p_size as double) as product_length_cm,
               cast(p_size % 7 + 1 as double) as product_width_cm,
               cast(p_size % 5 + 1 as double) as product_height_cm
        from part""",
    "product_features": """
        select *,
               product_length_cm * product_width_cm * product_height_cm as product_volume,
               product_length_cm * product_width_cm * product_height_cm
                   / nullif(product_weight_g, 0) as size_to_weight_ratio,
               product_weight_g / nullif(product_length_cm * product_width_cm
                   * product_height_cm, 0) as product_density
        from products""",
    "clean_products": """
        select distinct * from product_features
        where product_weight_g is not null and product_density is not null
          and size_to_weight_ratio is not null""",
    "purchases": """
        select o_orderkey as order_id, o_custkey as customer_id, o_orderstatus as order_status,
               o_orderdate as order_purchase_timestamp,
               o_orderdate + to_hours(o_orderkey % 72) as order_approved_at,
               o_orderdate + to_days(cast(o_orderkey % 5 as integer))
                   as order_delivered_carrier_date,
               case when o_orderstatus <> 'P'
                    then o_orderdate + to_days(cast(o_orderkey % 30 as integer)) end
                   as order_delivered_customer_date,
               o_orderdate + to_days(15) as order_estimated_delivery_date
        from orders""",
    "clean_purchases": """
        select distinct * from purchases where order_delivered_customer_date is not null""",
    "items": """
        select l_orderkey as order_id, l_linenumber as order_item_id, l_partkey as product_id,
               l_extendedprice as price,
               cast(l_extendedprice as decimal(12,2)) as price_dec,
               cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2))
                   as shipping_dec,
               cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2))
                   as double) as shipping_cost
        from lineitem""",
    "item_features": """
        select *, price + shipping_cost as item_total_cost,
               shipping_cost / nullif(price, 0) as shipping_to_price_ratio
        from items""",
    "payments": """
        select l_orderkey as order_id, l_linenumber as payment_sequential,
               l_returnflag as payment_type,
               cast(round(l_discount * 100) as integer) as payment_installments,
               l_extendedprice as payment_value
        from lineitem""",
    "payment_features": """
        select *, case when payment_installments > 0
                       then payment_value / payment_installments end as installment_value
        from payments""",
    "order_totals": """
        select order_id,
               cast(sum(cast(payment_value as decimal(12,2))) as double) as monetary_value
        from payments group by order_id""",
    "reviews": """
        select o_orderkey as review_id, o_orderkey as order_id,
               cast(substr(o_orderpriority, 1, 1) as integer) as review_score,
               o_orderdate as review_creation_date,
               o_orderdate + to_days(cast(o_orderkey % 5 as integer))
                   as review_answer_timestamp
        from orders""",
    "visits": """
        select event_id as review_id, user_id as order_id,
               cast(floor(value) as integer) % 5 + 1 as review_score,
               ts as review_creation_date,
               ts + to_hours(event_id % 48) as review_answer_timestamp
        from events""",
    "history": """
        select customer_id, count(order_id) as order_count,
               min(order_purchase_timestamp) as first_order_date,
               max(order_purchase_timestamp) as last_order_date,
               cast(date_diff('day', max(order_purchase_timestamp),
                    (select max(order_purchase_timestamp) from clean_purchases)) as integer)
                   as recency
        from clean_purchases group by customer_id""",
    "order_side": """
        select o.*, h.order_count, h.first_order_date, h.last_order_date, h.recency,
               case when h.order_count > 1 then 1 else 0 end as is_repeated_customer,
               cast(date_diff('day', order_purchase_timestamp, order_delivered_customer_date)
                   as integer) as delivery_duration,
               cast(date_diff('day', order_purchase_timestamp, order_approved_at)
                   as integer) as approval_duration,
               cast(date_diff('day', order_delivered_customer_date,
                    order_estimated_delivery_date) as integer) as delivery_delay
        from clean_purchases o left join history h on o.customer_id = h.customer_id""",
    "item_profile": """
        select order_id, {item_measures}, {product_measures}
        from item_features left join clean_products using (product_id)
        group by order_id""",
    "one_product": """
        select order_id, product_id from (
            select order_id, product_id, row_number() over (
                partition by order_id order by order_item_id, product_id) as place
            from items) where place = 1""",
    "item_agg": """
        select order_id, {item_measures} from item_features group by order_id""",
    "payment_agg": """
        select order_id,
               max(case when payment_type = 'A' then 1 else 0 end) as "dummy_A",
               max(case when payment_type = 'N' then 1 else 0 end) as "dummy_N",
               max(case when payment_type = 'R' then 1 else 0 end) as "dummy_R",
               max(payment_sequential) as total_payment_sequential,
               cast(sum(cast(payment_value as decimal(12,2))) as double) as total_payment_value,
               avg(payment_installments) as avg_payment_installments,
               max(payment_installments) as max_payment_installments
        from payments group by order_id""",
    "labels_by_order": """
        select order_id, case when review_score >= 4 then 1 else 0 end as review,
               review_answer_timestamp as latest_timestamp,
               cast((epoch_us(review_answer_timestamp) - epoch_us(review_creation_date))
                   // 1000000 as double) / 86400 as review_responsiveness
        from reviews""",
}


def _money(name: str, exact: str) -> str:
    return f"""min({name}) as min_{name}, max({name}) as max_{name},
        cast(sum({exact}) as double) / count({name}) as avg_{name},
        cast(sum({exact}) as double) as total_{name}"""


ITEM_MEASURES = ",\n".join(
    [
        "count(order_item_id) as nbr_items",
        _money("price", "price_dec"),
        _money("shipping_cost", "shipping_dec"),
        _money("item_total_cost", "price_dec + shipping_dec"),
        """min(shipping_to_price_ratio) as min_shipping_to_price_ratio,
        max(shipping_to_price_ratio) as max_shipping_to_price_ratio,
        round(avg(shipping_to_price_ratio), 6) as avg_shipping_to_price_ratio,
        round(sum(shipping_to_price_ratio), 6) as total_shipping_to_price_ratio""",
    ]
)
PRODUCT_MEASURES = """
    avg(product_name_lenght) as avg_name_length,
    avg(product_description_lenght) as avg_description_length,
    cast(sum(product_photos_qty) as bigint) as total_photos,
    sum(product_weight_g) as total_weight_g,
    sum(product_volume) as total_volume,
    avg(product_volume) as avg_product_volume_per_order,
    round(sum(product_density), 9) as total_product_density,
    round(avg(product_density), 9) as avg_product_density,
    string_agg(distinct product_category_name, ', ' order by product_category_name) as category,
    count(distinct product_category_name) as distincy_category_count"""

# Sums of ratios depend on the order of addition in their last bits, so both engines round them.
# The decimals are chosen where no value of this data can lie half way between two results: a
# density is a fraction over 64 at most, and its mean over 8 of them has nine decimals.
ROUNDED = {
    "avg_shipping_to_price_ratio": 6,
    "total_shipping_to_price_ratio": 6,
    "total_product_density": 9,
    "avg_product_density": 9,
}


def with_roles(*names: str) -> str:
    """The ``with`` clause that defines the named expressions, in the order given."""
    parts = []
    for name in names:
        body = CTES[name].replace("{item_measures}", ITEM_MEASURES)
        body = body.replace("{product_measures}", PRODUCT_MEASURES)
        parts.append(f"{name} as ({body})")
    return "with " + ",\n".join(parts) + "\n"


BASE = (
    "products",
    "product_features",
    "clean_products",
    "purchases",
    "clean_purchases",
    "history",
    "order_side",
    "items",
    "item_features",
    "item_profile",
    "payments",
    "payment_agg",
    "reviews",
    "labels_by_order",
)
