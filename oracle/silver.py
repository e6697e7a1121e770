"""Clean tables as SQL over the raw ones.

Survivor of a duplicate key: smallest in the remaining columns, NULLs last.
"""


def _blank(*cols):
    return {c: f"trim(nullif({c}, ''))" for c in cols}


def _positive(*cols):
    return {c: f"CASE WHEN {c} < 0 THEN NULL ELSE {c} END" for c in cols}


def _within(low, high, *cols):
    return {c: f"CASE WHEN {c} BETWEEN {low} AND {high} THEN {c} END" for c in cols}


def _ordered_end(start, end):
    return {end: f"CASE WHEN {start} > {end} THEN NULL ELSE {end} END"}


# target -> (raw table, columns in order, rules, key, leading order)
_RULES = {
    "customer_demographics_clean": (
        "customer_demographics",
        "customer_id name date_of_birth gender region country city marital_status annual_income",
        _blank("name", "gender", "region", "country", "city", "marital_status") | _positive("annual_income"),
        "customer_id", None,
    ),
    "customer_service_interactions_clean": (
        "customer_service_interactions",
        "interaction_id interaction_date interaction_type issue_category description duration_minutes "
        "resolution_status follow_up_required customer_satisfaction",
        _blank("interaction_id", "interaction_type", "issue_category", "resolution_status", "follow_up_required")
        | {"description": "trim(description)"}
        | _positive("duration_minutes") | _within(1, 5, "customer_satisfaction"),
        "interaction_id", None,
    ),
    "financial_transactions_clean": (
        "financial_transactions",
        "transaction_id transaction_date transaction_type amount payment_method entity region account_code",
        _blank("transaction_id", "transaction_type", "payment_method", "entity", "region", "account_code")
        | _positive("amount"),
        "transaction_id", None,
    ),
    "promotions_clean": (
        "promotions_data",
        "promotion_id product_category promotion_type discount_percentage start_date end_date region",
        _blank("promotion_id", "product_category", "promotion_type", "region")
        | _within(0, 1, "discount_percentage") | _ordered_end("start_date", "end_date"),
        "promotion_id", None,
    ),
    "marketing_campaigns_clean": (
        "marketing_campaigns",
        "campaign_id campaign_name campaign_type product_category target_audience start_date end_date region "
        "budget reach conversion_rate",
        _blank("campaign_id", "campaign_name", "campaign_type", "product_category", "target_audience", "region")
        | _positive("budget", "reach") | _within(0, 1, "conversion_rate"),
        "campaign_id", None,
    ),
    "product_reviews_clean": (
        "product_reviews",
        "review_id product_id reviewer_id reviewer_name rating review_date review_title review_text product_category",
        _blank("product_id", "reviewer_id", "reviewer_name", "product_category")
        | {"review_title": "trim(review_title)", "review_text": "trim(review_text)"} | _within(1, 5, "rating"),
        "review_id", None,
    ),
    "logistics_and_shipping_clean": (
        "logistics_and_shipping",
        "shipment_id order_id ship_date estimated_delivery shipping_method status shipping_cost "
        "destination_region destination_country carrier",
        _blank("shipment_id", "order_id", "shipping_method", "status", "destination_region",
               "destination_country", "carrier")
        | _positive("shipping_cost") | _ordered_end("ship_date", "estimated_delivery"),
        "shipment_id", None,
    ),
    "supplier_information_clean": (
        "supplier_information",
        "supplier_id supplier_name product_category region country city lead_time reliability_score quality_rating",
        _blank("supplier_id", "supplier_name", "product_category", "region", "country", "city", "quality_rating")
        | _positive("lead_time") | _within(0, 1, "reliability_score"),
        "supplier_id", None,
    ),
    "employee_records_clean": (
        "employee_records",
        "employee_id name date_of_birth hire_date department job_title salary region country email",
        _blank("employee_id", "name", "department", "job_title", "region", "country")
        | {"email": "lower(trim(nullif(email, '')))"} | _positive("salary"),
        "employee_id", None,
    ),
    "inventory_clean": (
        "inventory",
        "product_id product_category region country warehouse current_stock reorder_point lead_time last_restock_date",
        _blank("product_id", "product_category", "region", "country", "warehouse")
        | _positive("current_stock", "reorder_point", "lead_time"),
        "product_id country warehouse", "last_restock_date",
    ),
    "store_locations_clean": (
        "store_locations",
        "store_id store_name store_type region country city address postal_code square_footage employee_count",
        _blank("store_id", "store_name", "store_type", "region", "country", "city", "address", "postal_code")
        | _positive("square_footage", "employee_count"),
        "store_id", None,
    ),
}


def _sql(raw, columns, rules, key, latest):
    columns, key = columns.split(), key.split()
    ruled = ", ".join(f"{rules.get(c, c)} AS {c}" for c in columns)
    order = ([f"{latest} DESC NULLS LAST"] if latest else []) + [
        f"{c} ASC NULLS LAST" for c in columns if c not in key and c != latest
    ]
    return (
        f"SELECT * FROM (SELECT {ruled} FROM {raw}) AS ruled\n"
        f"QUALIFY row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {', '.join(order)}) = 1"
    )


SILVER = {target: _sql(*rule) for target, rule in _RULES.items()}
RAW_OF = {target: rule[0] for target, rule in _RULES.items()}
