"""What a load of each landing file accepts, as SQL over the raw tables."""

from oracle.silver import RAW_OF, SILVER

# table -> (row number, date column, figure and its type, text column and its length); the faults landing files carry
_PLANTED = {
    "customer_demographics": ("customer_id", "date_of_birth", "annual_income", "decimal(18,2)", "gender", 20),
    "customer_service_interactions": (
        "CAST(interaction_id AS BIGINT)", "interaction_date", "duration_minutes", "decimal(18,2)", "follow_up_required", 10),
    "promotions_data": (
        "CAST(substr(promotion_id, 3) AS BIGINT)", "start_date", "discount_percentage", "decimal(6,4)", "promotion_type", 100),
    "marketing_campaigns": ("CAST(substr(campaign_id, 2) AS BIGINT)", "start_date", "budget", "decimal(18,2)", "campaign_type", 100),
    "logistics_and_shipping": (
        "CAST(split_part(shipment_id, '-', 1) AS BIGINT) * 8 + CAST(split_part(shipment_id, '-', 2) AS BIGINT)",
        "ship_date", "shipping_cost", "decimal(18,2)", "status", 50),
    "supplier_information": ("CAST(supplier_id AS BIGINT)", None, "lead_time", "bigint", "quality_rating", 5),
    "employee_records": ("CAST(employee_id AS BIGINT)", "hire_date", "salary", "decimal(18,2)", "department", 100),
}


def _spoilt(table: str) -> list[tuple[int, str]]:
    """Remainders of the row number, and the reason of the reject."""
    _, day, figure, kind, text, length = _PLANTED[table]
    key = next(sql for t, sql in SILVER.items() if RAW_OF[t] == table).split("PARTITION BY ")[1].split(" ")[0]
    found = [(5, f"{figure}: not a valid {kind}"), (7, f"{key}: missing key"), (11, f"{text}: longer than {length}"), (13, "wrong number of fields")]
    return found + ([(3, f"{day}: not a valid date")] if day else [])


def accepted(table: str) -> str:
    """Rows that pass: text is trimmed and empty text NULL, as the file formats say."""
    number, *_, text, _ = _PLANTED[table]
    bad = ", ".join(str(k) for k, _ in _spoilt(table))
    return f"""
SELECT * REPLACE (CASE WHEN ({number}) % 20 = 17 THEN NULL ELSE {text} END AS {text})
FROM (SELECT * REPLACE ({_trimmed(table)}) FROM {table}) AS trimmed WHERE ({number}) % 20 NOT IN ({bad})"""


_TEXT = {
    "customer_demographics": "name gender region country city marital_status",
    "customer_service_interactions": "interaction_id interaction_type issue_category description resolution_status follow_up_required",
    "promotions_data": "promotion_id product_category promotion_type region",
    "marketing_campaigns": "campaign_id campaign_name campaign_type product_category target_audience region",
    "logistics_and_shipping": "shipment_id order_id shipping_method status destination_region destination_country carrier",
    "supplier_information": "supplier_id supplier_name product_category region country city quality_rating",
    "employee_records": "employee_id name department job_title region country email",
}


def _trimmed(table: str) -> str:
    return ", ".join(f"nullif(trim({c}), '') AS {c}" for c in _TEXT[table].split())


def reasons(table: str) -> str:
    number = _PLANTED[table][0]
    cases = " ".join(f"WHEN {k} THEN '{reason}'" for k, reason in _spoilt(table))
    return f"""
SELECT reason, CAST(COUNT(*) AS BIGINT) AS nb_rows FROM (SELECT CASE ({number}) % 20 {cases} END AS reason FROM {table}) AS r
WHERE reason IS NOT NULL GROUP BY 1"""


PLANTED_TABLES = list(_PLANTED)
