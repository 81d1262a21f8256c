"""Names, headers and types of the source tables and the feature tables."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER = "cms_code_enc"
WINDOW_KEYS = [CUSTOMER, "window_size", "window_end"]

# --- fixed values: complaint codes of the shipment and customer-month tables
COMPLAINT_CODES = [114, 115, 116, 134, 194, 554, 595, 314, 594, 274, 614, 654, 234, 174]
COMPLAINT_COLUMNS = [f"complaint{code}" for code in COMPLAINT_CODES]

# --- fixed values: service letters, in the order used to break ties
SERVICES = ["c", "e", "m", "p", "r", "u", "l", "q"]
SERVICE_COLUMNS = [f"ser_{s}" for s in SERVICES]

# --- fixed values: canonical column order of each landing file
HEADERS: dict[str, list[str]] = {
    "bccp_orderitem": (
        "crm_code_enc cms_code_enc item_code_enc service_code weight_kg length_size width_size height_size "
        "total_fee is_domestic country_code send_province_code send_district_code send_commune_code "
        "rec_province_code rec_district_code rec_commune_code region sending_time ending_time rec_success "
        "refunded no_accepted lost_order delay_day done total_complaint"
    ).split()
    + COMPLAINT_COLUMNS
    + ["order_score", "bccp_update_date"],
    "cas_customer": (
        "cms_code_enc report_month item_count weight_kg total_fee intra_province international "
        "ser_c ser_e ser_m ser_p ser_r ser_u ser_l ser_q delay_day delay_count nodone refunded noaccepted "
        "lost_order lastday noservice dev_item order_score satisfaction_score total_complaint"
    ).split()
    + COMPLAINT_COLUMNS
    + ["updated_at"],
    "cms_complaint": (
        "cms_code_enc item_code create_complaint_date exp_complaint_date close_complaint_date delay_complaint "
        "complaint_code complaint_content complaint_content_bit complaint_update_date etl_date"
    ).split(),
    "cas_info": (
        "cms_code_enc crm_code_enc cus_province contract_service tenure custype customer_update_date "
        "contract_classify contract_sig_first contract_mgr_org cus_poscode"
    ).split(),
}

# --- fixed values: text columns guarded against spreadsheet formulas
TEXT_COLUMNS: dict[str, list[str]] = {
    "bccp_orderitem": ["crm_code", "cms_code_enc", "item_code", "service_code", "country_code", "region"],
    "cms_complaint": ["cms_code", "crm_code", "item_code", "complaint_content"],
    "cas_customer": ["cms_code_enc"],
    "cas_info": ["cms_code_enc", "crm_code"],
}

# --- fixed values: how each typed column is read (s text, i int, d decimal(3), t timestamp, m date)
TYPED_KINDS: dict[str, dict[str, str]] = {
    "bccp_orderitem": {
        **dict.fromkeys(["crm_code_enc", "cms_code_enc", "item_code", "service_code", "country_code", "region"], "s"),
        **dict.fromkeys(["weight_kg", "order_score"], "d"),
        **dict.fromkeys(
            (
                "length_size width_size height_size total_fee is_domestic rec_success refunded no_accepted "
                "lost_order delay_day done total_complaint send_province_code send_district_code "
                "send_commune_code rec_province_code rec_district_code rec_commune_code"
            ).split()
            + COMPLAINT_COLUMNS,
            "i",
        ),
        **dict.fromkeys(["sending_time", "ending_time", "bccp_update_date"], "t"),
    },
    "cas_customer": {
        "cms_code_enc": "s",
        "report_month": "m",
        **dict.fromkeys(
            (
                "item_count total_fee intra_province international ser_c ser_e ser_m ser_p ser_r ser_u ser_l "
                "ser_q delay_day delay_count nodone refunded noaccepted lost_order lastday noservice "
                "total_complaint"
            ).split()
            + COMPLAINT_COLUMNS,
            "i",
        ),
        **dict.fromkeys(["weight_kg", "dev_item", "order_score", "satisfaction_score"], "d"),
        "updated_at": "t",
    },
    "cas_info": {
        **dict.fromkeys(["cms_code_enc", "crm_code_enc"], "s"),
        **dict.fromkeys(
            (
                "cus_province contract_service tenure custype contract_classify contract_mgr_org cus_poscode"
            ).split(),
            "i",
        ),
        **dict.fromkeys(["customer_update_date", "contract_sig_first"], "t"),
    },
    "cms_complaint": {
        **dict.fromkeys(["cms_code_enc", "item_code", "complaint_content"], "s"),
        **dict.fromkeys(["delay_complaint", "complaint_code", "complaint_content_bit"], "i"),
        **dict.fromkeys(
            "create_complaint_date exp_complaint_date close_complaint_date complaint_update_date etl_date".split(), "t"
        ),
    },
}

# --- fixed values: tables and columns a feature build needs
REQUIRED_SOURCES: dict[str, list[str]] = {
    "bccp_orderitem": ["cms_code_enc", "sending_time"],
    "cas_customer": ["cms_code_enc", "report_month"],
    "cas_info": ["cms_code_enc"],
    "cms_complaint": ["cms_code_enc", "complaint_code", "create_complaint_date"],
}

# --- fixed values: metrics pivoted by month, and the signals smoothed over them
PIVOT_METRICS = ["item", "revenue", "complaint", "delay", "nodone", "order_score", "satisfaction"]
EWMA_METRICS = ["item", "revenue", "complaint", "delay", "nodone", "order", "satisfaction"]

# --- fixed values: the numeric model features
MODEL_FEATURES = (
    "item_sum item_avg item_std item_median revenue_sum revenue_avg revenue_std complaint_sum complaint_avg "
    "weight_sum weight_avg avg_revenue_per_item pct_delay pct_refund pct_noaccepted pct_lost_order "
    "pct_complaint pct_successful_item pct_intra_province pct_international avg_delayday order_score_avg "
    "satisfaction_avg active_months inactive_months active_days inactive_days avg_noservice_days avg_lastday "
    "item_slope revenue_slope satisfy_slope complaint_slope cv_item cv_revenue item_range revenue_range "
    "service_types_used dominant_service_ratio ser_c_sum ser_e_sum ser_m_sum ser_p_sum ser_r_sum ser_u_sum "
    "ser_l_sum ser_q_sum recency frequency monetary"
).split() + [
    f"{prefix}_{metric}" for metric in EWMA_METRICS for prefix in ("ewma", "delta_ewma")
] + ["ewma", "delta_ewma"]

# --- fixed values: name parts that betray a label or a future column
LEAKY_NAME_PARTS = [
    "y_raw", "y_label", "y_smooth", "label", "target", "churn", "item_in_horizon", "rev_in_horizon", "future",
]


def typed_schema(base: str) -> T.StructType:
    """Schema of a typed source table (see ``TYPED_KINDS``)."""
    kinds = {
        "s": T.StringType(),
        "i": T.LongType(),
        "d": T.DecimalType(38, 3),
        "t": T.TimestampNTZType(),
        "m": T.DateType(),
    }
    return T.StructType([T.StructField(name, kinds[k]) for name, k in TYPED_KINDS[base].items()])


def landing_schema(base: str) -> T.StructType:
    """All-text schema of a landing file in canonical order."""
    return T.StructType([T.StructField(name, T.StringType()) for name in HEADERS[base]])


INGEST_LOG_SCHEMA = T.StructType(
    [
        T.StructField("zip_name", T.StringType()),
        T.StructField("base", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("period_key", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("file_mtime", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)
