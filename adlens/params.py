"""Parameters. Nothing brand- or month-specific is hard-coded in operators:
focus brand, months, rule tables and token lists arrive through ``Params``.

Two parameter sets live here:

* ``EXPORT_PARAMS`` the values of the original marketing exports (fixed
  values that must stay exactly as written for equal results on those files);
* ``DRIVER_PARAMS`` the same roles filled for the TPC-H-like driver tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values of the original exports (kept verbatim, in their natural order).
# ---------------------------------------------------------------------------

# brand, platform, pattern, priority  (file order is the last tie-break)
EXPORT_BRAND_RULES = [
    ("Treats Portfolio", "meta", "%treat%", 200),
    ("Treats Portfolio", "meta", "%treats%", 200),
    ("Treats Portfolio", "google", "%treat%", 200),
    ("Treats Portfolio", "google", "%treats%", 200),
    ("Yakies", "meta", "%yakies%", 100),
    ("Yakies", "google", "%yakies%", 100),
    ("YIMT", "meta", "%yimt%", 100),
    ("YIMT", "google", "%yimt%", 100),
    ("Yum Num", "meta", "%yumnum%", 100),
    ("Yum Num", "meta", "%yum num%", 100),
    ("Yum Num", "google", "%yumnum%", 100),
    ("Yum Num", "google", "%yum num%", 100),
    ("Hearty", "meta", "%hearty%", 100),
    ("Hearty", "meta", "%heartyk%", 100),
    ("Hearty", "google", "%hearty%", 100),
    ("Meowsi", "meta", "%meowsi%", 100),
    ("Meowsi", "google", "%meowsi%", 100),
    ("NutriMeow", "meta", "%nutrimeow%", 100),
    ("NutriMeow", "google", "%nutrimeow%", 100),
    ("Sara's", "meta", "%sara%", 80),
    ("Sara's", "google", "%sara%", 80),
    ("Sara's", "meta", "%swf%", 80),
    ("Sara's", "google", "%swf%", 80),
    ("Sara's", "meta", "%wholesome%", 120),
    ("Sara's", "google", "%wholesome%", 120),
]

# Keyword dictionary for rule inference: brand -> keywords in priority order.
EXPORT_BRAND_KEYWORDS = {
    "Sara's": ["sara", "sara's", "saratreats", "sara treats"],
    "Treats Portfolio": ["treats", "treat"],
    "Sara's Treats": ["saratreats", "sara treats", "sara's treats"],
    "Yakies": ["yakies"],
    "YIMT": ["yimt"],
    "Yum Num": ["yumnum", "yum num"],
    "Hearty": ["hearty", "heartyk"],
    "Meowsi": ["meowsi"],
    "NutriMeow": ["nutrimeow", "nutri meow"],
}

EXPORT_MONTHS = ["2025-12", "2026-01", "2026-02"]
EXPORT_FOCUS_BRAND = "Sara's"
EXPORT_BRAND_LABEL = "saras"
# Campaign-type text that marks demand generation.
EXPORT_GENERATION_TOKENS = ["video", "demand gen", "display"]
# Audit confidence tokens: high first, then low, else medium.
EXPORT_HIGH_CONFIDENCE_TOKENS = [" swf", "swf_", "_swf", "sara's", "saras", "wholesome"]
EXPORT_LOW_CONFIDENCE_TOKENS = ["dog food"]
EXPORT_SIGNAL_REGEX = "(?i)(sara|swf|wholesome)"
EXPORT_TITLE_REGEX = "sara|wholesome"
# Guardrails: names containing the first token must map to the focus brand;
# names containing the second must not.
EXPORT_MUST_MAP_TOKENS = ["wholesome"]
EXPORT_MUST_NOT_MAP_TOKENS = ["treat", "treats"]
# Dashboard channel labels and campaign-key aliases.
EXPORT_CHANNEL_LABELS = {"blinkit": "blinkit_cpass", "instamart": "instamart_cpass"}
EXPORT_KEY_ALIASES = {"pmax_sara_s_new_customer": "pmax_sara_s_wholesome_new_customer"}
# Source classification: ordered (substring of lower-cased path, source group).
EXPORT_SOURCE_RULES = [
    ("google dashboard", "google_ads_campaign"),
    ("google shopify dashboard", "google_shopify"),
    ("swfxmetadashboard", "meta_d2c_adset"),
    ("swf-metaxshopifydashboard", "meta_shopify_sales"),
    ("swf-metaxblinkit", "meta_blinkit"),
    ("swf-metaxinstamart", "meta_instamart"),
    ("amazon sales_sara_s wholesome", "amazon_sales"),
    ("new vs returning", "shopify_new_vs_returning"),
    ("volume trend", "brand_search_google"),
    ("platformwise spend", "platform_spend"),
]
# Source groups that are expected once per month.
EXPORT_MONTHLY_SOURCES = ["google_ads_campaign", "google_shopify", "meta_d2c_adset",
                          "meta_shopify_sales", "meta_blinkit", "meta_instamart", "amazon_sales"]
# Manifest status order for sorting.
EXPORT_STATUS_ORDER = ["awaited", "received_needs_validation", "received_xlsx_manual_etl",
                       "received_ready_csv"]
# Customer buckets of the new-vs-returning export.
EXPORT_CUSTOMER_BUCKETS = {"new": "d2c_new_customers", "returning": "d2c_repeat_customers"}


@dataclass(frozen=True)
class Params:
    focus_brand: str
    brand_label: str
    brand_rules: list
    months: list | None = None                 # None = every month present
    generation_tokens: list = field(default_factory=list)
    high_tokens: list = field(default_factory=list)
    low_tokens: list = field(default_factory=list)
    signal_regex: str = ""
    must_map_tokens: list = field(default_factory=list)
    must_not_map_tokens: list = field(default_factory=list)
    keywords: dict = field(default_factory=dict)
    channel_labels: dict = field(default_factory=dict)
    key_aliases: dict = field(default_factory=dict)
    iroas_floor: float = 50000.0


EXPORT_PARAMS = Params(
    focus_brand=EXPORT_FOCUS_BRAND, brand_label=EXPORT_BRAND_LABEL,
    brand_rules=EXPORT_BRAND_RULES, months=EXPORT_MONTHS,
    generation_tokens=EXPORT_GENERATION_TOKENS, high_tokens=EXPORT_HIGH_CONFIDENCE_TOKENS,
    low_tokens=EXPORT_LOW_CONFIDENCE_TOKENS, signal_regex=EXPORT_SIGNAL_REGEX,
    must_map_tokens=EXPORT_MUST_MAP_TOKENS, must_not_map_tokens=EXPORT_MUST_NOT_MAP_TOKENS,
    keywords=EXPORT_BRAND_KEYWORDS, channel_labels=EXPORT_CHANNEL_LABELS,
    key_aliases=EXPORT_KEY_ALIASES,
)

# ---------------------------------------------------------------------------
# The same roles on the driver tables (part names such as "hot ring").
# ---------------------------------------------------------------------------
DRIVER_BRAND_RULES = [
    ("Widget", "google", "%widget%", 80),
    ("Ring", "google", "%ring%", 80),
    ("Red", "google", "%red%", 120),
    ("Hot", "google", "%hot%", 100),
    ("Rod", "google", "%rod%", 80),
    ("Hot", "google", "%hot r%", 100),
    ("Widget", "meta", "%widget%", 80),
    ("Ring", "meta", "%ring%", 80),
    ("Red", "meta", "%red%", 120),
    ("Hot", "meta", "%hot%", 100),
    ("Rod", "meta", "%rod%", 80),
    ("Hot", "meta", "%hot r%", 100),
]

DRIVER_PARAMS = Params(
    focus_brand="Hot", brand_label="hot", brand_rules=DRIVER_BRAND_RULES, months=None,
    generation_tokens=["promo", "large"],
    high_tokens=["red "], low_tokens=["old "], signal_regex="(?i)(hot|red|old)",
    must_map_tokens=["hot"], must_not_map_tokens=["plate"],
    keywords={"Hot": ["hot", "warm"], "Cold": ["cold", "cool"], "Metal": ["rod", "bolt", "gear"]},
    channel_labels={"blinkit": "blinkit_cpass", "instamart": "instamart_cpass"},
    key_aliases={"hot_gizmo": "hot_gear"},
)
