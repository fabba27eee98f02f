"""Fixed values and parameters.

Everything here is data, passed into operators as arguments; operator bodies
never hard-code a code set, threshold, zone or calendar.
"""

from __future__ import annotations

import datetime as dt

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the reference's definitions for equal results.
# ---------------------------------------------------------------------------

# Promotion location codes.  Display: '0' and 'A' mean no special display,
# '1'..'7' and '9' mean a display.  Mailer: '0' means no mailer, the letters
# A C D F H J L P X Z mean a mailer.  Anything else (NULL, '', other) is unknown.
DISPLAY_NO_SUPPORT = ["0", "A"]
DISPLAY_SUPPORT = ["1", "2", "3", "4", "5", "6", "7", "9"]
MAILER_NO_SUPPORT = ["0"]
MAILER_SUPPORT = ["A", "C", "D", "F", "H", "J", "L", "P", "X", "Z"]
DISPLAY_KNOWN = DISPLAY_NO_SUPPORT + DISPLAY_SUPPORT
MAILER_KNOWN = MAILER_NO_SUPPORT + MAILER_SUPPORT

# Scope statuses and reasons of the product classifier.
IN_SCOPE, OUT_OF_SCOPE, REVIEW = "IN_SCOPE", "OUT_OF_SCOPE", "REVIEW"
SCOPE_STATUSES = [IN_SCOPE, OUT_OF_SCOPE, REVIEW]
REASON_DEFAULT = "Mixed or unconfirmed department"
REASON_DEPT_OUT = "Department excluded by project scope v1"
REASON_DEPT_IN = "Eligible department with category and type"
REASON_CATEGORY_REVIEW = "Exact category requires scope review"
REASON_MISSING_ATTR = "Missing classification attribute"
REASON_MISSING_LOOKUP = "Product missing from lookup"

# Support statuses of a sales line against weekly promotion data.
SUPPORT_STATUSES = ["NO_DISPLAY_MAILER", "DISPLAY_ONLY", "MAILER_ONLY", "DISPLAY_MAILER"]
UNKNOWN_STATUS = "UNKNOWN"

# DQ rule code prefix and tolerances.
DQ_PREFIX = "DQ_V1_"
CENT_TOLERANCE = "0.000001"

# Source calendar CJ_2017: 53 Monday-start weeks from 2016-12-26, coverage 2017.
CALENDAR_ID = "CJ_2017"
CALENDAR_FIRST_MONDAY = dt.date(2016, 12, 26)
CALENDAR_WEEKS = 53
COVERAGE_START = dt.date(2017, 1, 1)
COVERAGE_END = dt.date(2017, 12, 31)
SOURCE_ZONE = "America/New_York"

MONEY = ["sales_value", "retail_disc", "coupon_disc", "coupon_match_disc"]
MEASURES = ["quantity"] + MONEY

# Source keys and descriptive attributes per staged table.
REDEMPTION_GRAIN = ["household_id", "coupon_upc", "campaign_id", "redemption_date"]
REQUIRED_KEYS = {
    "products": ["product_id"],
    "demographics": ["household_id"],
    "campaign_descriptions": ["campaign_id"],
    "campaigns": ["campaign_id", "household_id"],
    "coupons": ["campaign_id", "coupon_upc", "product_id"],
    "coupon_redemptions": ["household_id", "coupon_upc", "campaign_id"],
    "transactions": ["household_id", "store_id", "basket_id", "product_id"],
    "promotions": ["product_id", "store_id"],
}
DESCRIPTIONS = {
    "products": ["manufacturer_id", "department", "brand", "product_category",
                 "product_type", "package_size"],
    "demographics": ["age", "income", "home_ownership", "marital_status",
                     "household_size", "household_comp", "kids_count"],
    "campaign_descriptions": ["campaign_type"],
}

# ---------------------------------------------------------------------------
# PARAMETERS of the driver-table fixture (same rule shape as the reference,
# different values; see FIXTURES.md).
# ---------------------------------------------------------------------------
SCOPE_RULE_VERSION = "fixture-1"
HIGH_QUANTITY = 45            # the reference uses 100; max quantity per line here is 49
SCOPE_IN_DEPARTMENTS = ["STANDARD", "MEDIUM", "LARGE"]
SCOPE_OUT_DEPARTMENTS = ["PROMO"]
SCOPE_REVIEW_CATEGORIES = ["RING"]
# (kind, department, category, product types, status, reason) refinements,
# applied in order to rows still REVIEW.
SCOPE_REFINEMENTS = [
    ("refine_in", "ECONOMY", "WIDGET", ["RED WIDGET", "BLUE WIDGET"], IN_SCOPE,
     "Reviewed category/type"),
    ("refine_out", "SMALL", "BOLT", ["RED BOLT", "BLUE BOLT"], OUT_OF_SCOPE,
     "Reviewed durable goods/accessories or services"),
]

# A longer decision list over (department, category, type), for products that are still under review: the three
# refinements by exact triples, then rules with wildcards (None).  The first that fits decides.
DECISION_ATTRIBUTES = ["department", "product_category", "product_type"]
DECISION_LISTS = {
    "personal_care": [("ECONOMY", c, f"{k} {c}", IN_SCOPE, "Reviewed personal care") for c, kinds in
                      [("GEAR", ["RED", "BLUE", "NEW"]), ("PLATE", ["HOT", "COLD"]), ("ROD", ["SMALL"])] for k in kinds],
    "nutrition": [("SMALL", c, f"{k} {c}", IN_SCOPE, "Reviewed nutrition") for c, kinds in
                  [("GIZMO", ["NEW", "OLD"]), ("ANVIL", ["RED"]), ("RING", ["LARGE", "HOT", "COLD"]), ("PLATE", ["BLUE"])] for k in kinds],
    "cosmetics": [("ECONOMY", c, f"{k} {c}", IN_SCOPE, "Reviewed cosmetics") for c, kinds in
                  [("ANVIL", ["OLD", "NEW"]), ("GIZMO", ["RED", "HOT"])] for k in kinds],
    "general": [("SMALL", "BOLT", None, OUT_OF_SCOPE, "Durable goods"), (None, "ROD", "OLD ROD", OUT_OF_SCOPE, "Old stock"),
                (None, None, "COLD GEAR", IN_SCOPE, "Type confirmed"), ("ECONOMY", None, None, REVIEW, "Department under review"),
                (None, None, None, REVIEW, "No rule")],
}

# Reasons for which a redemption may be left out of its fact; any other stops the load.  The given tables have these.
ACCEPTED_REJECTS = ["household not in campaign", "coupon not in campaign", "date outside campaign", "repeated row"]

BATCH_ID = 1
