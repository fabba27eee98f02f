"""The digest tree of a batch of sources: recorded when staged, compared later."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import config as C
from ..operators import digests as D
from ..session import stored

#: table -> (key whose hash names a row's part, columns)
MANIFEST = {
    "transactions_raw": (["basket_id"], ["household_id", "store_id", "basket_id", "product_id", "quantity", *C.MONEY, "transaction_timestamp", "week"]),
    "promotions": (["product_id", "store_id"], ["product_id", "store_id", "display_location", "mailer_location", "week"]),
    "products": (["product_id"], ["product_id", *C.DESCRIPTIONS["products"]]),
    "demographics": (["household_id"], ["household_id", *C.DESCRIPTIONS["demographics"]]),
    "campaigns": (["household_id"], ["campaign_id", "household_id"]),
    "campaign_descriptions": (["campaign_id"], ["campaign_id", "campaign_type", "start_date", "end_date"]),
    "coupons": (["product_id"], ["coupon_upc", "product_id", "campaign_id"]),
    "coupon_redemptions_raw": (["household_id"], C.REDEMPTION_GRAIN),
}


def manifest(frames: dict[str, DataFrame]) -> DataFrame:
    """(level, table_name, part, rows, digest): parts, tables and batch."""
    return D.table_digests({t: (df, *MANIFEST[t]) for t, df in frames.items()})


def staged_manifest(src) -> DataFrame:
    """The manifest of the staged tables as they are now."""
    return manifest({t: src.source(t) for t in MANIFEST})


def recorded_manifest(src) -> DataFrame:
    """The manifest recorded for the staged tables: computed once and stored beside them."""
    if "recorded_manifest" not in src.__dict__:
        src.__dict__["recorded_manifest"] = stored(staged_manifest(src), "manifest")
    return src.__dict__["recorded_manifest"]


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """All tables and the batch with their status, and each part that is not the same."""
    return D.compare_trees(before, after).where("level <> 'part' or status <> 'PASS'")
