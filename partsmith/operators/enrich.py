"""Second-vendor enrichment: components LEFT JOIN categories LEFT JOIN
manufacturers, mapped onto catalog columns.

The joins carry no broadcast hint: the dimension tables' sizes are checked by
the planner (file statistics against ``autoBroadcastJoinThreshold``) and again
at runtime by AQE, which turns a shuffle join into a broadcast join only when
the measured side is small.  A manufacturer table that outgrows the threshold
therefore stays a sort-merge join instead of overflowing executor memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsmith.functions.coerce import epoch_to_timestamp, prefixed_key, tier_label

KEY_PREFIX = "C"  # fixed value: the catalog key is the vendor code behind this letter


def enrich(components: DataFrame, categories: DataFrame, manufacturers: DataFrame) -> DataFrame:
    """Vendor components as catalog rows (vendor columns filled, stock untouched)."""
    c = components.alias("c")
    cat = categories.select(F.col("id").alias("__cat_id"), F.col("category").alias("__cat"),
                            F.col("subcategory").alias("__sub"))
    mfr = manufacturers.select(F.col("id").alias("__mfr_id"), F.col("name").alias("__mfr"))
    j = (c.join(cat, F.col("c.category_id") == F.col("__cat_id"), "left")
          .join(mfr, F.col("c.manufacturer_id") == F.col("__mfr_id"), "left"))
    return j.select(
        prefixed_key(KEY_PREFIX, "c.part_code").alias("sku"),
        F.col("c.mfr").alias("mfr_part_number"),
        F.col("c.manufacturer_id").cast("bigint").alias("brand_id"),
        F.col("__mfr").alias("brand_name"),
        F.col("c.package").alias("package"),
        F.col("c.description").alias("description"),
        F.col("c.category_id").cast("bigint").alias("category_id"),
        F.col("__cat").alias("first_category_name"),
        F.col("__sub").alias("second_category_name"),
        F.col("c.datasheet").alias("pdf_url"),
        F.col("c.stock").cast("bigint").alias("vendor_stock"),
        F.col("c.price").alias("vendor_price_ladder"),
        tier_label("c.basic", "c.preferred").alias("vendor_library_type"),
        F.col("c.extra").alias("vendor_extra"),
        epoch_to_timestamp("c.last_update").alias("vendor_last_updated"),
    )


def vendor_categories(categories: DataFrame) -> DataFrame:
    """Vendor categories as catalog category rows (id, subcategory as name)."""
    return categories.select(F.col("id").cast("bigint").alias("id"),
                             F.col("subcategory").alias("name_en"))
