from .business import (as_of, asset_details, asset_measurements, customer_accounts,
                       customer_asset_hierarchy, meters)
from .quality import accepted_values, not_null, orphans, row_counts, run_checks, unique
from .references import reference_codes, reference_table
from .reports import active_hierarchy, hub_counts, quality_counts, recent_measurements
from .staging import stage_readings
from .vault import (VaultFrames, build_vault, compact_satellite, hub_rows, link_rows,
                    measurement_rows, satellite_rows, upsert_rows)
from .window import change_points, first_by, latest_by

__all__ = [
    "as_of", "asset_details", "asset_measurements", "customer_accounts",
    "customer_asset_hierarchy", "meters", "accepted_values", "not_null", "orphans",
    "row_counts", "run_checks", "unique", "reference_codes", "reference_table",
    "active_hierarchy", "hub_counts", "quality_counts", "recent_measurements",
    "stage_readings", "VaultFrames", "build_vault", "compact_satellite", "hub_rows",
    "link_rows", "measurement_rows", "satellite_rows", "upsert_rows", "change_points",
    "first_by", "latest_by",
]
