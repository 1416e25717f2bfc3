"""Sources, sinks and reference data."""

from dwkit.sources.files import (  # noqa: F401
    read_csv, read_table, convert_types, refresh, append, quarantine, write_csv,
    write_version, latest_version, write_routed, read_branch, stage, exists, is_complete, scratch_path,
)
from dwkit.sources.reference import (  # noqa: F401
    FLAT_SCHEMA, COMPLETION_SCHEMA, ERROR_SCHEMA, DELAY_PARTS, REASON_ROWS, REASON_COLUMNS,
    US_STATE_REGIONS, REGION_CODES, UNKNOWN_REGION_CODE, US_FEDERAL_HOLIDAYS_2024,
    seed_reasons, us_region_reference, REASON_LENGTHS, REGION_LENGTHS,
)
