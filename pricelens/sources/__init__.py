"""Readers and writers. Only this package and `plans.pipeline` touch storage."""

from pricelens.sources.listings import (  # noqa: F401
    append_listings,
    append_matches,
    archive_raw,
    read_listing_json,
    read_listings,
    replace_table,
    stage_listings,
    stage_matched,
    write_clean,
    write_sample_json,
)
