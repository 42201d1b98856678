"""The parse step as an incremental stream over the raw-page table."""
