"""Writers: partition replacement, CSV export, the fact table."""
