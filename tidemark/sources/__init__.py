"""Tables read and written: scans, feature tables, scored log, run log, registry."""
