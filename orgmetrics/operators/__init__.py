"""Set-based operators: ``DataFrame -> DataFrame``."""
