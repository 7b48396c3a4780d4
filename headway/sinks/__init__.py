"""Writing tables, messages and keyed logs."""
