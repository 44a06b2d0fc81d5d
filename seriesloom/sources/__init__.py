"""Readers and writers of the pipeline's tables."""
from .tables import (  # noqa: F401
    read_transactions, read_keep_blanks, read_narrow, read_table, write_table,
    write_wide, TRANSACTIONS, ASSIGNMENTS, LABEL_COLUMNS, MEASURES,
)
