"""DataFrame -> DataFrame operators; no reads or writes here."""
