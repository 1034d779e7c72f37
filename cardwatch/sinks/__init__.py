"""Writers: tables, rejects, reports, logs, served features and messages."""
