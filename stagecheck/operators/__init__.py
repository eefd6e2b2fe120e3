"""DataFrame operators: mapping, cleaning, matching, reports, audits, numbering, ledgers, tracking."""
