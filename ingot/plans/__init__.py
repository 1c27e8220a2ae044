"""End-to-end plans: convert, validate, load, publish-with-ledger; and the
driver stand-ins (``standins``) that exercise each operator on the test tables."""
