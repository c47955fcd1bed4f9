"""Sources and sinks: ledger tables, request/callback messages, outbox publishing."""
