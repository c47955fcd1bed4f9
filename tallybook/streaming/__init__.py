"""Structured Streaming jobs: intake, routing, dedupe, balances, posting, settlement, hold
timers, outbox publishing, backlog windows."""
