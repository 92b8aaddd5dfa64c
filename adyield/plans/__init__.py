"""End-to-end flows composed from the operators (bids, schedules, policy tables)."""
