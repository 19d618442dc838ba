"""Where the event log comes from."""
