"""Column expressions and small numeric helpers (fixed statistical tables)."""
