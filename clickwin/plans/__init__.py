"""Job plans: incremental window control, catch-up, the registered queries."""
