"""The registered queries: every operator on the driver's tables, with its SQL oracle."""
