"""The reference's jobs as DataFrame operators: ``f(df, ..., **params) -> DataFrame``."""
