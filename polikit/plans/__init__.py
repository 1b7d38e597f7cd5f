"""Composed plans: the registered queries, the SQL oracle, the whole pipeline run."""
