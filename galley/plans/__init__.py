"""Ready-made plans: adapters from the star-schema tables, and the registered queries."""
