"""The registered queries: each operator wired to the star-schema tables, with its SQL twin."""
