"""Named analytic queries over the relational, star and snowflake models."""
