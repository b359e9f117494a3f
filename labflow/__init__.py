"""A lab-results lakehouse on Spark: checked feeds, keyed upserts and deletes, quarantine, reports and an audit trail."""
