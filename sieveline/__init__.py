"""Table-parity analytics on PySpark: fingerprints, profiles, rules, diffs, verdicts and lineage."""
