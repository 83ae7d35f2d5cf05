"""Security-log analytics on Spark: parsing, detection rules, statistics and reports."""
