"""Support-ticket analytics on Spark: cleaning, rules, warehouse, KPIs and text classifiers."""
