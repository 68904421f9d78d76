"""Retail-sales warehouse on Spark: staging extract -> snowflake or star tables -> reports."""
