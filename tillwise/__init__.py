"""Retail analytics on Spark: feed cleaning, star-schema loading, sales reports and RFM segments."""
