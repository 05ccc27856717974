"""hexloom: geo-temporal feature engineering as Spark DataFrame programs."""
