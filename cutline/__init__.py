"""Point-in-time labels, features and scoring for customer behaviour tables on PySpark."""
