"""churnlens: client churn-risk and recurring-revenue analytics on Spark."""
