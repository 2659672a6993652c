"""isolake: cohort analytics and training-data processing as Spark DataFrame plans."""
