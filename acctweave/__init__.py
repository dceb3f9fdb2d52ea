"""Account-feed standardization and matching, written as Spark DataFrame plans."""
