"""wardloom: from raw hospital tables to a machine-learning data set, as Spark DataFrame operators."""
