"""Public-transport fleet analytics expressed as Spark DataFrame transformations."""
