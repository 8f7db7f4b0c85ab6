"""riskloom: risk features, scoring and drift monitoring as Spark DataFrame plans."""
