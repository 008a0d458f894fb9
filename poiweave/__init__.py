"""poiweave: a Spark-native engine for building and analysing a points-of-interest knowledge graph."""
