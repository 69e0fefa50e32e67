"""waymark: entity resolution, ranking, labelling and validation of place records on Spark."""
