"""Star-schema cubes on Spark: denormalise, check and append rows, aggregate every subset of dimensions."""
